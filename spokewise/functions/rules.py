"""Audit rules. A rule names a condition that every row of a table has to meet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from spokewise.functions.dates import parse_date


@dataclass(frozen=True)
class Rule:
    column: str

    @property
    def name(self) -> str:
        raise NotImplementedError

    def condition(self) -> Column:
        raise NotImplementedError

    def broken(self) -> Column:
        """True where the row fails the rule; a condition that is null counts as failed."""
        return ~F.coalesce(self.condition(), F.lit(False))


@dataclass(frozen=True)
class InSet(Rule):
    values: Sequence

    @property
    def name(self) -> str:
        return f"{self.column} in domain"

    def condition(self) -> Column:
        return F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class AtLeast(Rule):
    bound: float

    @property
    def name(self) -> str:
        return f"{self.column} >= {self.bound}"

    def condition(self) -> Column:
        return F.col(self.column) >= F.lit(self.bound)


@dataclass(frozen=True)
class GreaterThan(Rule):
    bound: float

    @property
    def name(self) -> str:
        return f"{self.column} > {self.bound}"

    def condition(self) -> Column:
        return F.col(self.column) > F.lit(self.bound)


@dataclass(frozen=True)
class Present(Rule):
    @property
    def name(self) -> str:
        return f"{self.column} present"

    def condition(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class WellFormed(Rule):
    """The reader could make sense of the line; ``column`` keeps the lines where it could not."""

    @property
    def name(self) -> str:
        return "line is well formed"

    def condition(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class DateFormat(Rule):
    """Text, where there is any, is a valid date of this form. Pair with ``Present`` for gaps."""

    date_format: str

    @property
    def name(self) -> str:
        return f"{self.column} is {self.date_format}"

    def condition(self) -> Column:
        return F.col(self.column).isNull() | parse_date(self.column, self.date_format).isNotNull()
