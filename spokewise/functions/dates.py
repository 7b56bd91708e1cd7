"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two text forms of a date in retail files.
STRICT_DATE = "dd/MM/yyyy"  # two-digit day and month
LENIENT_DATE = "d/M/y"  # one or two digits


def parse_date(column: str, date_format: str) -> Column:
    """The date in a text column, null where the text is missing or not a date of this form."""
    return F.try_to_date(F.col(column), date_format)


def calendar_features(df: DataFrame, date: str = "OrderDate") -> DataFrame:
    """Add Year, Month and Day of a date column."""
    return df.withColumns(
        {"Year": F.year(date), "Month": F.month(date), "Day": F.dayofmonth(date)}
    )
