"""Medians of columns: approximate and lazy, or exact by narrowing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that one digest may hold in full; up to this many the digest is exact.
_EXACT_ROWS = 50_000
# Digest accuracy and bracket half-width of a narrowing round.
_ACCURACY = 1_000
_MARGIN = 0.002


def without_nan(column: str) -> Column:
    """The column as double, with null for NaN."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def column_medians(
    df: DataFrame, columns: Sequence[str], relative_error: float = 0.01
) -> dict[str, Column]:
    """Median of each column: an element whose rank is within ``relative_error`` of the middle.

    All columns share one aggregate, which stays part of the calling query as a scalar subquery:
    nothing is run here, and Spark reuses the exchanges that both sides have in common. Nulls and
    NaN are ignored; a column without values has a null median. With ``relative_error=0`` the medians are
    exact and this call runs jobs; give it a stored table, since every round scans ``df`` twice.
    """
    if not columns:
        return {}
    if relative_error == 0:
        return {c: F.lit(m).cast("double") for c, m in exact_medians(df, columns).items()}
    accuracy = round(1 / relative_error)
    digests = [F.percentile_approx(without_nan(c), 0.5, accuracy).alias(c) for c in columns]
    medians = df.agg(F.struct(*digests).alias("medians")).scalar()
    return {c: medians.getField(c) for c in columns}


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The lower median of each column, exactly."""
    return exact_ranked(df, columns, lambda n: (n + 1) // 2)


def exact_ranked(
    df: DataFrame, columns: Sequence[str], rank: Callable[[int], int]
) -> dict[str, float | None]:
    """The element of each column at the rank (from 1) that ``rank`` gives for its number of values, exactly.

    Each round brackets the element between two others and counts the rows around them, so the
    rows in question shrink by a factor of some hundreds while the driver sees a few numbers per
    column. A hot value is settled by the counts, whatever its share of the rows.
    """
    head = df.agg(*[F.count(without_nan(c)).alias(c) for c in columns]).first()
    result: dict[str, float | None] = {c: None for c in columns}
    # column -> (open lower bound, open upper bound, rows up to the lower bound, rows inside)
    pending = {c: (None, None, 0, head[c]) for c in columns if head[c]}
    while pending:
        pending = _narrow(df, {c: rank(head[c]) for c in pending}, pending, result)
    return result


def _narrow(df: DataFrame, ranks: dict, pending: dict, result: dict) -> dict:
    probes = []
    for c, (low, high, below, inside) in pending.items():
        value = without_nan(c)
        if low is not None:
            value = F.when(value > low, value)
        if high is not None:
            value = F.when(value < high, value)
        middle = (ranks[c] - below - 0.5) / inside
        if inside <= _EXACT_ROWS:
            points, accuracy = [middle, middle], 2 * inside + 2
        else:
            points = [max(0.0, middle - _MARGIN), min(1.0, middle + _MARGIN)]
            accuracy = _ACCURACY
        probes.append(F.percentile_approx(value, points, accuracy).alias(c))
    found = df.agg(*probes).first()

    counts = []
    for c in pending:
        value, (low, high) = without_nan(c), found[c]
        counts += [
            F.struct(
                F.count_if(value < low).alias("before_low"),
                F.count_if(value <= low).alias("to_low"),
                F.count_if(value < high).alias("before_high"),
                F.count_if(value <= high).alias("to_high"),
            ).alias(c)
        ]
    around = df.agg(*counts).first()

    still = {}
    for c, (old_low, old_high, below, _) in pending.items():
        (low, high), rank, n = found[c], ranks[c], around[c]
        if n.before_low < rank <= n.to_low:
            result[c] = low
        elif n.before_high < rank <= n.to_high:
            result[c] = high
        elif rank <= n.before_low:
            still[c] = (old_low, low, below, n.before_low - below)
        elif rank > n.to_high:
            upto = below + pending[c][3]
            still[c] = (high, old_high, n.to_high, upto - n.to_high)
        else:
            still[c] = (low, high, n.to_low, n.before_high - n.to_low)
    return still
