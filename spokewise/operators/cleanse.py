"""Cleaning: duplicate rows, impossible values, missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.functions.statistics import column_medians, without_nan
from spokewise.schemas import TableSpec, check_defaults
from spokewise.session import stored


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; null equals null.

    The partial aggregate folds copies before the shuffle, so a row that fills a third of the
    table crosses the network once per task.
    """
    return df.dropDuplicates()


def drop_duplicates_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), latest: bool = False
) -> DataFrame:
    """Keep one row of each key: the one that comes first by ``order``, or last with ``latest``.

    Null equals null in a key and comes before every value in the order. Rows that agree in the
    order too are told apart by their other columns, so the same row stays in every run; where no
    order is named, the least row stays. One aggregate whose partial step keeps a single row per
    key and task: a hot key crosses the network once per task. There is no window and no sort of
    a key's rows.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*_quoted(keys)).dropDuplicates()
    ranks = [F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)]
    row = F.struct(*ranks, *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    kept = (F.max if latest else F.min)(row).alias("kept")
    named = {f"k{i}": c for i, c in enumerate(keys)}
    chosen = df.groupBy(*[F.col(f"`{c}`").alias(k) for k, c in named.items()]).agg(kept)
    back = {c: F.col(k) for k, c in named.items()} | {c: F.col(f"kept.c{i}") for i, c in enumerate(rest)}
    return chosen.select(*[back[c].alias(c) for c in df.columns])


def _quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def repair_negatives(df: DataFrame, medians: Mapping[str, Column]) -> DataFrame:
    """Replace negative values by the column's median. Nulls stay; the column becomes double."""
    return df.withColumns(
        {
            c: F.when(F.col(c) < 0, median).otherwise(F.col(c).cast("double"))
            for c, median in medians.items()
        }
    )


def fill_missing(
    df: DataFrame,
    defaults: Mapping[str, object] | None = None,
    statistics: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fill nulls (and NaN) by constants of the column's type, or by a column statistic."""
    if defaults:
        check_defaults(df.schema, defaults)
        df = df.fillna(dict(defaults))
    if statistics:
        df = df.withColumns(
            {c: F.coalesce(without_nan(c), statistic) for c, statistic in statistics.items()}
        )
    return df


def clean(df: DataFrame, spec: TableSpec, relative_error: float = 0.01) -> DataFrame:
    """The cleaned table: distinct rows, negatives repaired, gaps filled.

    One median per column serves both the repair and the fill. Moving the negatives onto the
    median leaves the median where it was: no row changes sides when the median is not negative,
    and all negatives coincide with it when it is. A second pass would find the same element.
    """
    rows = drop_duplicate_rows(df)
    if relative_error == 0:
        rows = stored(rows, f"distinct-{spec.name}")  # exact medians scan several times
    medians = column_medians(
        rows, list(dict.fromkeys((*spec.median_repair, *spec.median_fill))), relative_error
    )
    rows = repair_negatives(rows, {c: medians[c] for c in spec.median_repair})
    return fill_missing(rows, spec.defaults, {c: medians[c] for c in spec.median_fill})
