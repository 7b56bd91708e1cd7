"""Quantiles from mergeable sketches that are kept per part of a table.

A part, such as a year, is scanned once, when it arrives. Its sketch, some kilobytes a column, is
stored; quantiles over any set of parts come from merging sketches, without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.functions.statistics import without_nan

#: Size parameter: the rank error is some 2.6 / K**0.98 of the rows in 99 of 100 cases, half a percent here.
K = 800


def sketch_parts(df: DataFrame, columns: Sequence[str], part: str | Column, k: int = K) -> DataFrame:
    """(part, column_name, sketch): one sketch for every part and column; nulls and NaN are left out.

    Every task folds its rows to one sketch a part and column before the shuffle. A column
    without values in a part has a null sketch.
    """
    key = F.col(part) if isinstance(part, str) else part
    sketches = [
        F.when(F.count(without_nan(c)) > 0, F.kll_sketch_agg_double(without_nan(c), F.lit(k))).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    wide = df.groupBy(key.alias("part")).agg(*sketches)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return wide.select("part", F.inline(F.array(*pairs)))


def merged(sketches: DataFrame) -> DataFrame:
    """(column_name, n_values, sketch) over all parts of ``sketches``."""
    whole = sketches.where("sketch IS NOT NULL").groupBy("column_name")
    whole = whole.agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return whole.select("column_name", F.kll_sketch_get_n_double("sketch").alias("n_values"), "sketch")


def quantiles(sketches: DataFrame, ranks: Sequence[float]) -> DataFrame:
    """(column_name, n_values, rank, value) over all parts; a value is an element of the column."""
    each = [
        F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))).alias("value"))
        for r in ranks
    ]
    return merged(sketches).select("column_name", "n_values", F.inline(F.array(*each)))
