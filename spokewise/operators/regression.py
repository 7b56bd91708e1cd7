"""Least squares for every group of a table at once: moments in one aggregate, solved in columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A pivot below this share of its feature's variance counts as zero.
SINGULAR = 1e-12


def _name(feature: str) -> str:
    return f"slope_{feature}"


def fit_by_group(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """(keys, n, intercept, slope_<feature> ...) of unregularised least squares in every group.

    Rows with a null or NaN among features and label are left out. Counts, means and covariances of a group
    come from one aggregate, which folds each task's rows to one line a group; the normal equations of
    the centred features are solved by elimination in column expressions, so groups are solved where their
    sums arrive and none passes through the driver. A group whose features depend on each other, or
    that has too few rows, has null coefficients.
    """
    features = list(features)
    columns = [F.col(c).cast("double") for c in (*features, label)]
    sound = df.where(~F.exists(F.array(*columns), lambda x: x.isNull() | F.isnan(x)))
    p = len(features)
    moments = [F.count("*").alias("n")]
    moments += [F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)]
    moments += [F.covar_pop(columns[i], columns[j]).alias(f"m_{i}_{j}") for i in range(p) for j in range(i, p + 1)]
    step = sound.groupBy(*keys).agg(*moments)
    entries = {(i, j): F.col(f"m_{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p + 1)}
    kept = [*keys, "n", *[f"mean_{i}" for i in range(p + 1)]]
    variances = [F.col(f"m_{i}_{i}").alias(f"v_{i}") for i in range(p)]
    step = step.select(*kept, *variances, *[c.alias(f"a_{i}_{j}") for (i, j), c in entries.items()])
    kept += [f"v_{i}" for i in range(p)]
    for k in range(p):
        step = step.select(*kept, *_eliminated(p, k))
    slopes = [F.col(f"a_{i}_{p}") for i in range(p)]
    intercept = F.col(f"mean_{p}")
    for i, slope in enumerate(slopes):
        intercept = intercept - slope * F.col(f"mean_{i}")
    named = [s.alias(_name(f)) for s, f in zip(slopes, features)]
    return step.select(*keys, "n", intercept.alias("intercept"), *named)


def _eliminated(p: int, k: int) -> list[Column]:
    """The equations after feature k is cleared from all of them but its own, where it gets factor 1.

    Covariances of independent features have positive pivots in any order, so rows are not exchanged.
    """
    pivot = F.when(F.col(f"a_{k}_{k}") > SINGULAR * F.col(f"v_{k}"), F.col(f"a_{k}_{k}"))
    out = []
    for i in range(p):
        for j in range(k + 1, p + 1):
            own = F.col(f"a_{k}_{j}") / pivot
            value = own if i == k else F.col(f"a_{i}_{j}") - F.col(f"a_{i}_{k}") * own
            out.append(value.alias(f"a_{i}_{j}"))
    return out


def forecast_by_group(model: DataFrame, rows: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``rows`` with the ``prediction`` of their group's fit; null for a group that has none.

    The model has one row a group; Spark broadcasts it after checking its size.
    """
    value = F.col("intercept")
    for f in features:
        value = value + F.col(_name(f)) * F.col(f)
    joined = rows.join(model.select(*keys, "intercept", *[_name(f) for f in features]), list(keys), "left")
    return joined.select(*rows.columns, value.alias("prediction"))
