"""Helpers the operators share: keys, packed runs, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.session import stored

#: Stands for a null document id in joins and comparisons; sorts before every other id.
NULL_ID = -(2**63)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(column: str = "doc_id") -> Column:
    """The document id as long, with one fixed value for null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """(k1, k2): id and hash of the text. Rows that agree in both are copies of one row."""
    return [id_key(id_column).alias("k1"), F.xxhash64(F.col(text_column)).alias("k2")]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough to take apart into Python objects at once."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def placed(documents: DataFrame, *columns: Column | str, label: str = "rows") -> DataFrame:
    """``columns`` and rid: 16 bytes that tell rows apart, the same in every pass, in a fixed order.

    For a scan of Parquet files rid is the hash of the file's path and the row's number in the file, which
    do not depend on how a scan is split; nothing is written. Other inputs are stored once, with their running
    number.
    """

    def rid(high: Column, low: Column) -> Column:
        return F.unhex(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in (high, low)))).alias("rid")

    try:
        return documents.select(rid(F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")), *columns)
    except AnalysisException:  # not a scan of Parquet files
        return stored(documents.select(rid(F.lit(0).cast("long"), F.monotonically_increasing_id()), *columns), label)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 0, 3): owners (0, 0, 2, 2, 2) and numbers within them (0, 1, 0, 1, 2)."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge, in place, the classes of a[i] and b[i]; a label is its class's smallest index."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b); root is the smallest id it reaches.

    Large-star and small-star rounds: every round joins neighbours to the smallest one seen, sums
    fold in each task, and the edges stay distributed. Each round is stored, so that a lost
    executor repeats one round at most. Ids must not be null.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
    )
    seen = mark(now)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        now = stored(small, label)
        was, seen = seen, mark(now)
        if was == seen:
            break
    leaves = now.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return leaves.union(now.select("v", "v").distinct())
