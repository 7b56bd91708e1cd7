"""Table writers. All of them write from the executors; no table passes through the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def publish_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table; with ``path`` its files lie there."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def publish_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None
) -> None:
    """Replace a catalog table whose files are dealt out and sorted by ``keys``.

    Tables with the same number of buckets join on their keys without a shuffle, and sums by the
    keys need none either. The rows are dealt out before they are written, so there is one file a
    bucket. A hot key makes a large file: leave such tables unbucketed, where AQE can split it.
    """
    dealt = df.repartition(buckets, *[f"`{k}`" for k in keys])
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """Replace a database table over at most ``connections`` parallel connections.

    Each task commits its own rows, so a task that is repeated after its commit would write twice:
    publish from a stored table, and repeat the whole call (it replaces) if the job lost executors.
    """
    (
        df.write.mode("overwrite")
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .jdbc(url, table, properties=dict(properties or {}))
    )
