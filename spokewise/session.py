"""Session settings that follow the size of the input, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CORE_SETTINGS = {"spark.shuffle.accurateBlockSkewedFactor": "5"}
GIB = 1 << 30
MIB = 1 << 20


def scale_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Runtime SQL settings for an input of ``input_bytes`` on ``cores`` task slots.

    The shuffle starts with about one partition per 4 GiB of input and 20,000 at most, never fewer
    than the cores: maps x reducers blocks stay some 50 KB large at 100 TB. AQE merges the small
    ones and splits the skewed ones towards one size. Small inputs keep small splits so that every
    core has work. A join whose smaller side was filtered sends a Bloom filter of its keys ahead of
    the larger side's shuffle, where that side scans at least a hundredth of the input and the filter's side is
    small enough to be read twice.
    """
    partitions = max(cores, min(20_000, -(-input_bytes // (4 * GIB))))
    split = max(16 * MIB, min(GIB, input_bytes // max(1, 4 * cores)))
    merged = max(64 * MIB, min(512 * MIB, input_bytes // max(1, 16 * cores)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(merged),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * merged),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(input_bytes // 100),
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(max(16 * MIB, min(4 * GIB, input_bytes // 1000))),
    }


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC dates; master and resources come from spark-submit.

    Beyond 2,000 shuffle partitions Spark reports block sizes as averages, in which AQE cannot see a
    hot key; the skewed factor keeps the true size of blocks that much over the median. It is read
    when a context starts, so a session that already runs must have been started with it.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in CORE_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster such a folder would be
    seen by one machine alone, so the missing setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spokewise-"))
    return context.getCheckpointDir().rstrip("/")


_SCOPES: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope for ``fresh_path`` and ``stored``: what they write inside it goes when it closes.

    Results have to be written elsewhere before that, as they may still read the scratch tables.
    """
    folder = f"{shared_dir(spark)}/spokewise/scope-{uuid.uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody has used yet; in the scope that is open, if one is."""
    folder = _SCOPES[-1] if _SCOPES else f"{shared_dir(spark)}/spokewise"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, options: dict[str, int | str] | None = None) -> DataFrame:
    """The same rows, written once to the shared folder, with ``options`` of the writer, and read back.

    For rows that several passes need: later passes scan columns instead of repeating the shuffles
    behind them, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
