"""Order of stored files, checked without sorting them again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def rows_out_of_order(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(file, row_index, before, value): rows of a Parquet folder that are less than the row before them.

    Files follow each other by name, as a sort writes them; nulls come first. Within a file a row is
    joined to its neighbour by number. The first row of a file is compared with the last row of the file before, over one
    line per file. So the check shuffles the compared columns once and sorts nothing globally.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")]
    value = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)]).alias("value")
    rows = spark.read.parquet(path).select(*place, value)
    following = rows.select("file", (F.col("row_index") + 1).alias("row_index"), F.col("value").alias("before"))
    inside = rows.join(following, ["file", "row_index"])
    bounds = rows.groupBy("file").agg(
        F.min_by("value", "row_index").alias("value"),
        F.max_by("value", "row_index").alias("last"),
        F.min("row_index").alias("row_index"),
    )
    before = F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("file"))  # one line per file
    across = bounds.withColumn("before", before).where("before IS NOT NULL")
    pairs = inside.select("file", "row_index", "before", "value").unionByName(across.drop("last"))
    return pairs.where(F.col("before") > F.col("value"))
