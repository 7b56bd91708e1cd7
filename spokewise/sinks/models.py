"""Saving of models."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import SparkSession

from spokewise.operators.factors import FactorTables

#: Folder of factor tables within a model's path.
FACTORS = "factors"


def save_model(model: MLWritable | FactorTables, path: str) -> str:
    """Save a model, replacing what was there, so that a run can be repeated.

    Factor tables are saved as two Parquet tables in a folder of their own.
    """
    if isinstance(model, FactorTables):
        remove(model.userFactors.sparkSession, path)
        for side, table in (("users", model.userFactors), ("items", model.itemFactors)):
            table.write.parquet(f"{path}/{FACTORS}/{side}")
    else:
        model.write().overwrite().save(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
