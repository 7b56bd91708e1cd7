"""Loading of saved models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spokewise.operators.factors import FactorTables
from spokewise.sinks.models import FACTORS


def load_forecast(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


def load_segments(path: str) -> KMeansModel:
    return KMeansModel.load(path)


def load_segmentation(path: str) -> PipelineModel:
    """The whole segmentation: feature steps as fitted in training, then the clusters."""
    return PipelineModel.load(path)


def load_recommender(path: str) -> ALSModel | FactorTables:
    """MLlib's model, or the factor tables of the other fit, whichever lies at the path."""
    spark = SparkSession.getActiveSession()
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FACTORS}")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return ALSModel.load(path)
    users, items = (spark.read.parquet(f"{path}/{FACTORS}/{side}") for side in ("users", "items"))
    rank = users.select(F.size("features")).first()
    return FactorTables(rank[0] if rank else 0, users, items)
