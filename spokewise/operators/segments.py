"""Customer segmentation by purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def customer_totals(orders: DataFrame) -> DataFrame:
    """Quantity bought per customer."""
    return orders.groupBy("CustomerKey").agg(F.sum("Quantity").alias("TotalPurchase"))


def customers_with_totals(customers: DataFrame, totals: DataFrame) -> DataFrame:
    """Customers who bought something, with their totals.

    The totals are already one row per customer and partitioned by the join key.
    """
    return customers.join(totals, "CustomerKey", "inner")


def feature_steps(columns: Sequence[str] = ("TotalPurchase",), components: int = 1) -> list:
    """Assemble, standardise (mean 0, sample deviation 1), project on principal components."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error"),
        StandardScaler(
            inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=True
        ),
        PCA(k=components, inputCol="scaledFeatures", outputCol="pcaFeatures"),
    ]


def fit_features(
    df: DataFrame, columns: Sequence[str] = ("TotalPurchase",), components: int = 1
) -> PipelineModel:
    return Pipeline(stages=feature_steps(columns, components)).fit(df)


def fit_segmentation(
    df: DataFrame,
    columns: Sequence[str] = ("TotalPurchase",),
    components: int = 1,
    k: int = 4,
    seed: int = 1,
    cluster_on: str = "features",
) -> PipelineModel:
    """Feature steps and K-Means as one model, so that scoring uses the training's scaler.

    ``cluster_on`` chooses the raw vector, ``scaledFeatures`` or ``pcaFeatures``; only the steps that
    it needs are fitted. Only the feature
    columns enter the fit; the estimators pass over the input several times, so give it a stored
    table when the totals are costly.
    """
    kmeans = KMeans(k=k, seed=seed, featuresCol=cluster_on, predictionCol="prediction")
    steps = {"features": 1, "scaledFeatures": 2}.get(cluster_on, 3)
    stages = [*feature_steps(columns, components)[:steps], kmeans]
    return Pipeline(stages=stages).fit(df.select(*columns))


def assemble_totals(customers: DataFrame) -> DataFrame:
    """The totals as the vector that clusters saved alone are applied to."""
    return feature_steps()[0].transform(customers)


def assign_segments(model: PipelineModel, customers: DataFrame) -> DataFrame:
    """Customer, total and segment number."""
    return model.transform(customers).select("CustomerKey", "TotalPurchase", "prediction")
