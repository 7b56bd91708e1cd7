"""Scoring with saved models."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.operators import recommend, sales, segments, supply
from spokewise.sources import models
from spokewise.sources.tables import rows_as_table


def score_days(
    spark: SparkSession, model_path: str, days: Iterable[tuple[int, int, int]]
) -> DataFrame:
    """Sales forecast for (year, month, day) rows."""
    rows = rows_as_table(spark, days, "Year int, Month int, Day int")
    return sales.forecast_sales(models.load_forecast(model_path), rows)


def score_months(
    spark: SparkSession, model_path: str, months: Iterable[tuple[int, int]]
) -> DataFrame:
    """Supply forecast for (year, month) rows."""
    rows = rows_as_table(spark, months, "Year int, Month int")
    return supply.forecast_supply(models.load_forecast(model_path), rows)


def score_segments(model_path: str, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Segment of each customer with orders, by the scaler and clusters of the training."""
    totals = segments.customers_with_totals(customers, segments.customer_totals(orders))
    return segments.assign_segments(models.load_segmentation(model_path), totals)


def score_customer(model_path: str, customers: DataFrame, customer: int, k: int = 5) -> DataFrame:
    """The ``k`` best bikes for one customer: (CustomerKey, rank, BikeKey, score)."""
    one = customers.where(F.col("CustomerKey") == F.lit(customer))
    return recommend.ranked(recommend.recommend_to(models.load_recommender(model_path), one, k))
