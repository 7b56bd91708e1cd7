"""Monthly quantity per frame type and its forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.functions.dates import parse_date
from spokewise.operators.sales import assemble, drop_unusable

MONTHS = ("Year", "Month")


def monthly_supply(
    orders: DataFrame, bikes: DataFrame, date_format: str | None = None
) -> DataFrame:
    """Quantity per year, month and frame; rows without a date share a null month.

    Both sides are cut to the needed columns before the join. The join carries no hint: Spark
    broadcasts the bikes when their size allows and otherwise sorts and merges, with skewed keys
    split by AQE. The aggregate folds each task's rows to a few groups before its shuffle. Where
    OrderDate is text of ``date_format``, it is parsed once per group of equal text.
    """
    sold = orders.select("BikeKey", "Quantity", "OrderDate").join(
        bikes.select("BikeKey", "BikeFrame"), "BikeKey"
    )
    if date_format is not None:
        sold = (
            sold.groupBy("OrderDate", "BikeFrame")
            .agg(F.sum("Quantity").alias("Quantity"))
            .withColumn("OrderDate", parse_date("OrderDate", date_format))
        )
    return sold.groupBy(
        F.year("OrderDate").alias("Year"), F.month("OrderDate").alias("Month"), "BikeFrame"
    ).agg(F.sum("Quantity").alias("TotalQuantity"))


def supply_features(monthly: DataFrame, unwanted: Sequence[float] = ()) -> DataFrame:
    """Dated monthly totals with the vector of Year and Month; the frame is not a feature."""
    return assemble(drop_unusable(monthly, MONTHS, "TotalQuantity", unwanted), MONTHS)


def forecast_supply(model: LinearRegressionModel, months: DataFrame) -> DataFrame:
    """Predicted quantity for rows of Year, Month."""
    return model.transform(assemble(months, MONTHS))
