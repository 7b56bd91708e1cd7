"""Daily sales and their forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.functions.dates import calendar_features, parse_date

CALENDAR = ("Year", "Month", "Day")


def daily_sales(orders: DataFrame, date_format: str | None = None) -> DataFrame:
    """Quantity sold per day; rows without a date form one group.

    Where OrderDate is text of ``date_format``, the rows are summed per text first, so that each
    text is parsed once and not each row. Unsorted: a fit needs no order, and a report sorts the
    few daily rows itself.
    """
    daily = orders.groupBy("OrderDate").agg(F.sum("Quantity").alias("TotalSales"))
    if date_format is None:
        return daily
    parsed = daily.withColumn("OrderDate", parse_date("OrderDate", date_format))
    return parsed.groupBy("OrderDate").agg(F.sum("TotalSales").alias("TotalSales"))


def drop_unusable(
    totals: DataFrame, dates: Sequence[str], total: str, unwanted: Sequence[float] = ()
) -> DataFrame:
    """Totals that a model can be fitted to: with a date and a value.

    ``unwanted`` also removes totals that equal one of the given values.
    """
    usable = totals.dropna(subset=[*dates, total])
    return usable.where(~F.col(total).isin(*unwanted)) if unwanted else usable


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """The columns as one feature vector; a null among them is an error."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid="error"
    ).transform(df)


def sales_features(daily: DataFrame, unwanted: Sequence[float] = ()) -> DataFrame:
    """Dated daily totals with Year, Month, Day and their vector."""
    usable = drop_unusable(daily, ["OrderDate"], "TotalSales", unwanted)
    return assemble(calendar_features(usable), CALENDAR)


def fit_forecast(features: DataFrame, label: str) -> LinearRegressionModel:
    """Unregularised least squares; one pass over the rows, then a solve of feature-count size."""
    return LinearRegression(featuresCol="features", labelCol=label).fit(features)


def forecast_sales(model: LinearRegressionModel, days: DataFrame) -> DataFrame:
    """Predicted sales for rows of Year, Month, Day."""
    return model.transform(assemble(days, CALENDAR))
