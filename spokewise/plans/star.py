"""The retail tables seen through the order/line star schema of the test data.

An order line is (OrderId, OrderLine, CustomerKey, BikeKey, Quantity, OrderDate). The dates are
also offered as text with gaps and nonsense in it, as they come from retail files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.operators.recommend import with_known
from spokewise.sources.tables import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def date_text() -> Column:
    """Order date as d/M/y text: missing on low priority, no real date on urgent orders."""
    written = F.date_format("o_orderdate", "d/M/yyyy")
    return (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("31/13/2000"))
        .otherwise(written)
    )


def order_heads(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """(OrderId, CustomerKey, OrderDate); with ``dirty`` the date is text, see ``date_text``."""
    date = date_text() if dirty else F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderId"),
        F.col("o_custkey").alias("CustomerKey"),
        date.alias("OrderDate"),
    )


def order_lines(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Order lines with customer and date: lines and heads joined on the order."""
    return bare_lines(spark, sf_dir).join(order_heads(spark, sf_dir, dirty), "OrderId")


def bare_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderId"),
        F.col("l_linenumber").alias("OrderLine"),
        F.col("l_partkey").alias("BikeKey"),
        F.col("l_quantity").alias("Quantity"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating triples from the split tables.

    The customer check runs on the order heads, a quarter of the lines in number, so that the
    lines themselves cross the network for the order and, where bikes are too many to broadcast,
    for the bike, but not for the customer.
    """
    heads = with_known(order_heads(spark, sf_dir), customers(spark, sf_dir), "CustomerKey")
    lines = with_known(bare_lines(spark, sf_dir), bikes(spark, sf_dir), "BikeKey")
    return lines.join(heads, "OrderId").select("CustomerKey", "BikeKey", "Quantity")


def order_totals(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """One row per order that has lines: CustomerKey, OrderDate and the summed Quantity.

    For questions that do not look at the bike. Summing before the join folds the lines of a hot
    order in each task, and the join runs on the partitioning of the sum, so the shuffles are the
    same as without it.
    """
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("OrderId"))
        .agg(F.sum("l_quantity").alias("Quantity"))
    )
    return per_order.join(order_heads(spark, sf_dir, dirty), "OrderId")


def bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("BikeKey"),
        F.col("p_name").alias("BikeModel"),
        F.col("p_brand").alias("BikeCategory2"),
        F.col("p_type").alias("BikeFrame"),
        F.col("p_retailprice").alias("BikePrice"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerKey"),
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Occupation"),
        F.col("c_acctbal").alias("AnnualIncome"),
    )


def bikeshops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shops with their state: suppliers and the 25 nations."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("BikeshopState")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, "s_nationkey")
        .select(
            F.col("s_suppkey").alias("BikeshopKey"),
            F.col("s_name").alias("BikeshopName"),
            "BikeshopState",
        )
    )
