"""Time single steps of the library, apart from the queries that contain them.

Uses BENCH_SF_DIR and BENCH_CPUS as bench.py does; prints one line per step, best of three.
"""

import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spokewise.functions.dates import LENIENT_DATE
from spokewise.functions.rules import AtLeast
from spokewise.functions.statistics import column_medians
from spokewise.operators import audit, cleanse, sales
from spokewise.plans import star
from spokewise.session import stored


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(form) -> float:
    def once() -> float:
        start = time.perf_counter()
        form()
        return time.perf_counter() - start

    return min(once() for _ in range(3))


def steps(spark, sf_dir):
    lines = star.bare_lines(spark, sf_dir)
    rules = [AtLeast(c, 1) for c in ("OrderId", "OrderLine", "BikeKey", "Quantity")]

    yield "audit of four bounds", lambda: run(audit.audit(lines, rules, "lines"))

    prices = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    columns = ["l_quantity", "l_extendedprice"]

    def medians_inside():
        rows = cleanse.drop_duplicate_rows(prices)
        medians = column_medians(rows, columns)
        repaired = cleanse.repair_negatives(rows, medians)
        run(cleanse.fill_missing(repaired, statistics=medians))

    yield "cleaning with two medians", medians_inside

    texts = stored(
        star.order_lines(spark, sf_dir).select(
            F.date_format("OrderDate", "d/M/yyyy").alias("OrderDate"), "Quantity"
        ),
        "text-dates",
    )
    yield "daily sales from date texts", lambda: run(sales.daily_sales(texts, LENIENT_DATE))
    yield (
        "daily sales over the order join",
        lambda: run(sales.daily_sales(star.order_totals(spark, sf_dir))),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench-forms")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, form in steps(spark, sf_dir):
        print(f"{name:34s} {best(form):7.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
