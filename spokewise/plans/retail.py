"""The whole batch job: read, clean, audit, analyse, save models, publish."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.functions.rules import WellFormed
from spokewise.operators import audit, cleanse, recommend, sales, segments, supply
from spokewise.schemas import TABLES
from spokewise.session import scratch
from spokewise.sinks.models import save_model
from spokewise.sinks.tables import publish_jdbc, write_parquet
from spokewise.sources.tables import read_table

# Column of the stored tables that keeps lines the reader could not make sense of.
MALFORMED = "malformed_line"
STEPS = ("clean", "audit", "analyse", "publish")


@dataclass(frozen=True)
class Database:
    """Where to publish: a JDBC address, its properties and the parallel connections."""

    url: str
    properties: Mapping[str, str]
    connections: int = 16


class RetailJob:
    """Every step writes its result below ``out`` and the next step reads it from there.

    So the shuffles of the cleaning run once, each later step scans only the columns it needs, a
    lost executor costs a re-read, and a failed job can be taken up at the step that failed.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark = spark
        self.out = out.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join((self.out, *parts))

    def write(self, df: DataFrame, *parts: str) -> DataFrame:
        write_parquet(df, self.path(*parts))
        return self.spark.read.schema(df.schema).parquet(self.path(*parts))

    def cleaned(self, name: str) -> DataFrame:
        """A cleaned table in its declared columns, without the lines that could not be read."""
        table = self.spark.read.parquet(self.path("clean", name))
        if MALFORMED in table.columns:
            table = table.where(F.col(MALFORMED).isNull())
        return table.select(*TABLES[name].schema.names)

    def clean(self, inputs: Mapping[str, str], file_format: str = "csv") -> None:
        """Read and clean the tables.

        Lines that could not be read are kept with a mark: the audit counts them and sets them
        aside, and ``cleaned`` leaves them out.
        """
        for name, spec in TABLES.items():
            rows = read_table(self.spark, spec, inputs[name], file_format, MALFORMED)
            self.write(cleanse.clean(rows, spec), "clean", name)

    def audit(self) -> DataFrame:
        """The report over all tables; rows that break a rule are set aside per table."""
        reports = []
        for name, spec in TABLES.items():
            rows = self.spark.read.parquet(self.path("clean", name))
            rules = spec.rules
            if MALFORMED in rows.columns:
                rules = (*rules, WellFormed(MALFORMED))
            broken = self.write(audit.violations(rows, rules), "quarantine", name)
            reports.append(audit.audit_from_violations(broken, rows, rules, name))
        return self.write(audit.combine(reports), "audit")

    def analyse(self, method: str = "blocks", blocks: int = recommend.BLOCKS) -> None:
        """Reports and models; ``method`` and ``blocks`` are those of the recommender."""
        orders = self.cleaned("orders")
        date_format = TABLES["orders"].date_formats["OrderDate"]
        customers, bikes = self.cleaned("customers"), self.cleaned("bikes")

        daily = self.write(
            sales.daily_sales(orders, date_format).orderBy("OrderDate"), "reports", "daily_sales"
        )
        self.save(sales.fit_forecast(sales.sales_features(daily), "TotalSales"), "sales_forecast")

        monthly = self.write(
            supply.monthly_supply(orders, bikes, date_format), "reports", "monthly_supply"
        )
        self.save(
            sales.fit_forecast(supply.supply_features(monthly), "TotalQuantity"),
            "supply_forecast",
        )

        totals = self.write(
            segments.customers_with_totals(customers, segments.customer_totals(orders)),
            "reports",
            "customer_totals",
        )
        segmentation = segments.fit_segmentation(totals)
        self.save(segmentation, "segmentation")
        self.save(segmentation.stages[-1], "segment_clusters")

        ratings = self.write(
            recommend.rating_triples(orders, customers, bikes), "reports", "ratings"
        )
        self.save(recommend.fit_recommender(ratings, method, blocks), "recommender")

    def save(self, model, name: str) -> None:
        save_model(model, self.path("models", name))

    def publish(self, database: Database) -> None:
        for name in TABLES:
            publish_jdbc(
                self.cleaned(name),
                database.url,
                name,
                database.properties,
                connections=database.connections,
            )


def run(
    spark: SparkSession,
    inputs: Mapping[str, str],
    out: str,
    file_format: str = "csv",
    database: Database | None = None,
    method: str = "blocks",
    blocks: int = recommend.BLOCKS,
    from_step: str = STEPS[0],
) -> DataFrame:
    """Run the steps and return the audit report. ``inputs`` maps table names to paths.

    ``from_step`` takes up a failed job: earlier steps' results are read from ``out``.
    """
    job = RetailJob(spark, out)
    first = STEPS.index(from_step)
    with scratch(spark):
        if first <= STEPS.index("clean"):
            job.clean(inputs, file_format)
        if first <= STEPS.index("audit"):
            job.audit()
        if first <= STEPS.index("analyse"):
            job.analyse(method, blocks)
    if database:
        job.publish(database)
    report = spark.read.parquet(job.path("audit"))
    return report.orderBy(F.col("passed"), "table", "rule")
