"""Types of text columns, found in one pass that counts what each type would lose."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from spokewise.sources.tables import read_csv

#: From narrow to wide; every later type reads what an earlier number type reads, and text reads all.
LATTICE = ("boolean", "int", "bigint", "double", "date", "timestamp_ntz", "string")

# The written forms of values. A cast alone would take a bare year for a date, and a
# failing cast is dear, so texts of another form are not cast.
WHOLE_FORM = r"^\s*[+-]?\d+\s*$"
NUMBER_FORM = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?|nan|inf|infinity)\s*$"
DATE_FORM = r"^\d{4}-\d{2}-\d{2}$"
TIME_FORM = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?$"


def readable(column: str, type_name: str) -> Column:
    """Can the text be read as a value of the type?"""
    text = F.col(f"`{column}`")
    if type_name == "boolean":
        return F.lower(text).isin("true", "false")
    fits = text.try_cast(type_name).isNotNull()
    if type_name in ("int", "bigint"):
        return text.rlike(WHOLE_FORM) & fits
    if type_name == "double":
        return text.rlike(NUMBER_FORM) & fits
    if type_name == "date":
        return text.rlike(DATE_FORM) & fits
    if type_name == "timestamp_ntz":
        return text.rlike(TIME_FORM) & fits
    return fits


def type_losses(rows: DataFrame, lattice: Sequence[str] = LATTICE) -> DataFrame:
    """(column_name, position, type, step, n_values, n_lost) for every text column and type.

    One aggregate over one scan; every task folds its rows to one line of counts.
    """
    counts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(position).alias("position"),
            F.lit(t).alias("type"),
            F.lit(step).alias("step"),
            F.count(F.col(f"`{c}`")).alias("n_values"),
            F.count_if(F.col(f"`{c}`").isNotNull() & ~readable(c, t)).alias("n_lost"),
        )
        for position, c in enumerate(rows.columns)
        for step, t in enumerate(lattice)
    ]
    names = [f"l{i}" for i in range(len(counts))]
    folded = rows.agg(*[c.alias(n) for c, n in zip(counts, names)])
    return folded.select(F.inline(F.array(*names)))


def narrowest(losses: DataFrame) -> DataFrame:
    """(column_name, position, type, n_values): the first type of the lattice that loses nothing.

    A column without any value is text.
    """
    fits = losses.where("n_lost = 0 AND (n_values > 0 OR type = 'string')")
    chosen = fits.groupBy("column_name", "position").agg(
        F.min_by("type", "step").alias("type"), F.first("n_values").alias("n_values")
    )
    return chosen


def infer_csv(spark: SparkSession, path: str, lattice: Sequence[str] = LATTICE) -> DataFrame:
    """CSV with a header line, read by the narrowest types that keep every value.

    The names come from the header, the types from one pass over the text; the result is a lazy scan with
    a declared schema, like any other.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = read_csv(spark, path, StructType([StructField(n, _type("string")) for n in names]))
    found = {r.position: r.type for r in narrowest(type_losses(text, lattice)).collect()}
    fields = [StructField(n, _type(found.get(i, "string"))) for i, n in enumerate(names)]
    return read_csv(spark, path, StructType(fields))


def _type(name: str):
    return StructType.fromDDL(f"c {name}").fields[0].dataType
