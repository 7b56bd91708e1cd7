"""Table readers. Schemas are declared, so reading costs no inference pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spokewise.schemas import TableSpec


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header line; types come from ``schema``, or are inferred where none is given.

    A header that differs from the schema is an error. ``mode="FAILFAST"`` stops at a malformed
    line; in PERMISSIVE mode its unreadable fields become null and ``corrupt_column``, if named,
    keeps the line: a line with too few or too many fields, or one whose values are not of their
    columns' types. Which lines are marked does not depend on the columns that a query reads.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    reader = reader.option("enforceSchema", False)
    if not corrupt_column:
        return reader.schema(schema).csv(path)
    # fields are read as text and cast here: Spark's own parser looks at the selected columns only
    text = [StructField(f.name, StringType()) for f in schema.fields]
    reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
    rows = reader.schema(StructType([*text, StructField(corrupt_column, StringType())])).csv(path)
    return _typed(rows, schema, [f.name for f in text], corrupt_column)


def read_headerless_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV without a header: text columns ``_c0, _c1, ...``, or named and cast by ``schema``.

    A value that is not of its column's type becomes null, and ``corrupt_column``, if named, keeps
    the line where that happened, or where fields are missing or too many.
    """
    if schema is None:
        return spark.read.csv(path)
    text = [StructField(f"_c{i}", StringType()) for i in range(len(schema.fields))]
    if not corrupt_column:
        return _typed(spark.read.schema(StructType(text)).csv(path), schema, [f.name for f in text])
    reader = spark.read.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
    rows = reader.schema(StructType([*text, StructField(corrupt_column, StringType())])).csv(path)
    return _typed(rows, schema, [f.name for f in text], corrupt_column)


def _typed(
    rows: DataFrame, schema: StructType, text: Sequence[str], corrupt_column: str | None = None
) -> DataFrame:
    """Text columns cast to the types of ``schema``; the line of a row that loses a value is kept."""
    casts = [F.col(c).try_cast(f.dataType) for c, f in zip(text, schema.fields)]
    columns = [c.alias(f.name) for c, f in zip(casts, schema.fields)]
    if corrupt_column:
        lost = [F.col(c).isNotNull() & value.isNull() for c, value in zip(text, casts)]
        line = F.to_csv(F.struct(*text))
        kept = F.coalesce(F.col(corrupt_column), F.when(reduce(lambda a, b: a | b, lost), line))
        columns.append(kept.alias(corrupt_column))
    return rows.select(*columns)


def split_marked(df: DataFrame, corrupt_column: str) -> tuple[DataFrame, DataFrame]:
    """The rows that were read, without the mark, and the lines that were not, as one text column."""
    marked = F.col(corrupt_column).isNotNull()
    return df.where(~marked).drop(corrupt_column), df.where(marked).select(corrupt_column)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    file_format: str = "csv",
    corrupt_column: str | None = None,
) -> DataFrame:
    """One of the known tables from CSV or Parquet, in its declared columns."""
    if file_format == "csv":
        return read_csv(spark, path, spec.schema, corrupt_column=corrupt_column)
    return spark.read.format(file_format).load(path).select(*spec.schema.names)


def rows_as_table(
    spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str | None = None
) -> DataFrame:
    """A few literal rows, such as the days to forecast; columns ``_1, _2, ...`` where no schema is given."""
    return spark.createDataFrame(list(rows), schema)
