import os
import subprocess
import sys
from unittest import mock

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from spokewise import session
from spokewise.operators import sales
from spokewise.schemas import BIKES, STATES
from spokewise.sinks.models import save_model
from spokewise.sinks.tables import publish_jdbc, publish_table, write_csv, write_parquet
from spokewise.sources.models import load_forecast
from spokewise.sources.tables import (
    read_csv,
    read_headerless_csv,
    read_parquet,
    read_table,
    rows_as_table,
)
from tests.retail_rows import BIKE_ROWS, frame

PAIRS = [("red", 1), ("green", 2), ("blue", 3)]
PAIR_SCHEMA = StructType(
    [StructField("name", StringType()), StructField("number", LongType())]
)


def test_headerless_roundtrip(spark, tmp_path):
    path = str(tmp_path / "pairs.csv")
    write_csv(rows_as_table(spark, PAIRS, PAIR_SCHEMA), path)
    text = read_headerless_csv(spark, path)
    assert text.dtypes == [("_c0", "string"), ("_c1", "string")]
    back = read_headerless_csv(spark, path, PAIR_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(PAIRS)
    assert back.schema == PAIR_SCHEMA


def test_csv_write_refuses_an_existing_path(spark, tmp_path):
    path = str(tmp_path / "pairs.csv")
    df = rows_as_table(spark, PAIRS, PAIR_SCHEMA)
    write_csv(df, path)
    with pytest.raises(PySparkException):
        write_csv(df, path)


def test_header_roundtrip_with_schema_and_with_inference(spark, tmp_path):
    path = str(tmp_path / "bikes.csv")
    write_csv(frame(spark, "bikes"), path, header=True)
    back = read_table(spark, BIKES, path)
    assert back.schema == BIKES.schema
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, BIKE_ROWS))
    assert read_csv(spark, path).schema["BikePrice"].dataType == IntegerType()


def test_malformed_lines(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("name,number\na,1\nb,many\n")
    schema = StructType([*PAIR_SCHEMA.fields])
    kept = read_csv(spark, str(path), schema, corrupt_column="raw").collect()
    assert [(r.name, r.number, r.raw) for r in kept] == [("a", 1, None), ("b", None, "b,many")]
    with pytest.raises(Exception, match="Malformed records"):
        read_csv(spark, str(path), schema, mode="FAILFAST").collect()


def test_headerless_lines_that_do_not_parse_are_marked(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("a,1\nb,many\n")
    schema = StructType([StructField("name", StringType()), StructField("number", LongType())])
    kept = read_headerless_csv(spark, str(path), schema, corrupt_column="raw").collect()
    assert [(r.name, r.number, r.raw) for r in kept] == [("a", 1, None), ("b", None, "b,many")]


def test_a_header_that_differs_from_the_schema_is_an_error(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("number,name\n1,a\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(path), PAIR_SCHEMA).collect()


def test_parquet_and_catalog_publishing_replace(spark, tmp_path):
    path = str(tmp_path / "bikes")
    for rows in (frame(spark, "bikes"), frame(spark, "bikes").limit(2)):
        write_parquet(rows, path)
    assert read_parquet(spark, path).count() == 2
    for n in (5, 3):
        publish_table(spark.range(n).toDF("k"), "numbers", str(tmp_path / "numbers"))
    assert spark.table("numbers").count() == 3
    spark.sql("DROP TABLE numbers")


def test_jdbc_publishing_is_distributed_and_replaces():
    """The writer's settings only: a real database would be a server, which tests do not start."""
    df = mock.MagicMock()
    writer = df.write.mode.return_value
    writer.option.return_value = writer
    publish_jdbc(df, "jdbc:some:url", "bikes", {"user": "u"}, connections=4, batch_rows=500)
    df.write.mode.assert_called_once_with("overwrite")
    assert writer.option.mock_calls == [mock.call("numPartitions", 4), mock.call("batchsize", 500)]
    writer.jdbc.assert_called_once_with("jdbc:some:url", "bikes", properties={"user": "u"})
    df.toPandas.assert_not_called()


def test_model_can_be_saved_again_and_scores_alike(spark, tmp_path):
    rows = [(2020, m, d, float(m + d)) for m in range(1, 13) for d in (1, 9, 20)]
    days = spark.createDataFrame(rows, "Year int, Month int, Day int, TotalSales double")
    model = sales.fit_forecast(sales.assemble(days, sales.CALENDAR), "TotalSales")
    path = str(tmp_path / "model")
    for _ in range(2):
        save_model(model, path)
    before = sales.forecast_sales(model, days).toPandas().prediction
    after = sales.forecast_sales(load_forecast(path), days).toPandas().prediction
    assert (before == after).all()


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_shared_dir_is_required_on_a_cluster():
    cluster = mock.MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.getCheckpointDir.return_value = None
    for master in ("yarn", "local-cluster[3,2,1024]"):
        cluster.sparkContext.master = master
        with pytest.raises(RuntimeError):
            session.shared_dir(cluster)


def test_a_closed_scope_leaves_no_files(spark):
    with session.scratch(spark) as folder:
        kept = session.stored(spark.range(5).toDF("k"), "numbers")
        assert kept.inputFiles()[0].split("/")[-2].startswith("numbers-") and kept.count() == 5
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert "scope-" not in session.fresh_path(spark, "x")


def test_hot_keys_are_split_above_2000_partitions():
    """In a session of its own: the setting is read when a context starts."""
    code = """
from pyspark.sql import functions as F
from spokewise.operators.recommend import with_known
from spokewise.session import build_session
spark = build_session("skew", {
    "spark.master": "local[4]", "spark.ui.enabled": "false", "spark.driver.memory": "2g",
    "spark.sql.shuffle.partitions": "2500", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
})
n = 600_000
key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
rows = spark.range(0, n, 1, 8).select(key.alias("k"), F.xxhash64("id").alias("v"))
joined = with_known(rows, spark.range(n).toDF("k"), "k")
joined.write.format("noop").mode("overwrite").save()
joined.count()
assert joined.collect()
assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_sessions_report_skewed_blocks():
    assert session.CORE_SETTINGS["spark.shuffle.accurateBlockSkewedFactor"] == "5"


def test_settings_follow_the_input():
    small = session.scale_settings(100 * session.MIB, cores=8)
    large = session.scale_settings(100_000 * session.GIB, cores=4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "20000"
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 16 * session.MIB
    assert int(large["spark.sql.files.maxPartitionBytes"]) == session.GIB


def test_states_are_complete():
    assert len(STATES) == len(set(STATES)) == 59
