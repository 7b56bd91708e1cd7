import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from spokewise.functions import statistics
from spokewise.functions.statistics import column_medians, exact_medians
from spokewise.operators.cleanse import clean, drop_duplicate_rows, fill_missing, repair_negatives
from spokewise.schemas import BIKES, BIKESHOPS, CUSTOMERS, ORDERS, TableSpec
from tests.retail_rows import frame


def lower_median(values):
    kept = sorted(v for v in values if v is not None and v == v)
    return kept[(len(kept) + 1) // 2 - 1] if kept else None


def test_duplicates_fold_and_null_equals_null(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a")], "k int, v string")
    assert drop_duplicate_rows(rows).count() == 3


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [1.0, 2.0],
        [None, None],
        [None, float("nan"), -5.0, 7.0, 7.0],
        [5.0] * 700 + list(range(300)),
        [1.0] * 500 + [2.0] * 500,
        [-1.0] * 600 + [3.0] * 400,
        [random.Random(1).gauss(0, 1e6) for _ in range(3001)],
        [10.0 ** random.Random(i).uniform(-300, 300) for i in range(2000)],
    ],
)
def test_exact_median_by_narrowing(spark, monkeypatch, values):
    """With a tiny exact limit the rounds really narrow; every result equals the sorted middle."""
    monkeypatch.setattr(statistics, "_EXACT_ROWS", 3)
    rows = [(None if v is None else float(v),) for v in values]
    df = spark.createDataFrame(rows, "v double").repartition(4)
    assert exact_medians(df, ["v"]) == {"v": lower_median(values)}


def test_exact_medians_of_several_columns(spark):
    draw = random.Random(3)
    rows = [(draw.randint(-9, 9), draw.random(), None) for _ in range(997)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    expected = {"a": lower_median([r[0] for r in rows]), "b": lower_median([r[1] for r in rows])}
    assert exact_medians(df, ["a", "b", "c"]) == {**expected, "c": None}


def test_approximate_median_keeps_its_rank_bound(spark):
    n = 20_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("v")).repartition(9)
    medians = column_medians(df, ["v"])
    value = df.select(medians["v"]).first()[0]
    assert abs(value + 1 - n / 2) <= 0.01 * n


def test_repair_counts_negatives_in_the_median_and_gives_double(spark):
    df = spark.createDataFrame([(v,) for v in (-9, -8, 1, 2, 3, None)], "v int")
    repaired = repair_negatives(df, column_medians(df, ["v"]))
    assert isinstance(repaired.schema["v"].dataType, DoubleType)
    assert sorted(repaired.dropna().toPandas()["v"]) == [1.0, 1.0, 1.0, 2.0, 3.0]
    assert repaired.where("v is null").count() == 1


@pytest.mark.parametrize("seed", range(4))
def test_one_median_serves_repair_and_fill(spark, seed):
    """The median after the repair is the one before it, negative or not."""
    draw = random.Random(seed)
    shift = draw.choice([-6, 0, 6])
    values = [(draw.randint(-10, 10) + shift,) for _ in range(draw.randint(5, 60))]
    df = spark.createDataFrame(values, "v int")
    before = exact_medians(df, ["v"])
    repaired = repair_negatives(df, {c: F.lit(m) for c, m in before.items()})
    assert exact_medians(repaired, ["v"]) == before


def test_fill_refuses_a_default_of_another_type(spark):
    df = spark.createDataFrame([(None, "x", None)], "n double, s string, i int")
    for default in ({"n": "1.0"}, {"s": 1}, {"i": 1.5}):
        with pytest.raises(ValueError):
            fill_missing(df, default)
    assert fill_missing(df, {"n": 1.5}).first().n == 1.5


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    filled = fill_missing(df, statistics=column_medians(df, ["v"]))
    assert [r.v for r in filled.collect()] == [None, None]


@pytest.mark.parametrize("relative_error", [0.01, 0])
def test_clean_bikes(spark, relative_error):
    rows = {r.BikeKey: r for r in clean(frame(spark, "bikes"), BIKES, relative_error).collect()}
    assert len(rows) == 5
    # prices 3000, 1200, -50, 900: lower median 900
    assert (rows[3].BikeCategory1, rows[3].BikeCategory2, rows[3].BikeFrame) == (
        "Road",
        "Sport",
        "Aluminum",
    )
    assert rows[3].BikePrice == 900.0 and rows[4].BikePrice == 900.0


def test_clean_other_tables(spark):
    shops = {r.BikeshopKey: r for r in clean(frame(spark, "bikeshops"), BIKESHOPS).collect()}
    assert len(shops) == 3
    assert shops[2][2:] == ("Los Angeles", "CA", 34.052234, -118.243685)

    orders = {r.OrderKey: r for r in clean(frame(spark, "orders"), ORDERS).collect()}
    # quantities 2, 5, -7, 4, 3, 4, 6: median 4
    assert len(orders) == 8 and orders[4].Quantity == 4.0 and orders[3].Quantity == 1.0

    customers = {r.CustomerKey: r for r in clean(frame(spark, "customers"), CUSTOMERS).collect()}
    # incomes 50000, -1, 70000, 60000: lower median 50000; children 0, -2, 3, 1: lower median 0
    assert len(customers) == 5
    assert (customers[3].AnnualIncome, customers[3].TotalChildren) == (50000.0, 0.0)
    assert customers[2].asDict() == {
        "CustomerKey": 2, "Prefix": "Mr.", "FirstName": "John", "LastName": "Doe",
        "BirthDate": None, "MaritalStatus": "Single", "Gender": "Male",
        "EmailAddress": "johndoe@email.com", "AnnualIncome": 50000.0, "TotalChildren": 0.0,
        "EducationLevel": "Bachelor's", "Occupation": "Engineer", "HomeOwner": "No",
    }


def test_spec_refuses_a_default_outside_its_domain():
    with pytest.raises(ValueError):
        TableSpec("bikes", BIKES.schema, BIKES.rules, defaults={"BikeFrame": "Aluminium"})


def test_lazy_clean_shuffles_the_rows_once(spark):
    """Medians and rows share the exchange of the de-duplication."""
    cleaned = clean(frame(spark, "customers"), CUSTOMERS)
    cleaned.collect()
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
