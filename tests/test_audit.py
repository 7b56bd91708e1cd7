import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spokewise.functions.rules import AtLeast, DateFormat, GreaterThan, InSet, Present
from spokewise.operators.audit import (
    audit,
    audit_from_violations,
    per_rule,
    combine,
    verdict,
    violations,
)
from spokewise.schemas import BIKES, BIKESHOPS, CUSTOMERS, ORDERS
from tests.retail_rows import ROWS, frame


def failures(report):
    return {r.rule: r.n_violations for r in report.collect() if not r.passed}


def test_raw_tables(spark):
    assert failures(audit(frame(spark, "bikes"), BIKES.rules, "bikes")) == {
        "BikeCategory1 in domain": 2,
        "BikeCategory2 in domain": 2,
        "BikeFrame in domain": 2,
        "BikePrice > 0": 2,
    }
    assert failures(audit(frame(spark, "bikeshops"), BIKESHOPS.rules, "bikeshops")) == {
        "BikeshopState in domain": 2
    }
    assert failures(audit(frame(spark, "orders"), ORDERS.rules, "orders")) == {
        "Quantity >= 1": 2,
        "OrderDate present": 1,
        "OrderDate is d/M/y": 1,
    }
    assert failures(audit(frame(spark, "customers"), CUSTOMERS.rules, "customers")) == {
        "MaritalStatus in domain": 2,
        "Gender in domain": 2,
        "EducationLevel in domain": 2,
        "HomeOwner in domain": 2,
        "TotalChildren >= 0": 2,
        "AnnualIncome >= 0": 2,
        "BirthDate present": 1,
        "BirthDate is dd/MM/yyyy": 2,
    }


def test_violating_rows_come_once(spark):
    found = violations(frame(spark, "orders"), [*ORDERS.rules, AtLeast("Quantity", 0)])
    broken = {r.OrderKey: r.rules for r in found.collect()}
    assert broken[4] == ["Quantity >= 1", "Quantity >= 0"] and found.count() == len(broken)


def test_violating_rows_are_listed_once_per_rule(spark):
    rows = per_rule(violations(frame(spark, "orders"), ORDERS.rules)).collect()
    assert sorted((r.OrderKey, r.rule) for r in rows) == [
        (3, "Quantity >= 1"),
        (4, "Quantity >= 1"),
        (5, "OrderDate is d/M/y"),
        (7, "OrderDate present"),
    ]


def test_verdict(spark):
    good = audit(frame(spark, "orders"), [AtLeast("OrderKey", 1)], "orders")
    mixed = audit(
        frame(spark, "bikes"), [AtLeast("BikeKey", 1), GreaterThan("BikePrice", 0)], "bikes"
    )
    assert {r.table: r.passed for r in verdict(combine([good, mixed])).collect()} == {
        "orders": True,
        "bikes": False,
    }


def test_report_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    frame(spark, "orders").write.parquet(path)
    report = audit(spark.read.parquet(path), ORDERS.rules, "orders")
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ROWS)
def test_report_from_violations_is_the_same(spark, name):
    df, rules = frame(spark, name), ROWS[name][0].rules
    again = audit_from_violations(violations(df, rules), df, rules, name)
    direct = audit(df, rules, name)
    assert again.dtypes == direct.dtypes
    assert sorted(again.collect()) == sorted(direct.collect())


def test_empty_table_passes(spark):
    report = audit(frame(spark, "bikes").where("false"), BIKES.rules, "bikes")
    assert all(r.passed and r.n_rows == 0 for r in report.collect())


RULES = (
    InSet("s", ("a", "b")),
    AtLeast("n", 1),
    GreaterThan("n", 0),
    Present("s"),
    DateFormat("s", "d/M/y"),
)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["a", "b", "c", "1/2/2020", "30/2/2020"])),
            st.one_of(st.none(), st.integers(-2, 2)),
        ),
        max_size=12,
    )
)
def test_counts_equal_brute_force(spark, rows):
    report = audit(spark.createDataFrame(rows, "s string, n int"), RULES, "t")
    expected = [
        sum(s not in ("a", "b") for s, _ in rows),
        sum(n is None or n < 1 for _, n in rows),
        sum(n is None or n <= 0 for _, n in rows),
        sum(s is None for s, _ in rows),
        sum(s is not None and s != "1/2/2020" for s, _ in rows),
    ]
    assert [r.n_violations for r in report.collect()] == expected
    broken = per_rule(violations(spark.createDataFrame(rows, "s string, n int"), RULES))
    assert broken.count() == sum(expected)


@pytest.mark.parametrize(
    "text, strict, lenient",
    [
        ("03/04/1990", True, True),
        ("1/2/1999", False, True),
        ("31/13/2000", False, False),
        ("30/02/2001", False, False),
        ("", False, False),
        ("1990-04-03", False, False),
    ],
)
def test_date_forms(spark, text, strict, lenient):
    df = spark.createDataFrame([(text,)], "d string")
    rules = [DateFormat("d", "dd/MM/yyyy"), DateFormat("d", "d/M/y")]
    assert [r.passed for r in audit(df, rules, "t").collect()] == [strict, lenient]
