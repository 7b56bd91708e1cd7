"""The whole job over dirty CSV files, then scoring with its models."""

import pytest

from spokewise.__main__ import main, parser
from spokewise.plans import retail, scoring
from spokewise.schemas import TABLES
from spokewise.sources import models
from tests.retail_rows import ROWS


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    inputs = {}
    for name, (spec, rows) in ROWS.items():
        lines = [",".join("" if v is None else str(v) for v in row) for row in rows]
        if name == "orders":
            lines.append("9,8,1,5,1,many,21/05/2022")
            lines = [line.replace("8,7,1,2,5,6,", "3000000000,7,1,2,5,6,") for line in lines]
        (folder / f"{name}.csv").write_text("\n".join([",".join(spec.schema.names), *lines]))
        inputs[name] = str(folder / f"{name}.csv")
    report = retail.run(spark, inputs, str(folder / "out")).collect()
    # a second run replaces everything
    assert retail.run(spark, inputs, str(folder / "out")).collect() == report
    return retail.RetailJob(spark, str(folder / "out")), report


def test_report_lists_what_cleaning_could_not_mend(job):
    failed = {(r.table, r.rule): r.n_violations for r in job[1] if not r.passed}
    assert failed == {
        ("bikes", "BikeCategory1 in domain"): 1,
        ("bikes", "BikeCategory2 in domain"): 1,
        ("bikes", "BikeFrame in domain"): 1,
        ("bikeshops", "BikeshopState in domain"): 1,
        ("customers", "MaritalStatus in domain"): 1,
        ("customers", "Gender in domain"): 1,
        ("customers", "EducationLevel in domain"): 1,
        ("customers", "HomeOwner in domain"): 1,
        ("customers", "BirthDate present"): 1,
        ("customers", "BirthDate is dd/MM/yyyy"): 2,
        ("orders", "OrderDate present"): 1,
        ("orders", "OrderDate is d/M/y"): 1,
        ("orders", "line is well formed"): 1,
    }


def test_quarantine(spark, job):
    rows = spark.read.parquet(job[0].path("quarantine", "orders")).collect()
    assert sorted((r.OrderKey, r.rules) for r in rows) == [
        (5, ["OrderDate is d/M/y"]),
        (7, ["OrderDate present"]),
        (9, ["line is well formed"]),
    ]
    assert [r.malformed_line for r in rows if r.OrderKey == 9] == ["9,8,1,5,1,many,21/05/2022"]


def test_wide_keys_are_kept(spark, job):
    keys = spark.read.parquet(job[0].path("clean", "orders")).where("malformed_line IS NULL")
    assert 3000000000 in {r.OrderKey for r in keys.collect()}


def test_a_job_can_be_taken_up(spark, job):
    again = retail.run(spark, {}, job[0].out, from_step="publish").collect()
    assert again == job[1]


def test_published_tables_have_their_declared_columns(job):
    for name, spec in TABLES.items():
        assert job[0].cleaned(name).columns == spec.schema.names


def test_reports(spark, job):
    daily = spark.read.parquet(job[0].path("reports", "daily_sales"))
    assert {str(r.OrderDate): r.TotalSales for r in daily.collect()} == {
        "None": 8.0,
        "2020-03-01": 7.0,
        "2020-04-01": 1.0,
        "2021-04-15": 4.0,
        "2021-04-16": 3.0,
        "2022-05-20": 6.0,
    }


def test_scoring(spark, job):
    job = job[0]
    days = scoring.score_days(spark, job.path("models", "sales_forecast"), [(2023, 10, 9)])
    assert days.columns == ["Year", "Month", "Day", "features", "prediction"]
    assert days.first().prediction is not None
    months = scoring.score_months(spark, job.path("models", "supply_forecast"), [(2023, 10)])
    assert months.first().prediction is not None

    customers, orders = job.cleaned("customers"), job.cleaned("orders")
    segmented = scoring.score_segments(job.path("models", "segmentation"), customers, orders)
    assert sorted(r.CustomerKey for r in segmented.collect()) == [1, 2, 3, 4]
    clusters = models.load_segments(job.path("models", "segment_clusters"))
    # totals of the four customers: 11, 7, 4 and 4
    assert {c[0] for c in clusters.clusterCenters()} == {4.0, 7.0, 11.0}

    picks = scoring.score_customer(job.path("models", "recommender"), customers, 1, k=3)
    assert [(r.CustomerKey, r.rank) for r in picks.orderBy("rank").collect()] == [
        (1, 1), (1, 2), (1, 3)
    ]
    assert scoring.score_customer(job.path("models", "recommender"), customers, 99).count() == 0


def test_scoring_from_the_command_line(job, capsys):
    out = job[0].out
    main(["score", "--out", out, "supply", "2023-10"])
    main(["score", "--out", out, "segments"])
    main(["score", "--out", out, "recommend", "2", "--k", "1"])
    shown = capsys.readouterr().out
    assert "|2023|10   |" in shown and "TotalPurchase" in shown and "|2          |1   |" in shown


def test_command_line():
    args = parser().parse_args(
        ["run", "--input", "in", "--out", "o", "--input-bytes", "9", "--cores", "2"]
        + ["--jdbc-property", "user=u", "--from-step", "audit", "--recommender", "sums"]
    )
    assert (args.from_step, args.recommender, args.recommender_blocks) == ("audit", "sums", 10)
    assert (args.command, args.format, args.jdbc_property) == ("run", "csv", ["user=u"])
    args = parser().parse_args(["score", "--out", "o", "recommend", "12", "--k", "3"])
    assert (args.kind, args.customer, args.k) == ("recommend", 12, 3)
