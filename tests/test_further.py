"""Parts of operators met less often: key duplicates, inferred types, sketches, fits by group, best items, file order, plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokewise import session
from spokewise.functions import sketches
from spokewise.operators import best, cleanse, order, regression
from spokewise.plans import further_queries, star
from spokewise.sources import inference
from spokewise.sources.tables import read_csv, read_headerless_csv, split_marked

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("latest", [False, True])
def test_duplicates_by_key(spark, latest):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.randint(0, 5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k long, `odd.name` string, t int, v int")
    found = {(r[0], r[1]): (r[2], r[3]) for r in cleanse.drop_duplicates_by(df, ["k", "odd.name"], ["t"], latest).collect()}
    wanted = {}
    for k, name, t, v in rows:
        rank = ((t is not None, t or 0), v)
        if (k, name) not in wanted or (rank > wanted[k, name][0]) == latest and rank != wanted[k, name][0]:
            wanted[k, name] = (rank, (t, v))
    assert found == {k: row for k, (_, row) in wanted.items()}
    assert cleanse.drop_duplicates_by(df, ["k", "odd.name"], ["t"]).columns == df.columns
    assert cleanse.drop_duplicates_by(df.limit(0), ["k"], ["t"]).collect() == []
    assert cleanse.drop_duplicates_by(df.select("k"), ["k"]).count() == 4


def test_duplicates_by_key_need_no_window(spark):
    text = plan(further_queries.distinct_by_key(spark, SF_DIR))
    assert "Window" not in text and text.count("Exchange") == 1 and "partial_min" in text


def test_inferred_types(spark, tmp_path):
    lines = ["id,big,price,day,at,flag,name,empty"]
    lines += [f"{k},{k * 10**10},{k}.5,2020-01-{k + 1:02d},2020-01-01 00:00:{k:02d},true,n{k}," for k in range(20)]
    lines += [",,,,,,,", "-3,1,1e5,2021-02-28,2021-02-28,FALSE,2020,"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    found = inference.infer_csv(spark, str(tmp_path))
    assert [t for _, t in found.dtypes] == "int bigint double date timestamp_ntz boolean string string".split()
    assert found.count() == 22 and found.where("price = 100000").count() == 1
    (tmp_path / "b.csv").write_text(lines[0] + "\nx,1,2,2020-02-30,3,4,5,6\n")
    found = inference.infer_csv(spark, str(tmp_path))
    assert [t for _, t in found.dtypes] == "string bigint double string string string string int".split()


def test_types_of_nothing_are_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n")
    assert inference.infer_csv(spark, str(tmp_path)).dtypes == [("a", "string"), ("b", "string")]


@pytest.mark.parametrize("header", [True, False])
def test_marks_do_not_depend_on_what_is_selected(spark, tmp_path, header):
    lines = ["a,b,c"] * header + ["1,2,x", "1,zz,y", "only", "3,4,z,extra", "5,6,w", ",,"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    schema = inference.StructType.fromDDL("a long, b long, c string")
    reader = read_csv if header else read_headerless_csv
    df = reader(spark, str(tmp_path), schema, corrupt_column="line")
    marks = ["1,zz,y", "3,4,z,extra", "only"]
    assert sorted(r.line for r in df.collect() if r.line) == marks
    assert sorted(r.line for r in df.select("a", "line").collect() if r.line) == marks
    assert df.where("line IS NULL").count() == 3
    read, marked = split_marked(df, "line")
    assert read.columns == ["a", "b", "c"] and read.count() == 3 and sorted(r.line for r in marked.collect()) == marks


def test_sketches_merge_like_one(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate((rng.normal(size=6000), np.full(3000, 7.0)))
    rows = [(int(k % 7), float(v), None) for k, v in enumerate(values)] + [(9, None, None), (9, float("nan"), None)]
    df = spark.createDataFrame(rows, "part int, v double, nothing double")
    parts = sketches.sketch_parts(df, ["v", "nothing"], "part")
    found = {r.rank: r for r in sketches.quantiles(parts, [0.1, 0.5, 0.9]).collect()}
    assert {r.n_values for r in found.values()} == {9000}
    for rank, r in found.items():
        assert (values < r.value).mean() - 0.01 <= rank <= (values <= r.value).mean() + 0.01
    assert parts.where("part = 9 AND sketch IS NOT NULL").count() == 0
    assert sketches.quantiles(parts.limit(0), [0.5]).collect() == []


def test_new_part_scans_itself_only(spark):
    lines = star.table(spark, SF_DIR, "lineitem").withColumn("Year", F.year("l_shipdate"))
    text = plan(sketches.sketch_parts(lines.where("Year = 1998"), ["l_tax"], "Year"))
    assert "PushedFilters: [" in text and "ReadSchema: struct<l_tax:double,l_shipdate" in text


def test_fit_by_group(spark):
    rng = np.random.default_rng(6)
    rows = []
    for g in range(5):
        x = rng.normal(size=(40, 3)) * [1, 100, 0.01] + [0, 2000, 5]
        y = x @ rng.normal(size=3) + g + 0.1 * rng.normal(size=40)
        rows += [(f"g{g}", *map(float, r), float(t)) for r, t in zip(x, y)]
    rows += [("same", 1.0, 2.0, float(k), float(k)) for k in range(9)] + [("few", 1.0, 2.0, 3.0, 4.0)]
    rows += [("g0", None, 1.0, 1.0, 1.0), ("g0", 1.0, float("nan"), 1.0, 1.0), (None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, y double")
    model = {r.g: r for r in regression.fit_by_group(df, ["g"], ["a", "b", "c"], "y").collect()}
    for g in range(5):
        mine = np.array([r[1:] for r in rows if r[0] == f"g{g}" and None not in r and not np.isnan(r[2])])
        wanted = np.linalg.lstsq(np.column_stack((np.ones(len(mine)), mine[:, :3])), mine[:, 3], rcond=None)[0]
        r = model[f"g{g}"]
        assert np.allclose([r.intercept, r.slope_a, r.slope_b, r.slope_c], wanted, rtol=1e-6, atol=1e-7) and r.n == 40
    assert model["same"].slope_c is None and model["few"].intercept is None and None in model
    scored = regression.forecast_by_group(regression.fit_by_group(df, ["g"], ["a"], "y"), df, ["g"], ["a"])
    assert scored.columns == [*df.columns, "prediction"] and scored.count() == len(rows)


@pytest.mark.parametrize("first", [best.FIRST_BLOCK, 8])
def test_best_items(spark, monkeypatch, first):
    monkeypatch.setattr(best, "FIRST_BLOCK", first)
    rng = np.random.default_rng(8)
    y = rng.normal(size=(900, 6)) * rng.gamma(0.5, size=(900, 1))
    y[100:140], y[500:520] = y[99], 0
    x = np.concatenate((rng.normal(size=(700, 6)), np.zeros((1, 6))))
    users = [(k, v.tolist()) for k, v in enumerate(x)] + [(None, [1.0] * 6), (9000, None), (9001, [None] * 6)]
    items = [(k, v.tolist()) for k, v in enumerate(y)]
    schema = "id long, features array<double>"
    found = best.best_items(spark.createDataFrame(users, schema), spark.createDataFrame(items, schema), 5)
    assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)
    by = {}
    for r in found.collect():
        by.setdefault(r.user, []).append((r.rank, r.item, r.score))
    assert set(by) == set(range(701))
    for user, places in by.items():
        scores = x[user] @ y.T
        wanted = np.lexsort((np.arange(len(y)), -np.round(scores, 9)))[:5]
        places.sort()
        assert [p[0] for p in places] == [1, 2, 3, 4, 5]
        assert np.allclose([p[2] for p in places], scores[wanted])
    assert [p[1] for p in sorted(by[700])] == [0, 1, 2, 3, 4]


def test_best_items_leave_short_ones_out(spark):
    """The longest items win for everybody, so one round is enough."""
    y = np.concatenate((np.full((2000, 2), 10.0) + np.arange(2000)[:, None] * 1e-3, np.full((50_000, 2), 0.01)))
    items = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(y)], "id long, features array<double>")
    users = spark.createDataFrame([(k, [1.0, 1.0 + k]) for k in range(20)], "id long, features array<double>")
    asked, scored = [], best._scored

    def counted(open_, block, *rest):
        asked.append(block.count())
        return scored(open_, block, *rest)

    best._scored = counted
    try:
        assert best.best_items(users, items, 3).where("item NOT IN (1999, 1998, 1997)").count() == 0
    finally:
        best._scored = scored
    assert sum(asked) < 10_000


def test_no_items_and_no_users(spark):
    some = spark.createDataFrame([(1, [1.0])], "id long, features array<double>")
    assert best.best_items(some, some.limit(0)).collect() == []
    assert best.best_items(some.limit(0), some).collect() == []


def test_rows_out_of_order(spark, tmp_path):
    path = str(tmp_path / "rows")
    values = [None, 1, 2, 2, 3, 9, 4, 5, 6, 7, 1, 8, None]
    spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.option("maxRecordsPerFile", 3).parquet(path)
    found = sorted((r.before.v0, r.value.v0 or 0) for r in order.rows_out_of_order(spark, path, ["v"]).collect())
    assert found == [(7, 1), (8, 0), (9, 4)]


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(further_queries.rating_triples_bucketed(spark, SF_DIR)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    joins = [k for k, line in enumerate(lines) if "Join" in line]
    assert len(joins) == 3 and sum("Exchange" in line for line in lines) == 2
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for k in joins:
        if "CustomerKey" in lines[k] or "BikeKey" in lines[k]:
            below = []
            for line in lines[k + 1 :]:
                if depth(line) <= depth(lines[k]):
                    break
                below.append(line)
            assert below and not any("Exchange" in line for line in below)


def test_a_filtered_side_sends_its_keys_ahead(spark):
    settings = session.scale_settings(session.MIB // 100, cores=8) | {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        text = further_queries.segment_ratings(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "might_contain" in text


def test_best_places_of_a_block():
    rng = np.random.default_rng(1)
    scores = rng.integers(0, 30, (60, 80)).astype(float)
    scores[3], scores[4, :70] = 7, np.nan
    for least in (np.full(60, -np.inf), np.full(60, 28.0), rng.integers(0, 31, 60).astype(float)):
        row, place = best._best_places(scores, least, 5)
        for r in range(60):
            wanted = [c for c in np.lexsort((np.arange(80), -scores[r])) if scores[r, c] >= least[r]][:5]
            assert place[row == r].tolist() == wanted


def test_few_users_do_not_multiply_the_items():
    """Items are sent to every lane, so lanes stay few where users are."""
    assert best._lanes(54_000, 7_200_000) == (1, best.LANES)
    for users, items in ((1, 1), (1, 10**9), (10**9, 10**9), (10**9, 1), (5000, 5000), (0, 0)):
        lanes, shares = best._lanes(users, items)
        assert lanes * shares == best.LANES and lanes <= max(1, 2 * users // best.PACK + 1)
