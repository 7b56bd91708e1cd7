import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokewise.functions.dates import LENIENT_DATE, parse_date
from spokewise.operators import recommend, sales, segments, supply
from spokewise.session import stored
from spokewise.sinks.models import save_model
from spokewise.sources.models import load_recommender
from tests.retail_rows import frame

day = datetime.date


@pytest.fixture(scope="module")
def text_orders(spark):
    return frame(spark, "orders").dropDuplicates().fillna({"Quantity": 1})


@pytest.fixture(scope="module")
def orders(text_orders):
    return text_orders.withColumn("OrderDate", parse_date("OrderDate", LENIENT_DATE))


@pytest.mark.parametrize("as_text", [False, True])
def test_daily_sales_keep_one_group_without_date(orders, text_orders, as_text):
    daily = sales.daily_sales(text_orders, LENIENT_DATE) if as_text else sales.daily_sales(orders)
    assert {r.OrderDate: r.TotalSales for r in daily.collect()} == {
        day(2020, 3, 1): 7,
        day(2020, 4, 1): 1,
        day(2021, 4, 15): -7,
        day(2021, 4, 16): 3,
        day(2022, 5, 20): 6,
        None: 8,
    }


def test_unusable_totals(spark):
    totals = spark.createDataFrame(
        [("2020-01-01", 5), ("2020-01-02", None), (None, 7), ("2020-01-03", 9)], "d string, t int"
    )
    assert [r.t for r in sales.drop_unusable(totals, ["d"], "t").collect()] == [5, 9]
    assert [r.t for r in sales.drop_unusable(totals, ["d"], "t", unwanted=[9]).collect()] == [5]


def test_a_null_feature_is_an_error(spark):
    days = spark.createDataFrame([(2020, None, 1)], "Year int, Month int, Day int")
    with pytest.raises(Exception, match="null"):
        sales.assemble(days, sales.CALENDAR).collect()


def test_sales_forecast_is_least_squares(spark):
    first = day(2019, 1, 1)
    rows = [
        (first + datetime.timedelta(days=5 * i), float((i * 37) % 101 + i)) for i in range(200)
    ]
    daily = spark.createDataFrame(rows, "OrderDate date, TotalSales double")
    model = sales.fit_forecast(sales.sales_features(daily), "TotalSales")
    x = np.array([[1, d.year, d.month, d.day] for d, _ in rows], float)
    expected, *_ = np.linalg.lstsq(x, np.array([t for _, t in rows]), rcond=None)
    assert np.allclose([model.intercept, *model.coefficients], expected, rtol=1e-6)
    ahead = spark.createDataFrame([(2023, 10, 9)], "Year int, Month int, Day int")
    forecast = sales.forecast_sales(model, ahead).first().prediction
    assert forecast == pytest.approx(expected @ [1, 2023, 10, 9])


def test_one_year_only_still_solves(spark):
    rows = [(day(2020, m, 1), 10.0 * m) for m in range(1, 13)]
    daily = spark.createDataFrame(rows, "OrderDate date, TotalSales double")
    model = sales.fit_forecast(sales.sales_features(daily), "TotalSales")
    assert list(model.coefficients) == pytest.approx([0, 10, 0])


@pytest.mark.parametrize("as_text", [False, True])
def test_monthly_supply(spark, orders, text_orders, as_text):
    bikes = frame(spark, "bikes").dropDuplicates()
    if as_text:
        monthly = supply.monthly_supply(text_orders, bikes, LENIENT_DATE)
    else:
        monthly = supply.monthly_supply(orders, bikes)
    assert {
        (r.Year, r.Month, r.BikeFrame): r.TotalQuantity for r in monthly.collect()
    } == {
        (2020, 3, "Carbon"): 2,
        (2020, 3, "Aluminum"): 5,
        (2020, 4, "Carbon"): 1,
        (2021, 4, None): -7,
        (2021, 4, "Carbon"): 3,
        (2022, 5, "Bamboo"): 6,
        (None, None, "Carbon"): 8,
    }


def test_supply_forecast_pools_the_frames(spark):
    rows = [
        (2019 + m // 12, m % 12 + 1, frame_, float(m * 3 + len(frame_)))
        for m in range(30)
        for frame_ in ("Carbon", "Aluminum")
    ]
    monthly = spark.createDataFrame(
        rows + [(None, None, "Carbon", 99.0)],
        "Year int, Month int, BikeFrame string, TotalQuantity double",
    )
    model = sales.fit_forecast(supply.supply_features(monthly), "TotalQuantity")
    x = np.array([[1, r[0], r[1]] for r in rows], float)
    expected, *_ = np.linalg.lstsq(x, np.array([r[3] for r in rows]), rcond=None)
    assert np.allclose([model.intercept, *model.coefficients], expected, rtol=1e-6)


def test_customers_without_orders_and_unknown_customers_drop_out(spark, orders):
    totals = segments.customer_totals(orders)
    assert {r.CustomerKey: r.TotalPurchase for r in totals.collect()} == {
        1: 11, 2: 7, 3: -7, 4: 4, 99: 3
    }
    joined = segments.customers_with_totals(frame(spark, "customers").dropDuplicates(), totals)
    assert sorted(r.CustomerKey for r in joined.collect()) == [1, 2, 3, 4]
    assert joined.columns[0] == "CustomerKey" and joined.columns[-1] == "TotalPurchase"


@pytest.fixture(scope="module")
def totals(spark):
    rows = [(i, float(100 * (i % 4) + i % 7)) for i in range(200)]
    return spark.createDataFrame(rows, "CustomerKey int, TotalPurchase double")


def test_features_are_standardised(totals):
    scored = segments.fit_features(totals).transform(totals).toPandas()
    raw = scored.TotalPurchase
    z = (raw - raw.mean()) / raw.std(ddof=1)
    assert np.allclose(scored.scaledFeatures.map(lambda v: v[0]), z)
    assert np.allclose(scored.pcaFeatures.map(lambda v: abs(v[0])), abs(z))


def test_principal_components_of_several_columns(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 3)) @ np.array([[3, 1, 0], [0, 1, 2], [0, 0, 0.2]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    scored = segments.fit_features(df, ["a", "b", "c"], components=2).transform(df).toPandas()
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    _, _, axes = np.linalg.svd(z, full_matrices=False)
    got = np.array([v.toArray() for v in scored.pcaFeatures])
    assert np.allclose(np.abs(got), np.abs(z @ axes[:2].T))


@pytest.mark.parametrize("cluster_on", ["features", "scaledFeatures", "pcaFeatures"])
def test_segments_are_the_four_groups(totals, cluster_on):
    model = segments.fit_segmentation(totals, cluster_on=cluster_on)
    rows = segments.assign_segments(model, totals).toPandas()
    groups = rows.groupby(rows.CustomerKey % 4).prediction.nunique()
    assert (groups == 1).all() and rows.prediction.nunique() == 4


@pytest.fixture(scope="module")
def ratings(spark):
    draw = np.random.default_rng(2)
    rows = [
        (int(draw.integers(1, 40)), int(draw.integers(1, 25)), float(draw.integers(1, 9)))
        for _ in range(600)
    ]
    return spark.createDataFrame(rows, "CustomerKey int, BikeKey int, Quantity double")


@pytest.fixture(scope="module", params=["blocks", "sums"])
def recommender(ratings, request):
    """Fitted by MLlib's blocks, and by sums."""
    return recommend.fit_recommender(ratings, method=request.param)


def factors(model):
    def read(df):
        return {r.id: np.array(r.features, float) for r in df.collect()}

    return read(model.userFactors), read(model.itemFactors)


def test_user_factors_solve_their_ridge_problem(ratings, recommender):
    """Repeated pairs count as separate ratings, and the penalty grows with their number."""
    users, items = factors(recommender)
    rows = ratings.toPandas()
    for user, mine in rows.groupby("CustomerKey"):
        y = np.array([items[i] for i in mine.BikeKey])
        gram = y.T @ y + 0.01 * len(mine) * np.eye(recommender.rank)
        expected = np.linalg.solve(gram, y.T @ mine.Quantity.to_numpy())
        assert np.allclose(users[user], expected, rtol=1e-2, atol=1e-2)


def test_top_five_equals_scoring_every_bike(ratings, recommender):
    users, items = factors(recommender)
    asked = ratings.select("CustomerKey").distinct()
    got = recommend.ranked(recommend.recommend_to(recommender, asked, 5)).toPandas()
    assert set(got.CustomerKey) == set(users)
    for user, mine in got.groupby("CustomerKey"):
        mine = mine.sort_values("rank")
        best = sorted((users[user] @ y for y in items.values()), reverse=True)[:5]
        assert list(mine["rank"]) == [1, 2, 3, 4, 5]
        assert np.allclose(mine.score, best, rtol=1e-4, atol=1e-4)


def test_unknown_customers_get_nothing(spark, recommender):
    asked = spark.createDataFrame([(3,), (777,)], "CustomerKey int")
    got = recommend.ranked(recommend.recommend_to(recommender, asked, 5)).toPandas()
    assert set(got.CustomerKey) == {3} and len(got) == 5


def test_rating_triples_keep_repeats_and_drop_unknown_keys(spark, orders):
    triples = recommend.rating_triples(
        orders, frame(spark, "customers").dropDuplicates(), frame(spark, "bikes").dropDuplicates()
    )
    assert sorted(map(tuple, triples.collect())) == [
        (1, 1, 2), (1, 1, 4), (1, 2, 5), (2, 1, 1), (2, 5, 6), (3, 3, -7), (4, 4, 4),
    ]


def test_keys_beyond_int_are_refused(spark):
    rows = [(2**40, 1, 1.0), (1, 2, 2.0)]
    df = spark.createDataFrame(rows, "CustomerKey long, BikeKey long, Quantity double")
    with pytest.raises(Exception, match="CAST_OVERFLOW|range"):
        recommend.fit_recommender(df)


def test_factor_tables_take_long_keys(spark):
    rows = [(2**40, 1, 1.0), (1, 2**41, 2.0)]
    df = spark.createDataFrame(rows, "CustomerKey long, BikeKey long, Quantity double")
    model = recommend.fit_by_sums(df, recommend.als_settings())
    assert set(factors(model)[0]) == {1, 2**40} and set(factors(model)[1]) == {1, 2**41}


def test_factor_tables_are_saved_and_loaded(spark, ratings, tmp_path):
    """Either kind of recommender replaces the other at the same path."""
    by_sums = recommend.fit_recommender(ratings, method="sums")
    asked = ratings.select("CustomerKey").distinct()
    wanted = sorted(map(tuple, recommend.ranked(recommend.recommend_to(by_sums, asked, 3)).collect()))
    path = str(tmp_path / "model")
    save_model(recommend.fit_recommender(ratings), path)
    loaded = load_recommender(save_model(by_sums, path))
    assert loaded.rank == 10
    assert sorted(map(tuple, recommend.ranked(recommend.recommend_to(loaded, asked, 3)).collect())) == wanted
    assert type(load_recommender(save_model(recommend.fit_recommender(ratings), path))).__name__ == "ALSModel"


@pytest.mark.parametrize("row", [(1, 1, None), (1, 1, float("nan")), (None, 1, 1.0), (1, None, 1.0)])
@pytest.mark.parametrize("method", ["blocks", "sums"])
def test_missing_ratings_and_keys_are_refused(spark, method, row):
    schema = "CustomerKey int, BikeKey int, Quantity double"
    df = spark.createDataFrame([(1, 2, 3.0), (2, 1, 1.0), row], schema)
    with pytest.raises(Exception, match="(?i)null|nan"):
        recommend.fit_recommender(df, method=method)


def test_settings_follow_the_caller_alone(ratings):
    """The same settings, and so the same fit, whatever the number of rows and cores."""
    settings = recommend.als_settings()
    assert settings.getNumUserBlocks() == settings.getNumItemBlocks() == recommend.BLOCKS
    with pytest.MonkeyPatch.context() as patch:
        seen = []
        patch.setattr(type(settings), "fit", lambda self, df: seen.append(self))
        for df in (ratings, ratings.limit(5).repartition(40)):
            recommend.fit_recommender(df)
    assert [(a.getNumUserBlocks(), a.getNumItemBlocks(), a.getSeed()) for a in seen] == [(10, 10, 1)] * 2


def test_both_fits_are_about_as_good(ratings):
    rows = ratings.toPandas()

    def error(model):
        users, items = factors(model)
        scores = [users[u] @ items[i] for u, i in zip(rows.CustomerKey, rows.BikeKey)]
        return np.sqrt(np.mean((np.array(scores) - rows.Quantity) ** 2))

    by_blocks = recommend.fit_recommender(ratings)
    by_sums = recommend.fit_by_sums(ratings, recommend.als_settings())
    assert by_sums.rank == 10
    assert error(by_sums) < 1.15 * error(by_blocks)


def test_hot_key_gives_the_same_totals(spark):
    """A third of all lines on one customer and one bike."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("CustomerKey"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 90).alias("BikeKey"),
        (F.col("id") % 5 + 1).alias("Quantity"),
    )
    expected = rows.toPandas().groupby("CustomerKey").Quantity.sum().to_dict()
    got = {r.CustomerKey: r.TotalPurchase for r in segments.customer_totals(rows).collect()}
    assert got == expected
    known = stored(rows.select("CustomerKey").distinct(), "customers")
    bikes = stored(rows.select("BikeKey").distinct(), "bikes")
    assert recommend.rating_triples(rows, known, bikes).count() == 30_000


def test_optimum_is_judged_in_shares(spark, ratings, monkeypatch):
    """A hot customer's ratings are summed in shares, and a customer off the optimum is found."""
    from spokewise.operators.factors import FactorTables
    from spokewise.plans import star_queries

    hot = spark.createDataFrame([(39, b, 1.0 + b % 3) for b in range(1, 25)] * 20, ratings.schema)
    both = stored(ratings.union(hot), "ratings")
    model = recommend.fit_recommender(both)
    n = both.select("CustomerKey").distinct().count()
    monkeypatch.setattr(star_queries, "SHARE", 50)
    assert star_queries._off_optimum(both, model).collect() == [(n, 0)]
    moved = F.transform("features", lambda v: (v + F.when(F.col("id") == 39, 0.5).otherwise(0)).cast("float"))
    off = FactorTables(model.rank, model.userFactors.select("id", moved.alias("features")), model.itemFactors)
    assert star_queries._off_optimum(both, off).collect() == [(n, 1)]


@pytest.mark.parametrize("share", [1 << 18, 7])
def test_sums_in_blocks_and_shares(spark, ratings, monkeypatch, share):
    """The factors of plain alternating least squares; half-steps move rows by blocks, never by pairs."""
    from spokewise.operators import factors as sums

    moved, by_block = [], sums._by_block
    monkeypatch.setattr(sums, "_by_block", lambda rows, *a: moved.append(rows) or by_block(rows, *a))
    for name, value in {"SHARE": share, "CHUNK": 16, "BLOCKS": 3, "BLOCK_FACTORS": 400}.items():
        monkeypatch.setattr(sums, name, value)
    rows = ratings.toPandas()
    customers, bikes = sums.fit_factors(ratings, 4, 2, 0.01, 1)
    keys = stored(ratings.select("CustomerKey", "BikeKey").distinct(), "keys")
    given = {r.id: np.array(r.features) for r in sums._start(keys, 4, 1).collect()}
    for wanted, known in [("BikeKey", "CustomerKey"), ("CustomerKey", "BikeKey")] * 2:
        found = {}
        for key, mine in rows.groupby(wanted):
            y = np.array([given[k] for k in mine[known]])
            found[key] = np.linalg.solve(y.T @ y + 0.01 * len(mine) * np.eye(4), y.T @ mine.Quantity.to_numpy())
        before, given = given, found
    for table, expected in ((customers, given), (bikes, before)):
        got = {r.id: r.features for r in table.collect()}
        assert got.keys() == expected.keys()
        assert all(np.allclose(got[k], expected[k], rtol=1e-3, atol=1e-3) for k in got)
    blocks = max(3, -(-keys.count() // 100))
    packed = [m.count() for m in moved if m.columns == ["block", "seq", "blob"]]
    assert len(packed) == 8 and max(packed) <= blocks * (blocks + 2) < keys.count()


def test_broken_keys_are_refused(spark):
    """Vectors are kept by whole numbers, so that two keys never fall together."""
    df = spark.createDataFrame([(1.0, 1, 1.0), (1.5, 2, 2.0)], "CustomerKey double, BikeKey int, Quantity double")
    with pytest.raises(Exception, match="whole number"):
        recommend.fit_recommender(df, method="sums")
