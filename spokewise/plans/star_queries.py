"""Registered queries: every operator run over the whole tables of the star schema.

Dates leave as ISO text and fitted numbers rounded, so that results compare across engines.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from spokewise.functions.dates import LENIENT_DATE, STRICT_DATE, calendar_features
from spokewise.functions.rules import AtLeast, DateFormat, GreaterThan, InSet, Present
from spokewise.functions.statistics import column_medians
from spokewise.operators import audit, cleanse, recommend, sales, segments, supply
from spokewise.plans import star
from spokewise.schemas import TableSpec
from spokewise.session import fresh_path, stored
from spokewise.sinks.models import save_model
from spokewise.sinks.tables import write_csv, write_parquet
from spokewise.sources import models as saved
from spokewise.sources.tables import read_csv, read_headerless_csv, read_parquet, rows_as_table


# The day and the customer that scoring asks about.
ASKED_DAY = (2023, 10, 9)
ASKED_CUSTOMER = 12
UNKNOWN_CUSTOMER = 2_000_000_000
#: Ratings of one customer that one task sums up, about.
SHARE = 1_000_000


def _rounded(column, digits: int):
    return (F.round(column, digits) + F.lit(0.0)).alias


def _iso(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


# -- sources and sinks -------------------------------------------------------------------------

ORDER_SCHEMA = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderdate", DateType()),
        StructField("o_orderpriority", StringType()),
    ]
)
CUSTOMER_SCHEMA = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()),
        StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)


def csv_header_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders-csv")
    orders = star.table(spark, sf_dir, "orders")
    write_csv(orders.withColumn("o_orderdate", F.to_date("o_orderdate")), path, header=True)
    back = read_csv(spark, path, ORDER_SCHEMA)
    return back.withColumn("o_orderdate", _iso("o_orderdate"))


def csv_headerless_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "customer-csv")
    write_csv(star.table(spark, sf_dir, "customer"), path)
    return read_headerless_csv(spark, path, CUSTOMER_SCHEMA)


def publish_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "bikeshops")
    write_parquet(star.bikeshops(spark, sf_dir), path)
    return read_parquet(spark, path)


# -- cleaning ----------------------------------------------------------------------------------


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return cleanse.drop_duplicate_rows(lines)


def median_rank_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default median of four columns: how far its rank may lie from the middle."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = star.table(spark, sf_dir, "lineitem").select(*columns)
    medians = column_medians(lines, columns)
    counts = lines.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n_rows"),
                (F.count_if(F.col(c) < medians[c]) / F.count(c)).alias("before"),
                (F.count_if(F.col(c) <= medians[c]) / F.count(c)).alias("upto"),
            ).alias(c)
            for c in columns
        ]
    )
    return counts.select(F.inline(F.array(*columns))).select(
        "column_name",
        "n_rows",
        ((F.col("before") <= 0.51) & (F.col("upto") >= 0.49)).alias("within_one_percent"),
    )


def median_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = star.customers(spark, sf_dir)
    medians = column_medians(customers, ["AnnualIncome"], relative_error=0)
    return cleanse.repair_negatives(customers, medians)


def _gappy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a missing occupation in one segment and a missing income in another."""
    known = F.col("Occupation") != "MACHINERY"
    return star.customers(spark, sf_dir).withColumns(
        {
            "AnnualIncome": F.when(known, F.col("AnnualIncome")),
            "Occupation": F.nullif(F.col("Occupation"), F.lit("BUILDING")),
        }
    )


def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _gappy_customers(spark, sf_dir)
    medians = column_medians(customers, ["AnnualIncome"], relative_error=0)
    return cleanse.fill_missing(customers, {"Occupation": "Engineer"}, medians)


CUSTOMER_SPEC = TableSpec(
    name="customers",
    schema=StructType(
        [
            StructField("CustomerKey", LongType()),
            StructField("Name", StringType()),
            StructField("Occupation", StringType()),
            StructField("AnnualIncome", DoubleType()),
        ]
    ),
    rules=(AtLeast("CustomerKey", 1), AtLeast("AnnualIncome", 0)),
    defaults={"Occupation": "Engineer"},
    median_repair=("AnnualIncome",),
    median_fill=("AnnualIncome",),
)


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row twice, with gaps and negatives, through the whole cleaning."""
    customers = _gappy_customers(spark, sf_dir)
    return cleanse.clean(customers.unionAll(customers), CUSTOMER_SPEC, relative_error=0)


# -- audit -------------------------------------------------------------------------------------


def domain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = [f"Brand#{i}" for i in range(1, 21)]
    states = [f"NATION_{i}" for i in range(20)]
    bikes = [
        InSet("BikeFrame", ("SMALL", "MEDIUM", "LARGE", "ECONOMY", "STANDARD")),
        InSet("BikeCategory2", brands),
    ]
    occupations = ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    return audit.combine(
        [
            audit.audit(star.bikes(spark, sf_dir), bikes, "bikes"),
            audit.audit(
                star.bikeshops(spark, sf_dir), [InSet("BikeshopState", states)], "bikeshops"
            ),
            audit.audit(
                _gappy_customers(spark, sf_dir), [InSet("Occupation", occupations)], "customers"
            ),
        ]
    )


def bounds_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.bare_lines(spark, sf_dir)
    line_rules = [AtLeast(c, 1) for c in ("OrderId", "OrderLine", "BikeKey", "Quantity")]
    head_rules = [AtLeast(c, 1) for c in ("OrderId", "CustomerKey")]
    bike_rules = [AtLeast("BikeKey", 1), GreaterThan("BikePrice", 0)]
    return audit.combine(
        [
            audit.audit(lines, line_rules, "order_lines"),
            audit.audit(star.order_heads(spark, sf_dir), head_rules, "order_heads"),
            audit.audit(star.bikes(spark, sf_dir), bike_rules, "bikes"),
            audit.audit(star.bikeshops(spark, sf_dir), [AtLeast("BikeshopKey", 1)], "bikeshops"),
            audit.audit(star.customers(spark, sf_dir), CUSTOMER_SPEC.rules, "customers"),
        ]
    )


def audit_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.verdict(bounds_audit(spark, sf_dir))


def _date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.table(spark, sf_dir, "orders").select(
        "o_orderkey", star.date_text().alias("OrderDate")
    )


DATE_RULES = (
    Present("OrderDate"),
    DateFormat("OrderDate", LENIENT_DATE),
    DateFormat("OrderDate", STRICT_DATE),
)


def date_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_date_texts(spark, sf_dir), DATE_RULES, "orders")


def date_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.per_rule(audit.violations(_date_texts(spark, sf_dir), DATE_RULES[:2]))


def date_audit_from_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report counted from the rows set aside."""
    texts = stored(_date_texts(spark, sf_dir), "order-dates")
    broken = stored(audit.violations(texts, DATE_RULES), "quarantine")
    return audit.audit_from_violations(broken, texts, DATE_RULES, "orders")


# -- aggregates and joins ----------------------------------------------------------------------


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = sales.daily_sales(star.order_totals(spark, sf_dir, dirty=True), LENIENT_DATE)
    return daily.orderBy("OrderDate").select(_iso("OrderDate"), "TotalSales")


def dated_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = sales.daily_sales(star.order_totals(spark, sf_dir, dirty=True), LENIENT_DATE)
    usable = sales.drop_unusable(daily, ["OrderDate"], "TotalSales")
    return usable.select(_iso("OrderDate"), "TotalSales")


def daily_sales_without_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group without a date removed by the value of its total, known from the table."""
    totals = star.order_totals(spark, sf_dir, dirty=True)
    daily = stored(sales.daily_sales(totals, LENIENT_DATE), "daily-sales")
    undated = daily.where(F.col("OrderDate").isNull()).agg(F.max("TotalSales")).scalar()
    usable = daily.where(F.col("TotalSales").isNotNull() & ~F.col("TotalSales").eqNullSafe(undated))
    return usable.select(_iso("OrderDate"), "TotalSales")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = sales.sales_features(sales.daily_sales(star.order_totals(spark, sf_dir)))
    vector = vector_to_array("features")
    return daily.select(
        _iso("OrderDate"),
        "Year",
        "Month",
        "Day",
        (vector[0] * 10000 + vector[1] * 100 + vector[2]).alias("vector_as_number"),
    )


def customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.customer_totals(star.order_totals(spark, sf_dir))


def customers_with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.customers_with_totals(
        star.customers(spark, sf_dir), customer_totals(spark, sf_dir)
    )


def _dirty_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supply.monthly_supply(
        star.order_lines(spark, sf_dir, dirty=True), star.bikes(spark, sf_dir), LENIENT_DATE
    )


def monthly_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group without a date leaves as year 0, month 0."""
    return _dirty_monthly(spark, sf_dir).fillna(0, subset=list(supply.MONTHS))


def dated_monthly_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.drop_unusable(_dirty_monthly(spark, sf_dir), supply.MONTHS, "TotalQuantity")


def rating_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.rating_triples(
        star.order_lines(spark, sf_dir), star.customers(spark, sf_dir), star.bikes(spark, sf_dir)
    )


# -- features and models -----------------------------------------------------------------------


def _stored_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = customers_with_totals(spark, sf_dir).select("CustomerKey", "TotalPurchase")
    return stored(totals, "customer-totals")


def standardised_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _stored_totals(spark, sf_dir)
    scored = segments.fit_features(totals).transform(totals)
    z = vector_to_array("scaledFeatures")[0]
    return scored.select("CustomerKey", _rounded(z, 6)("z"))


def principal_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _stored_totals(spark, sf_dir)
    scored = segments.fit_features(totals).transform(totals)
    score = F.abs(vector_to_array("pcaFeatures")[0])
    return scored.select("CustomerKey", _rounded(score, 6)("score"))


def _stored_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(sales.daily_sales(star.order_totals(spark, sf_dir)), "daily-sales")


def _sales_model(spark: SparkSession, daily: DataFrame):
    model = sales.fit_forecast(sales.sales_features(daily), "TotalSales")
    return saved.load_forecast(save_model(model, fresh_path(spark, "sales-forecast")))


def _terms(spark: SparkSession, model, names) -> DataFrame:
    rows = [(n, round(float(b), 4)) for n, b in zip(names, model.coefficients)]
    rows.append(("intercept", round(float(model.intercept), 2)))
    return rows_as_table(spark, rows, "term string, value double")


def sales_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _sales_model(spark, _stored_daily(spark, sf_dir))
    return _terms(spark, model, sales.CALENDAR)


def sales_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast of every day of the table by the saved and loaded model."""
    daily = _stored_daily(spark, sf_dir)
    days = calendar_features(daily.dropna(subset=["OrderDate"]))
    scored = sales.forecast_sales(_sales_model(spark, daily), days)
    return scored.select(
        _iso("OrderDate"), "TotalSales", _rounded(F.col("prediction"), 2)("prediction")
    )


def sales_forecast_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast of one day given as a literal row."""
    model = _sales_model(spark, _stored_daily(spark, sf_dir))
    day = rows_as_table(spark, [ASKED_DAY], "Year int, Month int, Day int")
    scored = sales.forecast_sales(model, day)
    return scored.select(*sales.CALENDAR, _rounded(F.col("prediction"), 2)("prediction"))


def _stored_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = supply.monthly_supply(star.order_lines(spark, sf_dir), star.bikes(spark, sf_dir))
    return stored(monthly, "monthly-supply")


def _supply_model(spark: SparkSession, monthly: DataFrame):
    model = sales.fit_forecast(supply.supply_features(monthly), "TotalQuantity")
    return saved.load_forecast(save_model(model, fresh_path(spark, "supply-forecast")))


def supply_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _supply_model(spark, _stored_monthly(spark, sf_dir))
    return _terms(spark, model, supply.MONTHS)


def supply_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _stored_monthly(spark, sf_dir)
    usable = sales.drop_unusable(monthly, supply.MONTHS, "TotalQuantity")
    scored = supply.forecast_supply(_supply_model(spark, monthly), usable)
    return scored.select(
        "Year",
        "Month",
        "BikeFrame",
        "TotalQuantity",
        _rounded(F.col("prediction"), 2)("prediction"),
    )


def _off_centre(assigned: DataFrame, centres: list[float]) -> list:
    """Customers whose centre is not the nearest, and centres that are not their customers' mean."""
    distances = [F.abs(F.col("TotalPurchase") - c) for c in centres]
    chosen = F.element_at(F.array(*distances), F.col("prediction") + 1)
    gap = F.element_at(F.array(*map(F.lit, centres)), F.col("prediction") + 1)
    means = (
        assigned.groupBy("prediction")
        .agg(F.avg("TotalPurchase").alias("mean"), F.first(gap).alias("centre"))
        .agg(F.count_if(F.abs(F.col("mean") - F.col("centre")) > 1e-6 * F.abs(F.col("centre"))))
    )
    far = F.count_if(chosen > F.least(*distances) + 1e-9)
    return [far.alias("n_far"), means.scalar().alias("n_off_mean")]


def _centres(model) -> list[float]:
    return [float(c[0]) for c in model.clusterCenters()]


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's segment by the loaded segmentation and by the loaded clusters: the same."""
    totals = _stored_totals(spark, sf_dir)
    fitted = segments.fit_segmentation(totals)
    path = save_model(fitted, fresh_path(spark, "segmentation"))
    clusters = saved.load_segments(save_model(fitted.stages[-1], fresh_path(spark, "clusters")))
    whole = segments.assign_segments(saved.load_segmentation(path), totals)
    alone = clusters.transform(segments.assemble_totals(totals)).select(
        "CustomerKey", F.col("prediction").alias("again")
    )
    both = stored(whole.join(alone, "CustomerKey"), "segments")
    return both.agg(
        F.count("*").alias("n_customers"),
        F.count_if(F.col("prediction") != F.col("again")).alias("n_disagreements"),
        _off_centre(both, _centres(clusters))[0],
    )


def segment_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four clusters: intervals that do not overlap, nearest centres, centres at the means."""
    totals = _stored_totals(spark, sf_dir)
    model = segments.fit_segmentation(totals)
    assigned = stored(segments.assign_segments(model, totals), "segments")
    ranges = assigned.groupBy("prediction").agg(
        F.min("TotalPurchase").alias("low"),
        F.max("TotalPurchase").alias("high"),
        F.count("*").alias("n"),
    )
    far, off_mean = _off_centre(assigned, _centres(model.stages[-1]))
    ordered = ranges.agg(
        F.sum("n").alias("n_customers"),
        F.count("*").alias("n_segments"),
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("r"),
    )
    neighbours = F.arrays_zip(
        F.slice("r.high", 1, F.size("r") - 1).alias("high"),
        F.slice("r.low", 2, F.size("r") - 1).alias("low"),
    )
    overlapping = F.filter(neighbours, lambda x: x["high"] >= x["low"])
    return ordered.select(
        "n_customers",
        "n_segments",
        F.size(overlapping).cast("long").alias("n_overlaps"),
        assigned.agg(far).scalar().alias("n_far"),
        off_mean,
    )


def _stored_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(star.ratings(spark, sf_dir), "ratings")


def top5_for_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best bikes for one known and one unknown customer, by the loaded recommender.

    One row of counts: lists, places, distinct bikes, places whose score is not the product of the
    factors, places out of order, bikes with a better score that were left out, and places of the
    unknown customer.
    """
    ratings = _stored_ratings(spark, sf_dir)
    fitted = recommend.fit_recommender(ratings)
    model = saved.load_recommender(save_model(fitted, fresh_path(spark, "recommender")))
    known = star.customers(spark, sf_dir).where(F.col("CustomerKey") == F.lit(ASKED_CUSTOMER))
    unknown = rows_as_table(spark, [(UNKNOWN_CUSTOMER,)], "CustomerKey long")
    asked = known.select(F.col("CustomerKey").cast("long")).union(unknown)
    lists = stored(recommend.recommend_to(model, asked, 5), "lists")
    mine = model.userFactors.where(F.col("id") == F.lit(ASKED_CUSTOMER)).select("features")
    products = F.zip_with("features", "mine", lambda a, b: a.cast("double") * b.cast("double"))
    scored = model.itemFactors.withColumn("mine", mine.scalar()).select(
        F.col("id").alias("BikeKey"),
        F.aggregate(products, F.lit(0.0), lambda total, v: total + v).alias("product"),
    )
    places = recommend.ranked(lists)
    judged = places.join(scored, "BikeKey", "left")
    wrong = ~(F.abs(F.col("score") - F.col("product")) <= 1e-4 * (1 + F.abs(F.col("product"))))
    last = places.agg(F.min("score")).scalar()
    better = scored.where(F.col("product") > last + 1e-4).join(places, "BikeKey", "left_anti")
    scores = F.col("recommendations.rating")
    return judged.agg(
        lists.agg(F.count("*")).scalar().alias("n_lists"),
        F.count("*").alias("n_places"),
        F.count_distinct("BikeKey").alias("n_bikes"),
        F.count_if(F.coalesce(wrong, F.lit(True))).alias("n_wrong_scores"),
        lists.agg(F.count_if(F.sort_array(scores, asc=False) != scores)).scalar().alias("n_unsorted"),
        better.agg(F.count("*")).scalar().alias("n_left_out"),
        F.count_if(F.col("CustomerKey") == UNKNOWN_CUSTOMER).alias("n_unknown"),
    )


def recommendation_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that are asked about get five distinct known bikes with falling scores.

    Asked are those whose key divides by 100; bikes for all customers would cost customers x bikes.
    """
    ratings = _stored_ratings(spark, sf_dir)
    asked = star.customers(spark, sf_dir).where(F.col("CustomerKey") % 100 == 0)
    lists = stored(recommend.recommend_to(recommend.fit_recommender(ratings), asked, 5), "lists")
    known = ratings.select("BikeKey").distinct()
    strangers = recommend.ranked(lists).join(known, "BikeKey", "left_anti")
    scores = F.col("recommendations.rating")
    items = F.col("recommendations.BikeKey")
    return lists.agg(
        F.count("*").alias("n_customers"),
        F.sum(F.size("recommendations")).alias("n_recommendations"),
        F.count_if(F.size(F.array_distinct(items)) != 5).alias("n_wrong_lists"),
        F.count_if(F.sort_array(scores, asc=False) != scores).alias("n_unsorted"),
        strangers.agg(F.count("*")).scalar().alias("n_unknown_bikes"),
    )


def recommender_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _stored_ratings(spark, sf_dir)
    return _off_optimum(ratings, recommend.fit_recommender(ratings))


def recommender_by_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check for the fit that serves keys too hot for a factor block."""
    ratings = _stored_ratings(spark, sf_dir)
    return _off_optimum(ratings, recommend.fit_recommender(ratings, method="sums"))


def _off_optimum(ratings: DataFrame, model) -> DataFrame:
    """Customers whose factors do not solve their regularised least-squares problem: none.

    The last half-step of the fit solves for the customers, so at each customer the gradient
    sum((x.y - r) y) + lambda n x vanishes up to the precision of stored factors.
    """
    users = model.userFactors.select(F.col("id").alias("CustomerKey"), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("BikeKey"), F.col("features").alias("y"))
    # bikes before customers: the sums run where the second join leaves the rows, so a rating moves with
    # its bike's factors once and no sums move but one a share; hot customers have several shares
    counts = ratings.groupBy("CustomerKey").agg(F.ceil(F.count("*") / SHARE).alias("shares"))
    hot = stored(counts.where("shares > 1"), "hot-customers")
    share = F.coalesce(F.pmod(F.xxhash64("BikeKey", "Quantity"), "shares"), F.lit(0)).alias("share")
    dealt = ratings.join(hot, "CustomerKey", "left").select("CustomerKey", "BikeKey", "Quantity", share)
    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("shares", F.lit(1)) - 1)).alias("share")
    asked = users.join(hot, "CustomerKey", "left").select("CustomerKey", "x", shares)
    pairs = dealt.join(items, "BikeKey").drop("BikeKey").join(asked, ["CustomerKey", "share"])
    pairs = pairs.withColumns({c: F.col(c).cast("array<double>") for c in ("x", "y")})
    product = F.aggregate(
        F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v
    )
    pairs = pairs.withColumn("error", product - F.col("Quantity"))
    places = range(model.rank)
    per_share = pairs.groupBy("CustomerKey", "share").agg(
        *[
            F.sum(F.col("error") * F.col("y")[k] + 0.01 * F.col("x")[k]).alias(f"gradient_{k}")
            for k in places
        ],
        *[F.sum(F.abs(F.col("Quantity") * F.col("y")[k])).alias(f"scale_{k}") for k in places],
    )
    sums = [f"{name}_{k}" for name in ("gradient", "scale") for k in places]
    per_user = per_share.groupBy("CustomerKey").agg(*[F.sum(c).alias(c) for c in sums])
    gradient = F.greatest(*[F.abs(F.col(f"gradient_{k}")) for k in places])
    scale = F.greatest(*[F.col(f"scale_{k}") for k in places])
    return per_user.agg(
        F.count("*").alias("n_customers"),
        F.count_if(gradient > 1e-3 * scale).alias("n_off_optimum"),
    )


QUERIES = {
    "q01_csv_header_roundtrip": csv_header_roundtrip,
    "q02_csv_headerless_roundtrip": csv_headerless_roundtrip,
    "q03_distinct_rows": distinct_rows,
    "q04_median_rank_bound": median_rank_bound,
    "q04_median_repair": median_repair,
    "q04b_fill_missing": fill_missing,
    "q04c_clean_table": clean_table,
    "q05_domain_audit": domain_audit,
    "q06_bounds_audit": bounds_audit,
    "q06b_audit_verdict": audit_verdict,
    "q07_date_audit": date_audit,
    "q07b_date_violations": date_violations,
    "q07c_date_audit_from_violations": date_audit_from_violations,
    "q08_daily_sales": daily_sales,
    "q09_dated_daily_sales": dated_daily_sales,
    "q09b_daily_sales_without_total": daily_sales_without_total,
    "q10_calendar_features": calendar,
    "q11_customer_totals": customer_totals,
    "q12_customers_with_totals": customers_with_totals,
    "q13_monthly_supply": monthly_supply,
    "q14_dated_monthly_supply": dated_monthly_supply,
    "q15_rating_triples": rating_triples,
    "q15b_rating_triples_by_heads": star.ratings,
    "q16_standardised_totals": standardised_totals,
    "q16b_principal_scores": principal_scores,
    "q17_sales_model": sales_model,
    "q17b_sales_forecast": sales_forecast,
    "q17c_sales_forecast_day": sales_forecast_day,
    "q18_supply_model": supply_model,
    "q18b_supply_forecast": supply_forecast,
    "q19_segment_invariants": segment_invariants,
    "q20_customer_segments": customer_segments,
    "q21_recommendation_invariants": recommendation_invariants,
    "q21b_recommender_optimality": recommender_optimality,
    "q21d_recommender_by_sums": recommender_by_sums,
    "q22_top5_for_customer": top5_for_customer,
    "q23_publish_parquet": publish_parquet,
}
