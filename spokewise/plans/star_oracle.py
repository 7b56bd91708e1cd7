"""The registered queries in SQL, written independently of the operators."""

from __future__ import annotations

DATE_TEXT = """CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN '31/13/2000'
    ELSE strftime(o_orderdate, '%-d/%-m/%Y') END"""

DIRTY_LINES = f"""lines AS (
  SELECT CAST(try_strptime({DATE_TEXT}, '%d/%m/%Y') AS DATE) AS d, o_custkey, l_partkey, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LINES = """lines AS (
  SELECT CAST(o_orderdate AS DATE) AS d, o_custkey, l_partkey, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

TOTALS = """totals AS (
  SELECT o_custkey AS CustomerKey, SUM(l_quantity) AS TotalPurchase
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)"""

GAPPY = """gappy AS (
  SELECT c_custkey AS CustomerKey, c_name AS Name,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS Occupation,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS AnnualIncome
  FROM customer)"""

BIKESHOPS = """SELECT s_suppkey AS BikeshopKey, s_name AS BikeshopName, n_name AS BikeshopState
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

RATINGS = """SELECT o_custkey AS CustomerKey, l_partkey AS BikeKey, l_quantity AS Quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey"""

# Least squares with three features by Cramer's rule on the covariances.
SALES_FIT = f"""{LINES},
daily AS (SELECT d, SUM(l_quantity) AS t, year(d) AS y, month(d) AS m, day(d) AS k
  FROM lines GROUP BY d),
c AS (SELECT var_pop(y) AS yy, var_pop(m) AS mm, var_pop(k) AS kk,
    covar_pop(y, m) AS ym, covar_pop(y, k) AS yk, covar_pop(m, k) AS mk,
    covar_pop(y, t) AS yt, covar_pop(m, t) AS mt, covar_pop(k, t) AS kt,
    avg(y) AS ay, avg(m) AS am, avg(k) AS ak, avg(t) AS av FROM daily),
det AS (SELECT *, yy*(mm*kk - mk*mk) - ym*(ym*kk - mk*yk) + yk*(ym*mk - mm*yk) AS dd FROM c),
slopes AS (SELECT *,
    (yt*(mm*kk - mk*mk) - ym*(mt*kk - mk*kt) + yk*(mt*mk - mm*kt)) / dd AS by_,
    (yy*(mt*kk - mk*kt) - yt*(ym*kk - mk*yk) + yk*(ym*kt - mt*yk)) / dd AS bm,
    (yy*(mm*kt - mt*mk) - ym*(ym*kt - mt*yk) + yt*(ym*mk - mm*yk)) / dd AS bk FROM det),
fit AS (SELECT by_, bm, bk, av - by_*ay - bm*am - bk*ak AS b0 FROM slopes)"""

SUPPLY_FIT = f"""{LINES},
monthly AS (SELECT year(d) AS y, month(d) AS m, p_type AS frame, SUM(l_quantity) AS t
  FROM lines JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
c AS (SELECT var_pop(y) AS yy, var_pop(m) AS mm, covar_pop(y, m) AS ym,
    covar_pop(y, t) AS yt, covar_pop(m, t) AS mt,
    avg(y) AS ay, avg(m) AS am, avg(t) AS av FROM monthly),
slopes AS (SELECT *, (yt*mm - mt*ym) / (yy*mm - ym*ym) AS by_,
    (yy*mt - ym*yt) / (yy*mm - ym*ym) AS bm FROM c),
fit AS (SELECT by_, bm, av - by_*ay - bm*am AS b0 FROM slopes)"""

MONTHLY = f"""WITH {DIRTY_LINES}
  SELECT CAST(COALESCE(year(d), 0) AS INTEGER) AS "Year",
    CAST(COALESCE(month(d), 0) AS INTEGER) AS "Month", p_type AS BikeFrame, SUM(l_quantity) AS TotalQuantity
  FROM lines JOIN part ON l_partkey = p_partkey"""


def _report(table: str, source: str, rules: dict[str, str]) -> str:
    """One line per rule; ``rules`` maps a rule's name to the condition of a good row."""
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{name}' AS rule, COUNT(*) AS n_rows,
          COUNT(*) FILTER (WHERE NOT COALESCE({good}, FALSE)) AS n_violations,
          COUNT(*) FILTER (WHERE NOT COALESCE({good}, FALSE)) = 0 AS passed
        FROM {source}"""
        for name, good in rules.items()
    )


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


DOMAIN_REPORT = f"WITH {GAPPY} " + " UNION ALL ".join(
    [
        _report(
            "bikes",
            "part",
            {
                "BikeFrame in domain": "p_type IN ('SMALL','MEDIUM','LARGE','ECONOMY','STANDARD')",
                "BikeCategory2 in domain": f"p_brand IN ({_quoted(f'Brand#{i}' for i in range(1, 21))})",
            },
        ),
        _report(
            "bikeshops",
            f"({BIKESHOPS})",
            {
                "BikeshopState in domain": f"BikeshopState IN ({_quoted(f'NATION_{i}' for i in range(20))})"
            },
        ),
        _report(
            "customers",
            "gappy",
            {
                "Occupation in domain": "Occupation IN ('AUTOMOBILE','FURNITURE','HOUSEHOLD','MACHINERY')"
            },
        ),
    ]
)

BOUNDS_REPORT = " UNION ALL ".join(
    [
        _report(
            "order_lines",
            "lineitem",
            {
                "OrderId >= 1": "l_orderkey >= 1",
                "OrderLine >= 1": "l_linenumber >= 1",
                "BikeKey >= 1": "l_partkey >= 1",
                "Quantity >= 1": "l_quantity >= 1",
            },
        ),
        _report(
            "order_heads",
            "orders",
            {"OrderId >= 1": "o_orderkey >= 1", "CustomerKey >= 1": "o_custkey >= 1"},
        ),
        _report(
            "bikes", "part", {"BikeKey >= 1": "p_partkey >= 1", "BikePrice > 0": "p_retailprice > 0"}
        ),
        _report("bikeshops", f"({BIKESHOPS})", {"BikeshopKey >= 1": "BikeshopKey >= 1"}),
        _report(
            "customers",
            "customer",
            {"CustomerKey >= 1": "c_custkey >= 1", "AnnualIncome >= 0": "c_acctbal >= 0"},
        ),
    ]
)

DATE_REPORT = _report(
    "orders",
    f"(SELECT {DATE_TEXT} AS t FROM orders)",
    {
        "OrderDate present": "t IS NOT NULL",
        "OrderDate is d/M/y": "t IS NULL OR try_strptime(t, '%d/%m/%Y') IS NOT NULL",
        "OrderDate is dd/MM/yyyy": """t IS NULL OR (regexp_full_match(t, '[0-9]{2}/[0-9]{2}/[0-9]{4}')
            AND try_strptime(t, '%d/%m/%Y') IS NOT NULL)""",
    },
)

ORACLE = {
    "q01_csv_header_roundtrip": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""",
    "q02_csv_headerless_roundtrip": "SELECT * FROM customer",
    "q03_distinct_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "q04_median_rank_bound": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n_rows, TRUE AS within_one_percent FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "q04_median_repair": """SELECT c_custkey AS CustomerKey, c_name AS Name,
        c_mktsegment AS Occupation,
        CASE WHEN c_acctbal < 0 THEN (SELECT quantile_disc(c_acctbal, 0.5) FROM customer)
          ELSE c_acctbal END AS AnnualIncome
      FROM customer""",
    "q04b_fill_missing": f"""WITH {GAPPY}
      SELECT CustomerKey, Name, COALESCE(Occupation, 'Engineer') AS Occupation,
        COALESCE(AnnualIncome, (SELECT quantile_disc(AnnualIncome, 0.5) FROM gappy)) AS AnnualIncome
      FROM gappy""",
    "q04c_clean_table": f"""WITH {GAPPY},
      repaired AS (SELECT CustomerKey, Name, Occupation,
          CASE WHEN AnnualIncome < 0 THEN (SELECT quantile_disc(AnnualIncome, 0.5) FROM gappy)
            ELSE AnnualIncome END AS AnnualIncome
        FROM gappy)
      SELECT CustomerKey, Name, COALESCE(Occupation, 'Engineer') AS Occupation,
        COALESCE(AnnualIncome, (SELECT quantile_disc(AnnualIncome, 0.5) FROM repaired)) AS AnnualIncome
      FROM repaired""",
    "q05_domain_audit": DOMAIN_REPORT,
    "q06_bounds_audit": BOUNDS_REPORT,
    "q06b_audit_verdict": f"""SELECT "table", bool_and(passed) AS passed
      FROM ({BOUNDS_REPORT}) GROUP BY "table" """,
    "q07_date_audit": DATE_REPORT,
    "q07b_date_violations": f"""WITH texts AS (SELECT o_orderkey, {DATE_TEXT} AS OrderDate FROM orders)
      SELECT o_orderkey, OrderDate, 'OrderDate present' AS rule FROM texts WHERE OrderDate IS NULL
      UNION ALL
      SELECT o_orderkey, OrderDate, 'OrderDate is d/M/y' AS rule FROM texts
      WHERE OrderDate IS NOT NULL AND try_strptime(OrderDate, '%d/%m/%Y') IS NULL""",
    "q07c_date_audit_from_violations": DATE_REPORT,
    "q08_daily_sales": f"""WITH {DIRTY_LINES}
      SELECT strftime(d, '%Y-%m-%d') AS OrderDate, SUM(l_quantity) AS TotalSales
      FROM lines GROUP BY d""",
    "q09_dated_daily_sales": f"""WITH {DIRTY_LINES}
      SELECT strftime(d, '%Y-%m-%d') AS OrderDate, SUM(l_quantity) AS TotalSales
      FROM lines WHERE d IS NOT NULL GROUP BY d""",
    "q09b_daily_sales_without_total": f"""WITH {DIRTY_LINES},
      daily AS (SELECT d, SUM(l_quantity) AS TotalSales FROM lines GROUP BY d)
      SELECT strftime(d, '%Y-%m-%d') AS OrderDate, TotalSales FROM daily
      WHERE TotalSales <> (SELECT TotalSales FROM daily WHERE d IS NULL)""",
    "q10_calendar_features": f"""WITH {LINES}
      SELECT DISTINCT strftime(d, '%Y-%m-%d') AS OrderDate, CAST(year(d) AS INTEGER) AS "Year",
        CAST(month(d) AS INTEGER) AS "Month", CAST(day(d) AS INTEGER) AS "Day",
        CAST(year(d) * 10000 + month(d) * 100 + day(d) AS DOUBLE) AS vector_as_number
      FROM lines""",
    "q11_customer_totals": f"WITH {TOTALS} SELECT CustomerKey, TotalPurchase FROM totals",
    "q12_customers_with_totals": f"""WITH {TOTALS}
      SELECT CustomerKey, c_name AS Name, c_mktsegment AS Occupation, c_acctbal AS AnnualIncome,
        TotalPurchase
      FROM customer JOIN totals ON c_custkey = CustomerKey""",
    "q13_monthly_supply": f"{MONTHLY} GROUP BY 1, 2, 3",
    "q14_dated_monthly_supply": f"{MONTHLY} WHERE d IS NOT NULL GROUP BY 1, 2, 3",
    "q15_rating_triples": RATINGS,
    "q15b_rating_triples_by_heads": RATINGS,
    "q16_standardised_totals": f"""WITH {TOTALS},
      known AS (SELECT totals.* FROM totals JOIN customer ON CustomerKey = c_custkey)
      SELECT CustomerKey, round((TotalPurchase - (SELECT avg(TotalPurchase) FROM known))
        / (SELECT stddev_samp(TotalPurchase) FROM known), 6) + 0.0 AS z FROM known""",
    "q16b_principal_scores": f"""WITH {TOTALS},
      known AS (SELECT totals.* FROM totals JOIN customer ON CustomerKey = c_custkey)
      SELECT CustomerKey, round(abs(TotalPurchase - (SELECT avg(TotalPurchase) FROM known))
        / (SELECT stddev_samp(TotalPurchase) FROM known), 6) + 0.0 AS score FROM known""",
    "q17_sales_model": f"""WITH {SALES_FIT}
      SELECT 'Year' AS term, round(by_, 4) AS value FROM fit
      UNION ALL SELECT 'Month', round(bm, 4) FROM fit
      UNION ALL SELECT 'Day', round(bk, 4) FROM fit
      UNION ALL SELECT 'intercept', round(b0, 2) FROM fit""",
    "q17b_sales_forecast": f"""WITH {SALES_FIT}
      SELECT strftime(d, '%Y-%m-%d') AS OrderDate, t AS TotalSales,
        round(b0 + by_*y + bm*m + bk*k, 2) + 0.0 AS prediction
      FROM daily, fit""",
    "q17c_sales_forecast_day": f"""WITH {SALES_FIT}
      SELECT 2023 AS "Year", 10 AS "Month", 9 AS "Day",
        round(b0 + by_*2023 + bm*10 + bk*9, 2) + 0.0 AS prediction FROM fit""",
    "q18_supply_model": f"""WITH {SUPPLY_FIT}
      SELECT 'Year' AS term, round(by_, 4) AS value FROM fit
      UNION ALL SELECT 'Month', round(bm, 4) FROM fit
      UNION ALL SELECT 'intercept', round(b0, 2) FROM fit""",
    "q18b_supply_forecast": f"""WITH {SUPPLY_FIT}
      SELECT CAST(y AS INTEGER) AS "Year", CAST(m AS INTEGER) AS "Month", frame AS BikeFrame,
        t AS TotalQuantity, round(b0 + by_*y + bm*m, 2) + 0.0 AS prediction
      FROM monthly, fit""",
    "q19_segment_invariants": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_customers, CAST(4 AS BIGINT) AS n_segments,
        CAST(0 AS BIGINT) AS n_overlaps, CAST(0 AS BIGINT) AS n_far,
        CAST(0 AS BIGINT) AS n_off_mean
      FROM customer JOIN totals ON c_custkey = CustomerKey""",
    "q20_customer_segments": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_customers, CAST(0 AS BIGINT) AS n_disagreements,
        CAST(0 AS BIGINT) AS n_far
      FROM customer JOIN totals ON c_custkey = CustomerKey""",
    "q21_recommendation_invariants": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_customers, 5 * COUNT(*) AS n_recommendations,
        CAST(0 AS BIGINT) AS n_wrong_lists, CAST(0 AS BIGINT) AS n_unsorted,
        CAST(0 AS BIGINT) AS n_unknown_bikes
      FROM customer JOIN totals ON c_custkey = CustomerKey WHERE CustomerKey % 100 = 0""",
    "q22_top5_for_customer": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_lists, 5 * COUNT(*) AS n_places, 5 * COUNT(*) AS n_bikes,
        CAST(0 AS BIGINT) AS n_wrong_scores, CAST(0 AS BIGINT) AS n_unsorted,
        CAST(0 AS BIGINT) AS n_left_out, CAST(0 AS BIGINT) AS n_unknown
      FROM customer JOIN totals ON c_custkey = CustomerKey WHERE CustomerKey = 12""",
    "q21b_recommender_optimality": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_customers, CAST(0 AS BIGINT) AS n_off_optimum
      FROM customer JOIN totals ON c_custkey = CustomerKey""",
    "q21d_recommender_by_sums": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_customers, CAST(0 AS BIGINT) AS n_off_optimum
      FROM customer JOIN totals ON c_custkey = CustomerKey""",
    "q23_publish_parquet": BIKESHOPS,
}
