"""SQL of the queries in ``further_queries``, written independently of the operators."""

from __future__ import annotations

from spokewise.plans.star_oracle import LINES, RATINGS, TOTALS

TEXTS = """texts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
    o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
  FROM orders)"""

# What a text must look like to be read as a type.
FORMS = {
    "boolean": "lower({v}) IN ('true', 'false')",
    "bigint": "regexp_full_match({v}, '[+-]?[0-9]+')",
    "double": "TRY_CAST({v} AS DOUBLE) IS NOT NULL",
    "date": "regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')",
    "timestamp_ntz": "regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')",
    "string": "TRUE",
}
CHOSEN = {
    "o_orderkey": "bigint",
    "o_custkey": "string",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "date",
    "o_orderpriority": "string",
}
TYPE_LOSSES = f"WITH {TEXTS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS type, COUNT({c}) AS n_values,
      COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({form.format(v=c)})) AS n_lost, '{chosen}' AS chosen FROM texts"""
    for c, chosen in CHOSEN.items()
    for t, form in FORMS.items()
)

MONTHLY_BY_FRAME = f"""{LINES},
monthly AS (SELECT year(d) AS y, month(d) AS m, p_type AS frame, SUM(l_quantity) AS t
  FROM lines JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
c AS (SELECT frame, COUNT(*) AS n, var_pop(y) AS yy, var_pop(m) AS mm, covar_pop(y, m) AS ym,
    covar_pop(y, t) AS yt, covar_pop(m, t) AS mt, avg(y) AS ay, avg(m) AS am, avg(t) AS av
  FROM monthly GROUP BY frame),
slopes AS (SELECT *, (yt*mm - mt*ym) / (yy*mm - ym*ym) AS by_, (yy*mt - ym*yt) / (yy*mm - ym*ym) AS bm FROM c),
fit AS (SELECT frame, n, by_, bm, av - by_*ay - bm*am AS b0 FROM slopes)"""

ORACLE = {
    "q01b_inferred_csv": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
        'struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:date,o_orderpriority:string>' AS types
      FROM orders""",
    "q01c_type_losses": TYPE_LOSSES,
    "q01d_marked_lines": """SELECT
        CASE WHEN ok THEN o_orderkey END AS o_orderkey, CASE WHEN ok THEN o_custkey END AS o_custkey,
        CASE WHEN ok THEN o_orderstatus END AS o_orderstatus, CASE WHEN ok THEN o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderkey % 97 = 0 THEN 'cut off at ' || o_orderkey
          WHEN o_orderkey % 89 = 0 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'and more')
          WHEN o_orderkey % 83 = 0 THEN concat_ws(',', o_orderkey, 'c' || o_custkey, o_orderstatus, o_orderpriority)
        END AS line
      FROM (SELECT *, o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 83 <> 0 AS ok FROM orders)""",
    "q02b_unnamed_rows": """SELECT a._1, a._2, n_name
      FROM (VALUES ('first', 0::BIGINT), ('second', 7), ('third', 19), ('nowhere', -1)) AS a(_1, _2)
        JOIN nation ON a._2 = n_nationkey""",
    "q03b_distinct_by_key": """WITH o AS (
        SELECT CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS CustomerKey, o_orderpriority,
          CAST(year(o_orderdate) AS INTEGER) AS "Year", o_orderkey AS OrderId, o_totalprice AS Total FROM orders),
      n AS (SELECT *, row_number() OVER (PARTITION BY CustomerKey, o_orderpriority ORDER BY "Year", OrderId) AS place FROM o)
      SELECT CustomerKey, o_orderpriority, "Year", OrderId, Total FROM n WHERE place = 1""",
    "q03c_latest_by_key": """WITH l AS (
        SELECT l_partkey AS BikeKey, strftime(l_shipdate, '%Y-%m-%d') AS ShipDate, l_orderkey AS OrderId,
          l_linenumber AS OrderLine FROM lineitem),
      n AS (SELECT *, row_number() OVER (PARTITION BY BikeKey ORDER BY ShipDate DESC, OrderId DESC, OrderLine DESC) AS place FROM l)
      SELECT BikeKey, ShipDate, OrderId, OrderLine FROM n WHERE place = 1""",
    "q04d_merged_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n_rows, TRUE AS within_one_percent FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "q08b_order_of_files": f"""WITH {LINES},
      daily AS (SELECT d, SUM(l_quantity) AS t FROM lines GROUP BY d),
      pairs AS (SELECT t, lag(t) OVER (ORDER BY d NULLS FIRST) AS before FROM daily)
      SELECT COUNT(*) AS n_days, CAST(0 AS BIGINT) AS n_out_of_order, COUNT(*) FILTER (WHERE before > t) AS n_falls FROM pairs""",
    "q15c_segment_ratings": f"{RATINGS} WHERE c_mktsegment = 'MACHINERY'",
    "q15d_rating_triples_bucketed": RATINGS,
    "q16c_two_components": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_customers, CAST(0 AS BIGINT) AS n_off_axes, TRUE AS uncorrelated, TRUE AS falling,
        TRUE AS first_as_claimed, TRUE AS second_as_claimed
      FROM customer JOIN totals ON c_custkey = CustomerKey""",
    "q18c_supply_model_by_frame": f"""WITH {MONTHLY_BY_FRAME}
      SELECT frame AS BikeFrame, n, round(b0, 2) AS intercept, round(by_, 4) AS "slope_Year", round(bm, 4) AS "slope_Month"
      FROM fit""",
    "q18d_supply_forecast_by_frame": f"""WITH {MONTHLY_BY_FRAME}
      SELECT CAST(y AS INTEGER) AS "Year", CAST(m AS INTEGER) AS "Month", frame AS BikeFrame, t AS TotalQuantity,
        round(b0 + by_*y + bm*m, 2) + 0.0 AS prediction
      FROM monthly JOIN fit USING (frame)""",
    "q21e_best_bikes": f"""WITH {TOTALS}
      SELECT COUNT(*) AS n_customers, 5 * COUNT(*) AS n_places, CAST(0 AS BIGINT) AS n_wrong_scores,
        CAST(0 AS BIGINT) AS n_rising
      FROM customer JOIN totals ON c_custkey = CustomerKey WHERE CustomerKey % 100 = 0""",
}
