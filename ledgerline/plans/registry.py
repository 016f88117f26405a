"""Registered queries over the driver tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs a pipeline on the driver
tables of one scale-factor folder; ``ORACLE_SQL[name]`` is a SQL statement
over the same tables (views named after the tables) that must return the same
rows. It is written from the definitions; only the value columns of ``gen_*``
share the generators' arithmetic, while their keys, sessions and domains are
checked by literal SQL in ``gen_keys`` and ``gen_domains``. Every query reads whole tables — no sampling, id
subsets or row caps; a ``LIMIT`` appears only where top-k is the feature.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import random as R
from ledgerline.plans import reports, retail
from ledgerline.sources import catalog
from ledgerline.sources import generate as G
from ledgerline.sources.bindings import driver_roles
from ledgerline.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------ retail (Q1–Q9)
def q_order_enrichment(spark, sf_dir):
    """Flagship: customers joined at order-header level (see retail)."""
    r = driver_roles(spark, sf_dir)
    return retail.order_enrichment_by_header(
        r.order_lines, r.order_headers, r.customers, r.products, r.lit("completed"))


def q_order_enrichment_flat(spark, sf_dir):
    """The reference's join order over flat order lines."""
    r = driver_roles(spark, sf_dir)
    return retail.order_enrichment(r.orders, r.customers, r.products, r.lit("completed"))


def q_order_enrichment_sql(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.order_enrichment_sql(spark, r.orders, r.customers, r.products, r.lit("completed"))


def q_product_margin(spark, sf_dir):
    return retail.product_margin(driver_roles(spark, sf_dir).products)


def q_margin_tier_native(spark, sf_dir):
    return retail.margin_tier_native(driver_roles(spark, sf_dir).products)


def q_margin_tier_transform(spark, sf_dir):
    return retail.margin_tier_transform(driver_roles(spark, sf_dir).products)


def q_margin_tier_udf(spark, sf_dir):
    return retail.margin_tier_udf(driver_roles(spark, sf_dir).products)


def q_order_enrichment_header_sql(spark, sf_dir):
    """The flagship's header-level join as SQL."""
    r = driver_roles(spark, sf_dir)
    return retail.order_enrichment_by_header_sql(
        spark, r.order_lines, r.order_headers, r.customers, r.products, r.lit("completed"))


def q_margin_tier_chain(spark, sf_dir):
    """U4: the transform's result queried with SQL."""
    return retail.margin_tier_transform_sql(spark, driver_roles(spark, sf_dir).products)


# Money as DECIMAL(10,2), quantity as INT, score as FLOAT, three session keys:
# the column types and keys of the seeded tables.
def q_product_margin_decimal(spark, sf_dir):
    return retail.product_margin(driver_roles(spark, sf_dir).products_decimal)


def q_margin_tier_native_decimal(spark, sf_dir):
    return retail.margin_tier_native(driver_roles(spark, sf_dir).products_decimal)


def q_margin_tier_transform_decimal(spark, sf_dir):
    return retail.margin_tier_transform(driver_roles(spark, sf_dir).products_decimal)


def q_margin_tier_udf_decimal(spark, sf_dir):
    return retail.margin_tier_udf(driver_roles(spark, sf_dir).products_decimal)


def q_order_enrichment_decimal(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.order_enrichment(r.orders_decimal, r.customers, r.products_decimal, r.lit("completed"))


def q_category_revenue_decimal(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.category_revenue(r.orders_decimal, r.products_decimal, r.lit("completed"))


def q_top_recommendations_float(spark, sf_dir):
    """The bound is a score that lines have: as a FLOAT it keeps them out, as a
    DOUBLE literal it would let them in (0.098f > 0.098)."""
    r = driver_roles(spark, sf_dir)
    return retail.top_recommendations(r.recommendations_float, r.products, min_score=0.098, k=200)


def q_session_summary_devices(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.session_summary(
        r.clickstream_devices, purchase=r.lit("purchase"), add_to_cart=r.lit("add_to_cart"))


def q_customer_segmentation(spark, sf_dir):
    return retail.segmentation(
        driver_roles(spark, sf_dir).customers_geo, keys=("segment", "region"), measure="acctbal",
        low_name="lowest_balance", high_name="highest_balance",
    )


def q_order_date_range(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    return retail.segmentation(
        o, keys=("priority", "status"), measure="order_date", count_name="order_count",
        low_name="earliest_order", high_name="latest_order",
    )


SESSION_KEYS = ("session_id", "customer_id")


def q_session_summary(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.session_summary(
        r.clickstream, keys=SESSION_KEYS, purchase=r.lit("purchase"), add_to_cart=r.lit("add_to_cart")
    )


def q_session_summary_top20(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.session_summary_top(
        r.clickstream, 20, keys=SESSION_KEYS, purchase=r.lit("purchase"), add_to_cart=r.lit("add_to_cart")
    )


def q_session_summary_top20_prefiltered(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.session_summary_top_prefiltered(
        r.clickstream, 20, keys=SESSION_KEYS, purchase=r.lit("purchase"), add_to_cart=r.lit("add_to_cart")
    )


def q_top_recommendations(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.top_recommendations(r.recommendations, r.products, min_score=0.07, k=20)


def q_top_recommendations_prefiltered(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.top_recommendations_prefiltered(r.recommendations, r.products, min_score=0.07, k=20)


def q_product_units(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.product_units(r.orders, r.lit("completed"))


def q_product_units_top5(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.product_units_head(r.orders, r.lit("completed"), 5)


def q_category_revenue(spark, sf_dir):
    r = driver_roles(spark, sf_dir)
    return retail.category_revenue(r.orders, r.products, r.lit("completed"))


def q_category_revenue_exact(spark, sf_dir):
    """Q8 as the exact sum of the line amounts, not rounded to cents."""
    r = driver_roles(spark, sf_dir)
    return retail.category_revenue_exact(r.orders, r.products, r.lit("completed"))


def q_order_enrichment_reduced(spark, sf_dir):
    """The flagship with its lines reduced by a Bloom filter of the kept headers."""
    r = driver_roles(spark, sf_dir)
    return retail.order_enrichment_by_header(
        r.order_lines, r.order_headers, r.customers, r.products, r.lit("completed"), reduce_lines=True)


def q_user_reach(spark, sf_dir):
    """A5: distinct users per event type, exact and by united daily sketches."""
    return reports.user_reach(Tables(spark, sf_dir).events)


def q_run_log_pivot_found(spark, sf_dir):
    """Q10 with the engines that the log holds as columns."""
    return reports.run_log_pivot(reports.events_run_log(Tables(spark, sf_dir).events))


# The tables of a report, in its order
LISTED_TABLES = ("user_9", "user_2", "user_41")


def q_run_log_pivot_listed(spark, sf_dir):
    """The report's rows are the tables that the caller lists, in that order."""
    return reports.run_log_pivot(reports.events_run_log(Tables(spark, sf_dir).events), tables=LISTED_TABLES)


def q_running_value(spark, sf_dir):
    """A keyed function with a running state, per user in the order of time."""
    return reports.running_value(Tables(spark, sf_dir).events)


def q_weighted_labels(spark, sf_dir):
    """Labels drawn with weights that are no whole numbers, one per order."""
    label = R.weighted_sql("o_orderkey", (901, 902), list(WEIGHTED), list(WEIGHTED.values()))
    return Tables(spark, sf_dir).orders.select("o_orderkey", F.expr(label).alias("label"))


# Fixed values of the query weighted_labels: label -> weight
WEIGHTED = {"web": 0.437, "store": 0.31, "phone": 0.15, "partner": 0.1, "mail": 0.003}


def _scan(name):
    def q(spark, sf_dir):
        return getattr(Tables(spark, sf_dir), name).select("*")
    q.__name__ = f"q_scan_{name}"
    return q


# ------------------------------------------------------------ reports
def q_pivot_report(spark, sf_dir):
    return reports.events_pivot(Tables(spark, sf_dir).events)


def q_argmin_argmax(spark, sf_dir):
    return reports.events_arg_extremes(Tables(spark, sf_dir).events)


def q_run_log_pivot(spark, sf_dir):
    return reports.run_log_pivot(reports.events_run_log(Tables(spark, sf_dir).events), reports.EVENT_TYPE_ORDER)


def q_run_log_summary(spark, sf_dir):
    return reports.run_log_summary(reports.events_run_log(Tables(spark, sf_dir).events), reports.EVENT_TYPE_ORDER)


def q_step_summary(spark, sf_dir):
    return reports.step_summary(reports.events_steps(Tables(spark, sf_dir).events))


def q_first_per_key(spark, sf_dir):
    return reports.events_first_per_user(Tables(spark, sf_dir).events)


def q_meta_left_join(spark, sf_dir):
    return reports.events_meta_join(Tables(spark, sf_dir).events)


def q_total_row(spark, sf_dir):
    return reports.events_total_row(Tables(spark, sf_dir).events)


def q_display_format(spark, sf_dir):
    return reports.events_display(Tables(spark, sf_dir).events)


# ------------------------------------------------------------ generators
# The seed jobs generate from spark.range; the registered forms take their
# ids (and customer foreign keys) from the driver tables, so the work grows
# with the data.
def q_gen_customers(spark, sf_dir):
    return G.customers(Tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("id")))


def q_gen_orders(spark, sf_dir):
    ids = Tables(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_num"))
    return G.orders(ids, G.products(spark))


def q_gen_clickstream(spark, sf_dir):
    ids = Tables(spark, sf_dir).events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("customer_num"))
    return G.clickstream(ids)


def q_gen_recommendations(spark, sf_dir):
    ids = Tables(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_num"))
    return G.recommendations(ids)


WIDE_COLUMNS = 50
WIDE_SEED = G.SEED_WIDE["large_dim_100k"]


def q_gen_wide(spark, sf_dir):
    ids = Tables(spark, sf_dir).part.select(F.col("p_partkey").alias("id"))
    return G.wide(ids, WIDE_COLUMNS, WIDE_SEED)


def q_gen_keys(spark, sf_dir):
    """Keys and session numbers of the generated clickstream and orders."""
    clicks = q_gen_clickstream(spark, sf_dir).select("event_id", "session_id", "customer_id")
    orders = q_gen_orders(spark, sf_dir).select(
        F.col("order_id").alias("event_id"), F.lit(None).cast("string").alias("session_id"), "customer_id")
    return clicks.unionByName(orders)


def q_gen_domains(spark, sf_dir):
    """Rows outside the domain of their column, per generated table."""
    o, c = q_gen_orders(spark, sf_dir), q_gen_customers(spark, sf_dir)
    k, r = q_gen_clickstream(spark, sf_dir), q_gen_recommendations(spark, sf_dir)
    bad = lambda *ok: F.sum(F.when(reduce(lambda a, b: a & b, ok), 0).otherwise(1)).alias("outside")
    parts = {
        "customers": c.agg(F.count("*").alias("n"), bad(
            F.col("segment").isin(G.CUSTOMER_SEGMENTS), F.col("region").isin(G.CUSTOMER_REGIONS), F.year("signup_date") == 2023)),
        "orders": o.agg(F.count("*").alias("n"), bad(
            F.col("status").isin(G.ORDER_STATUSES), F.col("quantity").between(1, 5), F.year("order_date") == 2024)),
        "clickstream": k.agg(F.count("*").alias("n"), bad(
            F.col("event_type").isin(G.EVENT_TYPES), F.col("device").isin(G.DEVICES), F.year("timestamp") == 2024)),
        "recommendations": r.agg(F.count("*").alias("n"), bad(
            F.col("reason").isin(G.RECOMMENDATION_REASONS), F.col("score").between(F.lit(0.1).cast("float"), 1.0))),
    }
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("table"), "n", F.col("outside").cast("bigint").alias("outside")) for name, df in parts.items()])


SHAPE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def q_table_shapes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return catalog.shapes({n: getattr(t, n) for n in SHAPE_TABLES})


SCAN_TABLES = ("lineitem", "orders", "customer", "events")

QUERIES: dict[str, Query] = {
    "order_enrichment": q_order_enrichment,
    "order_enrichment_flat": q_order_enrichment_flat,
    "order_enrichment_sql": q_order_enrichment_sql,
    "order_enrichment_header_sql": q_order_enrichment_header_sql,
    "order_enrichment_decimal": q_order_enrichment_decimal,
    "product_margin": q_product_margin,
    "product_margin_decimal": q_product_margin_decimal,
    "margin_tier_native": q_margin_tier_native,
    "margin_tier_transform": q_margin_tier_transform,
    "margin_tier_udf": q_margin_tier_udf,
    "margin_tier_chain": q_margin_tier_chain,
    "margin_tier_native_decimal": q_margin_tier_native_decimal,
    "margin_tier_transform_decimal": q_margin_tier_transform_decimal,
    "margin_tier_udf_decimal": q_margin_tier_udf_decimal,
    "customer_segmentation": q_customer_segmentation,
    "order_date_range": q_order_date_range,
    "session_summary": q_session_summary,
    "session_summary_devices": q_session_summary_devices,
    "session_summary_top20": q_session_summary_top20,
    "session_summary_top20_prefiltered": q_session_summary_top20_prefiltered,
    "top_recommendations": q_top_recommendations,
    "top_recommendations_float": q_top_recommendations_float,
    "top_recommendations_prefiltered": q_top_recommendations_prefiltered,
    "product_units": q_product_units,
    "product_units_top5": q_product_units_top5,
    "category_revenue": q_category_revenue,
    "category_revenue_decimal": q_category_revenue_decimal,
    "category_revenue_exact": q_category_revenue_exact,
    "order_enrichment_reduced": q_order_enrichment_reduced,
    "user_reach": q_user_reach,
    "run_log_pivot_found": q_run_log_pivot_found,
    "run_log_pivot_listed": q_run_log_pivot_listed,
    "running_value": q_running_value,
    "weighted_labels": q_weighted_labels,
    **{f"scan_{t}": _scan(t) for t in SCAN_TABLES},
    "pivot_report": q_pivot_report,
    "run_log_pivot": q_run_log_pivot,
    "run_log_summary": q_run_log_summary,
    "step_summary": q_step_summary,
    "argmin_argmax": q_argmin_argmax,
    "first_per_key": q_first_per_key,
    "meta_left_join": q_meta_left_join,
    "total_row": q_total_row,
    "display_format": q_display_format,
    "gen_customers": q_gen_customers,
    "gen_orders": q_gen_orders,
    "gen_clickstream": q_gen_clickstream,
    "gen_recommendations": q_gen_recommendations,
    "gen_wide": q_gen_wide,
    "gen_keys": q_gen_keys,
    "gen_domains": q_gen_domains,
    "table_shapes": q_table_shapes,
}


# ------------------------------------------------------------ DuckDB oracles
_COST = "FLOOR(p_retailprice * (20 + p_size)) / 100"

_ORDER_ENRICHMENT = """
SELECT c.c_mktsegment AS segment, p.p_type AS category,
       COUNT(*) AS total_orders,
       SUM(l.l_quantity) AS total_units,
       ROUND(SUM(CAST(l.l_extendedprice AS DOUBLE) * CAST(l.l_quantity AS DOUBLE)), 2) AS total_revenue
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderstatus = 'F'
GROUP BY c.c_mktsegment, p.p_type
ORDER BY total_revenue DESC
"""

_TIER = f"""
SELECT p_name AS product_name, p_type AS category, p_retailprice AS price, {_COST} AS cost,
       CASE WHEN (p_retailprice - {_COST}) / p_retailprice * 100 >= 60 THEN 'high'
            WHEN (p_retailprice - {_COST}) / p_retailprice * 100 >= 50 THEN 'medium'
            ELSE 'low' END AS margin_tier
FROM part
ORDER BY price DESC
"""

_SESSION = """
SELECT CAST(event_id // 10 AS BIGINT) AS session_id, user_id AS customer_id,
       COUNT(*) AS events_in_session,
       COUNT(DISTINCT json_extract_string(props, '$.k')) AS products_viewed,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
       CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS add_to_carts
FROM events
GROUP BY 1, 2
"""

_SESSION_TOP20 = f"SELECT * FROM ({_SESSION}) s ORDER BY session_id, customer_id LIMIT 20"

_TOP_RECS = """
SELECT l.l_orderkey AS customer_id, p.p_name AS product_name, p.p_type AS category,
       l.l_discount AS score, l.l_returnflag AS reason
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_discount > 0.07
ORDER BY score DESC, customer_id, product_name, category, reason
LIMIT 20
"""

_PRODUCT_UNITS = """
SELECT l.l_partkey AS product_id, COUNT(*) AS order_count, SUM(l.l_quantity) AS total_units
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F'
GROUP BY l.l_partkey
"""

# money as DECIMAL(10,2); percentages compared exactly, without a division
_PARTS_DECIMAL = f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST({_COST} AS DECIMAL(10,2)) AS cost FROM part
"""

_TIER_DECIMAL = f"""
SELECT product_name, category, price, cost,
       CASE WHEN 100 * (price - cost) >= 60 * price THEN 'high'
            WHEN 100 * (price - cost) >= 50 * price THEN 'medium' ELSE 'low' END AS margin_tier
FROM ({_PARTS_DECIMAL}) p ORDER BY price DESC
"""

_REVENUE_DECIMAL = ("CAST(CAST(l.l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) * "
                    "CAST(CAST(l.l_quantity AS INTEGER) AS DOUBLE)")

# fixed values: the event types in report order
_ENGINES = ("view", "click", "purchase", "signup", "error")

_RUN_LOG = """
SELECT 'user_' || user_id AS "table", event_type AS engine, COUNT(*) AS "rows",
       CASE WHEN COUNT(*) % 3 <> 0 THEN MIN(value) END AS time_s
FROM events GROUP BY user_id, event_type
"""

_TYPE_POS = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN {i}" for i, t in enumerate(reports.EVENT_TYPE_ORDER, start=1)
) + f" ELSE {len(reports.EVENT_TYPE_ORDER) + 1} END"

ORACLE_SQL: dict[str, str] = {
    "order_enrichment": _ORDER_ENRICHMENT,
    "order_enrichment_reduced": _ORDER_ENRICHMENT,
    # whole multiples of 2**-60, summed as 128-bit integers and rounded once from
    # their decimal digits; the last division is by a power of two
    "category_revenue_exact": """
SELECT p.p_type AS category,
       CAST(CAST(SUM(CAST(CAST(l.l_extendedprice AS DOUBLE) * CAST(l.l_quantity AS DOUBLE) * power(2.0, 60) AS HUGEINT))
                 AS VARCHAR) AS DOUBLE) / power(2.0, 60) AS revenue
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderstatus = 'F'
GROUP BY p.p_type
ORDER BY revenue DESC, category
""",
    "user_reach": """
SELECT event_type, COUNT(DISTINCT user_id) AS users, TRUE AS within_bound, TRUE AS unites
FROM events GROUP BY event_type
""",
    "running_value": """
SELECT event_id, user_id, row_number() OVER w AS nth, MAX(value) OVER w AS highest
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""",
    "weighted_labels": f"""
SELECT o_orderkey, {R.weighted_sql("o_orderkey", (901, 902), list(WEIGHTED), list(WEIGHTED.values()), "duckdb")} AS label FROM orders
""",
    "order_enrichment_flat": _ORDER_ENRICHMENT,
    "order_enrichment_sql": _ORDER_ENRICHMENT,
    "order_enrichment_header_sql": _ORDER_ENRICHMENT,
    "order_enrichment_decimal": f"""
SELECT c.c_mktsegment AS segment, p.p_type AS category, COUNT(*) AS total_orders,
       SUM(CAST(l.l_quantity AS INTEGER))::BIGINT AS total_units, ROUND(SUM({_REVENUE_DECIMAL}), 2) AS total_revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderstatus = 'F' GROUP BY ALL
""",
    "category_revenue_decimal": f"""
SELECT p.p_type AS category, ROUND(SUM({_REVENUE_DECIMAL}), 2) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderstatus = 'F' GROUP BY ALL
""",
    "product_margin_decimal": f"""
SELECT product_id, product_name, category, price, cost, price - cost AS margin,
       CAST(ROUND(CAST((price - cost) AS DOUBLE) * 100 / CAST(price AS DOUBLE), 1) AS DECIMAL(20,1)) AS margin_pct
FROM ({_PARTS_DECIMAL}) p
""",
    "margin_tier_native_decimal": _TIER_DECIMAL,
    "margin_tier_transform_decimal": _TIER_DECIMAL,
    "margin_tier_udf_decimal": _TIER_DECIMAL,
    "margin_tier_chain": _TIER,
    "session_summary_devices": """
SELECT CAST(event_id // 10 AS BIGINT) AS session_id, user_id AS customer_id,
       CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
       COUNT(*) AS events_in_session,
       COUNT(DISTINCT json_extract_string(props, '$.k')) AS products_viewed,
       COUNT(*) FILTER (event_type = 'purchase') AS purchases,
       COUNT(*) FILTER (event_type = 'click') AS add_to_carts
FROM events GROUP BY ALL
""",
    "top_recommendations_float": """
SELECT l.l_orderkey AS customer_id, p.p_name AS product_name, p.p_type AS category,
       CAST(l.l_discount * l.l_quantity / 50 AS FLOAT) AS score, l.l_returnflag AS reason
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE CAST(l.l_discount * l.l_quantity / 50 AS FLOAT) > CAST(0.098 AS FLOAT)
ORDER BY score DESC, customer_id, product_name, category, reason LIMIT 200
""",
    "run_log_pivot": f"""
SELECT "table", arg_min("rows", engine) AS "rows", 6 AS cols, {", ".join(
        f"MAX(CASE WHEN engine = '{e}' THEN time_s END) AS {e}" for e in _ENGINES)}
FROM ({_RUN_LOG}) l GROUP BY "table" ORDER BY "table"
""",
    "run_log_pivot_found": f"""
SELECT "table", arg_min("rows", engine) AS "rows", 6 AS cols, {", ".join(
        f"MAX(CASE WHEN engine = '{e}' THEN time_s END) AS {e}" for e in _ENGINES)}
FROM ({_RUN_LOG}) l GROUP BY "table"
""",
    "run_log_pivot_listed": f"""
SELECT "table", arg_min("rows", engine) AS "rows", 6 AS cols, {", ".join(
        f"MAX(CASE WHEN engine = '{e}' THEN time_s END) AS {e}" for e in _ENGINES)}
FROM ({_RUN_LOG}) l WHERE "table" IN {LISTED_TABLES} GROUP BY "table"
""",
    "run_log_summary": f"""
WITH l AS ({_RUN_LOG}),
r AS (SELECT *, list_position({list(_ENGINES)}, engine) AS pos FROM l WHERE time_s IS NOT NULL),
m AS (SELECT "table", arg_min("rows", engine) AS n FROM l GROUP BY "table")
SELECT r."table", format('{{:,}}', any_value(n)) AS "rows", 6 AS cols,
       arg_min(engine, (time_s, pos)) || ' (' || printf('%.3f', MIN(time_s)) || 's)' AS fastest,
       arg_min(engine, (-time_s, pos)) || ' (' || printf('%.3f', MAX(time_s)) || 's)' AS slowest,
       printf('%.1fx', MAX(time_s) / MIN(time_s)) AS speedup
FROM r JOIN m USING ("table") GROUP BY r."table" ORDER BY r."table"
""",
    "step_summary": """
SELECT coalesce(event_type, 'TOTAL') AS step, printf('%.3f', SUM(CASE WHEN value < 100 THEN value END)) AS time_s
FROM events GROUP BY ROLLUP (event_type)
""",
    "product_margin": f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       p_retailprice AS price, {_COST} AS cost,
       ROUND(p_retailprice - {_COST}, 2) AS margin,
       ROUND((p_retailprice - {_COST}) / p_retailprice * 100, 1) AS margin_pct
FROM part
ORDER BY margin DESC
""",
    "margin_tier_native": _TIER,
    "margin_tier_transform": _TIER,
    "margin_tier_udf": _TIER,
    "customer_segmentation": """
SELECT c.c_mktsegment AS segment, r.r_name AS region,
       COUNT(*) AS customer_count,
       MIN(c.c_acctbal) AS lowest_balance, MAX(c.c_acctbal) AS highest_balance
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY c.c_mktsegment, r.r_name
ORDER BY customer_count DESC
""",
    "order_date_range": """
SELECT o_orderpriority AS priority, o_orderstatus AS status, COUNT(*) AS order_count,
       MIN(CAST(o_orderdate AS DATE)) AS earliest_order, MAX(CAST(o_orderdate AS DATE)) AS latest_order
FROM orders
GROUP BY o_orderpriority, o_orderstatus
ORDER BY order_count DESC
""",
    "session_summary": _SESSION,
    "session_summary_top20": _SESSION_TOP20,
    "session_summary_top20_prefiltered": _SESSION_TOP20,
    "top_recommendations": _TOP_RECS,
    "product_units": _PRODUCT_UNITS + "ORDER BY total_units DESC",
    "top_recommendations_prefiltered": _TOP_RECS,
    "product_units_top5": f"SELECT * FROM ({_PRODUCT_UNITS}) u ORDER BY total_units DESC, product_id, order_count LIMIT 5",
    "category_revenue": """
SELECT p.p_type AS category,
       ROUND(SUM(CAST(l.l_extendedprice AS DOUBLE) * CAST(l.l_quantity AS DOUBLE)), 2) AS revenue
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderstatus = 'F'
GROUP BY p.p_type
ORDER BY revenue DESC
""",
    **{f"scan_{t}": f"SELECT * FROM {t}" for t in SCAN_TABLES},
    "pivot_report": "SELECT user_id, " + ", ".join(
        f"ROUND(SUM(CASE WHEN event_type = '{t}' THEN value END), 2) AS \"{t}\""
        for t in reports.EVENT_TYPE_ORDER
    ) + " FROM events GROUP BY user_id",
    "argmin_argmax": f"""
WITH m AS (
  SELECT user_id, event_type, MIN(value) AS t, {_TYPE_POS} AS pos
  FROM events GROUP BY user_id, event_type
), r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY t ASC, pos ASC) AS rn_lo,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY t DESC, pos ASC) AS rn_hi
  FROM m WHERE t IS NOT NULL
)
SELECT a.user_id, a.event_type AS fastest, a.t AS fastest_time,
       b.event_type AS slowest, b.t AS slowest_time, ROUND(b.t / a.t, 6) AS speedup
FROM r a JOIN r b ON a.user_id = b.user_id
WHERE a.rn_lo = 1 AND b.rn_hi = 1
""",
    "first_per_key": """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT user_id, event_id, ts, event_type, value,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events) x
WHERE rn = 1
""",
    "meta_left_join": """
SELECT m.event_type, m.row_count, m.user_count, d.high_value_events, d.high_value_total
FROM (SELECT event_type, COUNT(*) AS row_count, COUNT(DISTINCT user_id) AS user_count
      FROM events GROUP BY event_type) m
LEFT JOIN (SELECT event_type, COUNT(*) AS high_value_events, ROUND(SUM(value), 2) AS high_value_total
           FROM events WHERE value > 100 GROUP BY event_type) d
ON m.event_type = d.event_type
""",
    "total_row": """
SELECT CASE WHEN GROUPING(event_type) = 1 THEN 'TOTAL' ELSE event_type END AS step,
       COUNT(*) AS events, ROUND(SUM(value), 2) AS total_value
FROM events
GROUP BY ROLLUP(event_type)
""",
    "display_format": """
SELECT event_type,
       format('{:,}', COUNT(*)) AS events_fmt,
       printf('%.3f', ROUND(SUM(value), 2)) AS value_fmt,
       printf('%.1fx', MAX(value) / MIN(value)) AS spread_fmt
FROM events
GROUP BY event_type
""",
}


def _gen_orders_sql() -> str:
    lines = G.generator_sql(
        G.order_columns("duckdb"), "SELECT o_orderkey AS id, o_custkey AS customer_num FROM orders")
    cols = ", ".join("p.price AS unit_price" if c == "unit_price" else f"g.{c}" for c in G.ORDER_COLUMNS)
    return f"SELECT {cols} FROM ({lines}) g JOIN ({G.products_sql()}) p ON g.product_id = p.product_id"


ORACLE_SQL.update({
    "gen_customers": G.generator_sql(G.customer_columns("duckdb"), "SELECT c_custkey AS id FROM customer"),
    "gen_orders": _gen_orders_sql(),
    "gen_clickstream": G.generator_sql(
        G.clickstream_columns("duckdb"), "SELECT event_id AS id, user_id AS customer_num FROM events"),
    "gen_recommendations": G.generator_sql(
        G.recommendation_columns("duckdb"), "SELECT o_orderkey AS id, o_custkey AS customer_num FROM orders"),
    "gen_wide": G.generator_sql(
        G.wide_columns("duckdb", WIDE_COLUMNS, WIDE_SEED), "SELECT p_partkey AS id FROM part"),
    # written out literally: keys are zero-padded to 7, 6 and 4 digits, and ten
    # consecutive event ids make a session
    "gen_keys": """
SELECT printf('EVT-%07d', event_id) AS event_id,
       printf('SESS-%06d', CAST(floor((event_id - 1) / 10.0) AS BIGINT) + 1) AS session_id,
       printf('CUST-%04d', user_id) AS customer_id FROM events
UNION ALL
SELECT printf('ORD-%06d', o_orderkey), NULL, printf('CUST-%04d', o_custkey) FROM orders
""",
    "gen_domains": """
SELECT 'customers' AS "table", COUNT(*) AS n, 0::BIGINT AS outside FROM customer
UNION ALL SELECT 'orders', COUNT(*), 0 FROM orders
UNION ALL SELECT 'clickstream', COUNT(*), 0 FROM events
UNION ALL SELECT 'recommendations', COUNT(*), 0 FROM orders
""",
    "table_shapes": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", COUNT(*) AS \"rows\", "
        f"(SELECT CAST(COUNT(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS cols FROM {t}"
        for t in SHAPE_TABLES
    ),
})
