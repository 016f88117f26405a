"""Q1–Q8: the retail pipelines, each in DataFrame form and as SQL.

Inputs are DataFrames with the e-commerce column names (see
``ledgerline.sources.bindings``). Every function is lazy and returns a
DataFrame; the SQL twins (``*_sql``) run through ``spark.sql`` with the frames
bound as named inputs, and must return the same rows (tested both ways with
``exceptAll``). Their output columns, predicates and order are fixed values:
they are the contract of the queries.

Scale notes (planner output checked with ``explain("formatted")``):
  * filters on the fact (``status``, ``score``) are pushed into the Parquet
    scan below the joins;
  * no join carries a broadcast hint: the planner's statistics check
    (``autoBroadcastJoinThreshold``) decides, and AQE re-decides from
    measured shuffle sizes (broadcast, or a hash join instead of a sort);
  * aggregates run partial (map-side) then final, so a hot group key is
    collapsed before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import exact
from ledgerline.functions import scalar as S
from ledgerline.operators.joins import bloom_reduced
from ledgerline.operators.order import top_k
from ledgerline.operators.transform import series_udf, transform
from ledgerline.session import ship_package


# --------------------------------------------------------------------- Q1
def product_margin(products: DataFrame) -> DataFrame:
    """Q1: margin and margin percentage per product, by margin descending."""
    return products.select(
        "product_id", "product_name", "category", "price", "cost",
        S.margin().alias("margin"),
        S.margin_pct().alias("margin_pct"),
    ).orderBy(F.desc("margin"))


PRODUCT_MARGIN_SQL = """
SELECT product_id, product_name, category, price, cost,
       ROUND(price - cost, 2) AS margin,
       ROUND(try_divide(price - cost, price) * 100, 1) AS margin_pct
FROM {products}
ORDER BY margin DESC
"""


def product_margin_sql(spark: SparkSession, products: DataFrame) -> DataFrame:
    return spark.sql(PRODUCT_MARGIN_SQL, products=products)


# --------------------------------------------------------------------- Q2
def segmentation(
    df: DataFrame,
    keys=("segment", "region"),
    measure: str = "signup_date",
    count_name: str = "customer_count",
    low_name: str = "earliest_signup",
    high_name: str = "latest_signup",
) -> DataFrame:
    """Q2: count and min/max of a measure per two-key group."""
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias(count_name),
            F.min(measure).alias(low_name),
            F.max(measure).alias(high_name),
        )
        .orderBy(F.desc(count_name))
    )


SEGMENTATION_SQL = """
SELECT segment, region,
       COUNT(*) AS customer_count,
       MIN(signup_date) AS earliest_signup,
       MAX(signup_date) AS latest_signup
FROM {customers}
GROUP BY segment, region
ORDER BY customer_count DESC
"""


def customer_segmentation_sql(spark: SparkSession, customers: DataFrame) -> DataFrame:
    return spark.sql(SEGMENTATION_SQL, customers=customers)


# --------------------------------------------------------------------- Q3
def order_enrichment(
    orders: DataFrame, customers: DataFrame, products: DataFrame, completed: str = "completed"
) -> DataFrame:
    """Q3 (flagship): completed order lines ⋈ customers ⋈ products, totals
    per (segment, category)."""
    o = orders.where(F.col("status") == F.lit(completed)).select(
        "customer_id", "product_id", "quantity", "unit_price"
    )
    c = customers.select("customer_id", "segment")
    p = products.select("product_id", "category")
    return (
        o.join(c, "customer_id")
        .join(p, "product_id")
        .groupBy("segment", "category")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("quantity").alias("total_units"),
            F.round(
                F.sum(F.col("unit_price").cast("double") * F.col("quantity").cast("double")), 2
            ).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def order_enrichment_by_header(
    lines: DataFrame, headers: DataFrame, customers: DataFrame, products: DataFrame,
    completed: str = "completed", reduce_lines: bool = False,
) -> DataFrame:
    """Q3 over a normalized order model: ``headers (order_id, customer_id,
    status)`` and ``lines (order_id, product_id, quantity, unit_price)``.

    Same result as :func:`order_enrichment` on ``lines ⋈ headers``, with the
    customer joined at header level: when no side is small enough to
    broadcast, the line-sized stream is shuffled twice (by order, by
    product) instead of three times (by order, by customer, by product);
    the customer shuffle moves only completed headers.

    No join strategy is forced. With nothing broadcastable, the line ⋈
    header join is planned as a sort-merge join, and AQE turns it into a
    shuffled hash join built on the headers once every measured header
    partition fits ``maxShuffledHashJoinLocalMapThreshold`` (see
    ``ledgerline.session``), so the line stream is not sorted. A forced
    ``shuffle_hash`` hint would skip that measured check, and a hash join
    cannot spill, so with too few shuffle partitions a slow job would become
    a failed one. Without table statistics, Catalyst sizes ``h`` (a join) as the
    product of its inputs, so before the query runs the lines would look
    like the smaller side; ``autoBroadcastJoinThreshold`` is kept at Spark's
    default for that reason, and a measured, small ``h`` is broadcast by AQE.

    With ``reduce_lines``, lines whose order is not completed are dropped by a
    Bloom filter of the kept headers before they are shuffled, if those are few
    enough for one (see :func:`bloom_reduced`).
    """
    kept = headers.where(F.col("status") == F.lit(completed)).select("order_id", "customer_id")
    if reduce_lines:
        lines = bloom_reduced(lines, "order_id", kept)
    h = (
        kept.join(customers.select("customer_id", "segment"), "customer_id")
        .select("order_id", "segment")
    )
    p = products.select("product_id", "category")
    return (
        lines.select("order_id", "product_id", "quantity", "unit_price")
        .join(h, "order_id")
        .join(p, "product_id")
        .groupBy("segment", "category")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("quantity").alias("total_units"),
            F.round(
                F.sum(F.col("unit_price").cast("double") * F.col("quantity").cast("double")), 2
            ).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"))
    )


ORDER_ENRICHMENT_BY_HEADER_SQL = """
WITH h AS (
  SELECT oh.order_id, c.segment
  FROM {headers} oh
  JOIN {customers} c ON oh.customer_id = c.customer_id
  WHERE oh.status = :completed
)
SELECT h.segment, p.category,
       COUNT(*) AS total_orders,
       SUM(l.quantity) AS total_units,
       ROUND(SUM(CAST(l.unit_price AS DOUBLE) * CAST(l.quantity AS DOUBLE)), 2) AS total_revenue
FROM {lines} l
JOIN h ON l.order_id = h.order_id
JOIN {products} p ON l.product_id = p.product_id
GROUP BY h.segment, p.category
ORDER BY total_revenue DESC
"""


def order_enrichment_by_header_sql(
    spark: SparkSession, lines: DataFrame, headers: DataFrame, customers: DataFrame,
    products: DataFrame, completed: str = "completed",
) -> DataFrame:
    """SQL form of :func:`order_enrichment_by_header` (the CTE joins the
    customer at header level)."""
    return spark.sql(
        ORDER_ENRICHMENT_BY_HEADER_SQL, args={"completed": completed},
        lines=lines, headers=headers, customers=customers, products=products,
    )


ORDER_ENRICHMENT_SQL = """
SELECT c.segment, p.category,
       COUNT(*) AS total_orders,
       SUM(o.quantity) AS total_units,
       ROUND(SUM(CAST(o.unit_price AS DOUBLE) * CAST(o.quantity AS DOUBLE)), 2) AS total_revenue
FROM {orders} o
JOIN {customers} c ON o.customer_id = c.customer_id
JOIN {products} p ON o.product_id = p.product_id
WHERE o.status = :completed
GROUP BY c.segment, p.category
ORDER BY total_revenue DESC
"""


def order_enrichment_sql(
    spark: SparkSession, orders: DataFrame, customers: DataFrame, products: DataFrame,
    completed: str = "completed",
) -> DataFrame:
    return spark.sql(
        ORDER_ENRICHMENT_SQL, args={"completed": completed},
        orders=orders, customers=customers, products=products,
    )


# --------------------------------------------------------------------- Q4
def session_summary(
    clickstream: DataFrame,
    keys=("session_id", "customer_id", "device"),
    purchase: str = "purchase",
    add_to_cart: str = "add_to_cart",
) -> DataFrame:
    """Q4: per-session counts. Groups are near-unique (a session mixes
    customers and devices), so the shuffle carries about one row per input
    row; the exact distinct count is planned as a two-level aggregate whose
    partial steps also collapse a hot key before each shuffle."""
    return clickstream.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events_in_session"),
        F.countDistinct("product_id").alias("products_viewed"),
        F.sum(S.is_value("event_type", purchase)).cast("bigint").alias("purchases"),
        F.sum(S.is_value("event_type", add_to_cart)).cast("bigint").alias("add_to_carts"),
    )


def session_summary_top(clickstream: DataFrame, k: int = 20, **kw) -> DataFrame:
    """Q4 with an ordered ``TAKE k ROWS``: the first k groups by key."""
    keys = list(kw.get("keys", ("session_id", "customer_id", "device")))
    return top_k(session_summary(clickstream, **kw), keys, k, descending=False)


def session_summary_top_prefiltered(clickstream: DataFrame, k: int = 20, **kw) -> DataFrame:
    """Q4 with an ordered ``TAKE k ROWS``, the top-k pushed below the
    aggregate — same rows as :func:`session_summary_top`.

    The result is ordered by the group keys, so the k groups it keeps are
    the k smallest distinct keys, and their rows are exactly the rows whose
    key tuple is at most the k-th of them (ascending, NULLs first, which is
    how Spark orders structs). That bound is a scalar subquery over the key
    columns alone (deduplicated map-side, then TakeOrderedAndProject, then
    ``max(struct(keys))``). The filter ``struct(keys) <= bound`` needs no
    join or broadcast, and Catalyst pushes it below the projection, so
    computed columns are evaluated only for surviving rows. At scale this
    replaces the two full shuffles of the exact distinct count with one
    shuffle of deduplicated key columns and a scan; a hot group among the k
    still reduces map-side before its shuffle. Lazy: the bound is computed
    when the query runs.
    """
    keys = list(kw.get("keys", ("session_id", "customer_id", "device")))
    if k <= 0:
        return session_summary_top(clickstream, k, **kw)
    first = top_k(clickstream.select(*keys).dropDuplicates(), keys, k, descending=False)
    bound = first.agg(F.max(F.struct(*keys))).scalar()
    rows = clickstream.where(F.struct(*keys) <= bound)
    return top_k(session_summary(rows, **kw), keys, k, descending=False)


SESSION_SUMMARY_SQL = """
SELECT {keys},
       COUNT(*) AS events_in_session,
       COUNT(DISTINCT product_id) AS products_viewed,
       CAST(SUM(CASE WHEN event_type = :purchase THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
       CAST(SUM(CASE WHEN event_type = :add_to_cart THEN 1 ELSE 0 END) AS BIGINT) AS add_to_carts
FROM {clickstream}
GROUP BY {keys}
"""


def session_summary_sql(
    spark: SparkSession, clickstream: DataFrame,
    keys=("session_id", "customer_id", "device"),
    purchase: str = "purchase", add_to_cart: str = "add_to_cart",
) -> DataFrame:
    key_list = ", ".join(f"`{k}`" for k in keys)
    text = SESSION_SUMMARY_SQL.replace("{keys}", key_list)
    return spark.sql(
        text, args={"purchase": purchase, "add_to_cart": add_to_cart},
        clickstream=clickstream,
    )


SESSION_SUMMARY_TOP_PREFILTERED_SQL = """
WITH first_keys AS (
  SELECT DISTINCT {keys} FROM {clickstream} ORDER BY {keys} LIMIT :k
)
SELECT {keys},
       COUNT(*) AS events_in_session,
       COUNT(DISTINCT product_id) AS products_viewed,
       CAST(SUM(CASE WHEN event_type = :purchase THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
       CAST(SUM(CASE WHEN event_type = :add_to_cart THEN 1 ELSE 0 END) AS BIGINT) AS add_to_carts
FROM {clickstream}
WHERE struct({keys}) <= (SELECT max(struct({keys})) FROM first_keys)
GROUP BY {keys}
ORDER BY {keys}
LIMIT :k
"""


def session_summary_top_prefiltered_sql(
    spark: SparkSession, clickstream: DataFrame, k: int = 20,
    keys=("session_id", "customer_id", "device"),
    purchase: str = "purchase", add_to_cart: str = "add_to_cart",
) -> DataFrame:
    """SQL form of :func:`session_summary_top_prefiltered` (k > 0): the
    same key bound as a scalar subquery."""
    key_list = ", ".join(f"`{c}`" for c in keys)
    text = SESSION_SUMMARY_TOP_PREFILTERED_SQL.replace("{keys}", key_list)
    return spark.sql(
        text, args={"k": k, "purchase": purchase, "add_to_cart": add_to_cart},
        clickstream=clickstream,
    )


# --------------------------------------------------------------------- Q5
def _typed_literal(df: DataFrame, column: str, value):
    """Compare a FLOAT column with a FLOAT literal: a DOUBLE literal would
    widen the column and make ``0.8f > 0.8`` true."""
    dtype = df.schema[column].dataType
    lit = F.lit(value)
    return lit.cast(dtype) if isinstance(dtype, (T.FloatType, T.DecimalType)) else lit


def top_recommendations(
    recommendations: DataFrame, products: DataFrame, min_score: float = 0.7, k: int = 20
) -> DataFrame:
    """Q5: recommendations above a score, with product name and category,
    top k by score (ties broken on all output columns)."""
    r = recommendations.where(
        F.col("score") > _typed_literal(recommendations, "score", min_score)
    ).select("customer_id", "product_id", "score", "reason")
    p = products.select("product_id", "product_name", "category")
    joined = r.join(p, "product_id").select(
        "customer_id", "product_name", "category", "score", "reason"
    )
    return top_k(joined, ["score"], k)


def top_recommendations_prefiltered(
    recommendations: DataFrame, products: DataFrame, min_score: float = 0.7, k: int = 20
) -> DataFrame:
    """Q5 with a score bound below the product join — same rows as
    :func:`top_recommendations`.

    The k-th best score among the lines that have a product is a scalar
    subquery (a semi-join, then TakeOrderedAndProject); only lines at or above
    it are joined with the products, ties included. Lazy and exact: the bound
    is computed when the query runs, and with fewer than k lines it lets all
    of them pass.
    """
    if k <= 0:
        return top_recommendations(recommendations, products, min_score, k)
    r = recommendations.where(
        F.col("score") > _typed_literal(recommendations, "score", min_score)
    ).select("customer_id", "product_id", "score", "reason")
    sold = r.select("product_id", "score").join(products.select("product_id"), "product_id", "left_semi")
    best = sold.select("score").orderBy(F.col("score").desc_nulls_last()).limit(k)
    bound = best.agg(F.min("score")).scalar()
    return top_recommendations(r.where(F.col("score") >= bound), products, min_score, k)


TOP_RECOMMENDATIONS_SQL = """
SELECT r.customer_id, p.product_name, p.category, r.score, r.reason
FROM {recommendations} r
JOIN {products} p ON r.product_id = p.product_id
WHERE r.score > CAST(:min_score AS {score_type})
ORDER BY r.score DESC, r.customer_id, p.product_name, p.category, r.reason
LIMIT :k
"""


def top_recommendations_sql(
    spark: SparkSession, recommendations: DataFrame, products: DataFrame,
    min_score: float = 0.7, k: int = 20,
) -> DataFrame:
    # the literal takes the column's type, as in the DataFrame form
    score_type = recommendations.schema["score"].dataType.simpleString()
    text = TOP_RECOMMENDATIONS_SQL.replace("{score_type}", score_type)
    return spark.sql(
        text, args={"min_score": min_score, "k": k},
        recommendations=recommendations, products=products,
    )


# --------------------------------------------------------------------- Q6
def product_units(orders: DataFrame, completed: str = "completed") -> DataFrame:
    """Q6: order lines and units per product over completed orders."""
    return (
        orders.where(F.col("status") == F.lit(completed))
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("quantity").alias("total_units"),
        )
        .orderBy(F.desc("total_units"))
    )


def product_units_head(orders: DataFrame, completed: str = "completed", n: int = 5) -> DataFrame:
    """Q6 ``head(5)``: the first n rows of the sorted result."""
    return top_k(product_units(orders, completed), ["total_units"], n)


PRODUCT_UNITS_SQL = """
SELECT product_id, COUNT(*) AS order_count, SUM(quantity) AS total_units
FROM {orders}
WHERE status = :completed
GROUP BY product_id
ORDER BY total_units DESC
"""


def product_units_sql(spark: SparkSession, orders: DataFrame, completed: str = "completed") -> DataFrame:
    return spark.sql(PRODUCT_UNITS_SQL, args={"completed": completed}, orders=orders)


# --------------------------------------------------------------------- Q7
def _tiers(pct: pd.Series) -> np.ndarray:
    """Tier of each percentage; a missing one is 'low'. Decimals are compared
    as Decimals, so no percentage moves across a threshold by rounding."""
    at_least = lambda bound: pct.map(lambda x: x is not None and x == x and x >= bound).astype(bool)
    return np.select([at_least(S.HIGH_TIER_MIN), at_least(S.MEDIUM_TIER_MIN)], ["high", "medium"], default="low")


def _percentage(price, cost):
    """Margin in percent of the price, None without both or for a zero price."""
    if price is None or cost is None or price != price or cost != cost or price == 0:
        return None
    return (price - cost) / price * 100


def classify_margin(df: pd.DataFrame) -> pd.DataFrame:
    """Row-local pandas transform: append ``margin_tier`` from the unrounded
    margin percentage, in the arithmetic of the columns' own type (Decimal
    columns divide as Decimals, floats as floats)."""
    if pd.api.types.is_numeric_dtype(df["price"]) and pd.api.types.is_numeric_dtype(df["cost"]):
        price, cost = df["price"].astype("float64"), df["cost"].astype("float64")
        pct = ((price - cost) / price.where(price != 0) * 100).to_numpy()
        tier = np.select([pct >= S.HIGH_TIER_MIN, pct >= S.MEDIUM_TIER_MIN], ["high", "medium"], default="low")
    else:
        pct = pd.Series([_percentage(p, c) for p, c in zip(df["price"], df["cost"])], index=df.index, dtype=object)
        tier = _tiers(pct)
    return df.assign(margin_tier=tier)


TIER_COLUMNS = ["product_name", "category", "price", "cost", "margin_tier"]


def margin_tier_native(products: DataFrame) -> DataFrame:
    """Q7, JVM-side: chained CASE on the unrounded percentage."""
    return products.select(
        "product_name", "category", "price", "cost",
        S.margin_tier(S.margin_pct_raw()).alias("margin_tier"),
    ).orderBy(F.desc("price"))


def tier_of_pct(pct: pd.Series) -> pd.Series:
    """Tier of each value of a percentage Series, float or Decimal; NaN and
    NULL are 'low'."""
    if pd.api.types.is_numeric_dtype(pct):
        x = pct.astype("float64")
        got = np.select([x >= S.HIGH_TIER_MIN, x >= S.MEDIUM_TIER_MIN], ["high", "medium"], default="low")
    else:
        got = _tiers(pct)
    return pd.Series(got, index=pct.index)


def margin_tier_udf(products: DataFrame) -> DataFrame:
    """Q7 with U3: the percentage stays a JVM expression; only the tier
    function runs in Python, as an Arrow-batched pandas UDF."""
    ship_package(products.sparkSession)
    tier = series_udf(tier_of_pct, "string")
    return products.select(
        "product_name", "category", "price", "cost",
        tier(S.margin_pct_raw()).alias("margin_tier"),
    ).orderBy(F.desc("price"))


def margin_tier_transform(products: DataFrame) -> DataFrame:
    """Q7 as a transform: ``TRANSFORM products USING classify_margin`` (schema
    ``*, margin_tier:str``), then select and order. Python sees only the
    columns that the result or the function needs."""
    transformed = transform(products.select(*TIER_COLUMNS[:-1]), classify_margin, "*, margin_tier:str")
    return transformed.select(*TIER_COLUMNS).orderBy(F.desc("price"))


TIER_QUERY_SQL = """
SELECT product_name, category, price, cost, margin_tier
FROM {transformed}
ORDER BY price DESC
"""


def margin_tier_transform_sql(spark: SparkSession, products: DataFrame) -> DataFrame:
    """Q7 chained (U4): the transform's result is bound under a name and
    queried with SQL."""
    transformed = transform(products.select(*TIER_COLUMNS[:-1]), classify_margin, "*, margin_tier:str")
    return spark.sql(TIER_QUERY_SQL, transformed=transformed)


MARGIN_TIER_SQL = """
SELECT product_name, category, price, cost,
       CASE WHEN try_divide(price - cost, price) * 100 >= 60 THEN 'high'
            WHEN try_divide(price - cost, price) * 100 >= 50 THEN 'medium'
            ELSE 'low' END AS margin_tier
FROM {products}
ORDER BY price DESC
"""


def margin_tier_sql(spark: SparkSession, products: DataFrame) -> DataFrame:
    return spark.sql(MARGIN_TIER_SQL, products=products)


# --------------------------------------------------------------------- Q8
def category_revenue(orders: DataFrame, products: DataFrame, completed: str = "completed") -> DataFrame:
    """Q8: revenue per product category over completed orders.

    Eager aggregation: order lines are summed per ``product_id`` first (a
    partial aggregate before the shuffle collapses a hot product), and the
    product join then sees one row per product; its output is already
    hash-partitioned on the join key, so only the product side moves.
    """
    per_product = (
        orders.where(F.col("status") == F.lit(completed))
        .groupBy("product_id")
        .agg(F.sum(F.col("unit_price").cast("double") * F.col("quantity").cast("double")).alias("rev"))
    )
    p = products.select("product_id", "category")
    return (
        per_product.join(p, "product_id")
        .groupBy("category")
        .agg(F.round(F.sum("rev"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def category_revenue_exact(orders: DataFrame, products: DataFrame, completed: str = "completed") -> DataFrame:
    """Q8 without rounding to cents: the double nearest to the exact sum of the
    line amounts, the same bits however the lines are dealt. The limbs of the
    amounts are summed per product and again per category."""
    amount = F.col("unit_price").cast("double") * F.col("quantity").cast("double")
    per_product = (
        orders.where(F.col("status") == F.lit(completed)).groupBy("product_id").agg(*exact.limb_sums(amount, "rev")))
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category").agg(*exact.merged_sums("rev"))
        .select("category", exact.total_of("rev").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


CATEGORY_REVENUE_SQL = """
SELECT p.category,
       ROUND(SUM(CAST(o.unit_price AS DOUBLE) * CAST(o.quantity AS DOUBLE)), 2) AS revenue
FROM {orders} o
JOIN {products} p ON o.product_id = p.product_id
WHERE o.status = :completed
GROUP BY p.category
ORDER BY revenue DESC
"""


def category_revenue_sql(
    spark: SparkSession, orders: DataFrame, products: DataFrame, completed: str = "completed"
) -> DataFrame:
    return spark.sql(
        CATEGORY_REVENUE_SQL, args={"completed": completed}, orders=orders, products=products
    )
