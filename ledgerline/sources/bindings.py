"""Role bindings: the driver's TPC-H-like tables projected onto the
e-commerce schema the pipelines are written against.

Every pipeline in ``ledgerline.plans`` takes DataFrames with the e-commerce
column names (``products``, ``customers``, ``orders``, ``clickstream``,
``recommendations``). The same pipeline therefore runs on tables seeded by
``ledgerline.sources.generate`` and on the driver tables through these
projections. Projections are plain ``select``s (and, for order lines and
customers, joins), so Catalyst still prunes columns and pushes filters into
the Parquet scans underneath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import Tables


class Roles:
    """E-commerce role frames plus the literals that mark statuses/events.

    Frames are built on first access only: constructing a DataFrame reads
    Parquet footers and analyzes the plan, so a pipeline that needs two
    roles should not pay for five.
    """

    def __init__(self, builders: dict, literals: dict | None = None):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}
        self.literals = dict(literals or {})

    def __getattr__(self, name: str) -> DataFrame:
        builders = self.__dict__.get("_builders", {})
        if name not in builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = builders[name]()
        return self._built[name]

    def lit(self, name: str) -> str:
        return self.literals.get(name, DEFAULT_LITERALS[name])


# The status / event labels the reference's queries test for.
DEFAULT_LITERALS = {
    "completed": "completed",
    "purchase": "purchase",
    "add_to_cart": "add_to_cart",
}

# Labels of the driver tables that play those roles.
DRIVER_LITERALS = {
    "completed": "F",
    "purchase": "purchase",
    "add_to_cart": "click",
}


def driver_products(t: Tables) -> DataFrame:
    """part → products. cost is a whole number of cents below the price."""
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        (F.floor(F.col("p_retailprice") * (F.lit(20) + F.col("p_size"))) / F.lit(100)).alias("cost"),
        F.col("p_brand").alias("supplier"),
    )


def driver_products_decimal(t: Tables) -> DataFrame:
    """part → products with money as DECIMAL(10,2), as the seeded tables have it."""
    money = "decimal(10,2)"
    return driver_products(t).withColumns({c: F.col(c).cast(money) for c in ("price", "cost")})


def driver_customers(t: Tables) -> DataFrame:
    """customer → customers, without the region lookup (Q3 needs only the
    segment, and an inner join Catalyst cannot prove lossless would not be
    removed for it)."""
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
    )


def driver_customers_geo(t: Tables) -> DataFrame:
    """customer ⋈ nation ⋈ region → customers (region = region name).

    nation and region have a fixed cardinality (25 and 5 rows at every
    scale factor), so broadcasting them is bounded by construction.
    """
    geo = t.nation.select("n_nationkey", "n_regionkey").join(
        F.broadcast(t.region.select("r_regionkey", "r_name")),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.col("c_acctbal").alias("acctbal"),
    )


def driver_orders(t: Tables) -> DataFrame:
    """lineitem ⋈ orders → order lines (one product per row).

    Both sides grow with the data: no hint, so the planner's size check
    decides (sort-merge at scale, AQE may still switch at runtime).
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def driver_order_headers(t: Tables) -> DataFrame:
    """orders → order headers (one row per order)."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def driver_order_lines(t: Tables) -> DataFrame:
    """lineitem → order lines without header columns."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


def driver_orders_decimal(t: Tables) -> DataFrame:
    """Order lines with an INT quantity and a DECIMAL(10,2) unit price."""
    return driver_orders(t).withColumns({
        "quantity": F.col("quantity").cast("int"), "unit_price": F.col("unit_price").cast("decimal(10,2)")})


# Devices of the clickstream, dealt out by event id.
DEVICES = ["desktop", "mobile", "tablet"]


def driver_clickstream_devices(t: Tables) -> DataFrame:
    """The clickstream with a device per event, so that sessions mix devices."""
    device = F.element_at(F.array(*map(F.lit, DEVICES)), (F.col("event_id") % 3 + 1).cast("int"))
    return driver_clickstream(t).withColumn("device", device)


def driver_clickstream(t: Tables) -> DataFrame:
    """events → clickstream: ten consecutive event ids form a session and
    the product is the ``k`` field of the JSON ``props``."""
    return t.events.select(
        F.col("event_id"),
        F.floor(F.col("event_id") / F.lit(10)).cast("bigint").alias("session_id"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("event_type"),
        F.col("ts").alias("timestamp"),
        F.col("value"),
    )


def driver_recommendations(t: Tables) -> DataFrame:
    """lineitem → recommendations: discount plays the score."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_discount").alias("score"),
        F.col("l_returnflag").alias("reason"),
        F.col("l_shipdate").cast("date").alias("generated_at"),
    )


def driver_recommendations_float(t: Tables) -> DataFrame:
    """Recommendations whose score is a FLOAT, as the seeded tables have it:
    the discount weighted by the quantity, so that few lines share a score."""
    score = (F.col("l_discount") * F.col("l_quantity") / 50).cast("float")
    return t.lineitem.select(
        F.col("l_orderkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
        score.alias("score"), F.col("l_returnflag").alias("reason"))


def driver_roles(spark: SparkSession, sf_dir: str) -> Roles:
    t = Tables(spark, sf_dir)
    return Roles(
        {
            "products": lambda: driver_products(t),
            "products_decimal": lambda: driver_products_decimal(t),
            "customers": lambda: driver_customers(t),
            "customers_geo": lambda: driver_customers_geo(t),
            "orders": lambda: driver_orders(t),
            "orders_decimal": lambda: driver_orders_decimal(t),
            "order_headers": lambda: driver_order_headers(t),
            "order_lines": lambda: driver_order_lines(t),
            "clickstream": lambda: driver_clickstream(t),
            "clickstream_devices": lambda: driver_clickstream_devices(t),
            "recommendations": lambda: driver_recommendations(t),
            "recommendations_float": lambda: driver_recommendations_float(t),
        },
        DRIVER_LITERALS,
    )
