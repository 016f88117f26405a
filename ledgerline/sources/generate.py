"""Distributed, repeatable table generators.

Each generator maps an *id frame* to rows: ``spark.range(1, n + 1)`` when
seeding a catalog (the seed jobs), or keys taken from existing tables (the
registered queries). Every column is a pure expression of the id, so the
work is map-only, spreads over all executors and never passes rows through
the driver. The one join — order lines looking up the product price — is
against the 10-row constant product list.

Column expressions are rendered per SQL dialect (see
``ledgerline.functions.random``); the Spark form runs them through
``F.expr`` and the DuckDB form is the oracle for the same rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.random import (
    date_sql, float2_sql, hundredths_sql, key_sql, pick_sql, timestamp_sql, uniform_sql,
)

# ---------------------------------------------------------------------------
# The product catalog, name lists and category domains of the
# e-commerce and wide benchmark tables. Repeated entries set the weights
# (order status 3:1:1, event type 3:2:1).
PRODUCT_CATALOG = [
    ("PROD-001", "Wireless Mouse", "Peripherals", "29.99", "12.50", "TechCorp"),
    ("PROD-002", "Mechanical Keyboard", "Peripherals", "89.99", "35.00", "KeyMaster"),
    ("PROD-003", "USB-C Hub", "Accessories", "45.50", "18.00", "ConnectPro"),
    ("PROD-004", "Monitor Stand", "Furniture", "34.99", "14.00", "DeskWorks"),
    ("PROD-005", "Webcam HD", "Peripherals", "59.99", "22.00", "VisionTech"),
    ("PROD-006", "Laptop Sleeve", "Accessories", "19.99", "6.50", "BagCo"),
    ("PROD-007", "Desk Lamp", "Furniture", "24.99", "9.00", "LightHouse"),
    ("PROD-008", "Headphones", "Audio", "79.99", "30.00", "SoundWave"),
    ("PROD-009", "Mouse Pad", "Accessories", "12.99", "3.50", "PadMaster"),
    ("PROD-010", "Cable Organizer", "Accessories", "9.99", "2.80", "TidyDesk"),
]
CUSTOMER_SEGMENTS = ["premium", "standard", "basic"]
CUSTOMER_REGIONS = ["US-West", "US-East", "US-Central", "EU-West", "EU-East", "APAC"]
FIRST_NAMES = ["Alice", "Bob", "Charlie", "Diana", "Eve", "Frank", "Grace", "Henry", "Iris", "Jack",
               "Karen", "Leo", "Mia", "Noah", "Olivia", "Paul", "Quinn", "Rosa", "Sam", "Tina"]
LAST_NAMES = ["Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis", "Wilson", "Moore"]
ORDER_STATUSES = ["completed", "completed", "completed", "pending", "cancelled"]
EVENT_TYPES = ["page_view", "page_view", "page_view", "add_to_cart", "add_to_cart", "purchase"]
DEVICES = ["desktop", "mobile", "tablet"]
RECOMMENDATION_REASONS = ["similar_purchase", "trending", "frequently_bought_together", "browsing_history"]
WIDE_CATEGORIES = ["Electronics", "Clothing", "Home", "Sports", "Books", "Toys", "Food", "Auto"]
WIDE_REGIONS = ["US-West", "US-East", "US-Central", "EU-West", "EU-East", "APAC", "LATAM", "MEA"]
WIDE_STATUSES = ["active", "inactive", "pending", "archived"]
WIDE_PRIORITIES = ["low", "medium", "high", "critical"]
LOWERCASE = "abcdefghijklmnopqrstuvwxyz"
# Row counts of the seeded e-commerce tables and (name, columns, rows) of the
# wide benchmark tables.
NUM_CUSTOMERS = 500
NUM_ORDERS = 100_000
NUM_CLICKSTREAM = 1_000_000
NUM_RECOMMENDATIONS = 50_000
WIDE_TABLES = [
    ("small_dim_100k", 10, 100_000),
    ("large_dim_100k", 50, 100_000),
    ("small_dim_200k", 10, 200_000),
    ("large_dim_200k", 50, 200_000),
]
# Per-table seeds (G8): one constant per table, never a salted hash().
SEED_CUSTOMERS, SEED_ORDERS, SEED_CLICKS, SEED_RECS = 42, 43, 44, 45
SEED_WIDE = {"small_dim_100k": 46, "large_dim_100k": 47, "small_dim_200k": 48, "large_dim_200k": 49}
# ---------------------------------------------------------------------------

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("price", T.DecimalType(10, 2), False),
    T.StructField("cost", T.DecimalType(10, 2), False),
    T.StructField("supplier", T.StringType(), False),
])
PRODUCT_IDS = [p[0] for p in PRODUCT_CATALOG]


def _salt(seed: int, column: int) -> int:
    """One salt per (table seed, column) so columns are independent."""
    return seed * 1000 + column


# ------------------------------------------------------------------ G1
def products(spark: SparkSession) -> DataFrame:
    """G1: the constant 10-row product dimension."""
    rows = [(a, b, c, Decimal(d), Decimal(e), f) for a, b, c, d, e, f in PRODUCT_CATALOG]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


def products_sql() -> str:
    """DuckDB form of :func:`products`."""
    vals = ", ".join(
        f"('{a}', '{b}', '{c}', CAST('{d}' AS DECIMAL(10,2)), CAST('{e}' AS DECIMAL(10,2)), '{f}')"
        for a, b, c, d, e, f in PRODUCT_CATALOG
    )
    return (f"SELECT * FROM (VALUES {vals}) "
            "AS p(product_id, product_name, category, price, cost, supplier)")


# ------------------------------------------------------------------ G2
def customer_columns(dialect: str, id_col: str = "id", seed: int = SEED_CUSTOMERS) -> list[tuple[str, str]]:
    s = lambda k: _salt(seed, k)
    first = pick_sql(id_col, s(1), FIRST_NAMES, dialect)
    last = pick_sql(id_col, s(2), LAST_NAMES, dialect)
    return [
        ("customer_id", key_sql("CUST", id_col, 4, dialect)),
        ("name", f"concat({first}, ' ', {last})"),
        ("email", f"concat(lower({first}), '.', lower({last}), CAST({id_col} AS STRING), '@example.com')"
         if dialect == "spark" else
         f"concat(lower({first}), '.', lower({last}), CAST({id_col} AS VARCHAR), '@example.com')"),
        ("segment", pick_sql(id_col, s(3), CUSTOMER_SEGMENTS, dialect)),
        ("region", pick_sql(id_col, s(4), CUSTOMER_REGIONS, dialect)),
        ("signup_date", date_sql("2023", uniform_sql(id_col, s(5), 1, 12, dialect),
                                 uniform_sql(id_col, s(6), 1, 28, dialect), dialect)),
    ]


# ------------------------------------------------------------------ G3
def order_columns(dialect: str, id_col: str = "id", cust_col: str = "customer_num",
                  seed: int = SEED_ORDERS) -> list[tuple[str, str]]:
    s = lambda k: _salt(seed, k)
    return [
        ("order_id", key_sql("ORD", id_col, 6, dialect)),
        ("customer_id", key_sql("CUST", cust_col, 4, dialect)),
        ("product_id", pick_sql(id_col, s(1), PRODUCT_IDS, dialect)),
        ("quantity", f"CAST({uniform_sql(id_col, s(2), 1, 5, dialect)} AS INT)"
         if dialect == "spark" else f"CAST({uniform_sql(id_col, s(2), 1, 5, dialect)} AS INTEGER)"),
        ("order_date", date_sql("2024", uniform_sql(id_col, s(3), 1, 12, dialect),
                                uniform_sql(id_col, s(4), 1, 28, dialect), dialect)),
        ("status", pick_sql(id_col, s(5), ORDER_STATUSES, dialect)),
    ]


ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "order_date", "status"]


# ------------------------------------------------------------------ G4
def clickstream_columns(dialect: str, id_col: str = "id", cust_col: str = "customer_num",
                        seed: int = SEED_CLICKS) -> list[tuple[str, str]]:
    s = lambda k: _salt(seed, k)
    session_num = f"CAST(floor((({id_col}) - 1) / 10) AS BIGINT) + 1"
    return [
        ("event_id", key_sql("EVT", id_col, 7, dialect)),
        ("session_id", key_sql("SESS", session_num, 6, dialect)),
        ("customer_id", key_sql("CUST", cust_col, 4, dialect)),
        ("product_id", pick_sql(id_col, s(1), PRODUCT_IDS, dialect)),
        ("event_type", pick_sql(id_col, s(2), EVENT_TYPES, dialect)),
        ("timestamp", timestamp_sql(
            "2024", uniform_sql(id_col, s(3), 1, 12, dialect), uniform_sql(id_col, s(4), 1, 28, dialect),
            uniform_sql(id_col, s(5), 0, 23, dialect), uniform_sql(id_col, s(6), 0, 59, dialect),
            uniform_sql(id_col, s(7), 0, 59, dialect), dialect)),
        ("device", pick_sql(id_col, s(8), DEVICES, dialect)),
    ]


# ------------------------------------------------------------------ G5
def recommendation_columns(dialect: str, id_col: str = "id", cust_col: str = "customer_num",
                           seed: int = SEED_RECS) -> list[tuple[str, str]]:
    s = lambda k: _salt(seed, k)
    return [
        ("customer_id", key_sql("CUST", cust_col, 4, dialect)),
        ("product_id", pick_sql(id_col, s(1), PRODUCT_IDS, dialect)),
        ("score", float2_sql(uniform_sql(id_col, s(2), 10, 100, dialect), dialect)),
        ("reason", pick_sql(id_col, s(3), RECOMMENDATION_REASONS, dialect)),
        ("generated_at", date_sql("2024", uniform_sql(id_col, s(4), 6, 12, dialect),
                                  uniform_sql(id_col, s(5), 1, 28, dialect), dialect)),
    ]


# ------------------------------------------------------------------ G6
WIDE_TYPE_CYCLE = ["int", "float", "str", "date", "decimal"]


def wide_column_names(num_columns: int) -> list[str]:
    fixed = ["id", "category", "region", "status", "priority", "created_date", "amount", "score",
             "flag", "description"]
    return fixed + [f"col_{WIDE_TYPE_CYCLE[i % 5]}_{i}" for i in range(10, num_columns)]


def wide_columns(dialect: str, num_columns: int, seed: int, id_col: str = "id") -> list[tuple[str, str]]:
    """10 fixed columns, then ``col_<type>_<i>`` for i = 10..N-1 cycling
    int, float, str, date, decimal by ``i % 5``."""
    s = lambda k: _salt(seed, k)
    int_t = "INT" if dialect == "spark" else "INTEGER"
    str_t = "STRING" if dialect == "spark" else "VARCHAR"
    letter_pos = uniform_sql(id_col, s(9), 1, 26, dialect)
    letter = (f"substr('{LOWERCASE}', CAST({letter_pos} AS INT), 1)" if dialect == "spark"
              else f"substr('{LOWERCASE}', {letter_pos}, 1)")
    cols = [
        ("id", f"CAST({id_col} AS {int_t})"),
        ("category", pick_sql(id_col, s(1), WIDE_CATEGORIES, dialect)),
        ("region", pick_sql(id_col, s(2), WIDE_REGIONS, dialect)),
        ("status", pick_sql(id_col, s(3), WIDE_STATUSES, dialect)),
        ("priority", pick_sql(id_col, s(4), WIDE_PRIORITIES, dialect)),
        ("created_date", date_sql(uniform_sql(id_col, s(5), 2020, 2024, dialect),
                                  uniform_sql(id_col, s(6), 1, 12, dialect),
                                  uniform_sql(id_col, s(7), 1, 28, dialect), dialect)),
        ("amount", hundredths_sql(uniform_sql(id_col, s(8), 100, 1_000_000, dialect), 12, dialect)),
        ("score", float2_sql(uniform_sql(id_col, s(10), 0, 10_000, dialect), dialect)),
        ("flag", f"({uniform_sql(id_col, s(11), 0, 1, dialect)} = 1)"),
        ("description", f"concat('item_', CAST({id_col} AS {str_t}), '_', {letter})"),
    ]
    for i in range(10, num_columns):
        kind = WIDE_TYPE_CYCLE[i % 5]
        name = f"col_{kind}_{i}"
        k = 100 + i * 4
        if kind == "int":
            expr = f"CAST({uniform_sql(id_col, s(k), 0, 1_000_000, dialect)} AS {int_t})"
        elif kind == "float":
            expr = float2_sql(uniform_sql(id_col, s(k), 0, 100_000, dialect), dialect)
        elif kind == "str":
            expr = f"concat('val_', CAST({uniform_sql(id_col, s(k), 0, 10_000, dialect)} AS {str_t}))"
        elif kind == "date":
            expr = date_sql(uniform_sql(id_col, s(k), 2020, 2024, dialect),
                            uniform_sql(id_col, s(k + 1), 1, 12, dialect),
                            uniform_sql(id_col, s(k + 2), 1, 28, dialect), dialect)
        else:
            expr = hundredths_sql(uniform_sql(id_col, s(k), 0, 500_000, dialect), 10, dialect)
        cols.append((name, expr))
    return cols


# ------------------------------------------------------------------ frames
def _apply(ids: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return ids.select(*[F.expr(expr).alias(name) for name, expr in columns])


def customers(ids: DataFrame) -> DataFrame:
    """G2 over an id frame with column ``id``."""
    return _apply(ids, customer_columns("spark"))


def orders(ids: DataFrame, product_frame: DataFrame) -> DataFrame:
    """G3 over ``(id, customer_num)``; ``unit_price`` is the product's price
    (P24), looked up by a join. No hint: the planner measures the frame."""
    lines = _apply(ids, order_columns("spark"))
    prices = product_frame.select("product_id", F.col("price").alias("unit_price"))
    return lines.join(prices, "product_id").select(*ORDER_COLUMNS)


def clickstream(ids: DataFrame) -> DataFrame:
    """G4 over ``(id, customer_num)``: ids 1–10 are session 1, 11–20 session 2…"""
    return _apply(ids, clickstream_columns("spark"))


def recommendations(ids: DataFrame) -> DataFrame:
    """G5 over ``(id, customer_num)``."""
    return _apply(ids, recommendation_columns("spark"))


def wide(ids: DataFrame, num_columns: int, seed: int) -> DataFrame:
    """G6 over an id frame with column ``id``."""
    return _apply(ids, wide_columns("spark", num_columns, seed))


def id_range(spark: SparkSession, n: int, customers_n: int | None = None, num_partitions: int | None = None,
             seed: int = 0) -> DataFrame:
    """``spark.range(1, n + 1)`` as ``id`` (and ``customer_num`` uniform on
    ``[1, customers_n]`` when given): the id frame of a seed job.

    By default the range has the session's parallelism; the sinks bound file
    sizes with ``maxRecordsPerFile``. Values do not depend on either."""
    ids = spark.range(1, n + 1, numPartitions=num_partitions).select(F.col("id"))
    if customers_n:
        ids = ids.withColumn("customer_num", F.expr(uniform_sql("id", _salt(seed, 0), 1, customers_n)))
    return ids


def generator_sql(columns: list[tuple[str, str]], source_sql: str) -> str:
    """DuckDB statement for a generator over ``source_sql`` (the id frame)."""
    body = ",\n  ".join(f"{expr} AS {name}" for name, expr in columns)
    return f"SELECT\n  {body}\nFROM ({source_sql}) src"
