"""G1–G8 invariants: counts, keys, foreign keys, domains, weights, and
independence from partitioning."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.schema import schema_of
from ledgerline.sources import generate as G

N_CUST, N_ORD, N_CLICK, N_REC = 500, 20_000, 50_000, 10_000


@pytest.fixture(scope="module")
def tables(spark):
    p = G.products(spark)
    return {
        "products": p,
        "customers": G.customers(G.id_range(spark, N_CUST)).cache(),
        "orders": G.orders(G.id_range(spark, N_ORD, N_CUST, seed=G.SEED_ORDERS), p).cache(),
        "clickstream": G.clickstream(G.id_range(spark, N_CLICK, N_CUST, seed=G.SEED_CLICKS)).cache(),
        "recommendations": G.recommendations(G.id_range(spark, N_REC, N_CUST, seed=G.SEED_RECS)).cache(),
    }


def test_counts_and_unique_keys(tables):
    assert tables["products"].count() == 10
    for name, key, n in [("customers", "customer_id", N_CUST), ("orders", "order_id", N_ORD),
                         ("clickstream", "event_id", N_CLICK)]:
        df = tables[name]
        assert df.count() == n
        assert df.select(key).distinct().count() == n


def test_key_formats(tables):
    c = tables["customers"].orderBy("customer_id").first()
    assert c.customer_id == "CUST-0001"
    first, last = c.name.split(" ")
    assert c.email == f"{first.lower()}.{last.lower()}1@example.com"
    assert tables["orders"].agg(F.min("order_id")).first()[0] == "ORD-000001"
    assert tables["clickstream"].agg(F.max("event_id")).first()[0] == f"EVT-{N_CLICK:07d}"


def test_foreign_keys(tables):
    c, p = tables["customers"], tables["products"]
    for name in ("orders", "clickstream", "recommendations"):
        df = tables[name]
        assert df.join(c, "customer_id", "left_anti").count() == 0, name
        assert df.join(p, "product_id", "left_anti").count() == 0, name


def test_unit_price_is_product_price(tables):
    o = tables["orders"].join(tables["products"].select("product_id", "price"), "product_id")
    assert o.where(F.col("unit_price") != F.col("price")).count() == 0


def test_domains(tables):
    o = tables["orders"].agg(F.min("quantity"), F.max("quantity"), F.min("order_date"), F.max("order_date")).first()
    assert (o[0], o[1]) == (1, 5)
    assert o[2].year == 2024 and o[3].year == 2024
    c = tables["customers"].agg(F.min("signup_date"), F.max("signup_date"), F.max(F.dayofmonth("signup_date"))).first()
    assert c[0].year == 2023 and c[1].year == 2023 and c[2] <= 28
    r = tables["recommendations"].agg(F.min("score"), F.max("score"), F.min("generated_at")).first()
    assert 0.0999 < r[0] and r[1] <= 1.0001 and r[2].month >= 6
    assert set(x[0] for x in tables["customers"].select("segment").distinct().collect()) == set(G.CUSTOMER_SEGMENTS)


def test_weights(tables):
    st = {r.status: r["count"] for r in tables["orders"].groupBy("status").count().collect()}
    assert abs(st["completed"] / N_ORD - 0.6) < 0.03
    assert abs(st["pending"] / N_ORD - 0.2) < 0.03
    ev = {r.event_type: r["count"] for r in tables["clickstream"].groupBy("event_type").count().collect()}
    assert abs(ev["page_view"] / N_CLICK - 0.5) < 0.03
    assert abs(ev["purchase"] / N_CLICK - 1 / 6) < 0.03


def test_ten_events_per_session(tables):
    sizes = tables["clickstream"].groupBy("session_id").count().select("count").distinct().collect()
    assert [r[0] for r in sizes] == [10]
    assert tables["clickstream"].where(F.col("event_id") == "EVT-0000011").first().session_id == "SESS-000002"


def test_partitioning_does_not_change_rows(spark):
    a = G.clickstream(G.id_range(spark, 5000, 500, num_partitions=1, seed=G.SEED_CLICKS))
    b = G.clickstream(G.id_range(spark, 5000, 500, num_partitions=13, seed=G.SEED_CLICKS))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_keys_wider_than_padding_are_kept(spark):
    ids = spark.range(99_998, 100_002).select("id")
    got = sorted(r.customer_id for r in G.customers(ids).collect())
    assert got == ["CUST-100000", "CUST-100001", "CUST-99998", "CUST-99999"]


def test_large_ids_do_not_overflow(spark):
    ids = spark.createDataFrame([(2**62,), (9_000_000_000_000,)], "id long")
    rows = G.customers(ids).collect()
    assert len(rows) == 2 and all(r.segment in G.CUSTOMER_SEGMENTS for r in rows)


@pytest.mark.parametrize("cols", [10, 50])
def test_wide_schema(spark, cols):
    df = G.wide(G.id_range(spark, 1000), cols, 46)
    assert len(df.columns) == cols
    assert df.columns == G.wide_column_names(cols)
    types = dict(df.dtypes)
    assert types["amount"] == "decimal(12,2)" and types["score"] == "float" and types["flag"] == "boolean"
    if cols == 50:
        assert types["col_int_10"] == "int" and types["col_float_11"] == "float"
        assert types["col_str_12"] == "string" and types["col_date_13"] == "date"
        assert types["col_decimal_14"] == "decimal(10,2)"
        assert sum(c.startswith("col_") for c in df.columns) == 40
    r = df.agg(F.min("amount"), F.max("amount"), F.min("created_date"), F.max("created_date")).first()
    assert float(r[0]) >= 1.0 and float(r[1]) <= 10000.0
    assert r[2].year >= 2020 and r[3].year <= 2024
    assert df.where(~F.col("description").rlike(r"^item_[0-9]+_[a-z]$")).count() == 0


def test_schema_expression(spark):
    base = G.products(spark)
    s = schema_of(base, "*, margin_tier:str")
    assert [f.name for f in s.fields] == base.columns + ["margin_tier"]
    s2 = schema_of(base, "*, price:double, n:decimal(10,2)")
    assert s2["price"].dataType.simpleString() == "double"
    assert s2["n"].dataType.simpleString() == "decimal(10,2)"
    with pytest.raises(ValueError):
        schema_of(base, "*, x:nosuchtype")


def test_columns_are_independent(spark):
    """Columns share one per-row mix; their joint distribution must still be
    close to uniform (18 segment × region cells over 36,000 customers)."""
    c = G.customers(G.id_range(spark, 36_000))
    cells = [r["count"] for r in c.groupBy("segment", "region").count().collect()]
    assert len(cells) == 18
    assert min(cells) > 1700 and max(cells) < 2300  # expected 2000 each
    months = [r["count"] for r in c.groupBy(F.month("signup_date"), "segment").count().collect()]
    assert len(months) == 36 and min(months) > 750 and max(months) < 1250  # expected 1000


def test_no_two_ids_share_their_payload(spark):
    """Ids that squaring would pair, and ids beyond the modulus."""
    m = 2147483647
    pair = [(7,), (1595340477 - 7,), (5,), (5 + m,), (5 + 2 * m,), (2**40 + 1,), (2**40 + 1 + m,)]
    ids = spark.createDataFrame(pair, "id long")
    cols = dict(G.wide_columns("spark", 50, 47))
    got = ids.select(*[F.expr(cols[c]).alias(c) for c in G.wide_column_names(50) if c not in ("id", "description")]).collect()
    assert len({tuple(r) for r in got}) == len(pair)


def test_seed_range_has_the_sessions_parallelism(spark):
    assert G.id_range(spark, 200_000).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
