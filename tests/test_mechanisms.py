"""Semi-join reduction, sketches, data-driven pivots, checked and keyed
transforms, weighted draws, one job a table in the seed jobs."""

import random

import duckdb
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import random as R
from ledgerline.operators import aggregate as A
from ledgerline.operators import joins as J
from ledgerline.operators import transform as T
from ledgerline.plans import registry, retail, seed
from ledgerline.sources.bindings import driver_roles
from tests.conftest import SF01
from tests.helpers import assert_same_rows


# ------------------------------------------------------------ semi-join reduction
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reduction_keeps_every_match_and_few_others(spark):
    kept = spark.range(0, 40_000, 4).select((F.col("id") * 7919).alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    fact = spark.range(40_000).select((F.col("id") * 7919).alias("k"), F.col("id").alias("v"))
    out = J.bloom_reduced(fact, "k", kept)
    assert out.join(kept, "k").count() == 10_000 == fact.join(kept, "k").count()
    assert 10_000 <= out.count() <= 10_000 + 0.05 * 30_000  # false positives only
    assert J.bloom_reduced(fact, "k", kept.limit(0)).count() <= 0.05 * 40_000
    text = J.bloom_reduced(fact.select(F.col("v").cast("string").alias("k")), "k", spark.createDataFrame([("7",), ("x",)], "k string"))
    assert "7" in {r.k for r in text.collect()}


def test_a_filter_too_full_is_left_out(spark):
    fact, kept = spark.range(100).withColumnRenamed("id", "k"), spark.range(1000).withColumnRenamed("id", "k")
    assert J.filter_words(1000, 64 * 100) == 100 and J.filter_words(1000, 64 * 60) == 0
    assert J.bloom_reduced(fact, "k", kept, max_bits=4096) is fact


def test_lines_are_dropped_below_the_exchange(spark):
    r = driver_roles(spark, SF01)
    args = (r.order_lines, r.order_headers, r.customers, r.products, r.lit("completed"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole, reduced = retail.order_enrichment_by_header(*args), retail.order_enrichment_by_header(*args, reduce_lines=True)
        assert_same_rows(whole, reduced)
        lines = plan_of(reduced).split("Exchange hashpartitioning(order_id")[1].split("Exchange")[0]
        assert "Subquery" in lines and "Filter" in lines  # between the scan and the exchange
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kept = r.order_headers.where(F.col("status") == r.lit("completed"))
    n, m = r.order_lines.count(), J.bloom_reduced(r.order_lines, "order_id", kept).count()
    assert r.order_lines.join(kept, "order_id").count() <= m <= 0.7 * n


def test_a_partitioned_fact_is_pruned_by_its_dimension(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(2000).select("id", (F.col("id") % 20).alias("day")).write.partitionBy("day").parquet(path)
    days = spark.createDataFrame([(d, d % 2) for d in range(20)], "day long, odd int")
    out = spark.read.parquet(path).join(F.broadcast(days.where("odd = 1")), "day")
    assert "dynamicpruning" in plan_of(out) and out.count() == 1000


# ------------------------------------------------------------ sketches
def test_united_sketches_equal_those_of_all_rows(spark):
    rows = spark.range(60_000).select((F.col("id") % 9).alias("day"), (F.hash("id") % 23_000).alias("user"))
    daily = A.distinct_sketches(rows, ["day"], "user")
    one = A.united_sketches(daily).select(A.sketched_count().alias("n")).first().n
    assert one == A.distinct_sketches(rows, [], "user").select(A.sketched_count().alias("n")).first().n
    exact = rows.select("user").distinct().count()
    assert abs(one - exact) <= 4 * A.SKETCH_ERROR * exact
    # stored and read again, coarser groups need no raw row
    halves = A.united_sketches(daily.groupBy((F.col("day") % 2).alias("half")).agg(F.hll_union_agg("sketch").alias("sketch")))
    assert halves.select(A.sketched_count().alias("n")).first().n == one
    assert A.united_sketches(daily.limit(0)).select(A.sketched_count().alias("n")).first().n == 0
    nulls = spark.sql("SELECT CAST(NULL AS BIGINT) AS user, 1 AS day")
    assert A.distinct_sketches(nulls, ["day"], "user").select(A.sketched_count().alias("n")).first().n == 0


# ------------------------------------------------------------ pivots
def test_pivot_finds_its_columns(spark):
    df = spark.createDataFrame([("a", "z", 1.0), ("a", "b", 2.0), ("c", "z", 3.0), ("d", None, 4.0)], "t string, e string, v double")
    got = A.pivot_unique(df, "t", "e", "v")
    assert got.columns == ["t", "b", "z"]
    assert sorted(map(tuple, got.collect())) == [("a", 2.0, 1.0), ("c", None, 3.0), ("d", None, None)]
    with pytest.raises(ValueError, match="more than 1 values"):
        A.pivot_unique(df, "t", "e", "v", most=1)
    with pytest.raises(Exception, match="duplicate"):
        A.pivot_unique(df.union(df.limit(1)), "t", "e", "v").collect()
    assert A.pivot_unique(df.limit(0), "t", "e", "v").collect() == []


# ------------------------------------------------------------ transforms
def test_whole_frame_functions_raise_when_checked(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("v")).coalesce(2)
    for whole in (lambda p: p.assign(s=p["v"] / p["v"].sum()), lambda p: p.assign(s=p["v"].rank()),
                  lambda p: p.assign(s=p["v"].shift(1).fillna(0.0)), lambda p: p.assign(s=1.0).head(3)):
        with pytest.raises(Exception, match="not row-local"):
            T.transform(df, whole, "*, s:double", checked=True).collect()
    good = T.transform(df, lambda p: p.assign(s=p["v"] * 2)[p["v"] > 5], "*, s:double", checked=True)
    assert good.count() == 994 and good.where("s <> 2 * v").count() == 0
    changes = T.transform(df, lambda p: p.assign(v=p["v"] + 1, s=0.5), "*, s:double", checked=True)
    assert changes.agg(F.sum("v")).first()[0] == sum(range(1, 1001))


def test_keyed_functions_see_their_group_as_a_stream(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(9)) for i in range(30_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        def running(key, batches):
            total, seen = 0, 0
            for b in batches:
                seen = max(seen, b.num_rows)
                v = pd.Series(b.column("v").to_pylist()).cumsum() + total
                total = int(v.iloc[-1])
                yield pa.RecordBatch.from_arrays([b.column("k"), b.column("at"), pa.array(v), pa.array([seen] * b.num_rows)],
                                                 names=["k", "at", "total", "batch"])

        df = spark.createDataFrame(rows, "k string, at long, v long").repartition(5)
        got = T.keyed_transform(df, ["k"], running, "k:string, at:long, total:long, batch:long", order_by=["at"])
        plan = plan_of(got)
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
        got = got.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    totals, want = {}, {}
    for k, at, v in rows:
        totals[k] = totals.get(k, 0) + v
        want[k, at] = totals[k]
    assert {(r.k, r.at): r.total for r in got} == want and max(r.batch for r in got) <= 1000


# ------------------------------------------------------------ weighted draws
@pytest.mark.parametrize("weights", [[0.437, 0.31, 0.15, 0.1, 0.003], [1, 0, 2.5], [1], [1 / 3] * 3, [1e-9, 1], [5, 1, 1, 1, 1, 1, 1]])
def test_shares_follow_the_weights(spark, weights):
    n, values = 1_000_000, [f"v{i}'" for i in range(len(weights))]
    sql = R.weighted_sql("id", (77, 78), values, weights)
    got = {r[0]: r[1] for r in spark.range(n).select(F.expr(sql).alias("x")).groupBy("x").count().collect()}
    for v, w in zip(values, weights):
        p = w / sum(weights)
        assert abs(got.get(v, 0) - n * p) <= 5 * (n * p * (1 - p)) ** 0.5 + 1, (v, got)
    same = duckdb.sql(f"SELECT x, count(*) FROM (SELECT {R.weighted_sql('id', (77, 78), values, weights, 'duckdb')} AS x "
                      f"FROM range({n}) t(id)) GROUP BY x").fetchall()
    assert dict(same) == got


def test_bad_weights_raise():
    for w in ([], [0, 0], [1, -1]):
        with pytest.raises(ValueError):
            R.alias_table(w)
    threshold, other = R.alias_table([3, 1])
    assert threshold[1] == round(R.MODULUS / 2) and other[1] == 0 and threshold[0] == R.MODULUS


# ------------------------------------------------------------ seeds
def test_seed_counts_come_from_the_write(spark, monkeypatch):
    """No table is read to count it, and a NULL in a NOT NULL column raises."""
    read = []
    monkeypatch.setattr(seed.catalog, "checked_row_counts", lambda frames: read.append(frames))
    sizes = {"customers": 40, "orders": 300, "clickstream": 500, "recommendations": 60}
    got = {r.table: r.rows for r in seed.seed_ecommerce(spark, "seed_observed", sizes=sizes).collect()}
    assert got == {f"seed_observed.{t}": n for t, n in {"products": 10, **sizes}.items()} and not read
    assert {t: spark.read.table(t).count() for t in got} == got
    df = spark.range(5).select(F.when(F.col("id") != 3, F.col("id")).alias("id"))
    with pytest.raises(ValueError, match="NOT NULL violated in seed_observed.bad"):
        seed._written(spark, {"seed_observed.bad": (df, ["id"], None)}, "parquet", 1000)


def test_registered_mechanisms_are_deterministic(spark):
    for name in ("category_revenue_exact", "running_value", "weighted_labels"):
        a, b = (registry.QUERIES[name](spark, SF01) for _ in range(2))
        assert_same_rows(a, b)
