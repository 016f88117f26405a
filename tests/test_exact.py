import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import exact as X


def nearest(values):
    return float(sum(map(Fraction, values), Fraction(0)))  # rounds once, to even


def money(rng, n):
    return [rng.choice([-1, 1, 1]) * round(rng.random() * 10 ** rng.randrange(0, 12), 2) for _ in range(n)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "k int, v double").repartition(parts)


def test_totals_are_rounded_once(spark):
    rng = random.Random(3)
    groups = {k: money(rng, rng.randrange(1, 60)) for k in range(120)}
    # ties, long carries, cancellation to nothing and to the lowest bit
    groups[200] = [2.0**53, 1.0, 2.0**-84]
    groups[201] = [2.0**53, 1.0]
    groups[202] = [2.0**53, 3.0]
    groups[203] = [-(2.0**59), 2.0**59, -(2.0**-84)]
    groups[204] = [0.1, -0.1, 0.0, -0.0]
    groups[205] = [2.0**59.5] * 50 + [2.0**-60]
    groups[206] = [-1e17, 0.01] * 30
    groups[207] = [2.0**59 + 2.0**10, 2.0**-40, -(2.0**-41)]
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    got = {r.k: r.s for r in frame(spark, rows).groupBy("k").agg(X.exact_sum("v").alias("s")).collect()}
    assert got == {k: nearest(vs) for k, vs in groups.items()}
    assert got[200] == 2.0**53 + 2 and got[201] == 2.0**53 and got[203] == -(2.0**-84)


def test_equal_bits_for_any_partitioning(spark):
    rng = random.Random(5)
    rows = [(i % 3, v) for i, v in enumerate(money(rng, 6000) + [round(rng.random() * 1e15, 2) for _ in range(6000)])]
    seen = set()
    for parts in (1, 13, 211):
        df = frame(spark, rows, parts)
        twice = df.groupBy("k", (F.hash("v") % 7).alias("h")).agg(*X.limb_sums("v", "s")).groupBy("k").agg(
            *X.merged_sums("s")).select("k", X.total_of("s").alias("s"))
        for got in (df.groupBy("k").agg(X.exact_sum("v").alias("s")), twice):
            seen.add(tuple(sorted((r.k, r.s.hex()) for r in got.collect())))
    assert len(seen) == 1
    want = {k: nearest([v for g, v in rows if g == k]) for k in range(3)}
    assert dict(seen.pop()) == {k: v.hex() for k, v in want.items()} and min(want.values()) > 1e16


def test_missing_and_special_values(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, None), (1, None), (1, 2.5), (2, nan), (2, 1.0), (3, inf), (3, 1.0), (4, inf), (4, -inf), (5, -inf), (6, 0.0)]
    got = {r.k: r.s for r in frame(spark, rows).groupBy("k").agg(X.exact_sum("v").alias("s")).collect()}
    assert got[0] is None and got[1] == 2.5 and math.isnan(got[2]) and got[3] == inf and math.isnan(got[4])
    assert got[5] == -inf and got[6] == 0.0
    assert frame(spark, []).agg(X.exact_sum("v").alias("s")).first().s is None


@pytest.mark.parametrize("value", [1e-30, 2.0**60, -1e19, 5e-324])
def test_values_without_an_exact_sum_raise(spark, value):
    with pytest.raises(Exception, match="no exact sum holds"):
        frame(spark, [(1, value), (1, 1.0)]).agg(X.exact_sum("v")).collect()


def test_sums_are_partial_hash_aggregates(spark):
    plan = frame(spark, [(1, 1.0)]).groupBy("k").agg(X.exact_sum("v").alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_sum" in plan
