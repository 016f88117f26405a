"""Every registered query against its DuckDB oracle at sf0.01, plus the
driver smoke entry."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.helpers import digest

from ledgerline.plans.registry import QUERIES

ORACLES = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    missing = set(QUERIES) - set(ORACLES)
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["segment", "category", "total_orders", "total_units", "total_revenue"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert digest(srows, df.columns) == digest(orows, rel.columns)


def test_bench_prints_one_json_line():
    """bench.py (the driver's per-round benchmark) prints exactly one JSON
    line with the metric, unit, per-query seconds and scale factor."""
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run(
        [sys.executable, os.path.join(root, "bench.py"), "product_margin", "session_summary_top20_prefiltered"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1, out
    d = json.loads(lines[0])
    assert d["metric"] == "total_query_seconds" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"product_margin", "session_summary_top20_prefiltered"}
    assert all(isinstance(v, float) and v > 0 for v in d["queries"].values())
    assert "errors" not in d


def test_every_query_matches_oracle_without_broadcasts(spark, duck):
    """The 100 TB regime: with broadcasting disabled (sort-merge joins, AQE's
    measured hash-join conversion, tiny advisory partitions so AQE coalesces
    and splits), every registered query still returns its oracle's rows."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k) for k in confs}
    bad = []
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        for name, fn in sorted(QUERIES.items()):
            df = fn(spark, SF01)
            srows = [tuple(r) for r in df.collect()]
            rel = duck.sql(ORACLES[name])
            if digest(srows, df.columns) != digest(rel.fetchall(), rel.columns):
                bad.append(name)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert not bad, bad
