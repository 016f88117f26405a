"""A11–A17, J3, O6, P23 on hand-made run logs (FIXTURES.md §3 edge cases)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.operators.aggregate import arg_extremes, first_per_key, pivot_sum, pivot_unique, with_total_row
from ledgerline.operators.order import order_by_position, top_k
from ledgerline.plans import reports
from ledgerline.plans.timing import RUN_LOG_SCHEMA

ENGINES = ["Pandas", "DuckDB", "Spark"]


def log(spark, rows):
    return spark.createDataFrame([r + (None,) for r in rows], RUN_LOG_SCHEMA)


@pytest.fixture(scope="module")
def run_log(spark):
    return log(spark, [
        ("t_small", 100000, 10, "Pandas", 0.5),
        ("t_small", 100000, 10, "DuckDB", 0.25),
        ("t_small", 100000, 10, "Spark", 2.0),
        ("t_tie", 200000, 50, "Pandas", 1.0),      # tie with DuckDB → Pandas (first)
        ("t_tie", 200000, 50, "DuckDB", 1.0),
        ("t_tie", 200000, 50, "Spark", None),      # failed run: skipped
        ("t_fail", 100000, 50, "Pandas", None),    # all failed: no summary row
        ("t_fail", 100000, 50, "DuckDB", None),
        ("t_fail", 100000, 50, "Spark", None),
    ])


def test_pivot_report(run_log):
    rows = {r.table: r for r in reports.run_log_pivot(run_log, ENGINES).collect()}
    assert set(rows) == {"t_small", "t_tie", "t_fail"}
    assert rows["t_small"].DuckDB == 0.25 and rows["t_small"].Spark == 2.0
    assert rows["t_tie"].Spark is None
    assert rows["t_fail"].Pandas is None and rows["t_fail"].rows == 100000
    assert reports.run_log_pivot(run_log, ENGINES).columns == ["table", "rows", "cols"] + ENGINES


def test_pivot_duplicate_pair_raises(spark, run_log):
    dup = run_log.unionByName(log(spark, [("t_small", 100000, 10, "Spark", 3.0)]))
    with pytest.raises(PySparkException, match="duplicate"):
        pivot_unique(dup, "table", "engine", "time_s", ENGINES).collect()


def test_arg_extremes(run_log):
    got = {r.table: r for r in arg_extremes(run_log, "table", "engine", "time_s", ENGINES).collect()}
    assert set(got) == {"t_small", "t_tie"}  # all-NULL table omitted
    assert (got["t_small"].fastest, got["t_small"].slowest) == ("DuckDB", "Spark")
    assert got["t_small"].speedup == 8.0
    assert (got["t_tie"].fastest, got["t_tie"].slowest) == ("Pandas", "Pandas")


def test_arg_extremes_tie_follows_report_order(run_log):
    order = ["DuckDB", "Pandas", "Spark"]
    got = {r.table: r for r in arg_extremes(run_log, "table", "engine", "time_s", order).collect()}
    assert (got["t_tie"].fastest, got["t_tie"].slowest) == ("DuckDB", "DuckDB")


def test_summary_formats(run_log):
    got = {r.table: r for r in reports.run_log_summary(run_log, ENGINES).collect()}
    assert got["t_small"].rows == "100,000"
    assert got["t_small"].fastest == "DuckDB (0.250s)"
    assert got["t_small"].slowest == "Spark (2.000s)"
    assert got["t_small"].speedup == "8.0x"
    assert "t_fail" not in got


def test_empty_log(spark):
    empty = spark.createDataFrame([], RUN_LOG_SCHEMA)
    p = reports.run_log_pivot(empty, ENGINES)
    assert p.count() == 0 and p.columns == ["table", "rows", "cols"] + ENGINES
    assert reports.run_log_summary(empty, ENGINES).count() == 0


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), ("a", 2, "w")], "k string, o int, v string")
    got = sorted(tuple(r) for r in first_per_key(df, "k", ["o"]).collect())
    assert got == [("a", 1, "y"), ("b", 2, "z")]
    got2 = sorted(tuple(r) for r in first_per_key(df.repartition(3), "k", ["o"]).collect())
    assert got == got2


def test_total_row_and_null_label(spark):
    steps = spark.createDataFrame(
        [("load", 1.25), ("query", 0.5), (None, 0.25)], "step string, time_s double")
    out = {r.step: r.time_s for r in reports.step_summary(steps).collect()}
    assert out == {"load": "1.250", "query": "0.500", None: "0.250", "TOTAL": "2.000"}
    direct = with_total_row(steps, "step", [("n", "count", None)]).collect()
    assert {r.step: r.n for r in direct}["TOTAL"] == 3


def test_order_by_position(spark):
    df = spark.createDataFrame([("Spark",), ("zzz",), ("Pandas",), ("DuckDB",)], "engine string")
    got = [r.engine for r in order_by_position(df, "engine", ENGINES).collect()]
    assert got == ["Pandas", "DuckDB", "Spark", "zzz"]


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (2, "c"), (2, "b")], "s int, n string")
    got = [tuple(r) for r in top_k(df, ["s"], 2).collect()]
    assert got == [(2, "a"), (2, "b")]


def test_zero_fastest_time_gives_infinite_speedup(spark):
    zlog = log(spark, [("t", 10, 2, "Pandas", 0.0), ("t", 10, 2, "DuckDB", 1.5),
                       ("z", 10, 2, "Pandas", 0.0), ("z", 10, 2, "DuckDB", 0.0)])
    ext = {r.table: r for r in arg_extremes(zlog, "table", "engine", "time_s", ENGINES).collect()}
    assert ext["t"].speedup == float("inf")
    assert ext["z"].speedup != ext["z"].speedup  # 0/0 is NaN
    summ = {r.table: r.speedup for r in reports.run_log_summary(zlog, ENGINES).collect()}
    assert summ == {"t": "infx", "z": "nanx"}


def test_pivot_rows_in_explicit_order(run_log):
    order = ["t_tie", "t_fail", "t_small"]
    got = [r.table for r in reports.run_log_pivot(run_log, ENGINES, order).collect()]
    assert got == order


def test_scalar_helpers(spark):
    from ledgerline.functions import scalar as S

    df = spark.createDataFrame([(7, "Alice", "Smith", 1234567, 0.5, "purchase")],
                               "n long, f string, l string, big long, x double, t string")
    r = df.select(
        S.thousands("big").alias("th"),
        S.fixed("x", 3).alias("fx"),
        S.fixed(F.lit(1.015), 2).alias("below_tie"),
        S.fixed(F.lit(1234567.125), 3).alias("big"),
        S.times_label(F.lit(2.25)).alias("lbl"),
        S.is_value("t", "purchase").alias("hit"),
    ).first()
    assert r.th == "1,234,567" and r.fx == "0.500" and r.hit == 1
    assert r.below_tie == f"{1.015:.2f}" and r.big == "1234567.125"
    assert r.lbl == "2.2x"  # an exact tie rounds half-even, as Python's f"{2.25:.1f}" does


def test_pivot_without_values_keeps_index(run_log):
    got = sorted(r.table for r in pivot_unique(run_log, "table", "engine", "time_s", []).collect())
    assert got == ["t_fail", "t_small", "t_tie"]


def test_nan_time_is_skipped_like_pandas(spark):
    nlog = log(spark, [("t", 10, 2, "Pandas", float("nan")), ("t", 10, 2, "DuckDB", 1.5),
                       ("t", 10, 2, "Spark", 3.0)])
    got = arg_extremes(nlog, "table", "engine", "time_s", ENGINES).first()
    assert (got.fastest, got.slowest, got.speedup) == ("DuckDB", "Spark", 2.0)


def test_unlisted_values_raise(spark, run_log):
    sixth = run_log.unionByName(log(spark, [("t_small", 100000, 10, "Sixth", 3.0)]))
    for got in (pivot_unique(sixth, "table", "engine", "time_s", ENGINES),
                pivot_sum(sixth, "table", "engine", "time_s", ENGINES, 2),
                arg_extremes(sixth, "table", "engine", "time_s", ENGINES)):
        with pytest.raises(PySparkException, match="list|order"):
            got.collect()
    chosen = pivot_unique(sixth, "table", "engine", "time_s", ENGINES, selection=True).collect()
    assert {r.table for r in chosen} == {"t_small", "t_tie", "t_fail"}
    twice = sixth.unionByName(log(spark, [("t_small", 100000, 10, "Sixth", 4.0)]))
    with pytest.raises(PySparkException, match="duplicate"):
        pivot_unique(twice, "table", "engine", "time_s", ENGINES, selection=True).collect()


def test_report_rows_in_a_list_that_names_a_missing_table(run_log):
    with pytest.raises(PySparkException, match="no row"):
        reports.run_log_pivot(run_log, ENGINES, ["t_tie", "nowhere"]).collect()
    got = [r.table for r in reports.run_log_summary(run_log, ENGINES, ["t_tie", "t_small"]).collect()]
    assert got == ["t_tie", "t_small"]
    assert [r.table for r in reports.run_log_summary(run_log, ENGINES).collect()] == ["t_small", "t_tie"]


def test_first_per_key_with_null_order_and_keys(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", None, "y"), (None, 2, "z"), (None, 1, "w"), ("b", 1, "q"), ("b", 1, "p")],
        "k string, o int, v string")
    got = sorted((tuple(r) for r in first_per_key(df, "k", ["o"]).collect()), key=str)
    assert got == sorted([("a", None, "y"), (None, 1, "w"), ("b", 1, "p")], key=str)


@pytest.mark.parametrize("op", ["first", "extremes", "pivot", "total"])
def test_report_operators_hash_and_pre_aggregate(spark, op):
    """Skew safety: a partial hash aggregate runs in every task before the
    shuffle (a hot key arrives pre-reduced); raw rows are neither sorted for it,
    nor multiplied, nor windowed; the pivot and extremes shuffle once."""
    import contextlib
    import io

    from ledgerline.sources.tables import Tables
    from tests.conftest import SF001

    ev = Tables(spark, SF001).events
    df = {
        "first": lambda: reports.events_first_per_user(ev),
        "extremes": lambda: reports.events_arg_extremes(ev),
        "pivot": lambda: reports.events_pivot(ev),
        "total": lambda: reports.events_total_row(ev),
    }[op]()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "Window" not in plan and "Expand" not in plan and "partial_" in plan
    if op != "first":  # its struct minimum sees the tied rows only, after the join
        assert "Sort" not in plan
    if op in ("extremes", "pivot"):
        assert plan.count("Exchange") == 1
