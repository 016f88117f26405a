"""Namespaces, sinks, listing, seed/verify jobs and the
timed-run log (session catalog in a per-run scratch warehouse)."""

from pyspark.sql import functions as F

from ledgerline.plans import reports, seed, timing
from ledgerline.sources import catalog
from ledgerline.sources import generate as G
from ledgerline.sources.tables import Tables
from tests.conftest import SF001


def test_namespace_is_idempotent(spark):
    catalog.create_namespace(spark, "ll_ns")
    catalog.create_namespace(spark, "ll_ns")
    names = [r[0] for r in spark.sql("SHOW NAMESPACES").collect()]
    assert "ll_ns" in names


def test_replace_then_append(spark):
    catalog.create_namespace(spark, "ll_sink")
    ev = Tables(spark, SF001).events
    batches = [ev.where(F.col("event_id") % 4 == i) for i in range(4)]
    assert catalog.write_batches(batches, "ll_sink.events_copy") == 4
    total = ev.count()
    assert spark.read.table("ll_sink.events_copy").count() == total
    # replace again: previous contents are gone
    catalog.write_table(batches[0], "ll_sink.events_copy", "replace")
    assert spark.read.table("ll_sink.events_copy").count() == batches[0].count()
    catalog.write_table(batches[1], "ll_sink.events_copy", "append")
    assert spark.read.table("ll_sink.events_copy").count() == batches[0].count() + batches[1].count()


def test_list_tables_and_describe(spark):
    catalog.create_namespace(spark, "ll_list")
    catalog.write_table(G.products(spark), "ll_list.products")
    got = {(r.namespace, r.table) for r in catalog.list_tables(spark, ["ll_list"]).collect()}
    assert got == {("ll_list", "products")}
    desc = {r.col_name: r.data_type for r in catalog.describe(spark, "ll_list.products").collect()}
    assert desc["price"] == "decimal(10,2)"


def test_seed_and_verify_ecommerce(spark):
    sizes = {"customers": 50, "orders": 1000, "clickstream": 2000, "recommendations": 500}
    counts = {r.table: r.rows for r in seed.seed_ecommerce(spark, "ll_shop", sizes=sizes).collect()}
    assert counts == {
        "ll_shop.products": 10, "ll_shop.customers": 50, "ll_shop.orders": 1000,
        "ll_shop.clickstream": 2000, "ll_shop.recommendations": 500,
    }
    v = {r.table: r.rows for r in seed.verify(spark, list(counts), show=False).collect()}
    assert v == counts
    o = spark.read.table("ll_shop.orders")
    assert o.join(spark.read.table("ll_shop.customers"), "customer_id", "left_anti").count() == 0


def test_seed_wide_batched_equals_single_write(spark):
    cfg = [("w_small", 12, 1200)]
    one = {r.table: r.rows for r in seed.seed_wide(spark, "ll_wide1", configs=cfg).collect()}
    many = {r.table: r.rows for r in seed.seed_wide(spark, "ll_wide2", configs=cfg, batch_rows=500).collect()}
    assert one == {"ll_wide1.w_small": 1200} and many == {"ll_wide2.w_small": 1200}
    a, b = spark.read.table("ll_wide1.w_small"), spark.read.table("ll_wide2.w_small")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_shapes(spark):
    t = Tables(spark, SF001)
    got = {r.table: (r.rows, r.cols) for r in catalog.shapes({"part": t.part, "events": t.events}).collect()}
    assert got["part"][1] == 6 and got["events"][1] == 6
    assert got["part"][0] == t.part.count()


def test_timed_run_log_and_reports(spark):
    t = Tables(spark, SF001)
    log = timing.run_benchmark(spark, {"orders": t.orders, "customer": t.customer})
    rows = log.collect()
    assert len(rows) == 4
    assert all(r.time_s is not None and r.time_s >= 0 and r.error is None for r in rows)
    assert {r.engine for r in rows} == set(timing.FORMS)
    piv = reports.run_log_pivot(log, list(timing.FORMS)).collect()
    assert {r.table for r in piv} == {"orders", "customer"}
    summ = reports.run_log_summary(log, list(timing.FORMS)).collect()
    assert all(r.speedup.endswith("x") for r in summ)
    catalog.create_namespace(spark, "ll_runs")
    catalog.write_table(log, "ll_runs.run_log", "append")
    assert spark.read.table("ll_runs.run_log").count() >= 4


def test_failed_run_is_recorded_as_null(spark):
    secs, err = timing.timed(lambda: spark.sql("SELECT * FROM no_such_table_xyz").collect())
    assert secs is None and err is not None


def test_step_summary_from_timings(spark):
    steps = timing.step_log(spark, {"1. Load": 0.5, "2. Query": 0.25})
    out = {r.step: r.time_s for r in reports.step_summary(steps).collect()}
    assert out["TOTAL"] == "0.750"


def _exchanges(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return [line for line in buf.getvalue().splitlines() if "Exchange hashpartitioning" in line]


def test_bucketed_seed_tables_skip_shuffles(spark):
    from ledgerline.plans import retail

    sizes = {"customers": 40, "orders": 800, "clickstream": 1000, "recommendations": 100}
    seed.seed_ecommerce(spark, "ll_bkt", sizes=sizes, buckets=4)
    o, c, p = (spark.read.table(f"ll_bkt.{t}") for t in ("orders", "customers", "products"))
    # one task per bucket: about 4 files, not one per (write task, bucket)
    assert len(o.inputFiles()) <= 8
    cs = spark.read.table("ll_bkt.clickstream")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:  # the 100 TB regime: nothing is small enough to broadcast
            spark.conf.set(k, "-1")
        q3 = retail.order_enrichment(o, c, p)
        assert not any("customer_id" in line for line in _exchanges(q3))
        q4 = retail.session_summary(cs)
        assert _exchanges(q4) == []
        # results are unchanged by the layout
        flat = {t: spark.read.table(f"ll_bkt.{t}").repartition(3) for t in ("orders", "customers")}
        assert sorted(map(tuple, q3.collect())) == sorted(
            map(tuple, retail.order_enrichment(flat["orders"], flat["customers"], p).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_local_frame_helpers(spark):
    import pandas as pd

    from ledgerline.sources.tables import from_pandas, to_pandas

    df = from_pandas(spark, pd.DataFrame({"a": [1, 2, 3]}))
    assert to_pandas(df)["a"].tolist() == [1, 2, 3]


def test_counts_and_null_check_in_one_pass(spark):
    import pytest
    from pyspark.errors import PySparkException

    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    ok = catalog.checked_row_counts({"t": (df, []), "u": (df.where("x > 0"), ["x"])}).collect()
    assert {r.table: r.rows for r in ok} == {"t": 3, "u": 2}
    with pytest.raises(PySparkException, match="NOT NULL"):
        catalog.checked_row_counts({"t": (df, ["x"])}).collect()
    empty = catalog.checked_row_counts({"t": (df.limit(0), ["x"])}).first()
    assert empty.rows == 0


def test_names_are_quoted(spark):
    assert catalog.quoted("cat.my-space.t`1") == "`cat`.`my-space`.`t``1`"
    catalog.create_namespace(spark, "ll_odd_space")
    catalog.write_table(spark.range(3), "ll_odd_space.t", "replace")
    assert [tuple(r) for r in catalog.list_tables(spark, ["ll_odd_space"]).collect()] == [("ll_odd_space", "t")]
    assert catalog.list_tables(spark, ["spark_catalog.ll_odd_space"]).count() == 1


def test_package_zip_imports_in_a_clean_interpreter(tmp_path):
    import subprocess
    import sys

    from ledgerline.session import package_zip

    path = tmp_path / "ledgerline.zip"
    path.write_bytes(package_zip())
    code = (f"import sys; sys.path.insert(0, {str(path)!r}); import ledgerline.plans.retail as r; "
            "assert '.zip' in r.__file__; print(r.TIER_COLUMNS[-1])")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True,
                         env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)})
    assert out.stdout.strip() == "margin_tier"


def test_shipping_errors_are_raised_and_retried():
    import pytest

    from ledgerline.session import ship_package

    class Context:
        applicationId, calls = "app-test-ship", 0

        def addPyFile(self, path):
            self.calls += 1
            if self.calls == 1:
                raise OSError("no room")

    class Session:
        sparkContext = Context()

    with pytest.raises(OSError):
        ship_package(Session())
    ship_package(Session())
    ship_package(Session())
    assert Session.sparkContext.calls == 2


def test_timed_steps(spark):
    t = Tables(spark, SF001)
    log, errors = timing.timed_steps(spark, {
        "scan": lambda: t.orders,
        "broken": lambda: spark.sql("SELECT * FROM no_such_table_abc"),
    })
    rows = {r.step: r.time_s for r in log.collect()}
    assert rows["scan"] is not None and rows["broken"] is None
    assert set(errors) == {"broken"}
    out = [r.step for r in reports.step_summary(log).collect()]
    assert out == ["scan", "broken", "TOTAL"]


def test_not_null_check(spark):
    import pytest

    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    got = {r.column: r.nulls for r in catalog.null_counts(df).collect()}
    assert got == {"x": 1, "y": 1}
    catalog.check_not_null(df.where("x IS NOT NULL AND y IS NOT NULL"))
    with pytest.raises(ValueError, match="NOT NULL"):
        catalog.check_not_null(df, ["x"])


class _StubContext:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _StubConf:
    def __init__(self, values):
        self.values = values

    def get(self, k, default=None):
        return self.values.get(k, default)


class _StubSession:
    def __init__(self, master, confs=None, current=None):
        self.sparkContext = _StubContext(master, current)
        self.conf = _StubConf(confs or {})


def test_checkpoint_dir_policy():
    """The cluster's shared spark.checkpoint.dir is used as-is; only a local
    session without one gets a scratch folder; a cluster without one fails."""
    import pytest

    from ledgerline.session import ensure_checkpoint_dir

    shared = "hdfs://nn/shared/ckpt"
    s = _StubSession("spark://head:7077", {"spark.checkpoint.dir": shared})
    assert ensure_checkpoint_dir(s) == shared
    assert ensure_checkpoint_dir(_StubSession("yarn", current="s3a://b/ck")) == "s3a://b/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_StubSession("k8s://api:443"))
    local = ensure_checkpoint_dir(_StubSession("local[2]"))
    assert local and "ledgerline-ckpt-" in local


class _ConnectLikeSession:
    """No client-side SparkContext (as under Spark Connect)."""

    def __init__(self, confs):
        self.conf = _StubConf(confs)

    @property
    def sparkContext(self):
        raise RuntimeError("not available")


def test_checkpoint_dir_without_spark_context():
    from ledgerline.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(_ConnectLikeSession({"spark.checkpoint.dir": "s3a://b/ck"})) == "s3a://b/ck"
    assert ensure_checkpoint_dir(_ConnectLikeSession({})) == ""


def test_only_one_process_gets_a_scratch_checkpoint_folder():
    from ledgerline.session import runs_in_one_process

    assert [runs_in_one_process(m) for m in ("local", "local[*]", "local[8]", "local-cluster[3,2,1024]", "yarn", "spark://h:7077")] == [
        True, True, True, False, False, False]
