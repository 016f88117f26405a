import os

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import loads as L


@pytest.fixture()
def place(spark, tmp_path):
    name = f"loads_{tmp_path.name}".replace("-", "_").replace("[", "_").replace("]", "_")
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")
    return f"{name}.facts", str(tmp_path / "root")


def batch(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id"), (F.col("id") * 2).alias("v"))


def ids(spark, fqn):
    return sorted(r.id for r in spark.read.table(fqn).collect())


def test_a_failed_load_is_run_again(spark, place):
    fqn, root = place
    L.load_batches(spark, [("old", lambda: batch(spark, 900, 905))], fqn, "first", root)
    built = []

    def run(fails):
        def build(lo):
            built.append(lo)
            if lo == 20 and fails:  # half of the batch's files are written when a task fails
                return batch(spark, 20, 30).repartition(4).withColumn(
                    "v", F.when(F.col("id") == 27, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
            return batch(spark, lo, lo + 10)
        return L.load_batches(spark, [(f"b{lo}", lambda lo=lo: build(lo)) for lo in (0, 10, 20, 30)], fqn, "second", root,
                              not_null=["id"], key="id")

    with pytest.raises(Exception, match="lost"):
        run(True)
    assert ids(spark, fqn) == list(range(900, 905))  # readers still see the old load, all of it
    got = run(False)
    assert ids(spark, fqn) == list(range(40)) and built == [0, 10, 20, 20, 30]
    assert got == {"b0": None, "b10": None, "b20": {"rows": 10, "nulls_id": 0, "least": 20, "greatest": 29},
                   "b30": {"rows": 10, "nulls_id": 0, "least": 30, "greatest": 39}}
    assert set(run(False).values()) == {None} and ids(spark, fqn) == list(range(40))


def test_appended_batches_count_once(spark, place):
    fqn, root = place
    load = L.Load(spark, fqn, "only", root)
    assert load.add("a", batch(spark, 0, 3)) == {"rows": 3}
    load.publish()
    assert load.add("b", batch(spark, 3, 5)) == {"rows": 2} and load.add("b", batch(spark, 3, 5)) is None
    assert ids(spark, fqn) == list(range(5)) and load.batches() == ["a", "b"]
    assert spark.read.table(fqn).columns == ["id", "v"]


def test_bad_batches_never_count(spark, place):
    fqn, root = place
    load = L.Load(spark, fqn, "only", root)
    load.add("a", batch(spark, 0, 3))
    load.publish()
    with pytest.raises(ValueError, match="NOT NULL violated"):
        load.add("b", batch(spark, 3, 5).withColumn("v", F.lit(None).cast("long")), not_null=["v"])
    with pytest.raises(ValueError, match="has columns"):
        load.add("c", batch(spark, 3, 5).select("v", "id"))
    with pytest.raises(ValueError, match="ledger's column"):
        load.add("d", batch(spark, 3, 5).withColumn(L.BATCH, F.lit(1)))
    for bad in ("", "a b", "x'"):
        with pytest.raises(ValueError):
            load.add(bad, batch(spark, 0, 1))
    with pytest.raises(ValueError, match="no batch"):
        L.Load(spark, fqn, "none", root).publish()
    assert ids(spark, fqn) == [0, 1, 2] and load.batches() == ["a"]


def test_empty_batches(spark, place):
    fqn, root = place
    assert L.load_batches(spark, [("a", lambda: batch(spark, 0, 0))], fqn, "e", root, key="id") == {
        "a": {"rows": 0, "least": None, "greatest": None}}
    assert ids(spark, fqn) == []


def test_checks_take_one_job(spark, tmp_path):
    """The metrics are those of the written table, and nothing is read for them."""
    df = batch(spark, 5, 505).repartition(7).withColumn("w", F.when(F.col("id") % 5 != 0, F.col("id")))
    sc = spark.sparkContext
    sc.setJobGroup("observed", "observed")
    path = str(tmp_path / "t")
    got = L.write_observed(df, lambda d: d.write.parquet(path), not_null=["id", "w"], key="id")
    jobs = sc.statusTracker().getJobIdsForGroup("observed")
    sc.setLocalProperty("spark.jobGroup.id", None)
    back = spark.read.parquet(path)
    assert got == {"rows": back.count(), "nulls_id": 0, "nulls_w": back.filter("w IS NULL").count(),
                   "least": 5, "greatest": 504}
    # the shuffle of the repartition is a job of its own under adaptive execution
    assert len(jobs) <= 2 and os.path.exists(path)
    with pytest.raises(ValueError, match="'w': 100"):
        L.refuse_nulls(got, "t")
