"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline import session
from ledgerline.session import runs_in_one_process


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors and bound what their Python workers get at once."""
    session.ship_package(spark)
    session.bound_arrow_batches(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one input table; the path is opened by Spark only. The
    package is sent to the executors, whose tasks import it."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    A local-mode session without the setting gets a scratch folder; a cluster
    without it is an error, so that nothing lands on one machine's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not runs_in_one_process(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder; safe against lost executors.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` the files go
    when the frame is garbage collected.
    """
    ship_package(df.sparkSession)
    shared_dir(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    a columnar lineage cut whose later scans prune columns."""
    spark = df.sparkSession
    ship_package(spark)
    path = os.path.join(shared_dir(spark), f"ledgerline-{label}-{uuid.uuid4().hex}")
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: dict[str, list[str]] = {}


def remove_written(spark: SparkSession) -> int:
    """Delete the folders that ``written`` made in this application and return
    their number. Results that were not stored elsewhere can't be read any more,
    so call it when the last of them has been."""
    paths, jvm = _WRITTEN.pop(spark.sparkContext.applicationId, []), spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def held_out(id_col: str, mod: int, rest: int) -> Column:
    """True for rows whose crc32(id as text) mod ``mod`` equals ``rest``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == rest, F.lit(False))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the least xxhash64 of ``key``: a repeatable
    uniform sample of labelled rows, used only to fit models."""
    return df.orderBy(F.xxhash64(F.col(key).cast("string"))).limit(rows)
