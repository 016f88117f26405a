"""Restartable loads and checks in the write pass.

A load writes its batches into folders of their own and keeps its ledger in the
catalog: the load's table is partitioned by batch, and a batch counts from the
moment its partition is added, one metadata operation after its files are
complete. A batch that the ledger has is skipped, so a failed load is run again
as it is and holds every row once; files of an attempt that failed belong to no
partition and are never read.

Readers use the table's name, which is a view over the load that is current.
``publish`` replaces the view, again one metadata operation: they see the old
rows or the new ones, never a mixture or nothing. Batches that are added to the
published load appear one whole batch at a time (append).

This is for catalogs whose tables are folders of files. A table format with
snapshots does all of it in its own commits; ``catalog.write_table`` uses those.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.catalog import quoted

BATCH = "load_batch"


def _observed(df: DataFrame, not_null: Sequence[str], key: str | None) -> tuple[DataFrame, Observation]:
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"nulls_{c}") for c in not_null]
    if key:
        metrics += [F.min(key).alias("least"), F.max(key).alias("greatest")]
    return df.observe(seen, *metrics), seen


def write_observed(
    df: DataFrame, write: Callable[[DataFrame], object], not_null: Sequence[str] = (), key: str | None = None
) -> dict:
    """What ``write`` wrote, measured in the write's own job: ``rows``,
    ``nulls_<column>`` of each column in ``not_null`` and, with ``key``, its
    ``least`` and ``greatest`` value. ``write`` gets the frame and must run one
    job over it. Nothing is read back. A write that does not shuffle the frame
    again (no bucketing) counts every partition's successful attempt once, also
    when executors are lost."""
    observed, seen = _observed(df, not_null, key)
    write(observed)
    return dict(seen.get)


def refuse_nulls(metrics: dict, name: str) -> None:
    """Raise if observed metrics hold a NULL in a NOT NULL column."""
    bad = {k.removeprefix("nulls_"): n for k, n in metrics.items() if k.startswith("nulls_") and n}
    if bad:
        raise ValueError(f"NOT NULL violated in {name}: {bad}")


class Load:
    """A restartable load of the table ``fqn``, known by ``load_id``: the same id
    goes on with the same load, a new one starts a replacement."""

    def __init__(self, spark: SparkSession, fqn: str, load_id: str, root: str, fmt: str = "parquet"):
        if not re.fullmatch(r"\w+", load_id):
            raise ValueError(f"a load id is letters, digits and _, not {load_id!r}")
        self.spark, self.fqn, self.fmt = spark, fqn, fmt
        self.table = f"{fqn}__load_{load_id}"
        self.folder = f"{root.rstrip('/')}/{self.table.replace('.', '/')}"

    def batches(self) -> list[str]:
        """The ids of the batches that are in: the ledger."""
        if not self.spark.catalog.tableExists(self.table):
            return []
        parts = self.spark.sql(f"SHOW PARTITIONS {quoted(self.table)}").collect()
        return sorted(r[0].removeprefix(f"{BATCH}=") for r in parts)

    def add(self, batch_id: str, df: DataFrame, not_null: Sequence[str] = (), key: str | None = None) -> dict | None:
        """Write one batch, or skip it (None) if the ledger has it. Returns the
        metrics of ``write_observed``. NULLs in a NOT NULL column raise before
        the batch counts."""
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"a batch id is letters, digits, _ . and -, not {batch_id!r}")
        if BATCH in df.columns:
            raise ValueError(f"{BATCH} is the ledger's column")
        if batch_id in self.batches():
            return None
        # a folder that no earlier attempt has written into
        folder = f"{self.folder}/{batch_id}-{uuid.uuid4().hex}"
        metrics = write_observed(df, lambda d: d.write.format(self.fmt).save(folder), not_null, key)
        refuse_nulls(metrics, self.table)
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(self.table)} ({columns}, {BATCH} string) "
                       f"USING {self.fmt} PARTITIONED BY ({BATCH}) LOCATION '{self.folder}'")
        known = [f.name for f in self.spark.read.table(self.table).schema.fields if f.name != BATCH]
        if known != df.columns:
            raise ValueError(f"{self.table} has columns {known}, the batch has {df.columns}")
        # fails if another writer has added the batch meanwhile; its files count then, these don't
        self.spark.sql(f"ALTER TABLE {quoted(self.table)} ADD PARTITION ({BATCH} = '{batch_id}') LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.table)
        return metrics

    def publish(self) -> None:
        """Make this load what readers of ``fqn`` see."""
        if not self.batches():
            raise ValueError(f"{self.table} has no batch to publish")
        columns = ", ".join(quoted(f.name) for f in self.spark.read.table(self.table).schema.fields if f.name != BATCH)
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(self.fqn)} AS SELECT {columns} FROM {quoted(self.table)}")


def load_batches(
    spark: SparkSession, batches: Iterable[tuple[str, Callable[[], DataFrame]]], fqn: str, load_id: str, root: str,
    not_null: Sequence[str] = (), key: str | None = None,
) -> dict[str, dict | None]:
    """Write ``(batch id, frame builder)`` pairs and publish them together.
    Run again after a failure with the same ``load_id``, it builds and writes
    only the batches that are missing. Returns the metrics of each batch
    written, None for those it skipped."""
    load, out = Load(spark, fqn, load_id, root), {}
    there = set(load.batches())
    for batch_id, build in batches:
        out[batch_id] = None if batch_id in there else load.add(batch_id, build(), not_null, key)
    load.publish()
    return out
