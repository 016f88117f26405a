"""Catalog namespaces, table sinks and table
reports.

Sinks pick the write path from the table name: a name whose first part is
a configured V2 catalog (``spark.sql.catalog.<name>`` is set, e.g. a
table-format catalog) uses ``DataFrameWriterV2`` (``createOrReplace`` /
``append``); a session-catalog name uses ``saveAsTable`` with overwrite /
append, because the V2 calls are unsupported on V1 tables there.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _v2_catalog(spark: SparkSession, fqn: str) -> str | None:
    head = fqn.split(".", 1)[0]
    if "." in fqn and spark.conf.get(f"spark.sql.catalog.{head}", None):
        return head
    return None


def quoted(name: str) -> str:
    """A dotted name with every part in backticks."""
    return ".".join(f"`{p.strip('`').replace('`', '``')}`" for p in name.split("."))


def create_namespace(spark: SparkSession, namespace: str) -> None:
    """Idempotent ``CREATE NAMESPACE IF NOT EXISTS``."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(namespace)}")


def list_tables(spark: SparkSession, namespaces: Iterable[str] | None = None) -> DataFrame:
    """``(namespace, table)`` for every table of the given namespaces,
    which may name a catalog (default: all of the current one). Catalog
    metadata only."""
    if namespaces is None:
        namespaces = [r[0] for r in spark.sql("SHOW NAMESPACES").collect()]
    parts = [
        spark.sql(f"SHOW TABLES IN {quoted(ns)}").where(~F.col("isTemporary")).select(
            F.lit(ns).alias("namespace"), F.col("tableName").alias("table")
        )
        for ns in namespaces
    ]
    if not parts:
        return spark.createDataFrame([], "namespace string, table string")
    return reduce(DataFrame.unionByName, parts)


def write_table(
    df: DataFrame,
    fqn: str,
    mode: str = "replace",
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
    partition_by: Iterable[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """S8 (``mode="replace"``) and S9 (``mode="append"``): one distributed
    write; every task writes its own files, nothing goes through the driver.

    ``bucket_by=(n, cols)`` stores the table hash-bucketed on ``cols``:
    later joins and aggregations on those keys between tables bucketed the
    same way read co-located data and skip the shuffle. The rows are first
    rebalanced into ``n`` hash partitions on the same keys, so each bucket
    is written by one task (about ``n`` files instead of one per task and
    bucket); AQE still splits an oversized (skewed) bucket over several
    tasks, so a hot key does not become a single straggler.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")
    spark = df.sparkSession
    partition_by = list(partition_by)
    if _v2_catalog(spark, fqn):
        w = df.writeTo(fqn)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", str(max_records_per_file))
        if mode == "append":
            w.append()
        else:
            w = w.using(fmt)
            parts = [F.col(c) for c in partition_by]
            if bucket_by:
                from pyspark.sql.functions import partitioning

                n, cols = bucket_by
                if len(cols) != 1:
                    # a transform per column would make n^m buckets, not n on the tuple
                    raise ValueError("a V2 table is bucketed on one column")
                parts.append(partitioning.bucket(n, F.col(cols[0])))
            if parts:
                w = w.partitionedBy(*parts)
            w.createOrReplace()
        return
    src = df.hint("rebalance", bucket_by[0], *bucket_by[1]) if bucket_by else df
    w = src.write.format(fmt).mode("overwrite" if mode == "replace" else "append")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(fqn)


def write_batches(batches: Iterable[DataFrame], fqn: str, fmt: str = "parquet") -> int:
    """The first batch replaces the table, later batches append.

    Kept for callers that receive data in batches; generated tables are
    written in one distributed write instead (see ``plans.seed``)."""
    n = 0
    for i, b in enumerate(batches):
        write_table(b, fqn, "replace" if i == 0 else "append", fmt)
        n += 1
    return n


def read_table(spark: SparkSession, fqn: str) -> DataFrame:
    """``spark.read.table``."""
    return spark.read.table(fqn)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` per named frame, as one union of
    aggregates (each a distributed count)."""
    if not frames:
        raise ValueError("row_counts needs at least one table")
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), F.col("rows"))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def shapes(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows, cols)`` per named frame (pandas ``df.shape``)."""
    if not frames:
        raise ValueError("shapes needs at least one table")
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.col("rows"), F.lit(len(df.columns)).alias("cols")
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL cells per column, in one aggregation pass: ``(column, nulls)``."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in cols])
    return wide.select(F.inline(pairs))


def checked_row_counts(frames: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table, rows)`` per named ``(frame, NOT NULL columns)``, read back in
    one pass that also counts the NULLs of those columns: a table with any
    raises when the counts are read. Parquet does not keep NOT NULL itself."""
    if not frames:
        raise ValueError("checked_row_counts needs at least one table")
    parts = []
    for name, (df, cols) in frames.items():
        nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in cols), F.lit(0))
        one = df.agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("nulls"))
        parts.append(one.select(F.lit(name).alias("table"), F.when(
            F.col("nulls") > 0, F.raise_error(F.lit(f"NOT NULL violated in {name}"))).otherwise(F.col("n")).alias("rows")))
    return reduce(DataFrame.unionByName, parts)


def check_not_null(df: DataFrame, columns: Sequence[str] | None = None, name: str = "table") -> None:
    """Raise if any of ``columns`` (default: all) holds a NULL."""
    bad = {r.column: r.nulls for r in null_counts(df, columns).where(F.col("nulls") > 0).collect()}
    if bad:
        raise ValueError(f"NOT NULL violated in {name}: {bad}")


def describe(spark: SparkSession, fqn: str) -> DataFrame:
    """S13 as a table: column name and type (``DESCRIBE TABLE``)."""
    return spark.sql(f"DESCRIBE TABLE {quoted(fqn)}").where(~F.col("col_name").startswith("#")).select(
        "col_name", "data_type"
    )


def show(df: DataFrame, n: int = 20) -> None:
    """Print the first n rows untruncated (``PRINT`` / ``show``)."""
    df.show(n, truncate=False)
