"""Q14–Q16: seed and verify jobs.

The reference builds rows in Python loops on the driver and writes wide
tables in 50k-row batches to bound driver memory. Here every table is one
``spark.range`` job with expression columns (``ledgerline.sources.
generate``) and one distributed write, so the job scales with executors
and no row passes through the driver; file sizes are bounded with
``maxRecordsPerFile`` instead of batching.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources import catalog
from ledgerline.sources import generate as G
from ledgerline.sources.loads import refuse_nulls, write_observed

ECOMMERCE_TABLES = ("products", "customers", "orders", "clickstream", "recommendations")


def _fqn(catalog_name: str | None, namespace: str, table: str) -> str:
    return f"{catalog_name}.{namespace}.{table}" if catalog_name else f"{namespace}.{table}"


def seed_ecommerce(
    spark: SparkSession,
    namespace: str = "ecommerce",
    catalog_name: str | None = None,
    sizes: dict | None = None,
    fmt: str = "parquet",
    max_records_per_file: int = 5_000_000,
    buckets: int | None = None,
) -> DataFrame:
    """Q14: namespace → five tables → ``(table, rows)`` counts, taken as they are written.

    With ``buckets`` (size it so one bucket is ~128–512 MB at the target
    scale), customers and orders are bucketed on ``customer_id`` and
    clickstream on ``session_id``: the order/customer join (Q3) and the
    per-session aggregation (Q4) then read co-located data without a shuffle
    even when no side can be broadcast. It is opt-in because a bucketed scan
    reads each bucket in one task, so a hot key (a customer with a third of
    all orders) becomes a straggler that AQE cannot split; unbucketed, the
    same join is a shuffle whose skewed partitions AQE does split. Use it
    when the bucket keys are known to be balanced.
    """
    by_customer = (buckets, ["customer_id"]) if buckets else None
    by_session = (buckets, ["session_id"]) if buckets else None
    n = {
        "customers": G.NUM_CUSTOMERS, "orders": G.NUM_ORDERS,
        "clickstream": G.NUM_CLICKSTREAM, "recommendations": G.NUM_RECOMMENDATIONS,
    }
    n.update(sizes or {})
    ns = f"{catalog_name}.{namespace}" if catalog_name else namespace
    catalog.create_namespace(spark, ns)
    fq = {t: _fqn(catalog_name, namespace, t) for t in ECOMMERCE_TABLES}

    clicks = G.clickstream(G.id_range(spark, n["clickstream"], n["customers"], seed=G.SEED_CLICKS))
    clicks = clicks.withColumn("timestamp", clicks["timestamp"].cast("timestamp"))  # instants, in the session's time zone
    frames = {
        "products": (G.products(spark), None),
        "customers": (G.customers(G.id_range(spark, n["customers"])), by_customer),
        "orders": (G.orders(G.id_range(spark, n["orders"], n["customers"], seed=G.SEED_ORDERS), G.products(spark)), by_customer),
        "clickstream": (clicks, by_session),
        "recommendations": (
            G.recommendations(G.id_range(spark, n["recommendations"], n["customers"], seed=G.SEED_RECS)), None),
    }
    # every e-commerce column is declared NOT NULL
    return _written(spark, {
        fq[t]: (frames[t][0], frames[t][0].columns, frames[t][1]) for t in ECOMMERCE_TABLES}, fmt, max_records_per_file)


def _written(spark: SparkSession, tables: dict, fmt: str, max_records_per_file: int) -> DataFrame:
    """Write ``name -> (frame, NOT NULL columns, buckets)`` and return ``(table,
    rows)``. Rows and NULLs are measured in the write's own job; a bucketed table
    is shuffled by its write, so it is read back instead."""
    counted, read_back = [], {}
    for fqn, (df, not_null, buckets) in tables.items():
        def write(d: DataFrame, fqn=fqn, buckets=buckets) -> None:
            catalog.write_table(d, fqn, "replace", fmt, max_records_per_file, bucket_by=buckets)

        if buckets:
            write(df)
            read_back[fqn] = (spark.read.table(fqn), not_null)
        else:
            metrics = write_observed(df, write, not_null)
            refuse_nulls(metrics, fqn)
            counted.append((fqn, metrics["rows"]))
    out = spark.createDataFrame(counted, "table string, rows long")
    return out.unionByName(catalog.checked_row_counts(read_back)) if read_back else out


# the ten fixed columns of the wide tables are NOT NULL; generated ones may be NULL
WIDE_NOT_NULL = ["id", "category", "region", "status", "priority", "created_date", "amount", "score",
                 "flag", "description"]


def seed_wide(
    spark: SparkSession,
    namespace: str = "benchmark",
    catalog_name: str | None = None,
    configs=None,
    fmt: str = "parquet",
    batch_rows: int | None = None,
    max_records_per_file: int = 5_000_000,
) -> DataFrame:
    """Q15: namespace → wide tables → counts.

    Default: one distributed write per table. With ``batch_rows`` the table
    is written as id ranges of that size, the first replacing and the rest
    appending (S10) — still generated on executors, never on the driver.
    """
    configs = configs or G.WIDE_TABLES
    ns = f"{catalog_name}.{namespace}" if catalog_name else namespace
    catalog.create_namespace(spark, ns)
    written, whole = {}, {}
    for name, cols, rows in configs:
        fqn = _fqn(catalog_name, namespace, name)
        seed = G.SEED_WIDE.get(name, 50)
        if batch_rows:
            batches = (
                G.wide(spark.range(start, min(start + batch_rows, rows + 1)), cols, seed)
                for start in range(1, rows + 1, batch_rows)
            )
            catalog.write_batches(batches, fqn, fmt)
            written[fqn] = (spark.read.table(fqn), WIDE_NOT_NULL)
        else:
            whole[fqn] = (G.wide(G.id_range(spark, rows), cols, seed), WIDE_NOT_NULL, None)
    if written:
        return catalog.checked_row_counts(written)
    return _written(spark, whole, fmt, max_records_per_file)


def verify(spark: SparkSession, fqns, sample_rows: int = 10, show: bool = True) -> DataFrame:
    """Q16: row count per table; with ``show``, also print each schema and
    ``sample_rows`` rows (S12, S13)."""
    frames = {f: spark.read.table(f) for f in fqns}
    if show:
        for f, df in frames.items():
            print(f"== {f}")
            df.printSchema()
            catalog.show(df, sample_rows)
    return catalog.row_counts(frames)
