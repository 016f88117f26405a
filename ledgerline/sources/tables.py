"""Parquet table sources (S3/S4) for the driver-generated tables.

Tables are read lazily; pipelines select only the columns they use, so the
Parquet scan's ``ReadSchema`` is narrowed and ``WHERE`` clauses become
``PushedFilters``. Nothing here triggers a job.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# The table names the driver writes under each scale-factor folder.
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Declared schemas of the driver tables the pipelines read.
# Declaring them (instead of inferring from Parquet footers) is the usual
# production practice and skips a footer read per table on the driver.
DECLARED_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, infer: bool = False) -> DataFrame:
    """Full-table scan by name (S3). Projection/filters are applied by callers."""
    path = table_path(sf_dir, name)
    if not infer and name in DECLARED_SCHEMAS:
        return spark.read.schema(DECLARED_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


class Tables:
    """Attribute access to the driver tables of one scale-factor folder.

    ``Tables(spark, sf_dir).lineitem`` is a lazy scan, created once per
    instance (creating it lists the files and reads the Parquet footers).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            frames = self.__dict__.setdefault("_frames", {})
            if name not in frames:
                frames[name] = read_table(self.spark, self.sf_dir, name)
            return frames[name]
        raise AttributeError(name)


def from_pandas(spark: SparkSession, pdf, schema=None) -> DataFrame:
    """A local pandas frame as a DataFrame (Arrow-based conversion).

    For small local inputs only — the frame already lives in driver memory;
    data that grows with the workload is read with ``spark.read``."""
    return spark.createDataFrame(pdf, schema=schema)


def to_pandas(df: DataFrame):
    """Collect a (small, typically aggregated) result locally, whole.

    What may be collected is bounded by the session's
    ``spark.driver.maxResultSize``, which raises; nothing is cut off."""
    return df.toPandas()
