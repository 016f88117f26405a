"""Vectorized pandas transforms.

``transform(df, fn, "*, x:str")`` runs ``fn(pandas.DataFrame) ->
pandas.DataFrame`` through ``mapInPandas``: Spark hands each task its input
as Arrow batches, so the work is partitioned like any other narrow
operator and nothing passes through the driver.

Contract: ``fn`` must be **row-local** (each output row depends only on its
input row) because it sees one Arrow batch at a time, never the whole
table. ``checked=True`` tests that in every task. A function that needs the rows
of a key together goes through ``keyed_transform``, which hands it a group as a
stream of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.schema import schema_of
from ledgerline.session import bound_arrow_batches, ship_package


def transform(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
    checked: bool = False,
) -> DataFrame:
    """``TRANSFORM df USING fn`` with an output-schema expression.

    With ``checked`` the first batch of every task that has two rows or more is
    also given to ``fn`` in two uneven parts; a result that differs raises, so a
    function over a whole frame (a share of a total, a rank) fails instead of
    returning figures per batch.
    """
    out_schema = schema_of(df, schema) if isinstance(schema, str) else schema
    names = [f.name for f in out_schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to_check = checked
        for pdf in batches:
            given = pdf.copy() if to_check and len(pdf) > 1 else None
            res = fn(pdf)[names]
            if given is not None:
                to_check = False
                _check_row_local(fn, given, res, names)
            yield res

    ship_package(df.sparkSession)
    bound_arrow_batches(df.sparkSession)
    return df.mapInPandas(run, out_schema)


def _check_row_local(fn, given: pd.DataFrame, whole: pd.DataFrame, names: list[str]) -> None:
    cut = max(1, len(given) // 3)
    parts = [fn(given.iloc[:cut].reset_index(drop=True))[names], fn(given.iloc[cut:].reset_index(drop=True))[names]]
    again = pd.concat(parts, ignore_index=True)
    if len(again) != len(whole) or not again.astype(object).equals(whole.reset_index(drop=True).astype(object)):
        raise ValueError("transform: the function is not row-local, its result changes when a batch is split; "
                         "use keyed_transform for functions over a group")


def keyed_transform(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``fn(key, batches)`` once per group of ``keys``, yielding record batches.

    The group arrives as a stream of Arrow batches with all columns, so a
    function that keeps a running state (totals, counters, last value) holds one
    batch at a time, however large the group. ``order_by`` sorts the rows of a
    group (by an external sort, which spills). A function that needs two passes
    should put its first one into an aggregate and join it.
    """
    out_schema = schema_of(df, schema) if isinstance(schema, str) else schema
    names = [f.name for f in out_schema.fields]

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fn(tuple(k.as_py() for k in key), batches):
            yield batch.select(names)

    ship_package(df.sparkSession)
    bound_arrow_batches(df.sparkSession)
    if order_by:  # the grouping needs this partitioning and order too, and adds none of its own
        df = df.repartition(*keys).sortWithinPartitions(*keys, *order_by)
    return df.groupBy(*keys).applyInArrow(run, out_schema)


def series_udf(fn: Callable[[pd.Series], pd.Series], return_type: str | T.DataType) -> Callable[..., Column]:
    """Element-wise function over a Series as an Arrow-batched pandas UDF.

    Call ``ledgerline.session.ship_package(spark)`` first when ``fn`` lives
    in a module the executors cannot import."""
    return F.pandas_udf(fn, returnType=return_type)
