"""Ordering and top-k.

``top_k`` is ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: each task keeps its own k best rows and only
k × tasks rows reach the final merge, so the full input is never sorted
or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_cols(by: Sequence[str], descending: bool | Sequence[bool] = True) -> list[Column]:
    flags = [descending] * len(by) if isinstance(descending, bool) else list(descending)
    return [
        F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first()
        for c, d in zip(by, flags)
    ]


def full_order(df: DataFrame, by: Sequence[str], descending: bool | Sequence[bool] = True) -> list[Column]:
    """Sort keys ``by`` followed by every other column ascending: rows tied
    on ``by`` are ordered the same way on every run."""
    rest = [c for c in df.columns if c not in set(by)]
    return sort_cols(by, descending) + [F.col(c).asc_nulls_first() for c in rest]


def top_k(
    df: DataFrame,
    by: Sequence[str],
    k: int,
    descending: bool | Sequence[bool] = True,
    tie_break: bool = True,
) -> DataFrame:
    """The first ``k`` rows by ``by``. With ``tie_break`` the other
    columns decide ties at the cut, so the chosen rows are reproducible."""
    cols = full_order(df, by, descending) if tie_break else sort_cols(by, descending)
    return df.orderBy(*cols).limit(k)


def order_by_position(df: DataFrame, column: str, values: Sequence, position: str = "_pos") -> DataFrame:
    """Order rows by an explicit list of values of ``column`` (report
    order); values not in the list sort last, in their natural order."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    keyed = df.withColumn(position, F.when(pos > 0, pos).otherwise(F.lit(len(values) + 1)))
    return keyed.orderBy(F.col(position), F.col(column)).drop(position)


def select_in_order(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """O6 as pandas ``.loc[values]``: the rows of the listed values, in the
    list's order; a listed value without a row raises when the query runs."""
    wanted = df.sparkSession.createDataFrame(
        [(i, v) for i, v in enumerate(values)], f"_pos int, _want {dict(df.dtypes)[column]}")
    found = wanted.join(df.withColumn("_found", F.lit(True)), F.col("_want") == F.col(column), "left")
    there = F.when(F.col("_found").isNull(), F.raise_error(
        F.concat(F.lit(f"no row with {column} = "), F.col("_want").cast("string")))).otherwise(F.col("_pos"))
    return found.orderBy(there).select(*df.columns)
