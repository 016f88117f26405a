"""The left join of reports, and the reduction of a fact by a Bloom filter.

The joins of J1 and J2 are plain ``DataFrame.join`` calls in ``plans.retail``:
no side is hinted, the planner's size check decides, and adaptive execution
re-checks with measured sizes and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FILTER_BITS = 1 << 28  # 32 MB, sent once to every executor
BITS_PER_KEY = 12
MIN_BITS_PER_KEY = 5       # a fuller filter lets too much through to pay
_BITS_SET = 4


def left_enrich(meta: DataFrame, detail: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keep every metadata row, add detail columns where the key matches
    (pandas ``DataFrame.join`` default)."""
    return meta.join(detail, on, "left")


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("word")), F.lit(words))


def _mask(key: Column) -> Column:
    """A long with up to four bits set, drawn from one hash of the key."""
    h, one = F.xxhash64(key, F.lit("mask")), F.lit(1).cast("long")
    out = None
    for i in range(_BITS_SET):
        bit = F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def filter_words(n_keys: int, max_bits: int = MAX_FILTER_BITS) -> int:
    """64-bit words of a filter for ``n_keys``; 0 if it would be too full."""
    bits = min(max_bits, max(64, n_keys * BITS_PER_KEY))
    return 0 if n_keys * MIN_BITS_PER_KEY > bits else -(-bits // 64)


def bloom_reduced(fact: DataFrame, key: str, kept: DataFrame, max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``fact`` without most rows whose ``key`` is in no row of ``kept``.

    Put in front of a shuffle join with ``kept``, it drops the fact's rows where
    they are scanned. The filter is blocked: a key sets up to four bits of one
    word, so a test reads one word. It is sized by a count of ``kept`` (a job of
    its own, over one column) and holds at most ``max_bits``; where that leaves
    fewer than MIN_BITS_PER_KEY bits a key, ``fact`` comes back as it is and the
    join alone decides. Rows are only ever kept in excess, but for NULL keys,
    which no equi-join keeps. The words are aggregated with a partial step and
    reach the tasks as one scalar subquery.
    """
    words = filter_words(kept.select(key).count(), max_bits)
    if not words:
        return fact
    ids = kept.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    bits = ids.select(_word(F.col("k"), words).alias("at"), _mask(F.col("k")).alias("bits")).union(
        fact.sparkSession.range(words).select("id", F.lit(0).cast("long"))).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    packed = bits.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "bits"))), lambda x: x["bits"]).alias("b")).scalar()
    mask = _mask(F.col(key))
    return fact.where(packed[_word(F.col(key), words).cast("int")].bitwiseAND(mask) == mask)
