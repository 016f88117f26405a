"""Sums of doubles that do not depend on the order of addition.

``SUM`` over doubles rounds after every addition, so partitions, retries and
adaptive plans change its last bits. Here every double is cut, without error,
into whole numbers of 24 bits at fixed powers of two (limbs); the limbs are
summed as longs, which is exact in any order, and the sums are put together and
rounded once, to the nearest double (ties to even).

Limb sums are plain ``SUM(bigint)``: hash aggregates with a partial step. They
can be summed again, so a total may be built up over several aggregations
(eager aggregation below a join) and is still rounded only at the end.

Values must be multiples of 2**LOW below 2**HIGH, as all money amounts in
doubles of a hundred-millionth or more are; anything finer or larger raises
instead of being rounded silently. A limb sum overflows, and raises, after 2**39
rows of the largest values. NULLs are skipped, no value at all gives NULL, and
NaN and infinities give what ``SUM`` gives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 24
LOW, LIMBS = -84, 6
HIGH = LOW + WIDTH * LIMBS
_MASK = (1 << WIDTH) - 1
SPECIAL = "special"


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def limbs(value: Column | str) -> list[Column]:
    """The limbs of a double, lowest first, then the value itself where it is no
    finite number. All are NULL for NULL."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    fits = (F.abs(x) < 2.0**HIGH) & (x % F.lit(2.0**LOW) == 0)
    checked = F.when(x.isNull() | ~_finite(x), F.lit(None).cast("double")).when(fits, x).otherwise(
        F.raise_error(F.concat(F.lit("no exact sum holds "), x.cast("string"))).cast("double"))
    out = []
    for i in range(LIMBS):
        low = LOW + WIDTH * i
        # the rest of a division by a power of two is exact, and so is the scaling
        part = checked % F.lit(2.0 ** (low + WIDTH)) if i < LIMBS - 1 else checked
        out.append((part * F.lit(2.0**-low)).cast("long"))
    return [*out, F.when(x.isNotNull() & ~_finite(x), x)]


def limb_sums(value: Column | str, prefix: str) -> list[Column]:
    """Aggregates of a double's limbs, named ``prefix0``, ``prefix1`` ..."""
    return [F.sum(c).alias(f"{prefix}{i}") for i, c in enumerate(limbs(value))]


def merged_sums(prefix: str) -> list[Column]:
    """Aggregates that add up limb sums, under the same names."""
    return [F.sum(f"{prefix}{i}").alias(f"{prefix}{i}") for i in range(LIMBS + 1)]


def _canonical(sums: Column) -> Column:
    """Limbs of WIDTH bits, two more for what carries over, the last one signed."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        total = a["carry"] + s
        return F.struct(F.shiftright(total, WIDTH).alias("carry"),
                        F.concat(a["out"], F.array(total.bitwiseAND(F.lit(_MASK)))).alias("out"))

    return F.aggregate(sums, start, step, lambda a: F.concat(
        a["out"], F.array(a["carry"].bitwiseAND(F.lit(_MASK)), F.shiftright(a["carry"], WIDTH))))


def _nearest(c: Column) -> Column:
    """The double nearest to canonical limbs that are not negative."""
    top = F.array_max(F.transform(c, lambda v, i: F.when(v != 0, i).otherwise(-1)))
    at = lambda k: F.coalesce(F.get(c, top - k), F.lit(0).cast("long"))
    rest = F.array_max(F.transform(c, lambda v, i: F.when((i < top - 3) & (v != 0), 1).otherwise(0))).cast("long")
    # 73 bits or more in two exact halves; a last bit stands for all below, far
    # under the half that decides the rounding of the one addition
    high = at(0) * (1 << WIDTH) + at(1)
    low = (at(2) * (1 << WIDTH) + at(3)).bitwiseOR(rest)
    both = high.cast("double") * 2.0 ** (2 * WIDTH) + low.cast("double")
    return F.when(top < 0, F.lit(0.0)).otherwise(both * F.pow(F.lit(2.0), ((top - 3) * WIDTH + LOW).cast("double")))


def total(sums: list[Column]) -> Column:
    """The rounded total of limb sums (``limb_sums`` or ``merged_sums``, or columns of them)."""
    s, special = F.array(*sums[:LIMBS]), sums[LIMBS]
    bind = lambda value, use: F.transform(F.array(value), use)[0]
    number = bind(_canonical(s), lambda c: F.when(
        F.element_at(c, -1) < 0, -bind(_canonical(F.transform(s, lambda x: -x)), _nearest)).otherwise(_nearest(c)))
    return F.coalesce(special, F.when(sums[0].isNotNull(), number))


def exact_sum(value: Column | str) -> Column:
    """Aggregate: the sum of a double column, rounded once."""
    return total([F.sum(c) for c in limbs(value)])


def total_of(prefix: str) -> Column:
    """The total of columns that ``limb_sums`` or ``merged_sums`` named."""
    return total([F.col(f"{prefix}{i}") for i in range(LIMBS + 1)])
