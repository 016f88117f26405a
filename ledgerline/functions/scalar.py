"""Column-expression helpers (P5–P23). All return JVM-side ``Column``s, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier thresholds of the margin classification (percent).
HIGH_TIER_MIN = 60
MEDIUM_TIER_MIN = 50


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def margin(price="price", cost="cost") -> Column:
    """P5 + P7: ``ROUND(price - cost, 2)``."""
    return F.round(_c(price) - _c(cost), 2)


def margin_pct_raw(price="price", cost="cost") -> Column:
    """``(price - cost) / price * 100``, unrounded.

    ``try_divide`` yields NULL for a zero price instead of an ANSI error.
    """
    return F.try_divide(_c(price) - _c(cost), _c(price)) * F.lit(100)


def margin_pct(price="price", cost="cost") -> Column:
    """P6 + P7: the displayed percentage, ``ROUND(.., 1)``."""
    return F.round(margin_pct_raw(price, cost), 1)


def margin_tier(pct: Column) -> Column:
    """Three-way tier on the *unrounded* percentage.

    NULL (zero price) and NaN fall to 'low', as a pandas comparison would.
    """
    return (
        F.when(pct >= HIGH_TIER_MIN, F.lit("high"))
        .when(pct >= MEDIUM_TIER_MIN, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def is_value(c, value) -> Column:
    """P10: ``CASE WHEN c = value THEN 1 ELSE 0 END``."""
    return F.when(_c(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def ieee_divide(num, den) -> Column:
    """Floating-point ``num / den`` with IEEE semantics at a zero divisor
    (±inf, or NaN for 0/0), as the reference's float arithmetic gives;
    Spark's ANSI ``/`` would raise and ``try_divide`` would give NULL."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    at_zero = (
        F.when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(d == 0, at_zero).otherwise(n / d)


def thousands(c) -> Column:
    """Integer with thousands separators (``1,234``)."""
    return F.format_number(_c(c), 0)


def fixed(c, decimals: int = 3) -> Column:
    """Fixed decimals, as Python's ``f"{x:.3f}"`` prints them.

    ``format_number`` rounds half-even on the exact binary value (like
    Python and C ``printf``); ``format_string`` would round half-up on the
    shortest decimal form and print 2.25 as "2.3". Grouping commas are
    removed."""
    return F.regexp_replace(F.format_number(_c(c), decimals), ",", "")


def times_label(c) -> Column:
    """Speed-up label (``%.1fx``); infinities and NaN print as Python
    does (``infx``, ``nanx``), not Java's ``Infinity``."""
    x = _c(c)
    return (
        F.when(F.isnan(x), F.lit("nanx"))
        .when(x == F.lit(float("inf")), F.lit("infx"))
        .when(x == F.lit(float("-inf")), F.lit("-infx"))
        .otherwise(F.concat(fixed(x, 1), F.lit("x")))
    )
