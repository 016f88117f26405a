"""Repeatable pseudo-random values keyed by row id.

A value is a pure function of ``(id, salt)``, so the output does not depend
on partitioning, task order or retries (``rand()`` would), and a rerun
writes the same table. Each helper renders one SQL expression for a
*dialect* — ``"spark"`` (used through ``F.expr``, so it stays in codegen)
or ``"duckdb"`` (used by the oracle) — from the same arithmetic, so both
engines compute identical values.

Mixing, with M = 2³¹−1 and the id split into ``low = id mod M`` and
``high = id div M``: a per-row part shared by every column,
``m = (low * A + B mod M)⁵ + C mod M``, then a per-column step
``(m * a + (high mod M) * c + b) mod M`` whose constants come from the salt.
Both the affine step and the fifth power permute the numbers below M (5 has no
factor in common with M − 1), so no two ids below M share their values in all
columns; beyond, ids with the same low part differ by a per-column multiple of
the high one. The shared part is textually identical in every column, so
Spark's subexpression elimination computes it once per row and each generated
column adds only two multiplies and a modulo. A 50-column table still fuses
into one whole-stage method too big for the JIT, so the session sets
``spark.sql.codegen.hugeMethodLimit`` (see ``ledgerline.session``) and Spark
compiles such a stage per expression. Every intermediate stays below 2⁶³, so
64-bit arithmetic never overflows (ANSI mode raises on overflow).
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

MODULUS = 2147483647  # 2^31 - 1


# Constants of the shared per-row mix.
_A, _B, _C = 1103515245, 12345, 2147480009


def _constants(salt: int) -> tuple[int, int, int]:
    m = MODULUS
    a = 69621 + (salt * 2654435761) % (m - 69622)
    b = (salt * 15485863 + 99991) % m
    c = 48271 + (salt * 2246822519) % (m - 48272)
    return a, b, c


def row_mix_sql(id_sql: str, dialect: str = "spark") -> str:
    """The salt-independent, non-linear part of the mix (one per row)."""
    m = MODULUS
    low = f"pmod({id_sql}, {m})" if dialect == "spark" else f"(((({id_sql}) % {m}) + {m}) % {m})"
    x1 = f"(({low}) * {_A} + {_B}) % {m}"
    x2 = f"(({x1}) * ({x1})) % {m}"
    x4 = f"(({x2}) * ({x2})) % {m}"
    return f"(((({x4}) * ({x1})) % {m} + {_C}) % {m})"


def hash_sql(id_sql: str, salt: int, dialect: str = "spark") -> str:
    """SQL for a value in [0, 2³¹−1) mixed from ``id_sql`` and ``salt``."""
    a, b, c = _constants(salt)
    m = MODULUS
    high = f"pmod(({id_sql}) div {m}, {m})" if dialect == "spark" else f"((((({id_sql}) // {m}) % {m}) + {m}) % {m})"
    return f"((({row_mix_sql(id_sql, dialect)} * {a}) % {m} + ({high} * {c}) % {m} + {b}) % {m})"


def uniform_sql(id_sql: str, salt: int, lo: int, hi: int, dialect: str = "spark") -> str:
    """Integer uniform on ``[lo, hi]`` (inclusive), as BIGINT."""
    return f"({lo} + {hash_sql(id_sql, salt, dialect)} % {hi - lo + 1})"


def _quote(v: str) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def pick_sql(id_sql: str, salt: int, values: Sequence[str], dialect: str = "spark") -> str:
    """One of ``values``; repeating an entry weights it."""
    n = len(values)
    idx = f"1 + {hash_sql(id_sql, salt, dialect)} % {n}"
    items = ", ".join(_quote(v) for v in values)
    if dialect == "spark":
        return f"element_at(array({items}), CAST({idx} AS INT))"
    return f"([{items}])[{idx}]"


def alias_table(weights: Sequence[float]) -> tuple[list[int], list[int]]:
    """(threshold, other) of Walker's alias method over n equal slots: a slot
    gives its own entry for draws below its threshold of MODULUS, else another
    one. Weights are taken as exact fractions, so each entry's share is its
    weight's to within n / MODULUS."""
    total = sum(map(Fraction, weights), Fraction(0))
    if not weights or total <= 0 or min(weights) < 0:
        raise ValueError("weights must not be negative and must have a positive sum")
    n = len(weights)
    share = [Fraction(w) * n / total for w in weights]
    small, large = [i for i in range(n) if share[i] < 1], [i for i in range(n) if share[i] >= 1]
    threshold, other = [MODULUS] * n, list(range(n))
    while small and large:
        i, j = small.pop(), large[-1]
        threshold[i], other[i] = round(share[i] * MODULUS), j
        share[j] -= 1 - share[i]
        if share[j] < 1:
            small.append(large.pop())
    return threshold, other


def weighted_sql(id_sql: str, salts: tuple[int, int], values: Sequence[str], weights: Sequence[float],
                 dialect: str = "spark") -> str:
    """One of ``values`` with a probability in proportion to its weight, any
    number that is not negative (G7): two hashes a row and two lookups in
    literals of one entry for each value."""
    threshold, other = alias_table(weights)
    slot = f"{hash_sql(id_sql, salts[0], dialect)} % {len(values)}"
    draw = hash_sql(id_sql, salts[1], dialect)
    name, num = ", ".join(_quote(v) for v in values), ", ".join(map(str, threshold))
    second = ", ".join(_quote(values[i]) for i in other)
    if dialect == "spark":
        at = f"CAST(1 + {slot} AS INT)"
        return (f"CASE WHEN {draw} < element_at(array({num}), {at}) THEN element_at(array({name}), {at}) "
                f"ELSE element_at(array({second}), {at}) END")
    return f"CASE WHEN {draw} < ([{num}])[1 + {slot}] THEN ([{name}])[1 + {slot}] ELSE ([{second}])[1 + {slot}] END"


def key_sql(prefix: str, n_sql: str, width: int, dialect: str = "spark") -> str:
    """Zero-padded key ``PREFIX-000123`` (never truncated when wider)."""
    fn = "format_string" if dialect == "spark" else "printf"
    return f"{fn}('{prefix}-%0{width}d', {n_sql})"


def date_sql(y: str, m: str, d: str, dialect: str = "spark") -> str:
    if dialect == "spark":
        return f"make_date(CAST({y} AS INT), CAST({m} AS INT), CAST({d} AS INT))"
    return f"make_date(CAST({y} AS BIGINT), CAST({m} AS BIGINT), CAST({d} AS BIGINT))"


def timestamp_sql(y: str, mo: str, d: str, h: str, mi: str, s: str, dialect: str = "spark") -> str:
    """Timestamp without time zone, whole seconds."""
    if dialect == "spark":
        return (
            f"make_timestamp_ntz(CAST({y} AS INT), CAST({mo} AS INT), CAST({d} AS INT), "
            f"CAST({h} AS INT), CAST({mi} AS INT), CAST({s} AS DECIMAL(8,6)))"
        )
    return f"make_timestamp({y}, {mo}, {d}, {h}, {mi}, CAST({s} AS DOUBLE))"


def hundredths_sql(n_sql: str, precision: int, dialect: str = "spark") -> str:
    """Exact DECIMAL(precision, 2) from an integer count of hundredths.

    ``n / 100.0`` is the double nearest to a two-place decimal, and both
    engines cast it back to exactly that decimal (like ``Decimal(f"{x:.2f}")``);
    this is much less generated code than a DECIMAL division."""
    return f"CAST(CAST({n_sql} AS DOUBLE) / 100 AS DECIMAL({precision},2))"


def float2_sql(n_sql: str, dialect: str = "spark") -> str:
    """FLOAT with two decimals from an integer count of hundredths."""
    return f"CAST(CAST({n_sql} AS DOUBLE) / 100 AS FLOAT)"

