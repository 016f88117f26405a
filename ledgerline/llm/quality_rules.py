"""Quality rules as a bitmask ledger, in DataFrame expressions only.

Every rule is evaluated once per document: the ledger row holds the
measurements and one failure bit per rule. A policy is a named, versioned mask
over those bits; applying one, or asking what a rule alone rejects, is bit
arithmetic on the ledger and never reads a text again.

Words are maximal runs of characters other than space and U+0009-U+000D. The
words of a document stay in one row as arrays, so nothing is exploded or
shuffled; a repeated three-word window is found by sorting the windows' 64-bit
hashes inside the row.

Defined results: a null text has no words, like an empty one; repeated rows are
judged one by one; an empty table gives an empty ledger; extra columns of the
input are dropped, so none can clash. Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Rule name -> (bit, failure condition on the measurements). Integer arithmetic
# only, so that every engine agrees. Bits are never reused.
RULES: dict[str, tuple[int, str]] = {
    "too_few_words": (0, "n_words < 50"),
    "repeated_words": (1, "100 * n_repeat_words > 50 * n_words"),
    "symbols": (2, "10 * n_symbols > n_words"),
    "repeated_lines": (3, "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
    "word_length": (4, "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)"),
    "shouting": (5, "4 * n_bangs > n_words"),
}
# Policy version -> the rules that reject a document under it.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_words"),
    "v1": ("too_few_words", "repeated_words", "symbols"),
    "v2": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_bangs", "n_lines", "n_dup_lines", "n_repeat_words")


def mask(policy: str) -> int:
    return sum(1 << RULES[r][0] for r in POLICIES[policy])


def _without(col: Column, chars: str) -> Column:
    return F.translate(col, chars, "")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements, all long."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    a = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(_without(x, SPACES)) > 0)
    a = a.select(
        "doc_id",
        F.array_remove(F.split(F.translate("t", SPACES, " " * len(SPACES)), " "), "").alias("w"),
        lines.alias("lines"),
        F.length(_without(F.col("t"), SPACES)).cast("long").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(_without(F.col("t"), "!"))).cast("long").alias("n_bangs"))
    windows = F.when(F.size("w") >= 3, F.expr(
        "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"))
    a = a.select(
        "doc_id", "word_chars", "n_symbols", "n_bangs",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.expr("cast(array() as array<bigint>)")).alias("h"))
    a = a.select("*", (F.size(F.array_distinct("h")) < F.size("h")).alias("repeats"))
    # windows in order of hash, then of place: equal ones are neighbours
    a = a.select(*[c for c in a.columns if c not in ("h", "repeats")], F.expr(
        "CASE WHEN repeats THEN sort_array(transform(h, (x, i) -> struct(x AS h, i AS p))) END").alias("s"))
    a = a.select(*[c for c in a.columns if c != "s"], F.expr(
        """sort_array(transform(filter(
             transform(s, (x, i) -> struct(x.p AS p,
               (i > 0 AND s[greatest(i - 1, 0)].h = x.h)
               OR (i < size(s) - 1 AND s[least(i + 1, size(s) - 1)].h = x.h) AS again)),
             x -> x.again), x -> x.p))""").alias("p"))
    # each repeated window adds the words that the one before it does not hold
    return a.select("doc_id", *[c for c in MEASURES if c != "n_repeat_words"], F.expr(
        """coalesce(aggregate(transform(p, (x, i) -> CASE WHEN i = 0 THEN 3
             ELSE least(3, x - p[greatest(i - 1, 0)]) END), 0L, (a, x) -> a + x), 0L)""").alias("n_repeat_words"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``fail_bits``, every rule evaluated once."""
    bits = [f"CASE WHEN {cond} THEN {1 << bit}L ELSE 0L END" for bit, cond in RULES.values()]
    return measure(docs, id_col, text_col).withColumn("fail_bits", F.expr(" | ".join(bits)))


def passes(policy: str) -> Column:
    """True where no rule of the policy failed."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents it fails, documents it alone rejects,
    and documents the policy would keep without it.

    The ledger is first counted by its distinct masks, so what the rules are
    compared on has at most 2^rules rows whatever the corpus.
    """
    m = mask(policy)
    counts = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("b")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).cast("long").alias("bit"))
                                for r in POLICIES[policy]]))
    each = counts.select("b", "n", rules.alias("r")).select("b", "n", "r.rule", "r.bit")
    fails = F.col("b").bitwiseAND(F.col("bit")) != 0
    alone = F.col("b") == F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only_this"),
        F.sum(F.when(alone | (F.col("b") == 0), F.col("n")).otherwise(0)).alias("n_kept_without"))


def op8_oracle() -> str:
    """The same ledger in DuckDB SQL, written from the definitions."""
    bad = " OR ".join(f"({c})" for _, c in RULES.values())
    return f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n >= 2),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS v(o) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN covered c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT ({bad}) AS kept
FROM m"""
