"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, as it is or paraphrased."""
    from ledgerline.llm.decontamination import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that each document carries a notice of."""
    from ledgerline.llm.license_scan import scan

    return scan(table(spark, sf_dir, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one holds."""
    from ledgerline.llm.substring_dedup import substring_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs, passages=True).select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), "removed")


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    from ledgerline.llm.jaccard_join import jaccard_classes

    return jaccard_classes(table(spark, sf_dir, "documents"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    from ledgerline.llm import language_id as L

    docs = table(spark, sf_dir, "documents")
    model = L.fit(docs.filter(~held_out("doc_id", 3, 1)))
    return L.predict(docs, model).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, learned from labels not held out."""
    from ledgerline.llm import toxicity as T

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = T.fit(docs, labels.filter(~held_out("doc_id", 4, 2)))
    return T.score(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts hold control strings,
    rebuilt from an event log, formatted, and read back."""
    from ledgerline.llm import chat_format as C

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    log = C.log_of(rows.unionByName(probe))
    return C.digests(C.format_conversations(log, ["turn", "tie", "message", "step"]))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of every document and the verdict of the latest policy."""
    from ledgerline.llm.quality_rules import ledger, passes

    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), passes("v2").alias("kept"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from labels not held out."""
    from ledgerline.llm import gradient_boosting as G

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = G.fit(docs, labels.filter(~held_out("doc_id", 5, 0)), "quality")
    return G.score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    from ledgerline.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the eight leading components of all, whitened."""
    from ledgerline.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), most=8)


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    from ledgerline.llm.url_filter import judge, listed_domains

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, listed_domains(pages))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and its text without their repeats."""
    from ledgerline.llm import periodic_runs as P

    return P.digests(P.periodic_runs(P.with_planted_tails(table(spark, sf_dir, "documents"))))


def _add_oracles() -> None:
    # per conversation the turns as given, marked as the template marks them
    ORACLE_SQL["op7_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(escaped) + 24)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
    # all pairs of documents by shared five-word shingles, classes by closure
    ORACLE_SQL["op4_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n, sha256(string_agg(g, chr(10) ORDER BY g)) AS d FROM s GROUP BY doc_id),
c AS (SELECT n.doc_id, count(*) AS copies FROM n JOIN n AS o ON n.d = o.d GROUP BY n.doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 5 * i >= 4 * (na.n + nb.n - i)),
r AS (SELECT DISTINCT a AS node, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.node),
k AS (SELECT node, min(m) AS class_id FROM r GROUP BY node),
l AS (SELECT a, count(*) AS links FROM e GROUP BY a)
SELECT w.doc_id, coalesce(k.class_id, w.doc_id) AS class_id, coalesce(c.copies, 1) AS n_copies, coalesce(l.links, 0) AS n_links
FROM w LEFT JOIN k ON k.node = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN l ON l.a = w.doc_id"""
    # equal stretches of three words, q apart, at neighbouring places make a run
    ORACLE_SQL["op13_periodic_runs"] = r"""
WITH c AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1),
      lambda k: ord(substr(doc_id::VARCHAR, k, 1))::BIGINT)), lambda x, b: list_reduce(
        list_concat([xor(x, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))),
      4294967295::BIGINT) AS h FROM documents),
a AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS tail, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM c),
t AS (SELECT doc_id, n, unnest(w) AS w, unnest(range(n)) AS i FROM (SELECT doc_id, n, CASE WHEN tail THEN list_transform(range(n),
    lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM a)),
s AS (SELECT doc_id, n, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS three FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
p AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM s AS x JOIN s AS y ON x.doc_id = y.doc_id AND x.three = y.three
      AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM p),
m AS (SELECT doc_id, min(i) AS start, count(*) + 2 + q AS length, q FROM k GROUP BY doc_id, q, island
      HAVING count(*) + 2 + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM m GROUP BY doc_id, start, length),
d AS (SELECT doc_id, count(*) AS n_runs, arg_min({'s': start, 'l': length, 'p': period}, (-length, start, period)) AS best,
      string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
x AS (SELECT DISTINCT t.doc_id, t.i FROM t JOIN r ON r.doc_id = t.doc_id AND t.i >= r.start + r.period AND t.i < r.start + r.length),
l AS (SELECT t.doc_id, string_agg(t.w, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN x ON x.doc_id = t.doc_id AND x.i = t.i GROUP BY t.doc_id)
SELECT c.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
  1000 * best.l // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM c LEFT JOIN d ON d.doc_id = c.doc_id LEFT JOIN l ON l.doc_id = c.doc_id"""
    from ledgerline.llm.license_scan import op2_oracle
    from ledgerline.llm.quality_rules import op8_oracle
    from ledgerline.llm.url_filter import op12_oracle

    ORACLE_SQL["op2_license_scan"] = op2_oracle()
    ORACLE_SQL["op8_quality_rules"] = op8_oracle()
    ORACLE_SQL["op12_url_filter"] = op12_oracle()


_add_oracles()
