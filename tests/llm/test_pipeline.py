import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerline.llm import decontamination as D, substring_dedup as S, toxicity as T
from ledgerline.llm.common import written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """(docs given, rows returned) of each stage, as the pipeline chains them."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in P.STAGES:
        got = written(stage(spark, docs, SF), "test-stage")
        out[name] = (docs, got)
        docs = got
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "best-fit packing"]
    for name, (given, got) in list(stages.items())[:-1]:
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert [f.dataType for f in got.schema] == [f.dataType for f in given.schema]


def test_toxicity_keeps_what_scores_low(spark, stages):
    given, got = stages["toxicity"]
    model = T.fit(given, spark.read.parquet(f"{SF}/labels.parquet"))
    low = {r.doc_id for r in T.score(given, model).filter("score < 0.3").collect()}
    assert set(rows(got)) == low
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lost = given.join(got, "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.filter("toxic = 0").count() == 0 and lost.filter("toxic = 1").count() >= 20


def test_one_of_each_group_stays(stages):
    from test_jaccard_join import brute

    given, got = stages["n-gram Jaccard join"]
    want = {i for i, (c, _) in brute([(r.doc_id, r.text) for r in given.collect()]).items() if c == i}
    assert set(rows(got)) == want


def test_repeats_are_cut_as_brute_force_cuts_them(stages):
    from test_substring_dedup import both, stays

    given, got = stages["substring dedup"]
    texts, spans = both(S.substring_dedup(given, passages=True))
    stays(texts, [(r.doc_id, r.text, spans[r.doc_id]) for r in given.orderBy("doc_id").collect()])
    want = {i: t for i, t in texts.items() if not spans[i] or any(c.isalnum() for c in t)}
    assert {i: r.text for i, r in rows(got).items()} == want and any(spans.values())
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_documents_with_benchmark_items_go(spark, stages):
    given, got = stages["benchmark decontamination"]
    items = [" ".join(D.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in given.collect() if any(x in " ".join(D.words_of(r.text)) for x in items)}
    assert holds and set(rows(got)) == set(rows(given)) - holds


def test_packing_takes_every_document(stages):
    given, got = stages["best-fit packing"]
    assert {r.doc_id for r in got.collect()} == set(rows(given))
    per = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert per.filter("n <> m OR n > 4096").count() == 0


def test_stages_take_nulls_and_empty_tables(spark, stages):
    given, _ = stages["toxicity"]
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, None), (2, "", None, None, None),
         (3, "one", "xx", "s", 1), (4, "word " * 30_000, "en", "s", 150_000), (4, "word " * 30_000, "en", "s", 150_000)],
        given.schema)
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, odd, SF)
        assert kept.columns == odd.columns
        assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 4}
    assert P.STAGES[1][1](spark, odd, SF).filter("doc_id = 4").count() == 1
    assert stage and P.STAGES[-1][1](spark, odd, SF).select("doc_id").distinct().count() == 5
    for _, stage in P.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0


def test_run_is_the_chain_of_stages(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got, want = P.run(spark, SF).select(key), stages["best-fit packing"][1].select(key)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
