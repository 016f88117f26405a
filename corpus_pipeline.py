"""Corpus pipeline: the documents that a training run should see, packed.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import decontamination, jaccard_join, packing as best_fit, substring_dedup, toxicity
from ledgerline.llm.common import table, written

TOXIC = 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on all labels, does not reject.

    Every document is judged by its text alone; the model scores each row, so
    repeated rows and rows with a null id are kept or dropped like any other.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class.

    A class's repeated rows are reduced to one; documents without a word, and
    rows with a null id, are in no group and stay.
    """
    return jaccard_join.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; ``n_chars``
    follows the text. A document of which no word is left goes."""
    spans = "removed"
    while spans in map(str.lower, docs.columns):
        spans += "_"
    cut = substring_dedup.substring_dedup(docs, passages=True, removed_col=spans)
    emptied = (F.size(spans) > 0) & ~F.col("text").rlike(r"[\p{L}\p{N}]")
    return cut.filter(~emptied).withColumn(
        "n_chars", F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or paraphrased."""
    leaks = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.remove_leaks(docs, leaks)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    return best_fit.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_leaks),
    ("best-fit packing", packed),
]

# A trained model, connected components and tokenisation have no SQL form: the
# tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i + 1}")
    return docs
