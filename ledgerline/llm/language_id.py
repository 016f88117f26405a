"""Language identification by nearest centroid over character n-grams.

A text becomes a hashed TF-IDF vector of its letter 1- to 3-grams, of length
one. Each language is represented by several centroids (spherical k-means over
a bounded sample of its texts), and a text gets the language of the centroid
with the greatest cosine. A text further from its centroid than nearly all
training texts of that language were is marked as not accepted.

Document frequencies come from all training texts. The k-means sample takes at
most ``SAMPLE_PER_LANG`` texts of a language in expectation, chosen by hash.

Defined results: a null text or one without a letter is ``und`` with score 0;
an empty text likewise; repeated rows are predicted one by one; an empty table
gives no rows; without training rows every text is ``und``. Whole texts are
read, whatever their length. Of the input's columns only the named ones are
read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm import textstats

DIM = 1 << 12
CENTROIDS = 4
SAMPLE_PER_LANG = 1_500
ROUNDS = 8
ACCEPT_QUANTILE = 0.001


def ngram_counts(text: str) -> np.ndarray | None:
    """Hashed counts of the letter 1- to 3-grams; None if there is no letter.

    Everything that is not a letter is a space; runs of them add the grams
    around them once each, so word starts and ends are grams too.
    """
    c = textstats.lower_letters()[textstats.code_points(text)]
    letter = c != 32
    if not letter.any():
        return None
    c = c[letter | np.concatenate([[True], letter[:-1]])].astype(np.uint32)  # one space for a run
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - DIM.bit_length() + 1)
    return sum(np.bincount(h >> shift, minlength=DIM) for h in (one * np.uint32(0x85EBCA77), two, three))


def vector(text: str, idf: np.ndarray) -> np.ndarray | None:
    n = ngram_counts(text)
    if n is None:
        return None
    v = np.log1p(n).astype(np.float32) * idf
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def _document_frequency(batches):
    df, n = np.zeros(DIM, np.int64), 0
    for b in batches:
        for t in b.column(0).to_pylist():
            if (c := ngram_counts(t or "")) is not None:
                df += c > 0
                n += 1
    # one row per block of buckets, so that the sums meet in several tasks
    step = DIM // 16
    yield pa.RecordBatch.from_pydict({
        "block": pa.array(range(16), pa.int32()), "n": pa.array([n] * 16, pa.int64()),
        "df": pa.array([df[i * step:(i + 1) * step].tolist() for i in range(16)], pa.list_(pa.int64()))})


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """IDF of each bucket over all rows of ``texts`` (one text column)."""
    parts = texts.mapInArrow(_document_frequency, "block int, n long, df array<long>")
    # positions are few: summed by key, partial sums in each task
    sums = (parts.select("block", "n", F.posexplode("df").alias("at", "df"))
            .groupBy("block", "at").agg(F.sum("df").alias("df"), F.sum("n").alias("n")))
    df, n = np.zeros(DIM), 0
    for r in sums.collect():  # DIM rows, whatever the corpus
        df[r.block * (DIM // 16) + r["at"]], n = r["df"], r.n
    return np.log((1 + n) / (1 + df)).astype(np.float32) + 1


def _cluster(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means; starts from the rows least like those chosen before."""
    chosen = [vectors.mean(0)]
    near = np.full(len(vectors), -1.0)
    for _ in range(min(CENTROIDS, len(vectors))):
        near = np.maximum(near, vectors @ (chosen[-1] / max(np.linalg.norm(chosen[-1]), 1e-12)))
        chosen.append(vectors[int(np.argmin(near))])
    c = np.stack(chosen[1:])
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ c.T, axis=1)
        c = np.stack([vectors[own == k].mean(0) if (own == k).any() else c[k] for k in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Model over rows with a non-null language: idf, centroids, languages, limits."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    idf = inverse_frequencies(rows.select("text"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return {"idf": idf, "centroids": np.zeros((0, DIM), np.float32), "langs": [], "limits": np.zeros(0)}
    share: Column = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, SAMPLE_PER_LANG / n)).otherwise(share)
    sample = rows.filter(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) < share * (1 << 20))

    def train(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        vs = [v for t in pdf["text"] if (v := vector(t or "", idf)) is not None]
        if not vs:
            return pd.DataFrame({"lang": [], "centroid": [], "limit": []})
        vs = np.stack(vs)
        c = _cluster(vs)
        best = (vs @ c.T).max(1)
        return pd.DataFrame({"lang": [key[0]] * len(c), "centroid": [x.tolist() for x in c],
                             "limit": [float(np.quantile(best, ACCEPT_QUANTILE))] * len(c)})

    got = (sample.repartition(max(1, len(counts)), "lang").groupBy("lang")
           .applyInPandas(train, "lang string, centroid array<float>, limit double").collect())
    got.sort(key=lambda r: (r.lang, r.centroid))
    return {"idf": idf, "centroids": np.array([r.centroid for r in got], np.float32).reshape(-1, DIM),
            "langs": [r.lang for r in got], "limits": np.array([r.limit for r in got])}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1) and accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages x CENTROIDS floats

    def run(batches):
        m = shared.value
        for b in batches:
            lang, score, ok = [], [], []
            for t in b.column(1).to_pylist():
                v = vector(t, m["idf"]) if t and m["langs"] else None
                if v is None:
                    lang.append("und"), score.append(0.0), ok.append(False)
                    continue
                cos = m["centroids"] @ v
                k = int(np.argmax(cos))
                lang.append(m["langs"][k])
                score.append(min(1.0, max(0.0, float(cos[k]))))
                ok.append(bool(cos[k] >= m["limits"][k]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ok, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "accepted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, accepted boolean")
