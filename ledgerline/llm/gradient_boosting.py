"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each document becomes a short row of numbers (lengths, character classes,
repetition, vocabulary). Trees are grown on binned statistics of a bounded
sample of labelled rows, then flattened into arrays (feature, threshold, left,
right, value) that numpy walks for a whole batch at a time, one level a step.

Defined results: a null or empty text has all-zero statistics and gets the
score of such a row; repeated rows are scored one by one; an empty table gives
no rows; without labelled rows, or with one class only, the score is the
smoothed share of label 1. Statistics are taken over whole texts. Only the
named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm import textstats
from ledgerline.llm.common import bounded_sample

SAMPLE_ROWS = 20_000   # labelled rows that the trees are grown on, at most
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.15
LEAF_ROWS = 5
L2 = 1.0
FEATURES = ("log_chars", "log_words", "mean_word", "upper", "digits", "symbols", "bangs", "commas_stops",
            "spaces", "lines_per_word", "distinct_words", "repeated_windows", "top_word", "dup_lines", "long_words")


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    words, codes, bounds = textstats.word_codes(texts)
    word_len = np.array([len(w) for w in words], np.int64)
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.float64)
    n_words = np.diff(bounds).astype(np.float64)
    per_char, per_word = np.maximum(chars, 1), np.maximum(n_words, 1)
    out = np.zeros((len(texts), len(FEATURES)))
    out[:, 0], out[:, 1] = np.log1p(chars), np.log1p(n_words)
    for k, pattern in ((3, r"\p{Lu}"), (4, r"[0-9]"), (5, r"[#*$%&|<>@{}\[\]=_~^\\]"), (6, r"!"), (7, r"[.,;:?]"), (8, r"\s")):
        out[:, k] = count(pattern) / per_char
    out[:, 9] = count("\n") / per_word
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        if hi == lo:
            continue
        c = codes[lo:hi].astype(np.uint64)
        lens = word_len[codes[lo:hi]]
        seen = np.unique(c, return_counts=True)[1]
        out[i, 2] = lens.mean()
        out[i, 10] = len(seen) / len(c)
        out[i, 12] = seen.max() / len(c)
        out[i, 14] = (lens > 20).mean()
        if len(c) >= 3:
            h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ c[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ c[2:]
            out[i, 11] = 1 - len(np.unique(h)) / len(h)
    for i, t in enumerate(texts.to_pylist()):
        lines = [x for x in t.split("\n") if x.strip()]
        out[i, 13] = 1 - len(set(lines)) / len(lines) if lines else 0
    return out


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[tuple]:
    """Nodes (feature, bin, left, right, value) of one tree; feature -1 is a leaf."""
    nodes: list[list] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        G, H = g[rows].sum(), h[rows].sum()
        nodes.append([-1, 0, me, me, -RATE * G / (H + L2)])
        if depth == DEPTH or len(rows) < 2 * LEAF_ROWS:
            return me
        best = (1e-6, None)
        for f in range(x.shape[1]):
            b = x[rows, f]
            gs, hs, ns = (np.cumsum(np.bincount(b, w, minlength=BINS)) for w in (g[rows], h[rows], None))
            gain = gs**2 / (hs + L2) + (G - gs)**2 / (H - hs + L2) - G**2 / (H + L2)
            gain[(ns < LEAF_ROWS) | (len(rows) - ns < LEAF_ROWS)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (f, k))
        if best[1]:
            f, k = best[1]
            low = x[rows, f] <= k
            nodes[me][:2] = f, k
            nodes[me][2] = grow(rows[low], depth + 1)
            nodes[me][3] = grow(rows[~low], depth + 1)
        return me

    grow(np.arange(len(x)), 0)
    return nodes


def grow_trees(x: np.ndarray, y: np.ndarray) -> dict:
    """The flattened model; thresholds are bin edges on the raw statistics."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    flat = {k: [] for k in ("feature", "threshold", "left", "right", "value", "root")}
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(x.shape[1])], 1)
        score = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            at, nodes = len(flat["feature"]), _tree(binned, p - y, p * (1 - p))
            flat["root"].append(at)
            for f, k, left, right, value in nodes:
                flat["feature"].append(f)
                flat["threshold"].append(edges[f][k] if f >= 0 and k < len(edges[f]) else np.inf)
                flat["left"].append(at + left), flat["right"].append(at + right), flat["value"].append(value)
            one = {k: np.array(v) for k, v in flat.items()} | {"root": np.array([at])}
            score += walk(one, x)
    return {"base": base} | {k: np.array(v, np.float64 if k in ("threshold", "value") else np.int64) for k, v in flat.items()}


def walk(m: dict, x: np.ndarray) -> np.ndarray:
    """Sum of the leaf values that each row reaches, all trees at once."""
    if not len(m["root"]):
        return np.zeros(len(x))
    at = np.broadcast_to(m["root"], (len(x), len(m["root"]))).copy()
    rows = np.arange(len(x))[:, None]
    for _ in range(DEPTH):
        f = m["feature"][at]
        low = x[rows, np.maximum(f, 0)] <= m["threshold"][at]
        at = np.where(f < 0, at, np.where(low, m["left"][at], m["right"][at]))
    return m["value"][at].sum(1)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        for b in batches:
            for part in textstats.slices(b, 1):
                s = statistics(textstats.filled(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(s.tolist(), pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, stats array<double>")


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Trees over at most SAMPLE_ROWS labelled rows (0 or 1, non-null); repeated
    label rows count once, an id with both labels is an example of each."""
    marked = bounded_sample(labels.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).distinct(), "doc_id", SAMPLE_ROWS)
    rows = document_statistics(  # SAMPLE_ROWS ids at most: the bounded side is the broadcast one
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(marked.select("doc_id")), "doc_id", "left_semi"))
    got = rows.join(F.broadcast(marked), "doc_id").select("doc_id", "y", "stats").collect()
    got.sort(key=lambda r: (r.doc_id, r.y, r.stats))
    x = np.array([r.stats for r in got], np.float64).reshape(-1, len(FEATURES))
    return grow_trees(x, np.array([r.y for r in got]))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TREES x 2^DEPTH nodes

    def run(batches):
        for b in batches:
            for part in textstats.slices(b, 1):
                x = statistics(textstats.filled(part.column(1)))
                p = 1 / (1 + np.exp(-(shared.value["base"] + walk(shared.value, x))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p)], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double")
