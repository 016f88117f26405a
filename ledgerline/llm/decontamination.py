"""Benchmark decontamination by latent semantic retrieval.

1. Every document is read once and becomes the places of those words that some
   benchmark item holds too (no other word can add to a product with an item).
2. Document frequencies over passages of ``PASSAGE`` words give the IDF weights.
3. A randomised SVD of the TF-IDF passages of the whole corpus and the items:
   tasks multiply their passages with a random matrix and back, the products
   are summed by blocks of terms, and a QR step of that terms x rank matrix
   gives the basis. Its size depends on the benchmark only.
4. Windows of two and four blocks of ``STEP`` words are projected and compared
   with all items, and with the pieces of at most ``PIECE`` words of the items
   that are longer than a window; a window is a candidate for an item if its
   cosine with the item or a piece is ``COSINE`` or more and it holds ``MASS`` of
   that one's latent vector. A window too short for the least mass is not
   compared at all. A candidate is verified over the item's full length, as the
   piece's place in the item lays it around the window.
5. A candidate is a leak if the longest common subsequence of words holds
   ``LCS`` of the item, or ``LCS_WITH_ANSWER`` of it and ``ANSWER`` of the item's
   answer (its last sentence, or its last quarter) while the words in common
   carry ``RARE`` of the item's IDF weight.

The items are taken in blocks of at most ``ITEMS`` rows, so that what is sent to
every task has a bound; each block searches all documents.

Defined results: null and empty texts hold no leak, null and empty items match
nothing; repeated documents are reported once each; an empty table on either
side gives no rows; texts of any length are read whole. Only the named columns
are read, so extra ones cannot clash.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm import textstats
from ledgerline.llm.common import written

PASSAGE, STEP = 48, 12
PIECE = 40
RANK, OVERSAMPLE, ROUNDS = 128, 8, 1
COSINE, MASS = 0.4, 0.35
WORDS_AT_ONCE = 200_000
LCS, LCS_WITH_ANSWER, ANSWER, RARE = 0.8, 0.6, 0.8, 0.6
ITEMS = 2_000
TERM_BLOCK, FAN_IN = 64, 64
CELLS_AT_ONCE = 8_192
EDGES = re.compile(r"[\W_]+")


def clean(word: str) -> str:
    return word if word.isalnum() else EDGES.sub("", word)


def words_of(text: str) -> list[str]:
    return [c for w in text.lower().split() if (c := clean(w))]


def answer_of(text: str) -> list[str]:
    """Words of the last sentence if there are several, else the last quarter."""
    parts = [p for p in (words_of(s) for s in re.split(r"[.!?\n]+", text)) if p]
    words = words_of(text)
    last = parts[-1] if len(parts) > 1 and len(parts[-1]) >= 3 else words[-max(3, len(words) // 4):]
    return last


def _places(vocabulary: dict[str, int]):
    """Document -> its number of words and the (place, term) of shared ones."""
    find = vocabulary.get

    def run(batches):
        for batch in batches:
            for part in textstats.slices(batch, 1):
                words, codes, bounds = textstats.word_codes(pc.utf8_lower(textstats.filled(part.column(1))))
                term = np.array([find(w, -1) if w.isalnum() else find(clean(w), -1) for w in words] or [-1], np.int32)
                terms = term[codes] if len(codes) else np.zeros(0, np.int32)
                place = (np.arange(len(codes)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.int32)
                known = terms >= 0
                offsets = pa.array(np.concatenate([[0], np.cumsum(known)])[bounds].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds)),
                     pa.ListArray.from_arrays(offsets, pa.array(place[known])),
                     pa.ListArray.from_arrays(offsets, pa.array(terms[known]))],
                    names=["doc_id", "n_words", "place", "term"])
    return run


def _some(batches):
    """Row slices of about WORDS_AT_ONCE words (a longer document alone)."""
    for b in batches:
        cuts = np.flatnonzero(np.diff(np.cumsum(b.column("n_words").to_numpy()) // WORDS_AT_ONCE)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            if hi > lo:
                yield b.slice(lo, hi - lo)


class Words:
    """The shared words of some documents, dealt into cells of STEP words."""

    def __init__(self, b: pa.RecordBatch):
        self.place, self.term = (b.column(c).flatten().to_numpy() for c in ("place", "term"))
        per_doc = pc.list_value_length(b.column("place")).to_numpy(zero_copy_only=False)
        self.bounds = np.concatenate([[0], np.cumsum(per_doc)])
        self.at = None
        doc = np.repeat(np.arange(b.num_rows), per_doc)
        cells = np.maximum(1, -(-b.column("n_words").to_numpy() // STEP))
        self.first = np.concatenate([[0], np.cumsum(cells)])
        self.doc_of = np.repeat(np.arange(b.num_rows), cells)
        self.nth = np.arange(len(self.doc_of)) - self.first[self.doc_of]
        self.cell = self.first[doc] + self.place // STEP
        # passages: PASSAGE // STEP cells of a document each
        per = PASSAGE // STEP
        passages = np.concatenate([[0], np.cumsum(-(-cells // per))])
        self.n_passages = int(passages[-1])
        self.passage_of = passages[self.doc_of] + self.nth // per
        self.passage = self.passage_of[self.cell]

    def tokens_before(self, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Index of the first shared word of a document at or after a place."""
        if self.at is None:  # documents ascend, and places do in each
            self.at = np.repeat(np.arange(len(self.bounds) - 1) << 32, np.diff(self.bounds)) + self.place
        return np.searchsorted(self.at, (doc << 32) + np.clip(place, 0, (1 << 32) - 1))

    def cell_sums(self, table: np.ndarray) -> np.ndarray:
        """Sum of the terms' rows by cell; the table's last row is of zeros."""
        at = np.full((len(self.doc_of), STEP), len(table) - 1, np.int32)
        at[self.cell, self.place % STEP] = self.term
        out = table[at[:, 0]]
        for k in range(1, STEP):
            out += table[at[:, k]]
        return out

    def passage_sums(self, table: np.ndarray) -> np.ndarray:
        cells = self.cell_sums(table)
        out = np.zeros((self.n_passages, table.shape[1]), np.float32)
        for k in range(PASSAGE // STEP):
            own = self.nth % (PASSAGE // STEP) == k
            out[self.passage_of[own]] += cells[own]
        return out


def _weighted(m: dict) -> np.ndarray:
    return np.vstack([m["idf"][:, None] * m["basis"], np.zeros((1, m["basis"].shape[1]), np.float32)])


def _frequencies(n_terms: int):
    def run(batches):
        df, n = np.zeros(n_terms, np.int64), 0
        for b in _some(batches):
            w = Words(b)
            pairs = np.unique(w.passage.astype(np.int64) * n_terms + w.term)
            df += np.bincount(pairs % n_terms, minlength=n_terms)
            n += w.n_passages
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({  # term -1 carries the number of passages
            "term": pa.array([-1, *seen.tolist()], pa.int32()), "df": pa.array([n, *df[seen].tolist()], pa.int64())})
    return run


def _back_and_forth(shared):
    """Sums of A'(AQ) over a task's passages, by blocks of terms."""
    def run(batches):
        table, idf = _weighted(shared.value), shared.value["idf"]
        task = TaskContext.get().partitionId()
        out = np.zeros_like(table[:-1])
        for b in _some(batches):
            w = Words(b)
            y = w.passage_sums(table)
            order = np.argsort(w.term, kind="stable")
            rows, own = y[w.passage[order]], w.term[order]
            at = np.flatnonzero(np.diff(own, prepend=-1)).tolist()
            for lo, hi in zip(at, [*at[1:], len(own)]):
                out[own[lo]] += rows[lo:hi].sum(0) * idf[own[lo]]
        for k in range(0, len(out), TERM_BLOCK):
            part = out[k:k + TERM_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([k], pa.int32()), "part": pa.array([task], pa.int32()),
                    "sums": pa.array([part.astype(np.float32).tobytes()], pa.binary())})
    return run


def _add_up(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(s, np.float32).astype(np.float64) for s in pdf["sums"])
    return pd.DataFrame({"block": [key[0]], "part": [key[1]], "sums": [total.astype(np.float32).tobytes()]})


def latent_basis(places: DataFrame, items: list[np.ndarray], n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """(idf, basis): the IDF of each term and an orthonormal terms x RANK basis
    of the leading right singular vectors of passages and items."""
    counts = places.mapInArrow(_frequencies(n_terms), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df, passages = np.zeros(n_terms), 0
    for r in counts.collect():  # one row per benchmark word
        if r.term < 0:
            passages = r["df"]
        else:
            df[r.term] = r["df"]
    idf = np.log1p((1 + passages) / (1 + df)).astype(np.float32)
    # the items are passages too; each weighs as much as the corpus passages do per item
    weight = max(1.0, passages / max(1, len(items)))
    rank = min(RANK + OVERSAMPLE, n_terms)
    basis, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((n_terms, rank)))
    for _ in range(ROUNDS):
        shared = places.sparkSession.sparkContext.broadcast({"idf": idf, "basis": basis.astype(np.float32)})
        sums = places.mapInArrow(_back_and_forth(shared), "block int, part int, sums binary")
        # a tree: a group adds up FAN_IN parts of a block at most, however many tasks there were
        parts = places.rdd.getNumPartitions()
        while parts > 1:
            parts = -(-parts // FAN_IN)
            sums = sums.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("block", "part").applyInPandas(
                _add_up, "block int, part int, sums binary")
        product = np.zeros((n_terms, rank))
        for r in sums.collect():  # n_terms x rank numbers in all
            part = np.frombuffer(r.sums, np.float32).reshape(-1, rank)
            product[r.block:r.block + len(part)] = part
        for terms in items:
            y = (idf[terms, None] * basis[terms]).sum(0) * weight
            np.add.at(product, terms, idf[terms, None] * y)
        shared.unpersist()
        # Rayleigh-Ritz: the rotation that orders the basis by singular value
        values, turn = np.linalg.eigh((lambda h: (h + h.T) / 2)(basis.T @ product))
        basis, _ = np.linalg.qr(product @ turn[:, np.argsort(-values)])
    return idf, basis[:, :min(RANK, rank)].astype(np.float32)


def lcs_length(masks: dict[int, int], m: int, tokens: list[int]) -> int:
    """Longest common subsequence of an item of m words, given as the bit set of
    places of each term, and a list of terms; one machine operation a word."""
    full = (1 << m) - 1
    v = full
    for t in tokens:
        if (x := masks.get(t)) is not None:
            u = v & x
            v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


def _bits(terms: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        out[t] = out.get(t, 0) | 1 << i
    return out


def pieces_of(items: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """(item, start, end) of what windows are compared with: every item whole,
    and even pieces of at most PIECE words of those longer than a window."""
    out = [(k, 0, len(t)) for k, t in enumerate(items)]
    for k, t in enumerate(items):
        if len(t) > 4 * STEP:
            cuts = np.linspace(0, len(t), -(-len(t) // PIECE) + 1).astype(int).tolist()
            out += [(k, a, z) for a, z in zip(cuts, cuts[1:])]
    return out


class Kinds:
    """The distinct terms of each item and how often the item holds them."""

    def __init__(self, items: list[np.ndarray], n_terms: int):
        self.n_terms = n_terms
        pairs = np.concatenate([t.astype(np.int64) + k * n_terms for k, t in enumerate(items)])
        self.pair, self.count = np.unique(pairs, return_counts=True)

    def shared(self, terms: np.ndarray, a: np.ndarray, z: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Size of the multiset intersection of terms[a:z] and the item, for each
        of many stretches; about WORDS_AT_ONCE words are looked up at once."""
        out = np.zeros(len(a), np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(z - a) // WORDS_AT_ONCE)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)]):
            n = (z - a)[lo:hi]
            nth = np.repeat(np.arange(hi - lo), n)
            at = np.arange(len(nth)) - np.repeat(np.cumsum(n) - n - a[lo:hi], n)
            pair = item[lo:hi][nth] * self.n_terms + terms[at]
            kind = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
            known = self.pair[kind] == pair
            both, times = np.unique(nth[known] * len(self.pair) + kind[known], return_counts=True)
            out[lo:hi] = np.bincount(both // len(self.pair), np.minimum(times, self.count[both % len(self.pair)]), hi - lo)
        return out


def _search(shared):
    def run(batches):
        m = shared.value
        table = _weighted(m)
        items, answers = m["items"], m["answers"]
        pieces = pieces_of(items)
        latent = np.stack([table[items[k][a:z]].sum(0) for k, a, z in pieces])
        length = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)
        latent /= length[:, None]
        masks, answer_masks = [_bits(t) for t in items], [_bits(t) for t in answers]
        totals = [float(m["idf"][t].sum()) for t in items]
        kinds = Kinds(items, len(table))
        item_of, start, end = (np.array(x) for x in zip(*pieces))
        size = np.array([len(t) for t in items])

        def verify(terms, k):
            share = lcs_length(masks[k], len(items[k]), tokens := terms.tolist()) / len(items[k])
            if share < LCS_WITH_ANSWER:
                return None
            answer = lcs_length(answer_masks[k], len(answers[k]), tokens) / len(answers[k])
            if share < LCS:
                if answer < ANSWER:
                    return None
                own, n_own = np.unique(items[k], return_counts=True)
                there = (terms[:, None] == own).sum(0)
                if float((m["idf"][own] * np.minimum(n_own, there)).sum()) < RARE * totals[k]:
                    return None
            return share, answer

        for b in _some(batches):
            w = Words(b)
            cells = w.cell_sums(table)
            follows = lambda n: np.append(w.doc_of[n:] == w.doc_of[:-n], np.zeros(min(n, len(w.doc_of)), bool))
            two = cells + np.where(follows(1)[:, None], np.roll(cells, -1, 0), 0)
            four = two + np.where(follows(2)[:, None], np.roll(two, -2, 0), 0)
            hits = []
            for z, width, use in ((two, 2, np.arange(len(two))), (four, 4, np.flatnonzero(w.nth % 2 == 0))):
                norm = np.sqrt(np.einsum("ij,ij->i", z, z))
                # a product with a unit vector is at most the norm: nothing is lost here
                use = use[norm[use] >= MASS * length.min()]
                for first in range(0, len(pieces), ITEMS):
                    least = MASS * length[first:first + ITEMS]
                    for c in range(0, len(use), CELLS_AT_ONCE):
                        own = use[c:c + CELLS_AT_ONCE]
                        product = z[own] @ latent[first:first + ITEMS].T
                        at, p = np.divmod(np.flatnonzero(product >= least), len(least))
                        value, at = product[at, p], own[at]
                        close = value >= COSINE * norm[at]
                        hits.append((value[close] / norm[at[close]], at[close], first + p[close], np.full(close.sum(), width)))
            cosine, c, p, width = (np.concatenate(x) for x in zip(*hits)) if hits else np.zeros((4, 0), np.int64)
            # each window and the words around it that the rest of the item may cover
            k, d, span = item_of[p], w.doc_of[c], size[item_of[p]] // 2
            lo = w.nth[c] * STEP - start[p]
            hi = (w.nth[c] + width) * STEP + size[k] - end[p]
            a, z = (w.tokens_before(d, at) for at in (lo - span, hi + span))
            # no subsequence is longer than the words that the item and the stretch share
            hopeful = np.flatnonzero(kinds.shared(w.term, a, z, k) >= LCS_WITH_ANSWER * size[k])
            order = hopeful[np.lexsort((width[hopeful], p[hopeful], c[hopeful], cosine[hopeful]))[::-1]]
            best = {}
            for i, key in zip(order.tolist(), zip(d[order].tolist(), k[order].tolist())):
                if best.get(key, (0,))[0] == 1.0:
                    continue
                if found := verify(w.term[a[i]:z[i]], key[1]):
                    got = *found, max(0, int(lo[i])), int(hi[i])
                    if got > best.get(key, (0,)):
                        best[key] = (*got, float(cosine[i]))
            ids = b.column("doc_id").to_pylist()
            rows = [(ids[d], m["ids"][k], c, s, a, lo, hi) for (d, k), (s, a, lo, hi, c) in sorted(best.items())]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((
                ("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()),
                ("answer_share", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())))})
    return run


LEAK_DDL = ("doc_id long, item_id long, cosine double, lcs_share double, answer_share double, "
            "start_word long, end_word long")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, cosine,
    lcs_share, answer_share and the word range (start_word, end_word)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    questions = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).filter(
        "id IS NOT NULL AND text IS NOT NULL")
    out = spark.createDataFrame([], LEAK_DDL)
    blocks = max(1, -(-questions.count() // ITEMS))
    for block in range(blocks):
        rows = sorted(tuple(r) for r in questions.filter(
            F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect())
        rows = [(i, t, w) for i, t in rows if (w := words_of(t))]
        if not rows:
            continue
        vocabulary = {w: k for k, w in enumerate(sorted({w for r in rows for w in r[2]}))}
        items = [np.array([vocabulary[w] for w in r[2]], np.int32) for r in rows]
        answers = [np.array([vocabulary[w] for w in answer_of(r[1])], np.int32) for r in rows]
        places = written(texts.mapInArrow(
            _places(vocabulary), "doc_id long, n_words long, place array<int>, term array<int>"), "benchmark-words")
        idf, basis = latent_basis(places, items, len(vocabulary))
        shared = spark.sparkContext.broadcast(
            {"idf": idf, "basis": basis, "items": items, "answers": answers, "ids": [r[0] for r in rows]})
        out = out.unionByName(places.mapInArrow(_search(shared), LEAK_DDL))
    return out


def remove_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no leak; rows with a null id stay."""
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # no name of the input can clash
    found = leaks.select(F.col("doc_id").alias("leaked")).distinct()
    return rows.join(found, rows[docs.columns.index(id_col)].cast("long") == found["leaked"], "left_anti").toDF(*docs.columns)
