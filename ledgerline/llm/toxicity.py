"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

The kernel of two words is the gap-weighted subsequence kernel of order three,
normalised and squared: words are alike when they share letter triples in
order, even with letters inserted between them, each step of the span costing a
factor ``DECAY``. The kernel of two sentences is the sum over their distinct
words. The Nystroem map over landmark words turns a sentence into a short
vector, so the SVM is linear there, and every distinct word adds one number,
its own margin, to the margin of its sentence. A document scores as its most
toxic sentence does, through a logistic curve fitted to training documents.

Toxic landmarks are chosen to cover the toxic training documents: again and again
the word is taken that the likelihood ratio ties most to the toxic documents that
hold fewer than ``COVER`` of those taken, until none is tied by ``MIN_TIE``. Clean
landmarks are frequent words and, for each toxic landmark, the clean words next
to it that a first SVM takes for toxic. Sentences of toxic documents that hold a
word like a toxic landmark are the positive ones, once as they are and once with
a letter inserted; sentences of clean documents, some at random and those that
the first SVM finds worst, are the negative ones.
Sentences become kernel rows in tasks; the driver gets one matrix of them.

Words are lowered and lose inner punctuation, and runs of single letters are
also read as one word, so ``i.d.i.o.t`` and ``i d i o t`` meet ``idiot``.

Training reads at most SAMPLE_TOXIC + SAMPLE_CLEAN labelled documents, chosen
by hash. Defined results: null and empty texts have no sentence and score as
the model's bias; repeated rows are scored one by one; an empty table gives no
rows; without labelled rows of both kinds every document scores 0. Texts of any
length are read whole. Only the named columns are read, so extra ones cannot
clash.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.llm import textstats
from ledgerline.llm.common import bounded_sample, written

SAMPLE_TOXIC, SAMPLE_CLEAN = 3_000, 6_000
CANDIDATES = 2_000      # words with the highest ties of their own; landmarks are chosen among them
MIN_TIE = 17.0          # likelihood ratio that ties a landmark to toxic documents
ALIKE = 0.15            # kernel value from which a word is like a landmark
COVER = 3               # landmarks after which a toxic document is covered
CLEAN_LANDMARKS, HARD_LANDMARKS = 32, 1  # frequent clean words; clean words next to each toxic landmark
TRAIN_SENTENCES = 16_000
HARD_SENTENCES = 1_000  # clean sentences that the first SVM finds worst
HARD_SHARE = 0.01       # of the total weight 1, half of which is the positive sentences'
FIT_TASKS = 16
NEAR = 0.3              # words less like every toxic landmark than this are neutral
DECAY, REACH = 0.7, 5   # a triple spans at most REACH letters after its first
WORD, STEP = 24, 12     # longer words are read in overlapping windows
SENTENCE_WORDS = 32
CODES = 64
CACHE_WORDS = 250_000   # in each of two generations
WORDS_AT_ONCE = 1_000  # whose triples and kernel rows are in memory together
TEXT_AT_ONCE = 1 << 20
EDGES = re.compile(r"[\W_]+")


def clean(word: str) -> str:
    return word if word.isalnum() else EDGES.sub("", word)


def _letters(words: list[str]) -> np.ndarray:
    """Words as rows of letter codes 1 to 63, 0 beyond the end.

    a-z and 0-9 have codes of their own; all other letters share the rest.
    """
    lens = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), max(int(lens.max(initial=0)), REACH + 1)), np.int64)
    if words:
        flat = textstats.code_points("".join(words)).astype(np.int64)
        rows = np.repeat(np.arange(len(words)), lens)
        cols = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        code = np.where((flat >= 97) & (flat <= 122), flat - 96,
                        np.where((flat >= 48) & (flat <= 57), flat - 21, 37 + flat % 27))
        out[rows, cols] = code
    return out


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, triple, weight) of all gapped letter triples, equal ones summed,
    scaled so that each word's weights have length one."""
    c = _letters(words)
    rows, codes, weights = [], [], []
    for far in range(2, REACH + 1):
        first, last = c[:, :-far], c[:, far:]
        for near in range(1, far):
            r, at = np.nonzero(last)
            rows.append(r)
            codes.append((first[r, at] * CODES + c[r, at + near]) * CODES + last[r, at])
            weights.append(np.full(len(r), DECAY ** (far - 2)))
    key = np.concatenate(rows) * CODES**3 + np.concatenate(codes)
    order = np.argsort(key, kind="stable")
    key, w = key[order], np.concatenate(weights)[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    w = np.add.reduceat(w, start) if len(start) else w
    row, code = np.divmod(key[start], CODES**3)
    norm = np.sqrt(np.bincount(row, w * w, minlength=len(words)))
    return row, code, w / norm[row]


def kernel(words: list[str], marks: np.ndarray, place: np.ndarray, most: int | None = None) -> np.ndarray:
    """Kernel values of words (rows) with the landmarks, or the first ``most``.

    ``place`` maps a triple to its row of ``marks`` (0: in no landmark), whose
    columns are the landmarks' weights.
    """
    marks = marks[:, :most]
    row, code, w = triples(words)
    at = place[code]
    row, at, w = row[at > 0], at[at > 0], w[at > 0].astype(np.float32)
    out = np.zeros((len(words), marks.shape[1]), np.float32)
    if len(row):
        # the k-th known triple of every word at once; row 0 of marks is of zeros
        count = np.bincount(row, minlength=len(words))
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        ats, ws = (np.zeros((int(count.max()), len(words)), x.dtype) for x in (at, w))
        ats[nth, row], ws[nth, row] = at, w
        for a, x in zip(ats, ws):
            some = np.flatnonzero(a)
            out[some] += marks[a[some]] * x[some, None]
    return out * out


def landmark_table(toxic: list[str], usual: list[str]) -> dict:
    words = list(dict.fromkeys(w[:WORD] for w in toxic + usual))
    row, code, w = triples(words)
    known = np.unique(code)
    place = np.zeros(CODES**3, np.int32)
    place[known] = np.arange(1, len(known) + 1)
    marks = np.zeros((len(known) + 1, len(words)), np.float32)
    marks[place[code], row] = w
    n_toxic = len({w[:WORD] for w in toxic})
    return {"landmarks": words, "marks": marks, "place": place, "n_toxic": n_toxic,
            "peak": marks[:, :n_toxic].max(1)}


def _may_be_near(words: list[str], t: dict) -> np.ndarray:
    """False only for words that cannot reach NEAR with any toxic landmark.

    Each triple counts with its greatest weight in any toxic landmark, and the
    word's norm as if no triple of it were repeated, which is a lower bound.
    """
    c = _letters(words)
    most, norm = np.zeros(len(words)), np.full(len(words), 1e-12)
    for far in range(2, REACH + 1):
        first, last = c[:, :-far] * CODES**2, c[:, far:]
        for near in range(1, far):
            code = first + c[:, near:c.shape[1] - far + near] * CODES + last
            there = last > 0
            most += (t["peak"][t["place"][code]] * there).sum(1) * DECAY ** (far - 2)
            norm += there.sum(1) * DECAY ** (2 * far - 4)
    return most >= NEAR * np.sqrt(norm) * (1 - 1e-6)


def near_kernel(words: list[str], t: dict):
    """(rows, kernel values) of the words near a toxic landmark, a few at a time.

    Words further than NEAR from every toxic landmark are neutral: the kernel's
    map of them is 0. Words of like length are handled together.
    """
    order = np.argsort(np.array([len(w) for w in words], np.int64), kind="stable")
    for lo in range(0, len(words), WORDS_AT_ONCE):
        at = order[lo:lo + WORDS_AT_ONCE]
        at = at[_may_be_near([words[i] for i in at], t)]
        if len(at):
            best = kernel([words[i] for i in at], t["marks"], t["place"], t["n_toxic"]).max(1)
            at = at[best >= NEAR * NEAR]
        if len(at):
            yield at, kernel([words[i] for i in at], t["marks"], t["place"])


def windows(word: str) -> list[str]:
    if len(word) <= WORD:
        return [word]
    return [word[i:i + WORD] for i in range(0, len(word) - WORD + STEP, STEP)]


def sentences(text: str) -> list[list[str]]:
    """Cleaned words by sentence; ends are . ! ? and line ends, or 32 words."""
    out, now = [], []
    for raw in text.lower().replace("\n", " . ").split():
        if w := clean(raw):
            now.append(w)
        if now and (raw[-1] in ".!?" or len(now) == SENTENCE_WORDS):
            out.append(now)
            now = []
    return out + [now] * bool(now)


def _sentence_rows(batches):
    for b in batches:
        for part in textstats.slices(b, 1):
            ids, ys, ws = [], [], []
            for i, y, t in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(1).to_pylist()):
                for s in sentences(t or ""):
                    ids.append(i), ys.append(y), ws.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), pa.array(ws, pa.list_(pa.string()))],
                names=["doc_id", "y", "words"])


def _disturbed(words: list[str], targets: set[str], rng: random.Random) -> list[str]:
    """The sentence with its target words as an evader would write them."""
    out = []
    for w in words:
        if w in targets and len(w) > 3:
            k = rng.randrange(1, len(w))
            w = w[:k] + rng.choice("abcdefghijklmnopqrstuvwxyz") + w[k:]
        out.append(w)
    return out


def _linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM by Nesterov gradient steps: the w and bias that minimise
    sum(weight * max(0, 1 - y * (x w + bias))**2) + l2 / 2 * |w|**2."""
    xb = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y, weight = y.astype(np.float32), weight.astype(np.float32)
    step = 1 / (2 * float(np.linalg.eigvalsh((xb.T * weight) @ xb)[-1]) + l2)
    w = v = np.zeros(xb.shape[1], np.float32)
    for t in range(1, rounds + 1):
        slack = np.maximum(0, 1 - y * (xb @ v))
        new = (v - step * (l2 * np.append(v[:-1], 0) - 2 * xb.T @ (weight * slack * y))).astype(np.float32)
        v, w = (new + (t - 1) / (t + 2) * (new - w)).astype(np.float32), new
    return w[:-1], float(w[-1])


def tie(t, c, n_toxic: int, n_clean: int):
    """Twice the log likelihood ratio of a word's shares in t toxic and c clean
    documents against a common share; 0 if it isn't four times likelier in toxic ones."""
    t, c = np.asarray(t, float), np.asarray(c, float)
    share = (t + c) / (n_toxic + n_clean)
    part = lambda k, m: k * np.log(np.maximum(k, 1e-300) / np.maximum(m * share, 1e-300))
    return np.where(t * n_clean > 4 * c * n_toxic, 2 * (part(t, n_toxic) + part(c, n_clean)), 0.0)


def choose_landmarks(holds: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> list[int]:
    """Candidates in the order chosen. ``holds`` has a row for each candidate: the
    toxic documents that hold it; ``clean`` counts the clean ones."""
    covered, chosen = np.zeros(holds.shape[1], np.int64), []
    while True:
        ties = tie((holds & (covered < COVER)).sum(1), clean, n_toxic, n_clean)
        ties[chosen] = 0
        best = int(np.argmax(ties)) if len(ties) else 0
        if not len(ties) or ties[best] < MIN_TIE:
            return chosen
        chosen.append(best)
        covered += holds[best]


def _like(words: list[str], shared=None):
    """Tasks: (word, mark, margin) of the words like a landmark of ``words``, with
    the margin that a model gives them; 0 without one."""
    t = landmark_table(words, [])

    def run(batches):
        for b in batches:
            own = b.column(0).to_pylist()
            for lo in range(0, len(own), WORDS_AT_ONCE):
                some = own[lo:lo + WORDS_AT_ONCE]
                pieces = [windows(w) for w in some]
                count = np.array([len(p) for p in pieces])
                value = kernel([p for ps in pieces for p in ps], t["marks"], t["place"])
                value = np.maximum.reduceat(value, np.cumsum(count) - count)
                row, mark = np.nonzero(value >= ALIKE)
                near = np.unique(row)
                margin = np.zeros(len(some))
                if shared is not None and len(near):
                    margin[near] = word_margins([some[i] for i in near], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some[i] for i in row], pa.string()), pa.array(mark.astype(np.int32)), pa.array(margin[row])],
                    names=["word", "mark", "margin"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text") -> dict | None:
    """The model, or None without labelled rows of both kinds."""
    marked = labels.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).distinct()
    marked = bounded_sample(marked.filter("y = 1"), "doc_id", SAMPLE_TOXIC).unionByName(
        bounded_sample(marked.filter("y = 0"), "doc_id", SAMPLE_CLEAN))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN ids are broadcast; several jobs read what is left
    chosen = written(texts.join(F.broadcast(marked), "doc_id").select("doc_id", "text", "y"), "toxicity-sample")
    rows = written(chosen.repartition(FIT_TASKS).mapInArrow(
        _sentence_rows, "doc_id long, y int, words array<string>"), "toxicity-sentences")
    held = written(rows.select("doc_id", "y", F.explode("words").alias("word")).filter(F.length("word") >= 3).distinct(),
                   "toxicity-words")
    n = {r.y: r.n for r in held.groupBy("y").agg(F.countDistinct("doc_id").alias("n")).collect()}
    if len(n) < 2:
        return None
    counts = written(held.groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")), "toxicity-counts")
    likelier = F.col("t") * n[0] > 4 * F.col("c") * n[1]
    toxic = _toxic_landmarks(held, counts, likelier, n)
    if not toxic:
        return None
    usual = [r.word for r in counts.filter(~likelier & (F.length("word") >= 4))
             .orderBy(F.desc("c"), "word").limit(CLEAN_LANDMARKS).collect()]
    # the words of the sample that are like a landmark: at most its vocabulary, read in tasks
    near = counts.filter(likelier).select("word").mapInArrow(_like(toxic), "word string, mark int, margin double")
    near = written(near.select("word").distinct(), "toxicity-near")
    some = lambda df, most: bounded_sample(
        df.withColumn("key", F.concat_ws(" ", "words")), "key", most).drop("key")
    numbered = rows.select("doc_id", "y", "words").withColumn("at", F.monotonically_increasing_id())
    hit = numbered.filter("y = 1").select("at", "words", F.explode("words").alias("word")).join(F.broadcast(near), "word")
    hit = hit.groupBy("at").agg(F.first("words").alias("words"), F.collect_set("word").alias("targets"))
    positive = some(hit.select("words", "targets"), TRAIN_SENTENCES // 2)
    negative = rows.filter(F.col("y") == 0).select("words").distinct()
    first = some(negative, TRAIN_SENTENCES // 2).select(
        "words", F.lit(None).cast("array<string>").alias("targets"), F.lit(-1).alias("y"), F.lit(0).alias("hard"))
    given = written(positive.select("words", "targets", F.lit(1).alias("y"), F.lit(0).alias("hard")).unionByName(first), "toxicity-train")
    model = _train(given, toxic, usual)
    # second round: the clean words next to each landmark, and the clean sentences, that look worst to the first model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    words = counts.filter(~likelier).select("word").mapInArrow(
        _like(toxic, shared), "word string, mark int, margin double").filter("margin > 0")
    worst = words.groupBy("mark").agg(F.slice(F.sort_array(F.collect_list(F.struct(-F.col("margin"), "word"))), 1, HARD_LANDMARKS)
                                      .alias("worst")).collect()  # one short list for each landmark
    hard_words = sorted({r.word for row in worst for r in row.worst})
    hard = written(negative.mapInArrow(_margins_of_sentences(shared), "words array<string>, margin double").orderBy(
        F.desc("margin"), "words").limit(HARD_SENTENCES), "toxicity-hard")
    hard = hard.select("words", F.lit(None).cast("array<string>").alias("targets"), F.lit(-1).alias("y"), F.lit(1).alias("hard"))
    model = _train(given.unionByName(hard), toxic, usual + hard_words)
    fitted = chosen.select("doc_id", "text", "y").join(
        margins(chosen.dropDuplicates(["doc_id"]), model), "doc_id").select("y", "margin").toPandas()
    fitted = fitted.sort_values(["y", "margin"])
    return model | dict(zip(("slope", "shift"), _logistic(fitted["margin"].to_numpy(), fitted["y"].to_numpy(np.float64))))


def _toxic_landmarks(held: DataFrame, counts: DataFrame, likelier, n: dict[int, int]) -> list[str]:
    """The toxic landmarks; ``held`` has a row for each word of each document."""
    rated = counts.filter(likelier).select("word", "t", "c").toPandas()
    rated = rated.assign(tie=tie(rated["t"], rated["c"], n[1], n[0])).sort_values(["tie", "word"], ascending=[False, True])
    candidates = rated["word"].head(CANDIDATES).tolist()
    if not candidates:
        return []
    clean = rated["c"].head(CANDIDATES).to_numpy()
    order = {w: i for i, w in enumerate(candidates)}
    wanted = held.sparkSession.createDataFrame([(w,) for w in candidates], "word string")
    of = held.filter("y = 1").join(F.broadcast(wanted), "word")
    # a bit for each of the SAMPLE_TOXIC documents and candidate
    number = held.filter("y = 1").select("doc_id").distinct().select(
        "doc_id", F.row_number().over(Window.orderBy("doc_id")).alias("nth"))
    holds = np.zeros((len(candidates), n[1]), bool)
    for r in of.join(F.broadcast(number), "doc_id").groupBy("word").agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(nth))").alias("bits")).collect():
        holds[order[r.word]] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")[:n[1]]
    chosen = choose_landmarks(holds, clean, n[1], n[0])
    return list(dict.fromkeys(candidates[i][:WORD] for i in chosen))


def _train(sentences_: DataFrame, toxic: list[str], usual: list[str]) -> dict:
    """Map (words, targets, y, hard) in tasks and train on one matrix; a sentence
    with targets comes a second time, as an evader would write it."""
    t = landmark_table(toxic, usual)
    # Nystroem: k(w, L) K^-1/2 with the landmarks' own kernel matrix K
    own = kernel(t["landmarks"], t["marks"], t["place"]).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    root = root.astype(np.float32)
    shared = sentences_.sparkSession.sparkContext.broadcast(t)

    def mapped(batches):
        for b in batches:
            words, targets = b.column(0).to_pylist(), b.column(1).to_pylist()
            y, hard = b.column(2).to_numpy(), b.column(3).to_numpy()
            twice = [i for i, x in enumerate(targets) if x]
            words += [_disturbed(words[i], set(targets[i]), random.Random(" ".join(words[i]))) for i in twice]
            at = np.concatenate([np.arange(b.num_rows), np.array(twice, np.int64)])
            for lo in range(0, len(words), 500):
                x = _mapped(words[lo:lo + 500], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([" ".join(w) for w in words[lo:lo + 500]]), pa.array(y[at[lo:lo + 500]], pa.int32()),
                     pa.array(hard[at[lo:lo + 500]], pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["key", "y", "hard", "x"])

    got = sentences_.repartition(FIT_TASKS).mapInArrow(mapped, "key string, y int, hard int, x binary").toArrow()
    # in a fixed order, so that equal tables give equal models
    got = got.sort_by([(c, "ascending") for c in ("y", "hard", "key")]).drop_columns("key")
    x = np.concatenate([np.frombuffer(b"".join(c.to_pylist()), np.float32) for c in got.column("x").chunks]).reshape(got.num_rows, -1) @ root
    y, hard = got.column("y").to_numpy(), got.column("hard").to_numpy() > 0
    weight = np.zeros(len(y))
    share = HARD_SHARE if hard.any() else 0.0
    for part, all_of_it in ((y > 0, 0.5), ((y < 0) & ~hard, 0.5 - share), (hard, share)):
        weight[part] = all_of_it / max(part.sum(), 1)
    w, bias = _linear_svm(x, y, weight)
    return t | {"weights": (root @ w).astype(np.float32), "bias": bias}


def _mapped(some: list[list[str]], t: dict) -> np.ndarray:
    """Kernel of each sentence with the landmarks: the sum over its distinct words."""
    vocabulary = sorted({p for s in some for w in s for p in windows(w)})
    values = {vocabulary[i]: k for at, ks in near_kernel(vocabulary, t) for i, k in zip(at.tolist(), ks)}
    out = np.zeros((len(some), t["marks"].shape[1]), np.float32)
    for i, s in enumerate(some):
        for p in {p for w in s for p in windows(w)} & values.keys():
            out[i] += values[p]
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(y = 1 | x) over the training documents, with a mild
    pull of the slope to 0 so that separable classes give a finite one."""
    w = np.full(len(x), 1 / max(len(x), 1))
    xb, beta = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(xb @ beta, -30, 30)))
        grad = xb.T @ (w * (p - y)) + np.array([1e-4 * beta[0], 0])
        hess = (xb * (w * p * (1 - p))[:, None]).T @ xb + np.diag([1e-4, 1e-6])
        beta = beta - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(beta[0]), float(beta[1])


def _margins_of_sentences(shared):
    def run(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            known = sorted({w for s in words for w in s})
            of = dict(zip(known, word_margins(known, shared.value).tolist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sum(of[w] for w in set(s)) for s in words], pa.float64())],
                names=["words", "margin"])
    return run


def word_margins(words: list[str], model: dict) -> np.ndarray:
    """Margin that each (cleaned) word adds; a long word has its best window's."""
    parts = [windows(w) for w in words]
    flat = [p for ps in parts for p in ps]
    got = np.zeros(len(flat))
    for at, values in near_kernel(flat, model):
        got[at] = values @ model["weights"]
    count = np.array([len(p) for p in parts], np.int64)
    return np.maximum.reduceat(got, np.cumsum(count) - count) if len(flat) else got


class Scorer:
    """Scores batches of texts with a cache of word margins."""

    def __init__(self, model: dict):
        self.model, self.margin, self.before = model, {"": 0.0}, {}

    def _learn(self, words: list[str]) -> None:
        if len(self.margin) > CACHE_WORDS:  # the words of late are kept, older ones go
            self.margin, self.before = {"": 0.0}, self.margin
        lost = [w for w in dict.fromkeys(words) if w not in self.margin]
        self.margin.update((w, self.before[w]) for w in lost if w in self.before)
        if new := [w for w in lost if w not in self.margin]:
            self.margin.update(zip(new, word_margins(new, self.model).tolist()))

    def __call__(self, texts: pa.Array) -> np.ndarray:
        lowered = pc.replace_substring(pc.utf8_lower(texts), "\n", " . ")
        vocabulary, codes, bounds = textstats.word_codes(lowered)
        cleaned = [clean(w) for w in vocabulary]
        self._learn(cleaned)
        ids = {w: i for i, w in enumerate(dict.fromkeys(cleaned))}
        word = np.array(list(map(ids.__getitem__, cleaned)) or [0], np.int64)[codes]
        margin = np.array([self.margin[w] for w in ids] or [0.0])[word]
        ends = np.array([w[-1:] in (".", "!", "?") for w in vocabulary] or [False])
        single = np.array([len(w) == 1 for w in cleaned] or [False])
        empty = np.array([not w for w in cleaned] or [False])
        if not len(codes):
            return np.full(len(texts), self.model["bias"])
        # a sentence starts with a text, after an end, and every 32 words
        first = np.zeros(len(codes), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        first[1:] |= ends[codes[:-1]]
        nth = np.cumsum(~empty[codes]) - (~empty[codes])
        at = np.flatnonzero(first)
        nth = nth - np.repeat(nth[at], np.diff(np.append(at, len(codes))))
        first |= (nth % SENTENCE_WORDS == 0) & ~empty[codes]
        at = np.flatnonzero(first)
        # a word counts once in a sentence: later occurrences add nothing
        of = np.cumsum(first) - 1
        key = of * np.int64(len(ids)) + word
        _, once = np.unique(key, return_index=True)
        added = np.zeros(len(codes))
        added[once] = margin[once]
        total = np.add.reduceat(added + self._spelled(cleaned, codes, single, bounds), at)
        out = np.zeros(len(texts))
        has = np.flatnonzero(np.diff(bounds) > 0)
        # sentences are in text order, so the maximum of a text is that of a run of them
        out[has] = np.maximum.reduceat(total, np.searchsorted(at, bounds[:-1][has]))
        return out + self.model["bias"]

    def _spelled(self, cleaned: list[str], codes: np.ndarray, single: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Margins of runs of three or more single letters read as one word,
        added where the run starts."""
        out = np.zeros(len(codes))
        one = single[codes]
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        edge = np.flatnonzero(np.diff(one, prepend=~one[0]) | (np.diff(text_of, prepend=-1) != 0))
        size = np.diff(np.append(edge, len(codes)))
        runs = [(i, "".join(cleaned[c] for c in codes[i:i + n])) for i, n in zip(edge.tolist(), size.tolist())
                if one[i] and n >= 3]
        if runs:
            self._learn([w for _, w in runs])
            for i, w in runs:
                out[i] = self.margin[w]
        return out


def margins(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and margin of the most toxic sentence; docs has doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred landmarks at most

    def run(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            for part in textstats.slices(b, 1, TEXT_AT_ONCE):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scorer(textstats.filled(part.column(1))), pa.float64())],
                    names=["doc_id", "margin"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, margin double")


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: toxic likelier)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    return margins(rows, model).select(
        "doc_id", (1 / (1 + F.exp(-(F.lit(model["slope"]) * F.col("margin") + model["shift"])))).alias("score"))


def keep_clean(docs: DataFrame, model: dict | None, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    border = (np.log(threshold / (1 - threshold)) - model["shift"]) / model["slope"]

    def run(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            for part in textstats.slices(b, at, TEXT_AT_ONCE):
                keep = scorer(textstats.filled(part.column(at))) < border
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
