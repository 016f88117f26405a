import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import gradient_boosting as G, language_id as L, toxicity as T
from ledgerline.llm.common import held_out

SF01 = "/root/testdata/sf0.01"
EDGES = [(-1, None), (-2, ""), (-3, " \n\t"), (-4, "123 !!"), (-5, "x"), (-6, "word " * 100_000), (-7, "y" * 300_000), (-7, "y" * 300_000)]


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda n: spark.read.parquet(f"{SF01}/{n}.parquet")
    return read("documents"), read("labels")


def test_language_of_held_out_texts(spark, tables):
    docs, _ = tables
    out = held_out("doc_id", 3, 1)
    model = L.fit(docs.filter(~out))
    got = L.predict(docs.filter(out), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got) and len(model["langs"]) > len(set(model["langs"]))
    edge = L.predict(spark.createDataFrame([(*r, "zz") for r in EDGES], "doc_id long, text string, lang_pred string"), model).collect()
    assert len(edge) == len(EDGES)
    assert {r.doc_id for r in edge if r.lang_pred == "und"} == {-1, -2, -3, -4}
    odd = L.predict(spark.createDataFrame([(1, "ЖЩЮ ЫЭ ЯЖ " * 50)], "doc_id long, text string"), model).first()
    assert not odd.accepted and odd.lang_pred in model["langs"]
    assert L.predict(docs.limit(0), model).count() == 0
    none = L.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in L.predict(docs.limit(5), none).collect()} == {"und"}


def test_ngrams_equal_brute_force_counts():
    c = "abc ab é x"
    assert L.ngram_counts("Abc, ab  É9x").sum() == len(c) + (len(c) - 1) + (len(c) - 2)
    assert L.ngram_counts("12 !") is None
    assert (L.ngram_counts("ABC") == L.ngram_counts("abc")).all()


def test_quality_of_held_out_texts(spark, tables):
    docs, labels = tables
    out = held_out("doc_id", 5, 0)
    model = G.fit(docs, labels.filter(~out), "quality")
    got = G.score(docs, model).join(labels.filter(out), "doc_id").collect()
    right = np.mean([(r.score >= 0.3) == (r.quality == 1) for r in got])
    assert right >= 0.95 and all(0 <= r.score <= 1 for r in got)
    edge = G.score(spark.createDataFrame([(*r, 1.0) for r in EDGES], "doc_id long, text string, score double"), model).collect()
    assert len(edge) == len(EDGES) and all(0 <= r.score <= 1 for r in edge)
    assert G.score(docs.limit(0), model).count() == 0
    none = G.fit(docs, labels.limit(0), "quality")
    assert {round(r.score, 3) for r in G.score(docs.limit(3), none).collect()} == {0.5}


def test_flat_trees_equal_nested_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(G.FEATURES)))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.1)).astype(float)
    m = G.grow_trees(x, y)

    def one(row):
        total = 0.0
        for at in m["root"]:
            while m["feature"][at] >= 0:
                at = m["left"][at] if row[m["feature"][at]] <= m["threshold"][at] else m["right"][at]
            total += m["value"][at]
        return total

    assert np.allclose(G.walk(m, x[:50]), [one(r) for r in x[:50]])
    assert ((G.walk(m, x) + m["base"] > 0) == (y > 0)).mean() > 0.95


def test_statistics_of_simple_texts():
    s = G.statistics(pa.array(["a b c a b c", "A!! A!!", "", "x\nx\ny"], pa.large_string()))
    f = {n: i for i, n in enumerate(G.FEATURES)}
    assert s[0, f["repeated_windows"]] == pytest.approx(0.25) and s[0, f["distinct_words"]] == 0.5
    assert s[1, f["bangs"]] == pytest.approx(4 / 7) and s[1, f["upper"]] == pytest.approx(2 / 7)
    assert not s[2].any() and s[3, f["dup_lines"]] == pytest.approx(1 / 3)


def kernel_by_definition(a, b, decay=T.DECAY):
    def features(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + T.REACH + 1)):
                    key = w[i] + w[j] + w[k]
                    out[key] = out.get(key, 0) + decay ** (k - i - 2)
        return out

    fa, fb = features(a), features(b)
    dot = sum(v * fb.get(k, 0) for k, v in fa.items())
    norm = (sum(v * v for v in fa.values()) * sum(v * v for v in fb.values())) ** 0.5
    return (dot / norm) ** 2 if norm else 0.0


def test_kernel_equals_its_definition():
    marks = ["idiot", "scum", "pathetic", "aaaaaa"]
    t = T.landmark_table(marks, ["this"])
    words = ["idiot", "idixot", "scxum", "aaa", "ab", "that", "pthetic"]
    got = T.kernel(words, t["marks"], t["place"])
    for i, w in enumerate(words):
        for j, m in enumerate([*marks, "this"]):
            assert got[i, j] == pytest.approx(kernel_by_definition(w, m), abs=1e-5)
    near = {words[i] for at, _ in T.near_kernel(words, t) for i in at}
    assert near == {w for w in words if max(kernel_by_definition(w, m) for m in marks) >= T.NEAR**2}


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    rng = random.Random(2)
    usual = ["".join(rng.choice("aeioubdfglmnprst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    insults = ["idiot", "scumbag", "pathetic", "moron", "worthless"]
    docs, labels = [], []
    for i in range(900):
        body = [rng.choice(usual) + ("." if rng.random() < 0.1 else "") for _ in range(rng.randint(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                body.insert(rng.randrange(len(body)), rng.choice(insults))
        docs.append((i, " ".join(body)))
        labels.append((i, int(toxic)))
    return usual, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_of_held_out_and_disguised_texts(spark, toxic_corpus):
    usual, docs, labels = toxic_corpus
    out = held_out("doc_id", 4, 2)
    model = T.fit(docs, labels.filter(~out))
    got = T.score(docs, model).join(labels.filter(out), "doc_id").collect()
    assert np.mean([(r.score >= 0.3) == (r.toxic == 1) for r in got]) >= 0.97
    plain = " ".join(usual[:60])
    said = ["you idixot there", "an i d i o t speaks", "i.d.i.o.t", "such a mooron", "patheetic stuff", "scum-bag"]
    rows = [(k, f"{plain}. {s}. {plain}") for k, s in enumerate(said)] + [(100, plain), *EDGES]
    scored = {r.doc_id: r.score for r in T.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert sum(scored[k] >= 0.3 for k in range(len(said))) >= 5
    assert scored[100] < 0.3 and all(scored[k] < 0.3 for k, _ in EDGES)
    kept = T.keep_clean(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string"), model, 0.3)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _ in rows if scored[k] < 0.3)
    assert T.score(docs.limit(0), model).count() == 0


def test_toxicity_without_labels(toxic_corpus):
    _, docs, labels = toxic_corpus
    assert T.fit(docs, labels.filter("toxic = 0")) is None
    assert {r.score for r in T.score(docs.limit(3), None).collect()} == {0.0}
    assert T.keep_clean(docs, None, 0.3).count() == 900


def test_a_scorer_agrees_with_sentence_margins(toxic_corpus):
    usual, docs, labels = toxic_corpus
    model = T.fit(docs, labels)
    texts = ["", "one.", "\n".join([" ".join(usual[i:i + 40]) for i in range(0, 400, 40)]), "idiot idiot. moron", "! ? ..",
             "a b " * 50, " ".join(["pathetic"] * 70)]
    got = T.Scorer(model)(pa.array(texts, pa.large_string()))
    for text, margin in zip(texts, got):
        own = [sum(T.word_margins(sorted(set(s)), model)) for s in T.sentences(text)]
        if "a b" not in text:  # spelled runs are the scorer's own
            assert margin == pytest.approx(max(own, default=0.0) + model["bias"], abs=1e-4)


def test_svm_minimises_its_objective():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 4)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=120) > 0, 1.0, -1.0)
    weight = rng.random(120) / 60

    def objective(w, b):
        return float((weight * np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum() + 1e-4 / 2 * (w @ w))

    w, b = T._linear_svm(x, y, weight, rounds=2000)
    best = objective(w, b)
    for _ in range(400):  # no step in any direction lowers it
        d, e = rng.normal(size=4), rng.normal()
        for size in (0.3, 0.03, 0.003):
            assert objective(w + size * d, b + size * e) >= best - 1e-7


def test_landmarks_cover_toxic_documents():
    holds = np.array([[1] * 8 + [0] * 12, [1] * 7 + [0] * 13, [0] * 12 + [1] * 8, [1] * 2 + [0] * 18], bool)
    assert T.choose_landmarks(holds, np.array([0, 0, 1, 0]), 20, 200) == [0, 1, 2]
    assert T.choose_landmarks(holds, np.array([90, 90, 90, 90]), 20, 200) == []
    assert T.choose_landmarks(np.zeros((0, 20), bool), np.zeros(0), 20, 200) == []
    # of words in the same documents no more than COVER are taken
    assert T.choose_landmarks(np.ones((9, 20), bool), np.zeros(9), 20, 200) == [0, 1, 2]
    n, m, t, c = 20, 200, 8, 1
    p = (t + c) / (n + m)
    assert float(T.tie(t, c, n, m)) == pytest.approx(2 * (t * np.log(t / n / p) + c * np.log(c / m / p)))


def test_nystroem_margins_by_definition(spark):
    """The trained margin of a sentence is the sum of its words' kernels with the
    landmarks through the inverse root of the landmarks' own kernel matrix."""
    toxic, usual = ["idiot", "moron"], ["table", "window"]
    rows = [(["you", "idiot"], ["idiot"], 1, 0), (["a", "moron", "here"], ["moron"], 1, 0),
            (["the", "table"], None, -1, 0), (["windows", "open"], None, -1, 0), (["idiom", "book"], None, -1, 1)]
    m = T._train(spark.createDataFrame(rows, "words array<string>, targets array<string>, y int, hard int"), toxic, usual)
    marks = toxic + usual
    k = np.array([[kernel_by_definition(a, b) for b in marks] for a in marks])
    assert np.allclose(T.kernel(marks, m["marks"], m["place"]), k, atol=1e-5)
    values, vectors = np.linalg.eigh(k)
    root = vectors / np.sqrt(values) @ vectors.T
    for w in ("idiot", "idixot", "mooron", "idiom"):
        own = np.array([kernel_by_definition(w, b) for b in marks])
        x = own @ root  # the Nystroem map: its products are the kernel's projection
        assert np.allclose(x @ root @ k, own, atol=1e-6)
        want = own @ m["weights"] if own[:2].max() >= T.NEAR**2 else 0.0
        assert T.word_margins([w], m)[0] == pytest.approx(want, abs=1e-5)
    assert T.word_margins(["idiot"], m)[0] > 0 > m["bias"]
