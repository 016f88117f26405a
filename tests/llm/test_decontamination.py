import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import decontamination as D


def words(rng, n, top=3000):
    return [f"{rng.choice('abcdefgh')}{int(rng.paretovariate(0.4)) % top}" for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, rng.randint(15, 59)))) for i in range(30)]
    docs, leaks = [], set()
    for d in range(240):
        body = words(rng, rng.randint(30, 400))
        if d % 6 == 0:
            item, text = items[rng.randrange(30)]
            text = text.split()
            if d % 12 == 0:  # a paraphrase: every eighth word another, an inserted word
                text = [f"new{rng.randrange(999)}" if k % 8 == 3 and k < len(text) * 3 // 4 else w for k, w in enumerate(text)]
                text.insert(len(text) // 2, "really")
            at = rng.randrange(len(body))
            body[at:at] = text
            leaks.add((d, item))
        docs.append((d, " ".join(body)))
    return docs, items, leaks


def test_planted_leaks_are_found_and_nothing_else(spark, planted, monkeypatch):
    docs, items, leaks = planted
    frame = spark.createDataFrame([(d, t, 0.5) for d, t in docs], "doc_id long, text string, cosine double").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_leaks(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)
    assert D.remove_leaks(frame, D.find_leaks(frame, bench)).count() == len(docs) - len({d for d, _ in leaks})
    monkeypatch.setattr(D, "ITEMS", 8)  # the items in several blocks
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(frame, bench).collect()} == leaks


def test_the_candidate_search_has_the_recall_of_brute_force(spark, planted):
    """Verification of all pairs without a candidate search finds no more."""
    docs, items, _ = planted
    bench, frame = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, t in items for w in D.words_of(t)}))}
    want = set()
    for i, t in items:
        terms = [vocabulary[w] for w in D.words_of(t)]
        masks: dict = {}
        for at, k in enumerate(terms):
            masks[k] = masks.get(k, 0) | 1 << at
        for d, text in docs:
            tokens = [vocabulary.get(w, -1) for w in D.words_of(text)]
            step = max(1, len(terms) // 3)
            if any(D.lcs_length(masks, len(terms), tokens[s:s + len(terms) + step]) >= D.LCS * len(terms)
                   for s in range(0, len(tokens), step)):
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(frame, bench).collect()}
    assert len(want) >= 20 and len(want & got) >= 0.9 * len(want)


def test_lcs_equals_the_table():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        masks: dict = {}
        for at, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << at
        assert D.lcs_length(masks, len(a), b) == table[-1][-1]


def test_edges(spark):
    item = "what is the tallest hill of the northern county and who first walked up to its top"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, item), (3, item), (4, "x " * 60_000 + item), (None, item), (5, "!!")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, item), (4, "...")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()), key=str)
    assert got == sorted([(3, 1), (3, 1), (4, 1), (None, 1)], key=str)
    assert D.find_leaks(docs, bench.limit(0)).count() == 0
    assert D.find_leaks(docs.limit(0), bench).count() == 0
    left = D.remove_leaks(docs, D.find_leaks(docs, bench))
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 2, None, 5], key=str)


def test_answers():
    assert D.answer_of("Who is it? It is the king.") == ["it", "is", "the", "king"]
    assert D.answer_of("a b c d e f g h i j k l") == ["j", "k", "l"]


def test_items_longer_than_a_window_are_found(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([50, 100, 150, 200, 250, 300, 400, 500] * 3)]
    docs, leaks = [], set()
    for d in range(72):
        body = words(rng, rng.randint(30, 900))
        if d % 3 == 0:
            item, text = items[d // 3]
            text = [w if d % 2 or k % 8 != 3 or k > len(text.split()) * 3 // 4 else f"new{rng.randrange(999)}"
                    for k, w in enumerate(text.split())]  # every second one a paraphrase
            at = rng.randrange(len(body))
            body[at:at] = text
            leaks.add((d, item))
        docs.append((d, " ".join(body)))
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)
    lengths = {i: len(t.split()) for i, t in items}
    assert all(r.end_word - r.start_word >= lengths[r.item_id] // 2 for r in got)


def test_pieces_cover_the_items():
    items = [range(n) for n in (1, 48, 49, 80, 81, 500)]
    for k, t in enumerate(items):
        whole, *parts = [(a, z) for i, a, z in D.pieces_of(items) if i == k]
        assert whole == (0, len(t)) and bool(parts) == (len(t) > 48)
        assert [x for a, z in parts for x in t[a:z]] == (list(t) if parts else [])
        assert all(z - a <= D.PIECE for a, z in parts)


def test_items_whose_rare_words_are_replaced_are_found(spark):
    """The rarest 15 % of an item's words are others, the rest stands as it was."""
    rng = random.Random(21)
    items = [(i, " ".join(words(rng, rng.randint(20, 59)))) for i in range(40)]
    noise = [(100 + d, " ".join(words(rng, 300))) for d in range(200)]
    counts: dict = {}
    for _, t in noise:
        for w in set(t.split()):
            counts[w] = counts.get(w, 0) + 1
    docs = list(noise)
    for i, t in items:
        own = t.split()
        rare = set(sorted(range(len(own)), key=lambda k: counts.get(own[k], 0))[:int(0.15 * len(own))])
        body = words(rng, 120)
        body[60:60] = [f"other{i}x{k}" if k in rare else w for k, w in enumerate(own)]
        docs.append((i, " ".join(body)))
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(got & {(i, i) for i in range(40)}) >= 36 and not {d for d, _ in got} - set(range(40))


def test_partial_sums_are_added_up_in_a_tree(spark, monkeypatch):
    rng = random.Random(22)
    items = [(i, " ".join(words(rng, 30))) for i in range(10)]
    docs = [(d, " ".join(words(rng, 100) + (items[d % 10][1].split() if d % 9 == 0 else []))) for d in range(90)]
    args = spark.createDataFrame(docs, "doc_id long, text string").repartition(9), spark.createDataFrame(items, "item_id long, text string")
    want = {(r.doc_id, r.item_id) for r in D.find_leaks(*args).collect()}
    monkeypatch.setattr(D, "FAN_IN", 2)
    monkeypatch.setattr(D, "CELLS_AT_ONCE", 3)
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(*args).collect()} == want >= {(d, d % 10) for d in range(0, 90, 9)}
    clash = args[0].withColumnRenamed("text", "leaked")
    assert D.remove_leaks(clash, D.find_leaks(*args)).columns == ["doc_id", "leaked"]


def test_subsequences_are_sought_only_where_enough_words_are_shared(monkeypatch):
    """One frequent word of an item, many times over, is no reason to verify."""
    item = "the a0 the a1 the a2 the a3 a4 a5 a6 a7 a8 a9 a10 a11".split()
    vocabulary = {w: k for k, w in enumerate(sorted(set(item)))}
    terms = np.array([vocabulary[w] for w in item], np.int32)
    texts = [" ".join(["the"] * 40 + ["a0", "a1", "a2", "a3"] + ["the"] * 40), "x " * 30 + " ".join(item) + " y" * 30, None]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3], pa.int64()), "text": pa.array(texts)})
    calls = []
    lcs = D.lcs_length
    monkeypatch.setattr(D, "lcs_length", lambda *a: calls.append(a[1]) or lcs(*a))
    shared = SimpleNamespace(value={
        "idf": np.ones(len(vocabulary), np.float32), "basis": np.eye(len(vocabulary), dtype=np.float32),
        "items": [terms], "answers": [terms[-4:]], "ids": [7]})
    got = [r for b in D._search(shared)(D._places(vocabulary)([batch])) for r in b.to_pylist()]
    assert [(r["doc_id"], r["item_id"], r["lcs_share"]) for r in got] == [(2, 7, 1.0)]
    assert len(calls) == 2  # of document 2, its item and the answer; of document 1, none


def test_shared_words_are_counted_as_often_as_both_hold_them(monkeypatch):
    monkeypatch.setattr(D, "WORDS_AT_ONCE", 50)
    rng = np.random.default_rng(8)
    items = [rng.integers(0, 12, n).astype(np.int32) for n in (5, 30, 1)]
    terms = rng.integers(0, 15, 300).astype(np.int32)
    a = rng.integers(0, 300, 200)
    z = np.minimum(300, a + rng.integers(0, 60, 200))
    item = rng.integers(0, 3, 200)
    want = [(Counter(terms[x:y].tolist()) & Counter(items[k].tolist())).total() for x, y, k in zip(a, z, item)]
    assert D.Kinds(items, 15).shared(terms, a, z, item).tolist() == want
    assert D.Kinds(items, 15).shared(terms, a[:0], z[:0], item[:0]).tolist() == []
