import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm import periodic_runs as R


def brute(words):
    """All runs by trying each period at each place."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)  # periods rise, so the first is the smallest
            i = j
    return sorted((a, b - a, q) for (a, b), q in best.items())


def kept(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(texts):
    codes = {}
    flat = np.array([codes.setdefault(w, len(codes)) for t in texts for w in t], np.int64)
    unit, a, b, q = R.runs_of(flat, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
    starts = np.cumsum([0] + [len(t) for t in texts])
    return [[(int(x - starts[d]), int(y - x), int(p)) for u, x, y, p in zip(unit, a, b, q) if u == d] for d in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
def test_small_alphabets(texts):
    assert found(texts) == [brute(t) for t in texts]


def patterned(rng):
    out = []
    for _ in range(rng.randrange(1, 6)):
        block = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 14))]
        if rng.random() < 0.4:
            block = block * rng.randrange(1, 7) + [rng.randrange(3)]  # nested repeats
        out += block * rng.randrange(1, 9) + block[:rng.randrange(len(block) + 1)] + [rng.randrange(60) for _ in range(rng.randrange(4))]
    return out


def test_planted_and_nested_repeats():
    rng = random.Random(8)
    for _ in range(60):
        texts = [patterned(rng) for _ in range(10)]
        assert found(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("text", [[1] * 3000, [1, 2] * 900, [int(c) for c in "".join(bin(i)[2:] for i in range(300))],
                                  [bin(i).count("1") % 2 for i in range(2048)], list(range(400)) * 5, list(range(400)) * 4 + [7]])
def test_hard_texts(text):
    assert found([text, text[::-1]]) == [brute(text), brute(text[::-1])]


def test_fibonacci_words():
    a, b = [0], [0, 1]
    for _ in range(13):
        a, b = b, b + a
    assert found([b]) == [brute(b)]


def test_texts_and_edges(frame):
    ddl = "doc_id long, text string, start long, period string"
    again = "a b c " * 8
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, again), (4, again), (None, again), (5, "x" * 100_000), (6, "w " * 60_000),
            (7, "\x0ba b\x85c " * 9), (8, "no run here"), (9, "so " * 5), (10, "so " * 6)]
    got = R.periodic_runs(frame([(i, t, 3, "p") for i, t in rows], ddl))
    assert got.columns == ["doc_id", "text", "start", "period", "runs", "collapsed"]
    for r in got.collect():
        words = re.findall("[^\x20\x09-\x0D]+", r.text or "")
        want = [(0, 60_000, 1)] if r.doc_id == 6 else brute(words)
        assert [(x["start"], x["length"], x["period"]) for x in r.runs] == want
        assert r.collapsed == kept(words, want) and r.period == "p"
    assert R.periodic_runs(frame([], ddl)).count() == 0


def want_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    h, n = (1 if doc_id is None else zlib.crc32(str(doc_id).encode())), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words) if len(words) < 3000 else found([words])[0]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(kept(words, runs)))


def test_query_on_its_table(spark):
    from ledgerline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    df = QUERIES["op13_periodic_runs"](spark, sf)
    assert df.dtypes == [("doc_id", "bigint"), *((c, "bigint") for c in ("n_runs", "start", "length", "period", "exponent_milli")),
                         ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    want = sorted(want_row(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(tuple(r) for r in df.collect()) == want
    assert sum(r[1] > 0 for r in want) > 50


def test_digests_of_odd_rows(frame):
    rows = [(None, "a " * 9), (0, None), (1, ""), (17, "x y " * 30), (17, "x y " * 30)]
    got = R.digests(R.periodic_runs(R.with_planted_tails(frame(rows))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((want_row(*r) for r in rows), key=str)
