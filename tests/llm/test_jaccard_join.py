import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import jaccard_join as J
from ledgerline.llm.components import connected_components


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8):
    sets = {i: shingles(t) for i, t in rows}
    links = defaultdict(set)
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
                    links[a].add(b), links[b].add(a)
    cls = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            low = min([cls[a], *(cls[b] for b in links[a])])
            if low < cls[a]:
                cls[a], changed = low, True
    return {i: (cls[i], len(links[i])) for i in ids}


def corpus(n_groups, size, seed, words=60, edits=2):
    rng, rows = random.Random(seed), []
    for g in range(n_groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(rng.randint(1, size)):
            t = list(base)
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(t)))
    return rows


EDGES = [(9001, None), (9002, ""), (9003, " \n"), (9004, "two words"), (9005, "Two  words"), (9006, "solo"),
         (9007, "x " * 20_000), (9008, "x " * 30_000)]


@pytest.mark.parametrize("block", [256, 8])
def test_classes_and_links_equal_brute_force(spark, frame, monkeypatch, block):
    # small blocks force the groups to be spread and to meet pair by pair
    monkeypatch.setattr(J, "BLOCK", block)
    rows = corpus(12, 6, 1) + EDGES
    start = 20_000
    rows += [(start + i, t) for i, (_, t) in enumerate(corpus(1, 60, 2, edits=1) * 1)]
    rows += [(30_000 + i, rows[3][1]) for i in range(15)]  # exact copies
    docs = frame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, class_id int, bands int").repartition(3)
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.jaccard_classes(docs).collect()}
    assert got == brute(rows)
    copies = {r.doc_id: r.n_copies for r in J.jaccard_classes(docs).collect()}
    count = Counter(shingles(t) for _, t in rows)
    assert copies == {i: count[s] if (s := shingles(t)) else 1 for i, t in rows}


def test_intersections_by_product_equal_those_by_search():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    left, right = np.triu_indices(40, 1)
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(left, right)]
    assert J._intersections(sets, left, right).tolist() == want
    assert J._intersections(sets, left[:100], right[:100]).tolist() == want[:100]


def test_bands_reach_the_recall_asked_for():
    bands, rows = J.choose_bands(0.8, 0.999, 160)
    assert bands * rows <= 160 and 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_repeated_and_null_ids_and_empty_table(frame):
    text = "one two three four five six seven"
    docs = frame([(1, text), (1, text), (2, text), (None, text), (None, None)])
    got = sorted(((r.doc_id, r.class_id, r.n_copies) for r in J.jaccard_classes(docs).collect()), key=str)
    assert got == [(1, 1, 3), (1, 1, 3), (2, 1, 3), (None, None, 1), (None, None, 1)]
    assert sorted(map(str, J.keep_one(docs).collect())) == sorted(map(str, frame([(1, text), (None, text), (None, None)]).collect()))
    assert J.jaccard_classes(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_text(frame):
    rng = random.Random(12)
    a, b, c = ([f"w{rng.randrange(10**6)}" for _ in range(80)] for _ in range(3))
    near = [*c[:40], "changed", *c[41:]]
    text = " ".join
    rows = [(1, text(a)), (2, text(a)), (2, text(b)), (3, text(c)), (3, text(near)), (4, text(b[:5])), (4, text(b[:5]))]
    docs = frame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, tid int, keep_id int, c0 int")
    for given in (docs, docs.repartition(3)):
        got = J.keep_one(given)
        assert got.columns == docs.columns
        kept = sorted((r.doc_id, r.text) for r in got.collect())
        assert [i for i, _ in kept] == [1, 2, 3, 4] and kept[0] == (1, text(a)) and kept[1] == (2, text(b))
        assert kept[2][1] in (text(c), text(near)) and kept[3] == (4, text(b[:5]))


def test_large_group_of_near_copies(spark, frame):
    """2,500 texts that all link to each other: several blocks meet."""
    rng = random.Random(13)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(2500):
        t = list(base)
        t[rng.randrange(120)] = f"z{i}"
        rows.append((i, " ".join(t)))
    got = J.jaccard_classes(frame(rows).repartition(6)).collect()
    # the target recall is 0.999 for a pair at the threshold; these are somewhat above it
    assert {r.class_id for r in got} == {0} and 0.999 * 2500 * 2499 <= sum(r.n_links for r in got) <= 2500 * 2499


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 150)] + [
        (rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(5, 5), (1, 0)]
    label = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    linked = {n for e in edges for n in e if e[0] != e[1]}
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len(got) == len(linked) and {r.node: r.component for r in got} == {n: label[n] for n in linked}


def test_tasks_of_components_go_with_the_edges(spark, monkeypatch):
    """Rounds over a few edges take few tasks, however many partitions the
    session shuffles into, and no round only confirms the one before it."""
    edges = [(10 * k + i, 10 * k + i + 1) for k in range(30) for i in range(6)]
    held = {"spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc = spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("components", "")
        frame = spark.createDataFrame(edges, "u long, v long").coalesce(1)
        got = connected_components(frame).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.node: r.component for r in got} == {10 * k + i: 10 * k for k in range(30) for i in range(7)}
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numTasks for s in stages if (i := tracker.getStageInfo(s)) and i.numCompletedTasks)
    assert tasks < 4500, tasks


def test_components_of_stars_and_of_nothing(spark):
    star = spark.createDataFrame([(9, 1), (1, 8), (7, 1), (7, 1)], "u long, v long")
    assert {(r.node, r.component) for r in connected_components(star).collect()} == {(n, 1) for n in (1, 7, 8, 9)}
    for edges in ([], [(3, 3)]):
        assert connected_components(spark.createDataFrame(edges, "u long, v long")).count() == 0
