import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import whitening as W

DDL = "vec_id long, embedding array<float>, n int, id string"


def reference(rows):
    """Plain Python integers and numpy's own eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    c = np.array([[a - s / n for a, s in zip(r, sums)] for r in x])
    cov = c.T @ c / n
    e, q = np.linalg.eigh(cov)
    return n, dev, e[::-1], q[:, ::-1], c, np.trace(cov)


def check(got, rows, most=8):
    n, dev, e, q, c, trace = reference(rows)
    assert len(got) == len(rows) * most
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for at, (i, _) in enumerate(rows):
        own = by[(i, dev[at])]
        for k in range(most):
            r = own[k + 1]
            assert r.n == n and abs(r.explained / (e[k] / trace) - 1) < 1e-9 and r.identity_error < 1e-9
            assert abs(abs(r.whitened) - abs(c[at] @ q[:, k] / math.sqrt(e[k]))) < 1e-6


def test_whitening_equals_eigenvectors(frame):
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((12, 12)) * np.geomspace(1, 0.02, 12)
    vectors = np.float32(rng.standard_normal((700, 12)) @ mix + 3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    docs = frame([(i, v, 1, "x") for i, v in rows], DDL).repartition(5)
    check(W.whiten(docs).collect(), rows)
    # signs are the same for all rows: products of rows do not depend on them
    got = W.whiten(docs, most=3).toPandas().pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    _, _, e, q, c, _ = reference(rows)
    want = c @ q[:, :3] / np.sqrt(e[:3])
    assert np.allclose(np.abs(got.T @ want / len(rows)), np.eye(3), atol=1e-7)


def test_dirty_rows_are_dropped(frame):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in v]) for i, v in enumerate(np.float32(rng.standard_normal((40, 9))))]
    good += [(3, good[3][1]), (3, good[4][1]), (None, good[5][1])]
    bad = [(90, None), (91, []), (92, [None] + [0.0] * 8), (93, [float("nan")] * 9), (94, [float("inf")] + [1.0] * 8),
           (95, [1.0, 2.0]), (96, [3e38] * 9), (97, [float("-inf")] * 9)]
    check(W.whiten(frame([(i, v, None, None) for i, v in good + bad], DDL)).collect(), good)


def test_no_variance_no_rows(frame):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]):
        out = W.whiten(frame([(i, v, 1, "") for i, v in rows], DDL))
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]
    low = frame([(i, [float(i), 2.0 * i, 5.0], 1, "") for i in range(9)], DDL)  # rank one
    assert {r.component for r in W.whiten(low).collect()} == {1}


@pytest.mark.parametrize("kind", ["random", "clustered", "equal", "diagonal", "steep", "block"])
def test_components_of_hard_matrices(kind):
    rng = np.random.default_rng(11)
    q = np.linalg.qr(rng.standard_normal((48, 48)))[0]
    e = {"random": rng.random(48), "clustered": np.repeat([1, 1 + 1e-9, 5, 0], 12), "equal": np.full(48, 2.0),
         "diagonal": np.arange(48.0), "steep": np.geomspace(1e6, 1e-6, 48), "block": np.r_[np.full(47, 1.0), 100]}[kind]
    a = np.diag(e) if kind == "diagonal" else (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = W.components(a, 10)
    assert np.allclose(values, np.sort(e)[::-1][:10], rtol=0, atol=1e-13 * np.abs(e).max() * 48)
    assert np.allclose(vectors.T @ vectors, np.eye(10), atol=1e-12)
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-12 * np.linalg.norm(a)


def test_polar_factor():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    e, q = np.linalg.eigh(a)
    assert np.allclose(W.polar(a), (q * np.sign(e)) @ q.T, atol=1e-12)


def test_exact_products_of_large_numbers():
    rng = random.Random(1)
    y = np.array([[rng.randrange(-2**49, 2**49) for _ in range(4)] for _ in range(300)])
    want = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(4)] for i in range(4)]
    assert W.exact_products(y).tolist() == want
    assert W.exact_products(y >> 40).tolist() == [[sum(int(r[i] >> 40) * int(r[j] >> 40) for r in y) for j in range(4)] for i in range(4)]


def test_query_on_its_table(spark):
    from ledgerline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    df = QUERIES["op11_embedding_whitening"](spark, sf)
    assert df.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                         ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    check(df.collect(), rows)
    assert df.agg(F.countDistinct("identity_error")).first()[0] == 1
