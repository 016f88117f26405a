import re

from ledgerline.llm import license_scan as L


def brute(rows, threshold=L.DICE):
    out = {}
    for i, text in rows:
        units = (text or "").split("\n") + [p for p in re.split(r"\n[ \t\r]*\n", text or "") if "\n" in p]
        for u in units:
            a = set(L.bigrams(u))
            for name, ts in L.TEMPLATES.items():
                for t in ts:
                    b = set(L.bigrams(t))
                    if a and (d := 2 * len(a & b) / (len(a) + len(b))) >= threshold:
                        best, n = out.get((i, name), (0, 0))
                        out[i, name] = (max(best, d), n + 1)
    return out


def rows():
    texts = [None, "", "x", "All rights reserved.", "text\nReleased under the MIT License.\nmore", "ALL RIGHTS, reserved!",
             "licensed under cc by nc 4 0", "Licensed under the Apache License", "no licence here " * 20_000,
             "Licensed under the Apache License, version 2.0 today.\n\nReleased under MIT License\n \nAll rights\nreserved."]
    for ts in L.TEMPLATES.values():
        for t in ts:
            w = t.split()
            texts += [t, "intro\n" + t, " ".join(w[1:]), " ".join(w[: len(w) * 3 // 4]), "\n".join([" ".join(w[:5]), " ".join(w[5:])]),
                      t.replace("License", "Licence"), " ".join(w + ["and", "more", "words"])]
    return list(enumerate(texts))


def test_equals_brute_force(frame):
    docs = frame([(i, t, "x") for i, t in rows()], "doc_id long, text string, license_id string")
    got = {(r.doc_id, r.license_id): (r.dice, r.n_hits) for r in L.scan(docs).collect()}
    want = brute(rows())
    assert got.keys() == want.keys() and len(got) > 60
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in got)


def test_repeated_rows_empty_table_and_plan(frame):
    docs = frame([(1, "All rights reserved."), (1, "All rights reserved."), (None, "All rights reserved.")])
    assert sorted(((r.doc_id, r.n_hits) for r in L.scan(docs).collect()), key=str) == [(1, 2), (None, 1)]
    assert L.scan(docs.limit(0)).count() == 0
    plan = L.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian|Broadcast", plan)


def test_size_bounds_and_key_words_lose_no_match():
    for n in range(1, 60):
        lo, hi = L.size_bounds(n, 0.8)
        for a in range(1, 200):
            assert (2 * min(a, n) / (a + n) >= 0.8 - 1e-12) == (lo <= a <= hi)
