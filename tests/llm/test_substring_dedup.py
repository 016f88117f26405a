import random
import re

import pytest

from ledgerline.llm import substring_dedup as S

WORD = re.compile(r"[^\W_]+")


def plain(rng, n):
    return " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))


def sentence(rng, n):
    return plain(rng, n).capitalize() + "."


def kept(text, spans):
    return "".join(text[a:b] for a, b in zip([0] + [s.end for s in spans], [s.start for s in spans] + [len(text)]))


def stays(texts, rows):
    """Asserts, by brute force over (id, text, removed spans) in order of id, that
    no 41 words of an earlier document stay, no long repeated line stays, and
    that what is cut stands earlier, 16 words or a line at a time."""
    seen, short, lines = set(), set(), set()
    for i, text, spans in rows:
        assert texts[i] == kept(text, spans)
        at = [m.span() for m in WORD.finditer(text)]
        words = [text[a:z].lower() for a, z in at]
        gone = [any(s.start <= a < s.end for s in spans) for a, _ in at]
        own_long, own_short, own_lines, allowed = set(), {}, set(), set()
        for k in range(len(words) - 40):
            g = tuple(words[k:k + 41])
            assert g not in seen or any(gone[k:k + 41]), (i, k)
            own_long.add(g)
        for k in range(len(words) - 15):
            g = tuple(words[k:k + 16])
            if g in short or own_short.setdefault(g, k) <= k - 16:
                allowed |= set(range(k, k + 16))
        k = 0
        for line in text.split("\n"):
            g = tuple(w.lower() for w in WORD.findall(line))
            if len(g) >= 12:
                if g in lines or g in own_lines:
                    allowed |= set(range(k, k + len(g)))
                    assert all(gone[k:k + len(g)]), (i, line)
                own_lines.add(g)
            k += len(g)
        for k in range(1, len(words) - 1):  # a gap of one word is closed
            if k - 1 in allowed and k + 1 in allowed:
                allowed.add(k)
        assert {k for k, g in enumerate(gone) if g} <= allowed, i
        seen |= own_long
        short |= set(own_short)
        lines |= own_lines


def both(df):
    rows = df.collect()
    return {r.doc_id: r.text for r in rows}, {r.doc_id: r.removed for r in rows}


def test_repeated_lines_go_and_the_earliest_stays(frame):
    rng = random.Random(1)
    line = sentence(rng, 12)
    rows = [(i, f"{sentence(rng, 9)}\n{line}\nAll rights reserved.\n{sentence(rng, 20)}") for i in range(200)]
    got, spans = both(S.substring_dedup(frame(rows).repartition(4)))
    assert sum(line in t for t in got.values()) == 1 and line in got[0]
    for i, text in rows:
        assert got[i] == (text if not i else text.replace(f"{line}\n", "")) and "All rights reserved." in got[i]
        assert len(spans[i]) == (i > 0)


def test_lines_against_sql(spark, duck):
    """The line rule in SQL over whole sf0.01."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = S.substring_dedup(docs).collect()
    n = duck.execute(r"""
      WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
      w AS (SELECT *, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) AS u FROM l),
      r AS (SELECT doc_id, k, line, row_number() OVER (PARTITION BY u ORDER BY doc_id, k) AS nth FROM w
            WHERE len(string_split(u, ' ')) >= 12)
      SELECT doc_id, list(line ORDER BY k) FROM r WHERE nth > 1 GROUP BY doc_id""").fetchall()
    want = dict(n)
    assert len(want) > 50
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        cut = "\n".join(texts[r.doc_id][s.start:s.end].removesuffix("\n") for s in r.removed).split("\n") if r.removed else []
        assert cut == want.get(r.doc_id, [])


def test_edges(frame):
    long = "word " * 50_000 + "."
    rows = [(1, None), (2, ""), (3, " \n.!?"), (4, long), (5, long), (5, long), (None, long), (6, "x" * 100_000)]
    got = sorted(((r.doc_id, None if r.text is None else len(r.text), len(r.removed)) for r in
                  S.substring_dedup(frame(rows)).collect()), key=str)
    n = len(long)
    assert got == sorted([(1, None, 0), (2, 0, 0), (3, 5, 0), (4, n, 0), (5, 0, 1), (5, 0, 1), (None, n, 0), (6, 100_000, 0)], key=str)
    for passages in (False, True):
        assert S.substring_dedup(frame([]), passages=passages).count() == 0


def test_repeats_inside_one_document(frame):
    rng = random.Random(2)
    line = sentence(rng, 30)
    text = f"{line}\nother words here\n{line}"
    for i in (1, None):
        got = S.substring_dedup(frame([(i, text)])).first()
        assert got.text == f"{line}\nother words here\n" and len(got.removed) == 1


def test_passages_inside_sentences_go(frame):
    rng = random.Random(4)
    passages = [plain(rng, n) for n in (50, 51, 60, 90, 200, 700)]
    rows = [(i, f"{plain(rng, 7)} {passages[i % 6]} {plain(rng, 70)}.\n{plain(rng, rng.randrange(9))}") for i in range(60)]
    rows += [(60, f"{plain(rng, 8)} {passages[2].upper()}! {plain(rng, 3)}, {passages[3].replace(' ', ' - ', 9)}? ok")]
    rows += [(61, f"{(own := plain(rng, 55))} {plain(rng, 30)} {own}"), (62, plain(rng, 500)), (63, None)]
    got, spans = both(S.substring_dedup(frame(rows + [(None, rows[0][1])]).repartition(4), passages=True))
    for i, text in rows[:60]:
        words = passages[i % 6].split()
        left = got[i].split()
        assert got[i] == text if i < 6 else len(spans[i]) == 1 and len(left) <= len(text.split()) - len(words) + 16
        assert set(text.split()) - set(words) <= set(left)
    assert len(spans[60]) == 2 and len(got[60].split()) <= 8 + 3 + 1 + 32 + 9
    assert 85 <= len(got[61].split()) <= 101 and got[61].startswith(own)
    assert [got[i] for i in (62, 63, None)] == [dict(rows)[i] for i in (62, 63, 0)]
    stays(got, [(i, t, spans[i]) for i, t in rows if t])


def test_no_41_words_of_an_earlier_document_stay(frame):
    """Brute force over all windows, on passages that share parts and edges."""
    rng = random.Random(6)
    pool, rows = plain(rng, 900).split(), []
    periodic = (plain(rng, 7) + " ") * 12
    for i in range(60):
        parts = []
        for _ in range(4):
            a = rng.randrange(800)
            parts += [plain(rng, rng.randrange(1, 60)), " ".join(pool[a:a + rng.randrange(5, 130)]) + rng.choice([".", "", "\n"])]
        rows.append((i, " ".join([*parts, periodic] if i % 3 == 0 else parts)))
    got, spans = both(S.substring_dedup(frame(rows).repartition(3), passages=True))
    stays(got, [(i, t, spans[i]) for i, t in rows])


def test_whole_table_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got, spans = both(S.substring_dedup(docs, passages=True))
    stays(got, [(r.doc_id, r.text, spans[r.doc_id]) for r in docs.orderBy("doc_id").collect()])


def test_rows_that_share_an_id_keep_their_own_places(frame):
    rng = random.Random(7)
    line, other = sentence(rng, 40), sentence(rng, 40)
    rows = [(1, line), (2, f"{line}\nmine"), (2, f"{other}\n{sentence(rng, 30)}")] + [(3, line)] * 300
    for passages in (False, True):
        got = sorted(r.text for r in S.substring_dedup(frame(rows), passages=passages).collect())
        assert got == sorted([line, "mine", rows[2][1]] + [""] * 300)


@pytest.mark.parametrize("extra", ["removed", "REMOVED", "id", "tid", "places", "hi", "c0", "maybe"])
def test_clashing_columns(frame, extra):
    rng = random.Random(9)
    line = sentence(rng, 30)
    df = frame([(1, line, 5), (2, f"{line}\nx", 6)], f"doc_id long, text string, {extra} int")
    got = sorted(S.substring_dedup(df, passages=True).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in got] == [line, "x"]
    if extra.lower() != "removed":
        assert [r[extra] for r in got] == [5, 6] and [len(r.removed) for r in got] == [0, 1]


def test_words_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(["é" * 40, "İx_y", "a1", "\n", "ſ", "ПРИ", "\ud800", "漢字"]) for _ in range(500)) + " " + "z" * 300 + " end"
    whole = S.words(text)
    monkeypatch.setattr(S, "PIECE", 37)
    assert all((a == b).all() for a, b in zip(whole, S.words(text)))
    assert [text[a:z] for a, z in zip(whole[0], whole[1])] == WORD.findall(text)
