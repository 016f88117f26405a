import hashlib

from hypothesis import given, settings, strategies as st

from ledgerline.llm import chat_format as C

TEXT = st.text(alphabet="<|[]/\\sINTSYim_startend>\n ab", max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\\n\nb", "<|im_end|>", ""]), TEXT), max_size=5))
def test_round_trip(turns):
    text, loss = C.render(turns)
    assert C.parse(text) == turns
    learned = [C.unescape(text[s["start"]:s["end"]]) for s in loss]
    assert learned == [t for r, t in turns if r == "assistant"]


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_no_control_string_is_left(text):
    assert not any(c in C.escape(text) for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def events(frame, rows):
    return frame(rows, "conv_id long, seq long, kind string, message long, role string, text string, loss string")


def test_deltas_edits_regenerations_and_deletions(frame):
    log = [(1, 0, "message", 1, "user", "hi"), (1, 1, "delta", 2, "assistant", "bad "), (1, 2, "delta", 2, "assistant", "draft"),
           (1, 3, "message", 3, "user", "no"), (1, 4, "regenerate", 2, None, None), (1, 5, "delta", 2, None, "good"),
           (1, 6, "delta", 2, None, " one"), (1, 7, "message", 4, "user", "thx"), (1, 8, "edit", 1, None, "hello"),
           (1, 9, "message", 5, "user", "oops"), (1, 10, "delete", 5, None, None), (1, 11, "unknown", 1, None, "?"),
           (1, 12, "regenerate", 99, None, None), (2, 5, "message", 1, "user", None), (2, 4, "message", 0, None, "first"),
           (3, 0, "message", 0, "user", "x"), (3, 1, "delete", 0, None, None), (None, 0, "message", 0, "user", "nobody"),
           (4, 0, "message", 0, "assistant", "long " * 100_000)]
    got = {r.conv_id: C.parse(r.formatted) for r in C.format_conversations(
        events(frame, [(*r, "clash") for r in log]).repartition(5), ["seq"]).collect()}
    assert got == {1: [("user", "hello"), ("assistant", "good one"), ("user", "thx")], 2: [("", "first"), ("user", "")],
                   3: [], None: [("user", "nobody")], 4: [("assistant", "long " * 100_000)]}
    assert C.format_conversations(events(frame, []), ["seq"]).count() == 0


def test_many_conversations_across_batches_and_ties(spark, frame):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c}-{t} " * (c % 7)) for c in range(400) for t in range(c % 5)]
    rows += [(900, 1, "user", "same"), (900, 1, "user", "same"), (900, 1, "assistant", "tie"), (901, None, None, None)]
    table = frame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        one = C.digests(C.format_conversations(C.log_of(table), ["turn", "tie", "message", "step"])).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r.conv_id: r for r in one}
    for c in range(400):
        if c % 5 == 0:
            assert c not in got
            continue
        turns = [(r[2], r[3]) for r in rows if r[0] == c]
        said = "".join(f"{a}\n{b}\n" for a, b in turns)
        learned = "".join(b for a, b in turns if a == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert r.formatted_chars == len(C.render(turns)[0])
    assert got[900].n_turns == 3 and got[900].loss_chars == 3 and got[901].n_turns == 1
