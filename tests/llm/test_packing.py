import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from ledgerline.llm import packing  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(text):
    return packing.encoder(PATH).tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB'sTé²½ΣςİǅỀ́‍<|endoftext|>\x0b\x0c\x85  \n\t.,!?*#日_0123’", max_size=40), max_size=6))
def test_word_cache_equals_the_tokenizer(texts):
    flat, counts = packing.encoder(PATH).encode(pa.array(texts, pa.large_string()))
    at = 0
    for text, n in zip(texts, counts):
        assert flat[at:at + n].tolist() == plain_ids(text)
        at += n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_takes_the_tightest_bin(lengths):
    got = packing.best_fit(np.array(lengths, np.int64), 50).tolist()
    room, want = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(r, -b) for b, r in enumerate(room) if r >= lengths[i]]
        if fits:
            tight = min(fits)[0]
            assert room[got[i]] == tight
        else:
            room.append(50)
            assert got[i] == len(room) - 1
        room[got[i]] -= lengths[i]
    assert all(r >= 0 for r in room)


def pack_rows(spark, rows, capacity=64, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, text string, offset long, sequence_id string").repartition(parts)
    return packing.pack(df, PATH, capacity=capacity).collect()


def test_pieces_cover_every_document_and_sequences_have_no_gaps(spark):
    rng = np.random.default_rng(3)
    words = ["the", "nation", "über", "x" * 30, "no."]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 120))), 7, "clash") for i in range(150)]
    rows += [(200, None, 7, None), (201, "", 7, None), (202, "same text", 7, None), (202, "same text", 7, None),
             (203, "very long " * 5_000, 7, None), (None, "no id", 7, None)]
    got = pack_rows(spark, rows)
    assert set(got[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        ids = np.array([*plain_ids(text), 1], "<u4")
        want = sorted((k, s, len(ids[s:s + 64]), zlib.crc32(ids[s:s + 64].tobytes()))
                      for k, s in enumerate(range(0, len(ids), 64))) * (2 if doc_id == 202 else 1)
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc_id]) == sorted(want)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(sequences) <= total / 64 * 1.05 + 2


def test_empty_table_gives_no_rows(spark):
    assert pack_rows(spark, []) == []


def test_underfull_sequences_of_many_tasks_are_merged(spark):
    rows = [(i, "a b c", 0, "") for i in range(64)]  # 4 tokens each, one document a task at most
    got = pack_rows(spark, rows, capacity=32, parts=64)
    # 256 tokens; a sequence within SLACK of full is not filled further
    assert len({r.sequence_id for r in got}) <= -(-256 // (32 - packing.SLACK))
