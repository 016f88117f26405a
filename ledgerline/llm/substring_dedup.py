"""Substring deduplication by hashing lines and word stretches.

Words are runs of letters and digits, in lower case; everything else is read as
a gap. Two kinds of units are hashed to 128 bits, into one table of digests:

* every line of ``LINE_WORDS`` words or more, whole;
* inside and across lines, stretches of ``GRAM`` words. Of every ``REACH``
  neighbouring stretches the one with the least hash is a unit, so that wherever
  ``GRAM + REACH - 1`` words stand, the same stretches of them are chosen.

Over the whole corpus the earliest occurrence of a digest - least document id,
then least place in that document - stays. A repeated line goes. Repeated
stretches go where they lie side by side (a gap of one word is closed) and cover
``MIN_WORDS`` words together. So whatever its sentence or line ends, no run of
``MIN_WORDS + 2 * (REACH - 1)`` words of an earlier document stays, and what does
stay of a longer passage is at most ``REACH - 1`` words at either edge. What is
removed is reported by its offsets in the original text. Left alone are repeated
lines of fewer than ``LINE_WORDS`` words ("All rights reserved.") and shorter
shared stretches inside lines.

A document is read whole by one task, which finds repeats inside the document
itself and sends each of its digests once. The least id per digest is aggregated
before and after the shuffle, in two longs. A second pass sends only digests
that a bitmap of the repeated ones may hold, and joins them with those; adaptive
execution splits a hot digest, as both sides are dealt for the join. The places
of a document that repeat, a set, meet its text in a last join, which takes only
the documents that a bitmap of ids may hold; the others are finished where they
are. Both bitmaps are sized by a count and at most ``MOST_BITS``; a full one
lets more through and changes no result. Building the result runs these jobs.

Defined results: null and empty texts have no units and stay as they are; rows
with a null id lose repeats within themselves only; rows that repeat an id are
one document to each other, and neither is cut for the other's sake; within a
document only a stretch that does not overlap the earlier one repeats it; a text
of which nothing but white space and punctuation is left keeps that rest; an
empty table gives no rows. Columns of the input come back unchanged beside the
new text, whatever their names, but for one that is called like the column of
removed spans: that one is replaced. Texts are read whole.
"""

from __future__ import annotations

import re
import sys
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm import textstats
from ledgerline.llm.common import written

LINE_WORDS = 12
MIN_WORDS = 25
GRAM, REACH = 16, 9
WINDOW = GRAM + REACH - 1
MOST_BITS = 1 << 27
PIECE = 1 << 20
STOPS = re.compile(r"[.!?]*")
GAP = re.compile(r"[\W_]")
BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F))


@lru_cache(maxsize=None)
def word_characters() -> np.ndarray:
    """Code point -> its lower-case form, 0 for what is no letter or digit."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.full(n, b, np.uint64)) for b in (int(base), pow(int(base), -1, 2**64)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * BASES[1]
    return h ^ h >> np.uint64(29)


def words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words, piece by piece of a long text."""
    found, lo = [], 0
    while lo < len(text):
        hi = lo + PIECE
        if hi < len(text):
            gap = GAP.search(text, hi)
            hi = gap.start() if gap else len(text)
        low = word_characters()[textstats.code_points(text[lo:hi])]
        edge = np.diff(np.concatenate([[0], (low > 0).astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(BASES[0], len(low))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low * up)])
        found.append((starts + lo, ends + lo, _mixed((sums[ends] - sums[starts]) * down[starts])))
        lo = hi
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _sliding(a: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (or another of its kind) of every ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        a, n = least(a[:-n], a[n:]), 2 * n
    return least(a[:-(width - n)], a[width - n:]) if n < width else a


class Units:
    """The units of several texts: text, place (first word), words, hi, lo.
    Stretches of GRAM words come first, then lines, each kind by place."""

    def __init__(self, texts: list[str], stretches: bool):
        joined = "\n".join(texts)
        self.begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.starts, self.ends, h = words(joined)
        self.first_word = np.searchsorted(self.starts, self.begin)
        text = np.repeat(np.arange(len(texts)), np.diff(self.first_word))
        # lines, by the words between line ends
        newline = np.flatnonzero(textstats.code_points(joined) == 10) if joined else np.zeros(0, np.int64)
        self.newline = np.append(newline, len(joined))
        line = np.concatenate([[0], np.searchsorted(self.starts, self.newline)])
        long = np.flatnonzero(np.diff(line) >= LINE_WORDS)
        sums, down = [], []
        for base, own in ((BASES[1], h), (BASES[2], _mixed(h))):
            up, inverse = _powers(base, len(h))
            sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * up)]))
            down.append(inverse)
        kinds = [(line[long], line[long + 1] - line[long])]
        if stretches and len(h) >= WINDOW:
            gram = (sums[0][GRAM:] - sums[0][:-GRAM]) * down[0][:len(h) - GRAM + 1]
            rank = _mixed(gram) | np.uint64(1)
            # windows that reach into the next text choose nothing
            least = np.where(text[:-(WINDOW - 1)] == text[WINDOW - 1:], _sliding(rank, REACH, np.minimum), np.uint64(0))
            at = np.flatnonzero(rank == _sliding(np.pad(least, REACH - 1), REACH, np.maximum))
            kinds.insert(0, (at, np.full(len(at), GRAM)))
        self.n_stretches = len(kinds[0][0]) if len(kinds) > 1 else 0
        self.place, self.words = (np.concatenate(x) for x in zip(*kinds))
        size = self.words.astype(np.uint64) * np.uint64(2) + (np.arange(len(self.words)) < self.n_stretches)
        self.text = text[self.place] if len(self.place) else np.zeros(0, np.int64)
        self.hi, self.lo = (_mixed((s[self.place + self.words] - s[self.place]) * d[self.place] ^ _mixed(size)) if len(self.place)
                            else np.zeros(0, np.uint64) for s, d in zip(sums, down))

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, again) of each unit: whether it is the first of its digest in
        its text; whether it repeats the first without overlapping it."""
        key = self.hi ^ _mixed(self.text.astype(np.uint64))
        order = np.argsort(key, kind="stable")
        same = (key[order][1:] == key[order][:-1]) & (self.lo[order][1:] == self.lo[order][:-1])
        new = np.append(True, ~same)[:len(order)]
        head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
        first, again = np.zeros((2, len(order)), bool)
        first[order] = new
        again[order] = ~new & (self.place[order] >= self.place[order[head]] + self.words[order])
        return first, again

    def local_place(self, which: np.ndarray) -> np.ndarray:
        """Place in the text, doubled, and odd for a line."""
        return (self.place[which] - self.first_word[self.text[which]]) * 2 + (which >= self.n_stretches)


def _texts(batch: pa.RecordBatch, at: int):
    for part in textstats.slices(batch, at, PIECE):
        yield part, textstats.filled(part.column(at)).to_pylist()


def _digest_rows(stretches: bool):
    """(hi, lo, id): every digest of a document once."""
    def run(batches):
        for batch in batches:
            for part, texts in _texts(batch, 1):
                u = Units(texts, stretches)
                first = u.repeats()[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.hi[first].view(np.int64)), pa.array(u.lo[first].view(np.int64)),
                     part.column(0).take(pa.array(u.text[first]))], names=["hi", "lo", "id"])
    return run


def _wanted_rows(stretches: bool, shared):
    """(hi, lo, id, tid, place) of the digests that the bitmap may hold; those
    that repeat inside their document need no other one."""
    def run(batches):
        bits = shared.value
        for batch in batches:
            for part, texts in _texts(batch, 1):
                u = Units(texts, stretches)
                which = np.flatnonzero(~u.repeats()[1] & _holds(bits, u.hi.view(np.int64)))
                text = pa.array(u.text[which])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.hi[which].view(np.int64)), pa.array(u.lo[which].view(np.int64)), part.column(0).take(text),
                     part.column(2).take(text), pa.array(u.local_place(which))], names=["hi", "lo", "id", "tid", "place"])
    return run


def _holds(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & (len(bits) * 8 - 1)
    return bits[at >> 3] >> (at & 7) & 1 > 0


def bitmap(keys: DataFrame, column: str, n: int) -> np.ndarray:
    """The bits of the low ends of ``n`` keys, eight or more for each key up to
    MOST_BITS, brought to the driver in maps of 4 KB."""
    size = min(MOST_BITS, max(1 << 15, 1 << (8 * n).bit_length()))
    bit = (F.col(column).bitwiseAND(F.lit(size - 1)) + 1).alias("bit")  # buckets of 2**15 bits count from 1
    out = np.zeros(size // 8, np.uint8)
    maps = keys.select(bit).groupBy(F.expr("bitmap_bucket_number(bit)").alias("part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
    for r in maps.toLocalIterator():
        out[(r.part - 1) << 12:r.part << 12] = np.frombuffer(r.bits, np.uint8)
    return out


def repeated_places(texts: DataFrame, stretches: bool) -> DataFrame:
    """(id, tid, places): the units of a document that an earlier one holds, as
    ``Units.local_place`` gives them. ``texts`` has id, text and tid, a hash of
    the text: rows may share an id."""
    texts = texts.filter("id IS NOT NULL AND text IS NOT NULL")
    digests = texts.mapInArrow(_digest_rows(stretches), "hi long, lo long, id long")
    # written, so that the join deals both of its sides itself: only then can
    # adaptive execution split the tasks of a hot digest
    first = written(digests.groupBy("hi", "lo").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
                    .filter("first_id < last_id").drop("last_id"), "repeated-digests")
    shared = texts.sparkSession.sparkContext.broadcast(bitmap(first, "hi", first.count()))
    wanted = texts.mapInArrow(_wanted_rows(stretches, shared), "hi long, lo long, id long, tid long, place long")
    later = wanted.join(first, ["hi", "lo"]).filter("id > first_id")
    return written(later.groupBy("id", "tid").agg(F.collect_set("place").alias("places")), "repeated-places")


def _spans(u: Units, t: int, text: str, gone: np.ndarray, lines: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint spans of a text. ``gone`` marks the words that go, by the word's
    place in the text; ``lines`` holds the first words of lines that go whole."""
    lo = u.first_word[t]
    starts, ends = u.starts[lo:u.first_word[t + 1]] - u.begin[t], u.ends[lo:u.first_word[t + 1]] - u.begin[t]
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    spans = [(int(starts[a]), STOPS.match(text, int(ends[z - 1])).end())
             for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    for w in lines:
        k = np.searchsorted(u.newline, u.starts[lo + w])
        begin = max(0, int(u.newline[k - 1] + 1 - u.begin[t])) if k else 0
        spans.append((begin, min(len(text), int(u.newline[k] + 1 - u.begin[t]))))
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(z, out[-1][1])
        else:
            out.append((a, z))
    return out


def _cut_texts(texts: list[str], marks: list, stretches: bool, min_words: int):
    """(texts without their repeats, spans of each)."""
    u = Units(texts, stretches)
    own = np.flatnonzero(u.repeats()[1])
    local, of = u.local_place(own), u.text[own]
    bounds = np.searchsorted(of[np.argsort(of, kind="stable")], np.arange(len(texts) + 1))
    local = local[np.argsort(of, kind="stable")]
    out, spans = [], []
    for t, text in enumerate(texts):
        given = marks[t]
        places = local[bounds[t]:bounds[t + 1]]
        if given is not None and len(given):
            places = np.concatenate([places, np.asarray(given, np.int64)])
        if not len(places):
            out.append(text), spans.append([])
            continue
        n = int(u.first_word[t + 1] - u.first_word[t])
        line, stretch = places[places & 1 == 1] >> 1, places[places & 1 == 0] >> 1
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, stretch, 1)
        np.add.at(cover, stretch + GRAM, -1)
        gone = np.cumsum(cover[:-1]) > 0
        gone[1:-1] |= gone[:-2] & gone[2:]
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            if z - a < min_words:
                gone[a:z] = False
        cuts = _spans(u, t, text, gone, line)
        spans.append([{"start": a, "end": z} for a, z in cuts])
        out.append("".join(text[a:z] for a, z in zip([0] + [z for _, z in cuts], [a for a, _ in cuts] + [len(text)])))
    return out, spans


def _apply(text_at: int, stretches: bool, min_words: int, shared=None):
    """Rows with a last column of places -> the same with cut texts and spans.
    With a shared bitmap the last column is a key instead, and only the rows are
    taken whose key it does not hold: nothing outside of them repeats in these."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            if shared is not None:
                batch = batch.filter(pa.array(~_holds(shared.value, batch.column(batch.num_columns - 1).to_numpy())))
            for b, texts in _texts(batch, text_at):
                places = [None] * len(texts) if shared is not None else [x.values if x.is_valid else None for x in b.column(b.num_columns - 1)]
                new, spans = _cut_texts(texts, places, stretches, min_words)
                cols = [b.column(i) for i in range(b.num_columns - 1)]
                cols[text_at] = pc.if_else(pc.is_valid(cols[text_at]), pa.array(new, pa.string()), pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays(cols + [pa.array(spans, span)], names=[*b.schema.names[:-1], "removed"])
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                    passages: bool = False, removed_col: str = "removed") -> DataFrame:
    """The input's columns, the text without its repeats, and ``removed``: the
    spans (start, end) cut out, as offsets in the original text. ``passages``
    also cuts what repeats inside and across lines; without it only lines go."""
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() != removed_col.lower()])
    at = {c: i for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*[f"c{i}" for i in range(len(at))])  # no name of the input can clash
    text = F.col(f"c{at[text_col]}")
    rows = rows.withColumn("id", F.col(f"c{at[id_col]}").cast("long")).withColumn("tid", F.xxhash64(text))
    places = repeated_places(rows.select("id", text.alias("text"), "tid"), passages)
    bits = bitmap(places.select(F.xxhash64("id").alias("key")), "key", places.count())
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def may_repeat(key: pd.Series) -> pd.Series:
        return pd.Series(_holds(shared.value, key.to_numpy()))

    schema = T.StructType([*docs.schema.fields, T.StructField(removed_col, T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    key = F.xxhash64("id")
    joined = rows.filter(may_repeat(key)).join(places, ["id", "tid"], "left").drop("id", "tid")
    rest = rows.withColumn("key", key).drop("id", "tid")
    return joined.mapInArrow(_apply(at[text_col], passages, min_words), schema).union(
        rest.mapInArrow(_apply(at[text_col], passages, min_words, shared), schema))
