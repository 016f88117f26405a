"""Periodic run detection in grammar-compressed texts.

A run is a stretch of words with smallest period q, at least ``MIN_WORDS`` long
and ``MIN_PERIODS`` periods long, that no neighbouring word extends. Every
document is compressed by Re-Pair: in rounds, each place takes the pair of
symbols that occurs more often than the pairs it overlaps, and all places that
took the same pair get one new symbol, until no pair is taken twice. A run lies
inside the text of some symbol and crosses the boundary between its halves, or
crosses a boundary of the symbols that are left, so only those boundaries are
searched: that of a symbol once, at its first place, and what is found there is
carried to every place where the symbol stands. Intervals of a period that lie
in larger ones of the same period are merged into them.

Words, and runs of three words, that are too rare in a document to stand in a
run cut it into pieces before the compression: a run of four periods holds each
of its words four times and each of its three-word stretches three times. Most
texts have no piece left. Counting uses hashes, whose collisions only keep more.

At a boundary, a period q is found as the distance between two occurrences of
the 2**j words before or behind it, for the 2**j that is q or more but less than
2q: in a run such words recur exactly q apart. Ranks of all stretches of 2**j
words, made by doubling, give those distances and then how far the period goes
to both sides, so the result is exact.

The work of a document is one task's; documents are independent, and nothing is
shuffled. Memory is about 4 bytes a word and doubling, for a text's pieces only.

Defined results: null and empty texts and texts without a word have no run and
an empty collapsed text; repeated rows, and rows with null or equal ids, are
taken one by one; an empty table gives no rows; columns of the input come back
unchanged and must not be called ``runs`` or ``collapsed``. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm import textstats
from ledgerline.llm.common import ship_package

MIN_WORDS, MIN_PERIODS = 6, 4
MIXES = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
RUN = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _often(hashes: np.ndarray, least: int) -> np.ndarray:
    """True where a hash occurs ``least`` times; now and then where it does not."""
    bits = max(8, int(len(hashes)).bit_length() + 2)
    slot = ((hashes ^ hashes >> np.uint64(29)) * MIXES[2] >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(slot, minlength=1)[slot] >= least


def _stretches(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of True."""
    edge = np.diff(np.concatenate([[0], keep.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def pieces(codes: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, piece of each) of the words that may stand in a run. ``unit`` is
    the document of each word; a run lies in one piece."""
    at = np.arange(len(codes))
    while len(at):
        h = (codes[at].astype(np.uint64) + np.uint64(1)) * MIXES[0] ^ unit.astype(np.uint64) * MIXES[1]
        h ^= h >> np.uint64(32)
        word = _often(h, MIN_PERIODS)
        three = word[:-2] & word[1:-1] & word[2:] & (unit[:-2] == unit[2:])
        if not three.any():
            return at[:0], unit[:0]
        first = np.flatnonzero(three)
        three[first] = _often(h[first] + h[first + 1] * MIXES[1] + h[first + 2] * MIXES[2], MIN_PERIODS - 1)
        # a change of unit between neighbouring starts breaks a stretch too
        starts, ends = _stretches(three)
        long = ends - starts >= MIN_WORDS - 2
        starts, n = starts[long], ends[long] + 2 - starts[long]
        shift = np.repeat(starts - (np.cumsum(n) - n), n)
        before, at, unit = len(at), at[np.arange(len(shift)) + shift], np.repeat(np.arange(len(n)), n)
        if len(at) > 0.9 * before:
            break
    return at, unit


def re_pair(symbols: np.ndarray, unit: np.ndarray):
    """Compress the pieces. -> (boundaries, places): a boundary (c, lo, hi) is a
    place c between two halves of the words lo to hi, once for each new symbol,
    then all those between the symbols left, where lo to hi is the whole piece.
    ``places`` has (which boundary, start) for every place of each new symbol."""
    n = len(symbols)
    seq, start = symbols.copy(), np.arange(n)
    last = np.append(unit[1:] != unit[:-1], True)
    end_of = np.append(np.flatnonzero(last) + 1, n)
    found, places, made, count = [], [], 0, int(symbols.max()) + 1
    while len(seq) > 1:
        a, b = seq[:-1], seq[1:]
        places_ok = np.flatnonzero(~last[:-1])
        keys, kind = np.unique(a[places_ok] * count + b[places_ok], return_inverse=True)
        # of a stretch of one symbol, every second place
        same = np.append(False, (a == b) & ~last[:-1])
        run_start = np.maximum.accumulate(np.where(same, 0, np.arange(len(seq))))
        own = (a[places_ok] != b[places_ok]) | ((places_ok - run_start[places_ok]) % 2 == 0)
        often = np.bincount(kind[own], minlength=len(keys))
        mixed = (keys.astype(np.uint64) * MIXES[0] >> np.uint64(32)).astype(np.int64)
        rank = np.zeros(len(seq) + 1, np.int64)  # of the pair at each place, shifted by one
        rank[places_ok + 1] = np.where(own & (often[kind] > 1), often[kind] << 32 | mixed[kind], 0)
        here = rank[places_ok + 1]
        taken = (here > rank[places_ok]) & (here > np.append(rank, 0)[places_ok + 2])
        taken &= np.bincount(kind[taken], minlength=len(keys))[kind] > 1
        if not taken.any():
            break
        where, kinds = places_ok[taken], kind[taken]
        used, first, new = np.unique(kinds, return_index=True, return_inverse=True)
        ends = np.append(start[1:], n)
        found.append(np.stack([start[where[first] + 1], start[where[first]], ends[where[first] + 1]]))
        places.append(np.stack([new + made, start[where]]))
        made += len(used)
        seq[where] = count + new
        count += len(used)
        gone = np.zeros(len(seq), bool)
        gone[where + 1] = True
        last[where] = last[where + 1]
        seq, start, last = seq[~gone], start[~gone], last[~gone]
    inner = np.flatnonzero(~last[:-1]) + 1
    piece = unit[start[inner]]
    begin_of = np.append(0, end_of)[:-1]
    found.append(np.stack([start[inner], begin_of[piece], end_of[piece]]))
    places.append(np.stack([made + np.arange(len(inner)), begin_of[piece]]))
    return np.concatenate(found, 1), np.concatenate(places, 1)


class _Ranks:
    """Ranks of the stretches of 1, 2, 4 ... words: equal where the words are.
    A stretch that occurs once has a rank of its own below 0."""

    def __init__(self, symbols: np.ndarray):
        self.n, self.of = len(symbols), []
        self.alone = -1 - np.arange(self.n)
        self.order: list[np.ndarray] = []
        self._add(np.arange(self.n), symbols)

    def _add(self, at: np.ndarray, key: np.ndarray) -> None:
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.append(True, key[1:] != key[:-1])
        many = ~(new & np.append(new[1:], True))
        rank = self.alone.copy()
        rank[at[many]] = np.cumsum(new)[many]
        self.of.append(rank.astype(np.int32 if self.n < 2**31 else np.int64))
        # the places of each stretch that occurs again, neighbours in the order
        self.order.append(at[many])

    def double(self) -> bool:
        """Ranks of twice as many words; False where no stretch occurs again."""
        rank, k = self.of[-1], 1 << len(self.of) - 1
        at = np.sort(self.order[-1])
        at = at[at + k < self.n]
        at = at[rank[at + k] >= 0]
        if not len(at):
            return False
        self._add(at, rank[at].astype(np.int64) * (self.n + 1) + rank[at + k])
        return len(self.order[-1]) > 0

    def neighbours(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """(next, previous) place of the stretch of 2**j words at each place, -1 without."""
        at, rank = self.order[j], self.of[j]
        after, before = np.full(self.n, -1), np.full(self.n, -1)
        pair = np.flatnonzero(rank[at[1:]] == rank[at[:-1]])
        after[at[pair]], before[at[pair + 1]] = at[pair + 1], at[pair]
        return after, before

    def matching(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many words from places x and y on (step 1), or before them (-1), are equal."""
        x, y, n = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        for j in reversed(range(len(self.of))):
            k = 1 << j
            at_x, at_y = (x, y) if step > 0 else (x - k, y - k)
            ok = (at_x >= 0) & (at_y < self.n)
            equal = np.zeros(len(x), bool)
            equal[ok] = self.of[j][at_x[ok]] == self.of[j][at_y[ok]]
            n += equal * k
            x, y = x + equal * k * step, y + equal * k * step
        return n


def crossing(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Runs (which boundary, start, end, period) across each boundary c, within
    its words lo to hi."""
    ranks, out = _Ranks(symbols), []
    c, lo, hi = bounds
    near, j = [], 0
    while True:
        k = 1 << j
        most = np.flatnonzero(hi - lo >= (MIN_WORDS if k == 1 else MIN_PERIODS * (k // 2 + 1)))
        if not len(most):
            break
        after, before = ranks.neighbours(j)
        for x in (c[most], c[most] - k):
            inside = (x >= lo[most]) & (x < ranks.n)
            own, x = most[inside], x[inside]
            for other in (after, before):
                y = other[x]
                q = np.abs(y - x)
                fits = (y >= 0) & (q <= k) & (2 * q > k)
                near.append(np.stack([own[fits], np.minimum(x, y)[fits], q[fits]]))
        j += 1
        if not ranks.double():
            break
    if near:
        which, x, q = np.unique(np.concatenate(near, 1), axis=1)
        begin = np.maximum(x - ranks.matching(x, x + q, -1), lo[which])
        end = np.minimum(x + q + ranks.matching(x, x + q, 1), hi[which])
        fits = (end - begin >= np.maximum(MIN_WORDS, MIN_PERIODS * q)) & (begin < c[which]) & (end > c[which])
        out = np.stack([which, begin, end, q])[:, fits]
        return np.unique(out, axis=1)
    return np.zeros((4, 0), np.int64)


def merged(unit: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals that no other of their unit and period holds, each with its
    smallest period, in order of unit, start and period."""
    if not len(begin):
        return unit, begin, end, period
    order = np.lexsort((-end, begin, period, unit))
    unit, begin, end, period = unit[order], begin[order], end[order], period[order]
    group = np.cumsum(np.append(True, (unit[1:] != unit[:-1]) | (period[1:] != period[:-1]))) * (int(end.max(initial=0)) + 1) + end
    outer = np.append(True, group[1:] > np.maximum.accumulate(group)[:-1])
    unit, begin, end, period = (x[outer] for x in (unit, begin, end, period))
    order = np.lexsort((period, end, begin, unit))
    unit, begin, end, period = (x[order] for x in (unit, begin, end, period))
    first = np.append(True, (unit[1:] != unit[:-1]) | (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))
    order = np.lexsort((period[first], begin[first], unit[first]))
    return tuple(x[first][order] for x in (unit, begin, end, period))


def runs_of(codes: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, ...]:
    """(unit, start, end, period) of all runs; starts and ends are places in ``codes``."""
    at, piece = pieces(codes, unit)
    if not len(at):
        return tuple(np.zeros((4, 0), np.int64))
    symbols = np.unique(piece * (int(codes.max()) + 1) + codes[at], return_inverse=True)[1]
    bounds, places = re_pair(symbols, piece)
    which, begin, end, q = crossing(symbols, bounds)
    # from a boundary's first place to all of them
    order = np.argsort(places[0], kind="stable")
    where, n = places[1][order], np.bincount(places[0], minlength=bounds.shape[1])
    first = np.cumsum(n) - n
    each = np.repeat(np.arange(len(which)), n[which])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(n[which]) - n[which], n[which])
    moved = where[first[which][each] + nth] - bounds[1][which][each]
    begin, length, q = begin[each] + moved, (end - begin)[each], q[each]
    return merged(unit[at[begin]], at[begin], at[begin] + length, q)


def _detected(text_at: int):
    def run(batches):
        for batch in batches:
            for part in textstats.slices(batch, text_at):
                vocabulary, codes, bounds = textstats.word_codes(textstats.filled(part.column(text_at)))
                codes = codes.astype(np.int64)
                unit, begin, end, q = runs_of(codes, np.repeat(np.arange(part.num_rows), np.diff(bounds)))
                # words in a run, behind its first period
                depth = np.zeros(len(codes) + 1, np.int64)
                np.add.at(depth, begin + q, 1)
                np.add.at(depth, end, -1)
                kept = np.cumsum(depth[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(kept)])[bounds]
                words = pa.array(vocabulary, pa.string()).take(pa.array(codes[kept]))
                collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words), " ")
                runs = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(unit, np.arange(part.num_rows + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(begin - bounds[unit]), pa.array(end - begin), pa.array(q)],
                                               names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays([*part.columns, runs, collapsed], names=[*part.schema.names, "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input's columns, ``runs`` (start, length, period in words, by start
    and period) and ``collapsed``: the words left when every run keeps its first
    period, joined by single spaces."""
    ship_package(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("runs", RUN), T.StructField("collapsed", T.StringType())])
    return docs.mapInArrow(_detected(docs.columns.index(text_col)), schema)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the contract's texts. With h = crc32 of the decimal id and
    g = floor(h / 10), documents whose h is a multiple of 10 have the words from
    g % n on replaced by repeats of their first ones."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    tail = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w").cast("long")
    tail = tail.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    planted = F.array_join(F.transform("w", lambda _, i: F.expr("w")[F.when(
        i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")]), " ")
    return tail.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of a result of ``periodic_runs``."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    out = found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
