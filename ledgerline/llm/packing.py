"""Best-fit packing by hierarchical residual packing.

Every task tokenises its documents, cuts those longer than a sequence and
best-fits the pieces into sequences of its own. Sequences that are (nearly)
full are final. The underfull ones move on as items of their present length to
an eighth of the tasks, which best-fit them again, round after round, until one
small task is left or a round no longer lowers their number. A sequence is one
row that carries its pieces, so no round joins anything.

Defined results: null text packs as empty (its end token alone); an empty table
gives no rows; repeated documents are packed as often as they occur; columns
other than the id and the text are not looked at, so none can clash. Texts of
any length are tokenised whole.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm import textstats
from ledgerline.llm.common import checkpointed

PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                   ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
BIN_DDL = ("fill long, items array<struct<doc_id:long, piece:int, start:long, length:long, "
           "ids_crc32:long, offset:long>>")
FIELDS = [f.name for f in PIECE]
SLACK = 8            # a sequence within this many tokens of full is final
FAN_IN = 8           # tasks of one round that feed one task of the next
BUFFER = 200_000     # pieces best-fitted together in the first round
BINS_PER_TASK = 20_000
CACHE_WORDS = 400_000  # per Python worker, about 100 MB
PUNCTUATION = ".,;:!?*$%&#|"


class WordEncoder:
    """Encodes texts through a cache of encoded words.

    White space is dropped by the tokenizer and no rule of it looks across
    ASCII white space, so a text's ids are those of its words, in order. It
    also lowers case and never joins a letter run with the punctuation after
    it, so ``Word,`` is looked up as ``word`` and ``,``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocabulary = self.tok.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.slot = {"": 0}  # lowered letter run, punctuation or odd word -> place
        self.starts, self.lens = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        runs = [w for w in words if w.isalpha()]
        if runs:
            # letter runs are encoded many to a call; each ends with an end-of-word id
            flat = np.concatenate(self._ids([" ".join(runs[i:i + 500]) for i in range(0, len(runs), 500)]))
            ends = np.flatnonzero(self.ends_word[flat]) + 1
            if len(ends) == len(runs) and ends[-1] == len(flat):
                self._add(runs, flat, np.diff(ends, prepend=0))
        if rest := [w for w in words if w not in self.slot]:
            ids = self._ids(rest)
            self._add(rest, np.concatenate(ids), np.array(list(map(len, ids)), np.int64))

    def _add(self, words: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        self.slot.update(zip(words, range(len(self.slot), len(self.slot) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.pool = np.concatenate([self.pool, flat])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        words = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(words.flatten())
        per_text = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        heads, tails = [], []
        for w in coded.dictionary.to_pylist():
            head = w.rstrip(PUNCTUATION)
            # above U+024F, and for the dotted capital I, lowering may depend on
            # the neighbours or leave a mark behind: left to the tokenizer
            if head.isalpha() and (head.isascii() or max(head) < "\u0250" and "\u0130" not in head):
                heads.append(head.lower())
                tails.append(w[len(head):])
            else:
                heads.append(w)
                tails.append("")
        if len(self.slot) > CACHE_WORDS:
            self.clear()
        new = [p for p in dict.fromkeys(heads) if p not in self.slot]
        new += [p for p in dict.fromkeys(tails) if p not in self.slot]
        if new:
            self._learn(list(dict.fromkeys(new)))
        place = np.empty(2 * len(heads), np.int64)
        place[0::2] = list(map(self.slot.__getitem__, heads))
        place[1::2] = list(map(self.slot.__getitem__, tails))
        pool, ends = _gather(self.pool, self.starts[place], self.lens[place])
        bounds = np.concatenate([[0], ends[1::2]])
        at = coded.indices.to_numpy(zero_copy_only=False)
        flat, ends = _gather(pool, bounds[at], np.diff(bounds)[at])
        return flat, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])])


def _gather(pool: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of ``pool`` one after the other, and where each ends."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lens), lens) + np.arange(total)], ends


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item by best fit, longest items first.

    ``free`` has bit r set while some open bin has r tokens left, so the
    tightest bin for an item is the lowest set bit at or above its length.
    """
    out = np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, made = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = free >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            bin_no = open_bins[room].pop()
            if not open_bins[room]:
                free &= ~(1 << room)
        else:
            room, bin_no, made = capacity, made, made + 1
        out[i] = bin_no
        if room > n:
            open_bins[room - n].append(bin_no)
            free |= 1 << (room - n)
    return out


def _bins_of_pieces(cols: dict[str, np.ndarray], capacity: int) -> pa.RecordBatch:
    bin_no = best_fit(cols["length"], capacity)
    order = np.lexsort((-cols["length"], bin_no))
    bin_no, cols = bin_no[order], {k: v[order] for k, v in cols.items()}
    first = np.flatnonzero(np.diff(bin_no, prepend=-1))
    before = np.cumsum(cols["length"]) - cols["length"]
    count = np.diff(np.append(first, len(bin_no)))
    cols["offset"] = before - np.repeat(before[first], count)
    fill = np.add.reduceat(cols["length"], first)
    items = pa.StructArray.from_arrays(
        [pa.array(cols[f.name], type=f.type) for f in PIECE], fields=list(PIECE))
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(bin_no)), pa.int32()), items)
    return pa.RecordBatch.from_arrays([pa.array(fill), lists], names=["fill", "items"])


def _pack_documents(path: str, capacity: int, end_id: int):
    def run(batches):
        enc, parts, held = encoder(path), [], 0
        for batch in batches:
            for part in textstats.slices(batch, 1):
                flat, counts = enc.encode(textstats.filled(part.column(1)))
                rows, at = [], 0
                for doc_id, n in zip(part.column(0).to_pylist(), counts.tolist()):
                    ids = np.empty(n + 1, "<u4")
                    ids[:n], ids[n] = flat[at:at + n], end_id
                    at += n
                    rows += [(doc_id, k, s, min(capacity, n + 1 - s), zlib.crc32(ids[s:s + capacity]))
                             for k, s in enumerate(range(0, n + 1, capacity))]
                parts += rows
                held = len(parts)
            if held >= BUFFER:
                yield _bins_of_pieces(_columns(parts), capacity)
                parts, held = [], 0
        if parts:
            yield _bins_of_pieces(_columns(parts), capacity)
    return run


def _columns(rows: list[tuple]) -> dict[str, np.ndarray]:
    # ids may be null: they stay Python objects until Arrow types them
    cols = list(zip(*rows))
    out = {"doc_id": np.array(cols[0], dtype=object)}
    return out | {k: np.array(v, np.int64) for k, v in zip(FIELDS[1:5], cols[1:])}


def _merge_bins(capacity: int):
    def run(batches):
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        if not rows:
            return
        # the order rows arrive in after a shuffle is not fixed: sort them
        rows.sort(key=lambda r: (-r[0], r[1][0]["doc_id"] or 0, r[1][0]["piece"], r[1][0]["ids_crc32"]))
        merged: dict[int, list] = {}
        for (fill, items), b in zip(rows, best_fit(np.array([r[0] for r in rows]), capacity).tolist()):
            to = merged.setdefault(b, [0, []])
            to[1] += [i | {"offset": i["offset"] + to[0]} for i in items]
            to[0] += fill
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in merged.values()], pa.int64()),
             pa.array([m[1] for m in merged.values()], pa.list_(PIECE))], names=["fill", "items"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Jobs run while the result is built: the first round, and one small round
    per level of the tree.
    """
    first = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bins = checkpointed(first.mapInArrow(_pack_documents(tokenizer_path, capacity, end_id), BIN_DDL))
    tasks = max(1, bins.rdd.getNumPartitions())
    final, rest, left = [], bins, None
    while True:
        final.append(rest.filter(F.col("fill") >= capacity - SLACK))
        under = rest.filter(F.col("fill") < capacity - SLACK)
        count = under.count()
        if count <= 1 or tasks == 1 or (left is not None and count > 0.99 * left):
            final.append(under)
            break
        # an eighth of the tasks, but never more bins than a task can hold
        tasks = max(-(-tasks // FAN_IN), -(-count // BINS_PER_TASK))
        left = count
        rest = checkpointed(under.repartition(tasks, F.xxhash64("items"))
                            .mapInArrow(_merge_bins(capacity), BIN_DDL))
    out = final[0]
    for f in final[1:]:
        out = out.unionByName(f)
    # numbered before the explode, so that one row (a sequence) gets one number
    numbered = out.select(F.monotonically_increasing_id().alias("sequence_id"), "items")
    return (numbered.select("sequence_id", F.explode("items").alias("i"))
            .select("i.doc_id", "i.piece", "i.start", "i.length", "i.ids_crc32", "sequence_id", "i.offset"))
