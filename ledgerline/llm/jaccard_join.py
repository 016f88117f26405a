"""N-gram Jaccard self-join of documents by MinHash banding.

1. Each text becomes its set of 64-bit hashes of five-word shingles (lower-cased
   words between white space; a text of fewer words is one shingle), a MinHash
   signature cut into bands, and a digest of the whole set.
2. Texts with equal sets are copies: one representative stands for them.
3. Representatives that share a band hash are candidates. Candidates are dealt
   into blocks of about ``BLOCK`` texts or ``BLOCK_SHINGLES`` shingles: small
   groups of candidates (components of the bucket graph) share a block, large
   groups are spread over several. Two blocks meet only if some bucket has
   members in both, so a hot bucket becomes many equal tasks.
4. Where blocks meet, the pairs that share a band are verified on their full
   shingle sets. Instead of pairs, a task returns for each text how many links
   it has and one edge to the least text it hangs together with, so the output
   stays in proportion to the texts. Every pair meets in one block pair only.
5. Components of those edges are the classes.

``choose_bands`` takes the longest bands whose recall for a pair at the
threshold reaches the target within the number of hashes allowed.

Defined results: null and empty texts have no shingles, link to nothing and are
classes of their own; every distinct shingle set is a node of its own, so rows
that share an id but not a set are judged apart and repeated rows are copies of
each other; rows with a null id get a null class; an empty table gives no rows.
Texts are read whole. Only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm import textstats
from ledgerline.llm.common import checkpointed, written
from ledgerline.llm.components import connected_components

NGRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.999, 160
BLOCK, BLOCK_SHINGLES = 256, 400_000


def choose_bands(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have at the target recall."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, n: int = NGRAM) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, codes, bounds = textstats.word_codes(pc.utf8_lower(texts))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))[codes] \
        if len(codes) else np.zeros(0, np.uint64)
    place = _odd(n, 1)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        w = hashes[lo:hi]
        if len(w) >= n:
            h = sum(w[i:len(w) - n + 1 + i] * place[i] for i in range(n))
        else:
            h = sum(w[i:i + 1] * place[i] for i in range(len(w))) if len(w) else w
        out.append(np.unique(_mix(h)))
    return out


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes, one row per set (an empty set has a row of zeros)."""
    a, b = _odd(bands * rows, 2)[:, None], _odd(bands * rows, 3)[:, None]
    sig = np.zeros((len(sets), bands * rows), np.uint64)
    for i, s in enumerate(sets):
        low = None
        for lo in range(0, len(s), 2048):
            m = ((s[None, lo:lo + 2048] ^ b) * a).min(1)
            low = m if low is None else np.minimum(low, m)
        if low is not None:
            sig[i] = low
    weight = _odd(rows, 4)
    folded = (_mix(sig).reshape(len(sets), bands, rows) * weight).sum(2, dtype=np.uint64)
    return _mix(folded).view(np.int64)


def _digests(s: np.ndarray) -> tuple[int, int]:
    raw = s.tobytes()
    return tuple(int(np.uint64(xxhash.xxh64_intdigest(raw, seed)).astype(np.int64)) for seed in (11, 12))


def _features(bands: int, rows: int, n: int):
    def run(batches):
        for batch in batches:
            for part in textstats.slices(batch, 1):
                sets = shingle_sets(textstats.filled(part.column(1)), n)
                both = [_digests(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([d[0] for d in both], pa.int64()),
                     pa.array([d[1] for d in both], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([r.tobytes() for r in signatures(sets, bands, rows)], pa.binary())],
                    names=["doc_id", "tid", "hi", "lo", "size", "bands"])
    return run


def _sets(n: int):
    def run(batches):
        for batch in batches:
            for part in textstats.slices(batch, 1):
                sets = shingle_sets(textstats.filled(part.column(1)), n)
                both = [_digests(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([d[0] for d in both], pa.int64()), pa.array([d[1] for d in both], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())],
                    names=["rep", "hi", "lo", "shingles"])
    return run


def _band_rows(bands: int):
    def run(batches):
        for b in batches:
            got = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(0).to_numpy(), bands)),
                 pa.array(np.tile(np.arange(bands, dtype=np.int32), b.num_rows)), pa.array(got)],
                names=["node", "band", "h"])
    return run


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at left[k] and right[k]."""
    if len(left) <= 4 * len(sets):
        out = np.zeros(len(left), np.int64)
        for k, (i, j) in enumerate(zip(left.tolist(), right.tolist())):
            a, b = sorted((sets[i], sets[j]), key=len)
            at = np.searchsorted(b, a)
            out[k] = (b[np.minimum(at, len(b) - 1)] == a).sum()
        return out
    # many pairs: products of 0/1 matrices over the shingles that two sets share
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.diff(flat, prepend=flat[:1] + np.uint64(1)) != 0) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    product = np.zeros((len(sets), len(sets)), np.float32)
    step, top = 8192, int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, top, step):
        a, b = np.searchsorted(column, (lo, lo + step))
        x = np.zeros((len(sets), step), np.float32)
        x[owner[a:b], column[a:b] - lo] = 1
        product += x @ x.T  # whole numbers below 2^24 are exact
    return product[left, right].astype(np.int64)


def _verify(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        bands = np.frombuffer(b"".join(pdf["bands"]), np.int64).reshape(len(pdf), -1)
        same = np.zeros((len(pdf), len(pdf)), bool)
        for k in range(bands.shape[1]):
            same |= bands[:, k, None] == bands[None, :, k]
        if key[0] != key[1]:
            side = pdf["block"].to_numpy()
            same &= side[:, None] != side[None, :]
        left, right = np.nonzero(np.triu(same, 1))
        used = np.unique(np.concatenate([left, right]))
        if not len(used):
            return pd.DataFrame({"node": [], "root": [], "links": []})
        back = np.zeros(len(pdf), np.int64)
        back[used] = np.arange(len(used))
        left, right = back[left], back[right]
        sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"].iloc[used]]
        size = np.array([len(s) for s in sets])
        inter = _intersections(sets, left, right)
        linked = inter >= threshold * (size[left] + size[right] - inter) - 1e-9
        left, right = left[linked], right[linked]
        node, copies = pdf["node"].to_numpy()[used], pdf["copies"].to_numpy()[used]
        links = np.bincount(left, copies[right], len(used)) + np.bincount(right, copies[left], len(used))
        root = node.copy()
        while True:  # least node of what hangs together here
            old = root.copy()
            np.minimum.at(root, left, old[right])
            np.minimum.at(root, right, old[left])
            if (root == old).all():
                break
        hit = links > 0
        return pd.DataFrame({"node": node[hit], "root": root[hit], "links": links[hit].astype(np.int64)})
    return run


def _classed(docs: DataFrame, id_col: str, text_col: str, ngram: int, threshold: float, recall: float) -> DataFrame:
    """(doc_id, tid, class_id, class_node, n_copies, n_links) of every row, where
    tid is a hash of the text and class_node the class's own number, null for
    rows that are in none."""
    bands, rows = choose_bands(threshold, recall, MAX_HASHES)
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tid"))
    features = written(texts.mapInArrow(
        _features(bands, rows, ngram), "doc_id long, tid long, hi long, lo long, size long, bands binary"), "shingle-features")
    # every set's number is drawn once, as the table is written
    classes = written(
        features.filter("size > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("size").alias("size"),
             F.first("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id()), "shingle-classes")

    # buckets with two different texts or more, and the least text of each;
    # written, so that the join deals both of its sides and can split a hot bucket
    members = classes.select("node", "bands").mapInArrow(_band_rows(bands), "node long, band int, h long")
    leaders = written(members.groupBy("band", "h").agg(F.min("node").alias("leader"), F.count("*").alias("n"))
                      .filter("n > 1").drop("n"), "bucket-leaders")
    starred = written(members.join(leaders, ["band", "h"]).select("node", "band", "h", "leader"), "buckets")
    groups = connected_components(starred, "node", "leader")
    candidates = checkpointed(classes.join(groups, "node").select("node", "rep", "hi", "lo", "copies", "size", "bands", "component"))

    # blocks: large groups get some of their own, the small ones share the rest
    sizes = candidates.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("w")).select(
        "component", "n", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("w") / BLOCK_SHINGLES)).alias("parts"), "w")
    small = sizes.filter("parts = 1").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("w")).first()
    shared = max(1, -(-small.n // BLOCK), -(-small.w // BLOCK_SHINGLES))
    block = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(
        # negative numbers, so that no large group meets a shared block
        -1 - F.abs(F.xxhash64("component", F.pmod(F.xxhash64("hi", "lo"), F.col("parts"))) / 2).cast("long"))
    dealt = checkpointed(candidates.join(sizes.select("component", "parts"), "component")
                         .withColumn("block", block).drop("component", "size"))
    # pairs of blocks that some bucket has members in; a shared block meets itself
    own = dealt.select(F.col("block").alias("a"), F.col("block").alias("b")).distinct()
    spread = (starred.select("node", "band", "h").join(dealt.filter("parts > 1").select("node", "block"), "node")
              .select("band", "h", "block").distinct())
    across = (spread.alias("x").join(spread.alias("y"), ["band", "h"]).filter("x.block < y.block")
              .select(F.col("x.block").alias("a"), F.col("y.block").alias("b")).distinct())
    meets = checkpointed(own.unionByName(across))

    sets = texts.select("doc_id", "text").join(dealt.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(
        _sets(ngram), "rep long, hi long, lo long, shingles binary").dropDuplicates(["rep", "hi", "lo"])
    loaded = dealt.join(sets, ["rep", "hi", "lo"])
    ends = meets.select("a", "b", F.col("a").alias("block")).unionByName(
        meets.filter("a <> b").select("a", "b", F.col("b").alias("block")))
    found = checkpointed(
        loaded.join(ends, "block").select("a", "b", "block", "node", "copies", "bands", "shingles")
        .groupBy("a", "b").applyInPandas(_verify(threshold), "node long, root long, links long"))

    classed = connected_components(found, "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = checkpointed(classes.select("hi", "lo", "node", "rep", "copies").join(links, "node", "left")
                         .join(classed, "node", "left").withColumn("component", F.coalesce("component", "node")))
    # the least id of each class; most are alone
    least = nodes.groupBy("component").agg(F.min("rep").alias("class_id"))
    result = nodes.join(least, "component")
    linked = features.filter("size > 0 AND doc_id IS NOT NULL").select("doc_id", "tid", "hi", "lo").join(
        result, ["hi", "lo"]).select(
        "doc_id", "tid", "class_id", F.col("component").alias("class_node"), F.col("copies").alias("n_copies"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = features.filter("size = 0 OR doc_id IS NULL").select(
        "doc_id", "tid", F.col("doc_id").alias("class_id"), F.lit(None).cast("long").alias("class_node"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone)


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (least id of the class), n_copies (documents with the
    same shingle set, itself included) and n_links (other documents whose
    similarity reaches the threshold, copies included). Jobs run while the
    result is built; what they need later is written to the shared folder."""
    return _classed(docs, id_col, text_col, ngram, threshold, recall).select("doc_id", "class_id", "n_copies", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class: of those with the least id, one with the least text
    hash. Rows that share an id or a text are judged by their own text. Rows
    without a shingle or without an id stay as they are."""
    classes = _classed(docs, id_col, text_col, NGRAM, THRESHOLD, RECALL).filter("class_node IS NOT NULL")
    # of a class's rows with its least id, one text stays: both are partial aggregates
    own = classes.select("class_node", "doc_id", "tid", "class_id")
    stays = own.filter("doc_id = class_id").groupBy("class_node").agg(F.min("tid").alias("kept_tid"))
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # no name of the input can clash
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    ident, text = F.col(at[id_col]).cast("long"), F.col(at[text_col])
    rows = rows.withColumn("keep_id", ident).withColumn("keep_tid", F.xxhash64(text))
    in_class = F.coalesce(text.rlike(r"\S"), F.lit(False)) & F.col("keep_id").isNotNull()
    kept = own.join(stays, "class_node").filter("doc_id = class_id AND tid = kept_tid").select(
        F.col("doc_id").alias("keep_id"), F.col("tid").alias("keep_tid")).distinct()
    one = rows.filter(in_class).join(kept, ["keep_id", "keep_tid"], "left_semi").dropDuplicates(["keep_id", "keep_tid"])
    return one.unionByName(rows.filter(~in_class)).drop("keep_id", "keep_tid").toDF(*docs.columns)
