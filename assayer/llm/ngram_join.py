"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are linked if the sets of their five-word shingles (of lower-cased words of letters and digits)
have a Jaccard similarity of at least `threshold`.

1. One pass gives each text its class (a hash of its words: equal classes are copies, similarity 1) and `bands`
   hashes of `rows` MinHash values each.  Only one text of each class goes on.
2. Texts that share a band are candidates.  In a band of up to PAIRS texts those pairs are linked whose MinHash values (the
   lowest byte of each) leave the threshold possible; in a larger one all are linked to the smallest of the band.  The components
   of these links hold every similar pair.  Bands are combined to (smallest, count) before the shuffle.
3. The texts of a component meet in blocks of at most `block` texts and BLOCK_BYTES bytes, or, in larger components, in pairs of
   blocks, so no task holds a whole large component.  Pairs that share a band compare their MinHash values step by step and
   are dropped when the posterior probability that their similarity reaches the threshold falls below `tolerance`;
   the rest are verified on the exact shingle sets.  A block returns counts of links by text and a spanning forest
   of its links, never the pairs.
4. The components of the forests are the classes of the result.

A pair at the threshold shares no band with a probability of (1 - threshold**rows) ** bands: 5e-8 by default.

Defined results: a null, empty or wordless text has no shingles, links to nothing and is a class of its own; a text of
one to four words has one shingle, of all its words; rows that repeat an id are documents of their own; class_id is the
smallest id of the class (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .components import components, salted_join
from .durable import discard, written

_NO_ID = -(1 << 63)
#: Texts of a band that are compared pair by pair before components are formed.
PAIRS = 64
#: Bytes of text in a block (one text may be longer).
BLOCK_BYTES = 1 << 20


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = tc.mix(np.arange(1, 2 * n + 1, dtype=tc.U))
    return (seeds[:n] >> tc.U(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> tc.U(32)).astype(np.uint32)


def signatures(shingles: np.ndarray, offs: np.ndarray, n: int) -> np.ndarray:
    """MinHash values, n for each text; of a text without shingles, zeros."""
    out = np.zeros((len(offs) - 1, n), np.uint32)
    full = np.flatnonzero(np.diff(offs) > 0)
    if len(full):
        low, at = (shingles >> tc.U(32)).astype(np.uint32), offs[full]
        values = np.empty_like(low)
        for k, (a, b) in enumerate(zip(*permutations(n), strict=True)):
            np.multiply(low, a, out=values)
            np.add(values, b, out=values)
            out[full, k] = np.minimum.reduceat(values, at)
    return out


def band_keys(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sigs), bands), tc.U)
    for b in range(bands):
        h = np.full(len(sigs), b + 1, tc.U)
        for r in range(rows):
            h = tc.mix(h * tc.U(0x9E3779B97F4A7C15) + sigs[:, b * rows + r].astype(tc.U))
        keys[:, b] = h
    return keys


def _profile(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in tc.slices(batches):
        w = tc.normal_words(batch.column("text"))
        hashes = w.hashes()
        none = pa.array(w.counts == 0)
        cls = pa.array(tc.signed(tc.wholes(hashes, w.first))) if len(hashes) else pa.array([0] * batch.num_rows, pa.int64())
        sigs = signatures(*tc.shingles(hashes, w.first, n), bands * rows)
        keys = band_keys(sigs, bands, rows)
        low = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bands * rows), len(sigs), [None, pa.py_buffer(sigs.astype(np.uint8).tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("tx"), pa.compute.if_else(none, pa.scalar(None, pa.int64()), cls), pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(tc.signed(keys.ravel()))), low, pa.array(np.diff(w.off))],
            ["rid", "tx", "cls", "bands", "low", "bytes"],
        )


def _band_links(batches: Iterator[pa.RecordBatch], values: int, threshold: float, tolerance: float) -> Iterator[pa.RecordBatch]:
    """For rows (key, cls, low) sorted by key, a link of each text to the smallest of those of its key that it hangs together with."""
    least = least_matches(threshold, tolerance, values)
    key, cls, low = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, values), np.uint8)
    for batch in _and_end(batches):
        if batch is not None and not batch.num_rows:
            continue
        if batch is not None:
            key, cls = (np.concatenate([x, np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64)]) for x, c in ((key, "key"), (cls, "cls")))
            own = b"".join(batch.column("low").to_pylist())
            low = np.concatenate([low, np.frombuffer(own, np.uint8).reshape(-1, values)])
        # The last key may go on in the next batch.
        whole = len(key) if batch is None else int(np.searchsorted(key, key[-1]))
        if whole:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _linked(key[:whole], cls[:whole], low[:whole], least)], ["u", "v"])
            key, cls, low = key[whole:], cls[whole:], low[whole:]


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _linked(key: np.ndarray, cls: np.ndarray, low: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = []
    for step in range(1, PAIRS):
        at = np.flatnonzero(key[step:] == key[:-step])
        if not len(at):
            break
        for some in np.array_split(at, len(at) // 20_000 + 1):
            pairs.append(np.stack([some, some + step], 1)[(low[some] == low[some + step]).sum(1) >= least])
    root = np.arange(len(key))
    if pairs:
        i, j = np.concatenate(pairs).T
        while True:
            before = root.copy()
            low_root = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low_root)
            np.minimum.at(root, j, low_root)
            root = root[root]
            if (root == before).all():
                break
    far = np.flatnonzero(cls[root] != cls)
    return cls[far], cls[root[far]]


@lru_cache(maxsize=32)
def least_matches(threshold: float, tolerance: float, seen: int) -> int:
    """The fewest equal values of `seen` with which a similarity, uniform beforehand, reaches the threshold with a probability of at least the tolerance."""
    x = (np.arange(20_000) + 0.5) / 20_000
    for m in range(seen + 1):
        log = m * np.log(x) + (seen - m) * np.log1p(-x)
        density = np.exp(log - log.max())
        if density[x >= threshold].sum() / density.sum() >= tolerance:
            return m
    return seen


def verified_pairs(ids: np.ndarray, offs: np.ndarray, sigs: np.ndarray, keys: np.ndarray, side: np.ndarray | None, threshold: float, tolerance: float, step: int = 16) -> Iterator[tuple[int, np.ndarray]]:
    """For each text i of a block, the texts j > i that it links to.

    ids, offs: numbers of the distinct shingles of each text.  side: only pairs of different sides count."""
    n = len(offs) - 1
    cand = np.zeros((n, n), bool)
    for b in range(keys.shape[1]):
        order = np.argsort(keys[:, b], kind="stable")
        same = np.flatnonzero(np.diff(np.concatenate([[False], keys[order, b][1:] == keys[order, b][:-1], [False]]).astype(np.int8)))
        for lo, hi in zip(same[::2], same[1::2], strict=True):
            group = order[lo : hi + 1]
            cand[np.ix_(group, group)] = True
    if side is not None:
        cand &= side[:, None] != side[None, :]
    sizes, marked = np.diff(offs), np.zeros(int(ids.max(initial=-1)) + 1, bool)
    for i in range(n):
        js = np.flatnonzero(cand[i, i + 1 :]) + i + 1
        # Sizes alone bound the similarity.
        js = js[np.minimum(sizes[js], sizes[i]) >= threshold * np.maximum(sizes[js], sizes[i])]
        equal = np.zeros(len(js), np.int32)
        for at in range(0, sigs.shape[1], step):
            if not len(js):
                break
            equal += (sigs[js, at : at + step] == sigs[i, at : at + step]).sum(1, dtype=np.int32)
            stay = equal >= least_matches(threshold, tolerance, min(at + step, sigs.shape[1]))
            js, equal = js[stay], equal[stay]
        if not len(js):
            continue
        own = ids[offs[i] : offs[i + 1]]
        marked[own] = True
        lengths = sizes[js]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(offs[js] - (ends - lengths), lengths)
        shared = np.add.reduceat(marked[ids[at]].astype(np.int64), ends - lengths)
        marked[own] = False
        yield i, js[shared >= threshold * (lengths + sizes[i] - shared) - 1e-9]


def _block(table: pa.Table, n: int, bands: int, rows: int, threshold: float, tolerance: float) -> pa.Table:
    """(u, null, documents linked to u) for each text with links, (u, v, null) for a forest of the links."""
    w = tc.normal_words(table.column("text"))
    shingles, offs = tc.shingles(w.hashes(), w.first, n)
    sigs = signatures(shingles, offs, bands * rows)
    values, numbers = np.unique(shingles, return_inverse=True)
    pair = np.unique(np.repeat(np.arange(len(offs) - 1), np.diff(offs)) * max(1, len(values)) + numbers)
    ids = pair % max(1, len(values))
    offs = np.searchsorted(pair // max(1, len(values)), np.arange(len(offs)))
    cls, copies = (np.asarray(table.column(c).to_numpy(), np.int64) for c in ("cls", "copies"))
    side = np.asarray(table.column("side").to_numpy(), np.int64) if table.column("cross")[0].as_py() else None
    links, root, forest = np.zeros(len(cls), np.int64), np.arange(len(cls)), []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, js in verified_pairs(ids, offs, sigs, band_keys(sigs, bands, rows), side, threshold, tolerance):
        links[i] += copies[js].sum()
        links[js] += copies[i]
        for j in js:
            if (a := top(i)) != (b := top(j)):
                root[b] = a
                forest.append((i, j))
    has = np.flatnonzero(links)
    pairs = np.array(forest, np.int64).reshape(-1, 2)
    out = pa.table({
        "u": pa.array(np.concatenate([cls[has], cls[pairs[:, 0]]])),
        "v": pa.concat_arrays([pa.nulls(len(has), pa.int64()), pa.array(cls[pairs[:, 1]])]),
        "n": pa.concat_arrays([pa.array(links[has]), pa.nulls(len(pairs), pa.int64())]),
    })
    del w, shingles, sigs, values, numbers, pair, ids
    tc.release()
    return out


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 4, tolerance: float = 1e-6, block: int = 1024) -> DataFrame:
    """Per row: rid (its id, the smallest long for null), tx (xxhash64 of its text), class_id, n_links (other rows that it links to),
    keep_rid and keep_tx (rid and tx of the row of its class that stays)."""
    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("rid"), F.xxhash64(f"`{text_col}`").alias("tx"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows_of = written(texts.mapInArrow(tc.tidy(lambda it: _profile(it, n, bands, rows)), "rid long, tx long, cls long, bands array<long>, low binary, bytes long"))
    classes = written(rows_of.where("cls is not null").groupBy("cls").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "tx")).alias("row"), F.min(F.when(F.col("rid") != _NO_ID, F.col("rid"))).alias("first_id"), F.first("bands").alias("bands"), F.first("low").alias("low"), F.first("bytes").alias("bytes")))

    keys = classes.select("cls", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("cls").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    banded = written(keys.join(shared, "key"))
    stars = banded.where(F.col("n") > PAIRS).select(F.col("cls").alias("u"), "v").where("u <> v")
    near = banded.where(F.col("n") <= PAIRS).join(classes.select("cls", "low").hint("merge"), "cls").select("key", "cls", "low")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = near.repartition(parts, "key").sortWithinPartitions("key", "cls").mapInArrow(tc.tidy(lambda it: _band_links(it, bands * rows, threshold, tolerance)), "u long, v long")
    candidates = components(links.union(stars))

    sizes = candidates.join(classes.select(F.col("cls").alias("node"), "bytes"), "node").groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("bytes").alias("held"))
    # Blocks of a component: as many as its texts and their bytes ask for.
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("held") / BLOCK_BYTES)).cast("int")
    members = written(salted_join(candidates, sizes.withColumn("blocks", blocks), "root", "node").join(classes.withColumnRenamed("cls", "node"), "node").select(F.col("node").alias("cls"), "copies", "bytes", "row.rid", "row.tx", "root", "blocks"))
    discard(banded, candidates)
    small, other = F.col("blocks") == 1, F.col("other").cast("long")
    texts_of, bytes_of = members.where(small).agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    # Small components share groups of about as many texts and bytes.
    groups = max(1, texts_of // block, bytes_of // BLOCK_BYTES)
    blocks = F.col("blocks")
    members = members.withColumn("side", F.pmod(F.xxhash64("cls", F.lit(7)), blocks).cast("long"))
    spread = members.withColumn("other", F.explode(F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1)))).withColumn("cross", ~small & (other != F.col("side")))
    spread = spread.withColumn("g", F.when(small, F.pmod(F.xxhash64("root"), F.lit(groups))).otherwise(F.xxhash64("root", F.least("side", other), F.greatest("side", other))))
    # The candidates grow with the corpus: both sides are shuffled at any size, never broadcast.
    spread = texts.join(spread.hint("merge"), ["rid", "tx"]).dropDuplicates(["cls", "other"])
    found = written(spread.select("g", "cls", "copies", "side", "cross", "text").groupBy("g").applyInArrow(lambda t: _block(t, n, bands, rows, threshold, tolerance), "u long, v long, n long"))

    links = found.where("v is null").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("links"))
    joined = components(found.where("v is not null").select("u", "v")).withColumnRenamed("node", "cls")
    classes = classes.drop("bands", "low", "bytes").join(joined, "cls", "left").join(links, "cls", "left")
    linked = classes.where("root is not null")
    heads = linked.groupBy("root").agg(F.min("first_id").alias("class_id"), F.min("row").alias("keep"))
    linked = salted_join(linked, heads, "root", "cls").select("cls", "class_id", "keep", "copies", "links")
    classes = linked.union(classes.where("root is null").select("cls", F.col("first_id").alias("class_id"), F.col("row").alias("keep"), "copies", "links"))
    classes = classes.select("cls", "class_id", "keep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    own = F.col("cls").isNull()
    return rows_of.select("rid", "tx", "cls").join(classes, "cls", "left").select(
        "rid", "tx", F.when(own, F.nullif("rid", F.lit(_NO_ID))).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("keep.rid", "rid").alias("keep_rid"), F.coalesce("keep.tx", "tx").alias("keep_tx"))
