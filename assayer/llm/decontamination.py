"""Benchmark decontamination by size-partitioned MinHash containment search.

An item leaks into a document if at least `threshold` of the item's distinct five-word shingles (of lower-cased words of
letters and digits) occur in the document.

A short item has a tiny Jaccard similarity with a long document, so documents are cut into windows that suit the item:
items are partitioned by size, into classes c = 8, 12, 16, 24, 32 ... words, and for class c a document is read as windows
of 2c words that begin every c words.  Each occurrence of at most c words lies inside one window, where its similarity is
at least about a quarter.  Window and item become candidates if one of `hashes` MinHash values is equal; each
candidate pair of document and item is then verified on the exact shingle sets of the whole document.

The windows' values come from minima over blocks of four words that are combined from class to class, so each hash costs
one pass over the words whatever the number of classes.  The search is map-only: nothing of the documents is shuffled.
Items are sent to the tasks in blocks of at most `item_block`, one pass over the documents for each block, so what is
broadcast has a bound that doesn't depend on the number of items.

An item of containment t in a window of similarity J is missed with a probability of (1 - J) ** hashes: with J of 0.19 and
64 hashes 1.4e-6.  Of an item with m distinct shingles a window that holds the share t has a J of at least t m / (2c + (1 - t) m).
Items for which that is below 0.19 (those that repeat themselves) and all of up to six words are found exactly instead:
their shingles' hashes are looked up among the documents', and those of which the share t is there are candidates.

Defined results: null, empty or wordless texts hold nothing, and wordless items leak nowhere; an item of one to four words
has one shingle, of all its words, and is found where a document has the same run of words; rows that share an id are
found each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc
from .ngram_join import permutations, signatures

UNIT = 4
#: Least similarity of a window for which MinHash is used, and most words of the items that never use it.
LEAST_J, SHORT = 0.19, 6


def size_class(words: int) -> int:
    """The least of 8, 12, 16, 24, 32, 48 ... that is at least words."""
    c = 8
    while c < words:
        c = c + c // 2 if c & (c - 1) == 0 else c // 3 * 4
    return c


class Items:
    """A block of items: shingles of each, and for each size class the MinHash values to look for."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, n: int, hashes: int, threshold: float):
        w = tc.normal_words(texts)
        self.ids, self.n, self.hashes, self.threshold = ids, n, hashes, threshold
        h = w.hashes()
        # Items below n words are looked for as runs of their own length.
        self.shingles = [np.unique(tc.runs(h[a:b], min(n, b - a))) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.words = w.counts
        self.lengths = sorted({int(min(n, c)) for c in self.words if c})
        self.classes, self.direct = {}, {}
        for length in self.lengths:
            of = [i for i, c in enumerate(self.words) if c and min(n, c) == length]
            exact = [i for i in of if self._is_exact(i)]
            of = sorted({*of} - {*exact})
            if exact:
                keys, owner = np.concatenate([self.shingles[i] for i in exact]), np.repeat(exact, [len(self.shingles[i]) for i in exact])
                order = np.argsort(keys, kind="stable")
                seen = np.zeros(1 << 16, bool)
                seen[(keys & tc.U(0xFFFF)).astype(np.int64)] = True
                self.direct[length] = keys[order], owner[order], seen
            by_class: dict[int, list[int]] = {}
            for i in of:
                by_class.setdefault(size_class(int(self.words[i])), []).append(i)
            tables = {}
            for c, own in by_class.items():
                values = signatures(np.concatenate([self.shingles[i] for i in own]), np.cumsum([0, *(len(self.shingles[i]) for i in own)]), hashes)
                order = np.argsort(values, axis=0, kind="stable")
                tables[c] = (np.array(own)[order], np.take_along_axis(values, order, 0))
            self.classes[length] = tables
        self._filters: dict[tuple[int, int], list[np.ndarray]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_filters": {}}

    def filters(self, length: int, c: int) -> list[np.ndarray]:
        """For each hash, which low halves of values occur; made once in each worker, as they are larger than what they are made of."""
        if (length, c) not in self._filters:
            _, values = self.classes[length][c]
            own = np.zeros((self.hashes, 1 << 16), bool)
            for k in range(self.hashes):
                own[k, values[:, k] & 0xFFFF] = True
            self._filters[length, c] = list(own)
        return self._filters[length, c]

    def _is_exact(self, i: int) -> bool:
        m = len(self.shingles[i])
        return self.words[i] <= SHORT or self.threshold * m < LEAST_J * (2 * size_class(int(self.words[i])) + (1 - self.threshold) * m)

    def search(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, shared share) of every leak."""
        w = tc.normal_words(texts)
        hashes = w.hashes()
        docs, items, shares = [], [], []
        for length in self.lengths:
            if len(hashes) < length:
                continue
            runs = tc.runs(hashes, length)
            # Shingles that reach beyond their text don't count.
            alive = np.arange(len(runs)) + length <= np.repeat(w.first[1:], w.counts)[: len(runs)]
            pairs = np.concatenate([self._looked_up(runs, alive, w.first, length), self._candidates(runs, alive, w.first, length)])
            found = np.unique(pairs[:, 0])
            pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
            begin = np.searchsorted(pairs[:, 0], found)
            for d, at, end in zip(found, begin, np.append(begin, len(pairs))[1:], strict=True):
                lo, hi = w.first[d], min(w.first[d + 1], len(runs))
                own = np.unique(runs[lo:hi][alive[lo:hi]])
                for i in pairs[at:end, 1]:
                    want = self.shingles[i]
                    at = np.searchsorted(own, want)
                    share = float((own[np.minimum(at, len(own) - 1)] == want).mean()) if len(own) else 0.0
                    if share >= self.threshold - 1e-12:
                        docs.append(d)
                        items.append(i)
                        shares.append(share)
        return np.array(docs, np.int64), np.array(items, np.int64), np.array(shares)

    def _looked_up(self, runs: np.ndarray, alive: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
        """Pairs of document and item of which the document has the threshold's share of shingles."""
        none = np.zeros((0, 2), np.int64)
        if length not in self.direct:
            return none
        keys, owner, seen = self.direct[length]
        at = np.flatnonzero(seen[(runs & tc.U(0xFFFF)).astype(np.int64)] & alive)
        # Each shingle of a document once, however often it stands there.
        doc = np.searchsorted(first, at, "right") - 1
        values, where = np.unique(runs[at], return_inverse=True)
        lo, hi = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
        there = hi[where] > lo[where]
        if not there.any():
            return none
        own = np.unique(doc[there] * len(values) + where[there])
        doc, where = own // len(values), own % len(values)
        count = (hi - lo)[where]
        entry = np.repeat(lo[where], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        pairs, n = np.unique(np.repeat(doc, count) * len(self.ids) + owner[entry], return_counts=True)
        doc, item = pairs // len(self.ids), pairs % len(self.ids)
        size = np.array([len(self.shingles[i]) for i in item])
        enough = n / size >= self.threshold - 1e-12
        return np.stack([doc, item], 1)[enough]

    def _candidates(self, runs: np.ndarray, alive: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
        """Distinct pairs of document and item with an equal MinHash value in a window."""
        tables = {c: (*table, self.filters(length, c)) for c, table in self.classes[length].items()}
        if not tables:
            return np.zeros((0, 2), np.int64)
        n = len(runs)
        top = max(tables)
        padded = -(-n // (2 * UNIT)) * 2 * UNIT
        low = np.full(padded, 0xFFFFFFFF, np.uint32)
        low[:n] = (runs >> tc.U(32)).astype(np.uint32)
        dead = np.ones(padded, bool)
        dead[:n] = ~alive
        values, out = np.empty_like(low), []
        for k, (a, b) in enumerate(zip(*permutations(self.hashes), strict=True)):
            np.multiply(low, a, out=values)
            np.add(values, b, out=values)
            values[dead] = 0xFFFFFFFF
            half = np.minimum(values[0::2], values[1::2])
            unit = np.minimum(half[0::2], half[1::2])
            # level[c]: minima over c words from every multiple of c (c = 4 * 2**j), thirds: over 12 * 2**j.
            level, c = unit, UNIT
            while c < top:
                pair = np.minimum(level[0 : len(level) - 1 : 2], level[1::2]) if len(level) > 1 else level[:0]
                if len(level) % 2:
                    pair = np.concatenate([pair, level[-1:]])
                if 3 * c in tables:
                    self._match(_windows(_triples(level)), 3 * c, k, tables, first, n, out)
                level, c = pair, 2 * c
                if c in tables:
                    self._match(_windows(level), c, k, tables, first, n, out)
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)

    @staticmethod
    def _match(window: np.ndarray, c: int, k: int, tables: dict, first: np.ndarray, n: int, out: list) -> None:
        index, values, filters = tables[c]
        at = np.flatnonzero(filters[k][window & np.uint32(0xFFFF)])
        at = at[window[at] != 0xFFFFFFFF]
        lo, hi = np.searchsorted(values[:, k], window[at], "left"), np.searchsorted(values[:, k], window[at], "right")
        count = hi - lo
        at, lo, count = at[count > 0], lo[count > 0], count[count > 0]
        if not len(at):
            return
        which = index[np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count), k]
        at = np.repeat(at, count)
        # A window may reach over several short texts.
        begin = np.searchsorted(first, at * c, "right") - 1
        end = np.searchsorted(first, np.minimum(at * c + 2 * c, n) - 1, "right") - 1
        begin = np.clip(begin, 0, len(first) - 2)
        end = np.clip(end, begin, len(first) - 2)
        many = end - begin + 1
        doc = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        out.append(np.unique(np.stack([doc, np.repeat(which, many)], 1), axis=0))


def _triples(level: np.ndarray) -> np.ndarray:
    """Minima over three neighbours from every multiple of three."""
    pad = -len(level) % 3
    level = np.concatenate([level, np.full(pad, 0xFFFFFFFF, np.uint32)]) if pad else level
    return np.minimum(np.minimum(level[0::3], level[1::3]), level[2::3])


def _windows(level: np.ndarray) -> np.ndarray:
    """Minima over each block and the next."""
    out = level.copy()
    np.minimum(out[:-1], level[1:], out=out[:-1])
    return out


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", item_text: str = "text", n: int = 5, threshold: float = 0.8, hashes: int = 64, item_block: int = 20_000) -> DataFrame:
    """The rows of docs as the struct `doc`, and `leaks`: array<struct<item_id, share>> of the items that each holds, by item_id; empty if none."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumn("text", F.col("doc").getField(text_col))
    wanted = items.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{item_text}`").cast("string").alias("t"))
    count = wanted.count()
    blocks = max(1, -(-count // item_block))
    kind = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("share", T.DoubleType())]))
    schema = T.StructType([rows.schema["doc"], rows.schema["text"], T.StructField("leaks", kind)])
    rows = rows.withColumn("leaks", F.array().cast(kind))
    for b in range(blocks):
        # Blocks by hash: at most a few more than item_block items each, whatever their number.
        part = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        table = part.toArrow()
        # The index is made once, here; its size is bounded by item_block.
        sent = spark.sparkContext.broadcast(Items(table.column("i").to_pandas().to_numpy(dtype=object), table.column("t").combine_chunks() if table.num_rows else pa.array([], pa.string()), n, hashes, threshold))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block, ids = sent.value, sent.value.ids
            for batch in tc.slices(batches):
                doc, item, share = block.search(batch.column("text"))
                old = batch.column("leaks")
                if not len(doc):
                    yield batch
                    continue
                found = old.to_pylist()
                for d, i, s in zip(doc.tolist(), item.tolist(), share.tolist(), strict=True):
                    found[d] = [*found[d], {"item_id": None if ids[i] is None or ids[i] != ids[i] else int(ids[i]), "share": s}]
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text"), pa.array(found, old.type)], schema=batch.schema)

        rows = rows.mapInArrow(tc.tidy(search), schema)
    return rows.select("doc", F.array_sort("leaks").alias("leaks"))
