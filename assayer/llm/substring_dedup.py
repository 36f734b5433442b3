"""Substring dedup by difference-cover anchors.

A window is `window` consecutive words of one text.  Every word is removed that a window covers whose
words also start earlier: in a text with a smaller id, or earlier in the same text.

1. Anchors.  D is a perfect difference set modulo a period v: for any two places i and j there is a
   shift below v that puts both on D.  Hashes of window - v + 1 words are taken only where
   place mod v is in D, so two equal windows share an equal anchor inside them, whatever their places.
2. Anchors that occur once are dropped.  The windows around the others are the only ones that can repeat.
3. Each such window is extended to its full length, hashed by all its words (96 bits) and kept unless it is its first occurrence.
4. The words of the rest are removed from the texts.

A value that occurs many times in one map task leaves that task once (its other occurrences are settled
there), so a value has at most as many rows in a shuffle as there are map tasks: no hot key meets in one task.
Occurrences are sent packed, about 11 bytes each, to spark.sql.shuffle.partitions ranges of hashes; a task holds one range as
it came and works on STEP occurrences of it at once.
The texts are shuffled once by id; both later passes read that exchange.

Defined results: a null id sorts before all others; rows that share an id are ordered by a 64-bit hash of the text,
and rows that share id and text count as one text and get one result each; a null or empty text, or one with
fewer words than a window, loses nothing; all input columns come back in the struct `doc`, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc

#: Perfect difference sets by period (fixed values).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
#: Makes of the words' hashes others, for the second hash of a window.
_OTHER = tc.U(0xA24BAED4963EE407)
#: Occurrences that a map task settles and packs at once, and that a task of keys or texts works on at once.
FLUSH, STEP = 500_000, 400_000
#: What a map task sends to one partition of keys: the sorted keys as steps, and for each its check, its text (a number in rid and tie) and place;
#: then the text and place of occurrences that are settled already.  Numbers are stored by byte planes, which compress well.
_PACK = "part int, keys binary, checks binary, who binary, place binary, known_who binary, known_place binary, rid binary, tie binary"
#: What a task of keys sends to one partition of texts: texts, how many places each has, and the places.
_PLACES = "part int, rid binary, tie binary, n binary, place binary"
_RANGES = "rid long, tie long, at array<int>"


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of at least two fifths of the window."""
    period = max(v for v in COVERS if v == 1 or window - v + 1 >= 0.4 * window)
    return period, COVERS[period]


def _planes(x: np.ndarray) -> bytes:
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _numbers(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _ints(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), np.int64)


def _part_of(rid: np.ndarray, parts: int) -> np.ndarray:
    return ((tc.mix(rid.view(tc.U)) >> tc.U(32)) * tc.U(parts) >> tc.U(32)).astype(np.int64)


class _Packer:
    """Gathers occurrences (key, check, rid, tie, place) of a map task and packs them by partition of keys.  Key and check are one hash of 96 bits.

    A key leaves with its first occurrence only.  If it has several, they are settled here: all of them
    (all_known), or all but the first."""

    def __init__(self, parts: int, all_known: bool):
        self.parts, self.all_known, self.held, self.n = parts, all_known, [], 0

    def add(self, key: np.ndarray, check: np.ndarray, batch: pa.RecordBatch, doc: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((key, check, _ints(batch.column("rid"))[doc], _ints(batch.column("tie"))[doc], place))
        self.n += len(key)
        if self.n > FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        key, check, rid, tie, place = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.n = [], 0
        order = np.lexsort((place, tie, rid))
        rid, tie = rid[order], tie[order]
        fresh = np.concatenate([[True], (rid[1:] != rid[:-1]) | (tie[1:] != tie[:-1])])
        who = np.empty(len(order), np.int64)
        who[order] = np.cumsum(fresh) - 1
        rid, tie = rid[fresh], tie[fresh]
        spot = (who << 32) | place
        order = np.lexsort((spot, check, key))
        key, check, spot = key[order], check[order], spot[order]
        keep = np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1]) | (spot[1:] != spot[:-1])])
        key, check, spot = key[keep], check[keep], spot[keep]
        again = np.concatenate([[False], (key[1:] == key[:-1]) & (check[1:] == check[:-1])])
        known = again.copy()
        if self.all_known:
            known[:-1] |= again[1:]
        known = np.sort(spot[known])
        key, check, spot = key[~again], check[~again], spot[~again]
        part = ((key >> tc.U(32)) * tc.U(self.parts) >> tc.U(32)).astype(np.int64)
        cuts = np.searchsorted(part, np.arange(self.parts + 1))
        # Settled occurrences go out evenly by text, not by key.
        to = _part_of(rid, self.parts)[known >> 32]
        known = known[np.argsort(to, kind="stable")]
        known_cuts = np.searchsorted(np.sort(to), np.arange(self.parts + 1))
        rows = []
        for p in range(self.parts):
            k, x, y = key[cuts[p] : cuts[p + 1]], spot[cuts[p] : cuts[p + 1]], known[known_cuts[p] : known_cuts[p + 1]]
            if len(k) or len(y):
                used, number = np.unique(np.concatenate([x, y]) >> 32, return_inverse=True)
                number = number.astype(np.uint32)
                rows.append((p, _planes(np.diff(k, prepend=tc.U(0))), _planes(check[cuts[p] : cuts[p + 1]]), _planes(number[: len(x)]), _planes((x & 0xFFFFFFFF).astype(np.uint32)), _planes(number[len(x) :]), _planes((y & 0xFFFFFFFF).astype(np.uint32)), rid[used].tobytes(), tie[used].tobytes()))
        yield from _rows_of(rows, ["part", "keys", "checks", "who", "place", "known_who", "known_place", "rid", "tie"])


def _rows_of(columns: list[list], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns), 64):
        part, *rest = zip(*columns[at : at + 64], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(c, pa.binary()) for c in rest)], names=names)


def _places(rid: np.ndarray, tie: np.ndarray, place: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Places by text, packed by partition of texts."""
    to = _part_of(rid, parts)
    order = np.lexsort((place, tie, rid, to))
    rid, tie, place, to = rid[order], tie[order], place[order], to[order]
    fresh = np.concatenate([[True], (rid[1:] != rid[:-1]) | (tie[1:] != tie[:-1])])[: len(rid)]
    cuts, rows = np.searchsorted(to, np.arange(parts + 1)), []
    for p in np.flatnonzero(np.diff(cuts)):
        lo, hi = cuts[p], cuts[p + 1]
        first = np.flatnonzero(fresh[lo:hi]) + lo
        rows.append((int(p), rid[first].tobytes(), tie[first].tobytes(), _planes(np.diff(np.append(first, hi)).astype(np.uint32)), _planes(place[lo:hi].astype(np.uint32))))
    yield from _rows_of(rows, ["part", "rid", "tie", "n", "place"])


def _later(key: np.ndarray, check: np.ndarray, rid: np.ndarray, tie: np.ndarray, place: np.ndarray, all_known: bool) -> np.ndarray:
    """Which occurrences aren't the first one of their key (all_known: those whose key has several)."""
    order = np.lexsort((place, tie, rid, check, key))
    twin = np.concatenate([[False], (key[order][1:] == key[order][:-1]) & (check[order][1:] == check[order][:-1])])
    same_spot = twin.copy()
    for x in (rid, tie, place):
        same_spot[1:] &= x[order][1:] == x[order][:-1]
    # A run of one key: its first spot, and every row that isn't at that spot.
    start = np.flatnonzero(~twin)
    run = np.cumsum(~twin) - 1
    moved = np.cumsum(~same_spot)
    later = moved > moved[start][run]
    return order[np.bitwise_or.reduceat(later, start)[run] if all_known else later]


def _settle(batches: Iterator[pa.RecordBatch], all_known: bool, parts: int) -> Iterator[pa.RecordBatch]:
    """Places by text, of one partition of keys: the settled ones, and those whose key occurs again (all_known: all of them; else all but the first).

    The packs are held as they came, 20 bytes for each occurrence; they are settled by ranges of keys of about STEP occurrences."""
    held = []
    for batch in batches:
        for r in batch.to_pylist():
            rid, tie = np.frombuffer(r["rid"], np.int64), np.frombuffer(r["tie"], np.int64)
            held.append((np.cumsum(_numbers(r["keys"], np.uint64), dtype=tc.U), _numbers(r["who"], np.uint32), _numbers(r["place"], np.uint32), rid, tie, _numbers(r["checks"], np.uint32)))
            known, spot = _numbers(r["known_who"], np.uint32), _numbers(r["known_place"], np.uint32).astype(np.int64)
            for at in range(0, len(known), STEP):
                yield from _places(rid[known[at : at + STEP]], tie[known[at : at + STEP]], spot[at : at + STEP], parts)
    held = [x for x in held if len(x[0])]
    if not held:
        return
    least, most = min(int(x[0][0]) for x in held), max(int(x[0][-1]) for x in held)
    steps = -(-sum(len(x[0]) for x in held) // STEP)
    # Keys are hashes, so ranges of equal width hold about as many.
    bounds = [np.searchsorted(x[0], np.array([least + (most - least) * k // steps for k in range(1, steps)], tc.U)) for x in held]
    for k in range(steps):
        cut = [slice(b[k - 1] if k else 0, b[k] if k < steps - 1 else len(x[0])) for x, b in zip(held, bounds, strict=True)]
        key = np.concatenate([x[0][c] for x, c in zip(held, cut, strict=True)])
        if len(key):
            rid, tie = (np.concatenate([x[i][x[1][c]] for x, c in zip(held, cut, strict=True)]) for i in (3, 4))
            place, check = (np.concatenate([x[i][c] for x, c in zip(held, cut, strict=True)]) for i in (2, 5))
            place = place.astype(np.int64)
            hit = _later(key, check, rid, tie, place, all_known)
            yield from _places(rid[hit], tie[hit], place[hit], parts)


def _merge(batches: Iterator[pa.RecordBatch], before: int, after: int) -> Iterator[pa.RecordBatch]:
    """Per text of one partition, the ranges that place - before to place + after make up: first, end, first, end ...

    Places are held as they came, 4 bytes each, and merged for about STEP places at once: texts by a hash of their ids."""
    held, total = [], 0
    for batch in batches:
        for r in batch.to_pylist():
            n = _numbers(r["n"], np.uint32).astype(np.int64)
            held.append((np.frombuffer(r["rid"], np.int64), np.frombuffer(r["tie"], np.int64), n, _numbers(r["place"], np.uint32)))
            total += len(held[-1][3])
    steps = max(1, -(-total // STEP))
    for k in range(steps):
        rid, tie, place = [], [], []
        for r, t, n, p in held:
            own = (tc.mix(r.view(tc.U)) % tc.U(steps)).astype(np.int64) == k if steps > 1 else np.ones(len(r), bool)
            rid.append(np.repeat(r[own], n[own]))
            tie.append(np.repeat(t[own], n[own]))
            place.append(p[np.repeat(own, n)])
        if rid:
            yield from _ranges(np.concatenate(rid), np.concatenate(tie), np.concatenate(place).astype(np.int64), before, after)


def _ranges(rid: np.ndarray, tie: np.ndarray, place: np.ndarray, before: int, after: int) -> Iterator[pa.RecordBatch]:
    if not len(rid):
        return
    order = np.lexsort((place, tie, rid))
    rid, tie, place = rid[order], tie[order], place[order]
    first, end = np.maximum(place - before, 0), place + after + 1
    fresh = np.concatenate([[True], (rid[1:] != rid[:-1]) | (tie[1:] != tie[:-1])])
    cut = fresh.copy()
    cut[1:] |= first[1:] > end[:-1]
    begin = np.flatnonzero(cut)
    flat = np.stack([first[begin], end[np.append(begin[1:], len(place)) - 1]], 1).astype(np.int32).ravel()
    doc = np.flatnonzero(fresh)
    ends = 2 * np.append(np.searchsorted(begin, doc), len(begin))
    for at in range(0, len(doc), 20_000):
        lo, hi = at, min(at + 20_000, len(doc))
        lists = pa.ListArray.from_arrays(pa.array((ends[lo : hi + 1] - ends[lo]).astype(np.int32)), pa.array(flat[ends[lo] : ends[hi]]))
        yield pa.RecordBatch.from_arrays([pa.array(rid[doc[lo:hi]]), pa.array(tie[doc[lo:hi]]), lists], names=["rid", "tie", "at"])


def _text(batch: pa.RecordBatch, name: str) -> pa.RecordBatch:
    return batch.append_column("text", batch.column("doc").field(name).cast(pa.string()))


def _anchors(batches: Iterator[pa.RecordBatch], window: int, parts: int) -> Iterator[pa.RecordBatch]:
    period, cover = cover_for(window)
    size, on = window - period + 1, np.isin(np.arange(period), cover)
    pack = _Packer(parts, True)
    for batch in tc.slices(batches):
        w = tc.words(*tc.utf8(batch.column("text")), tc.SOLID)
        hashes = tc.runs(w.hashes(), size)
        total = np.repeat(w.counts, w.counts)
        place = np.arange(len(w.start)) - np.repeat(w.first[:-1], w.counts)
        at = np.flatnonzero(on[place % period] & (total - place >= size) & (total >= window))
        yield from pack.add(hashes[at], np.zeros(len(at), np.uint32), batch, np.repeat(np.arange(batch.num_rows), w.counts)[at], place[at])
    yield from pack.flush()


def _marked(batch: pa.RecordBatch, w: tc.Words) -> np.ndarray:
    """Words that lie in the ranges `at` of their texts."""
    ranges = batch.column("at")
    n = _ints(ranges.value_lengths().fill_null(0))
    places = np.repeat(w.first[:-1], n) + _ints(ranges.flatten())
    mark = np.zeros(len(w.start) + 1, np.int32)
    np.add.at(mark, places[0::2], 1)
    np.add.at(mark, np.minimum(places[1::2], np.repeat(w.first[1:], n)[1::2]), -1)
    return np.cumsum(mark)[:-1] > 0


def _candidates(batches: Iterator[pa.RecordBatch], window: int, parts: int, text_col: str) -> Iterator[pa.RecordBatch]:
    """The windows that start in the ranges `at`."""
    pack = _Packer(parts, False)
    for batch in tc.slices(_text(b, text_col) for b in batches):
        w = tc.words(*tc.utf8(batch.column("text")), tc.SOLID)
        own = w.hashes()
        hashes, checks = tc.runs(own, window), (tc.runs(tc.mix(own ^ _OTHER), window) >> tc.U(32)).astype(np.uint32)
        owner = np.repeat(np.arange(batch.num_rows), w.counts)
        at = np.flatnonzero(_marked(batch, w) & (np.arange(len(w.start)) + window <= w.first[1:][owner]))
        yield from pack.add(hashes[at], checks[at], batch, owner[at], at - w.first[:-1][owner[at]])
    yield from pack.flush()


def _cut(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    for batch in tc.slices(_text(b, text_col) for b in batches):
        w = tc.words(*tc.utf8(batch.column("text")), tc.SOLID)
        gone = _marked(batch, w)
        removed = tc.segment_sums(gone, w.first)
        # Words that stay, each but the last of a text with the white space after it as one blank.
        stay = np.flatnonzero(~gone)
        owner = np.repeat(np.arange(batch.num_rows), w.counts)[stay]
        text, byte = w.data.copy(), np.zeros(len(w.data) + 1, np.int8)
        after = stay[:-1][owner[1:] == owner[:-1]]
        byte[w.start[stay]] += 1
        byte[w.stop[stay]] -= 1
        byte = np.cumsum(byte[:-1]) > 0
        byte[w.stop[after]] = True
        text[w.stop[after]] = 0x20
        ends = np.concatenate([[0], np.cumsum(byte)])[w.off].astype(np.int32)
        kept = pa.StringArray.from_buffers(batch.num_rows, pa.py_buffer(ends), pa.py_buffer(text[byte]))
        # Spans of removed words as [first, last) numbers of words.
        step = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        bounds = np.zeros(len(gone) + 1, bool)
        bounds[w.first] = True
        begin = np.flatnonzero(gone & ((step[:-1] == 1) | bounds[:-1]))
        end = np.flatnonzero(gone & ((step[1:] == -1) | bounds[1:])) + 1
        base = w.first[:-1][np.searchsorted(w.first, begin, "right") - 1] if len(begin) else begin
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, w.first).astype(np.int32)), pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], ["first", "last"]))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(w.counts), pa.array(removed.astype(np.int64)), spans, kept], ["doc", "n_words", "n_removed", "spans", "kept"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Per row: doc (its columns), n_words, n_removed, spans (removed words as [first, last)), kept (the other words, joined by one blank)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    text = F.col("doc").getField(text_col).cast("string")
    rows = rows.select("doc", F.coalesce(F.col("doc").getField(id_col).cast("long"), F.lit(-(1 << 63))).alias("rid"), F.xxhash64(text).alias("tie"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    period, _ = cover_for(window)

    def ranges(packs: DataFrame, all_known: bool, before: int, after: int) -> DataFrame:
        """Ranges of each text around the settled places; one row for each text."""
        places = packs.repartitionById(parts, "part").mapInArrow(tc.tidy(lambda it: _settle(it, all_known, parts)), _PLACES)
        return places.repartitionById(parts, "part").mapInArrow(tc.tidy(lambda it: _merge(it, before, after)), _RANGES)

    anchors = rows.select("rid", "tie", text.alias("text")).mapInArrow(tc.tidy(lambda it: _anchors(it, window, parts)), _PACK)
    near = rows.join(ranges(anchors, True, period - 1, 0), ["rid", "tie"]).select("doc", "rid", "tie", "at")
    windows = near.mapInArrow(tc.tidy(lambda it: _candidates(it, window, parts, text_col)), _PACK)
    last = rows.join(ranges(windows, False, 0, window - 1), ["rid", "tie"], "left").select("doc", "at")
    schema = T.StructType([rows.schema["doc"], *T._parse_datatype_string("n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept string").fields])
    return last.mapInArrow(tc.tidy(lambda it: _cut(it, text_col)), schema)
