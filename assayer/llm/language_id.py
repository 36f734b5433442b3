"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to `order` bytes holds the frozen counts of what followed them in training
texts.  The code length of a byte is -log2 of its share in the longest context of the tree that its predecessors match,
with the escape probability of method C (q kinds among n followers: q / (n + q)) for every context in which it wasn't seen,
down to 1/256 without a context.  A text belongs to the language in whose tree its bytes have the shortest code.

Scoring works on whole batches: the last order + 1 bytes at each place are one number; its code lengths in all languages
are rows of a table where any tree has seen them, and are worked out from the shorter contexts otherwise.

Defined results: `und` with score 0 for a null text, one without a letter, or if no language was learned.  Extra columns
come back in the struct `doc`.  Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc
from .samples import _SPAN, chance

ORDER = 3
_START = 0x0A  # stands before every text, ORDER times
#: Entries of the table that finds a number by its halves; with more kinds of halves numbers are looked up by bisection.
_DENSE = 1 << 25


def grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """At each byte, it and the ORDER bytes before it as one number."""
    docs = np.repeat(np.arange(1, len(off)), np.diff(off))
    padded = np.full(len(data) + ORDER * (len(off) - 1), _START, np.uint32)
    at = np.arange(len(data)) + ORDER * docs
    padded[at] = data
    out = padded.copy()
    for k in range(1, ORDER + 1):
        out[k:] |= padded[:-k] << np.uint32(8 * k)
    return out[at]


class ContextTree:
    """Counts of one language: per context length k, the numbers seen with their code lengths, the contexts with those of their escape."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        whole = grams(data, off)
        self.levels = []
        for k in range(ORDER + 1):
            seen, n = np.unique(whole & np.uint32((1 << 8 * (k + 1)) - 1), return_counts=True)
            context, first, kinds = np.unique(seen >> np.uint32(8), return_index=True, return_counts=True)
            total = np.add.reduceat(n, first) if len(n) else n
            own = np.repeat(np.arange(len(context)), kinds)
            self.levels.append((seen, -np.log2(n / (total + kinds)[own]), context, -np.log2(kinds / (total + kinds))))

    def bits(self, wanted: np.ndarray, k: int = ORDER) -> np.ndarray:
        """Code lengths of the last byte of each number after its last k bytes of context."""
        if k < 0:
            return np.full(len(wanted), 8.0)
        seen, own, context, escape = self.levels[k]
        if not len(seen):
            return np.full(len(wanted), 8.0)
        part = wanted & np.uint32((1 << 8 * (k + 1)) - 1)
        at = np.minimum(np.searchsorted(seen, part), len(seen) - 1)
        out = own[at]
        new = np.flatnonzero(seen[at] != part)
        if len(new):
            before = part[new] >> np.uint32(8)
            c = np.minimum(np.searchsorted(context, before), len(context) - 1)
            out[new] = np.where(context[c] == before, escape[c], 0.0) + self.bits(wanted[new], k - 1)
        return out


class Model:
    def __init__(self, texts: dict[str, pa.Array]):
        self.langs = sorted(texts)
        self.trees = [ContextTree(*tc.utf8(texts[x])) for x in self.langs]
        if not self.langs:
            return
        self.known = np.unique(np.concatenate([t.levels[ORDER][0] for t in self.trees]))
        self.rows = np.stack([t.bits(self.known) for t in self.trees], 1).astype(np.float32) if len(self.known) else np.zeros((0, len(self.langs)), np.float32)
        high, low = self.known >> np.uint32(16), self.known & np.uint32(0xFFFF)
        self.dense = None
        (a, x), (b, y) = (np.unique(v, return_inverse=True) for v in (high, low))
        if (len(a) + 1) * (len(b) + 1) <= _DENSE:
            self.high, self.low = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
            self.high[a], self.low[b] = (np.arange(len(a)) + 1) * (len(b) + 1), np.arange(len(b)) + 1
            self.dense = np.full((len(a) + 1) * (len(b) + 1), len(self.known), np.int32)
            self.dense[(x + 1) * (len(b) + 1) + y + 1] = np.arange(len(self.known))

    def code_lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(off) - 1, len(self.langs)))
        if not len(data) or not self.langs:
            return out
        whole = grams(data, off)
        if self.dense is not None:
            at = self.dense[self.high[whole >> np.uint32(16)] + self.low[whole & np.uint32(0xFFFF)]]
        else:
            at = np.minimum(np.searchsorted(self.known, whole), max(0, len(self.known) - 1))
            at[self.known[at] != whole] = len(self.known)
        new = np.flatnonzero(at == len(self.known))
        rows = self.rows
        if len(new):
            kinds, number = np.unique(whole[new], return_inverse=True)
            rows = np.concatenate([rows, np.stack([t.bits(kinds) for t in self.trees], 1).astype(np.float32)])
            at[new] = len(self.known) + number
        full = np.flatnonzero(np.diff(off) > 0)
        for x in range(len(self.langs)):
            out[full, x] = np.add.reduceat(rows[:, x][at], off[full], dtype=np.float64)
        return out


_LETTERS = tc.table([*range(0x41, 0x5B), *range(0x61, 0x7B)])


def has_letter(texts: pa.Array, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    out = tc.segment_sums(_LETTERS[data], off) > 0
    for i in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return out


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", texts_per_lang: int = 400, broadcast_langs: int = 10_000) -> Model:
    """Trees of all languages, from at most texts_per_lang texts of each, chosen by a hash of id and text; texts of any length are taken, copies
    of a row once.

    Thresholds of up to broadcast_langs languages are broadcast, more are joined ordinarily."""
    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"), chance(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).alias("chance")).where("lang is not null and text is not null")
    # Different rows count, so copies don't crowd out a language's other texts; a fifth more than wanted are drawn, as the count is approximate.
    counts = rows.groupBy("lang").agg(F.greatest(F.approx_count_distinct("chance"), F.lit(1)).alias("n"))
    # A part of the counts tells whether all are few; texts aren't shuffled to meet few.
    few = counts.limit(broadcast_langs + 1).collect()
    if len(few) <= broadcast_langs:
        counts = F.broadcast(docs.sparkSession.createDataFrame([(r["lang"], r["n"]) for r in few], "lang string, n long"))
    least = F.least(F.lit(_SPAN), F.floor(F.lit(texts_per_lang * _SPAN // 5 * 6) / F.col("n")))
    # Copies are combined before the shuffle.
    picked = rows.join(counts, "lang").where(F.col("chance") < least).groupBy("lang", "chance").agg(F.first("text").alias("text"))
    sample = picked.orderBy("lang", "chance").select("lang", "text").toArrow()
    texts = sample.column("text").combine_chunks() if sample.num_rows else pa.array([], pa.string())
    # Rows of a language follow each other.
    spans: dict[str, list[int]] = {}
    for i, x in enumerate(sample.column("lang").to_pylist()):
        spans.setdefault(x, [i, i])[1] = i + 1
    return Model({x: texts.slice(i, min(j - i, texts_per_lang)) for x, (i, j) in spans.items()})


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """doc (the row), lang_pred, score (posterior probability of lang_pred if all languages were equally likely before)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in tc.slices(b.append_column("text", b.column("doc").field(text_col).cast(pa.string())) for b in batches):
            texts = batch.column("text")
            data, off = tc.utf8(texts)
            bits = model.code_lengths(data, off)
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if model.langs:
                good, best = has_letter(texts, data, off), bits.argmin(1)
                pred[good] = np.array(model.langs, object)[best[good]]
                score[good] = (1 / np.exp2(np.minimum(0, bits.min(1, keepdims=True) - bits)).sum(1))[good]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(pred, pa.string()), pa.array(score)], ["doc", "lang_pred", "score"])

    return rows.mapInArrow(tc.tidy(run), T.StructType([rows.schema["doc"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
