"""Quality classifier: a factorisation machine.

Features of a text: hashed words (one weight each, scaled so that the words of a text have length 1), and its structure
statistics and metadata (size, shares of kinds of characters, lengths of words and lines, repetition, how it ends), each as the
one of `bins` quantile bins that it falls into.  The score is
sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairwise interactions through vectors of
`rank` numbers, in time linear in the features by the sum-of-squares identity.

Defined results: a null text is scored as an empty one, which has statistics but no words; without any labelled row, or with
only one label among them, every score is the share of that label (0.5 without rows).  Extra columns come back in `doc`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc

_KINDS = {
    "upper": tc.table(range(0x41, 0x5B)),
    "lower": tc.table(range(0x61, 0x7B)),
    "digit": tc.table(range(0x30, 0x3A)),
    "beyond": tc.table(range(0x80, 0x100)),
    "stop": tc.table(b".,;:'\"-?"),
    "loud": tc.table(b"!#$%&*+<=>@[]^_`{|}~\\/()"),
    "space": ~tc.SOLID,
    "line": tc.table([0x0A]),
}


def statistics(texts: pa.Array) -> tuple[np.ndarray, tc.Words, np.ndarray]:
    """Structure statistics of each text, its solid words and their hashes."""
    data, off = tc.utf8(texts)
    w = tc.words(data, off, tc.SOLID)
    size, count = np.diff(off), w.counts
    share = [tc.segment_sums(kind[data], off) / np.maximum(size, 1) for kind in _KINDS.values()]
    hashes = w.hashes()
    owner = np.repeat(np.arange(len(size)), count)
    length = w.stop - w.start
    lines = tc.words(data, off, ~_KINDS["line"])
    line_hash = lines.hashes()
    line_owner = np.repeat(np.arange(len(size)), lines.counts)

    def distinct(owner: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        key = np.unique(tc.mix(owner.astype(tc.U)) ^ h, return_index=True)[1]
        return np.bincount(owner[key], minlength=len(n)) / np.maximum(n, 1)

    last = np.where(size > 0, data[np.maximum(off[1:] - 1, 0)] if len(data) else 0, 0)
    loud_words = np.zeros(len(owner), bool)
    if len(owner):
        loud_words = _KINDS["loud"][data[w.stop - 1]]
    mean = tc.segment_sums(length, w.first) / np.maximum(count, 1)
    rows = [np.log1p(size), np.log1p(count), np.log1p(lines.counts), mean, np.sqrt(np.maximum(0, tc.segment_sums(length.astype(np.float64) ** 2, w.first) / np.maximum(count, 1) - mean**2)), distinct(owner, hashes, count), distinct(line_owner, line_hash, lines.counts), count / np.maximum(lines.counts, 1), tc.segment_sums(loud_words, w.first) / np.maximum(count, 1), last.astype(np.float64), *share]
    return np.stack(rows, 1), w, hashes


class FactorisationMachine:
    def __init__(self, edges: list[np.ndarray], buckets: int, rank: int, seed: int = 1):
        self.edges, self.buckets, self.rank = edges, buckets, rank
        self.base = buckets + np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])
        rng = np.random.default_rng(seed)
        self.w0, self.w, self.v = 0.0, np.zeros(self.base[-1]), rng.normal(0, 0.05, (self.base[-1], rank))

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and values of the features of all texts, and where each text's begin."""
        stats, w, hashes = statistics(texts)
        n = len(stats)
        owner = np.repeat(np.arange(n), w.counts)
        pair = np.unique(owner.astype(np.int64) * self.buckets + (hashes % tc.U(self.buckets)).astype(np.int64))
        owner, bucket = pair // self.buckets, pair % self.buckets
        kinds = np.bincount(owner, minlength=n)
        value = (1 / np.sqrt(np.maximum(kinds, 1)))[owner]
        bins = np.stack([self.base[k] + np.searchsorted(e, stats[:, k], "right") for k, e in enumerate(self.edges)], 1)
        first = np.concatenate([[0], np.cumsum(kinds + bins.shape[1])])
        number, x = np.empty(first[-1], np.int64), np.ones(first[-1])
        at = np.arange(len(owner)) + owner * bins.shape[1]
        number[at], x[at] = bucket, value
        rest = np.ones(first[-1], bool)
        rest[at] = False
        number[rest] = bins.ravel()
        return number, x, first

    def raw(self, number: np.ndarray, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the sums of v_i x_i of each text.  Every text has features."""
        vx = self.v[number] * x[:, None]
        sums = np.add.reduceat(vx, first[:-1], axis=0)
        squares = np.add.reduceat(vx * vx, first[:-1], axis=0)
        return self.w0 + np.add.reduceat(self.w[number] * x, first[:-1]) + 0.5 * (sums * sums - squares).sum(1), sums

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.features(texts))[0], -30, 30)))

    def fit(self, texts: pa.Array, labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.08, decay: float = 1e-4) -> None:
        """Logistic loss by Adagrad; a batch weighs both labels alike on average, then the offset is fitted to the sample."""
        parts = [self.features(t) for t in tc.pieces(texts)]
        number, x = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[2]) for p in parts]))])
        rng = np.random.default_rng(2)
        gw, gv, g0 = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                sizes = first[some + 1] - first[some]
                begin = np.concatenate([[0], np.cumsum(sizes)])
                take = np.arange(begin[-1]) + np.repeat(first[some] - begin[:-1], sizes)
                i, xi = number[take], x[take]
                raw, sums = self.raw(i, xi, begin)
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[some]) / len(some)
                e = np.repeat(err, sizes) * xi
                used, place = np.unique(i, return_inverse=True)
                dw = np.bincount(place, e, len(used)) + decay * self.w[used]
                dv = np.zeros((len(used), self.rank))
                inner = np.repeat(sums, sizes, axis=0) - self.v[i] * xi[:, None]
                for f in range(self.rank):
                    dv[:, f] = np.bincount(place, e * inner[:, f], len(used))
                dv += decay * self.v[used]
                d0 = err.sum()
                gw[used] += dw * dw
                gv[used] += dv * dv
                g0 += d0 * d0
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * dv / np.sqrt(gv[used])
                self.w0 -= rate * d0 / np.sqrt(g0)


class Constant:
    def __init__(self, score: float):
        self.score = score

    def scores(self, texts: pa.Array) -> np.ndarray:
        return np.full(len(texts), self.score)


def train(sample: pa.Table, buckets: int = 1 << 15, rank: int = 8, bins: int = 16) -> FactorisationMachine | Constant:
    """Fit on a sample of text and label."""
    labels = np.asarray(sample.column("label").to_numpy(), np.float64)
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels[0]) if len(labels) else 0.5)
    texts = sample.column("text").combine_chunks()
    stats = np.concatenate([statistics(t)[0] for t in tc.pieces(texts)])
    fm = FactorisationMachine([np.unique(np.quantile(s, np.arange(1, bins) / bins)) for s in stats.T], buckets, rank)
    fm.fit(texts, labels)
    return fm


def score(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """doc (the row) and score (0 to 1) of every row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tc.slices(b.append_column("text", b.column("doc").field(text_col).cast(pa.string())) for b in batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(sent.value.scores(batch.column("text")))], ["doc", "score"])

    return rows.mapInArrow(tc.tidy(run), T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())]))
