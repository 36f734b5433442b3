"""Packing into optimal length buckets.

1. Every text's tokens are counted with a public byte-level BPE vocabulary (a file whose path is a parameter; it is read on the
   driver and broadcast, as its size doesn't depend on the data).
2. A global histogram counts the texts of every length.
3. Dynamic programming over its lengths chooses the `buckets` boundaries that minimise the padding of all texts to the
   greatest length of their bucket, in time linear in the lengths for each bucket.
4. Inside a bucket, texts are numbered without gaps and cut into batches of budget // boundary texts, so each but a bucket's
   last batch is full.  Numbers come from ranks inside shards of about `shard` texts plus the shards' running totals: no
   bucket is sorted in one task, however many texts it holds, and however often one of them is repeated.

Defined results: a null or empty text has 0 tokens and is packed like any other; a text longer than the budget is in a batch
of its own kind (boundary above the budget, one text each), whole; ties and repeated rows are numbered in turn; an empty
table has no batches.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textcore as tc
from .durable import written

#: How the vocabulary's texts were split before merging (fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


#: Rows of one id and text that a task leaves in one shard.
REPEATS = 64


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid (the id), tx (xxhash64 of the text), n_tokens and again of every row.

    again is 0, but where a task meets an id with its text more than REPEATS times: there it tells parts of the repeated rows apart."""
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, sent.value.splitlines())}
        encode = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        task, seen = TaskContext.get().partitionId() + 1, Counter()
        for batch in batches:
            again = []
            for key in zip(batch.column("rid").to_pylist(), batch.column("tx").to_pylist(), strict=True):
                part = seen[key] // REPEATS
                again.append(part and (task << 32) + part)
                seen[key] += 1
            texts = pc.fill_null(batch.column("text"), "")
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("tx"), pa.array([len(encode(x.as_py())) for x in texts], pa.int64()), pa.array(again, pa.int64())], ["rid", "tx", "n_tokens", "again"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("rid"), F.xxhash64(f"`{text_col}`").alias("tx"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(tc.tidy(run), "rid long, tx long, n_tokens long, again long")


def histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(length, number of texts) of all lengths, in order.  As many entries as there are different lengths: n of them need texts of n * n / 2 tokens in all."""
    rows = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").collect()
    return [(r["n_tokens"], r["n"]) for r in rows]


def boundaries(cells: list[tuple[int, int]], buckets: int) -> list[int]:
    """The greatest lengths of at most `buckets` buckets of neighbouring lengths that minimise the total padding, exactly.

    With the first i lengths packed best, the rest up to length j cost best[i] + tokens[i] - top[j] * count[i], but for a part that
    i doesn't change: a line in top[j].  Slopes fall with i and the tops rise with j, so the lower envelope of the lines gives
    the best i for all j in one sweep, and a bucket more costs one sweep."""
    if not cells:
        return []
    n = len(cells)
    count, tokens = [0, *accumulate(c for _, c in cells)], [0, *accumulate(x * c for x, c in cells)]
    best: list[int | None] = [0] + [None] * n
    back = []
    for _ in range(min(buckets, n)):
        new: list[int | None] = [None] * (n + 1)
        cut, lines, first = [0] * (n + 1), [], 0
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                line = (-count[j - 1], best[j - 1] + tokens[j - 1], j - 1)
                while len(lines) - first >= 2 and _hidden(lines[-2], lines[-1], line):
                    lines.pop()
                lines.append(line)
            top = cells[j - 1][0]
            while len(lines) - first >= 2 and lines[first + 1][0] * top + lines[first + 1][1] < lines[first][0] * top + lines[first][1]:
                first += 1
            if len(lines) > first:
                slope, base, cut[j] = lines[first]
                new[j] = slope * top + base + top * count[j] - tokens[j]
        best = new
        back.append(cut)
    out, j = [], n
    for cut in reversed(back):
        out.append(cells[j - 1][0])
        j = cut[j]
        if j == 0:
            break
    return sorted(out)


def _hidden(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether line b lies nowhere below both a and c (slopes fall from a to c)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", budget: int = 16_384, buckets: int = 16, shard: int = 4096) -> DataFrame:
    """Per row: the id as doc_id, n_tokens, bucket, bucket_tokens (its boundary), batch_id, slot (place in the batch), padding."""
    lengths = written(token_counts(docs, vocabulary, id_col, text_col))
    cells = histogram(lengths)
    tops = boundaries(cells, buckets) or [0]
    held = [sum(n for top, n in cells if low < top <= high) for low, high in zip([-1, *tops], tops, strict=False)]
    array = lambda xs: F.array(*[F.lit(int(x)).cast("long") for x in xs])
    rows = lengths.withColumn("bucket", F.size(F.filter(array(tops), lambda x: x < F.col("n_tokens"))))
    # As many shards as the bucket's count asks for.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("rid", "tx", "again"), F.get(array([max(1, -(-n // shard)) for n in held]), F.col("bucket"))))
    offsets = rows.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("bucket", "shard", (F.sum("n").over(Window.partitionBy("bucket").orderBy("shard")) - F.col("n")).alias("before"))
    rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("n_tokens", "rid", "tx")))
    rows = rows.join(offsets, ["bucket", "shard"]).withColumn("at", F.col("before") + F.col("rn") - 1)
    top, size = F.get(array(tops), F.col("bucket")), F.get(array([max(1, budget // max(1, t)) for t in tops]), F.col("bucket"))
    return rows.select(
        F.col("rid").alias("doc_id"), "n_tokens", "bucket", top.alias("bucket_tokens"),
        (F.shiftleft(F.col("bucket").cast("long"), 48) + F.floor(F.col("at") / size)).alias("batch_id"), (F.col("at") % size).alias("slot"), (top - F.col("n_tokens")).alias("padding"))


def batches(packed: DataFrame) -> DataFrame:
    """batch_id, doc_ids in order of slot, tokens, padded_tokens; a batch holds at most budget // boundary texts."""
    rows = packed.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("slot", "doc_id"))).alias("d"), F.sum("n_tokens").alias("tokens"), F.sum("bucket_tokens").alias("padded_tokens"))
    return rows.select("batch_id", F.col("d.doc_id").alias("doc_ids"), "tokens", "padded_tokens")
