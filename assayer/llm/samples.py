"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPAN = 1 << 40


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of` (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(of))


def chance(*columns: Column | str) -> Column:
    """A number below _SPAN by a hash: rows that are equal in the columns share it, whatever their order and place."""
    return F.pmod(F.xxhash64(*columns, F.lit("sample")), F.lit(_SPAN))


def bounded_rows(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """About `most` rows, and no more, chosen by a hash of the keys; rows with equal keys are one row.

    Copies are combined before the shuffle, so a row that is repeated however often can't fill the sample."""
    rows = rows.withColumn("_chance", chance(*keys))
    n = rows.agg(F.approx_count_distinct("_chance")).first()[0]
    # A fifth more than wanted, as the count is approximate.
    picked = rows.where(F.col("_chance") < min(_SPAN, most * _SPAN // 5 * 6 // max(1, n)))
    return picked.dropDuplicates(keys).orderBy("_chance", *keys).limit(most).drop("_chance")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> pa.Table:
    """text and label (0 or 1) of about `rows` labelled documents of each label, chosen by a hash of the id.

    The bound holds whatever the size of the tables, and texts of any length are taken.  A document with several labels counts
    with the highest one; of rows that share an id the one with the smallest hash of its text is taken."""
    own = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("i")).agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = F.lit(0)
    for value, n in counts.items():
        least = F.when(F.col("label") == value, F.lit(min(_SPAN, rows * _SPAN // n))).otherwise(least)
    # At most about 2 * rows ids: the bound on what is broadcast.
    chosen = F.broadcast(own.where(chance("i") < least))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("text")).where(F.col("text").isNotNull())
    one = texts.join(chosen, "i").groupBy("i", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return one.select("i", "t.text", "label").orderBy("i").select("text", "label").toArrow()


def distinct_rows(texts: pa.Array) -> list[int]:
    """Rows without those that nearly repeat an earlier one, so that copies don't count as evidence."""
    from . import textcore as tc
    from .ngram_join import band_keys, signatures

    keys = []
    for part in tc.pieces(texts):
        w = tc.normal_words(part)
        keys += band_keys(signatures(*tc.shingles(w.hashes(), w.first, 3), 12), 4, 3).tolist()
    seen: set[int] = set()
    out = []
    for i, row in enumerate(keys):
        if not seen.intersection(row):
            out.append(i)
        seen.update(row)
    return out
