"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

All stages take any columns beside doc_id and text (lang is set, n_chars follows the text, where they are there), whatever their
names, and give them back unchanged.  Rows without an id are documents of their own that come before all others; an empty
table goes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import decontamination, language_id, ngram_join, packing, substring_dedup
from assayer.llm.durable import discard, written
from assayer.llm.queries import VOCABULARY
from assayer.llm.samples import remainder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null or empty text, or no letter in it) go; the others get the one they are written in.

    Learned from the rows whose crc32(doc_id) mod 3 isn't 1 (null ids among them); where no language can be learned, none is
    known and all documents go.  Repeated rows stay as often as they are there."""
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    out = language_id.identify(docs, language_id.train(docs.where(~held_out))).where("lang_pred <> 'und'")
    return out.select(*[F.col("lang_pred" if c == "lang" else f"doc.`{c}`").alias(c) for c in docs.columns])


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays (null before all; of equal ids the smaller hash of the text).

    Of rows that repeat id and text one stays; a text without words is no one's duplicate, so it stays for each id."""
    joined = ngram_join.ngram_join(docs)
    stays = joined.where("rid = keep_rid and tx = keep_tx").select("rid", "tx").distinct()
    keyed = docs.withColumns({"_rid": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "_tx": F.xxhash64("text")})
    # Rows that repeat id and text are combined before the shuffle, however many there are.
    kept = keyed.dropDuplicates(["_rid", "_tx"]).join(stays.select(F.col("rid").alias("_rid"), F.col("tx").alias("_tx")), ["_rid", "_tx"], "left_semi")
    return kept.select(*docs.columns)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 20-word runs go; a text that loses none stays as it is, null too.

    A document all of whose words go stays with an empty text: what to do with it is the next stages' affair."""
    out = substring_dedup.substring_dedup(docs)
    cut = F.col("n_removed") > 0
    own = {"text": F.when(cut, F.col("kept")).otherwise(F.col("doc.text")), "n_chars": F.when(cut, F.char_length("kept").cast("long")).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(own[c] if c in own else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none, and without items all stay."""
    out = decontamination.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.where(F.size("leaks") == 0).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of each document that is left; null and empty texts have no tokens and are packed like any other."""
    return packing.pack(docs, VOCABULARY)


STAGES = [("language_id", identify_language), ("ngram_join", remove_near_duplicates), ("substring_dedup", remove_repeats), ("decontamination", decontaminate), ("packing", pack)]
#: SQL can't express language models and tokenizers; the stages are held against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each over all that the one before kept."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, before = written(out), last
            if before is not None:
                discard(before)
            last = docs
        else:
            docs = out
    return docs
