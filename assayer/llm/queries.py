"""The queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The vocabulary that texts are counted with: a parameter of the packing queries.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored(spark: SparkSession, sf_dir: str, operator, label: str, fold: tuple[int, int], rows: int, cut: float) -> DataFrame:
    """Scores of all documents by a model of the labels outside the fold (modulus, remainder)."""
    from .samples import labelled_sample, remainder

    held_out = F.coalesce(remainder("doc_id", fold[0]) == fold[1], F.lit(False))
    docs = _table(spark, sf_dir, "documents")
    sample = labelled_sample(docs, _table(spark, sf_dir, "labels").where(~held_out), label, rows=rows)
    out = operator.score(docs.select("doc_id", "text"), operator.train(sample)).select(F.col("doc.doc_id").alias("doc_id"), "score")
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from about 1,500 documents of each label whose crc32(doc_id) mod 4 isn't 2."""
    from . import toxicity

    return _scored(spark, sf_dir, toxicity, "toxic", (4, 2), 1500, 0.3)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from about 2,500 documents of each label whose crc32(doc_id) mod 3 isn't 1."""
    from . import quality

    return _scored(spark, sf_dir, quality, "quality", (3, 1), 2500, 0.5)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    from .fingerprints import edited_fingerprints

    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, formatted, and what can be read back from the output."""
    from .chat_format import format_conversations, read_loss, read_turns

    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.sql(r"select * from values (-7L, 0L, 'user', '\\### Assistant: </turn> ok'), (-7L, 1L, 'assistant', '\\### Assistant: </turn> ok') as t(conv_id, turn, role, text)")
    out = format_conversations(turns.union(tricky))
    out = out.select("conv_id", "formatted", read_turns("formatted").alias("turns"), F.array_join(read_loss("formatted", "loss_spans"), "").alias("loss"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document."""
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), VOCABULARY)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items of which every document holds four fifths or more: doc_id, n_leaks, item_ids, max_share."""
    from .decontamination import find_leaks

    out = find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(F.col("doc.doc_id").alias("doc_id"), F.size("leaks").cast("long").alias("n_leaks"), F.array_join("leaks.item_id", ",").alias("item_ids"), F.coalesce(F.array_max("leaks.share"), F.lit(0.0)).alias("max_share"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates (five-word shingles, Jaccard of 0.8 or more) and number of links of every document."""
    from .ngram_join import ngram_join

    return ngram_join(_table(spark, sf_dir, "documents")).select(F.nullif("rid", F.lit(-(1 << 63))).alias("doc_id"), "class_id", "n_links")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeat an earlier run of 20 words, removed: doc_id, n_words, n_removed, kept_sha256."""
    from .substring_dedup import substring_dedup

    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select(F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, with weights from about 400 pages that mark their content."""
    from .html_text import main_text, train

    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, train(pages)).select("doc.page_id", "doc.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents whose crc32(doc_id) mod 3 isn't 1."""
    from .language_id import identify, train
    from .samples import remainder

    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    out = identify(docs.select("doc_id", "text"), train(docs.where(~held_out)))
    return out.select(F.col("doc.doc_id").alias("doc_id"), "lang_pred", "score").withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


#: DuckDB SQL for the queries that it can express.
_SQL = {
    "op3_chat_format": r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
s as (select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) is distinct from role as new,
    length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', '')) + 7 as piece,
    length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), chr(10), '')) + 5 as head from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    cast(sum(piece + case when new then head else 0 end) as bigint) as formatted_chars
from s group by conv_id""",
    "op5_decontamination": r"""
with d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z_\x{80}-\x{10FFFF}]+') as w from documents),
b as (select item_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z_\x{80}-\x{10FFFF}]+') as w from benchmark),
ds as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d)),
bs as (select distinct item_id, array_to_string(w[i : i + 4], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 3)) as i from b)),
n as (select item_id, count(*) as n from bs group by item_id),
m as (select doc_id, item_id, count(*) / n as share from ds join bs using (g) join n using (item_id) group by doc_id, item_id, n having count(*) >= 0.8 * n),
l as (select doc_id, count(*) as n_leaks, string_agg(cast(item_id as varchar), ',' order by item_id) as item_ids, max(share) as max_share from m group by doc_id)
select doc_id, coalesce(n_leaks, 0) as n_leaks, coalesce(item_ids, '') as item_ids, coalesce(max_share, 0.0) as max_share from documents left join l using (doc_id)""",
    "op6_ngram_join": r"""
with recursive d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z_\x{80}-\x{10FFFF}]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, case when len(w) > 0 then 2 else 1 end))) as i from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
l as (select a.doc_id as u, b.doc_id as v from s a join s b using (g) join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
    where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, x.n, y.n having count(*) >= 0.8 * (x.n + y.n - count(*))),
r(doc_id, v) as (select doc_id, doc_id from documents union select r.doc_id, l.v from r join l on r.v = l.u),
c as (select doc_id, min(v) as class_id from r group by doc_id),
k as (select u as doc_id, count(*) as n_links from l group by u)
select doc_id, class_id, coalesce(n_links, 0) as n_links from c left join k using (doc_id)""",
    "op8_substring_dedup": r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, i, md5(array_to_string(ws[i : i + 19], ' ')) as h from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from w)),
d as (select doc_id, i from (select *, row_number() over (partition by h order by doc_id, i) as rn from s) where rn > 1),
g as (select distinct doc_id, i + j as p from d, (select unnest(range(20)) as j)),
k as (select doc_id, i, ws[i] as word from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w)),
f as (select k.doc_id, count(g.p) as n_removed, string_agg(word, ' ' order by i) filter (where g.p is null) as kept from k left join g on g.doc_id = k.doc_id and g.p = k.i group by k.doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join f using (doc_id)""",
    # The content of pages that mark it: what lies in <article>, cut at block tags.
    "op9_html_text": r"""
with a as (select page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '\s+', ' ', 'g') as x from pages),
b as (select page_id, url, regexp_replace(regexp_replace(x, '</?(p|br|h[1-6]|ul|ol|li|div|section|blockquote|table|tr|td)\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') as x from a),
l as (select page_id, url, list_filter(list_transform(string_split(x, chr(10)), lambda s: trim(s)), lambda s: s <> '') as lines from b),
t as (select page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(array_to_string(lines, chr(10)), ''), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') as text from l)
select page_id, url, text, length(text) as n_chars from t""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
