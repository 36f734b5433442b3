"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is its weighted terms: its words (runs without white space), each weighing the characters that it covers in all
(count times length).  Sample k of a text takes, for each term of weight w, from hashes of term and k alone,
r and c of Gamma(2, 1) and b uniform in [0, 1), and
    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1),
and keeps (term, t) of the smallest a.  Two texts agree in a sample with a probability equal to the generalised Jaccard
similarity (sum of least over sum of greatest weights) of their terms, so the share of equal samples estimates it, with
a standard error of at most 0.5 / sqrt(samples).

r and ln c come from tables of quantiles with linear interpolation; ln c has finer ones for its lower tail, from which the
winners come.  ln a (24 bits after the point) and a 32-bit hash of (term, t) are one long, so a sample is a plain min.  The
samples are hash aggregations in generated code by two short keys and a block of samples, which are put together by key
afterwards.  A term is 33 bits of a word's hash and its length (31 bits, as long as any text can be).

Defined results: a null text is an empty one; a text without terms has an empty fingerprint, which is like another empty
one (1) and unlike all others (0); an empty table has no fingerprints; extra columns don't come back.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples of a fingerprint.
SAMPLES = 64
#: Samples of one block: the generated code of few minima is compiled well; with 16 a sample costs twice, with 22 three times as much.
_BLOCK = 4
_CELLS = 256


def _gamma2_quantile(u: float) -> float:
    """x with 1 - (1 + x) e**-x = u, by bisection."""
    lo, hi = 0.0, 64.0
    for _ in range(90):
        mid = (lo + hi) / 2
        # The series avoids cancellation for small x.
        p = mid * mid / 2 - mid**3 / 3 + mid**4 / 8 if mid < 1e-3 else 1 - (1 + mid) * math.exp(-mid)
        lo, hi = (mid, hi) if p < u else (lo, mid)
    return (lo + hi) / 2


def _array(values: list[float]) -> Column:
    """A constant without nulls, so that what is looked up in it needs no checks."""
    return F.array(*[F.lit(float(f"{x:.7g}")) for x in values])


def _tables() -> tuple[list[float], list[float], list[float], list[float]]:
    """Starts and slopes of the cells of r over u, and of ln c over u, the first cell of which is cut into cells again, twice."""
    r = [_gamma2_quantile(min(i / _CELLS, 1 - 0.25 / _CELLS)) for i in range(_CELLS + 1)]
    r[0] = _gamma2_quantile(0.25 / _CELLS)
    starts, slopes = [], []
    for depth in range(3):
        size = float(_CELLS) ** -(depth + 1)
        edges = [math.log(_gamma2_quantile(min(max(i, 0.25) * size, 1 - 0.25 * size))) for i in range(_CELLS + 1)]
        starts += edges[:-1]
        slopes += [b - a for a, b in zip(edges, edges[1:], strict=False)]
    return r[:-1], [b - a for a, b in zip(r, r[1:], strict=False)], starts, slopes


def _bits(x: Column, at: int, n: int) -> Column:
    return F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def _sample(term: Column, log_w: Column, k: Column, tables: tuple[Column, ...]) -> Column:
    """One long of a term for sample k: the smallest of a text tells its (term, t).  term and log_w aren't null."""
    r0, r1, c0, c1 = tables
    # Samples are told apart in bits that the term has from its hash.
    x = F.xxhash64(term.bitwiseXOR(F.shiftleft(k.cast("long"), 40)))
    # Bits: 8 + 8 + 8 for the cells of ln c, 12 inside its cell, 8 + 8 for r, 12 for b.
    cell = F.when(_bits(x, 0, 8) > 0, _bits(x, 0, 8)).when(_bits(x, 8, 8) > 0, _bits(x, 8, 8) + _CELLS).otherwise(_bits(x, 16, 8) + 2 * _CELLS).cast("int")
    i = _bits(x, 36, 8).cast("int")
    r = r0[i] + r1[i] * (_bits(x, 44, 8) * (1 / 256))
    b = _bits(x, 52, 12) * (1 / 4096)
    log_c = c0[cell] + c1[cell] * (_bits(x, 24, 12) * (1 / 4096))
    t = F.floor(log_w / r + b)
    # Below 128 in size: ln c lies between -17 and 3, r (t - b + 1) between ln w and ln w + r, r below 12 and ln w below 44.
    order = F.floor((log_c - r * (t - b + 1)) * 16777216.0)
    token = x.bitwiseXOR(F.shiftleft(t, 20)).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return F.shiftleft(order, 32).bitwiseOR(token)


def with_terms(rows: DataFrame, text: str) -> DataFrame:
    """rows exploded to one row per term: term, log_w.  A text without terms has no row."""
    plain = F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    words = F.when(plain != "", F.split(plain, r"[ \t\n\x0b\f\r]+"))
    ids = F.transform(words, lambda w: F.shiftleft(F.xxhash64(w), 31).bitwiseOR(F.char_length(w).cast("long")))
    rows = rows.withColumn("_s", F.array_sort(ids)).drop(text)
    at = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    rows = rows.where("_s is not null").withColumn("_at", at)
    term = lambda x, i: F.struct(F.get("_s", x).alias("w"), (F.coalesce(F.get("_at", i + 1), F.size("_s")) - x).alias("n"))
    rows = rows.withColumn("_term", F.explode(F.transform("_at", term)))
    term, length = F.coalesce("_term.w", F.lit(0).cast("long")), F.col("_term.w").bitwiseAND(F.lit((1 << 31) - 1).cast("long"))
    return rows.select(*[c for c in rows.columns if not c.startswith("_")], term.alias("term"), F.coalesce(F.log(F.col("_term.n").cast("double") * length), F.lit(0.0)).alias("log_w"))


def signatures(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """Samples of each key as an array `sig` of hashes of (term, t); a text without terms has none."""
    tables = tuple(_array(x) for x in _tables())
    blocks = -(-samples // _BLOCK)
    width = -(-samples // blocks)
    # Sample k has the same value in whatever block it lies.
    blocked = terms.withColumn("_block", F.explode(F.array(*[F.lit(i) for i in range(blocks)])))
    minima = blocked.groupBy(*keys, "_block").agg(*[F.min(_sample(F.col("term"), F.col("log_w"), F.col("_block") * width + j, tables)).alias(f"_{j}") for j in range(width)])
    token = lambda j: F.col(f"_{j}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    part = minima.select(*keys, F.struct("_block", F.array(*[token(j) for j in range(width)]).alias("sig")).alias("_part"))
    whole = part.groupBy(*keys).agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    return whole.select(*keys, F.slice(F.flatten(F.col("_parts.sig")), 1, samples).alias("sig"))


def as_text(sig: Column | str) -> Column:
    """The fingerprint of a signature: eight hexadecimal digits for each sample."""
    return F.coalesce(F.lower(F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x), 8, "0")), "")), F.lit(""))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal samples of two signatures."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.size(a)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def fingerprint(docs: DataFrame, key: str, text: str, samples: int = SAMPLES) -> DataFrame:
    """key, sig and fingerprint of every row's text; rows with equal keys count as one text."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    sigs = signatures(with_terms(rows, "text"), ["key"], samples)
    empty = rows.select("key").distinct().join(sigs.select("key"), "key", "left_anti").select("key", F.lit(None).cast("array<bigint>").alias("sig"))
    return sigs.union(empty).select(F.col("key").alias(key), "sig", as_text("sig").alias("fingerprint"))


def _arrays(pairs: list[tuple[int, int]]) -> list[Column]:
    if not pairs:
        return [F.array().cast("array<bigint>")] * 2
    return [F.expr(f"cast(split('{','.join(str(p[k]) for p in pairs)}', ',') as array<bigint>)") for k in (0, 1)]


def _range_of(pair: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted bounds are at most pair, by bisection."""
    rids, ties = _arrays(bounds)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(bounds).bit_length())))])

    def step(found: Column, size: Column) -> Column:
        at = found + size - 1
        # Beyond the end there is no bound.
        reached = F.coalesce(F.struct(F.get(rids, at), F.get(ties, at)) <= pair, F.lit(False)) & (at < len(bounds))
        return F.when(reached, found + size).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def _ranges(rows: DataFrame, per_range: int, most_ranges: int) -> tuple[list[tuple[int, int]], tuple[int, int] | None, list[tuple[int, int]]]:
    """Bounds of ranges of (rid, tie) of about per_range rows, each of them the pair of a row; the smallest pair; pairs of many rows.

    The bounds are quantiles of a sample of rows, so no distribution of the ids makes a range large; the sample grows with the
    number of ranges, not with the rows."""
    n = rows.select("rid").count()
    if not n:
        return [], None, []
    ranges = min(most_ranges, -(-n // per_range))
    # About twenty rows of the sample for each range; equal rows are sampled one by one.
    every = max(1, n // (20 * ranges))
    pair = F.struct("rid", "tie")
    drawn = rows.select("rid", "tie", (F.rand(7) < 1 / every).alias("drawn"))
    least, sample = drawn.agg(F.min(pair), F.collect_list(F.when(F.col("drawn"), pair))).first()
    pairs = sorted((x["rid"], x["tie"]) for x in sample)
    least = (least["rid"], least["tie"])
    hot = [p for p, k in Counter(pairs).items() if k > 8]
    return sorted({pairs[len(pairs) * k // ranges] for k in range(1, ranges)} - {least}) if pairs else [], least, hot


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, per_range: int = 256, most_ranges: int = 100_000) -> DataFrame:
    """Fingerprints of every text and its edited text: its last half replaced by the beginning of the next document's.

    Documents follow each other by id (null first), then by a hash of the text; after the last comes the first.  They are
    dealt out by ranges of (id, hash) of about per_range rows, or as many as make most_ranges ranges, so a document and the next
    share a task; the first of each range goes to the range before as well.  Where a sample tells that an id and its text are
    repeated so often that they would fill ranges, the rows are counted before the shuffle and are one row with a count until the
    end; each but the last of them has itself as the next document."""
    null_id = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.coalesce("doc_id", null_id).alias("rid"), F.xxhash64("text").alias("tie"), "doc_id", "text")
    bounds, least, hot = _ranges(rows, per_range, most_ranges)
    one = F.lit(1).cast("long").alias("n")
    if hot:
        many = F.col("tie").isin([t for _, t in hot])
        rows = rows.where(~many).select("*", one).union(rows.where(many).groupBy("rid", "tie", "doc_id").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n")))
    else:
        rows = rows.select("*", one)

    # The first row of a range is the bound where it begins (of the first range, the smallest); it goes to the range before as well.
    rows = rows.withColumn("b", _range_of(F.struct("rid", "tie"), bounds))
    start = [F.when(F.col("b") > 0, F.get(x, F.col("b") - 1)).otherwise(F.lit(least[k] if least else None).cast("long")) for k, x in enumerate(_arrays(bounds))]
    first = (F.col("rid") == start[0]) & (F.col("tie") == start[1])
    targets = F.array(F.struct(F.col("b").alias("b"), F.lit(0).alias("extra")), F.when(first, F.struct(((F.col("b") + len(bounds)) % (len(bounds) + 1)).cast("int").alias("b"), F.lit(1).alias("extra"))))
    rows = rows.withColumn("_to", F.explode(F.filter(targets, lambda x: x.isNotNull()))).select("_to.*", "rid", "tie", "doc_id", "text", "n")
    rows = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "b")
    in_order = Window.partitionBy("b").orderBy("extra", "rid", "tie", "doc_id")
    rows = rows.select("*", F.lead("text").over(in_order).alias("next"), F.row_number().over(in_order).cast("long").alias("rn"))

    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edit = lambda nxt: F.concat(F.substring(F.col("text"), F.lit(1), size - half), F.substring(nxt, F.lit(1), half))
    own = F.col("extra") == 0
    rows = rows.select("b", "rn", "extra", "n", "doc_id", size.alias("n_chars"), "text", F.when(own, edit(F.coalesce("next", F.lit("")))).alias("edited"), F.when(own & (F.col("n") > 1), edit(F.col("text"))).alias("own"))
    about = rows.where(own).select("b", "rn", F.struct("doc_id", "n", "n_chars", F.sha2("edited", 256).alias("edited"), F.sha2("own", 256).alias("own")).alias("about"), F.lit(None).cast("int").alias("side"), F.lit(None).cast("array<bigint>").alias("sig"))
    # A document's texts are told apart by the last two bits of the key.
    texts = rows.select("b", F.posexplode(F.array("text", "edited", "own")).alias("side", "t"), "rn").where("t is not null").select("b", (F.col("rn") * 4 + F.col("side")).alias("key"), "t")
    sigs = signatures(with_terms(texts, "t"), ["b", "key"], samples)
    key = F.col("key")
    sigs = sigs.select("b", F.shiftright(key, 2).alias("rn"), F.lit(None).cast(about.schema["about"].dataType).alias("about"), key.bitwiseAND(F.lit(3).cast("long")).cast("int").alias("side"), "sig")
    side = lambda k: F.first(F.when(F.col("side") == k, F.col("sig")), ignorenulls=True).alias(f"s{k}")
    # Both parts are dealt out by b already.
    joined = about.union(sigs).groupBy("b", "rn").agg(F.first("about", ignorenulls=True).alias("about"), side(0), side(1), side(2))
    joined = joined.withColumn("next", F.lead(F.struct("rn", "s0")).over(Window.partitionBy("b").orderBy("rn")))
    # A next row without terms is absent, or later than it would be.
    following = F.when(F.col("next.rn") == F.col("rn") + 1, F.col("next.s0"))
    joined = joined.where("about is not null").withColumn("following", following)
    repeated = F.col("about.n") > 1
    last = F.struct(one.alias("times"), F.col("about.edited").alias("sha"), F.col("s1").alias("edited"), F.col("following").alias("next"))
    others = F.when(repeated, F.struct((F.col("about.n") - 1).alias("times"), F.col("about.own").alias("sha"), F.col("s2").alias("edited"), F.col("s0").alias("next")))
    out = joined.select("about.doc_id", F.col("about.n_chars").cast("long").alias("n_chars"), "s0", F.explode(F.filter(F.array(last, others), lambda x: x.isNotNull())).alias("r"))
    out = out.select("doc_id", "n_chars", F.col("r.sha").alias("edited_sha256"), as_text("s0").alias("fingerprint"), as_text("r.edited").alias("edited_fingerprint"), likeness("s0", "r.edited").alias("near_edited"), likeness("s0", "r.next").alias("near_next"), "r.times")
    return out.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("_", "times")
