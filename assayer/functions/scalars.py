"""Scalar functions on columns: checks and conversions of text, built from Spark expressions only."""

from __future__ import annotations

import functools
import re
import zoneinfo

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
_INFINITY = float("inf")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(x: Column | str) -> Column:
    """Without blanks, tabs, carriage returns and line feeds at either end."""
    return F.btrim(_col(x), F.lit(" \t\r\n"))


def has_outer_space(x: Column | str) -> Column:
    return _col(x) != trimmed(x)


def is_blank(x: Column | str) -> Column:
    """Null or white space only."""
    return F.coalesce(trimmed(x) == "", F.lit(True))


def first_nonempty(*xs: Column | str) -> Column:
    """The first that has more than white space, unchanged."""
    return F.coalesce(*[F.when(~is_blank(x), _col(x)) for x in xs])


def strict_number(x: Column | str) -> Column:
    """x as a double if it is written as a plain finite number, else null."""
    value = _col(x).try_cast("double")
    return F.when(_col(x).rlike(NUMBER) & (F.abs(value) < _INFINITY), value)


def is_integer(number: Column) -> Column:
    return number == F.floor(number)


def valid_date(x: Column | str) -> Column:
    return F.coalesce(_col(x).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & _col(x).try_cast("date").isNotNull(), F.lit(False))


def valid_clock(x: Column | str) -> Column:
    """HH:MM or HH:MM:SS, with a fraction of seconds, before 24:00."""
    return F.coalesce(_col(x).rlike(r"^(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]+)?)?\z"), F.lit(False))


def valid_partial_date(x: Column | str) -> Column:
    """A year, a month or a date."""
    return F.coalesce(_col(x).rlike(r"^[0-9]{4}(?:-(?:0[1-9]|1[0-2]))?\z"), F.lit(False)) | valid_date(x)


_DURATION = r"^P(?:([0-9]+(?:\.[0-9]+)?)D)?(?:T(?:([0-9]+(?:\.[0-9]+)?)H)?(?:([0-9]+(?:\.[0-9]+)?)M)?(?:([0-9]+(?:\.[0-9]+)?)S)?)?\z"


def duration_seconds(x: Column | str) -> Column:
    """Seconds of PnDTnHnMnS; null without any part, and for signs, years, months and weeks."""
    x = _col(x)
    # One match puts the parts side by side; a text that doesn't match has a single piece.
    pieces = F.split(F.regexp_replace(x, _DURATION, "$1,$2,$3,$4"), ",")

    def seconds(p: Column) -> Column:
        part = lambda k: F.coalesce(F.nullif(F.get(p, F.lit(k)), F.lit("")).try_cast("double"), F.lit(0.0))
        return F.when((F.size(p) == 4) & F.exists(p, lambda s: s != "") & ~F.contains(x, F.lit(",")) & ~F.endswith(x, F.lit("T")), part(0) * 86400 + part(1) * 3600 + part(2) * 60 + part(3))

    return F.when(x.isNotNull(), F.get(F.transform(F.array(pieces), seconds), F.lit(0)))


_OFFSET = r"(Z|[+-](?:[01][0-9]|2[0-3]):[0-5][0-9])\z"


def datetime_parts(x: Column | str) -> Column:
    """struct<ok, naive>: a date and a clock joined by one T, with Z or an offset unless naive."""
    x = _col(x)
    plain = F.regexp_replace(x, _OFFSET, "")
    pieces = F.split(plain, "T")
    ok = (F.size(pieces) == 2) & valid_date(F.get(pieces, F.lit(0))) & valid_clock(F.get(pieces, F.lit(1)))
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), F.coalesce(~x.rlike(_OFFSET), F.lit(True)).alias("naive"))


@functools.lru_cache(maxsize=1)
def time_zones() -> frozenset[str]:
    return frozenset(zoneinfo.available_timezones() | {"unknown", "UTC"})


def valid_zone(name: str | None) -> bool:
    return name in time_zones()


# Accented letters and the plain ones that stand for them, one for one; then those that become several.
_ACCENTED = "àâäáãåāăąçćčďđèéêëēėęěğģìíîïīįıķłļľñńňņòóôöõōőøŕřśšşșťţțúùûüūůűųýÿźżžðµ"
_PLAIN = "aaaaaaaaacccddeeeeeeeeggiiiiiiiklllnnnnoooooooorrsssstttuuuuuuuuyyzzzdu"
_WIDE = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}


def normalise_name(x: Column | str) -> Column:
    """Lower-case ASCII words with single blanks between them; null if nothing is left."""
    lowered = F.lower(_col(x))
    out = lowered
    for a, b in _WIDE.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    # Looking up every letter is slow, and most texts have none to look up.
    out = F.when(lowered.rlike(r"[^\x00-\x7F]"), F.translate(out, _ACCENTED, _PLAIN)).otherwise(lowered)
    return F.nullif(F.trim(F.regexp_replace(out, "[^a-z0-9]+", " ")), F.lit(""))


def plain_diagnostic(x: Column | str, limit: int | None = 500) -> Column:
    """Without terminal escapes and tags, white space and control characters as single blanks, at most `limit` characters."""
    out = F.regexp_replace(_col(x), r"\x1B\[[0-9;]*[A-Za-z]", "")
    out = F.regexp_replace(F.regexp_replace(out, "<[^>]*>", " "), r"[\s\p{Cntrl}]+", " ")
    return F.substring(F.trim(out), 1, limit) if limit else F.trim(out)


def column_name(n: Column | str) -> Column:
    """A, B ... Z, AA ... of column 1, 2 ... (up to three letters)."""
    n = _col(n).cast("int")
    letter = lambda v: F.chr((v % 26 + 65).cast("int"))
    one = n - 1
    two = F.floor(one / 26) - 1
    three = F.floor(two / 26) - 1
    return F.concat(F.when(three >= 0, letter(three)).otherwise(""), F.when(two >= 0, letter(two)).otherwise(""), letter(one))


def column_number(name: Column | str) -> Column:
    letters = F.filter(F.split(F.upper(_col(name)), ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0), lambda acc, c: (acc * 26 + F.ascii(c) - 64).cast("int"))


def cell_ref(column: Column | str, row: Column | str) -> Column:
    return F.concat(column_name(column), _col(row).cast("string"))


def safe_file_name(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), "[^A-Za-z0-9_.-]", "_")


def osm_url(kind: Column | str, number: Column | str) -> Column:
    """Address of a map object; null if either part is."""
    return F.concat(F.lit("https://www.openstreetmap.org/"), _col(kind), F.lit("/"), _col(number).cast("string"))


def row_digest(*xs: Column | str, between: str = "|") -> Column:
    return F.sha2(F.concat_ws(between, *[_col(x) for x in xs]), 256)


def fixed(x: Column | str, digits: int) -> Column:
    """x with so many decimals; null stays null."""
    return F.when(_col(x).isNotNull(), F.format_string(f"%.{digits}f", _col(x).cast("double")))


def cache_key(lat: Column | str, lon: Column | str) -> Column:
    return F.format_string("%.7f_%.7f", _col(lat).cast("double"), _col(lon).cast("double"))


def json_text(x: Column | str, path: str) -> Column:
    return F.get_json_object(_col(x), path)


def is_json(x: Column | str) -> Column:
    return F.try_parse_json(_col(x)).isNotNull()


def safe_pattern(pattern: str | None) -> str | None:
    """The pattern for Java, or null if it can't be compiled (then nothing matches)."""
    if not pattern:
        return None
    try:
        re.compile(pattern)
    except re.error:
        return None
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            spark._jvm.java.util.regex.Pattern.compile(pattern)
        except Exception:
            return None
    return pattern


def matches(x: Column | str, pattern: str | None) -> Column:
    """Whether the pattern occurs in x; a pattern that can't be compiled occurs nowhere."""
    safe = safe_pattern(pattern)
    return F.lit(False) if safe is None else F.coalesce(_col(x).rlike(safe), F.lit(False))
