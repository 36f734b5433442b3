"""What spreadsheet numbers mean: number formats and date serials."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Built-in number formats that show dates and times.
_BUILT_IN = {**dict.fromkeys((14, 15, 16, 17), "date"), 22: "datetime", **dict.fromkeys((18, 19, 20, 21, 45, 47), "time"), 46: "duration"}


def format_kind(number: int, code: str | None) -> str:
    """number, date, datetime, time or duration: what cells of this format hold."""
    if number in _BUILT_IN:
        return _BUILT_IN[number]
    if not code:
        return "number"
    code = re.sub(r'"[^"]*"|\\.|_.|\*.', "", code).lower()
    if re.search(r"\[(h+|m+|s+)\]", code):
        return "duration"
    code = re.sub(r"\[[^\]]*\]", "", code)
    has_date, has_time = bool(re.search("[yd]", code)), bool(re.search("[hs]", code))
    return {(True, True): "datetime", (True, False): "date", (False, True): "time", (False, False): "number"}[has_date, has_time]


def excel_temporal(serial: Column | str, kind: str, date1904: bool = False) -> Column:
    """struct<value, type> of a serial number shown as date, datetime, time or duration; impossible ones are temporal_error.

    In the 1900 system serial 60 (29 February 1900) doesn't exist, and days before it count from another origin."""
    serial = F.col(serial) if isinstance(serial, str) else serial
    whole = F.floor(serial)
    origin = F.lit("1904-01-01") if date1904 else F.when(serial < 60, F.lit("1899-12-31")).otherwise(F.lit("1899-12-30"))
    day = F.date_format(F.date_add(origin.cast("date"), F.least(whole, F.lit(2_958_465)).cast("int")), "yyyy-MM-dd")
    seconds = F.round((serial - whole) * 86400, 6)
    micros = F.round(seconds * 1_000_000).cast("long")
    fraction = F.regexp_replace(F.lpad((micros % 1_000_000).cast("string"), 6, "0"), r"0+\z", "")
    clock = F.concat(F.format_string("%02d:%02d:%02d", F.floor(micros / 3_600_000_000), F.floor(micros / 60_000_000) % 60, F.floor(micros / 1_000_000) % 60), F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""))
    bad = serial.isNull() | F.isnan(serial) | (F.abs(serial) == float("inf")) | (serial < 0)
    if kind == "duration":
        value = F.format_string("PT%.9fS", serial * 86400)
    else:
        if not date1904 and kind != "time":
            bad = bad | ((serial >= 60) & (serial < 61))
        bad = bad | (seconds >= 86400)
        if kind == "date":
            bad, value = bad | (serial != whole), day
        elif kind == "time":
            bad, value = bad | (whole != 0), clock
        else:
            value = F.concat(day, F.lit("T"), clock)
    return F.struct(F.when(bad, serial.cast("string")).otherwise(value).alias("value"), F.when(bad, "temporal_error").otherwise(kind).alias("type"))
