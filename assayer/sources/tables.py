"""Plain inputs: external CSV evidence, country codes, points, and cached lookups."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NEVER = "\u0000never"  # no text stands for null

REVERSE = "name string, osm_type string, osm_id string, lat string, lon string, category string, type string, display_name string, address map<string,string>, namedetails map<string,string>"
NODES = "elements array<struct<id:bigint,lat:double,lon:double,tags:map<string,string>>>"


def _numbered(df: DataFrame) -> DataFrame:
    """df with file_row, the number of each row in its file, from 1.  The rows of a file come to one task, in order."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, int] = {}
        for batch in batches:
            rows = []
            for path in batch.column("_path").to_pylist():
                last[path] = last.get(path, 0) + 1
                rows.append(last[path])
            kept = [c for c in batch.schema.names if c != "_path"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(rows, pa.int64())], names=[*kept, "file_row"])

    names = [f for f in df.schema.fields if f.name != "_path"]
    return df.mapInArrow(number, T.StructType([*names, T.StructField("file_row", T.LongType())]))


def read_external_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header as text: nothing is trimmed, empty stays empty, no text means null.  file_row is numbered in the scan."""
    head = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", _NEVER).option("emptyValue", "").csv(path)
    return _numbered(head.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in head.columns if c != "file_row"], F.col("_metadata.file_path").alias("_path")))


def iso_countries(spark: SparkSession) -> list[str]:
    """The country codes of ISO 3166-1 that the Java runtime knows, NA among them."""
    return sorted(spark._jvm.java.util.Locale.getISOCountries())


def read_country_codes(spark: SparkSession, path: str) -> DataFrame:
    """code and name of a tab-separated list with # comments; the code NA is a code."""
    rows = spark.read.schema("code string, name string").option("sep", "\t").option("comment", "#").option("nullValue", _NEVER).option("quote", "").csv(path)
    return rows.where(F.col("code").rlike("^[A-Z]{2}$"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """position in the file, id, latitude and longitude of a CSV file as text and numbers; other columns are dropped."""
    rows = read_external_csv(spark, path)
    missing = {"id", "latitude", "longitude"} - set(rows.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    return rows.select(F.col("file_row").alias("position"), "id", F.col("latitude").try_cast("double").alias("latitude"), F.col("longitude").try_cast("double").alias("longitude"))


def read_reverse_cache(spark: SparkSession, path: str) -> DataFrame:
    """Cached reverse lookups (files <lat>_<lon>_zoom15.json) with the key of their names; files that can't be read are misses."""
    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    rows = text.select(F.regexp_extract("file", r"^(-?[0-9.]+_-?[0-9.]+)_zoom15", 1).alias("key"), F.from_json("value", REVERSE).alias("r"))
    return rows.where("r.osm_type is not null or r.name is not null").select("key", "r.*")


def read_node_cache(spark: SparkSession, path: str) -> DataFrame:
    """Distinct place nodes of cached searches (files <lat>_<lon>_r5000.json)."""
    text = spark.read.text(path, wholetext=True).select("value")
    return text.select(F.explode(F.from_json("value", NODES)["elements"]).alias("n")).select("n.*").dropDuplicates(["id"])


CONFIG_KEYS = {"max_cells", "missing_token", "references", "required_assessments", "enrich_toponyms", "geocoding_delay"}


def check_config(config: dict) -> dict:
    """The configuration, if it has no unknown key and every value is of its kind."""
    unknown = sorted(set(config) - CONFIG_KEYS)
    if unknown:
        raise ValueError("no such settings: " + ", ".join(unknown))
    cells, token, enrich = config.get("max_cells"), config.get("missing_token"), config.get("enrich_toponyms")
    if cells is not None and (isinstance(cells, bool) or not isinstance(cells, int | float) or cells < 1 or cells != int(cells)):
        raise ValueError("max_cells: a whole number above zero is needed")
    if token is not None and (not isinstance(token, str) or not token or "\n" in token or "\r" in token):
        raise ValueError("missing_token: one line of text is needed")
    if enrich is not None and not isinstance(enrich, bool):
        raise ValueError("enrich_toponyms: true or false is needed")
    for kind in config.get("references") or {}:
        if kind not in ("registry", "aliases", "lineage"):
            raise ValueError(f"no such reference: {kind}")
    return config


def read_config(path: str) -> dict:
    return check_config(json.loads(Path(path).read_text(encoding="utf-8")))
