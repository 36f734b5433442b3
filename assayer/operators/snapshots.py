"""Inventories of tables and what changed from one snapshot to the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .findings import Table


def field_profile(df: DataFrame, fields: list[str], types: bool = False) -> DataFrame:
    """field, nrows, ndist, missing (and the storage types) of each field, from one scan.

    Two levels: rows are first counted by field, value and type, which combines before the shuffle and spreads a field's
    values over all tasks; only the counts of distinct values meet by field.  A table without rows has a row for each field too."""
    if not fields:
        return df.sparkSession.createDataFrame([], "field string, nrows long, ndist long, missing long, types array<string>")
    kind = lambda f: F.col("types").getField(f) if types else F.lit(None).cast("string")
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value"), kind(f).alias("type")) for f in fields])
    counts = df.select(F.explode(cells).alias("c")).groupBy("c.field", "c.value", "c.type").agg(F.count(F.lit(1)).alias("n"))
    by_value = counts.groupBy("field", "value").agg(F.sum("n").alias("n"), F.collect_set("type").alias("types"))
    out = by_value.groupBy("field").agg(F.sum("n").alias("nrows"), F.count("value").alias("ndist"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"))
    named = F.array(*[F.lit(f) for f in fields])
    all_fields = df.sparkSession.range(1).select(F.explode(named).alias("field"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return all_fields.join(out, "field", "left").select("field", zero("nrows"), zero("ndist"), zero("missing"), F.coalesce("types", F.array().cast("array<string>")).alias("types"))


def table_extent(cells: DataFrame, keys: list[str], row: str = "row") -> DataFrame:
    """height (greatest row number) and number of cells of each sheet."""
    return cells.groupBy(*keys).agg(F.max(row).alias("height"), F.count(F.lit(1)).alias("cells"))


def content_digests(cells: DataFrame) -> dict[str, str]:
    return {r[0]: r[1] for r in sheet_digests(cells).collect()}


def sheet_digests(cells: DataFrame) -> DataFrame:
    """sheet and digest of its cells, which doesn't depend on the order of rows: the digests of cells, with their places, are summed up."""
    fields = [c for c in ("row", "col", "type", "value", "formula") if c in cells.columns]
    line = F.sha2(F.to_json(F.struct(*fields)), 256)
    # Sums of 60-bit parts of the digests, so no task holds all of them.
    parts = [F.sum(F.conv(F.substring("_l", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).alias(f"p{k}") for k in range(4)]
    sums = cells.select("sheet", line.alias("_l")).groupBy("sheet").agg(F.count(F.lit(1)).alias("n"), *parts)
    return sums.select("sheet", F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in sums.columns[1:]]), 256).alias("digest"))


def record_changes(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str] | None = None) -> DataFrame:
    """keys and change (added, removed, modified) of records that differ in the fields that both have; keys must be unique and not null."""
    fields = fields if fields is not None else [c for c in before.columns if c in after.columns and c not in keys]
    a = before.select(*keys, F.struct(F.lit(True).alias("_there"), *fields).alias("_a"))
    b = after.select(*keys, F.struct(F.lit(True).alias("_there"), *fields).alias("_b"))
    joined = a.join(b, keys, "full_outer")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "modified")
    return joined.select(*keys, change.alias("change")).where("change is not null")


def has_row_keys(df: DataFrame, key: str) -> bool:
    """Whether the key is never null and never repeated."""
    worst = df.groupBy(key).count().agg(F.max("count"), F.bool_or(F.col(key).isNull())).first()
    return not worst[1] and (worst[0] or 0) <= 1


def inventory(tables: dict[str, Table], cells: DataFrame | None = None) -> list[dict]:
    """One entry for each sheet: role, extent, fields with storage types and missing values, key and digest of its cells."""
    digests = content_digests(cells) if cells is not None else {}
    out = []
    for t in tables.values():
        fields = {r["field"]: {"types": r["types"], "missing": r["missing"]} for r in field_profile(t.frame, t.fields, types=True).collect()} if t.fields else {}
        out.append({"sheet": t.name, "role": t.role, "rows": t.rows, "columns": t.columns, "fields": t.fields, "excluded_fields": t.excluded, "key_field": t.key_field, "key_scope": t.key_scope, "field_profile": fields, "content_sha256": digests.get(t.name, "")})
    return out


def compare(old: list[dict], new: list[dict], before: dict[str, DataFrame], tables: dict[str, Table], keep: Callable[[str, DataFrame], str]) -> dict:
    """Changes of sheets, fields, keys and contents, and of records where both snapshots have row keys.

    The records that changed are handed to keep(sheet, changes), which tells where they are; only their counts come back here."""
    a, b = {s["sheet"]: s for s in old}, {s["sheet"]: s for s in new}
    out = {"added_sheets": [n for n in b if n not in a], "removed_sheets": [n for n in a if n not in b], "sheets": {}}
    for name in (n for n in a if n in b):
        x, y = a[name], b[name]
        entry = {
            "rows_before": x["rows"], "rows_after": y["rows"], "added_fields": [f for f in y["fields"] if f not in x["fields"]], "removed_fields": [f for f in x["fields"] if f not in y["fields"]],
            "field_order_changed": x["fields"] != y["fields"], "content_changed": x["content_sha256"] != y["content_sha256"], "key_definition_changed": (x["key_field"], x["key_scope"]) != (y["key_field"], y["key_scope"]),
        }
        t = tables[name]
        if t.key_scope == "row" and name in before and t.key_field in before[name].columns:
            fields = [f for f in before[name].columns if f in t.fields]
            past, now = before[name].select(*fields), t.frame.select(*[f"`{f}`" for f in fields])
            if has_row_keys(past, t.key_field) and has_row_keys(now, t.key_field):
                changes = record_changes(past, now, [t.key_field]).persist()
                counts = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
                entry["records"] = {k: counts.get(k, 0) for k in ("added", "removed", "modified")}
                entry["record_changes"] = keep(name, changes)
                changes.unpersist()
        elif t.key_scope == "entity":
            entry["record_comparison"] = "not_assessed: a key that is repeated does not tell which row became which"
        out["sheets"][name] = entry
    return out
