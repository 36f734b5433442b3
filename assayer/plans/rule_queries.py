"""Queries that run whole families of rules over tables derived from the star schema, and DuckDB SQL for the same findings."""

from __future__ import annotations

import csv
import io
import json
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import evidence, findings, snapshots, structure, toponyms, values
from ..operators.findings import ERROR, Findings, Table
from .registry import query, table_of, text_of

PLACE = ("rule_id", "sheet", "field", "source_row", "original_value")


def _shown(found: Findings, *columns: str) -> DataFrame:
    return found.findings().select(*(columns or PLACE))


def _union(*parts: str) -> str:
    """Findings as SQL: each part is (rule, sheet, field, row, value) of a select."""
    return " union all ".join(f"select {rule} as rule_id, {sheet} as sheet, {field} as field, cast({row} as bigint) as source_row, cast({value} as varchar) as original_value from {rest}" for rule, sheet, field, row, value, rest in parts)


_ONE = "(select 1) one"
_CUSTOMERS = """(select c_custkey as k, c_mktsegment as label, case when c_custkey % 13 = 0 then null when c_custkey % 17 = 0 then '99' when c_custkey % 19 = 0 then concat(cast(c_custkey % 50 as varchar), '.5')
 when c_custkey % 23 = 0 then 'n/a' else cast(c_custkey % 50 as varchar) end as amount, case c_custkey % 3 when 0 then 'TRUE' when 1 then 'FALSE' else 'yes' end as flag,
 case when c_custkey % 9 = 0 then concat(' ', c_mktsegment) else c_mktsegment end as segment, cast(c_nationkey as varchar) as nation from customer) c"""


@query(_union(
    ("'value.text_type'", "'data__customer'", "'label'", "k", "label", f"{_CUSTOMERS} where k % 5 = 0"),
    ("'value.required'", "'data__customer'", "'amount'", "k", "null", f"{_CUSTOMERS} where amount is null"),
    ("'value.legacy_missing_code'", "'data__customer'", "'amount'", "k", "amount", f"{_CUSTOMERS} where amount = '99'"),
    ("'value.numeric_type'", "'data__customer'", "'amount'", "k", "amount", f"{_CUSTOMERS} where amount = 'n/a'"),
    ("'value.integer'", "'data__customer'", "'amount'", "k", "amount", f"{_CUSTOMERS} where amount like '%.5'"),
    ("'value.bound'", "'data__customer'", "'amount'", "k", "amount", f"{_CUSTOMERS} where amount <> '99' and try_cast(amount as double) not between 5 and 40"),
    ("'value.boolean'", "'data__customer'", "'flag'", "k", "flag", f"{_CUSTOMERS} where flag = 'yes'"),
    ("'value.controlled_code'", "'data__customer'", "'segment'", "k", "segment", f"{_CUSTOMERS} where segment not in ('BUILDING', 'FURNITURE', 'MACHINERY')"),
    ("'value.code_whitespace'", "'data__customer'", "'segment'", "k", "segment", f"{_CUSTOMERS} where segment like ' %'"),
    ("'value.controlled_code'", "'data__customer'", "'nation'", "k", "nation", f"{_CUSTOMERS} where cast(nation as int) >= 20"),
    ("'metadata.unknown_type'", "'data__customer'", "'id'", "null", "'odd'", _ONE),
    ("'metadata.field_json'", "'data__customer'", "'id'", "null", "'['", _ONE),
    ("'metadata.numeric_bound'", "'ref__nation'", "'code'", "null", "null", _ONE),
    ("'value.reference_definition'", "'ref__nation'", "'name'", "null", "null", _ONE)))
def validate_values(spark, d):
    """All rules on declared values: types, limits, missing codes, listed and joined vocabularies, and faulty declarations."""
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    amount = F.when(k % 13 == 0, None).when(k % 17 == 0, "99").when(k % 19 == 0, F.concat(text_of(k % 50), F.lit(".5"))).when(k % 23 == 0, "n/a").otherwise(text_of(k % 50))
    flag = F.when(k % 3 == 0, "TRUE").when(k % 3 == 1, "FALSE").otherwise("yes")
    rows = table_of(spark, d, "customer").select(k.alias("source_row"), text_of(k).alias("id"), seg.alias("label"), amount.alias("amount"), flag.alias("flag"), F.when(k % 9 == 0, F.concat(F.lit(" "), seg)).otherwise(seg).alias("segment"), text_of(F.col("c_nationkey")).alias("nation"))
    fields = rows.columns[1:]
    kinds = {"label": F.when(F.col("source_row") % 5 == 0, "number").otherwise("text"), "amount": F.when(F.col("amount") == "n/a", "text").otherwise("number")}
    customers = Table("data__customer", fields, rows.withColumn("types", F.struct(*[kinds.get(f, F.lit("text")).alias(f) for f in fields])), key_field="id")
    nations = Table.of("ref__nation", table_of(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("source_row"), text_of(F.col("n_nationkey")).alias("code"), F.col("n_name").alias("name")), {"code": "number"}, role="ref")
    rule = values.FieldRule
    found = Findings(spark)
    values.validate_values(found, {"data__customer": customers, "ref__nation": nations}, {
        ("data__customer", "id"): rule(type="odd", allowed_values="["), ("data__customer", "label"): rule(type="text"), ("data__customer", "amount"): rule(type="integer", required="true", minimum="5", maximum="40", missing_codes='["99"]'),
        ("data__customer", "flag"): rule(type="boolean"), ("data__customer", "segment"): rule(allowed_values='["BUILDING", "FURNITURE", "MACHINERY"]'), ("data__customer", "nation"): rule(ref_sheet="ref__nation", ref_field="code"),
        ("ref__nation", "code"): rule(type="number", minimum="x"), ("ref__nation", "name"): rule(ref_sheet="data__customer", ref_field="id")})
    return _shown(found)


_EVENTS = """(select event_id as k, case event_id % 4 when 0 then '2024-02-30' when 1 then '2024-2-3' else '2024-02-29' end as day, case event_id % 5 when 0 then 'PT6H5M0S' when 1 then 'PT30H' when 2 then '25:00' else '06:05' end as clock,
 case event_id % 3 when 0 then '2024-01-02T03:04:05' when 1 then '2024-01-02T03:04:05Z' else '2024-01-02 03:04' end as moment, case event_id % 6 when 0 then 'P1Y' when 1 then '90' else 'PT90M' end as len, case event_id % 7 when 0 then '2024-13' when 1 then '2024' else '2024-12' end as part from events) e"""


@query(_union(
    ("'temporal.invalid'", "'data__events'", "'seen_date'", "k", "day", f"{_EVENTS} where day <> '2024-02-29'"),
    ("'temporal.clock_serialization'", "'data__events'", "'seen_time'", "k", "clock", f"{_EVENTS} where clock = 'PT6H5M0S'"),
    ("'temporal.timezone_missing'", "'data__events'", "'seen_time'", "k", "null", _EVENTS),
    ("'temporal.invalid'", "'data__events'", "'seen_time'", "k", "clock", f"{_EVENTS} where clock in ('PT30H', '25:00')"),
    ("'temporal.timezone_missing'", "'data__events'", "'seen_datetime'", "k", "moment", f"{_EVENTS} where k % 3 <> 1"),
    ("'temporal.invalid'", "'data__events'", "'seen_datetime'", "k", "moment", f"{_EVENTS} where k % 3 = 2"),
    ("'temporal.invalid'", "'data__events'", "'len'", "k", "len", f"{_EVENTS} where k % 6 = 0"),
    ("'temporal.invalid'", "'data__events'", "'bare'", "k", "len", f"{_EVENTS} where k % 6 < 2"),
    ("'temporal.invalid'", "'data__events'", "'part'", "k", "part", f"{_EVENTS} where k % 7 = 0"),
    ("'temporal.timezone'", "'ref__zones'", "'open_time'", "null", "'Mars/Base'", _ONE)))
def validate_temporal(spark, d):
    """All rules on dates, clock times, timestamps, durations, partial dates and time zones."""
    k = F.col("event_id")
    pick = lambda n, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.least(k % n, F.lit(len(xs) - 1)) + 1).cast("int"))
    length = pick(6, "P1Y", "90", "PT90M")
    rows = table_of(spark, d, "events").select(k.alias("source_row"), pick(4, "2024-02-30", "2024-2-3", "2024-02-29").alias("seen_date"), pick(5, "PT6H5M0S", "PT30H", "25:00", "06:05").alias("seen_time"), pick(3, "2024-01-02T03:04:05", "2024-01-02T03:04:05Z", "2024-01-02 03:04").alias("seen_datetime"), length.alias("len"), length.alias("bare"), pick(7, "2024-13", "2024", "2024-12").alias("part"))
    fields = rows.columns[1:]
    kinds = {"seen_time": F.when(F.startswith(F.col("seen_time"), F.lit("PT")), "duration").otherwise("text")}
    events = Table("data__events", fields, rows.withColumn("types", F.struct(*[kinds.get(f, F.lit("text")).alias(f) for f in fields])))
    zones = Table.of("ref__zones", table_of(spark, d, "region").select(F.col("r_regionkey").alias("source_row"), F.lit("08:00").alias("open_time")), role="ref")
    rule = values.FieldRule
    found = Findings(spark)
    values.validate_temporal(found, {"data__events": events, "ref__zones": zones}, {("data__events", "len"): rule(type="duration", unit="s"), ("data__events", "bare"): rule(type="duration"), ("data__events", "part"): rule(type="partial_date"), ("ref__zones", "open_time"): rule(timezone="Mars/Base")})
    return _shown(found)


_IDS = """(select c_custkey as k, case when c_custkey % 29 = 0 then null when c_custkey % 31 = 0 then concat(' ', id) when c_custkey % 37 = 0 then lower(id) else id end as id from
 (select c_custkey, concat(case c_custkey % 4 when 0 then 'NA' when 1 then 'QQ' else 'FI' end, lpad(cast(c_custkey % 40 as varchar), 2, '0'), '_', lpad(cast((c_custkey // 2) % 400 as varchar), 4, '0'), '_A', cast(c_custkey % 3 as varchar)) as id from customer) x) c"""
_SHAPED = f"{_IDS} where regexp_matches(id, '^[A-Z]{{2}}[0-9]{{2}}_[0-9]{{4}}_[A-Z][0-9]+$')"


@query(_union(
    ("'identifier.missing'", "'data__ids'", "'id'", "k", "null", f"{_IDS} where id is null"),
    ("'identifier.storage'", "'data__ids'", "'id'", "k", "id", f"{_IDS} where id is not null and k % 41 = 0"),
    ("'identifier.whitespace'", "'data__ids'", "'id'", "k", "id", f"{_IDS} where id like ' %'"),
    ("'identifier.country'", "'data__ids'", "'id'", "k", "id", f"{_SHAPED} and substr(id, 1, 2) = 'QQ'"),
    ("'identifier.zero_serial'", "'data__ids'", "'id'", "k", "id", f"{_SHAPED} and substr(id, 6, 4) = '0000'"),
    ("'identifier.year'", "'data__ids'", "'id'", "k", "id", f"{_SHAPED} and cast(substr(id, 3, 2) as int) not between 10 and 35"),
    ("'identifier.zero_child'", "'data__ids'", "'id'", "k", "id", f"{_SHAPED} and id like '%_A0'"),
    ("'identifier.syntax'", "'data__ids'", "'id'", "k", "id", f"{_IDS} where id is not null and not regexp_matches(id, '^[A-Z]{{2}}[0-9]{{2}}_[0-9]{{4}}_[A-Z][0-9]+$')"),
    ("'identifier.lexical'", "'data__ids'", "'id'", "k", "id", f"{_IDS} where id is not null and not regexp_matches(id, '^[A-Z][A-Z0-9]*(_[A-Z0-9]+)*$')"),
    ("'identifier.width'", "'data__ids'", "'id'", "k", "id", f"{_IDS} where id is not null and length(id) <> 12"),
    ("'identifier.duplicate_row_key'", "'data__ids'", "'id'", "k", "id", "(select *, count(*) over (partition by id) as n from " + _IDS + ") y where id is not null and n > 1"),
    ("'identifier.profile_missing'", "'data__a'", "'id'", "null", "null", _ONE),
    ("'identifier.namespace'", "'data__b'", "'id'", "null", "null", _ONE),
    ("'identifier.profile_definition'", "'data__b'", "'id'", "null", "'other'", _ONE),
    ("'identifier.profile_pattern'", "'data__b'", "'id'", "null", "null", _ONE),
    ("'identifier.year_range'", "'data__c'", "'id'", "null", "null", _ONE),
    ("'identifier.profile_definition'", "'data__d'", "'id'", "null", "null", _ONE)))
def validate_identifiers(spark, d):
    """All rules on identifiers and their profiles, with the country codes of ISO 3166-1."""
    from ..sources.tables import iso_countries

    k = F.col("c_custkey")
    number = lambda x, n: F.lpad(text_of(x), n, "0")
    made = F.concat(F.when(k % 4 == 0, "NA").when(k % 4 == 1, "QQ").otherwise("FI"), number(k % 40, 2), F.lit("_"), number(F.floor(k / 2) % 400, 4), F.lit("_A"), text_of(k % 3))
    rows = table_of(spark, d, "customer").select(k.alias("source_row"), F.when(k % 29 == 0, None).when(k % 31 == 0, F.concat(F.lit(" "), made)).when(k % 37 == 0, F.lower(made)).otherwise(made).alias("id"))
    kind = F.when(F.col("id").isNull(), "blank").when(F.col("source_row") % 41 == 0, "number").otherwise("text")
    ids = Table("data__ids", ["id"], rows.withColumn("types", F.struct(kind.alias("id"))), key_field="id", key_scope="row")
    sound = rows.where("id is not null and source_row % 41 <> 0 and source_row % 31 <> 0 and source_row % 37 <> 0 and source_row % 4 <> 1 and source_row % 40 between 10 and 35 and source_row % 3 <> 0").where(F.floor(F.col("source_row") / 2) % 400 > 0)
    other = lambda name: Table.of(f"data__{name}", sound, key_field="id", key_scope="entity")
    profile = lambda **more: values.Profile(**({"type": "field_collection", "namespace": "n", "serial_width": 4, "child_pattern": "_[A-Z][0-9]+", "year_range": [2010, 2035]} | more))
    profiles = {"p": profile(width=12), "b": values.Profile("other", "", ""), "c": profile(year_range=[2010]), "d": profile(year_digits=3)}
    rules = {(f"data__{x}", "id"): values.FieldRule(identifier_profile=x) for x in "abcd"}
    found = Findings(spark)
    values.validate_identifiers(found, {t.name: t for t in (ids, *(other(x) for x in "abcd"))}, rules, profiles, "p", iso_countries(spark))
    return _shown(found)


_REG = "(select c_custkey as k, concat('C', cast(c_custkey as varchar)) as id, case c_custkey % 11 when 0 then 'retired' when 1 then 'void' else 'issued' end as status from customer where c_custkey % 10 <> 0) r"


@query(_union(
    ("'identifier.unregistered'", "'data__orders'", "'id'", "o.o_orderkey", "concat('C', cast(o.o_custkey as varchar))", f"orders o left join {_REG} on r.k = o.o_custkey where r.k is null"),
    ("'identifier.retired_reference'", "'data__orders'", "'id'", "o.o_orderkey", "r.id", f"orders o join {_REG} on r.k = o.o_custkey where r.status <> 'issued'"),
    ("'identifier.registry_reassignment'", "null", "null", "null", "concat('ns:C', cast(c_custkey as varchar))", "customer where c_custkey % 10 <> 0 and c_custkey % 7 = 0"),
    ("'identifier.registry_removed'", "''", "''", "null", "null", _ONE),
    ("'identifier.registry_missing'", "''", "''", "null", "null", _ONE),
    ("'identifier.registry_collision'", "''", "''", "null", "null", _ONE),
    ("'identifier.registry_layout'", "''", "''", "null", "null", _ONE)))
def validate_registry(spark, d):
    """The register against itself, its predecessor and the tables; a second one without its columns."""
    k = F.col("c_custkey")
    base = table_of(spark, d, "customer", "c_custkey")
    name = F.concat(F.lit("C"), text_of(k))
    status = F.when(k % 11 == 0, "retired").when(k % 11 == 1, "void").otherwise("issued")
    current = base.where(k % 10 != 0).select(F.lit("ns").alias("namespace"), name.alias("identifier"), F.concat(F.lit("E"), text_of(k)).alias("entity_reference"), status.alias("status"), k.alias("file_row"))
    # The first entry of an identifier counts: a later one changes nothing.
    later = current.where("identifier = 'C1'").select("namespace", "identifier", F.lit("").alias("entity_reference"), F.lit("issued").alias("status"), (F.col("file_row") + 1_000_000_000).alias("file_row"))
    before = base.select(F.lit("ns").alias("namespace"), name.alias("identifier"), F.concat(F.when(k % 7 == 0, "X").otherwise("E"), text_of(k)).alias("entity_reference"), k.alias("file_row"))
    orders = Table.of("data__orders", table_of(spark, d, "orders").select(F.col("o_orderkey").alias("source_row"), F.concat(F.lit("C"), text_of(F.col("o_custkey"))).alias("id")), key_field="id")
    found = Findings(spark)
    evidence.validate_registry(found, {"data__orders": orders}, current.union(later), before, {}, {"p": values.Profile("legacy", "ns")}, "p")
    evidence.validate_registry(found, {}, current.drop("status"), None, {}, {}, "")
    return _shown(found)


_KIN = "(select s_suppkey as c, (s_suppkey * 3) // 2 as p from supplier) s"


@query(_union(
    ("'lineage.unknown_entity'", "null", "null", "null", "concat('s:', cast(n as varchar))", f"(select c as n from {_KIN} union select p from {_KIN}) u where n not in (select s_suppkey from supplier where s_suppkey % 9 <> 0)"),
    ("'lineage.self_parent'", "''", "''", "null", "null", f"(select count(*) as n from {_KIN} where c = p) z where n > 0"),
    ("'lineage.cycle'", "''", "''", "null", "null", f"(select count(*) as n from {_KIN} where c = p) z where n > 0"),
    ("'lineage.missing'", "''", "''", "null", "null", _ONE),
    ("'lineage.layout'", "''", "''", "null", "null", _ONE),
    ("'identifier.alias_collision'", "null", "null", "null", "o_clerk", "(select o_orderpriority as o_clerk, count(distinct o_custkey % 2) as n from orders group by 1) a where n > 1"),
    ("'identifier.alias_layout'", "''", "''", "null", "null", _ONE)))
def validate_evidence(spark, d):
    """Lineage against itself and the register, aliases with several targets, and both without their columns."""
    k = F.col("s_suppkey")
    suppliers = table_of(spark, d, "supplier", "s_suppkey")
    lineage = suppliers.select(F.lit("s").alias("namespace"), text_of(k).alias("child_id"), text_of(F.floor(k * 3 / 2)).alias("parent_id"), F.when(k == 2, "").otherwise("part").alias("relationship"))
    register = suppliers.where(k % 9 != 0).select(F.lit("s").alias("namespace"), text_of(k).alias("identifier"))
    aliases = table_of(spark, d, "orders").select(F.lit("p").alias("provider"), F.col("o_orderpriority").alias("external_id"), F.lit("n").alias("namespace"), text_of(F.col("o_custkey") % 2).alias("identifier"))
    found = Findings(spark)
    evidence.validate_lineage(found, lineage, register)
    evidence.validate_lineage(found, lineage.drop("relationship"), None)
    evidence.validate_aliases(found, aliases)
    evidence.validate_aliases(found, aliases.drop("provider"))
    return _shown(found)


_SPOTS = "(select s_suppkey as k, case when s_suppkey % 8 = 0 then null else cast(s_suppkey % 120 as varchar) end as lat, case when s_suppkey % 12 = 0 then null else cast(s_suppkey % 200 as varchar) end as lon from supplier) s"


@query(_union(
    ("'coordinate.incomplete_pair'", "'data__spots'", "''", "k", "null", f"{_SPOTS} where (lat is null) <> (lon is null)"),
    ("'coordinate.required'", "'data__spots'", "''", "k", "null", f"{_SPOTS} where lat is null and lon is null"),
    ("'coordinate.invalid'", "'data__spots'", "'lat'", "k", "lat", f"{_SPOTS} where lon is not null and cast(lat as int) > 90"),
    ("'coordinate.invalid'", "'data__spots'", "'lon'", "k", "lon", f"{_SPOTS} where lat is not null and cast(lon as int) > 180"),
    ("'coordinate.expected_extent'", "'data__spots'", "''", "k", "null", f"{_SPOTS} where cast(lat as int) <= 90 and cast(lon as int) <= 180 and (cast(lat as int) > 60 or cast(lon as int) > 100)"),
    ("'coordinate.display_digits'", "'data__spots'", "''", "null", "null", _ONE), ("'coordinate.mapping_required'", "'data__plane'", "''", "null", "null", _ONE), ("'coordinate.ambiguous_fields'", "'data__two'", "''", "null", "null", _ONE),
    ("'coordinate.mapping_invalid'", "'data__same'", "''", "null", "null", _ONE), ("'coordinate.crs_unknown'", "'data__bare'", "''", "null", "null", _ONE), ("'coordinate.transform_dependency'", "'data__local'", "''", "null", "null", _ONE),
    ("'coordinate.projected_syntax'", "'data__local'", "''", "k", "null", "(select s_suppkey as k from supplier where s_suppkey % 4 = 1) s"),
    ("'coordinate.projected_syntax'", "'data__web'", "''", "k", "null", "(select s_suppkey as k from supplier where s_suppkey % 5 = 1) s"), ("'coordinate.transform_failed'", "'data__web'", "''", "k", "null", "(select s_suppkey as k from supplier where s_suppkey % 5 = 0) s")))
def validate_coordinates(spark, d):
    """All rules on pairs of coordinates and on their mappings."""
    k = F.col("s_suppkey")
    base = table_of(spark, d, "supplier", "s_suppkey")
    rows = lambda **columns: base.select(k.alias("source_row"), *[c.alias(n) for n, c in columns.items()])
    lat, lon = F.when(k % 8 != 0, text_of(k % 120)), F.when(k % 12 != 0, text_of(k % 200))
    easting = F.when(k % 4 == 1, "12 km").otherwise(text_of(k))
    frames = {"spots": rows(lat=lat, lon=lon), "plane": rows(easting=lat, northing=lon), "two": rows(lat=lat, latitude=lat, lon=lon), "same": rows(lat=lat, lon=lon), "bare": rows(lat=lat, lon=lon), "local": rows(a=easting, b=text_of(k)), "web": rows(a=text_of(k), b=F.when(k % 5 == 0, "99999999999").when(k % 5 == 1, "12 km").otherwise(text_of(k)))}
    tables = {f"data__{n}": Table.of(f"data__{n}", df) for n, df in frames.items()}
    mappings = {"data__spots": {"latitude": "lat", "longitude": "lon", "crs": "WGS84", "required": True, "bounds": [0, 0, 100, 60], "display_digits": 99}, "data__same": {"latitude": "lat", "longitude": "lat", "crs": "WGS84"}, "data__local": {"latitude": "a", "longitude": "b", "crs": "EPSG:2154"}, "data__web": {"latitude": "a", "longitude": "b", "crs": "EPSG:3857"}}
    found = Findings(spark)
    values.validate_coordinates(found, tables, mappings)
    return _shown(found)


_PLACES = "(select o_orderkey as k, case o_orderkey % 5 when 0 then 'guessed' when 1 then 'node_exact' when 2 then 'osm_fallback' when 3 then 'ambiguous' else 'unresolved' end as status, case when o_orderkey % 7 = 0 then null else o_orderstatus end as name, case when o_orderkey % 3 = 0 then 'way' else 'node' end as typ from orders) o"


@query(_union(
    ("'toponymy.status'", "'data__places'", "''", "k", "null", f"{_PLACES} where status = 'guessed'"),
    ("'toponymy.review'", "'data__places'", "''", "k", "null", f"{_PLACES} where status not in ('guessed', 'node_exact')"),
    ("'toponymy.reference'", "'data__places'", "''", "k", "null", f"{_PLACES} where status <> 'unresolved' and name is null"),
    ("'toponymy.node_status'", "'data__places'", "''", "k", "null", f"{_PLACES} where status = 'node_exact' and typ = 'way'"),
    ("'toponymy.mapping'", "'data__gone'", "''", "null", "null", _ONE), ("'toponymy.fields'", "'ref__region'", "''", "null", "null", _ONE)))
def validate_toponymy(spark, d):
    """All rules on stored place references and on their mappings."""
    k = F.col("o_orderkey")
    status = F.when(k % 5 == 0, "guessed").when(k % 5 == 1, "node_exact").when(k % 5 == 2, "osm_fallback").when(k % 5 == 3, "ambiguous").otherwise("unresolved")
    rows = table_of(spark, d, "orders").select(k.alias("source_row"), F.when(k % 7 != 0, F.col("o_orderstatus")).alias("title"), F.when(k % 3 == 0, "way").otherwise("node").alias("osm_type"), text_of(k).alias("osm_id"), status.alias("status"))
    tables = {"data__places": Table.of("data__places", rows), "ref__region": Table.of("ref__region", table_of(spark, d, "region", "r_name"), role="ref")}
    found = Findings(spark)
    values.validate_toponymy(found, tables, {"data__places": {"name": "title"}, "data__gone": {}, "ref__region": {"name": "r_name"}})
    return _shown(found)


def _cells(df: DataFrame, sheet: str, row: Column, columns: dict[str, Column], kind: Column | None = None, formula: Column | None = None, head: bool = True) -> DataFrame:
    """Cells of a sheet: a header in row 1, and a row of text cells for each row of df."""
    spark = df.sparkSession
    names = list(columns)
    entry = lambda c, v: F.struct(F.lit(c).alias("col"), v.cast("string").alias("value"))
    body = df.select(row.cast("int").alias("row"), (kind if kind is not None else F.lit("text")).alias("type"), (formula if formula is not None else F.lit(None)).cast("string").alias("formula"), F.explode(F.array(*[entry(i, c) for i, c in enumerate(columns.values(), 1)])).alias("c")).select("row", "c.col", "type", "c.value", "formula").where("value is not null or formula is not null")
    if head:
        body = body.union(spark.createDataFrame([(1, i, "text", n, None) for i, n in enumerate(names, 1)], "row int, col int, type string, value string, formula string"))
    return body.select(F.lit(sheet).alias("sheet"), "row", "col", sc.cell_ref("col", "row").alias("ref"), "type", "value", "formula")


@query(_union(
    ("'workbook.spacer_row'", "'data__nation'", "null", "n_nationkey + 2", "null", "nation where n_nationkey % 6 = 5 and n_nationkey < 24"),
    ("'workbook.raw_formula'", "'data__nation'", "'calc'", "n_nationkey + 2", "'=1'", "nation where n_nationkey % 8 = 2 and n_nationkey % 6 <> 5"),
    ("'workbook.raw_formula'", "'data__nation'", "'name'", "n_nationkey + 2", "'=1'", "nation where n_nationkey % 8 = 2 and n_nationkey % 6 <> 5"),
    ("'workbook.cell_error'", "'data__nation'", "'name'", "n_nationkey + 2", "n_name", "nation where n_nationkey % 8 = 3 and n_nationkey % 6 <> 5"),
    ("'workbook.cell_error'", "'data__nation'", "'calc'", "n_nationkey + 2", "case when n_nationkey % 4 = 0 then ' ' else 'x' end", "nation where n_nationkey % 8 = 3 and n_nationkey % 6 <> 5"),
    ("'workbook.whitespace_value'", "'data__nation'", "'calc'", "n_nationkey + 2", "' '", "nation where n_nationkey % 4 = 0 and n_nationkey % 6 <> 5"),
    ("'workbook.sheet_name'", "'Region'", "''", "null", "null", _ONE), ("'workbook.merged_cells'", "'data__nation'", "''", "null", "null", _ONE), ("'workbook.empty_sheet'", "'data__none'", "''", "null", "null", _ONE),
    ("'workbook.rectangle_limit'", "'data__far'", "''", "null", "null", _ONE), ("'workbook.headers'", "'data__twin'", "''", "1", "null", _ONE), ("'workbook.field_name'", "'data__bad'", "'Bad Name'", "1", "'Bad Name'", _ONE)))
def build_tables(spark, d):
    """All rules on the structure of sheets; cells of a calc__ column are exempt but for its header."""
    k = F.col("n_nationkey")
    nation = table_of(spark, d, "nation").where((k % 6 != 5) | (k == 24))
    kind = F.when(k % 8 == 3, "error").otherwise("text")
    formula = F.when(k % 8 == 2, "=1")
    body = _cells(nation, "data__nation", k + 2, {"name": F.col("n_name"), "calc": F.when(k % 4 == 0, " ").otherwise("x"), "calc__note": F.lit(" ")}, kind, formula)
    region = table_of(spark, d, "region")
    row = F.col("r_regionkey") + 2
    cells = body.union(_cells(region, "Region", row, {"a": F.col("r_name")})).union(_cells(region, "data__far", row * 1000, {"a": F.col("r_name")}))
    cells = cells.union(_cells(region, "data__twin", row, {"a": F.col("r_name"), "a ": F.lit("x")}).withColumn("value", F.when(F.col("row") == 1, "a").otherwise(F.col("value")))).union(_cells(region, "data__bad", row, {"Bad Name": F.col("r_name")}))
    found = Findings(spark)
    names = ["data__nation", "Region", "data__none", "data__far", "data__twin", "data__bad"]
    structure.build_tables(found, cells, [{"name": n, "merges": ["B2:C2"] if n == "data__nation" else []} for n in names], 1000)
    return _shown(found)


@query(_union(
    ("'metadata.duplicate_item'", "'meta__readme'", "''", "null", "null", _ONE),
    ("'metadata.required_item'", "'meta__readme'", "''", "null", "null", "(select unnest(range(6))) one"),
    ("'metadata.table_duplicates'", "'meta__tables'", "''", "null", "null", _ONE),
    ("'metadata.unknown_table'", "'meta__tables'", "''", "null", "concat('data__', lower(replace(n_name, ' ', '_')))", "(select distinct n_name from nation where n_nationkey > 0 and n_nationkey < 5) n"),
    ("'metadata.key_declaration'", "'data__region'", "''", "null", "null", _ONE),
    ("'metadata.key_declaration'", "'ref__part'", "''", "null", "null", _ONE),
    ("'metadata.entity_notes'", "'data__nation'", "''", "null", "null", _ONE),
    ("'metadata.fields_duplicates'", "'meta__fields'", "''", "null", "null", _ONE),
    ("'metadata.unknown_field'", "'meta__fields'", "''", "n_nationkey + 2", "concat('data__nation', chr(13), lower(replace(n_name, ' ', '_')))", "nation where n_nationkey < 5"),
    ("'metadata.required_sheet'", "'meta__readme'", "''", "null", "null", _ONE), ("'metadata.required_sheet'", "'meta__tables'", "''", "null", "null", _ONE), ("'metadata.readme_fields'", "'meta__readme'", "''", "null", "null", _ONE),
    ("'metadata.required_item'", "'meta__readme'", "''", "null", "null", "(select unnest(range(6))) one"), ("'metadata.tables_fields'", "'meta__tables'", "''", "null", "null", _ONE), ("'metadata.fields_layout'", "'meta__fields'", "''", "null", "null", _ONE),
    ("'metadata.source_identity'", "'meta__readme'", "''", "null", "'other'", _ONE), ("'metadata.contract_version'", "'meta__readme'", "''", "null", "null", _ONE), ("'metadata.invalid_json'", "'meta__readme'", "''", "null", "'{'", _ONE),
    ("'metadata.required_item'", "'meta__readme'", "''", "null", "null", "(select unnest(range(4))) one")))
def read_metadata(spark, d):
    """All rules on metadata sheets, over three workbooks: faulty declarations, absent columns, wrong items."""
    k = F.col("n_nationkey")
    nation, region = table_of(spark, d, "nation"), table_of(spark, d, "region")
    few = nation.where("n_nationkey < 5")
    slug = F.lower(F.replace(F.col("n_name"), F.lit(" "), F.lit("_")))
    found = Findings(spark)

    def book(*sheets: DataFrame, names: list[str]) -> dict[str, Table]:
        cells = sheets[0]
        for s in sheets[1:]:
            cells = cells.union(s)
        return structure.build_tables(Findings(spark), cells, [{"name": n, "merges": []} for n in names])

    data = _cells(nation, "data__nation", k + 2, {"key": text_of(k), "name": F.col("n_name")})
    plain = _cells(region, "data__region", F.col("r_regionkey") + 2, {"name": F.col("r_name")})
    part = _cells(region, "ref__part", F.col("r_regionkey") + 2, {"name": F.col("r_name")})
    first = k == 0
    tables = book(
        data, plain, part, _cells(few, "meta__readme", k + 2, {"item": F.lit("purpose"), "value": F.lit("x")}),
        _cells(few.union(few.where(first).select(F.lit(5), "n_name", "n_regionkey")).union(few.where(first).select(F.lit(6), "n_name", "n_regionkey")).union(few.where(first).select(F.lit(7), "n_name", "n_regionkey")), "meta__tables", k + 2, {
            "sheet_name": F.when(k == 0, "data__nation").when(k >= 6, "data__region").when(k == 5, "ref__part").otherwise(F.concat(F.lit("data__"), slug)), "key_field": F.when(k == 5, "absent").otherwise("key"), "key_scope": F.lit("entity"), "record_unit": F.lit("x")}),
        _cells(few.union(few.where(first).select(F.lit(5), "n_name", "n_regionkey")).union(few.where(first).select(F.lit(6), "n_name", "n_regionkey")), "meta__fields", k + 2, {"sheet_name": F.lit("data__nation"), "field_name": F.when(k >= 5, "name").otherwise(slug)}),
        names=["data__nation", "data__region", "ref__part", "meta__readme", "meta__tables", "meta__fields"])
    structure.read_metadata(found, tables, "s")
    tables = book(_cells(few, "meta__fields", k + 2, {"nothing": slug}), names=["meta__fields"])
    structure.read_metadata(found, tables, "s")
    items = region.select("r_regionkey", F.when(F.col("r_regionkey") == 0, "workbook_id").when(F.col("r_regionkey") == 1, "contract_version").when(F.col("r_regionkey") == 2, "identifier_profiles").otherwise(F.concat(F.lit("note_"), text_of(F.col("r_regionkey")))).alias("item"))
    value = F.when(F.col("r_regionkey") == 0, "other").when(F.col("r_regionkey") == 1, "1").otherwise("{")
    keys = _cells(region.limit(0), "meta__tables", F.lit(2), {"sheet_name": F.lit("x"), "key_field": F.lit("x"), "key_scope": F.lit("x"), "record_unit": F.lit("x")})
    tables = book(_cells(items, "meta__readme", F.col("r_regionkey") + 2, {"item": F.col("item"), "value": value}), keys, names=["meta__readme", "meta__tables"])
    read, _ = structure.read_metadata(found, tables, "s")
    structure.identifier_profiles(found, read)
    return _shown(found)


@query("select rule_id, n, errors, to_act_on from (select 'a' as rule_id, (select count(*) from lineitem where l_discount > 0.08) as n, (select count(*) from lineitem where l_discount > 0.08) > 0 as errors, (select count(*) from lineitem where l_discount > 0.08) as to_act_on union all select 'b', (select count(*) from orders where o_totalprice > 400000), false, (select count(*) from orders where o_totalprice > 400000) union all select 'c', (select count(*) from customer where c_acctbal < 0), false, 0) t where n > 0")
def corrections(spark, d):
    """Findings by rule, whether any is an error, and how many are to be acted on: errors and those with a proposal."""
    found = Findings(spark)
    for rule_id, severity, name, column, when, action in (("a", ERROR, "lineitem", "l_discount", F.col("l_discount").cast("double") > 0.08, ""), ("b", "warning", "orders", "o_totalprice", F.col("o_totalprice").cast("double") > 400000, "look"), ("c", "information", "customer", "c_acctbal", F.col("c_acctbal").cast("double") < 0, "")):
        found.evaluate(Table.of(name, table_of(spark, d, name, column)), [findings.Rule(rule_id, severity, when, "", column, action=action)])
    every = found.findings()
    acted = findings.corrections(every).groupBy("rule_id").agg(F.count(F.lit(1)).alias("to_act_on"))
    by_rule = every.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("severity") == ERROR).alias("errors"))
    return by_rule.join(acted, "rule_id", "left").select("rule_id", "n", "errors", F.coalesce("to_act_on", F.lit(0)).alias("to_act_on"))


@query("select s_suppkey, cast(2 + (case when s_suppkey % 4 <> 0 then 1 else 0 end) + (case when s_suppkey % 3 <> 0 then 1 else 0 end) as bigint) as names from supplier")
def settlement_names(spark, d):
    """How many different names a looked-up place has: its own, its address's settlements, the details of its name."""
    k = F.col("s_suppkey")
    address = F.create_map(F.lit("village"), F.lit(" V "), F.lit("town"), F.when(k % 3 == 0, "V").otherwise("T"), F.lit("country"), F.lit("no settlement"))
    names = toponyms.settlement_names(F.when(k % 4 != 0, F.col("s_name")), address, F.create_map(F.lit("alt"), F.concat(F.lit("alt "), "s_name")))
    return table_of(spark, d, "supplier").select("s_suppkey", F.size(names).cast("long").alias("names"))


@query("select o_orderkey, coalesce(a, b, 'none') as shown from (select o_orderkey, case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then null else o_orderstatus end as a, case when o_orderkey % 5 = 0 then null else o_orderpriority end as b from orders) t")
def first_nonempty(spark, d):
    """The first value with more than white space."""
    k = F.col("o_orderkey")
    a = F.when(k % 3 == 0, None).when(k % 3 == 1, " \t").otherwise(F.col("o_orderstatus"))
    return table_of(spark, d, "orders").select("o_orderkey", sc.first_nonempty(a, F.when(k % 5 != 0, F.col("o_orderpriority")), F.lit("none")).alias("shown"))


@query("select p_partkey, regexp_replace(concat(p_name, '/', p_brand), '[^A-Za-z0-9_.-]', '_', 'g') as file, regexp_matches(p_type, '^[A-Z]+ .*(TIN|STEEL)$') as metal, false as broken from part")
def patterns(spark, d):
    """Names of files, a pattern of the metadata, and one that can't be compiled."""
    return table_of(spark, d, "part").select("p_partkey", sc.safe_file_name(F.concat("p_name", F.lit("/"), "p_brand")).alias("file"), sc.matches("p_type", "^[A-Z]+ .*(TIN|STEEL)$").alias("metal"), sc.matches("p_type", "(").alias("broken"))


@query("select n_nationkey, n_nationkey <= 12 as known from nation")
def time_zones(spark, d):
    """Whether time zones exist: Etc/GMT+0 to +12 do."""
    name = F.concat(F.lit("Etc/GMT+"), text_of(F.col("n_nationkey")))
    return table_of(spark, d, "nation").select("n_nationkey", name.isin(*[z for z in sc.time_zones() if z.startswith("Etc/")]).alias("known"))


@query("select s_suppkey, s_suppkey % 2 = 0 and s_suppkey % 3 <> 0 as is_node from supplier")
def place_node(spark, d):
    k = F.col("s_suppkey")
    return table_of(spark, d, "supplier").select("s_suppkey", toponyms.is_place_node(F.when(k % 2 == 0, "node").when(k % 5 != 0, "way"), F.when(k % 3 != 0, "place")).alias("is_node"))


@query("select c_custkey as id from customer where c_custkey % 200 - 100 not between -90 and 90 or c_custkey % 7 = 0")
def out_of_range(spark, d):
    """Points that stop a batch."""
    k = F.col("c_custkey")
    return toponyms.out_of_range(table_of(spark, d, "customer").select(k.alias("id"), (k % 200 - 100).alias("latitude"), F.when(k % 7 != 0, k % 170).alias("longitude"))).select("id")


@query("select sheet, sha256(concat_ws(':', cast(count(*) as varchar), cast(sum(cast(concat('0x', substr(h, 1, 15)) as hugeint)) as varchar), cast(sum(cast(concat('0x', substr(h, 16, 15)) as hugeint)) as varchar), cast(sum(cast(concat('0x', substr(h, 31, 15)) as hugeint)) as varchar), cast(sum(cast(concat('0x', substr(h, 46, 15)) as hugeint)) as varchar))) as digest from (select l_returnflag as sheet, sha256(concat('{\"row\":', l_orderkey, ',\"col\":', l_linenumber, ',\"type\":\"text\",\"value\":\"', l_linestatus, '\"}')) as h from lineitem) t group by sheet")
def content_digests(spark, d):
    """Digests of the cells of sheets, whatever the order of their rows."""
    cells = table_of(spark, d, "lineitem").select(F.col("l_returnflag").alias("sheet"), F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("col"), F.lit("text").alias("type"), F.col("l_linestatus").alias("value"))
    return snapshots.sheet_digests(cells.repartition(5))


@query("select l_returnflag as sheet, count(*) as cells from lineitem where l_linenumber % 3 <> 0 or l_orderkey % 4 = 0 group by 1")
def occupied_cells(spark, d):
    """Cells with a value or a formula."""
    n = F.col("l_linenumber")
    cells = table_of(spark, d, "lineitem").select(F.col("l_returnflag").alias("sheet"), F.when(n % 3 != 0, text_of(n)).alias("value"), F.when(F.col("l_orderkey") % 4 == 0, "=1").alias("formula"))
    return structure.occupied(cells).groupBy("sheet").agg(F.count(F.lit(1)).alias("cells"))


_LOOKUPS = "select id, (spot % 180) / 2.0 - 45 as lat, spot / 2.0 - 90 as lon, spot, spot % 3 as nm, spot % 4 <> 0 as looked, spot % 5 = 0 as direct from (select c_custkey as id, c_custkey % 360 as spot from customer) c"
_TAGGED = "select s_suppkey as id, (s_suppkey * 3 % 180) / 2.0 - 45 as lat, (s_suppkey * 3 % 360) / 2.0 - 90 as lon, s_nationkey % 3 as nm from supplier where s_suppkey % 6 <> 0"
_HITS = f"""select pid, nid, hit, round(2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a)), 1) as d from (select p.id as pid, n.id as nid, p.nm = n.nm as hit, power(sin(radians(n.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(n.lat)) * power(sin(radians(n.lon - p.lon) / 2), 2) as a
 from ({_LOOKUPS}) p join ({_TAGGED}) n on abs(p.lat - n.lat) <= 3 where p.looked and not p.direct) x where 2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a)) <= 300000"""


@query(f"""
with p as ({_LOOKUPS}), h as ({_HITS}), m as (select pid, sum(case when hit then 1 else 0 end) as matches, count(*) as near, min(case when hit then nid end) as one, min(case when hit then d end) as dist, min(d) as least from h group by pid)
select p.id, case when not looked then 'unresolved' when direct or coalesce(matches, 0) = 1 then 'node_exact' when matches > 1 then 'ambiguous' else 'osm_fallback' end as status,
    case when not looked then 'failed' when direct then 'nominatim_place_node' when coalesce(matches, 0) = 1 then 'nominatim_reverse_then_place_node' when matches > 1 then 'nominatim_reverse_ambiguous_place_nodes' else 'nominatim_reverse_fallback' end as method,
    case when not looked then null when not direct and matches = 1 then concat('Tëwn ', cast(nm as varchar)) else concat('town ', cast(nm as varchar)) end as name, case when not looked then null when not direct and matches = 1 then one else spot end as osm_id,
    case when not looked or direct then 0 else cast(case when matches > 0 then matches else coalesce(near, 0) end as bigint) end as candidates, case when looked and not direct and matches = 1 then dist when looked and direct then 0.0 end as distance_m,
    case when looked and not direct then coalesce(dist, least) end as nearest_m
from p left join m on m.pid = p.id""")
def resolve_toponyms(spark, d):
    """Points to places end to end: rounded keys, place nodes within 300 km by name, one match or none."""
    def spot(key: str, factor: int) -> tuple[Column, Column]:
        k = F.col(key)
        return (k * factor % 180) / 2 - 45, (k * factor % 360) / 2 - 90

    k = F.col("c_custkey")
    lat, lon = spot("c_custkey", 1)
    customers = table_of(spark, d, "customer")
    points = customers.select(k.alias("position"), k.alias("id"), lat.alias("latitude"), lon.alias("longitude"))
    # What a lookup says depends on the place alone, as points that share it share its key.
    place = k % 360
    town = F.concat(F.lit("town "), text_of(place % 3))
    reverse = customers.where(place % 4 != 0).select(sc.cache_key(lat, lon).alias("key"), town.alias("name"), F.when(place % 5 == 0, "node").otherwise("way").alias("osm_type"), text_of(place).alias("osm_id"), text_of(lat).alias("lat"), text_of(lon).alias("lon"), F.when(place % 5 == 0, "place").otherwise("highway").alias("category"), F.lit("x").alias("type"), F.create_map(F.lit("country"), F.lit("c")).alias("address"), F.lit(None).cast("map<string,string>").alias("namedetails"))
    n = F.col("s_suppkey")
    node_lat, node_lon = spot("s_suppkey", 3)
    tags = F.create_map(F.lit("name"), F.concat(F.lit("Tëwn "), text_of(F.col("s_nationkey") % 3)), F.lit("alt_name"), F.concat(F.lit("y;TOWN-"), text_of(F.col("s_nationkey") % 3)), F.lit("place"), F.lit("town"))
    nodes = table_of(spark, d, "supplier").where(n % 6 != 0).select(n.alias("id"), node_lat.alias("lat"), node_lon.alias("lon"), tags.alias("tags"))
    done = toponyms.resolve(points, reverse, nodes, 300_000.0)
    return done.select(F.col("id").cast("long").alias("id"), "status", F.col("resolution_method").alias("method"), "name", F.col("osm_id").cast("long").alias("osm_id"), F.size("candidates").cast("long").alias("candidates"), "distance_m", F.get("candidates", F.lit(0))["distance_m"].alias("nearest_m"))


@query("select cast(row_number() over (order by n_nationkey) as bigint) as file_row, cast(n_nationkey as varchar) as k, concat('a \"', n_name, '\", b', chr(10), 'c') as t, case when n_nationkey % 4 = 0 then '\\N' else '' end as e from nation")
def csv_round_trip(spark, d):
    """A table as CSV parts, read back: quotes, line feeds, empty text and the token for missing values; rows keep their numbers."""
    from ..sources.durable import shared_folder
    from ..sources.tables import read_external_csv
    from . import sinks

    k = F.col("n_nationkey")
    rows = table_of(spark, d, "nation").select(k.alias("k"), F.concat(F.lit('a "'), "n_name", F.lit('", b\nc')).alias("t"), F.when(k % 4 != 0, "").alias("e"))
    path = f"{shared_folder(spark)}/assayer/{uuid.uuid4().hex}"
    sinks.write_csv_folder(rows.orderBy("k").coalesce(1), path, None)
    return read_external_csv(spark, path).select("file_row", "k", "t", "e")


def _xlsx(names: list[str]) -> bytes:
    """A workbook with a row for each name: shared text, a day counted from 1904, rich text with a reading aid, a truth value and a formula."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    rows = "".join(f'<row r="{i}"><c r="A{i}" t="s"><v>{i - 1}</v></c><c r="B{i}" s="1"><v>{i}</v></c><c r="C{i}" t="inlineStr"><is><r><t>n</t></r><r><t>o</t></r><rPh><t>x</t></rPh></is></c><c r="D{i}" t="b"><v>{i % 2}</v></c><c r="E{i}"><f>1+1</f><v>2</v></c></row>' for i in range(1, len(names) + 1))
    members = {
        "xl/workbook.xml": f'<workbook {main}><workbookPr date1904="1"/><sheets><sheet name="data__n" sheetId="1" r:id="a"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>', "xl/worksheets/s.xml": f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>",
        "xl/styles.xml": f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>', "xl/sharedStrings.xml": f"<sst {main}>" + "".join(f"<si><t>{n}</t></si>" for n in names) + "</sst>",
    }
    return _zipped(members)


def _ods(names: list[str]) -> bytes:
    """The like as ODS: text of two paragraphs with blanks and a tab, a day, a duration, and a repeated number before a large empty area."""
    ns = " ".join(f'xmlns:{p}="urn:oasis:names:tc:opendocument:xmlns:{p}:1.0"' for p in ("office", "table", "text"))
    rows = "".join(f'<table:table-row><table:table-cell office:value-type="string"><text:p>{n}<text:s text:c="2"/><text:tab/>x</text:p><text:p>y</text:p></table:table-cell><table:table-cell office:value-type="date" office:date-value="1904-01-{i + 1:02}"/><table:table-cell office:value-type="time" office:time-value="PT1H"/><table:table-cell table:number-columns-repeated="2" office:value-type="float" office:value="{i}"/><table:table-cell table:number-columns-repeated="9000"/></table:table-row>' for i, n in enumerate(names, 1))
    return _zipped({"content.xml": f'<office:document-content {ns}><office:body><office:spreadsheet><table:table table:name="data__n">{rows}<table:table-row table:number-rows-repeated="900000"><table:table-cell/></table:table-row></table:table></office:spreadsheet></office:body></office:document-content>'})


def _zipped(members: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return out.getvalue()


_NATIONS = "(select n_regionkey, n_name, row_number() over (partition by n_regionkey order by n_name) as i from nation) n"


@query(f"""
with x as (select concat(n_regionkey, '.xlsx') as path, n_name, i from {_NATIONS}), o as (select concat(n_regionkey, '.ods') as path, n_name, i from {_NATIONS})
select path, i as "row", 1 as col, 'text' as type, n_name as value, null as formula from x union all select path, i, 2, 'date', cast(date '1904-01-01' + cast(i as int) as varchar), null from x union all select path, i, 3, 'text', 'no', null from x
union all select path, i, 4, 'boolean', case when i % 2 = 1 then 'TRUE' else 'FALSE' end, null from x union all select path, i, 5, 'number', '2', '1+1' from x
union all select path, i, 1, 'text', concat(n_name, '  ', chr(9), 'x', chr(10), 'y'), null from o union all select path, i, 2, 'date', cast(date '1904-01-01' + cast(i as int) as varchar), null from o union all select path, i, 3, 'duration', 'PT1H', null from o
union all select path, i, 4, 'number', cast(i as varchar), null from o union all select path, i, 5, 'number', cast(i as varchar), null from o""")
def workbook_cells(spark, d):
    """Cells of an XLSX and an ODS workbook for each region, packed and read on the executors."""
    from ..sources.workbook import cells_of

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = [(f"{r['k']}.{form}", pack(r["names"])) for r in batch.to_pylist() for form, pack in (("xlsx", _xlsx), ("ods", _ods))]
            if files:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files]), pa.array([f[1] for f in files], pa.binary())], ["path", "content"])

    names = table_of(spark, d, "nation").groupBy(F.col("n_regionkey").alias("k")).agg(F.sort_array(F.collect_list("n_name")).alias("names"))
    cells = cells_of(names.mapInArrow(packed, "path string, content binary"))
    return cells.select("path", F.col("row").cast("long").alias("row"), "col", "type", "value", "formula")


@query("select path, format, date_system, 'data__n' as sheet, 1 as sheet_index, 0 as merges from (select concat(n_regionkey, '.xlsx') as path, 'xlsx' as format, '1904' as date_system from nation union select concat(n_regionkey, '.ods'), 'ods', 'ISO typed values' from nation) t")
def workbook_sheets(spark, d):
    """Sheets of the same workbooks."""
    from ..sources.workbook import sheets_of

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([f"{r['k']}.xlsx", f"{r['k']}.ods"]), pa.array([_xlsx(r["names"]), _ods(r["names"])], pa.binary())], ["path", "content"])

    names = table_of(spark, d, "nation").groupBy(F.col("n_regionkey").alias("k")).agg(F.sort_array(F.collect_list("n_name")).alias("names"))
    return sheets_of(names.mapInArrow(packed, "path string, content binary")).select("path", "format", "date_system", "sheet", "sheet_index", F.size("merges").alias("merges"))


def _nation_book(folder: Path, rows: list[tuple[str, ...]], head: tuple[str, ...], more: dict[str, str] | None = None) -> Path:
    """An ODS workbook of the rows with the metadata that a run asks for."""
    items = {"workbook_id": "nations", "purpose": "p", "curator": "c", "source_reference": "s", "contract_version": structure.CONTRACT, "locale": "en", "default_identifier_profile": "n", "identifier_profiles": json.dumps({"n": {"type": "external", "namespace": "n", "pattern": "^n_[0-9]+$"}}), **(more or {})}
    grids = {"meta__readme": [("item", "value"), *items.items()], "meta__tables": [("sheet_name", "key_field", "key_scope", "record_unit"), ("data__nations", "id", "row", "nation")], "data__nations": [head, *rows]}
    ns = " ".join(f'xmlns:{p}="urn:oasis:names:tc:opendocument:xmlns:{p}:1.0"' for p in ("office", "table", "text"))
    escaped = lambda x: x.replace("&", "&amp;").replace("<", "&lt;")
    cell = lambda x: f'<table:table-cell office:value-type="string"><text:p>{escaped(x)}</text:p></table:table-cell>'
    body = "".join(f'<table:table table:name="{s}">' + "".join(f"<table:table-row>{''.join(map(cell, r))}</table:table-row>" for r in rows) + "</table:table>" for s, rows in grids.items())
    folder.mkdir(parents=True)
    path = folder / "book.ods"
    path.write_bytes(_zipped({"content.xml": f"<office:document-content {ns}><office:body><office:spreadsheet>{body}</office:spreadsheet></office:body></office:document-content>"}))
    return path


def _own_folder(spark) -> Path:
    from ..sources.durable import shared_folder

    return Path(urlparse(shared_folder(spark)).path) / "assayer" / uuid.uuid4().hex


@query("select concat('n_', n_nationkey) as sheet, n_name as name from nation where n_nationkey % 2 = 0 union all select 'kept', 'yes'")
def publish_run(spark, d):
    """A whole run over a workbook of the nations in a folder of its own: what it publishes, read back, and whether the run was published."""
    from . import run, sinks

    rows = [(f"n_{r['n_nationkey']}", r["n_name"]) for r in table_of(spark, d, "nation").where("n_nationkey % 2 = 0").orderBy("n_nationkey").collect()]
    folder = _own_folder(spark)
    try:
        done = run.Run(spark, str(_nation_book(folder, rows, ("id", "name"))), str(folder / "state"), "nations").run()
        kept = sinks.read_json(folder / "state" / "nations" / "current.json")
        with open(f"{done['run_dir']}/original/data__nations.csv", newline="", encoding="utf-8") as f:
            rows = [(r["id"], r["name"]) for r in csv.DictReader(f)]
        return spark.createDataFrame([*rows, ("kept", "yes" if kept and kept["run_id"] == done["run_id"] else "no")], "sheet string, name string")
    finally:
        shutil.rmtree(folder, ignore_errors=True)


@query("""
select 'token' as run, 'serialization.missing_collision' as rule_id, 'error' as severity, 1 as n union all select 'broken', 'pipeline.failure', 'error', 1 union all select 'required', 'publication.required_coverage', 'error', 1
union all select 'places', 'toponymy.enrichment_failure', 'error', 1 union all select 'places', 'toponymy.enrichment_review', 'warning', 1
union all select 'register', 'identifier.unregistered', 'error', cast(count(*) as bigint) from nation where n_nationkey % 2 = 1 union all select 'register', 'identifier.retired_reference', 'information', count(*) from nation where n_nationkey % 6 = 4""")
def refused_runs(spark, d):
    """Findings of runs that aren't published: a value that is the token for missing ones, a file that is no workbook, a check that must be made, places
    that can't be found, identifiers that a register file lacks or has as retired."""
    from . import run

    nations = table_of(spark, d, "nation").orderBy("n_nationkey").collect()
    plain = [(f"n_{r['n_nationkey']}", r["n_name"]) for r in nations]
    placed = [(*p, f"{k}.5", f"{2 * k}.25") for k, p in enumerate(plain)]
    address = "address map<string,string>, namedetails map<string,string>"
    reverse = spark.createDataFrame([(f"{k}.5000000_{2 * k}.2500000", "road", "way", "1", "0", "0", "highway", "x", {}, {}) for k in range(0, len(placed), 2)], f"key string, name string, osm_type string, osm_id string, lat string, lon string, category string, type string, {address}")
    nodes = spark.createDataFrame([], "id long, lat double, lon double, tags map<string,string>")
    cases = {
        "token": (plain, {}, {"missing_token": plain[3][1]}, None), "broken": (plain, {}, {}, None), "required": (plain, {}, {"required_assessments": ["lineage"]}, None),
        "places": (placed, {"coordinate_crs": "WGS84"}, {"enrich_toponyms": True}, (reverse, nodes)), "register": (plain, {}, {"references": {"registry": {"path": "register.csv"}}}, None),
    }
    folder, found = _own_folder(spark), []
    try:
        for name, (rows, items, config, lookups) in cases.items():
            book = _nation_book(folder / name, rows, ("id", "name", "latitude", "longitude")[: len(rows[0])], items)
            if name == "broken":
                book.write_bytes(b"no archive")
            if name == "register":
                (folder / name / "register.csv").write_text("namespace,identifier,entity_reference,status\n" + "".join(f"n,n_{k},e,{'retired' if k % 6 == 4 else 'issued'}\n" for k in range(0, len(rows), 2)))
            done = run.Run(spark, str(book), str(folder / name / "state"), "nations", config, str(folder / name), "all", None, lookups).run()
            counts = spark.read.schema(findings.FINDING).json(Path(done["run_dir"], "findings").as_uri()).groupBy("rule_id", "severity").count().collect()
            found += [(name, r["rule_id"], r["severity"], r["count"]) for r in counts]
            if (folder / name / "state" / "nations" / "current.json").exists():
                found.append((name, "published", "", 1))
        return spark.createDataFrame(found, "run string, rule_id string, severity string, n long")
    finally:
        shutil.rmtree(folder, ignore_errors=True)


@query("""
select cast(n_nationkey as varchar) as id, case when n_nationkey % 5 = 0 or n_nationkey = 24 then 'unresolved' when n_nationkey % 2 = 0 or n_nationkey % 3 = 0 then 'node_exact' else 'osm_fallback' end as status,
    case when n_nationkey % 5 = 0 or n_nationkey = 24 then null when n_nationkey % 2 = 1 and n_nationkey % 3 = 0 then concat('V-', n_nationkey) else n_name end as name, cast(20 + n_nationkey as double) as longitude from nation""")
def cached_places(spark, d):
    """A batch of points from a CSV file and cached JSON answers, one of which is broken, to GeoJSON, read back."""
    from . import run

    nations = table_of(spark, d, "nation").orderBy("n_nationkey").collect()
    folder = _own_folder(spark)
    try:
        for sub in ("reverse", "nodes"):
            (folder / sub).mkdir(parents=True)
        lines = ["id,latitude,longitude"]
        for r in nations:
            k = r["n_nationkey"]
            lines.append(f"{k},{10 + k}.0,{20 + k}.0")
            key = f"{10 + k}.0000000_{20 + k}.0000000"
            kind = {"osm_type": "node", "category": "place", "type": "village"} if k % 2 == 0 else {"osm_type": "way", "category": "highway", "type": "road"}
            answer = json.dumps({"name": r["n_name"], "osm_id": k, "lat": f"{10 + k}", "lon": f"{20 + k}", "address": {"village": f"v {k}"}, **kind})
            if k % 5:
                (folder / "reverse" / f"{key}_zoom15.json").write_text(answer[:9] if k == 24 else answer)
            if k % 3 == 0:
                (folder / "nodes" / f"{key}_r5000.json").write_text(json.dumps({"elements": [{"id": 100 + k, "lat": 10.01 + k, "lon": 20.0 + k, "tags": {"name": f"V-{k}", "place": "village"}}]}))
        (folder / "points.csv").write_text("\n".join(lines) + "\n")
        run.resolve_batch(spark, (folder / "points.csv").as_uri(), (folder / "reverse").as_uri(), (folder / "nodes").as_uri(), str(folder / "places.geojson"))
        made = json.loads((folder / "places.geojson").read_text())["features"]
        rows = [(f["properties"]["id"], f["properties"]["status"], f["properties"].get("name"), f["geometry"]["coordinates"][0]) for f in made]
        return spark.createDataFrame(rows, "id string, status string, name string, longitude double")
    finally:
        shutil.rmtree(folder, ignore_errors=True)


_GRID = "(select s_suppkey as k, cast(100000 + s_suppkey * 797 % 800000 as double) as x, cast(s_suppkey * 9973 % 9300000 as double) as y from supplier) g"
_N = 1 / 298.257223563 / (2 - 1 / 298.257223563)
_M = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64) * 0.9996
_B, _D = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480), (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


@query(f"""
with p as (select k, x, y, y / {_M!r} as a, (x - 500000) / {_M!r} as b from {_GRID}),
q as (select k, x, y, a - {_B[0]!r} * sin(2 * a) * cosh(2 * b) - {_B[1]!r} * sin(4 * a) * cosh(4 * b) - {_B[2]!r} * sin(6 * a) * cosh(6 * b) as a, b - {_B[0]!r} * cos(2 * a) * sinh(2 * b) - {_B[1]!r} * cos(4 * a) * sinh(4 * b) - {_B[2]!r} * cos(6 * a) * sinh(6 * b) as b from p),
r as (select k, x, y, asin(sin(a) / cosh(b)) as chi, atan2(sinh(b), cos(a)) as turn from q)
select k, round(degrees(chi + {_D[0]!r} * sin(2 * chi) + {_D[1]!r} * sin(4 * chi) + {_D[2]!r} * sin(6 * chi)), 7) as lat, round(degrees(turn) + 3, 7) as lon,
    round(degrees(2 * atan(exp((x - 5e5) / 6378137.0)) - pi() / 2), 7) as mercator_lat, case when abs(degrees(y * 4 / 6378137.0)) > 180 then 'transform_failed' else 'converted' end as far from r""")
def projected_coordinates(spark, d):
    """Plane coordinates (UTM zone 31 north, the web's Mercator grid) in degrees, and those that lie nowhere."""
    k = F.col("s_suppkey")
    x, y = (k * 797 % 800_000 + 100_000).cast("double"), (k * 9973 % 9_300_000).cast("double")
    rows = table_of(spark, d, "supplier").select(k.alias("source_row"), text_of(k).alias("k"), F.format_string("%.1f", x).alias("x"), F.format_string("%.1f", y).alias("y"), F.format_string("%.1f", x - 500_000).alias("north"), F.format_string("%.1f", y * 4).alias("far"))
    derived = lambda lat, lon, crs: values.derive_coordinates(Table.of("data__grid", rows, key_field="k"), values.Mapping(lat, lon, crs))
    utm = derived("y", "x", "EPSG:32631").select("source_id", F.round("latitude_dd", 7).alias("lat"), F.round("longitude_dd", 7).alias("lon"))
    web = derived("north", "x", "EPSG:3857").select("source_id", F.round("latitude_dd", 7).alias("mercator_lat"))
    far = derived("north", "far", "EPSG:3857").select("source_id", F.when(F.col("_a") != "", F.col("_a")).otherwise(F.col("status")).alias("far"))
    return utm.join(web, "source_id").join(far, "source_id").select(F.col("source_id").cast("long").alias("k"), "lat", "lon", "mercator_lat", "far")
