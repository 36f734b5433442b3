"""Queries that apply the engine's operators to the star-schema tables, and DuckDB SQL for the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geography as geo
from ..functions import scalars as sc
from ..functions.spreadsheet import excel_temporal
from ..operators import evidence, snapshots, structure, toponyms, values
from ..operators.findings import ERROR, INFORMATION, WARNING, Rule, Table, evaluate, incomplete_checks, severity_counts
from . import registry
from .registry import Query, query
from .registry import table_of as _t
from .registry import text_of as _text

@query("select l_orderkey, l_linenumber, 'value.bound' as rule_id, l_discount as original_value from lineitem where l_discount < 0.02 or l_discount > 0.08")
def value_bound(spark, d):
    rule = values.FieldRule(type="number", minimum="0.02", maximum="0.08")
    rows = _t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount").withColumn("source_row", F.lit(0))
    table = Table.of("lineitem", rows, {"l_discount": "number"})
    bounds = [r for r in values.value_rules(table, "l_discount", rule, None, None) if r.rule_id == "value.bound"]
    hits = reduce(lambda a, b: a | b, [r.when for r in bounds])
    out = table.frame.where(hits)
    return out.select(F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("int"), F.lit("value.bound").alias("rule_id"), F.col("l_discount").cast("double").alias("original_value"))


@query("select o.o_orderkey, o.o_orderpriority from orders o left join (values ('1-URGENT'), ('2-HIGH')) v(code) on o.o_orderpriority = v.code where v.code is null")
def controlled_code(spark, d):
    codes = spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "code string")
    return values.outside_vocabulary(_t(spark, d, "orders", "o_orderkey", "o_orderpriority"), "o_orderpriority", codes, "code").select("o_orderkey", "o_orderpriority")


@query("select severity, count(*) as n from (select 'error' as severity from lineitem where l_discount > 0.08 union all select 'warning' from orders where o_totalprice > 400000 union all select 'information' from customer where c_mktsegment = 'FURNITURE') f group by severity")
def severity_histogram(spark, d):
    parts = [
        ("lineitem", "l_discount", Rule("value.bound", ERROR, F.col("l_discount").cast("double") > 0.08, "", "l_discount")),
        ("orders", "o_totalprice", Rule("value.review", WARNING, F.col("o_totalprice").cast("double") > 400000, "", "o_totalprice")),
        ("customer", "c_mktsegment", Rule("value.legacy_missing_code", INFORMATION, F.col("c_mktsegment") == "FURNITURE", "", "c_mktsegment")),
    ]
    found = [evaluate(Table.of(name, _t(spark, d, name, column)), [rule]) for name, column, rule in parts]
    return severity_counts(reduce(DataFrame.unionByName, found))


@query("select o_orderkey, o_custkey from (select o_orderkey, o_custkey, count(*) over (partition by o_custkey) as c from orders) x where c > 1")
def duplicate_row_key(spark, d):
    return values.repeated(_t(spark, d, "orders", "o_orderkey", "o_custkey"), "o_custkey")


@query("select p_partkey, p_brand, case when not regexp_matches(p_brand, '^Brand#[1-3][0-9]$') then 'identifier.syntax' else 'ok' end as rule_id from part")
def identifier_syntax(spark, d):
    table = Table.of("part", _t(spark, d, "part", "p_partkey", "p_brand"))
    rules, _ = values.identifier_rules("p_brand", values.FieldRule(), "brand", values.Profile("legacy", "brands", "^Brand#[1-3][0-9]$"), None, False)
    outcome = F.coalesce(*[F.when(r.when, r.rule_id) for r in rules], F.lit("ok"))
    return table.frame.select(F.col("p_partkey").cast("long"), "p_brand", outcome.alias("rule_id"))


@query("""
select c_custkey, id, case when not regexp_matches(id, '^[A-Z]{2}[0-9]{2}_[0-9]{5}$') then 'identifier.syntax' when substr(id, 1, 2) not in ('AU', 'BU', 'FU', 'NA') then 'identifier.country' when regexp_matches(substr(id, 6, 5), '^0+$') then 'identifier.zero_serial' when cast(substr(id, 3, 2) as int) not between 0 and 60 then 'identifier.year' else 'ok' end as rule_id
from (select c_custkey, concat(substr(upper(c_mktsegment), 1, 2), lpad(cast((c_custkey * 3) % 100 as varchar), 2, '0'), '_', lpad(cast(c_custkey % 50 as varchar), 5, '0')) as id from customer) t""")
def field_collection_id(spark, d):
    number = lambda x, n: F.lpad(_text(x), n, "0")
    rows = _t(spark, d, "customer", "c_custkey", "c_mktsegment").select("c_custkey", F.concat(F.substring(F.upper("c_mktsegment"), 1, 2), number(F.col("c_custkey") * 3 % 100, 2), F.lit("_"), number(F.col("c_custkey") % 50, 5)).alias("id"))
    profile = values.Profile("field_collection", "demo", year_range=[2000, 2060])
    rules, _ = values.identifier_rules("id", values.FieldRule(), "demo", profile, ["AU", "BU", "FU", "NA"], False)
    first = {r.rule_id: r.when for r in rules}
    rule = F.coalesce(*[F.when(first[k], k) for k in ("identifier.syntax", "identifier.country", "identifier.zero_serial", "identifier.year")], F.lit("ok"))
    return rows.withColumn("types", F.struct(F.lit("text").alias("id"))).select("c_custkey", "id", rule.alias("rule_id"))


@query("select o.o_orderkey, o.o_custkey from orders o left join (select c_custkey from customer where c_acctbal > 0) r on o.o_custkey = r.c_custkey where r.c_custkey is null")
def registry_unregistered(spark, d):
    register = _t(spark, d, "customer", "c_custkey", "c_acctbal").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("file_row"))
    looked = evidence.registry_lookup(_t(spark, d, "orders", "o_orderkey", "o_custkey"), register, ["o_custkey"])
    return looked.where(~F.col("registered")).select("o_orderkey", "o_custkey")


@query("select o.o_orderkey, r.status from orders o join (select * from (select c_nationkey as k, c_mktsegment as status, row_number() over (partition by c_nationkey order by c_custkey) as rn from customer) z where rn = 1) r on o.o_custkey % 25 = r.k where r.status = 'FURNITURE'")
def registry_first_match(spark, d):
    register = _t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("k"), F.col("c_mktsegment").alias("status"), F.col("c_custkey").alias("file_row"))
    looked = evidence.registry_lookup(_t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 25).alias("k")), register, ["k"])
    return looked.where("status = 'FURNITURE'").select("o_orderkey", "status")


@query("select p.k, case when c.k is null then 'removed' else 'reassigned' end as rule_id from (select c_custkey as k, c_nationkey as e from customer) p left join (select c_custkey as k, case when c_custkey % 50 = 0 then (c_nationkey + 1) % 25 else c_nationkey end as e from customer where c_custkey % 97 <> 0) c on p.k = c.k where c.k is null or c.e is distinct from p.e")
def registry_reassigned(spark, d):
    k, e = F.col("c_custkey"), F.col("c_nationkey")
    before = _t(spark, d, "customer").select(k.alias("k"), e.alias("entity_reference"))
    after = _t(spark, d, "customer").where(k % 97 != 0).select(k.alias("k"), F.when(k % 50 == 0, (e + 1) % 25).otherwise(e).alias("entity_reference"))
    return evidence.registry_changes(before, after, ["k"]).withColumnRenamed("change", "rule_id")


@query("select c_mktsegment, c_nationkey, count(distinct c_custkey % 3) as n from customer group by c_mktsegment, c_nationkey having count(distinct c_custkey % 3) > 1")
def alias_collision(spark, d):
    rows = _t(spark, d, "customer").select("c_mktsegment", "c_nationkey", (F.col("c_custkey") % 3).alias("identifier"))
    return evidence.alias_collisions(rows, ["c_mktsegment", "c_nationkey"], ["identifier"])


_EDGES = "select s_suppkey as c, (s_suppkey * 7 + 3) % 1009 as p from supplier where s_suppkey % 6 <> 0 union all select s_suppkey, s_suppkey + 1 from supplier where s_suppkey % 5 = 0"


@query(f"with recursive e as ({_EDGES}), r(root, node) as (select c, p from e union select r.root, e.p from r join e on r.node = e.c) select distinct a.root as node from r a join r b on a.node = b.root and b.root = b.node union select root from r where root = node")
def lineage_cycle(spark, d):
    """Nodes from which a cycle can be reached, as validate_lineage finds them."""
    k = F.col("s_suppkey")
    suppliers = _t(spark, d, "supplier", "s_suppkey")
    edges = suppliers.where(k % 6 != 0).select(k.alias("child"), ((k * 7 + 3) % 1009).alias("parent")).union(suppliers.where(k % 5 == 0).select(k, k + 1))
    return evidence.on_cycles(edges)


@query("select node from (select s_nationkey as node from supplier union select n_regionkey + 23 as node from nation) a where node not in (select n_nationkey from nation)")
def lineage_unknown(spark, d):
    nodes = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("node")).union(_t(spark, d, "nation").select(F.col("n_regionkey") + 23)).distinct()
    return evidence.unknown_nodes(nodes, _t(spark, d, "nation").select(F.col("n_nationkey").alias("node")), "node")


@query("""
select coalesce(a.k, b.k) as k, case when a.k is null then 'added' when b.k is null then 'removed' else 'modified' end as change
from (select o_orderkey as k, o_totalprice as v, o_orderstatus as s from orders where o_orderkey % 40 <> 1) a full outer join (select o_orderkey as k, case when o_orderkey % 30 = 0 then o_totalprice + 1 else o_totalprice end as v, o_orderstatus as s from orders where o_orderkey % 50 <> 2) b on a.k = b.k
where a.k is null or b.k is null or a.v is distinct from b.v or a.s is distinct from b.s""")
def snapshot_diff(spark, d):
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    before = _t(spark, d, "orders").where(k % 40 != 1).select(k.alias("k"), v.alias("v"), F.col("o_orderstatus").alias("s"))
    after = _t(spark, d, "orders").where(k % 50 != 2).select(k.alias("k"), F.when(k % 30 == 0, v + 1).otherwise(v).alias("v"), F.col("o_orderstatus").alias("s"))
    return snapshots.record_changes(before, after, ["k"])


@query("select 'c_acctbal' as field, count(*) as nrows, count(distinct c_acctbal) as ndist, cast(count(*) filter (where c_acctbal is null) as bigint) as missing from customer union all select 'c_mktsegment', count(*), count(distinct c_mktsegment), count(*) filter (where c_mktsegment is null) from customer")
def inventory_profile(spark, d):
    return snapshots.field_profile(_t(spark, d, "customer", "c_acctbal", "c_mktsegment"), ["c_acctbal", "c_mktsegment"]).drop("types")


@query("select l_orderkey, max(l_linenumber) as height, count(*) as cells from lineitem group by l_orderkey")
def table_extent(spark, d):
    return snapshots.table_extent(_t(spark, d, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey"], "l_linenumber")


@query("select o.o_orderkey, s.n as spacer from (select l_orderkey as o_orderkey, max(l_linenumber) as h from lineitem group by l_orderkey) o join (select unnest(range(1, 8)) as n) s on s.n <= o.h left join lineitem l on l.l_orderkey = o.o_orderkey and l.l_linenumber = s.n where l.l_orderkey is null")
def spacer_row(spark, d):
    return structure.spacer_rows(_t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), ["o_orderkey"], "l_linenumber")


_DMS = """
select k, txt, case when h = 'E' then 'Hemisphere marker conflicts with coordinate axis' when m >= 60 then 'Invalid degree, minute, or second components' when v > 90 then 'Coordinate outside -90 to 90' else '' end as err, case when h = 'E' or m >= 60 or v > 90 then null when h = 'S' then -v else v end as value
from (select k, txt, regexp_extract(txt, '([NSEW]?)$', 1) as h, cast(regexp_extract(txt, '^([0-9]+):([0-9]+):([0-9]+)', 2) as double) as m, cast(regexp_extract(txt, '^([0-9]+):([0-9]+):([0-9]+)', 1) as double) + cast(regexp_extract(txt, '^([0-9]+):([0-9]+):([0-9]+)', 2) as double) / 60 + cast(regexp_extract(txt, '^([0-9]+):([0-9]+):([0-9]+)', 3) as double) / 3600 as v
from (select k, trim(concat(d, ':', m, ':', s, ' ', h)) as txt from (select c_custkey as k, cast(c_custkey % 97 as varchar) as d, cast((c_custkey * 7) % 66 as varchar) as m, cast((c_custkey * 11) % 60 as varchar) as s, case c_custkey % 4 when 0 then 'N' when 1 then 'S' when 2 then '' else 'E' end as h from customer) a) b) c"""


@query(_DMS)
def coordinate_dms(spark, d):
    k = F.col("c_custkey")
    side = F.when(k % 4 == 0, "N").when(k % 4 == 1, "S").when(k % 4 == 2, "").otherwise("E")
    rows = _t(spark, d, "customer").select(k.alias("k"), F.trim(F.concat(_text(k % 97), F.lit(":"), _text(k * 7 % 66), F.lit(":"), _text(k * 11 % 60), F.lit(" "), side)).alias("txt"))
    return rows.withColumn("c", geo.parse_coordinate("txt", "latitude")).select("k", "txt", F.col("c.error").alias("err"), F.col("c.value").alias("value"))


@query("""
select k, txt, case when abs(v) > 180 then 'Coordinate outside -180 to 180' else '' end as err, case when abs(v) > 180 then null else v end as value, case when abs(v) > 180 then 'unresolved' else 'decimal_degrees' end as method
from (select k, replace(cast(v as varchar), '.', ',') as txt, cast(v as double) as v from (select c_custkey as k, cast(cast((c_custkey * 37 % 4000 - 2000) as double) / 10 as decimal(12, 1)) as v from customer) a) b""")
def coordinate_decimal(spark, d):
    k = F.col("c_custkey")
    text = F.replace(_text(((k * 37 % 4000 - 2000).cast("double") / 10).cast("decimal(12,1)")), F.lit("."), F.lit(","))
    rows = _t(spark, d, "customer").select(k.alias("k"), text.alias("txt"))
    return rows.withColumn("c", geo.parse_coordinate("txt", "longitude", ",")).select("k", "txt", F.col("c.error").alias("err"), F.col("c.value").alias("value"), F.col("c.method").alias("method"))


@query("select k, case when (lat is null) <> (lon is null) then 'coordinate.incomplete_pair' when lat is null then 'missing' when lon < -50 or lat < -20 or lon > 50 or lat > 20 then 'coordinate.expected_extent' else 'converted' end as outcome from (select c_custkey as k, nullif(c_custkey % 91, 0) * 1.0 - 45 as lat, nullif(c_custkey % 181, 0) * 1.0 - 90 as lon from customer) t")
def coordinate_pair_bounds(spark, d):
    k = F.col("c_custkey")
    lat, lon = (_text(F.nullif(k % n, F.lit(0)) - n // 2) for n in (91, 181))
    table = Table.of("customer", _t(spark, d, "customer").select(k.alias("k"), lat.alias("latitude"), lon.alias("longitude")), key_field="k")
    m = values.Mapping("latitude", "longitude", "WGS84", bounds=[-50, -20, 50, 20])
    found = {r.rule_id: r.when for r in values.coordinate_rules(m)}
    rows = values.derive_coordinates(table, m)
    outcome = F.when(found["coordinate.incomplete_pair"], "coordinate.incomplete_pair").when(found["coordinate.expected_extent"], "coordinate.expected_extent").otherwise(F.col("status"))
    return rows.select(F.col("source_id").cast("long").alias("k"), outcome.alias("outcome"))


_POINTS = "select c_custkey as id, c_nationkey as nm, (c_custkey % 180) / 2.0 - 45 as lat, (c_custkey % 360) / 2.0 - 90 as lon from customer"
_NODES = "select s_suppkey as id, s_nationkey as nm, (s_suppkey * 3 % 180) / 2.0 - 45 as lat, (s_suppkey * 3 % 360) / 2.0 - 90 as lon from supplier"
_NEAR = f"""select pid, nid, pn, nn, 2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a)) as d from (select p.id as pid, n.id as nid, p.nm as pn, n.nm as nn, power(sin(radians(n.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(n.lat)) * power(sin(radians(n.lon - p.lon) / 2), 2) as a from ({_POINTS}) p join ({_NODES}) n on abs(p.lat - n.lat) <= 3) x"""


def _places(spark, d) -> DataFrame:
    def rows(name: str, key: str, nation: str, factor: int, ids: list[str]) -> DataFrame:
        k = F.col(key)
        return _t(spark, d, name).select(k.alias(ids[0]), F.col(nation).alias(ids[1]), ((k * factor % 180) / 2 - 45).alias(ids[2]), ((k * factor % 360) / 2 - 90).alias(ids[3]))

    return toponyms.within_radius(rows("customer", "c_custkey", "c_nationkey", 1, ["pid", "pn", "lat", "lon"]), rows("supplier", "s_suppkey", "s_nationkey", 3, ["nid", "nn", "node_lat", "node_lon"]), 300_000.0)


@query(f"select pid, nid, round(d, 1) as distance_m from ({_NEAR}) y where d <= 300000")
def radius_join(spark, d):
    return _places(spark, d).select("pid", "nid", F.round("distance_m", 1).alias("distance_m"))


@query(f"select pid, case when n = 1 then 'node_exact' when n > 1 then 'ambiguous' else 'osm_fallback' end as status from (select p.id as pid, coalesce(sum(y.m), 0) as n from ({_POINTS}) p left join (select pid, case when pn % 3 = nn % 3 then 1 else 0 end as m from ({_NEAR}) z where d <= 300000) y on p.id = y.pid group by p.id) w")
def toponym_status(spark, d):
    matches = _places(spark, d).groupBy("pid").agg(F.count_if(F.col("pn") % 3 == F.col("nn") % 3).alias("n"))
    points = _t(spark, d, "customer").select(F.col("c_custkey").alias("pid"))
    return points.join(matches, "pid", "left").select("pid", toponyms.decide(F.lit(False), F.coalesce("n", F.lit(0))).alias("status"))


@query("select doc_id, nullif(trim(regexp_replace(translate(replace(replace(replace(replace(lower(text), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), 'þ', 'th'), 'àâäáãåāăąçćčďđèéêëēėęěğģìíîïīįıķłļľñńňņòóôöõōőøŕřśšşșťţțúùûüūůűųýÿźżžðµ', 'aaaaaaaaacccddeeeeeeeeggiiiiiiiklllnnnnoooooooorrsssstttuuuuuuuuyyzzzdu'), '[^a-z0-9]+', ' ', 'g')), '') as norm from documents")
def normalise_name(spark, d):
    return _t(spark, d, "documents", "doc_id", "text").select("doc_id", sc.normalise_name("text").alias("norm"))


@query("select doc_id from (select doc_id, case when doc_id % 7 = 0 then concat(text, chr(10)) when doc_id % 7 = 1 then concat(chr(9), text) else text end as text from documents) x where text <> trim(text, ' ' || chr(9) || chr(13) || chr(10))")
def whitespace_value(spark, d):
    k = F.col("doc_id")
    rows = _t(spark, d, "documents").select("doc_id", F.when(k % 7 == 0, F.concat("text", F.lit("\n"))).when(k % 7 == 1, F.concat(F.lit("\t"), "text")).otherwise(F.col("text")).alias("text"))
    return rows.where(sc.has_outer_space("text")).select("doc_id")


@query(r"select page_id, substr(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[\s\x00-\x1f\x7f]+', ' ', 'g')), 1, 500) as detail from pages")
def plain_diagnostic(spark, d):
    return _t(spark, d, "pages", "page_id", "html").select("page_id", sc.plain_diagnostic("html").alias("detail"))


@query("select k, d, case when regexp_matches(d, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') and try_cast(d as date) is not null then 'date' when regexp_matches(d, '^[0-9]{4}(-(0[1-9]|1[0-2]))?$') then 'partial_date' else 'temporal.invalid' end as outcome from (select o_orderkey as k, case o_orderkey % 4 when 0 then concat(substr(cast(o_orderdate as varchar), 1, 8), '31') when 1 then substr(cast(o_orderdate as varchar), 1, 7) else substr(cast(o_orderdate as varchar), 1, 10) end as d from orders) t")
def valid_date(spark, d):
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = _t(spark, d, "orders").select(k.alias("k"), F.when(k % 4 == 0, F.concat(F.substring(day, 1, 8), F.lit("31"))).when(k % 4 == 1, F.substring(day, 1, 7)).otherwise(day).alias("d"))
    return rows.select("k", "d", F.when(sc.valid_date("d"), "date").when(sc.valid_partial_date("d"), "partial_date").otherwise("temporal.invalid").alias("outcome"))


@query("select l_orderkey * 10 + l_linenumber as k, concat('PT', cast(cast(l_quantity as int) as varchar), 'H', cast(l_linenumber as varchar), 'M') as du, cast(cast(l_quantity as int) * 3600 + l_linenumber * 60 as double) as secs from lineitem")
def duration_seconds(spark, d):
    n = F.col("l_linenumber")
    rows = _t(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + n).alias("k"), F.concat(F.lit("PT"), _text(F.col("l_quantity").cast("int")), F.lit("H"), _text(n), F.lit("M")).alias("du"))
    return rows.withColumn("secs", sc.duration_seconds("du"))


@query("select k, case when n = 60 then 'temporal_error' when n < 60 then cast(date '1899-12-31' + n as varchar) else cast(date '1899-12-30' + n as varchar) end as iso from (select c_custkey as k, cast(c_custkey % 200 as int) as n from customer) t")
def excel_serial(spark, d):
    shown = excel_temporal((F.col("c_custkey") % 200).cast("double"), "date")
    return _t(spark, d, "customer").withColumn("s", shown).select(F.col("c_custkey").alias("k"), F.when(F.col("s.type") == "temporal_error", "temporal_error").otherwise(F.col("s.value")).alias("iso"))


@query("select k, concat(cast(date '1899-12-30' + (k % 40000 + 100)::int as varchar), 'T', lpad(cast((k * 7) % 24 as varchar), 2, '0'), ':', lpad(cast((k * 11) % 60 as varchar), 2, '0'), ':', lpad(cast((k * 13) % 60 as varchar), 2, '0')) as iso from (select c_custkey as k from customer) t")
def excel_datetime(spark, d):
    k = F.col("c_custkey")
    serial = (k % 40000 + 100).cast("double") + ((k * 7 % 24) * 3600 + (k * 11 % 60) * 60 + k * 13 % 60) / 86400
    return _t(spark, d, "customer").select(k.alias("k"), excel_temporal(serial, "datetime")["value"].alias("iso"))


@query("select event_id, v, case when regexp_matches(v, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$') and abs(try_cast(v as double)) < 1e308 then 'ok' else 'value.numeric_type' end as outcome from (select event_id, case event_id % 5 when 0 then event_type when 1 then concat(cast(event_id as varchar), '.') when 2 then concat('.', cast(event_id as varchar)) when 3 then '1e400' else concat(' ', cast(event_id as varchar)) end as v from events) t")
def strict_number(spark, d):
    k = F.col("event_id")
    v = F.when(k % 5 == 0, F.col("event_type")).when(k % 5 == 1, F.concat(_text(k), F.lit("."))).when(k % 5 == 2, F.concat(F.lit("."), _text(k))).when(k % 5 == 3, "1e400").otherwise(F.concat(F.lit(" "), _text(k)))
    rows = _t(spark, d, "events").select("event_id", v.alias("v"))
    return rows.withColumn("outcome", F.when(sc.strict_number("v").isNotNull(), "ok").otherwise("value.numeric_type"))


@query("select event_id, cast(json_extract_string(props, '$.k') as int) as k from events")
def json_metadata(spark, d):
    return _t(spark, d, "events").select("event_id", sc.json_text("props", "$.k").cast("int").alias("k"))


@query("select c_custkey, case when c_mktsegment in ('FURNITURE') then 'value.legacy_missing_code' when c_acctbal < 0 then 'value.bound' else 'ok' end as outcome from customer")
def missing_code_order(spark, d):
    # A coded row ends the checks before its number is looked at.
    value = F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("FURNITURE")).otherwise(_text(F.col("c_acctbal")))
    table = Table.of("customer", _t(spark, d, "customer").select("c_custkey", value.alias("v")), {"v": "number"})
    rules = values.value_rules(table, "v", values.FieldRule(type="number", minimum="0"), ["FURNITURE"], None)
    outcome = F.coalesce(*[F.when(r.when, r.rule_id) for r in rules], F.lit("ok"))
    return table.frame.select(F.col("c_custkey").cast("long"), outcome.alias("outcome"))


@query("select n_nationkey + 2 as source_row, 'n_name' as field, n_name as value from nation union all select n_nationkey + 2, 'n_regionkey', cast(n_regionkey as varchar) from nation")
def cells_unpivot(spark, d):
    return structure.unpivot(_t(spark, d, "nation").withColumn("source_row", F.col("n_nationkey") + 2), "source_row", ["n_name", "n_regionkey"])


@query("select l_orderkey, max(case when l_linenumber = 1 then l_quantity end) as c1, max(case when l_linenumber = 2 then l_quantity end) as c2, max(case when l_linenumber = 3 then l_quantity end) as c3 from lineitem group by l_orderkey")
def cells_pivot(spark, d):
    return structure.pivot(_t(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", "l_quantity", {1: "c1", 2: "c2", 3: "c3"})


@query("select k, concat(case when n > 26 then chr(cast(64 + ((n - 1) // 26) as int)) else '' end, chr(cast(65 + (n - 1) % 26 as int)), cast(k as varchar)) as ref from (select c_custkey as k, c_custkey % 500 + 1 as n from customer) t")
def cell_ref(spark, d):
    k = F.col("c_custkey")
    return _t(spark, d, "customer").select(k.alias("k"), sc.cell_ref(k % 500 + 1, k).alias("ref"))


@query("select c_custkey as k, c_custkey % 500 + 1 as n from customer")
def column_number(spark, d):
    k = F.col("c_custkey")
    return _t(spark, d, "customer").select(k.alias("k"), sc.column_number(sc.column_name(k % 500 + 1)).cast("long").alias("n"))


@query("select p_partkey, sha256(concat_ws('|', p_name, p_brand, p_type, cast(p_size as varchar))) as h from part")
def row_hash(spark, d):
    return _t(spark, d, "part").select("p_partkey", sc.row_digest("p_name", "p_brand", "p_type", _text(F.col("p_size"))).alias("h"))


@query("select c_custkey, printf('%.5f', c_custkey / 7.0e0) as display from customer")
def display_digits(spark, d):
    return _t(spark, d, "customer").select("c_custkey", sc.fixed(F.col("c_custkey") / 7, 5).alias("display"))


@query("select * from (select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_extendedprice, l_linenumber, l_partkey) as rk from lineitem) t where rk <= 3")
def nearest_first(spark, d):
    rows = _t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return toponyms.nearest_first(rows, ["l_orderkey"], ["l_extendedprice", "l_linenumber", "l_partkey"], 3).select("l_orderkey", "l_linenumber", F.col("rk").cast("long").alias("rk"))


@query("select r.chk from (select distinct p_type as chk from part) r left join (select p_type as chk, case when p_size % 5 = 0 and p_partkey % 3 = 0 then 'not_assessed' when p_size % 2 = 0 then 'not_applicable' else 'assessed' end as state from part where p_size > 3) c on r.chk = c.chk group by r.chk having count(c.chk) = 0 or sum(case when c.state = 'not_assessed' then 1 else 0 end) > 0")
def required_coverage(spark, d):
    part, size = _t(spark, d, "part"), F.col("p_size")
    state = F.when((size % 5 == 0) & (F.col("p_partkey") % 3 == 0), "not_assessed").when(size % 2 == 0, "not_applicable").otherwise("assessed")
    return incomplete_checks(part.select(F.col("p_type").alias("chk")), part.where(size > 3).select(F.col("p_type").alias("chk"), state.alias("state")), "chk")


@query("select event_id, concat(lpad(cast(hour(ts) as varchar), 2, '0'), ':', lpad(cast(event_id % 70 as varchar), 2, '0')) as clock, event_id % 70 < 60 as ok from events")
def valid_clock(spark, d):
    clock = F.concat(F.date_format("ts", "HH"), F.lit(":"), F.lpad(_text(F.col("event_id") % 70), 2, "0"))
    return _t(spark, d, "events").select("event_id", clock.alias("clock"), sc.valid_clock(clock).alias("ok"))


@query("select event_id, event_id % 3 <> 2 and event_id % 5 <> 4 as ok, event_id % 3 = 0 as naive from events")
def datetime_offset(spark, d):
    k = F.col("event_id")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.when(k % 5 == 4, " ").otherwise("T"), F.date_format("ts", "HH:mm:ss"), F.when(k % 3 == 0, "").when(k % 3 == 1, "+02:00").otherwise("+02:75"))
    parts = sc.datetime_parts(text)
    # An impossible offset is no offset at all, and leaves no clock time.
    return _t(spark, d, "events").select("event_id", parts["ok"].alias("ok"), ((k % 3 == 0) & parts["naive"]).alias("naive"))


@query("select s_suppkey, case when s_suppkey % 4 = 0 then null else concat('https://www.openstreetmap.org/node/', cast(s_suppkey as varchar)) end as url, printf('%.7f_%.7f', s_suppkey / 8.0e0, s_suppkey / -16.0e0) as key from supplier")
def lookup_keys(spark, d):
    k = F.col("s_suppkey")
    return _t(spark, d, "supplier").select("s_suppkey", sc.osm_url(F.when(k % 4 != 0, "node"), k).alias("url"), sc.cache_key(k / 8, k / -16).alias("key"))


@query("select s_suppkey, name_count, case when s_suppkey % 3 = 0 then concat('town ', cast(s_suppkey as varchar)) else concat('old ', s_name) end as shown from (select s_suppkey, s_name, case when s_suppkey % 2 = 0 then 2 else 3 end as name_count from supplier) t")
def place_names(spark, d):
    k = F.col("s_suppkey")
    tags = F.map_from_arrays(F.array(*[F.lit(x) for x in ("name", "alt_name", "population", "name:de")]), F.array(F.col("s_name"), F.when(k % 2 == 0, F.concat("s_name", F.lit("; ;x"))).otherwise(F.concat(F.lit("y;"), "s_name", F.lit(" ;z"))), F.lit("5"), F.col("s_name")))
    address = F.create_map(F.lit("town"), F.concat(F.lit("town "), _text(k)), F.lit("suburb"), F.lit("s"))
    name = F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("old "), "s_name"))
    return _t(spark, d, "supplier").select("s_suppkey", F.size(toponyms.node_names(tags)).alias("name_count"), toponyms.display_name(name, address).alias("shown"))


@query("select o_orderkey, case o_orderkey % 5 when 0 then 'toponymy.status' when 1 then 'ok' else 'toponymy.review' end as outcome from orders")
def stored_toponym(spark, d):
    k = F.col("o_orderkey")
    status = F.when(k % 5 == 0, "guessed").when(k % 5 == 1, "node_exact").when(k % 5 == 2, "osm_fallback").when(k % 5 == 3, "ambiguous").otherwise("unresolved")
    rules = values.toponymy_rules(F.lit("x"), F.lit("node"), F.lit("7"), status)
    return _t(spark, d, "orders").select("o_orderkey", F.coalesce(*[F.when(r.when, r.rule_id) for r in rules], F.lit("ok")).alias("outcome"))


@query("select 'orders' as sheet, o_orderkey as source_row, 'value.controlled_code' as rule_id, concat('B', cast(o_orderkey as varchar)) as cell, o_orderstatus as original_value from orders where o_orderstatus not in ('F', 'O')")
def rule_projection(spark, d):
    rows = _t(spark, d, "orders").select(F.col("o_orderkey").alias("source_row"), F.col("o_custkey"), "o_orderstatus")
    table = Table.of("orders", rows, key_field="o_custkey")
    found = evaluate(table, values.value_rules(table, "o_orderstatus", values.FieldRule(type="text"), None, ["F", "O"]))
    return found.select("sheet", "source_row", "rule_id", "cell", "original_value")


def queries() -> dict[str, Query]:
    from . import rule_queries  # noqa: F401  registers its own

    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(registry.SQL)
