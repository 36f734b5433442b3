"""Scalars, rules and place references on golden cases."""

import json

import pytest
from pyspark.sql import functions as F

from assayer.functions import geography as geo
from assayer.functions import scalars as sc
from assayer.functions.spreadsheet import excel_temporal, format_kind
from assayer.operators import evidence, toponyms, values
from assayer.operators.findings import Findings, Table, has_errors
from assayer.plans.run import resolve_batch
from assayer.sources import durable
from assayer.sources import tables as inputs


def apply(spark, xs, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f("x")).collect()]


GOOD = {"0": 0.0, "90 N": 90.0, "13:30:00 N": 13.5, "0° 30' 0\" S": -0.5, "-0° 30'": -0.5, " 13.5 ": 13.5, "−13.5": -13.5, "S 13.5": -13.5, "13.5°": 13.5, "1e1": 10.0, "5.": 5.0, "13d 30'": 13.5}
BAD = ["-13 N", "13 S N", "13° 60' N", "13,5", "91", "13 30", "Inf", "13' 30°", "13° 30\"", "13::30", "13°° 30'", "13 E", "", "N", "+13 S"]


def test_coordinates(spark):
    got = apply(spark, list(GOOD), lambda x: geo.parse_coordinate(x, "latitude"))
    for (text, want), r in zip(GOOD.items(), got, strict=True):
        assert (r["value"], r["error"]) == (pytest.approx(want, abs=1e-12), ""), text
    for text, r in zip(BAD, apply(spark, BAD, lambda x: geo.parse_coordinate(x, "latitude")), strict=True):
        assert r["value"] is None and r["error"], text
        assert r["method"] == "unresolved"
    null, comma = apply(spark, [None, "13,5"], lambda x: geo.parse_coordinate(x, "latitude", ","))
    assert null["method"] == "missing" and not null["error"] and comma["value"] == 13.5
    assert apply(spark, ["180 W"], lambda x: geo.parse_coordinate(x, "longitude"))[0]["value"] == -180
    assert apply(spark, ["13 30"], lambda x: geo.parse_coordinate(x, "latitude", form="dm"))[0]["value"] == 13.5
    assert apply(spark, ["13.5"], lambda x: geo.parse_coordinate(x, "latitude", form="dms"))[0]["error"] == geo.NOT_SEXAGESIMAL


def test_dates_and_numbers(spark):
    xs = ["2024-02-29", "2023-02-29", "2024-2-9", "2024-02-29\n", None]
    assert apply(spark, xs, sc.valid_date) == [True, False, False, False, False]
    assert apply(spark, ["23:59", "24:00", "12:60", "12:30:59.5", "1:00", None], sc.valid_clock) == [True, False, False, True, False, False]
    assert apply(spark, ["P1DT2H3M4.5S", "PT1H", "P", "PT", "P1Y", "-PT1H", "", None], sc.duration_seconds) == [93784.5, 3600.0] + [None] * 6
    assert apply(spark, ["1", "1.", ".5", "1e3", " 1", "1d", "Inf", "1e400", "", None], sc.strict_number) == [1.0, 1.0, 0.5, 1000.0] + [None] * 6
    assert apply(spark, ["2024", "2024-13", "2024-12", "2024-12-31"], sc.valid_partial_date) == [True, False, True, True]
    parts = apply(spark, ["2024-01-01T10:00", "2024-01-01T10:00Z", "2024-01-01T10:00+23:59", "2024-01-01 10:00", "2024-01-01T10:00+24:00"], sc.datetime_parts)
    assert [(p["ok"], p["naive"]) for p in parts] == [(True, True), (True, False), (True, False), (False, True), (False, True)]


def test_excel_serials(spark):
    f = lambda kind, d=False: lambda x: excel_temporal(F.col(x).cast("double"), kind, d)
    assert [r["value"] for r in apply(spark, ["1", "59", "61", "46272"], f("date"))] == ["1900-01-01", "1900-02-28", "1900-03-01", "2026-09-07"]
    assert {r["type"] for r in apply(spark, ["60", "-1", "1.5", None], f("date"))} == {"temporal_error"}
    assert apply(spark, ["0"], f("date", True))[0]["value"] == "1904-01-01"
    assert apply(spark, ["46272.5625"], f("datetime"))[0]["value"] == "2026-09-07T13:30:00"
    assert [r["type"] for r in apply(spark, ["0.9999999999999", "1", "0.5"], f("time"))] == ["temporal_error", "temporal_error", "time"]
    assert apply(spark, ["2.5"], f("duration"))[0]["value"] == "PT216000.000000000S"
    kinds = {(14, None): "date", (22, None): "datetime", (46, None): "duration", (0, None): "number", (164, "mm"): "number", (164, "[h]:mm"): "duration", (164, "yyyy-mm-dd"): "date", (164, 'h:mm "day"'): "time", (164, "d h:mm"): "datetime"}
    assert {k: format_kind(*k) for k in kinds} == kinds


def test_text_functions(spark):
    assert apply(spark, ["Médina  SSø-x", "---", "", None], sc.normalise_name) == ["medina sso x", None, None, None]
    assert apply(spark, ["A", "Z", "AA", "XFD"], sc.column_number) == [1, 26, 27, 16384]
    df = spark.createDataFrame([(n,) for n in (1, 26, 27, 702, 703, 16384)], "n int")
    assert [r[0] for r in df.select(sc.cell_ref("n", F.lit(2))).collect()] == ["A2", "Z2", "AA2", "ZZ2", "AAA2", "XFD2"]
    assert apply(spark, ["\x1b[31mred\x1b[0m <b>x</b>\n y"], sc.plain_diagnostic) == ["red x y"]
    assert apply(spark, ["a b/c"], sc.safe_file_name) == ["a_b_c"]
    assert not apply(spark, ["x"], lambda x: sc.matches(x, "("))[0]


def checked(spark, rows, rule, types=None):
    df = spark.createDataFrame([(i + 2, x) for i, x in enumerate(rows)], "source_row long, v string")
    table = Table.of("data__t", df, types, key_field="")
    found = Findings(spark, "s", "h")
    values.validate_values(found, {"data__t": table}, {("data__t", "v"): rule})
    return sorted((r.rule_id, r.source_row) for r in found.findings().collect()), found


def test_value_rules(spark):
    got, _ = checked(spark, ["5", "-1", "x", "99", "1.5", None], values.FieldRule(type="integer", minimum="0", maximum="10", missing_codes='["99"]', required="true"), {"v": "number"})
    assert got == [("value.bound", 3), ("value.integer", 6), ("value.legacy_missing_code", 5), ("value.numeric_type", 4), ("value.required", 7)]
    got, _ = checked(spark, ["TRUE", "true"], values.FieldRule(type="boolean"))
    assert got == [("value.boolean", 3)]
    got, found = checked(spark, ["a", " a", "b"], values.FieldRule(type="odd", allowed_values='["a"]', minimum="x"))
    assert got == [("metadata.unknown_type", None), ("value.code_whitespace", 3), ("value.controlled_code", 3), ("value.controlled_code", 4)]
    assert has_errors(found.findings())
    assert ("metadata.field_json", None) in checked(spark, ["a"], values.FieldRule(allowed_values="["))[0]
    assert ("metadata.numeric_bound", None) in checked(spark, ["1"], values.FieldRule(type="number", minimum="x"))[0]


def test_temporal_rules_rewrite_clocks(spark):
    df = spark.createDataFrame([(2, "PT13H30M0S"), (3, "25:00")], "source_row long, seen_time string")
    table = Table.of("data__t", df, {"seen_time": "duration"})
    found = Findings(spark)
    values.validate_temporal(found, {"data__t": table}, {})
    assert sorted((r.rule_id, r.source_row) for r in found.findings().collect()) == [("temporal.clock_serialization", 2), ("temporal.invalid", 3), ("temporal.timezone_missing", 2), ("temporal.timezone_missing", 3)]
    assert [r[0] for r in table.frame.orderBy("source_row").select("seen_time").collect()] == ["13:30:00", "25:00"]


def test_identifier_rules(spark):
    ids = ["NA26_00001", "XX26_00001", "NA26_00000", "NA99_00001", "na26_1", " NA26_00002", None, "NA26_00003", "NA26_00003"]
    df = spark.createDataFrame([(i + 2, x) for i, x in enumerate(ids)], "source_row long, id string")
    found = Findings(spark)
    profile = values.Profile("field_collection", "demo", year_range=[2000, 2050])
    values.validate_identifiers(found, {"t": Table.of("t", df, key_field="id", key_scope="row")}, {}, {"p": profile}, "p", ["NA"])
    got = {(r.rule_id, r.source_row) for r in found.findings().collect()}
    assert {("identifier.country", 3), ("identifier.zero_serial", 4), ("identifier.year", 5), ("identifier.syntax", 6), ("identifier.lexical", 6), ("identifier.whitespace", 7), ("identifier.missing", 8), ("identifier.duplicate_row_key", 9), ("identifier.duplicate_row_key", 10)} <= got
    assert not any(row == 2 for _, row in got)


def test_register_aliases_and_lineage(spark):
    registry = spark.createDataFrame([("n", "a", "E1", "issued"), ("n", "a", "E2", "retired"), ("n", "b", "", "void")], "namespace string, identifier string, entity_reference string, status string")
    found = Findings(spark)
    evidence.validate_registry(found, {}, registry, None, {}, {}, "")
    aliases = spark.createDataFrame([("p", "x", "n", "a"), ("p", "x", "n", "b"), ("p", "y", "n", "a")], "provider string, external_id string, namespace string, identifier string")
    evidence.validate_aliases(found, aliases)
    chain = spark.createDataFrame([("n", "a", "b", "r"), ("n", "a", "c", "r"), ("n", "b", "c", "r")], "namespace string, child_id string, parent_id string, relationship string")
    evidence.validate_lineage(found, chain, registry)
    got = sorted((r.rule_id, r.original_value) for r in found.findings().collect())
    assert got == [("identifier.alias_collision", "x"), ("identifier.registry_collision", None), ("identifier.registry_missing", None), ("lineage.unknown_entity", "n:c")]
    loop = spark.createDataFrame([("n", "a", "a", "r"), ("n", "x", "y", "r"), ("n", "y", "x", "")], chain.schema)
    found = Findings(spark)
    evidence.validate_lineage(found, loop, None)
    assert {r.rule_id for r in found.findings().collect()} == {"lineage.self_parent", "lineage.cycle", "lineage.missing"}


def test_deep_lineage_without_a_cycle_is_sound(spark):
    deep = [("n", f"e{k}", f"e{k + 1}", "r") for k in range(200)]
    schema = "namespace string, child_id string, parent_id string, relationship string"
    for rows, rules in ((deep, set()), ([*deep, ("n", "e200", "e0", "r")], {"lineage.cycle"})):
        found = Findings(spark)
        evidence.validate_lineage(found, spark.createDataFrame(rows, schema).coalesce(1), None)
        assert {r.rule_id for r in found.findings().collect()} == rules


def test_stripping_is_the_same_on_executors_and_driver(spark, monkeypatch):
    import random

    rng = random.Random(3)
    graphs = [[(k, k + 1) for k in range(6)], [(k, (k + 1) % 7) for k in range(7)] + [(9, 0), (3, 12), (20, 21)], [(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(34)]]
    for edges in graphs:
        out = {}
        for a, b in edges:
            out.setdefault(a, set()).add(b)

        def reach(x, out=out):
            seen, todo = set(), [x]
            while todo:
                for y in out.get(todo.pop(), ()):
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
            return seen

        loops = {x for x in out if x in reach(x)}
        want = {x for x in out if x in loops or reach(x) & loops}
        between = {x for x in want if x in loops or any(x in reach(y) for y in loops)}
        df = spark.createDataFrame(edges, "child long, parent long").coalesce(1)
        for limit in (50_000, 2):
            monkeypatch.setattr(evidence, "LOCAL_EDGES", limit)
            assert {r.node for r in evidence.on_cycles(df).collect()} == want
            assert {r.node for r in evidence.on_cycles(df, keep_cycles_only=True).collect()} == between


def test_vocabularies_of_any_size_give_the_same_findings(spark):
    for size in (3, 1500):
        codes = [f"c{k}" for k in range(size)]
        rows = ["c1", " c2", "zz", None, "99"]
        data = Table.of("data__t", spark.createDataFrame([(i + 2, x) for i, x in enumerate(rows)], "source_row long, v string"))
        ref = Table.of("ref__c", spark.createDataFrame([(i + 2, x) for i, x in enumerate([*codes, "c1", None])], "source_row long, code string"), role="ref")
        found = Findings(spark)
        values.validate_values(found, {"data__t": data, "ref__c": ref}, {("data__t", "v"): values.FieldRule(ref_sheet="ref__c", ref_field="code", missing_codes='["99"]')})
        assert sorted((r.rule_id, r.source_row, r.cell) for r in found.findings().collect()) == [("value.code_whitespace", 3, "A3"), ("value.controlled_code", 3, "A3"), ("value.controlled_code", 4, "A4"), ("value.legacy_missing_code", 6, "A6")]


def test_place_references(spark, tmp_path):
    reverse, nodes = tmp_path / "reverse", tmp_path / "nodes"
    reverse.mkdir()
    nodes.mkdir()
    look = lambda name, t="way", c="highway", **a: json.dumps({"name": name, "osm_type": t, "osm_id": 7, "lat": "13.5", "lon": "-16.2", "category": c, "address": a})
    spots = {"13.5000000_-16.2000000": look("Médina", "node", "place"), "14.0000000_-16.0000000": look("", village="Touba"), "15.0000000_-16.0000000": look("", town="Keur"), "16.0000000_-16.0000000": look("Nothing near"), "17.0000000_-16.0000000": "broken {"}
    for key, text in spots.items():
        (reverse / f"{key}_zoom15.json").write_text(text)
    node = lambda i, lat, lon, name, **t: {"id": i, "lat": lat, "lon": lon, "tags": {"name": name, "place": "village", **t}}
    (nodes / "a_r5000.json").write_text(json.dumps({"elements": [node(1, 14.01, -16.0, "TOUBA"), node(2, 14.2, -16.0, "Touba"), node(3, 15.01, -16.0, "Keur"), node(4, 15.0, -16.02, "x", alt_name="y;keur"), node(5, 14.0, -16.01, "Other")]}))
    (tmp_path / "points.csv").write_text("id,latitude,longitude,extra\n" + "".join(f"00{i},{k.split('_')[0]},{k.split('_')[1]},z\n" for i, k in enumerate(spots)) + "009,95,0,z\n")
    points = inputs.read_points(spark, str(tmp_path / "points.csv"))
    done = toponyms.resolve(points, inputs.read_reverse_cache(spark, str(reverse)), inputs.read_node_cache(spark, str(nodes)))
    out = {r.id: r for r in done.collect()}
    assert [out[f"00{i}"].status for i in (0, 1, 2, 3, 4, 9)] == ["node_exact", "node_exact", "ambiguous", "osm_fallback", "unresolved", "unresolved"]
    assert out["001"].name == "TOUBA" and out["001"].osm_id == "1" and [c.id for c in out["002"].candidates] == [3, 4]
    out_file = tmp_path / "places.geojson"
    with pytest.raises(ValueError, match="009"):  # a point out of range stops the batch
        resolve_batch(spark, str(tmp_path / "points.csv"), str(reverse), str(nodes), str(out_file))
    assert not out_file.exists()
    (tmp_path / "good.csv").write_text("".join((tmp_path / "points.csv").read_text().splitlines(keepends=True)[:-1]))
    counts = resolve_batch(spark, str(tmp_path / "good.csv"), str(reverse), str(nodes), str(out_file))
    assert counts == {"node_exact": 2, "ambiguous": 1, "osm_fallback": 1, "unresolved": 1}
    written = json.loads(out_file.read_text())
    assert [f["properties"]["id"] for f in written["features"]] == ["000", "001", "002", "003", "004"] and written["type"] == "FeatureCollection"
    none = resolve_batch(spark, _headed(tmp_path), str(reverse), str(nodes), str(out_file))
    assert none == {} and json.loads(out_file.read_text())["features"] == []
    made = [json.loads(r.feature) for r in toponyms.features(done).collect()]
    assert all(f["geometry"]["type"] == "Point" for f in made) and any(f["properties"].get("message") for f in made)


def _headed(tmp_path):
    (tmp_path / "none.csv").write_text("id,latitude,longitude\n")
    return str(tmp_path / "none.csv")


def _utm(lon, lat, zone, south):
    """Forward Krueger series: easting and northing."""
    import math

    f = 1 / 298.257223563
    n = f / (2 - f)
    size = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    p, d, e = math.radians(lat), math.radians(lon - (6 * zone - 183)), 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(math.sin(p)) - e * math.atanh(e * math.sin(p)))
    a, b = math.atan2(t, math.cos(d)), math.atanh(math.sin(d) / math.hypot(1, t))
    x = b + sum(k * math.cos(2 * j * a) * math.sinh(2 * j * b) for j, k in enumerate(alpha, 1))
    y = a + sum(k * math.sin(2 * j * a) * math.cosh(2 * j * b) for j, k in enumerate(alpha, 1))
    return 500_000 + size * x, size * y + (10_000_000 if south else 0)


def test_plane_coordinates(spark):
    """There and back within a hundred-millionth of a degree, and a known place."""
    spots = [(31, False, 2.2945, 48.8582), (33, False, 15.0, 0.0), (56, True, 151.2153, -33.8568), (1, False, -179.9, 83.0), (60, True, 174.5, -79.9)]
    for zone, south, lon, lat in spots:
        x, y = _utm(lon, lat, zone, south)
        got = spark.range(1).select(geo.from_projected(F.lit(x), F.lit(y), f"EPSG:{327 if south else 326}{zone:02}").alias("p")).first()["p"]
        assert (got["lon"], got["lat"]) == (pytest.approx(lon, abs=1e-8), pytest.approx(lat, abs=1e-8))
    assert _utm(2.2945, 48.8582, 31, False) == (pytest.approx(448251.8, abs=1), pytest.approx(5411932.7, abs=1))
    edge = spark.range(1).select(geo.from_projected(F.lit(20037508.342789244), F.lit(20037508.342789244), "EPSG:3857").alias("p")).first()["p"]
    assert (edge["lon"], edge["lat"]) == (pytest.approx(180.0), pytest.approx(85.0511287798))
    assert geo.can_transform("epsg:32760") and not geo.can_transform("EPSG:32661") and not geo.can_transform("EPSG:2154")


def test_radius_join_is_brute_force(spark):
    import math
    import random

    rng = random.Random(9)
    spot = lambda: (rng.choice([rng.uniform(-90, 90), rng.uniform(88, 90), rng.uniform(-1, 1)]), rng.choice([rng.uniform(-180, 180), rng.uniform(179, 180), rng.uniform(-180, -179)]))
    a, b = [(i, *spot()) for i in range(150)], [(i, *spot()) for i in range(150)]

    def metres(x, y):
        p, q = (math.radians(v[0]) for v in (x, y))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(y[1] - x[1]) / 2) ** 2
        return 2 * 6371000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    for radius in (40_000.0, 300_000.0):
        got = {(r.p, r.n) for r in toponyms.within_radius(spark.createDataFrame(a, "p int, lat double, lon double"), spark.createDataFrame(b, "n int, node_lat double, node_lon double"), radius).collect()}
        assert got == {(x[0], y[0]) for x in a for y in b if metres(x[1:], y[1:]) <= radius}


def test_a_cluster_must_name_its_shared_folder(spark):
    from types import SimpleNamespace as Fake

    def session(master, folder=None):
        none = Fake(isDefined=lambda: False)
        return Fake(conf=Fake(get=lambda *_: folder, set=lambda *_: None), sparkContext=Fake(master=master, _jsc=Fake(sc=lambda: Fake(getCheckpointDir=lambda: none))))

    assert durable.shared_folder(session("yarn", "hdfs:///x")) == "hdfs:///x"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            durable.shared_folder(session(master))
    table = durable.written(spark.range(3))
    assert table.count() == 3
    durable.discard(table)
    with pytest.raises(Exception):
        spark.read.parquet(table._assayer_path)


def test_inputs(spark, tmp_path):
    (tmp_path / "iso.tab").write_text("# comment\nNA\tNamibia\nSN\tSenegal\n")
    assert sorted(r.code for r in inputs.read_country_codes(spark, str(tmp_path / "iso.tab")).collect()) == ["NA", "SN"]
    (tmp_path / "e.csv").write_text('a,b\n" x ",NA\n,"q""t"\n')
    assert [tuple(r) for r in inputs.read_external_csv(spark, str(tmp_path / "e.csv")).collect()] == [(" x ", "NA", 1), ("", 'q"t', 2)]
    assert {"NA", "FI", "SN"} <= set(inputs.iso_countries(spark)) and "QQ" not in inputs.iso_countries(spark)
    for bad in ({"x": 1}, {"max_cells": 0.5}, {"missing_token": ""}, {"enrich_toponyms": "yes"}, {"references": {"z": {}}}):
        with pytest.raises(ValueError):
            inputs.check_config(bad)
