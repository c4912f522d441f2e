"""The general problems against brute force, and their defined cases."""

import math
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from humusgrid.operators import spatial, units
from humusgrid.operators.components import connected_components
from humusgrid.operators.orphans import Reference, all_orphans, orphan_references, orphan_report

REF = Reference("child", "id", "ref", "at", "parent", "key", "since", "until")
DAY = [datetime(2024, 1, d) for d in range(1, 30)]


def test_orphans_cases(spark):
    parent = spark.createDataFrame([("A", DAY[5], None, 1), ("a ", DAY[3], None, 1), ("gone", DAY[0], DAY[4], 1), (None, DAY[0], None, 1)], "key string, since timestamp, until timestamp, id int")
    child = spark.createDataFrame(
        [("1", " a\t", DAY[4]), ("2", "A", DAY[1]), ("3", "GONE", DAY[9]), ("4", "none", DAY[9]), ("5", None, DAY[9]), ("6", "  ", DAY[9]), ("7", "x", None), ("8", "a", None), ("4", "none", DAY[9]), (None, "none", DAY[2])],
        "id string, ref string, at timestamp",
    ).withColumn("since", F.lit("clash"))
    got = sorted((r["child_key"] or "", r["state"]) for r in orphan_references(child, parent, REF).collect())
    assert got == [("", "missing"), ("2", "late"), ("3", "deleted"), ("4", "missing"), ("4", "missing"), ("7", "missing")]
    empty = orphan_references(child.limit(0), parent, REF)
    assert empty.count() == 0
    assert orphan_references(child, parent.limit(0), REF).count() == 8
    report = {(r["month"], r["state"]): r["orphans"] for r in orphan_report(all_orphans([(child, parent, REF)])).collect()}
    assert report[("2024-01", "missing")] == 3 and report[(None, "missing")] == 1


def test_references_between_two_lives_of_a_parent(spark):
    parent = spark.createDataFrame(
        [("k", DAY[0], DAY[10]), ("k", DAY[20], DAY[25]), ("o", DAY[0], DAY[5]), ("o", DAY[9], None), ("n", None, DAY[3]), ("k", DAY[0], DAY[10]), ("b", DAY[8], DAY[2])], "key string, since timestamp, until timestamp"
    )
    rows = [("in", "k", 5), ("edge", "k", 10), ("gap", "k", 15), ("back", "k", 22), ("after", "k", 27), ("o gap", "o", 7), ("o on", "o", 27), ("n on", "n", 1), ("n after", "n", 4), ("b", "b", 9)]
    child = spark.createDataFrame([(i, k, DAY[d]) for i, k, d in rows] + [("none", "k", None)], "id string, ref string, at timestamp")
    got = {r["child_key"]: r["state"] for r in orphan_references(child, parent, REF).collect()}
    assert got == {k: "deleted" for k in ("gap", "after", "o gap", "n after", "b")}


def test_orphan_plan_merges_sorted_sides(spark):
    parent = spark.range(10).select(F.col("id").cast("string").alias("key"), F.lit(DAY[0]).alias("since"), F.lit(None).cast("timestamp").alias("until"))
    child = parent.select(F.col("key").alias("id"), F.col("key").alias("ref"), F.col("since").alias("at"))
    plan = orphan_references(child, parent, REF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize(
    ("text", "unit"),
    [("мг·кг⁻¹", "mg/kg"), ("mg / kg", "mg/kg"), ("(mg kg−1)", "mg/kg"), ("mg per kg", "mg/kg"), ("мг на 100 г", "mg/100g"), ("mg 100 g-1", "mg/100g"), ("млн⁻¹", "ppm"), ("(cmol(+) kg-1)", "cmolc/kg"),
     ("мг-экв./100 г почвы", "meq/100g"), ("µS cm-1", "uS/cm"), ("кгс/см²", "kgf/cm2"), ("градусы Цельсия", "C"), ("м/сут", "m/day"), ("wt. %", "%"), ("kg dm-3", "kg/dm3"), ("prcent", "%"), ("dS m-1 ", "dS/m")],
)
def test_unit_spellings(text, unit):
    assert unit in units.match_spelling(text)


@pytest.mark.parametrize("text", ["", "  ", None, "zg/kg", "parsec", "mg", "x" * 100])
def test_no_unit(text):
    assert units.match_spelling(text) == []


def test_units_in_long_texts():
    assert units.match_spelling("mg/kg" + " " * 500) == ["mg/kg"] and units.match_spelling("(" * 50 + "mg/kg" + ")" * 50) == ["mg/kg"]
    assert units.find_unit("Exchangeable potassium of the upper layer " * 400 + "mg / 100 g", "mass_fraction", False) == "mg/100g"
    assert units.match_spelling("x" * 1_000_000) == [] and units.match_spelling("mg/kg " * 20_000) == []


def test_headers_state_units_of_their_kind_only():
    assert units.find_unit("Available K", "mass_fraction", False) is None
    assert units.find_unit("Soil temperature, К", "temperature", False) == "K"
    assert units.find_unit("pH (H2O) [ед. pH]", "acidity", False) == "pH"
    assert units.find_unit("Corg g kg−1", "mass_fraction", False) == "g/kg"


def test_wrong_normalizations(spark):
    d = spark.createDataFrame([("soc", "g/kg"), ("soil_temperature", "C"), ("odd", "smoot"), ("soc", "g/kg"), (None, "g/kg")], "property_id string, canonical_unit string")
    c = spark.createDataFrame(
        [("ok", "soc", 1.5, None, "%", None), ("off", "soc", None, "1,5 %", None, None), ("f", "soil_temperature", 50.0, None, None, "T (°F)"), ("none", "soc", None, None, "%", None), ("nounit", "soc", 3.0, None, None, "SOC"),
         ("nan", "soc", float("nan"), "2e1", "g/kg", None), ("old", "soc", 2.0, None, "g/kg", None), ("null", "soc", 2.0, None, "g/kg", None), ("ok", "soc", 1.5, None, "%", None), (None, "soc", 2.0, None, "g/kg", None), ("alone", "soc", 2.0, None, "g/kg", None), ("odd", "odd", 2.0, None, "g/kg", None)],
        "candidate_id string, property_id string, value_num double, value_text string, unit_raw string, property_header_raw string",
    ).withColumn("kind", F.lit("clash"))
    n = spark.createDataFrame(
        [("ok", 15.0, "г/кг", DAY[1]), ("off", 1.5, "g/kg", DAY[1]), ("f", 283.15, "K", DAY[1]), ("none", 1.0, "g/kg", DAY[1]), ("nounit", 9.0, "g/kg", DAY[1]), ("nan", 20.1, "g/kg", DAY[1]), ("old", 7.0, "g/kg", DAY[1]), ("old", 2.0, "g/kg", DAY[2]), ("old", 7.0, "g/kg", None), ("null", None, None, DAY[1]), ("odd", 1.0, "g/kg", DAY[1])],
        "candidate_id string, value_normalized double, unit_normalized string, normalized_at timestamp",
    ).withColumn("normalizer_version", F.lit("v1"))
    assert sorted(r[0] for r in units.wrong_normalizations(c, n, d).select("candidate_id").collect()) == ["null", "off"]
    assert units.wrong_normalizations(c.limit(0), n, d).count() == 0
    assert units.wrong_normalizations(c, n.limit(0), d).count() == 0
    assert units.wrong_normalizations(c, n, d.limit(0)).count() == 0
    made = {r["candidate_id"]: r["value_canonical"] for r in units.convert_measurements(c, d).collect()}
    assert made["off"] == pytest.approx(15.0) and made["f"] == pytest.approx(10.0) and made["none"] is None


def _points(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rng.random() < 0.5:
            rows.append((f"s{i}", rng.uniform(-90, 90), rng.uniform(-180, 180)))
        else:
            at = rng.choice([(60.0, 100.0), (-17.0, 180.0), (89.999, 10.0), (0.0, -179.999), (-89.9995, 0.0)])
            lon = (at[1] + rng.uniform(-0.02, 0.02) * (50 if abs(at[0]) > 89 else 1) + 180) % 360 - 180
            rows.append((f"s{i}", max(-90.0, min(90.0, at[0] + rng.uniform(-0.02, 0.02))), lon))
    return rows


def _km(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def test_near_points_match_brute_force(spark):
    rows = _points(400, 1)
    rows += [rows[0], ("copy", *rows[1][1:]), ("edge", -17.0, 180.0), ("edge2", -17.0, -180.0)]
    bad = [("n", None, 1.0), ("m", 1.0, None), ("nan", float("nan"), 1.0), ("far", 91.0, 0.0), ("zero", 0.0, 0.0), (None, 60.0, 100.0)]
    df = spark.createDataFrame(rows + bad, "id string, latitude double, longitude double").withColumn("cell", F.lit("clash"))
    want = {tuple(sorted((a[0], b[0]))) for a in rows for b in rows if a[0] != b[0] and _km(a, b) <= 1.0}
    got = [tuple(r) for r in spatial.points_near_points(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    assert spatial.points_near_points(df.limit(0)).count() == 0


def test_regions_match_brute_force(spark):
    rng = random.Random(2)
    regions = [(f"r{i}", rng.uniform(-89, 89), rng.uniform(-180, 180), rng.choice([1.0, 50.0, 400.0, 3000.0, 11000.0])) for i in range(60)] + [("pole", 90.0, 0.0, 500.0), ("all", 10.0, 20.0, 30000.0), ("r0b", 5.0, 180.0, 700.0)]
    bad = [("x", 1.0, 1.0, None), ("x", 1.0, 1.0, 0.0), ("x", 1.0, 1.0, -5.0), ("x", None, 1.0, 5.0), (None, 1.0, 1.0, 5.0), ("x", 1.0, 1.0, float("nan"))]
    points = _points(600, 3) + [("np", 90.0, 33.0), ("sp", -90.0, 0.0)]
    p = spark.createDataFrame(points, "id string, latitude double, longitude double").withColumn("name", F.lit("clash"))
    r = spark.createDataFrame(regions + bad + regions[:3], "name string, latitude double, longitude double, radius_km double").withColumn("id", F.lit("clash"))
    want = {(a[0], b[0]) for a in points for b in regions if _km(a, (b[0], b[1], b[2])) <= b[3]}
    for group, salted in ((1024, 100_000), (20, 7)):
        before, spatial.POINTS = spatial.POINTS, salted
        got = [(x["id"], x["name"]) for x in spatial.points_in_regions(p, r, group).collect()]
        spatial.POINTS = before
        assert len(got) == len(set(got)) and set(got) == want
    assert spatial.points_in_regions(p, r.limit(0)).count() == 0 and spatial.points_in_regions(p.limit(0), r).count() == 0


def test_slabs_have_ordered_edges():
    s = spatial.build_slabs([spatial.disc_edges(*d) for d in ((10.0, 0.0, 400.0), (12.0, 1.0, 300.0), (11.0, 0.5, 250.0))])
    for k in range(len(s.cuts) - 1):
        e = slice(s.first_edge[k], s.first_edge[k + 1])
        mid = s.west[e] + s.slope[e] / 2
        assert (np.diff(mid) >= 0).all() and len(mid) % 2 == 0
        assert s.cover[s.first_edge[k] + k] == 0 == s.cover[s.first_edge[k + 1] + k]


def test_many_overlapping_regions_stay_small():
    rng = random.Random(4)
    shapes = [spatial.disc_edges(55 + rng.uniform(-1, 1), 60 + rng.uniform(-2, 2), rng.uniform(50, 300)) for _ in range(1000)]
    held = [spatial.build_slabs(shapes[k : k + spatial.SHAPES]) for k in range(0, 1000, spatial.SHAPES)]
    assert sum(a.nbytes for s in held for a in (s.cuts, s.first_edge, s.west, s.slope, s.cover)) < 200_000_000
    lat, lon = np.array([55.0, 56.2, 40.0]), np.array([60.0, 61.0, 60.0])
    found = sum(len(s.locate(lat, lon, True)[0]) for s in held)
    assert 300 < found < 2000


def _in_ring(x, y, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def test_polygons_match_ray_casting(spark):
    rng = random.Random(11)
    polygons = []
    for i in range(40):
        cx, cy, size = rng.uniform(-150, 150), rng.uniform(-70, 70), rng.choice([0.5, 4.0, 20.0])
        n = rng.randrange(3, 30)
        ring = [(cx + size * rng.uniform(0.4, 1) * math.cos(2 * math.pi * k / n), cy + size * rng.uniform(0.4, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        hole = [(cx + size * 0.1 * a, cy + size * 0.1 * b) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
        polygons.append((f"p{i % 30}", [ring + ring[:1], hole] if i % 3 == 0 else [ring]))
    square = [(10.0, 10.0), (12.0, 10.0), (12.0, 12.0), (10.0, 12.0)]
    polygons += [("sq", [square]), ("none", None), ("line", [[(0.0, 0.0), (1.0, 1.0)]]), (None, [square])]
    points = [(f"a{i}", rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(400)]
    points += [(f"b{i}", p[1][0][0][1] + rng.uniform(-3, 3), p[1][0][0][0] + rng.uniform(-3, 3)) for i, p in enumerate(polygons[:40] * 5)]
    points += [("low", 10.0, 11.0), ("top", 12.0, 11.0), ("west", 11.0, 10.0), ("east", 11.0, 12.0), ("bad", None, 1.0), ("corner", 10.0, 10.0)]
    want = set()
    for i, y, x in points:
        for name, rings in polygons:
            if name and rings and y is not None and len(rings[0]) > 2 and _in_ring(x, y, rings[0][:-1] if rings[0][0] == rings[0][-1] else rings[0]) and not any(_in_ring(x, y, h) for h in rings[1:]):
                want.add((i, name))
    p = spark.createDataFrame(points, "id string, latitude double, longitude double")
    q = spark.createDataFrame([(n, [[list(c) for c in r] for r in rs] if rs else None) for n, rs in polygons], "name string, rings array<array<array<double>>>").withColumn("lat", F.lit("clash"))
    got = [tuple(r) for r in spatial.points_in_polygons(p, q).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    assert {i for i, n in want if n == "sq"} >= {"low", "west"} and spatial.points_in_polygons(p, q.limit(0)).count() == 0


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(f"v{i}", f"v{i + 1}") for i in range(60)] + [("hub", f"h{i}") for i in range(50)] + [(f"x{rng.randrange(40)}", f"x{rng.randrange(40)}") for _ in range(30)] + [("loop", "loop"), ("a", "b"), ("b", "a"), ("a", "b")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, (None, "q"), ("q", None)], "src string, dst string").withColumn("u", F.lit(1))
    got = {r["id"]: r["component"] for r in connected_components(df, "src", "dst").collect()}
    assert got == {v: find(v) for v in root}
    assert connected_components(df.limit(0), "src", "dst").count() == 0
