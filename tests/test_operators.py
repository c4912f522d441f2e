"""Operators without SQL: golden cases and brute force."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from humusgrid.operators import aggregate, joins, matrix, merge, stats
from humusgrid.operators.extract import dms_coordinates
from humusgrid.operators.headers import classify_headers
from humusgrid.operators.quality import datum_of, decoded_year, horizon_of, plausibility, safe_conversion
from humusgrid.sources import files
from humusgrid.streaming.incremental import latest, start_merge


def test_headers(spark):
    golden = {
        "exchangeable Ca2+": "calcium_ion", "coarse sand, %": "sand", "Zn, mg/kg": "zinc", "B 1.583 2.273": None, r"pH\( _{H_2O} \)": "ph_h2o", "Общий азот": "total_nitrogen",
        "физическая глина": "physical_clay", "1-0.25 mm": "coarse_sand", "Thickness of horizons, cm A + B": "boron", "": None,
    }
    df = spark.createDataFrame([(h,) for h in golden] + [(None,), ("Zn, mg/kg",)], "h string")
    got = {r["header"]: r for r in classify_headers(df, "h").collect()}
    assert {h: r["property"] for h, r in got.items()} == golden
    assert got["Thickness of horizons, cm A + B"]["kind"] == "symbol_embedded" and got["Zn, mg/kg"]["kind"] == "symbol_clean"


@pytest.mark.parametrize(
    ("value", "unit", "canonical", "prop", "want"),
    [(2.0, "g/kg", "mg/kg", "x", (2000.0, "converted")), (3.0, "%", "g/kg", "soil_organic_carbon", (30.0, "converted")), (3.0, "%", "mg/kg", "sulfur", (None, "incompatible")), (5.0, "ppm", None, "x", (5.0, "exact")),
     (5.0, "мг/кг", "mg/kg", "x", (None, "incompatible")), (1.2, "г/см³", "g/cm3", "x", (1.2, "exact")), (None, "%", "%", "x", (None, "missing_value")), (1.0, None, "%", "x", (None, "missing_unit"))],
)
def test_safe_conversion(spark, value, unit, canonical, prop, want):
    df = spark.createDataFrame([(value, unit, canonical, prop)], "v double, u string, c string, p string")
    r = df.select(safe_conversion(*[F.col(x) for x in "vucp"]).alias("r")).first()["r"]
    assert (r["value"], r["status"]) == want


def test_strict_conversion_knows_cyrillic_kilograms(spark):
    r = spark.range(1).select(safe_conversion(F.lit(5.0), F.lit("мг/кг"), F.lit("mg/kg"), F.lit("x"), strict=True).alias("r")).first()["r"]
    assert (r["value"], r["status"]) == (5.0, "exact")


def test_plausibility(spark):
    cases = [("unclassified_table_metric", "u", 10001.0, "cm", "exact", "out_of_physical_range"), ("unclassified_table_metric", "u", 101.0, "%", "exact", "out_of_physical_range"), ("unclassified_table_metric", "u", 100.0, "mg/kg", "exact", "ok"),
             ("unclassified_table_metric", "u", 1e7, None, "missing_unit", "ok"), ("ph_h2o", "acid_base", 14.0, None, "missing_unit", "out_of_physical_range"), ("bulk_density", "physical", 9.0, "g/cm3", "missing_unit", "ok"),
             ("zinc", "microelement", -1.0, None, "missing_unit", "negative_content"), ("redox_potential", "geochemical", -10.0, "mV", "exact", "ok"), ("zinc", "microelement", None, "mg/kg", "exact", "unchecked")]
    df = spark.createDataFrame(cases, "p string, c string, v double, u string, s string, want string")
    rows = df.select("want", plausibility(*[F.col(x) for x in "pcvus"])["verdict"].alias("got")).collect()
    assert all(r["want"] == r["got"] for r in rows), rows


def test_year_horizon_datum(spark):
    df = spark.createDataFrame([("S1064229308071234", "A1, 0-10", "coords in WGS 84, see map")], "i string, h string, t string")
    r = df.select(decoded_year(F.col("i")).alias("y"), horizon_of(F.col("h")).alias("h"), horizon_of(F.lit("Control 0-10")).alias("n"), datum_of(F.col("t")).alias("d")).first()
    assert r["h"] == "A1" and r["n"] is None and r["d"]["datum"] == "WGS-84" and "coords in" in r["d"]["snippet"]
    assert (r["y"]["year"], r["y"]["confidence"], r["y"]["uncertainty"]) == (2008, "issue_number", 0)


def test_dms(spark):
    text = "x" * 1200 + " site 66°25'N, 67°18'E and 95°10'N 10°10'E; 10°00'S " + "y" * 300 + " 20°00'E"
    got = dms_coordinates(spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string"), "id", "t").collect()
    assert [(r["id"], round(r["latitude"], 5), round(r["longitude"], 5)) for r in got] == [(1, 66.41667, 67.3)]


def test_matrix(spark):
    cells = [("t", 0, 0, "Horizon", 1), ("t", 0, 1, "Zn, mg/kg", 1), ("t", 0, 2, "pH (H2O)", 1), ("t", 1, 0, "0-10", 2), ("t", 1, 1, "12,5", 1), ("t", 1, 2, "6.1", 1), ("t", 2, 0, "late", 1), ("t", 2, 1, "13 g/kg", 1), ("t", 2, 2, "6.2", 1)]
    df = spark.createDataFrame(cells, "artifact_id string, row_index int, column_index int, text_raw string, rowspan int")
    got = {r["candidate_id"]: r for r in matrix.cell_candidates(df).collect()}
    assert got["t:tm:r1:c1"]["value_num"] == 12.5 and got["t:tm:r1:c1"]["unit_raw"] == "mg/kg" and got["t:tm:r2:c1"]["unit_raw"] == "g/kg" and got["t:tm:r1:c2"]["unit_raw"] == "pH"
    assert got["t:tm:r2:c2"]["row_label"] == "0-10" and got["t:tm:r2:c2"]["depth_bottom_cm"] == 10.0  # the spanning cell wins
    assert matrix.cell_candidates(df.limit(0)).count() == 0


def test_html_tables(spark):
    html = "<p>x</p><table><tr><th rowspan='2x'>a</th><th colspan=2> b  c </th></tr><tr><td>1<td>2</tr></table><table><td>z</table>"
    got = [tuple(r) for r in files.html_cells(spark.createDataFrame([(7, html), (8, None)], "id int, html string"), "id", "html").collect()]
    assert got == [(7, 0, 0, 0, "a", 2, 1), (7, 0, 0, 1, "b c", 1, 2), (7, 0, 1, 1, "1", 1, 1), (7, 0, 1, 2, "2", 1, 1), (7, 1, 0, 0, "z", 1, 1)]


def test_file_sources(spark, tmp_path):
    (tmp_path / "d1.txt").write_bytes("тест".encode() + b"\xff")
    assert files.read_texts(spark, str(tmp_path)).first()["document_id"] == "d1"
    (tmp_path / "a_p3_t2.json").write_text('{"data": [["x", ""], ["1", "2"]]}')
    assert files.read_matrices(spark, str(tmp_path / "*.json")).count() == 3
    files.write_csv(spark.createDataFrame([(1, 'a "q", b')], "i int, s string"), str(tmp_path / "csv"))
    assert files.read_csv(spark, str(tmp_path / "csv"), "i int, s string").first()["s"] == 'a "q", b'
    assert files.manifest(spark, str(tmp_path / "csv")).filter("file like '%.csv'").first()["bytes"] > 0


def test_merge_operators(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    c = spark.createDataFrame([(2, None, 5), (3, "n", 6), (3, "m", 7)], "k int, v string, w int")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(merge.upsert(t, c, ["k"], ["v", "w"], order="w", keep_old_where_null=True)) == [(1, "a", 1), (2, "b", 5), (3, "m", 7)]
    assert [r[0] for r in rows(merge.insert_missing(t, c, ["k"]))] == [1, 2, 3]
    assert (2, None, 5) in [tuple(r) for r in merge.replace_rows(t, c, ["k"]).collect()]
    assert rows(merge.delete_rows(t, c, ["k"])) == [(1, "a", 1)]
    log = spark.createDataFrame([(1, 9)], "r int, c int")
    assert [r[0] for r in rows(merge.redirect_key(t, "k", log, "r", "c"))] == [2, 9]
    new, old = merge.with_history(t, c.filter("k = 2"), ["k"], ["v", "w"])
    assert rows(old) == [(2, "b", 2)] and new.count() == 2


def test_mixed_model_finds_planted_slope(spark):
    rng = np.random.default_rng(1)
    rows = [("p", f"g{g}", float(x), float(2.5 * x + u + rng.normal(0, 0.3))) for g, u in enumerate(rng.normal(0, 2, 80)) for x in rng.uniform(0, 1, 5 + g % 7)]
    r = stats.random_intercept(spark.createDataFrame(rows, "k string, g string, x double, y double"), ["k"], "g", "x", "y").first()
    assert r["slope"] == pytest.approx(2.5, abs=0.15) and 0.9 < r["icc"] < 1 and r["groups"] == 80


def test_moran(spark):
    pts = spark.createDataFrame([(i, float(i)) for i in range(6)], "id int, value double")
    pairs = spark.createDataFrame([(i, i + 1, 1.0) for i in range(5)], "id_a int, id_b int, km double")
    v = np.arange(6) - 2.5
    assert stats.moran_i(pts, pairs).first()["moran_i"] == pytest.approx(6 * (v[:-1] * v[1:]).sum() / (5 * (v * v).sum()))


def test_small_cases(spark):
    one = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 3.0), ("g", None)], "k string, v double")
    assert aggregate.lower_percentiles(one, ["k"], "v", (0.75,)).first()["p75"] == 2.0
    assert aggregate.gini(one.limit(0), "v").first()["gini"] is None
    left = spark.createDataFrame([(1, 5), (1, 1)], "k int, at int")
    right = spark.createDataFrame([(1, 5, "x"), (1, 3, "y")], "k int, at int, v string")
    assert sorted((r["at"], r["matched_v"]) for r in joins.asof(left, right, ["k"], "at", "at", ["v"]).collect()) == [(1, None), (5, "x")]
    assert sorted((r["at"], r["matched_v"]) for r in joins.asof(left, right, ["k"], "at", "at", ["v"], forward=True).collect()) == [(1, "y"), (5, None)]


def test_incremental_merge_equals_full_run(spark, tmp_path):
    source = tmp_path / "in"
    rows = [(i % 7, i, datetime(2024, 1, 1)) for i in range(40)]
    for k in range(4):
        spark.createDataFrame(rows[k * 10 : k * 10 + 10], "k int, v int, at timestamp").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("k int, v int, at timestamp").parquet(str(source))
        start_merge(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], ["v", "at"], order="v").awaitTermination()
    got = {r["k"]: r["v"] for r in latest(spark, str(tmp_path / "out")).collect()}
    assert got == {k: max(v for x, v, _ in rows if x == k) for k in range(7)}


def test_order_statistics_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=3000), 2).tolist()
    rows = [("hot", v) for v in values] + [("few", 1.0), ("few", 3.0), (None, 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in aggregate.exact_quantiles(df.repartition(7), ["k"], "v", {"a": 0.1, "m": 0.5, "z": 1.0}).collect()}
    assert [got["hot"][c] for c in "amz"] == pytest.approx([np.quantile(values, q) for q in (0.1, 0.5, 1.0)])
    assert (got["few"]["m"], got["few"]["n"], got[None]["m"]) == (2.0, 2, 2.0) and "none" not in got
    low = {r["k"]: r["p50"] for r in aggregate.lower_percentiles(df, ["k"], "v", (0.5,)).collect()}
    assert low["hot"] == sorted(values)[(len(values) - 1) // 2] and low["few"] == 1.0
    assert aggregate.exact_quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0


def test_asof_over_a_hot_key(spark):
    rng = np.random.default_rng(5)
    left = [(i, "hot" if i % 3 else None, int(t)) for i, t in enumerate(rng.integers(0, 500, 900))] + [(9000, "hot", None)]
    right = [("hot", int(t), i) for i, t in enumerate(rng.integers(0, 500, 40))] + [(None, 5, 0)]
    a, b = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, t int, x int")
    for forward in (False, True):
        got = {r["i"]: (r["matched_at"], r["matched_x"]) for r in joins.asof(a, b, ["k"], "t", "t", ["x"], forward).collect()}
        for i, k, t in left:
            near = [(s, x) for kk, s, x in right if k and kk == k and t is not None and (s > t if forward else s <= t)]
            want = (min if forward else max)(near, key=lambda p: p) if near else (None, None)
            assert got[i] == want, (i, k, t, got[i], want)
        assert len(got) == len(left)


def test_label_in_text_and_zip(spark):
    texts = spark.createDataFrame([("d", 1, "At Kurgan-3 site, Kurgan 31 follows"), ("d", 2, None), ("e", 3, "Kurgan 3"), (None, 4, "Kurgan 3")], "d string, i int, t string")
    labels = spark.createDataFrame([("d", "a", "Kurgan 3"), ("d", "b", "kurgan-31"), ("d", "c", "gan 3"), ("d", "e", " - "), ("e", "f", None)], "d string, l string, n string")
    assert sorted(tuple(r) for r in joins.label_in_text(texts, labels, "d", "i", "t", "l", "n").collect()) == [(1, "a"), (1, "b")]
    points = spark.createDataFrame([("k", 1, 2.0, 5.0), ("k", 2, None, 6.0), ("k", 3, 3.0, None), ("one", 1, 1.0, 1.0), ("odd", 1, 1.0, None), ("odd", 2, 1.0, 2.0)], "k string, o int, a double, b double")
    assert [tuple(r) for r in joins.zip_lists(points, "k", "a", "b", "o").orderBy("position").collect()] == [("k", 0, 2.0, 5.0), ("k", 1, 3.0, 6.0)]


def test_zip_puts_rows_without_order_last(spark):
    """As in the SQL; a struct alone would order them first. NaN is a value."""
    points = spark.createDataFrame([("k", None, 1.0, 5.0), ("k", "b", 2.0, 6.0), ("k", None, 0.5, None), ("k", "a", None, float("nan"))], "k string, o string, a double, b double")
    assert [str(tuple(r)) for r in joins.zip_lists(points, "k", "a", "b", "o").orderBy("position").collect()] == ["('k', 0, 2.0, nan)", "('k', 1, 0.5, 6.0)", "('k', 2, 1.0, 5.0)"]


def test_redirects_follow_chains_and_loops(spark):
    log = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("s", "s"), (None, "q"), ("m", "n"), ("m", "o")], "r string, c string")
    got = {r["id"]: r["survivor"] for r in merge.final_survivors(log, "r", "c").collect()}
    assert got == {"a": "c", "b": "c", "c": "c", "x": "x", "y": "x", "s": "s", "m": "n", "n": "n", "o": "n"}
