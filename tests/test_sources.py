"""Readers, free SQL and export on small files."""

import json
import math

import pytest
from pyspark.sql import functions as F

from humusgrid.operators import merge, places, stats
from humusgrid.sources import files, sql


def test_broken_json_lines_are_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x", "n": 1}\n{"id": "y", "n": \n{"id": "z"}\n', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"id": "w", "n": 4}\n', encoding="utf-8")
    good, broken = files.parsed_and_broken(files.read_json_lines(spark, str(tmp_path), "id string, n int"))
    assert sorted((r["id"], r["n"]) for r in good.collect()) == [("w", 4), ("x", 1), ("z", None)]
    assert {r["file"]: r["broken"] for r in broken.collect()} == {"a.json": 1, "b.json": 0}


def test_catalogue_and_index(spark, tmp_path):
    (tmp_path / "new.json").write_text(json.dumps({"articles": [{"article_id": "a1", "year": 1990, "article_url": "u1"}, {"article_id": "a2", "year": None, "article_url": "u2"}]}), encoding="utf-8")
    (tmp_path / "old.json").write_text(json.dumps([{"article_id": "a1", "title": "One"}, {"article_id": "zz", "title": "Gone"}]), encoding="utf-8")
    got = [tuple(r) for r in files.read_catalogue(spark, str(tmp_path / "new.json"), str(tmp_path / "old.json")).orderBy("article_id").collect()]
    assert got == [("a1", 1990, "u1", "One"), ("a2", None, "u2", None)]
    for d in ("meta", "md"):
        (tmp_path / d).mkdir()
    for k in (1, 2):
        (tmp_path / "meta" / f"c{k}.json").write_text(json.dumps({"source_pdf": f"p{k}.pdf", "start_page": k}), encoding="utf-8")
    (tmp_path / "md" / "c1.md").write_text("| a |", encoding="utf-8")
    rows = {r["stem"]: r for r in files.index_scans(spark, str(tmp_path / "meta"), str(tmp_path / "md"), "source_pdf string, start_page int").collect()}
    assert (rows["c1"]["text"], rows["c1"]["has_text"], rows["c2"]["text"], rows["c2"]["has_text"], rows["c2"]["start_page"]) == ("| a |", True, "", False, 2)


def test_resumed_work_is_not_done_again(spark, tmp_path):
    folder = str(tmp_path / "cache")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    work = lambda df: df.select("id", (F.col("n") * 10).alias("m"))
    assert files.resumed(spark, rows.limit(1), "id", folder, work).count() == 1
    changed = rows.withColumn("n", F.col("n") + 5)
    got = {r["id"]: r["m"] for r in files.resumed(spark, changed, "id", folder, work).collect()}
    assert sorted(got) == ["a", "b"] and sorted(got.values()) in ([10, 70], [20, 60])


def test_export_is_gated_and_counted(spark, tmp_path):
    frames = {"one": spark.createDataFrame([("x", 'say "hi"\nthere'), ("y", None)], "id string, t string").coalesce(1), "none": spark.createDataFrame([], "id string").coalesce(1)}
    bad = spark.createDataFrame([("orphans", 2), ("fine", 0)], "check string, rows int")
    with pytest.raises(ValueError, match="orphans"):
        files.export_package(frames, str(tmp_path / "p"), bad)
    out = [r for r in files.export_package(frames, str(tmp_path / "p"), bad.filter("rows = 0")).collect() if r["file"].endswith(".csv")]
    assert sorted(r["rows"] or 0 for r in out) == [0, 2] and all(len(r["sha256"]) == 64 and r["bytes"] >= 0 for r in out)


def test_free_sql(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "numbers.parquet"))
    assert sql.open_views(spark, str(tmp_path)) == ["numbers"]
    assert sql.statements("select ';' as a -- no; end\n; select 2;") == ["select ';' as a", "select 2"]
    assert sql.run_sql(spark, "select count(*) as n from numbers where id > :low", low=1).first()["n"] == 3
    assert sql.answer(spark, "select id from numbers order by id", 2) == (["id"], [(0,), (1,)], 5, None)
    assert sql.answer(spark, "select nothing from nowhere")[3] and sql.answer(spark, " ; ")[3] == "no statement"


def test_coordinates_and_utm(spark):
    text = "x" * 50_000 + " 55°45′12″N, 37°37′4.5″E; N 51.50, E 45.25; 40.50 E, 60.25 N; 53° 30.5′ с. ш., 60° 10′ в. д.; UTM zone 37N 412345 E, 6123456; 99.99 N, 10.00 E; 12.5"
    df = spark.createDataFrame([("a", text), ("b", None), ("c", "")], "id string, t string")
    got = {(r["notation"], round(r["latitude"], 4), round(r["longitude"], 4)) for r in places.coordinates(df, "id", "t").collect()}
    assert {("seconds", 55.7533, 37.6179), ("decimal_leading", 51.5, 45.25), ("decimal_reversed", 60.25, 40.5), ("minutes_russian", 53.5083, 60.1667)} <= got
    utm = next(g for g in got if g[0] == "utm")
    assert 55.2 < utm[1] < 55.3 and 37.5 < utm[2] < 37.7 and len(got) == 5


def test_regions_prose_and_lines(spark):
    texts = spark.createDataFrame([("d", "Altai krai and Altai were described in many other papers before. Soils of Nizhny Novgorod oblast and Novgorod were seen by the authors in these summers. Moscow State University."), ("e", None)], "d string, t string")
    names = spark.createDataFrame([("Novgorod", "subject"), ("Nizhny Novgorod", "subject"), ("Altai", "macroregion"), ("Moscow", "subject")], "name string, kind string")
    mentions = places.region_mentions(texts, names, "d", "t", beside=25)
    assert {r["name"]: r["mentions"] for r in mentions.collect()} == {"Nizhny Novgorod": 4, "Novgorod": 1, "Altai": 5}
    ranked = [(r["name"], r["rank"], r["attribution"]) for r in places.study_regions(mentions, names, "d").orderBy("rank").collect()]
    assert ranked == [("Nizhny Novgorod", 1, "dominant_region"), ("Novgorod", 2, "dominant_region")]
    prose = spark.createDataFrame([("p", "In horizon Bt (20–40 cm) the total nitrogen reached 1,5 g/kg there. The clay.\n12 %")], "id string, t string")
    r = places.prose_properties(prose, "id", "t").collect()
    assert [(x["property_id"], x["value"], x["unit"], x["depth_top"], x["depth_bottom"], x["horizon"]) for x in r] == [("total_nitrogen", 1.5, "g/kg", 20.0, 40.0, "Bt")]
    lines = spark.createDataFrame([("t", "A1 0-10 1,5 2.0\nA2 10-20 1\nbad\nB 20–30 3 4")], "id string, t string")
    assert [(x["label"], x["top"], x["values"]) for x in places.positional_lines(lines, "id", "t", 2).orderBy("line").collect()] == [("A1", 0, [1.5, 2.0]), ("B", 20, [3.0, 4.0])]
    parts = places.text_segments(lines, "id", "t", r"[AB]\d?", 5).collect()
    assert [p["segment"] for p in parts] == ["A1 0-", "A2 10", "B 20–"]


def test_names(spark):
    one = spark.createDataFrame([("Щёлковского района", "Тверской области", "Орёл-Изумруд")], "a string, b string, c string")
    r = one.select(places.nominative(F.col("a")).alias("a"), places.nominative(F.col("b")).alias("b"), places.transliterated(F.col("c")).alias("c"), places.place_tokens(F.lit("Московская область (Russia)")).alias("t")).first()
    assert (r["a"], r["b"], r["c"], r["t"]) == ("Щёлковский район", "Тверская область", "orel-izumrud", ["moskovskaya"])
    keys = spark.createDataFrame([("Humus Humus Humus",), (r"Ca ^{2+}",), ("CEC",), ("C : N",), (None,)], "h string").select(places.header_key(F.col("h")).alias("k"), places.curated_property(F.col("h")).alias("p")).collect()
    assert [(k["k"], k["p"]) for k in keys] == [("humus", "organic_matter"), ("ca2+", "calcium_ion"), ("cec", "cation_exchange_capacity"), ("c:n", "carbon_nitrogen_ratio"), ("", None)]


def test_p_values():
    assert stats.sign_p(2, 8) == pytest.approx(0.109375) and stats.sign_p(0, 0) == 1.0 and stats.sign_p(5, 5) == 1.0
    assert stats.student_p(2.228, 10) == pytest.approx(0.05, abs=1e-4) and stats.student_p(0.0, 5) == pytest.approx(1.0)
    assert stats.sign_p(400_000, 402_000) == pytest.approx(math.erfc(2000 / math.sqrt(802_000) / math.sqrt(2)), rel=1e-2)


def test_moran_and_thinning(spark):
    points = spark.createDataFrame([(f"p{i}", float(i % 5)) for i in range(25)], "id string, value double")
    pairs = spark.createDataFrame([(f"p{i}", f"p{j}", 1.0 + abs(i % 5 - j % 5)) for i in range(25) for j in range(25) if f"p{i}" < f"p{j}"], "id_a string, id_b string, km double")
    r = stats.moran_p(points, pairs, 39, 1).first()
    assert r["n"] == 25 and r["moran_i"] > 0 and r["p"] <= 0.1
    rows = spark.createDataFrame([(i, i % 4, float(i), 2.0 * i) for i in range(40)], "id int, c int, x double, y double")
    got = stats.thinned_slopes(rows, ["c"], "id", "x", "y", 5, 7).collect()
    assert len(got) == 5 and all(g["n"] == 4 and g["slope"] == pytest.approx(2.0) for g in got)


def test_keyed_writes(spark):
    t = spark.createDataFrame([("a", "old", 1), ("b", "keep", 2), (None, "none", 3)], "k string, v string, n int")
    changes = spark.createDataFrame([("a", "new"), ("b", "no"), ("c", None)], "k string, v string")
    got = {r["k"]: (r["v"], r["n"]) for r in merge.conditional_upsert(t, changes, "k", F.col("v") == "keep", ["v"]).collect()}
    assert got == {"a": ("new", 1), "b": ("keep", 2), None: ("none", 3), "c": (None, None)}
    left = merge.delete_where({"p": t, "c": changes, "x": t}, F.col("v") == "old", "p", "k", ["c"])
    assert sorted(str(r["k"]) for r in left["p"].collect()) == ["None", "b"] and sorted(r["k"] for r in left["c"].collect()) == ["b", "c"] and left["x"].count() == 3
    assert sorted(str(r["k"]) for r in merge.sweep_orphans(t, changes.filter("k = 'a'"), "k").collect()) == ["None", "a"]


def test_named_terms_and_contexts(spark):
    from humusgrid.functions import rules

    df = spark.createDataFrame([("a", "Carbon by Tyurin, then by dry combustion; nitrogen by Kjeldahl.\nICP-MS followed. Duma's house."), ("b", None)], "id string, t string")
    got = {(r["kind"], r["term"]) for r in places.named_terms(df, "id", "t", rules.METHODS).collect()}
    assert got == {("soc_tyurin", "Tyurin"), ("soc_dry_combustion", "dry combustion"), ("nitrogen_kjeldahl", "Kjeldahl"), ("metals_icp_ms", "ICP-MS")}
    where = spark.createDataFrame([("x", "Pits in Verkhny Altai Krai and in the Nizhny Novgorod district")], "id string, t string")
    assert {(r["kind"], r["term"]) for r in places.named_terms(where, "id", "t", rules.PLACES, case=True).collect()} == {("region", "Verkhny Altai Krai"), ("district", "Nizhny Novgorod district")}
    texts = ["Soil samples were taken here", "The institute, university press", "samples were taken, university of X", "institute; soil profile investigated at university", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", places.is_study_context(F.col("t")).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in rows] == [True, False, True, True, False]


def test_split_tables_and_statistics(spark):
    from humusgrid.operators import matrix

    cells = spark.createDataFrame([("a", 1, 2, "12,5 ± 0.4 mg/kg"), ("a", 1, 3, "7 +/- 1"), ("a", 1, 4, "12.5"), ("a", 1, 5, None)], "artifact_id string, row_index int, column_index int, text_raw string")
    assert [(r["candidate_id"], r["value_num"], r["spread"], r["unit"]) for r in matrix.statistical_cells(cells).orderBy("column_index").collect()] == [("a:tm-stat:r1:c2", 12.5, 0.4, "mg/kg"), ("a:tm-stat:r1:c3", 7.0, 1.0, None)]
    tables = spark.createDataFrame([("h", "d", 1, 1, 4, 2), ("b", "d", 1, 2, 4, 30), ("n", "d", 1, 3, 4, 2), ("m", "d", 1, 4, 4, 20), ("w", "d", 2, 1, 5, 1)], "artifact_id string, document_id string, page int, number int, columns int, rows int")
    headers = spark.createDataFrame([("h", "pH H2O"), ("h", "P2O5, mg"), ("n", "layer 10"), ("b", "5")], "artifact_id string, header string")
    assert [tuple(r) for r in matrix.split_headers(tables, headers).collect()] == [("h", "b")]
