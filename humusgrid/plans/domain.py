"""Domain operators over the measurement tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.functions import rules
from humusgrid.operators import merge
from humusgrid.operators.components import connected_components
from humusgrid.operators.extract import dms_coordinates
from humusgrid.operators.headers import classify_headers
from humusgrid.operators.matrix import adjacent_continuations, cell_candidates
from humusgrid.operators.matrix import statistical_cells as read_statistics
from humusgrid.operators.orphans import key_form
from humusgrid.operators.places import is_study_context, named_terms
from humusgrid.operators.quality import decoded_year, horizon_of, plausibility, safe_conversion
from humusgrid.plans.registry import Registry, Tables
from humusgrid.streaming.incremental import windowed_totals

R = Registry()
# The SQL states its constants for itself.
_TO_G = "'soil_organic_carbon', 'total_nitrogen', 'total_phosphorus', 'total_potassium', 'inorganic_carbon'"
_TO_PCT = "'organic_matter', 'carbonate_equivalent', 'base_saturation', 'porosity', 'sand', 'silt', 'clay', 'field_capacity', 'wilting_point', 'water_holding_capacity'"
_UNIT = "replace(replace(replace(replace(replace(lower(unit_raw), ' ', ''), '³', '3'), 'мг', 'mg'), 'г', 'g'), 'см', 'cm')"
_FORM = f"""CASE {_UNIT} WHEN 'mg/kg' THEN 'mg/kg' WHEN 'g/kg' THEN 'g/kg' WHEN '%' THEN '%' WHEN 'ds/m' THEN 'dS/m' WHEN 'g/cm3' THEN 'g/cm3'
WHEN 'cmol(c)/kg' THEN 'cmolc/kg' WHEN 'cmolc/kg' THEN 'cmolc/kg' ELSE unit_raw END"""
_RANGE = """(VALUES
    ('ph_h2o', 2.0, 12.0), ('ph_kcl', 2.0, 12.0), ('ph_unspecified', 2.0, 12.0), ('bulk_density', 0.05, 2.65),
    ('particle_density', 1.0, 4.0), ('soil_organic_carbon', 0.0, 600.0), ('total_nitrogen', 0.0, 50.0), ('total_potassium', 0.0, 60.0),
    ('soil_depth', 0.0, 2000.0), ('flow_depth', 0.0, 2000.0), ('layer_depth', 0.0, 2000.0), ('soil_moistening_depth', 0.0, 2000.0),
    ('leaf_length', 0.0, 2000.0), ('root_length', 0.0, 2000.0), ('iron', 0.0, 300000.0), ('zinc', 0.0, 50000.0),
    ('copper', 0.0, 50000.0), ('nickel', 0.0, 50000.0), ('manganese', 0.0, 50000.0), ('mercury', 0.0, 1000.0),
    ('nitrate_n', 0.0, 5000.0), ('mineral_nitrogen', 0.0, 5000.0), ('available_phosphorus', 0.0, 20000.0), ('total_dissolved_solids', 0.0, 500.0),
    ('calcium', 0.0, 100.0), ('magnesium', 0.0, 100.0), ('calcium_ion', 0.0, 200.0), ('magnesium_ion', 0.0, 200.0),
    ('sodium_ion', 0.0, 200.0), ('potassium_ion', 0.0, 200.0), ('chloride_ion', 0.0, 200.0), ('sulfate_ion', 0.0, 200.0),
    ('bicarbonate_ion', 0.0, 200.0), ('hydrogen_ion', 0.0, 200.0), ('ammonium_ion', 0.0, 200.0)
) AS g(range_of, lo, hi)"""
_PERCENT = """
    'sand', 'coarse_sand', 'fine_sand', 'silt', 'clay', 'physical_clay',
    'porosity', 'base_saturation', 'aggregate_stability', 'organic_matter', 'carbonate_equivalent', 'exchangeable_sodium_percentage',
    'gravimetric_water_content', 'field_capacity', 'wilting_point', 'water_holding_capacity', 'vegetation_pole_density', 'soil_cover_percentage',
    'coarse_silt', 'medium_silt', 'fine_silt', 'very_coarse_sand', 'fine_fraction_lt_0_001mm', 'silicon_dioxide',
    'iron_oxide_fe2o3', 'aluminum_oxide_al2o3', 'calcium_oxide_cao', 'magnesium_oxide_mgo', 'potassium_oxide_k2o', 'sodium_oxide_na2o',
    'titanium_dioxide', 'manganese_oxide_mno', 'phosphorus_pentoxide', 'potassium_oxide'"""
_CONTENT = """
    'organic', 'macronutrient', 'exchange', 'particle_size', 'microelement', 'contaminant',
    'salinity', 'biological', 'hydrophysical', 'elemental_oxide', 'soil_solution', 'geochemical',
    'vegetation', 'erosion', 'hydrological', 'hydrometeorological'"""
_CONVERT = f"""SELECT candidate_id, property_id, category, value_num AS raw, u, canonical_unit,
CASE WHEN value_num IS NULL OR u IS NULL THEN NULL WHEN u = canonical_unit THEN value_num WHEN u = 'g/kg' AND canonical_unit = 'mg/kg' THEN value_num * 1000 WHEN u = 'mg/kg' AND canonical_unit = 'g/kg' THEN value_num / 1000
WHEN u = '%' AND canonical_unit = 'g/kg' AND property_id IN ({_TO_G}) THEN value_num * 10 WHEN u = 'g/kg' AND canonical_unit = '%' AND property_id IN ({_TO_PCT}) THEN value_num / 10 END AS v,
CASE WHEN value_num IS NULL THEN 'missing_value' WHEN u IS NULL THEN 'missing_unit' WHEN u = canonical_unit THEN 'exact' WHEN (u = 'g/kg' AND canonical_unit = 'mg/kg') OR (u = 'mg/kg' AND canonical_unit = 'g/kg')
OR (u = '%' AND canonical_unit = 'g/kg' AND property_id IN ({_TO_G})) OR (u = 'g/kg' AND canonical_unit = '%' AND property_id IN ({_TO_PCT})) THEN 'converted' ELSE 'incompatible' END AS status
FROM (SELECT *, nullif({_FORM}, '') AS u FROM normalized_table_measurement_candidates JOIN property_definition USING (property_id))"""


def _converted(t: Tables) -> DataFrame:
    rows = t.normalized_table_measurement_candidates.join(t.property_definition, "property_id")
    out = rows.withColumn("c", safe_conversion(F.col("value_num"), F.col("unit_raw"), F.col("canonical_unit"), F.col("property_id")))
    return out.select("candidate_id", "property_id", "category", F.col("value_num").alias("raw"), "unit_raw", F.col("c.value").alias("v"), F.col("c.status").alias("status"))


@R.query(f"SELECT candidate_id, property_id, v, status FROM ({_CONVERT})")
def unit_convert(t: Tables) -> DataFrame:
    return _converted(t).select("candidate_id", "property_id", "v", "status")


_VERDICT = f"""SELECT candidate_id, property_id, CASE WHEN v IS NULL THEN 'unchecked' WHEN (status IN ('exact', 'converted') OR property_id LIKE 'ph\\_%' ESCAPE '\\') AND (v < lo OR v > hi) THEN 'out_of_physical_range'
WHEN property_id IN ({_PERCENT}) AND trim(canonical_unit) = '%' AND (v < 0 OR v > 100) THEN 'out_of_physical_range'
WHEN v < 0 AND category IN ({_CONTENT}) AND property_id NOT IN ('redox_potential', 'soil_temperature') THEN 'negative_content' ELSE 'ok' END AS verdict
FROM ({_CONVERT}) LEFT JOIN {_RANGE} ON property_id = range_of"""


def _judged(t: Tables) -> DataFrame:
    rows = _converted(t).join(t.property_definition.select("property_id", "canonical_unit"), "property_id")
    return rows.withColumn("judged", plausibility(F.col("property_id"), F.col("category"), F.col("v"), F.col("canonical_unit"), F.col("status")))


@R.query(f"SELECT property_id, verdict, count(*) AS n FROM ({_VERDICT}) GROUP BY 1, 2")
def plausibility_flags(t: Tables) -> DataFrame:
    return _judged(t).groupBy("property_id", F.col("judged.verdict").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@R.query(f"""SELECT property_id, count(*) AS rows, count(*) FILTER (WHERE verdict = 'ok') AS trusted, count(*) FILTER (WHERE verdict NOT IN ('ok', 'unchecked')) AS affected FROM ({_VERDICT}) GROUP BY 1
ORDER BY affected DESC, property_id LIMIT 15""")
def quality_report(t: Tables) -> DataFrame:
    """Checked values by property; the 15 most affected ones (a top-k report)."""
    v = F.col("judged.verdict")
    out = _judged(t).groupBy("property_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(v == "ok").alias("trusted"), F.count_if(~v.isin("ok", "unchecked")).alias("affected"))
    return out.orderBy(F.desc("affected"), "property_id").limit(15)


@R.query("""WITH s AS (SELECT document_id, count(DISTINCT site_id) AS k, min(site_id) AS site FROM reported_site WHERE document_id IS NOT NULL GROUP BY 1)
SELECT substr(sha1(candidate_id), 1, 24) AS observation_id, candidate_id, CASE WHEN k = 1 THEN site END AS site_id, CASE WHEN k IS NULL THEN 'none' WHEN k = 1 THEN 'single_site_context' ELSE 'multiple_sites' END AS linkage,
CASE candidate_status WHEN 'accepted' THEN 'accepted' WHEN 'rejected' THEN 'rejected' ELSE 'flagged' END AS qa FROM (SELECT DISTINCT candidate_id, document_id, candidate_status FROM normalized_table_measurement_candidates) c LEFT JOIN s USING (document_id)""")
def linkage_materialize(t: Tables) -> DataFrame:
    """One observation per candidate, linked to the document's site where it has exactly one."""
    s = t.reported_site.filter("document_id is not null").groupBy("document_id").agg(F.count_distinct("site_id").alias("k"), F.min("site_id").alias("site"))
    rows = t.normalized_table_measurement_candidates.select("candidate_id", "document_id", "candidate_status").distinct().join(s, "document_id", "left")
    qa = F.when(F.col("candidate_status").isin("accepted", "rejected"), F.col("candidate_status")).otherwise("flagged")
    link = F.when(F.col("k").isNull(), "none").when(F.col("k") == 1, "single_site_context").otherwise("multiple_sites")
    return rows.select(F.substring(F.sha1("candidate_id"), 1, 24).alias("observation_id"), "candidate_id", F.when(F.col("k") == 1, F.col("site")).alias("site_id"), link.alias("linkage"), qa.alias("qa"))


@R.query("""WITH i AS (SELECT o_orderkey, 'S1064229' || (o_orderkey % 10) || lpad(CAST(o_orderkey * 7 % 100 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey * 13 % 100 AS VARCHAR), 2, '0') || '123X' AS art FROM orders), p AS (SELECT o_orderkey, CAST(substr(art, 10, 2) AS INTEGER) AS y, CAST(substr(art, 12, 2) AS INTEGER) AS b FROM i)
SELECT o_orderkey, CASE WHEN y <= 68 THEN 2000 + y ELSE 1900 + y END AS year, CASE WHEN b < 60 THEN 'issue_number' ELSE 'submission_year' END AS confidence, CASE WHEN b < 60 THEN 0 ELSE 1 END AS uncertainty FROM p""")
def year_decode(t: Tables) -> DataFrame:
    two = lambda k: F.lpad((F.col("o_orderkey") * k % 100).cast("string"), 2, "0")
    art = F.concat(F.lit("S1064229"), (F.col("o_orderkey") % 10).cast("string"), two(7), two(13), F.lit("123X"))
    return t.orders.select("o_orderkey", decoded_year(art).alias("d")).select("o_orderkey", "d.year", "d.confidence", "d.uncertainty")


@R.query()
def header_classes(t: Tables) -> DataFrame:
    """Property and kind of match of every distinct column header."""
    return classify_headers(t.normalized_table_measurement_candidates, "property_header_raw")


@R.query("""SELECT header, property FROM (SELECT DISTINCT property_header_raw AS header, CASE WHEN starts_with(h, 'penetration resistance') THEN 'penetration_resistance' WHEN starts_with(h, 'organic carbon') OR starts_with(h, 'corg') OR starts_with(h, 'soc') OR starts_with(h, 'органический углерод') THEN 'soil_organic_carbon'
WHEN starts_with(h, 'soil temperature') OR starts_with(h, 'температура почвы') THEN 'soil_temperature' WHEN starts_with(h, 'available k') OR starts_with(h, 'подвижный калий') THEN 'available_potassium' WHEN starts_with(h, 'available p') OR starts_with(h, 'подвижный фосфор') THEN 'available_phosphorus'
WHEN starts_with(h, 'ksat') OR starts_with(h, 'коэффициент фильтрации') THEN 'saturated_hydraulic_conductivity' WHEN starts_with(h, 'bulk density') OR starts_with(h, 'плотность сложения') THEN 'bulk_density' WHEN starts_with(h, 'total n') OR starts_with(h, 'общий азот') THEN 'total_nitrogen' WHEN starts_with(h, 'sand') OR starts_with(h, 'песок') THEN 'sand'
WHEN starts_with(h, 'humus') OR starts_with(h, 'organic matter') OR starts_with(h, 'гумус') THEN 'organic_matter' WHEN starts_with(h, 'ph (h2o)') OR starts_with(h, 'ph водный') THEN 'ph_h2o' WHEN starts_with(h, 'electrical conductivity') OR h = 'ec' OR regexp_matches(h, '^ec[ ,:\\[(]') THEN 'electrical_conductivity' WHEN starts_with(h, 'clay') THEN 'clay'
WHEN starts_with(h, 'cec') THEN 'cation_exchange_capacity' WHEN starts_with(h, 'обменный кальций') THEN 'exchangeable_calcium' WHEN h = 'eh' OR regexp_matches(h, '^eh[ ,:\\[(]') THEN 'redox_potential' END AS property FROM (SELECT property_header_raw, lower(property_header_raw) AS h FROM normalized_table_measurement_candidates)) WHERE property IS NOT NULL""")
def header_phrases(t: Tables) -> DataFrame:
    """Headers whose property is named by a phrase."""
    return classify_headers(t.normalized_table_measurement_candidates, "property_header_raw").filter("kind = 'phrase'").select("header", "property")


@R.query()
def matrix_candidates(t: Tables) -> DataFrame:
    """Candidates re-derived from cells: the measurement tables laid out as grids, headers above values."""
    rows = t.normalized_table_measurement_candidates.filter("value_text is not null and artifact_id is not null")
    body = rows.select("artifact_id", (F.col("row_index") + 1).alias("row_index"), "column_index", F.col("value_text").alias("text_raw"), F.lit(1).alias("rowspan"))
    head = rows.groupBy("artifact_id", "column_index").agg(F.max("property_header_raw").alias("text_raw")).select("artifact_id", F.lit(0).alias("row_index"), "column_index", "text_raw", F.lit(1).alias("rowspan"))
    labels = rows.filter("row_label_raw is not null").groupBy("artifact_id", "row_index").agg(F.max("row_label_raw").alias("text_raw")).select("artifact_id", (F.col("row_index") + 1).alias("row_index"), F.lit(0).alias("column_index"), "text_raw", F.lit(1).alias("rowspan"))
    return cell_candidates(head.unionByName(body).unionByName(labels))


@R.query("""WITH l AS (SELECT row_label_raw AS s, regexp_extract(row_label_raw, '(?i)^[\\[\\(]?(?:O|H|A|AE|E|EL|BT|B|BC|C|R|AY|AУ|АY|АЕ|А|В|С|D)[0-9a-zа-я’′˙.]{0,6}[\\]\\)]?') AS h FROM normalized_table_measurement_candidates WHERE horizon_label IS NULL AND row_label_raw IS NOT NULL)
SELECT h AS horizon, count(*) AS n FROM l WHERE h <> '' AND h NOT IN ('Bismuth', 'Burozem', 'Clay', 'Contro', 'Control', 'Ditto', 'High', 'Object', 'Высокие', 'Am.s.', 'Oc.l.', 'A304', 'AlCl3', 'CATq', 'C0rr', 'RZAM')
AND regexp_matches(substr(s, length(h) + 1), '^[\\s,;|/()\\[\\]~*"''’′-]{0,6}[0-9]+\\s*[–—-]\\s*[0-9]+') GROUP BY 1""")
def horizon_backfill(t: Tables) -> DataFrame:
    """Horizon read from the row label where none is stored."""
    rows = t.normalized_table_measurement_candidates.filter("horizon_label is null and row_label_raw is not null").withColumn("horizon", horizon_of(F.col("row_label_raw")))
    return rows.filter("horizon is not null").groupBy("horizon").agg(F.count(F.lit(1)).alias("n"))


@R.query()
def dms_extract(t: Tables) -> DataFrame:
    """Coordinates in degrees, minutes and seconds anywhere in the extracted texts."""
    return dms_coordinates(t.extraction.filter("raw_text is not null"), "extraction_id", "raw_text", 0, None)


_SECONDS = "floor(({0} * 60 - floor({0} * 60)) * 60 + 0.5)"


@R.query(f"""WITH s AS (SELECT DISTINCT candidate_id, latitude, longitude, abs(latitude) AS a, abs(longitude) AS o FROM location_candidate WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND candidate_id IS NOT NULL)
SELECT candidate_id, CASE WHEN latitude < 0 THEN -1 ELSE 1 END * (floor(a) + floor((a - floor(a)) * 60) / 60 + {_SECONDS.format("a")} / 3600) AS latitude, CASE WHEN longitude < 0 THEN -1 ELSE 1 END * (floor(o) + floor((o - floor(o)) * 60) / 60 + {_SECONDS.format("o")} / 3600) AS longitude
FROM s WHERE {_SECONDS.format("a")} <= 59 AND {_SECONDS.format("o")} <= 59""")
def precise_coordinate(t: Tables) -> DataFrame:
    """Coordinate of a text in degrees, minutes and seconds; here of the candidates' contexts, behind which their coordinate is printed."""
    rows = t.location_candidate.filter("latitude between -90 and 90 and longitude between -180 and 180 and candidate_id is not null")

    def printed(x: Column, negative: str, positive: str) -> Column:
        a = F.abs(x)
        seconds = F.floor((a * 60 - F.floor(a * 60)) * 60 + 0.5)
        return F.concat(F.format_string("%d°%d′%d″ ", F.floor(a), F.floor((a - F.floor(a)) * 60), seconds), F.when(x < 0, negative).otherwise(positive))

    # every row keeps its number: candidates may be stored twice, with and without a context
    text = F.concat_ws(" ", "context_text", F.lit("The pit lies at"), printed(F.col("latitude"), "S", "N"), F.lit("and"), printed(F.col("longitude"), "W", "E"))
    texts = rows.select("candidate_id", text.alias("text")).distinct()
    return dms_coordinates(texts, "candidate_id", "text", 0, None).select("candidate_id", "latitude", "longitude").distinct()


@R.query("""SELECT c.o_custkey, c.total, coalesce(n.o_orderpriority, c.pri) AS pri FROM (SELECT o_custkey, sum(o_totalprice) AS total, 'none' AS pri FROM orders GROUP BY 1) c
LEFT JOIN (SELECT o_custkey, arg_max(o_orderpriority, struct_pack(o_orderdate, o_orderkey)) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) n USING (o_custkey)""")
def upsert_merge(t: Tables) -> DataFrame:
    target = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"), F.lit("none").alias("pri"))
    newest = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("pri"))
    return merge.upsert(target, newest, ["o_custkey"], ["pri"])


@R.query("""WITH RECURSIVE e AS (SELECT retired_site_id AS a, canonical_site_id AS b FROM site_merge UNION SELECT canonical_site_id, retired_site_id FROM site_merge), r AS (SELECT a, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.a),
g AS (SELECT a AS id, min(m) AS part FROM r GROUP BY 1), k AS (SELECT part, coalesce(min(id) FILTER (WHERE id NOT IN (SELECT retired_site_id FROM site_merge WHERE retired_site_id IS NOT NULL AND canonical_site_id <> retired_site_id)), part) AS survivor FROM g GROUP BY 1)
SELECT coalesce(survivor, site_id) AS site_id, count(*) AS profiles FROM profile LEFT JOIN g ON site_id = id LEFT JOIN k USING (part) GROUP BY 1""")
def key_redirect(t: Tables) -> DataFrame:
    """References follow chains of merges to the last survivor; of a loop, or of several last ones, the smallest id stays."""
    log = merge.final_survivors(t.site_merge, "retired_site_id", "canonical_site_id")
    return merge.redirect_key(t.profile, "site_id", log, "id", "survivor").groupBy("site_id").agg(F.count(F.lit(1)).alias("profiles"))


@R.query("""WITH c AS (SELECT 'site_without_document' AS "check", count(*) AS rows FROM reported_site WHERE document_id IS NULL UNION ALL SELECT 'profile_without_site', count(*) FROM profile WHERE site_id NOT IN (SELECT site_id FROM reported_site WHERE site_id IS NOT NULL)
UNION ALL SELECT 'negative_depth', count(*) FROM normalized_table_measurement_candidates WHERE depth_bottom_cm < depth_top_cm) SELECT *, (SELECT max(rows) FROM c) = 0 AS ready FROM c""")
def audit_zero_counts(t: Tables) -> DataFrame:
    return merge.zero_counts({
        "site_without_document": t.reported_site.filter("document_id is null"),
        "profile_without_site": t.profile.filter("site_id is not null").join(t.reported_site, "site_id", "left_anti"),
        "negative_depth": t.normalized_table_measurement_candidates.filter("depth_bottom_cm < depth_top_cm"),
    })


@R.query("""WITH RECURSIVE e AS (SELECT retired_site_id AS a, canonical_site_id AS b FROM site_merge UNION SELECT canonical_site_id, retired_site_id FROM site_merge), r AS (SELECT a, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.a)
SELECT a AS id, min(m) AS component FROM r GROUP BY 1""")
def components(t: Tables) -> DataFrame:
    return connected_components(t.site_merge, "retired_site_id", "canonical_site_id")


@R.query("SELECT date_trunc('hour', ts) AS start, user_id, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
def hourly_windows(t: Tables) -> DataFrame:
    """Extension: tumbling windows, the same plan as on a stream."""
    return windowed_totals(t.events, "ts", "user_id", "value")


@R.query("""SELECT count(*) AS rows, count(DISTINCT p.profile_id) AS profiles FROM profile_evidence e JOIN profile p ON lower(trim(e.profile_id, chr(9)||chr(10)||chr(13)||' '||chr(160))) = lower(trim(p.profile_id, chr(9)||chr(10)||chr(13)||' '||chr(160)))""")
def case_blind_join(t: Tables) -> DataFrame:
    """Join on keys that differ in letter case and blanks around them."""
    a = t.profile_evidence.select(key_form(F.col("profile_id")).alias("k"))
    b = t.profile.select(key_form(F.col("profile_id")).alias("k"), "profile_id")
    return a.join(b, "k").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("profile_id").alias("profiles"))


_CANDIDATES = "SELECT DISTINCT artifact_id, row_index, column_index, floor(abs(value_num) * 100 + 0.5) / 100 AS v, floor(abs(value_num) * 10 + 0.5) / 100 AS d FROM normalized_table_measurement_candidates WHERE value_num IS NOT NULL AND NOT isnan(value_num) AND abs(value_num) < 1000000 AND artifact_id IS NOT NULL"


@R.query(f"""SELECT artifact_id || ':tm-stat:r' || row_index || ':c' || column_index AS candidate_id, v AS value_num, d AS spread FROM ({_CANDIDATES})""")
def statistical_cells(t: Tables) -> DataFrame:
    """Means with their spread read back from cells; the cells are printed from the candidates' numbers."""
    rows = t.normalized_table_measurement_candidates.filter("value_num is not null and not isnan(value_num) and abs(value_num) < 1000000 and artifact_id is not null")
    text = F.format_string("%.2f ± %.2f %%", F.floor(F.abs("value_num") * 100 + 0.5) / 100, F.floor(F.abs("value_num") * 10 + 0.5) / 100)
    return read_statistics(rows.select("artifact_id", "row_index", "column_index", text.alias("text_raw")).distinct()).select("candidate_id", "value_num", "spread")


@R.query("""WITH c AS (SELECT artifact_id, count(DISTINCT column_index) AS columns FROM normalized_table_measurement_candidates GROUP BY 1), t AS (SELECT DISTINCT a.artifact_id, a.document_id, a.page_start, CAST(regexp_extract(a.table_label, '[0-9]+') AS INTEGER) AS number, columns FROM source_artifact a JOIN c USING (artifact_id) WHERE a.document_id IS NOT NULL AND regexp_matches(a.table_label, '[0-9]+')),
n AS (SELECT artifact_id, columns, number, lead(artifact_id) OVER w AS next_id, lead(number) OVER w AS next_number, lead(columns) OVER w AS next_columns FROM t WINDOW w AS (PARTITION BY document_id ORDER BY number, artifact_id))
SELECT artifact_id, next_id FROM n WHERE next_number = number + 1 AND next_columns = columns""")
def header_continuation(t: Tables) -> DataFrame:
    """Tables of a document that the next one continues: one number on, as wide."""
    columns = t.normalized_table_measurement_candidates.groupBy("artifact_id").agg(F.count_distinct("column_index").alias("columns"))
    number = F.regexp_extract("table_label", "[0-9]+", 0)
    tables = t.source_artifact.filter("document_id is not null").filter(number != "").select("artifact_id", "document_id", F.lit(0).alias("page"), number.cast("int").alias("number")).distinct().join(columns, "artifact_id")
    return adjacent_continuations(tables)


@R.query("""WITH s AS (SELECT document_id, count(DISTINCT site_id) AS k, min(site_id) AS site FROM reported_site WHERE document_id IS NOT NULL GROUP BY 1), o AS (SELECT artifact_id, min(profile_id) AS profile FROM profile_evidence WHERE evidence_kind = 'table_row' AND artifact_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT profile_id) = 1),
n AS (SELECT candidate_id, max(value_normalized) AS v, max(unit_normalized) AS u, max(normalization_status) AS st FROM table_measurement_candidate_normalization GROUP BY 1), c AS (SELECT DISTINCT candidate_id, artifact_id, document_id, property_id, row_index, column_index, candidate_status FROM normalized_table_measurement_candidates)
SELECT substr(sha1(candidate_id), 1, 24) AS observation_id, candidate_id, canonical_name AS property, category, v AS value_normalized, u AS unit_normalized, coalesce(st, 'missing') AS normalization_status, CASE WHEN k = 1 THEN site END AS context_site_id, profile AS profile_id,
CASE WHEN profile IS NOT NULL THEN 'row_profile_verified' WHEN k IS NULL THEN 'none' WHEN k = 1 THEN 'single_site_context' ELSE 'multiple_sites' END AS spatial_linkage, CASE WHEN profile IS NOT NULL THEN 'flagged' WHEN candidate_status IN ('accepted', 'rejected') THEN candidate_status ELSE 'flagged' END AS qa_status,
to_json(struct_pack(artifact := artifact_id, "row" := row_index, "column" := column_index)) AS evidence_locator FROM c JOIN property_definition USING (property_id) LEFT JOIN n USING (candidate_id) LEFT JOIN s USING (document_id) LEFT JOIN o USING (artifact_id)""")
def materialized_observations(t: Tables) -> DataFrame:
    """Observations with property, unit, quality, place and the cell they came from; a verified row link overrides the document's sites."""
    s = t.reported_site.filter("document_id is not null").groupBy("document_id").agg(F.count_distinct("site_id").alias("k"), F.min("site_id").alias("site"))
    o = t.profile_evidence.filter("evidence_kind = 'table_row' and artifact_id is not null").groupBy("artifact_id").agg(F.count_distinct("profile_id").alias("p"), F.min("profile_id").alias("profile")).filter("p = 1").drop("p")
    n = t.table_measurement_candidate_normalization.groupBy("candidate_id").agg(F.max("value_normalized").alias("v"), F.max("unit_normalized").alias("u"), F.max("normalization_status").alias("st"))
    c = t.normalized_table_measurement_candidates.select("candidate_id", "artifact_id", "document_id", "property_id", "row_index", "column_index", "candidate_status").distinct()
    rows = c.join(t.property_definition, "property_id").join(n, "candidate_id", "left").join(s, "document_id", "left").join(o, "artifact_id", "left")
    linked = F.col("profile").isNotNull()
    place = F.when(linked, "row_profile_verified").when(F.col("k").isNull(), "none").when(F.col("k") == 1, "single_site_context").otherwise("multiple_sites")
    qa = F.when(linked, "flagged").when(F.col("candidate_status").isin("accepted", "rejected"), F.col("candidate_status")).otherwise("flagged")
    locator = F.to_json(F.struct(F.col("artifact_id").alias("artifact"), F.col("row_index").alias("row"), F.col("column_index").alias("column")), {"ignoreNullFields": "false"})
    return rows.select(
        F.substring(F.sha1("candidate_id"), 1, 24).alias("observation_id"), "candidate_id", F.col("canonical_name").alias("property"), "category", F.col("v").alias("value_normalized"), F.col("u").alias("unit_normalized"), F.coalesce("st", F.lit("missing")).alias("normalization_status"),
        F.when(F.col("k") == 1, F.col("site")).alias("context_site_id"), F.col("profile").alias("profile_id"), place.alias("spatial_linkage"), qa.alias("qa_status"), locator.alias("evidence_locator"),
    )


@R.query("""SELECT property_id, count(*) AS rows FROM normalized_table_measurement_candidates WHERE property_id IN ('total_nitrogen', 'available_phosphorus', 'available_potassium') AND property_header_raw IS NOT NULL
AND NOT regexp_matches(lower(property_header_raw), CASE property_id WHEN 'total_nitrogen' THEN '^(total n|общий азот)' WHEN 'available_phosphorus' THEN '^(available p|подвижный фосфор)' ELSE '^(available k|подвижный калий)' END) GROUP BY 1""")
def contaminated_properties(t: Tables) -> DataFrame:
    """Rows of three properties whose header the classifier reads otherwise: what a repair would change."""
    c = t.normalized_table_measurement_candidates.filter("property_id in ('total_nitrogen', 'available_phosphorus', 'available_potassium') and property_header_raw is not null")
    found = classify_headers(c, "property_header_raw")
    rows = c.join(found, F.col("property_header_raw") == F.col("header"), "left")
    return rows.filter(~F.col("property").eqNullSafe(F.col("property_id"))).groupBy("property_id").agg(F.count(F.lit(1)).alias("rows"))


@R.query()
def method_mentions(t: Tables) -> DataFrame:
    """Laboratory methods named in texts."""
    return named_terms(t.documents, "doc_id", "text", rules.METHODS).select("doc_id", "position", "kind", "term")


@R.query("""SELECT document_id, count(*) AS terms FROM (SELECT document_id, unnest(regexp_extract_all(title, '(?i)(?:chernozem(?:ic)?|phaeozem|kastanozem|retisol|podzol(?:ic)?|cambisol|fluvisol|gleysol|leptosol|solonetz|solonchak|arenosol|histosol|cryosol)(?:$|[^a-zа-яё0-9_])')) AS term FROM document WHERE regexp_full_match(title, '[A-Za-z0-9 ,.:-]+')) GROUP BY 1""")
def soil_terms(t: Tables) -> DataFrame:
    """Names of soils in titles of plain Latin letters: their number for each document."""
    rows = t.document.filter(F.col("title").rlike("^[A-Za-z0-9 ,.:-]+$"))
    return named_terms(rows, "document_id", "title", {"soil": rules.DESCRIPTIONS["soil"]}).groupBy("document_id").agg(F.count(F.lit(1)).alias("terms"))


@R.query()
def promoted_places(t: Tables) -> DataFrame:
    """Accepted coordinates inside the country whose context says that the place was studied, one label each."""
    rows = t.location_candidate.filter("status = 'accepted' and country_candidate = 'RU' and latitude between 41 and 82 and longitude between 19 and 180")
    kept = rows.filter(is_study_context(F.col("context_text")))
    one = kept.groupBy("extraction_id").agg(F.count_distinct("place_text").alias("n")).filter("n = 1").select("extraction_id")
    return kept.join(one, "extraction_id", "left_semi").select("candidate_id", "extraction_id", "place_text", "latitude", "longitude").distinct()
