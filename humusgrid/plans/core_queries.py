"""Queries of the general problems: units, places and references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from humusgrid.operators.orphans import Reference, all_orphans, orphan_report
from humusgrid.operators.spatial import points_in_regions, points_near_points
from humusgrid.operators.units import convert_measurements, wrong_normalizations
from humusgrid.sources.tables import load_table

REFERENCES = (
    Reference("source_artifact", "artifact_id", "document_id", "created_at", "document", "document_id", "created_at"),
    Reference("profile_evidence", "evidence_id", "profile_id", "created_at", "profile", "profile_id", "created_at"),
    Reference("table_measurement_candidate_normalization", "candidate_id", "candidate_id", "normalized_at", "normalized_table_measurement_candidates", "candidate_id", "extracted_at"),
)


def p3_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_measurements(load_table(spark, sf_dir, "normalized_table_measurement_candidates"), load_table(spark, sf_dir, "property_definition"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrong_normalizations(
        load_table(spark, sf_dir, "normalized_table_measurement_candidates"),
        load_table(spark, sf_dir, "table_measurement_candidate_normalization"),
        load_table(spark, sf_dir, "property_definition"),
    ).select("candidate_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = load_table(spark, sf_dir, "reported_site").select(F.col("site_id").alias("id"), "latitude", "longitude")
    regions = load_table(spark, sf_dir, "document_study_region").select(F.col("region_name").alias("name"), "latitude", "longitude", "radius_km")
    near = points_near_points(sites, 1.0).select(F.lit("site").alias("kind"), "id_a", "id_b")
    inside = points_in_regions(sites.filter("id is not null").distinct(), regions).select(F.lit("region").alias("kind"), F.col("id").alias("id_a"), F.col("name").alias("id_b"))
    return near.unionByName(inside.distinct())


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_orphans([(load_table(spark, sf_dir, r.child_table), load_table(spark, sf_dir, r.parent_table), r) for r in REFERENCES])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("child_table", "child_key").distinct()


def p5_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(_orphans(spark, sf_dir))


QUERIES = {"p3_found": p3_found, "p3_converted": p3_converted, "p4_found": p4_found, "p5_found": p5_found, "p5_monthly": p5_monthly}

_KEY = "lower(trim({}, chr(9)||chr(10)||chr(13)||' '||chr(160)))"


def _orphan_sql() -> str:
    parts = []
    for r in REFERENCES:
        child, parent = _KEY.format(f"c.{r.ref_col}"), _KEY.format(r.parent_col)
        parts.append(f"""
        SELECT '{r.child_table}' AS child_table, c.{r.key_col} AS child_key, c.{r.child_time} AS at_time,
               CASE WHEN p.k IS NULL THEN 'missing' ELSE 'late' END AS state
        FROM {r.child_table} c LEFT JOIN (SELECT {parent} AS k, min({r.parent_time}) AS since FROM {r.parent_table} GROUP BY 1) p ON {child} = p.k
        WHERE {child} <> '' AND (p.k IS NULL OR p.since > c.{r.child_time})""")
    return " UNION ALL ".join(parts)


# Spellings of units in small letters, powers as plain digits, blanks single: (spelling, unit, kind, factor, offset). The SQL states them for itself.
_SPELLED = """('%', '%', 'mass', 1e4, 0), ('% масс.', '%', 'mass', 1e4, 0), ('мас. %', '%', 'mass', 1e4, 0), ('pct', '%', 'mass', 1e4, 0), ('percent', '%', 'mass', 1e4, 0), ('wt. %', '%', 'mass', 1e4, 0),
('g/kg', 'g/kg', 'mass', 1e3, 0), ('g / kg', 'g/kg', 'mass', 1e3, 0), ('g kg-1', 'g/kg', 'mass', 1e3, 0), ('g per kg', 'g/kg', 'mass', 1e3, 0), ('г/кг', 'g/kg', 'mass', 1e3, 0), ('г кг-1', 'g/kg', 'mass', 1e3, 0),
('mg/kg', 'mg/kg', 'mass', 1, 0), ('mg/ kg', 'mg/kg', 'mass', 1, 0), ('mg kg-1', 'mg/kg', 'mass', 1, 0), ('mg per kg', 'mg/kg', 'mass', 1, 0), ('мг/кг', 'mg/kg', 'mass', 1, 0), ('мг кг-1', 'mg/kg', 'mass', 1, 0),
('g/100g', 'g/100g', 'mass', 1e4, 0), ('g/100 g', 'g/100g', 'mass', 1e4, 0), ('g per 100 g', 'g/100g', 'mass', 1e4, 0), ('г/100 г', 'g/100g', 'mass', 1e4, 0),
('mg/100g', 'mg/100g', 'mass', 10, 0), ('mg/100 g', 'mg/100g', 'mass', 10, 0), ('mg 100 g-1', 'mg/100g', 'mass', 10, 0), ('мг/100 г', 'mg/100g', 'mass', 10, 0), ('мг на 100 г', 'mg/100g', 'mass', 10, 0),
('mg/g', 'mg/g', 'mass', 1e3, 0), ('mg g-1', 'mg/g', 'mass', 1e3, 0), ('мг/г', 'mg/g', 'mass', 1e3, 0), ('ug/g', 'ug/g', 'mass', 1, 0), ('ug g-1', 'ug/g', 'mass', 1, 0), ('мкг/г', 'ug/g', 'mass', 1, 0),
('ug/kg', 'ug/kg', 'mass', 1e-3, 0), ('ug kg-1', 'ug/kg', 'mass', 1e-3, 0), ('мкг/кг', 'ug/kg', 'mass', 1e-3, 0), ('ppm', 'ppm', 'mass', 1, 0), ('млн-1', 'ppm', 'mass', 1, 0), ('ppb', 'ppb', 'mass', 1e-3, 0), ('млрд-1', 'ppb', 'mass', 1e-3, 0),
('cmolc/kg', 'cmolc/kg', 'charge', 1, 0), ('cmolc kg-1', 'cmolc/kg', 'charge', 1, 0), ('cmol(c)/kg', 'cmolc/kg', 'charge', 1, 0), ('cmol(+) kg-1', 'cmolc/kg', 'charge', 1, 0), ('смоль(экв)/кг', 'cmolc/kg', 'charge', 1, 0),
('mmolc/kg', 'mmolc/kg', 'charge', 0.1, 0), ('mmol(+) kg-1', 'mmolc/kg', 'charge', 0.1, 0), ('ммоль(экв)/кг', 'mmolc/kg', 'charge', 0.1, 0),
('me/100g', 'meq/100g', 'charge', 1, 0), ('meq/100g', 'meq/100g', 'charge', 1, 0), ('meq/100 g', 'meq/100g', 'charge', 1, 0), ('мг-экв/100 г', 'meq/100g', 'charge', 1, 0), ('мг-экв./100 г почвы', 'meq/100g', 'charge', 1, 0),
('ds/m', 'dS/m', 'conduct', 1, 0), ('ds m-1', 'dS/m', 'conduct', 1, 0), ('дсм/м', 'dS/m', 'conduct', 1, 0), ('ms/cm', 'mS/cm', 'conduct', 1, 0), ('ms cm-1', 'mS/cm', 'conduct', 1, 0), ('мсм/см', 'mS/cm', 'conduct', 1, 0),
('ms/m', 'mS/m', 'conduct', 0.01, 0), ('ms m-1', 'mS/m', 'conduct', 0.01, 0), ('мсм/м', 'mS/m', 'conduct', 0.01, 0), ('us/cm', 'uS/cm', 'conduct', 1e-3, 0), ('us cm-1', 'uS/cm', 'conduct', 1e-3, 0), ('мксм/см', 'uS/cm', 'conduct', 1e-3, 0),
('g/cm3', 'g/cm3', 'density', 1, 0), ('g cm-3', 'g/cm3', 'density', 1, 0), ('g/cc', 'g/cm3', 'density', 1, 0), ('г/см3', 'g/cm3', 'density', 1, 0), ('kg/m3', 'kg/m3', 'density', 1e-3, 0), ('kg m-3', 'kg/m3', 'density', 1e-3, 0), ('кг/м3', 'kg/m3', 'density', 1e-3, 0),
('t/m3', 't/m3', 'density', 1, 0), ('t m-3', 't/m3', 'density', 1, 0), ('т/м3', 't/m3', 'density', 1, 0), ('kg/dm3', 'kg/dm3', 'density', 1, 0), ('kg dm-3', 'kg/dm3', 'density', 1, 0), ('кг/дм3', 'kg/dm3', 'density', 1, 0),
('mpa', 'MPa', 'press', 1, 0), ('мпа', 'MPa', 'press', 1, 0), ('kpa', 'kPa', 'press', 1e-3, 0), ('кпа', 'kPa', 'press', 1e-3, 0), ('bar', 'bar', 'press', 0.1, 0), ('бар', 'bar', 'press', 0.1, 0),
('kgf/cm2', 'kgf/cm2', 'press', 0.0980665, 0), ('kgf cm-2', 'kgf/cm2', 'press', 0.0980665, 0), ('кгс/см2', 'kgf/cm2', 'press', 0.0980665, 0),
('cm/day', 'cm/day', 'speed', 1, 0), ('cm/d', 'cm/day', 'speed', 1, 0), ('cm d-1', 'cm/day', 'speed', 1, 0), ('см/сут', 'cm/day', 'speed', 1, 0), ('cm/h', 'cm/h', 'speed', 24, 0), ('cm h-1', 'cm/h', 'speed', 24, 0), ('см/ч', 'cm/h', 'speed', 24, 0),
('mm/h', 'mm/h', 'speed', 2.4, 0), ('mm/hr', 'mm/h', 'speed', 2.4, 0), ('mm h-1', 'mm/h', 'speed', 2.4, 0), ('мм/ч', 'mm/h', 'speed', 2.4, 0), ('m/day', 'm/day', 'speed', 100, 0), ('m d-1', 'm/day', 'speed', 100, 0), ('м/сут', 'm/day', 'speed', 100, 0),
('m/s', 'm/s', 'speed', 8640000, 0), ('m s-1', 'm/s', 'speed', 8640000, 0), ('м/с', 'm/s', 'speed', 8640000, 0), ('mv', 'mV', 'volt', 1, 0), ('мв', 'mV', 'volt', 1, 0), ('v', 'V', 'volt', 1e3, 0), ('в', 'V', 'volt', 1e3, 0),
('c', 'C', 'heat', 1, 0), ('°c', 'C', 'heat', 1, 0), ('deg c', 'C', 'heat', 1, 0), ('градусы цельсия', 'C', 'heat', 1, 0), ('f', 'F', 'heat', 5.0::DOUBLE / 9, -160.0::DOUBLE / 9), ('°f', 'F', 'heat', 5.0::DOUBLE / 9, -160.0::DOUBLE / 9), ('deg f', 'F', 'heat', 5.0::DOUBLE / 9, -160.0::DOUBLE / 9),
('k', 'K', 'heat', 1, -273.15), ('к', 'K', 'heat', 1, -273.15), ('kelvin', 'K', 'heat', 1, -273.15), ('ph', 'pH', 'acid', 1, 0), ('ед. ph', 'pH', 'acid', 1, 0)"""


def _plain_unit(column: str) -> str:
    """SQL: a spelling in small letters, powers as plain digits, blanks single."""
    for old, new in (("−", "-"), ("–", "-"), ("⁻", "-"), ("¹", "1"), ("²", "2"), ("³", "3"), ("µ", "u"), ("μ", "u"), ("·", " "), ("⋅", " ")):
        column = f"replace({column}, '{old}', '{new}')"
    return f"trim(regexp_replace(replace(lower({column}), chr(160), ' '), '\\s+', ' ', 'g'))"


def _bare_unit(column: str) -> str:
    """SQL: the same without brackets around the whole."""
    return f"regexp_replace({_plain_unit(column)}, '^[(\\[](.*)[)\\]]$', '\\1')"


_NUMBER_SQL = "'^[\\s ]*[<>≤≥~≈]?[\\s ]*([-−–+]?[0-9]+(?:[.,][0-9]+)?(?:[eEеЕ][-−–+]?[0-9]+)?)(.*)$'"
_CONVERTED = f"""v AS (SELECT * FROM (VALUES {_SPELLED}) AS t(spelling, unit, kind, factor, shift)),
k AS (SELECT property_id, min(v.unit) AS canonical, min(v.kind) AS kind, min(v.factor) AS to_base, min(v.shift) AS base_shift FROM property_definition JOIN v ON v.spelling = {_bare_unit("canonical_unit")} WHERE property_id IS NOT NULL GROUP BY 1),
r AS (SELECT row_number() OVER () AS i, c.*, CASE WHEN value_num IS NOT NULL AND NOT isnan(value_num) THEN value_num ELSE TRY_CAST(translate(regexp_extract(value_text, {_NUMBER_SQL}, 1), ',−–еЕ', '.--ee') AS DOUBLE) END AS value_raw FROM normalized_table_measurement_candidates c),
a AS (SELECT i, v.* FROM r JOIN v ON v.spelling = {_bare_unit("unit_raw")}), b AS (SELECT i, v.* FROM r JOIN v ON v.spelling = {_bare_unit(f"regexp_extract(value_text, {_NUMBER_SQL}, 2)")}),
h AS (SELECT header, v.kind, arg_max(v.spelling, length(v.spelling)) AS spelling FROM (SELECT DISTINCT property_header_raw AS header, {_plain_unit("property_header_raw")} AS p FROM r) JOIN v ON ends_with(p, ' ' || v.spelling) OR ends_with(p, '(' || v.spelling || ')') OR ends_with(p, '[' || v.spelling || ']') GROUP BY 1, 2),
m AS (SELECT r.candidate_id, r.property_id, coalesce(a.unit, b.unit, x.unit) AS unit, k.canonical AS canonical_unit, r.value_raw, (r.value_raw * coalesce(a.factor, b.factor, x.factor) + coalesce(a.shift, b.shift, x.shift) - k.base_shift) / k.to_base AS value_canonical, k.kind, k.to_base, k.base_shift
FROM r LEFT JOIN k USING (property_id) LEFT JOIN a ON a.i = r.i AND a.kind = k.kind LEFT JOIN b ON b.i = r.i AND b.kind = k.kind LEFT JOIN h ON h.header = r.property_header_raw AND h.kind = k.kind LEFT JOIN v x ON x.spelling = h.spelling AND x.kind = k.kind)"""

ORACLE = {
    "p3_converted": f"WITH {_CONVERTED} SELECT candidate_id, property_id, unit, canonical_unit, value_raw, value_canonical FROM m",
    "p3_found": f"""WITH {_CONVERTED}, n AS (SELECT candidate_id, max(struct_pack(t := coalesce(normalized_at, TIMESTAMP '0001-01-01'), v := coalesce(normalizer_version, ''), g := value_normalized IS NOT NULL, x := coalesce(value_normalized, 0), u := coalesce(unit_normalized, ''))) AS s FROM table_measurement_candidate_normalization WHERE candidate_id IS NOT NULL GROUP BY 1),
        q AS (SELECT candidate_id, min(struct_pack(c := value_canonical, p := property_id, k := kind, t := to_base, o := base_shift)) AS s FROM m WHERE value_canonical IS NOT NULL AND candidate_id IS NOT NULL GROUP BY 1),
        j AS (SELECT q.candidate_id, q.s.c AS c, CASE WHEN n.s.g AND NOT isnan(n.s.x) THEN (n.s.x * v.factor + v.shift - q.s.o) / q.s.t END AS d FROM q JOIN n USING (candidate_id) LEFT JOIN v ON v.spelling = {_bare_unit("n.s.u")} AND v.kind = q.s.k)
        SELECT candidate_id FROM j WHERE NOT coalesce(abs(d - c) <= 0.01 * abs(c), false)""",
    "p4_found": """
        WITH s AS (SELECT DISTINCT site_id, latitude AS y, longitude AS x FROM reported_site
                   WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT (latitude = 0 AND longitude = 0)
                     AND NOT isnan(latitude) AND NOT isnan(longitude)),
             r AS (SELECT DISTINCT region_name, latitude AS y, longitude AS x, radius_km FROM document_study_region WHERE radius_km > 0)
        SELECT DISTINCT 'site' AS kind, a.site_id AS id_a, b.site_id AS id_b FROM s a JOIN s b ON a.site_id < b.site_id AND abs(a.y - b.y) < 0.01
        WHERE 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2)))) <= 1.0
        UNION ALL
        SELECT DISTINCT 'region', s.site_id, r.region_name FROM s, r
        WHERE 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(r.y - s.y) / 2), 2) + cos(radians(s.y)) * cos(radians(r.y)) * pow(sin(radians(r.x - s.x) / 2), 2)))) <= r.radius_km""",
    "p5_found": f"SELECT DISTINCT child_table, child_key FROM ({_orphan_sql()})",
    "p5_monthly": f"SELECT child_table, strftime(at_time, '%Y-%m') AS month, state, count(*) AS orphans, count(DISTINCT child_key) AS keys FROM ({_orphan_sql()}) GROUP BY ALL",
}
