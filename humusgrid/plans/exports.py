"""Files written and read again, and the export package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from humusgrid.operators.spatial import points_in_polygons
from humusgrid.plans import domain, relational, reports, writes
from humusgrid.plans.registry import Registry, Tables
from humusgrid.session import shared_dir
from humusgrid.sources import files

R = Registry()
#: Names of the export package and the queries behind them.
PACKAGE = {
    "observations": writes.R, "verified": writes.R, "staged": writes.R, "public_documents": writes.R, "supplement": writes.R, "map": writes.R, "census": relational.R, "missing": relational.R, "tiers": relational.R,
    "regions": relational.R, "linkage": domain.R, "flags": domain.R, "quality": domain.R, "reasons": reports.R, "descriptions": reports.R, "review": reports.R, "reuse": reports.R,
}
_QUERY = {
    "observations": "portal_observations", "verified": "cell_verification", "staged": "supported_staging", "public_documents": "scrubbed_paths", "supplement": "supplemental_layer", "map": "json_payloads", "census": "census", "missing": "missingness", "tiers": "tier_merge",
    "regions": "topk_ranked", "linkage": "linkage_materialize", "flags": "plausibility_flags", "quality": "quality_report", "reasons": "rejection_reasons", "descriptions": "merged_description", "review": "review_linkage", "reuse": "exact_reuse",
}


def package(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seventeen frames of the export package."""
    return {name: part.queries[_QUERY[name]](spark, sf_dir) for name, part in PACKAGE.items()}


def _folder(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@R.query("SELECT property_id, canonical_name, description FROM property_definition UNION ALL SELECT site_id, name, region FROM reported_site")
def csv_round_trip(t: Tables) -> DataFrame:
    """Texts with quotes, commas, line ends and nulls through CSV."""
    rows = t.property_definition.select("property_id", "canonical_name", "description").unionByName(t.reported_site.select(F.col("site_id").alias("property_id"), F.col("name").alias("canonical_name"), F.col("region").alias("description")))
    path = _folder(t, "csv")
    files.write_csv(rows, path, null="\\N")
    return files.read_csv(t.spark, path, "property_id string, canonical_name string, description string", null="\\N")


@R.query("SELECT extraction_id, raw_text, quality_score FROM extraction")
def json_lines_round_trip(t: Tables) -> DataFrame:
    """Texts of many lines through JSON lines; nothing is broken, nothing lost."""
    path = _folder(t, "lines")
    files.write_json_lines(t.extraction.select("extraction_id", "raw_text", "quality_score"), path)
    good, _ = files.parsed_and_broken(files.read_json_lines(t.spark, path, "extraction_id string, raw_text string, quality_score double"))
    return good


@R.query("""WITH c AS (SELECT artifact_id, row_index, column_index, min(value_text) AS v FROM normalized_table_measurement_candidates WHERE artifact_id IS NOT NULL AND value_text IS NOT NULL AND trim(value_text) <> '' GROUP BY 1, 2, 3)
SELECT artifact_id, count(*) AS cells, max(length(trim(regexp_replace(v, '\\s+', ' ', 'g')))) AS longest FROM c GROUP BY 1""")
def html_tables(t: Tables) -> DataFrame:
    """Tables of cells written as HTML and parsed again."""
    cells = t.normalized_table_measurement_candidates.filter("artifact_id is not null and trim(value_text) <> ''").groupBy("artifact_id", "row_index", "column_index").agg(F.min("value_text").alias("v"))
    escaped = F.replace(F.replace(F.col("v"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    # a table's cells are one page, as they are in the source
    rows = cells.groupBy("artifact_id", "row_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("column_index", escaped.alias("v")))), lambda x: F.concat(F.lit("<td>"), x["v"], F.lit("</td>"))), "").alias("r"))
    pages = rows.groupBy("artifact_id").agg(F.concat(F.lit("<table>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "r"))), lambda x: F.concat(F.lit("<tr>"), x["r"], F.lit("</tr>"))), ""), F.lit("</table>")).alias("html"))
    return files.html_cells(pages, "artifact_id", "html").groupBy("artifact_id").agg(F.count(F.lit(1)).alias("cells"), F.max(F.length("text_raw")).cast("long").alias("longest"))


_GEOJSON = """{"type": "FeatureCollection", "features": [
{"type": "Feature", "properties": {"ISO_A2": "AA"}, "geometry": {"type": "Polygon", "coordinates": [[[30, 45], [60, 45], [60, 65], [30, 65], [30, 45]], [[40, 50], [50, 50], [50, 60], [40, 60], [40, 50]]]}},
{"type": "Feature", "properties": {"ISO_A3": "BBB"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[80, 45], [100, 45], [100, 60], [80, 60], [80, 45]]], [[[110, 50], [140, 50], [140, 70], [110, 70], [110, 50]]]]}},
{"type": "Feature", "properties": {"name": "no code"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}"""


@R.query("""SELECT DISTINCT candidate_id, CASE WHEN longitude >= 30 AND longitude < 60 AND latitude >= 45 AND latitude < 65 AND NOT (longitude >= 40 AND longitude < 50 AND latitude >= 50 AND latitude < 60) THEN 'AA' WHEN (longitude >= 80 AND longitude < 100 AND latitude >= 45 AND latitude < 60) OR (longitude >= 110 AND longitude < 140 AND latitude >= 50 AND latitude < 70) THEN 'BBB' END AS country
FROM location_candidate WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""")
def country_triage(t: Tables) -> DataFrame:
    """Country of each coordinate by the polygons of a GeoJSON file; null for none."""
    path = _folder(t, "geojson")
    t.spark.createDataFrame([(_GEOJSON,)], "value string").coalesce(1).write.text(path, lineSep="\n")
    points = t.location_candidate.filter("latitude between -90 and 90 and longitude between -180 and 180").select(F.struct("candidate_id", "latitude", "longitude").alias("id"), "latitude", "longitude").distinct()
    found = points_in_polygons(points, files.read_geojson(t.spark, path)).groupBy("id").agg(F.when(F.count_distinct("name") == 1, F.min("name")).alias("country"))
    return points.select("id").join(found, "id", "left").select("id.candidate_id", "country").distinct()


@R.query()
def package_manifest(t: Tables) -> DataFrame:
    """The export package: seventeen names written as CSV, with sizes, digests and row counts."""
    audit = domain.R.queries["audit_zero_counts"](t.spark, t._dir)
    out = files.export_package(package(t.spark, t._dir), _folder(t, "package"), audit, force=True)
    return out.filter("file like '%.csv'")
