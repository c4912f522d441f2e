"""New versions of tables, and tables made for export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from humusgrid.operators import merge
from humusgrid.operators.aggregate import capped_lists
from humusgrid.plans.registry import Registry, Tables
from humusgrid.sources.sql import open_views, run_sql

R = Registry()


@R.query("""SELECT site_id, region FROM (SELECT site_id, min(region) AS region FROM reported_site WHERE latitude > 55 GROUP BY 1) UNION ALL
SELECT site_id, min(region) FROM reported_site WHERE site_id NOT IN (SELECT site_id FROM reported_site WHERE latitude > 55) GROUP BY 1""")
def insert_missing(t: Tables) -> DataFrame:
    """Rows of new keys are added, stored rows stay."""
    one = lambda df: df.groupBy("site_id").agg(F.min("region").alias("region"))
    return merge.insert_missing(one(t.reported_site.filter("latitude > 55")), one(t.reported_site), ["site_id"])


@R.query("""SELECT property_id, CASE WHEN category = 'exchange' THEN 'replaced' ELSE canonical_unit END AS unit FROM property_definition""")
def replace_rows(t: Tables) -> DataFrame:
    stored = t.property_definition.select("property_id", F.col("canonical_unit").alias("unit"))
    return merge.replace_rows(stored, t.property_definition.filter("category = 'exchange'").select("property_id", F.lit("replaced").alias("unit")), ["property_id"])


@R.query("""WITH s AS (SELECT profile_id, min(review_status) AS status, min(land_use) AS land_use FROM profile GROUP BY 1) SELECT profile_id, status, CASE WHEN status = 'accepted' OR land_use IS NULL THEN land_use ELSE upper(land_use) END AS land_use FROM s""")
def conditional_upsert(t: Tables) -> DataFrame:
    """Accepted rows stay; other rows take the change unless it is null."""
    stored = t.profile.groupBy("profile_id").agg(F.min("review_status").alias("status"), F.min("land_use").alias("land_use"))
    return merge.conditional_upsert(stored, stored.select("profile_id", F.upper("land_use").alias("land_use")), "profile_id", F.col("status") == "accepted", ["land_use"])


@R.query("""WITH e AS (SELECT profile_id, arg_min(evidence_kind, evidence_id) AS kind FROM (SELECT profile_id, evidence_id, min(evidence_kind) AS evidence_kind FROM profile_evidence WHERE evidence_kind IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT p.profile_id, coalesce(kind, notes) AS notes, count(*) AS rows FROM profile p LEFT JOIN e ON e.profile_id = p.profile_id GROUP BY 1, 2""")
def fill_from_first(t: Tables) -> DataFrame:
    """A column set from the first matching row of another table."""
    out = merge.fill_from_first(t.profile.select("profile_id", "notes"), t.profile_evidence, "profile_id", "notes", "evidence_kind", "evidence_id")
    return out.groupBy("profile_id", "notes").agg(F.count(F.lit(1)).alias("rows"))


@R.query("""WITH g AS (SELECT DISTINCT document_id FROM document WHERE document_id LIKE 'rcsi:a%' AND document_id IS NOT NULL)
SELECT 'document' AS name, count(*) AS rows FROM document WHERE document_id IS NULL OR document_id NOT IN (SELECT * FROM g) UNION ALL SELECT 'source_artifact', count(*) FROM source_artifact WHERE document_id IS NULL OR document_id NOT IN (SELECT * FROM g)
UNION ALL SELECT 'reported_site', count(*) FROM reported_site WHERE document_id IS NULL OR document_id NOT IN (SELECT * FROM g)""")
def delete_cascade(t: Tables) -> DataFrame:
    """Rows deleted by a pattern, and the rows that refer to them."""
    tables = {"document": t.document, "source_artifact": t.source_artifact, "reported_site": t.reported_site}
    left = merge.delete_where(tables, F.col("document_id").like("rcsi:a%"), "document", "document_id", ["source_artifact", "reported_site"])
    out = None
    for name, df in left.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


@R.query("SELECT evidence_kind, count(*) AS rows FROM profile_evidence WHERE profile_id IS NULL OR profile_id IN (SELECT profile_id FROM profile WHERE profile_id IS NOT NULL) GROUP BY 1")
def orphan_sweep(t: Tables) -> DataFrame:
    return merge.sweep_orphans(t.profile_evidence, t.profile, "profile_id").groupBy("evidence_kind").agg(F.count(F.lit(1)).alias("rows"))


@R.query("""SELECT 'candidates' AS name, CASE property_id WHEN 'clay' THEN 'clay_fraction' WHEN 'zinc' THEN 'zn' ELSE property_id END AS property_id, count(*) AS rows FROM normalized_table_measurement_candidates GROUP BY 1, 2
UNION ALL SELECT 'definitions', CASE property_id WHEN 'clay' THEN 'clay_fraction' WHEN 'zinc' THEN 'zn' ELSE property_id END, count(*) FROM property_definition GROUP BY 1, 2""")
def rename_everywhere(t: Tables) -> DataFrame:
    """A property renamed in every table that has the column."""
    tables = merge.rename_value({"candidates": t.normalized_table_measurement_candidates, "definitions": t.property_definition, "sites": t.reported_site}, "property_id", {"clay": "clay_fraction", "zinc": "zn"})
    count = lambda name: tables[name].groupBy(F.lit(name).alias("name"), "property_id").agg(F.count(F.lit(1)).alias("rows"))
    return count("candidates").unionByName(count("definitions"))


@R.query("SELECT o_orderstatus, count(*) AS rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS replaced FROM orders GROUP BY 1")
def overwrite_history(t: Tables) -> DataFrame:
    """An upsert that keeps what it overwrites: rows of the new version, and of the history, by status."""
    stored = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changes = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    new, replaced = merge.with_history(stored, changes, ["o_orderkey"], ["o_totalprice"])
    old = replaced.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("replaced"))
    return new.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows")).join(old, "o_orderstatus", "left").select("o_orderstatus", "rows", F.coalesce("replaced", F.lit(0)).alias("replaced"))


@R.query("""SELECT candidate_id, CASE WHEN status = 'accepted' AND country_candidate IS NULL THEN 'unreviewed' ELSE status END AS status, CASE WHEN status = 'accepted' AND country_candidate IS NULL THEN concat_ws(' ', precision_hint, 'No country.') ELSE precision_hint END AS note, NULL::VARCHAR AS reviewer FROM location_candidate""")
def status_downgrade(t: Tables) -> DataFrame:
    """Rows still accepted lose the state, with a note; a missing column is added."""
    rows = t.location_candidate.select("candidate_id", "status", F.col("precision_hint").alias("note"), "country_candidate")
    out = merge.downgrade(rows, "status", "accepted", "unreviewed", "note", "No country.", F.col("country_candidate").isNull())
    return merge.with_column_added(out, "reviewer", "string").select("candidate_id", "status", "note", "reviewer")


@R.query("""SELECT c.candidate_id, c.corpus, c.document_id, d.canonical_name AS property, d.category, c.value_num, n.value_normalized, n.unit_normalized, coalesce(n.normalization_status, 'none') AS normalization, c.candidate_status = 'accepted' AND n.value_normalized IS NOT NULL AS trusted, d.category IN ('organic', 'macronutrient', 'exchange') AS metric
FROM (SELECT DISTINCT candidate_id, corpus, document_id, property_id, value_num, candidate_status FROM normalized_table_measurement_candidates) c JOIN property_definition d USING (property_id)
LEFT JOIN (SELECT candidate_id, max(value_normalized) AS value_normalized, max(unit_normalized) AS unit_normalized, max(normalization_status) AS normalization_status FROM table_measurement_candidate_normalization GROUP BY 1) n ON n.candidate_id = c.candidate_id WHERE d.category <> 'environmental'""")
def portal_observations(t: Tables) -> DataFrame:
    """Denormalized table of the portal: one category dropped, flags derived."""
    c = t.normalized_table_measurement_candidates.select("candidate_id", "corpus", "document_id", "property_id", "value_num", "candidate_status").distinct()
    n = t.table_measurement_candidate_normalization.groupBy("candidate_id").agg(*[F.max(x).alias(x) for x in ("value_normalized", "unit_normalized", "normalization_status")])
    rows = c.join(t.property_definition.filter("category <> 'environmental'"), "property_id").join(n, "candidate_id", "left")
    return rows.select(
        "candidate_id", "corpus", "document_id", F.col("canonical_name").alias("property"), "category", "value_num", "value_normalized", "unit_normalized", F.coalesce("normalization_status", F.lit("none")).alias("normalization"),
        ((F.col("candidate_status") == "accepted") & F.col("value_normalized").isNotNull()).alias("trusted"), F.col("category").isin("organic", "macronutrient", "exchange").alias("metric"),
    )


@R.query("SELECT document_id, title, regexp_replace(source_path, '^.*/', '') AS file FROM document WHERE source_path IS NOT NULL")
def scrubbed_paths(t: Tables) -> DataFrame:
    """Paths reduced to file names for the public."""
    return t.document.filter("source_path is not null").select("document_id", "title", F.regexp_replace("source_path", "^.*/", "").alias("file"))


@R.query("""SELECT e.row_label_raw, e.property_id, count(*) AS rows FROM normalized_table_measurement_candidates e WHERE e.candidate_status <> 'accepted' AND e.property_id NOT IN (SELECT property_id FROM normalized_table_measurement_candidates WHERE candidate_status = 'accepted' AND depth_top_cm > 150 AND property_id IS NOT NULL)
AND e.artifact_id IN (SELECT artifact_id FROM normalized_table_measurement_candidates WHERE candidate_status = 'rejected') GROUP BY 1, 2""")
def supplemental_layer(t: Tables) -> DataFrame:
    """Rows whose property the core lacks, of tables that the core could not assign."""
    c = t.normalized_table_measurement_candidates
    core = c.filter("candidate_status = 'accepted' and depth_top_cm > 150").select("property_id").distinct()
    unassigned = c.filter("candidate_status = 'rejected'").select("artifact_id").distinct()
    return c.filter("candidate_status <> 'accepted' and property_id is not null").join(core, "property_id", "left_anti").join(unassigned, "artifact_id", "left_semi").groupBy("row_label_raw", "property_id").agg(F.count(F.lit(1)).alias("rows"))


@R.query("""SELECT category, to_json(list(struct_pack(property := property_id, n := n) ORDER BY property_id)) AS payload FROM (SELECT category, property_id, count(*) AS n FROM normalized_table_measurement_candidates JOIN property_definition USING (property_id) GROUP BY 1, 2) GROUP BY 1""")
def json_payloads(t: Tables) -> DataFrame:
    """Nested aggregates as JSON text."""
    n = t.normalized_table_measurement_candidates.groupBy("property_id").agg(F.count(F.lit(1)).alias("n")).join(t.property_definition, "property_id")
    return n.groupBy("category").agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("property_id").alias("property"), "n")))).alias("payload"))


@R.query("""WITH s AS (SELECT DISTINCT latitude, longitude, document_id, name FROM reported_site WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND document_id IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY document_id, name) AS r, count(*) OVER (PARTITION BY latitude, longitude) AS n FROM s)
SELECT latitude, longitude, max(n) AS sources, string_agg(document_id, ';' ORDER BY r) AS shown FROM r WHERE r <= 6 GROUP BY 1, 2""")
def map_points(t: Tables) -> DataFrame:
    """Points of a map with the number of their sources and the first six of them."""
    s = t.reported_site.filter("latitude between -90 and 90 and longitude between -180 and 180 and document_id is not null").select("latitude", "longitude", "document_id", "name").distinct()
    n = s.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("sources"))
    first = capped_lists(s.withColumn("at", F.struct("latitude", "longitude")), "at", ["document_id", "name"], 6)
    return first.select("at.*", F.array_join(F.transform("items", lambda x: x["document_id"]), ";").alias("shown")).join(n, ["latitude", "longitude"])


_FREE = """-- a page of questions; the last one is shown
CREATE OR REPLACE TEMP VIEW busy AS SELECT document_id, count(*) AS n FROM normalized_table_measurement_candidates GROUP BY document_id HAVING count(*) > 3;
SELECT d.corpus, count(*) AS documents, sum(b.n) AS cells, 'a;b' AS mark FROM busy b JOIN (SELECT DISTINCT document_id, corpus FROM document) d ON d.document_id = b.document_id GROUP BY d.corpus"""


@R.query("""SELECT d.corpus, count(*) AS documents, CAST(sum(b.n) AS BIGINT) AS cells, 'a;b' AS mark FROM (SELECT document_id, count(*) AS n FROM normalized_table_measurement_candidates GROUP BY document_id HAVING count(*) > 3) b JOIN (SELECT DISTINCT document_id, corpus FROM document) d ON d.document_id = b.document_id GROUP BY d.corpus""")
def free_sql(t: Tables) -> DataFrame:
    """Any SQL over the tables as views: several statements, the last one's result."""
    open_views(t.spark, t._dir)
    return run_sql(t.spark, _FREE)


@R.query("""SELECT depth_top_cm AS x, avg(value_num) AS mean, count(*) AS n FROM normalized_table_measurement_candidates WHERE property_id = 'clay' AND value_num IS NOT NULL AND NOT isnan(value_num) AND depth_top_cm IS NOT NULL GROUP BY 1""")
def property_chart(t: Tables) -> DataFrame:
    """Query of one chart with its property as a parameter."""
    open_views(t.spark, t._dir)
    text = "SELECT depth_top_cm AS x, avg(value_num) AS mean, count(*) AS n FROM normalized_table_measurement_candidates WHERE property_id = :property AND value_num IS NOT NULL AND NOT isnan(value_num) AND depth_top_cm IS NOT NULL GROUP BY 1"
    return run_sql(t.spark, text, property="clay")


@R.query("""WITH n AS (SELECT candidate_id, max(value_normalized) AS v FROM table_measurement_candidate_normalization GROUP BY 1), p AS (SELECT c.property_id, count(*) AS rows, count(v) AS proven, count(unit_raw) AS with_unit FROM normalized_table_measurement_candidates c LEFT JOIN n USING (candidate_id) GROUP BY 1)
SELECT property_id, CASE WHEN proven >= 0.3 * rows AND with_unit > 0 THEN 'normalized' ELSE 'raw' END AS shown FROM p""")
def shown_values(t: Tables) -> DataFrame:
    """Whether normalized or raw values are shown: enough of them proven, and a unit known."""
    n = t.table_measurement_candidate_normalization.groupBy("candidate_id").agg(F.max("value_normalized").alias("v"))
    p = t.normalized_table_measurement_candidates.join(n, "candidate_id", "left").groupBy("property_id").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("proven"), F.count("unit_raw").alias("with_unit"))
    return p.select("property_id", F.when((F.col("proven") >= 0.3 * F.col("rows")) & (F.col("with_unit") > 0), "normalized").otherwise("raw").alias("shown"))


@R.query("""SELECT document_id, title, (SELECT count(*) FROM document) AS found FROM document ORDER BY document_id, title, created_at LIMIT 1000""")
def shown_rows(t: Tables) -> DataFrame:
    """First thousand rows of a result beside its full number (a display cap)."""
    total = t.document.agg(F.count(F.lit(1)).alias("found"))
    return t.document.orderBy("document_id", "title", "created_at").limit(1000).select("document_id", "title").join(F.broadcast(total))  # one row beside each


@R.query("""WITH n AS (SELECT candidate_id, max(value_normalized) AS v, max(unit_normalized) AS u FROM table_measurement_candidate_normalization GROUP BY 1), c AS (SELECT candidate_id, property_id, max(value_num) AS raw, max(unit_raw) AS unit_raw FROM normalized_table_measurement_candidates GROUP BY 1, 2)
SELECT CASE WHEN v IS NULL THEN 'no_staged_value' WHEN raw IS NULL OR isnan(raw) THEN 'no_source_value' WHEN unit_raw IS NULL THEN 'no_source_unit' WHEN u <> canonical_unit THEN 'other_unit' WHEN v = raw THEN 'equal' WHEN abs(v - raw) <= 0.001 * abs(raw) THEN 'rounded' ELSE 'differs' END AS outcome, count(*) AS rows
FROM c JOIN property_definition USING (property_id) LEFT JOIN n USING (candidate_id) GROUP BY 1""")
def cell_verification(t: Tables) -> DataFrame:
    """Staged values against their source cells, in seven outcomes."""
    n = t.table_measurement_candidate_normalization.groupBy("candidate_id").agg(F.max("value_normalized").alias("v"), F.max("unit_normalized").alias("u"))
    c = t.normalized_table_measurement_candidates.groupBy("candidate_id", "property_id").agg(F.max("value_num").alias("raw"), F.max("unit_raw").alias("unit_raw"))
    rows = c.join(t.property_definition, "property_id").join(n, "candidate_id", "left")
    outcome = (
        F.when(F.col("v").isNull(), "no_staged_value").when(F.col("raw").isNull() | F.isnan("raw"), "no_source_value").when(F.col("unit_raw").isNull(), "no_source_unit")
        .when(F.col("u") != F.col("canonical_unit"), "other_unit").when(F.col("v") == F.col("raw"), "equal").when(F.abs(F.col("v") - F.col("raw")) <= 0.001 * F.abs("raw"), "rounded").otherwise("differs")
    )
    return rows.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


@R.query("""WITH s AS (SELECT document_id, count(DISTINCT site_id) AS k FROM reported_site WHERE document_id IS NOT NULL GROUP BY 1) SELECT DISTINCT candidate_id FROM normalized_table_measurement_candidates JOIN s USING (document_id) WHERE k = 1 AND value_num IS NOT NULL AND NOT isnan(value_num) AND value_num BETWEEN 0 AND 100
AND NOT regexp_matches(lower(coalesce(row_label_raw, '')), 'mean|lsd|среднее|нср') AND unit_raw IS NOT NULL""")
def supported_staging(t: Tables) -> DataFrame:
    """Values that may be staged: documents of one site, a number in tight bounds, a unit, no statistic or reference row."""
    one = t.reported_site.filter("document_id is not null").groupBy("document_id").agg(F.count_distinct("site_id").alias("k")).filter("k = 1").select("document_id")
    rows = t.normalized_table_measurement_candidates.filter("value_num is not null and not isnan(value_num) and value_num between 0 and 100 and unit_raw is not null")
    return rows.filter(~F.lower(F.coalesce("row_label_raw", F.lit(""))).rlike("mean|lsd|среднее|нср")).join(one, "document_id", "left_semi").select("candidate_id").distinct()


@R.query("""WITH d AS (SELECT document_id, max(publication_year) AS printed, max(year(created_at)) AS decoded FROM document WHERE publication_year IS NOT NULL GROUP BY 1) SELECT CASE WHEN abs(printed - (decoded - 20)) = 0 THEN 'exact' WHEN abs(printed - (decoded - 20)) = 1 THEN 'off_by_one' ELSE 'worse' END AS verdict, count(*) AS documents FROM d GROUP BY 1""")
def year_validation(t: Tables) -> DataFrame:
    """Years against a reference: exact, off by one, worse; here the printed year against one derived of the stored time."""
    d = t.document.filter("publication_year is not null").groupBy("document_id").agg(F.max("publication_year").alias("printed"), F.max(F.year("created_at")).alias("decoded"))
    off = F.abs(F.col("printed") - (F.col("decoded") - 20))
    return d.groupBy(F.when(off == 0, "exact").when(off == 1, "off_by_one").otherwise("worse").alias("verdict")).agg(F.count(F.lit(1)).alias("documents"))
