"""Aggregates, windows, sorting and flags as reports need them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.operators import aggregate as agg
from humusgrid.plans.registry import Registry, Tables

R = Registry()


def _n() -> Column:
    """Number of rows."""
    return F.count(F.lit(1))


@R.query("SELECT o_custkey, any_value(c_name) AS c_name, any_value(c_nationkey) AS c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey")
def functional_dependency(t: Tables) -> DataFrame:
    """Columns that depend on the key: counted by key first, named afterwards."""
    return t.orders.groupBy("o_custkey").agg(_n().alias("n")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", "c_name", "c_nationkey", "n")


# Depth bands, as (name, from, below).
BANDS = (("0-20", 0, 20), ("20-50", 20, 50), ("50-100", 50, 100), ("100+", 100, 100000))


@R.query("""SELECT property_id, CASE WHEN depth_top_cm < 0 THEN NULL WHEN depth_top_cm < 20 THEN '0-20' WHEN depth_top_cm < 50 THEN '20-50' WHEN depth_top_cm < 100 THEN '50-100' ELSE '100+' END AS band, count(*) AS n, avg(value_num) AS mean
FROM normalized_table_measurement_candidates WHERE depth_top_cm >= 0 AND NOT isnan(value_num) AND NOT isnan(depth_top_cm) GROUP BY 1, 2""")
def named_bands(t: Tables) -> DataFrame:
    band = F.coalesce(*[F.when((F.col("depth_top_cm") >= low) & (F.col("depth_top_cm") < high), F.lit(name)) for name, low, high in BANDS])
    rows = t.normalized_table_measurement_candidates.filter("depth_top_cm >= 0 and not isnan(value_num) and not isnan(depth_top_cm) and value_num is not null")
    return rows.groupBy("property_id", band.alias("band")).agg(_n().alias("n"), F.avg("value_num").alias("mean"))


@R.query("""SELECT CASE WHEN category IN ('macronutrient', 'microelement') THEN 'nutrients' WHEN category = 'environmental' THEN 'physical' ELSE replace(lower(category), '_', '-') END AS slug, count(*) AS n, count(DISTINCT property_id) AS properties
FROM normalized_table_measurement_candidates JOIN property_definition USING (property_id) GROUP BY 1""")
def category_rollup(t: Tables) -> DataFrame:
    """Counts by category after slugs that mean the same are merged."""
    counts = t.normalized_table_measurement_candidates.groupBy("property_id").agg(_n().alias("k")).join(t.property_definition, "property_id")
    slug = F.when(F.col("category").isin("macronutrient", "microelement"), "nutrients").when(F.col("category") == "environmental", "physical").otherwise(F.replace(F.lower("category"), F.lit("_"), F.lit("-")))
    return counts.groupBy(slug.alias("slug")).agg(F.sum("k").alias("n"), F.count_distinct("property_id").alias("properties"))


@R.query("""WITH b AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem), k AS (SELECT lo, hi, least(20, greatest(6, floor(sqrt(count(*))))) AS k FROM lineitem, b WHERE l_extendedprice BETWEEN lo AND hi GROUP BY ALL)
SELECT CAST(least(k - 1, floor((l_extendedprice - lo) / ((hi - lo) / k))) AS INTEGER) AS bin, count(*) AS n FROM lineitem, k WHERE l_extendedprice BETWEEN lo AND hi GROUP BY 1""")
def histogram_sqrt(t: Tables) -> DataFrame:
    """Histogram between the 1st and 99th percentile, the square root of the count as number of bins, from 6 to 20."""
    return agg.clipped_histogram(t.lineitem, "l_extendedprice")


@R.query("SELECT CAST(CASE WHEN longitude = 180 THEN 15 ELSE floor((longitude - 20) / 10) END AS INTEGER) AS bin, count(*) AS n FROM reported_site WHERE longitude BETWEEN 20 AND 180 GROUP BY 1")
def longitude_histogram(t: Tables) -> DataFrame:
    """Bins of ten degrees from 20 to 180, the last one closed."""
    rows = t.reported_site.filter("longitude between 20 and 180")
    return rows.groupBy(F.when(F.col("longitude") == 180, 15).otherwise(F.floor((F.col("longitude") - 20) / 10)).cast("int").alias("bin")).agg(_n().alias("n"))


@R.query("SELECT lower(trim(land_use)) AS land_use, count(*) AS n FROM profile WHERE trim(land_use) <> '' GROUP BY 1")
def casefolded_counts(t: Tables) -> DataFrame:
    return t.profile.filter("trim(land_use) <> ''").groupBy(F.lower(F.trim("land_use")).alias("land_use")).agg(_n().alias("n"))


@R.query("SELECT region, CAST(sum(CASE WHEN region LIKE '% oblast' OR region LIKE '% krai' THEN 4 ELSE 1 END) AS BIGINT) AS weight FROM reported_site WHERE region IS NOT NULL GROUP BY 1")
def weighted_mentions(t: Tables) -> DataFrame:
    """A name with its administrative suffix weighs four times a bare one."""
    weight = F.when(F.col("region").endswith(" oblast") | F.col("region").endswith(" krai"), 4).otherwise(1)
    return t.reported_site.filter("region is not null").groupBy("region").agg(F.sum(weight).alias("weight"))


@R.query("""SELECT site_id, nullif(string_agg(DISTINCT nullif(trim(land_use), ''), '; ' ORDER BY nullif(trim(land_use), '')), '') AS land_uses, nullif(string_agg(DISTINCT nullif(trim(soil_classification), ''), '; ' ORDER BY nullif(trim(soil_classification), '')), '') AS soils
FROM profile WHERE site_id IS NOT NULL GROUP BY 1""")
def merged_description(t: Tables) -> DataFrame:
    """Descriptive rows of one entity: distinct values in order, null where there is none."""
    return agg.merged_values(t.profile.filter("site_id is not null"), "site_id", {"land_uses": "land_use", "soils": "soil_classification"}, "; ")


@R.query("""WITH r AS (SELECT candidate_id, CASE WHEN value_num IS NULL AND value_text IS NULL THEN 'no_value' WHEN unit_raw IS NULL OR trim(unit_raw) = '' THEN 'no_unit' WHEN depth_top_cm IS NULL THEN 'no_depth' WHEN candidate_status = 'rejected' THEN 'rejected' ELSE 'stageable' END AS reason
FROM normalized_table_measurement_candidates) SELECT reason, count(*) AS n, min(candidate_id) AS example FROM r GROUP BY 1""")
def rejection_reasons(t: Tables) -> DataFrame:
    """First reason against each row, with their numbers and one example each."""
    reason = F.when(F.col("value_num").isNull() & F.col("value_text").isNull(), "no_value").when(F.col("unit_raw").isNull() | (F.trim("unit_raw") == ""), "no_unit").when(F.col("depth_top_cm").isNull(), "no_depth").when(F.col("candidate_status") == "rejected", "rejected").otherwise("stageable")
    return t.normalized_table_measurement_candidates.groupBy(reason.alias("reason")).agg(_n().alias("n"), F.min("candidate_id").alias("example"))


@R.query("""SELECT artifact_id, arg_min(extraction_id, struct_pack(a := -length(raw_text), b := extraction_id)) AS extraction_id, max(length(raw_text)) AS characters FROM extraction WHERE raw_text IS NOT NULL GROUP BY 1""")
def longest_text(t: Tables) -> DataFrame:
    """Longest text of each artifact, of equally long ones the smaller id."""
    rows = t.extraction.filter("raw_text is not null").select("artifact_id", "extraction_id", F.length("raw_text").cast("long").alias("n"))
    return rows.groupBy("artifact_id").agg(F.min(F.struct(-F.col("n"), "extraction_id"))["extraction_id"].alias("extraction_id"), F.max("n").alias("characters"))


@R.query("""WITH s AS (SELECT *, (name IS NOT NULL)::INT + (region IS NOT NULL)::INT + (publication_year IS NOT NULL)::INT AS rich, CASE spatial_confidence WHEN 'exact' THEN 0 WHEN 'reported' THEN 1 WHEN 'geocoded' THEN 2 ELSE 3 END AS trust FROM reported_site WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)
SELECT site_id, n FROM (SELECT site_id, row_number() OVER (PARTITION BY latitude, longitude ORDER BY rich DESC, trust, coalesce(spatial_precision_m, 1e12), site_id) AS r, count(*) OVER (PARTITION BY latitude, longitude) AS n FROM s) WHERE r = 1 AND n > 1""")
def canonical_site(t: Tables) -> DataFrame:
    """Row that stays of each cluster of one coordinate: the richest, most trusted, most precise, smallest id; a map-side minimum, no window."""
    rich = sum((F.col(c).isNotNull().cast("int") for c in ("name", "region", "publication_year")), F.lit(0))
    trust = F.coalesce(*[F.when(F.col("spatial_confidence") == v, F.lit(i)) for i, v in enumerate(("exact", "reported", "geocoded"))], F.lit(3))
    rows = t.reported_site.filter("latitude between -90 and 90 and longitude between -180 and 180")
    best = F.min(F.struct((-rich).alias("r"), trust.alias("t"), F.coalesce("spatial_precision_m", F.lit(1e12)).alias("p"), F.col("site_id")))
    return rows.groupBy("latitude", "longitude").agg(best["site_id"].alias("site_id"), _n().alias("n")).filter("n > 1").select("site_id", "n")


@R.query("SELECT site_id, document_id, n_sites FROM reported_site JOIN (SELECT document_id, count(DISTINCT site_id) AS n_sites FROM reported_site GROUP BY 1) USING (document_id)")
def distinct_broadcast(t: Tables) -> DataFrame:
    """Distinct count of a group beside each of its rows."""
    counts = t.reported_site.groupBy("document_id").agg(F.count_distinct("site_id").alias("n_sites"))
    return t.reported_site.select("site_id", "document_id").join(counts, "document_id")


@R.query("""SELECT evidence_id, profile_id, row_number() OVER w > 1 AS repeated, count(*) OVER (PARTITION BY profile_id, evidence_text) > 1 AS any_copy FROM (SELECT DISTINCT evidence_id, profile_id, evidence_text FROM profile_evidence)
WINDOW w AS (PARTITION BY profile_id, evidence_text ORDER BY evidence_id)""")
def duplicated_marks(t: Tables) -> DataFrame:
    """Rows that repeat an earlier one, and rows that have any copy: the first of a group is its smallest id, found without a window."""
    rows = t.profile_evidence.select("evidence_id", "profile_id", "evidence_text").distinct()
    first = rows.groupBy(F.col("profile_id").alias("p"), F.col("evidence_text").alias("e")).agg(F.min("evidence_id").alias("first"), _n().alias("n"))
    joined = rows.join(first, rows["profile_id"].eqNullSafe(F.col("p")) & rows["evidence_text"].eqNullSafe(F.col("e")))
    return joined.select("evidence_id", "profile_id", (F.col("evidence_id") != F.col("first")).alias("repeated"), (F.col("n") > 1).alias("any_copy"))


@R.query("""SELECT y, x, site_id FROM (SELECT floor(latitude / 2) * 2 AS y, floor(longitude / 2) * 2 AS x, site_id, row_number() OVER (PARTITION BY floor(latitude / 2), floor(longitude / 2) ORDER BY md5('20260803:' || site_id), site_id) AS r
FROM reported_site WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) WHERE r = 1""")
def seeded_representative(t: Tables) -> DataFrame:
    """One site of each cell of two degrees, drawn by a seeded digest."""
    rows = t.reported_site.filter("latitude between -90 and 90 and longitude between -180 and 180")
    pick = F.min(F.struct(F.md5(F.concat(F.lit("20260803:"), "site_id")), F.col("site_id")))["site_id"]
    return rows.groupBy((F.floor(F.col("latitude") / 2) * 2).cast("double").alias("y"), (F.floor(F.col("longitude") / 2) * 2).cast("double").alias("x")).agg(pick.alias("site_id"))


@R.query("""WITH p AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase'), b AS (SELECT a.event_id, a.ts, max(p.ts) FILTER (WHERE p.ts <= a.ts) AS before, min(p.ts) FILTER (WHERE p.ts > a.ts) AS after FROM events a LEFT JOIN p ON p.user_id = a.user_id WHERE a.event_type <> 'purchase' GROUP BY 1, 2)
SELECT event_id, CASE WHEN after IS NULL OR epoch_us(ts) - epoch_us(before) <= epoch_us(after) - epoch_us(ts) THEN epoch_us(before) - epoch_us(ts) ELSE epoch_us(after) - epoch_us(ts) END AS distance FROM b WHERE before IS NOT NULL OR after IS NOT NULL""")
def nearest_label(t: Tables) -> DataFrame:
    """Signed distance to the nearest mark before or after each position, before it on ties."""
    marks = t.events.filter("event_type = 'purchase'").select("user_id", "ts")
    return agg.nearest_marks(t.events.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts"), marks, "user_id", "ts").select("event_id", "distance")


@R.query("""WITH u AS (SELECT latitude, longitude, 0 AS rank, site_id AS id FROM reported_site UNION ALL SELECT latitude, longitude, 1, candidate_id FROM location_candidate UNION ALL SELECT latitude, longitude, 2, region_name FROM document_study_region)
SELECT latitude, longitude, CASE rank WHEN 0 THEN 'reported' WHEN 1 THEN 'candidate' ELSE 'region' END AS source, id FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY rank, id) AS r FROM u WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) WHERE r = 1""")
def first_seen_union(t: Tables) -> DataFrame:
    """Several sources of coordinates, each value once, from the source that comes first."""
    part = lambda df, rank, id_: df.select("latitude", "longitude", F.lit(rank).alias("rank"), F.col(id_).alias("id"))
    rows = part(t.reported_site, 0, "site_id").unionByName(part(t.location_candidate, 1, "candidate_id")).unionByName(part(t.document_study_region, 2, "region_name")).filter("latitude between -90 and 90 and longitude between -180 and 180")
    first = rows.groupBy("latitude", "longitude").agg(F.min(F.struct("rank", "id")).alias("m"))
    return first.select("latitude", "longitude", F.element_at(F.array(F.lit("reported"), F.lit("candidate"), F.lit("region")), F.col("m.rank") + 1).alias("source"), F.col("m.id").alias("id"))


@R.query("""SELECT artifact_id, property_id, arg_min(candidate_id, struct_pack(d := abs(row_index - 3), c := candidate_id)) AS candidate_id FROM normalized_table_measurement_candidates WHERE artifact_id IS NOT NULL GROUP BY 1, 2""")
def nearest_to_origin(t: Tables) -> DataFrame:
    """Candidate of each field that stands nearest to a row, ties to the smaller id."""
    return t.normalized_table_measurement_candidates.filter("artifact_id is not null").groupBy("artifact_id", "property_id").agg(F.min(F.struct(F.abs(F.col("row_index") - 3), "candidate_id"))["candidate_id"].alias("candidate_id"))


@R.query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY min(o_orderdate), o_custkey LIMIT 25")
def order_by_unselected(t: Tables) -> DataFrame:
    """Sorted by a column that does not come out (a top-k report)."""
    return t.orders.groupBy("o_custkey").agg(_n().alias("n"), F.min("o_orderdate").alias("first")).orderBy("first", "o_custkey").limit(25).drop("first")


@R.query("""(SELECT 'largest' AS side, l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10) UNION ALL (SELECT 'smallest', l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT 10)""")
def largest_smallest(t: Tables) -> DataFrame:
    """Ten largest and ten smallest (a top-k report)."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    top = rows.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10).select(F.lit("largest").alias("side"), "*")
    return top.unionByName(rows.orderBy("l_extendedprice", "l_orderkey", "l_linenumber").limit(10).select(F.lit("smallest").alias("side"), "*"))


@R.query("SELECT p_type, n, r FROM (SELECT p_type, count(*) AS n, corr(l_quantity, l_discount) AS r FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, p_type LIMIT 15")
def strongest_pairs(t: Tables) -> DataFrame:
    """Sorted by absolute value (a top-k report)."""
    r = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(_n().alias("n"), F.corr("l_quantity", "l_discount").alias("r"))
    return r.filter("r is not null and not isnan(r)").orderBy(F.desc(F.abs("r")), "p_type").limit(15)


@R.query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 30 OFFSET 20")
def sliced_window(t: Tables) -> DataFrame:
    """Rows 21 to 50 of an order (a page of a report)."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").offset(20).limit(30)


@R.query("""SELECT document_id, site_id FROM (SELECT document_id, site_id, row_number() OVER (PARTITION BY document_id ORDER BY CASE spatial_confidence WHEN 'exact' THEN 0 WHEN 'reported' THEN 1 ELSE 2 END, site_id) AS r FROM reported_site WHERE document_id IS NOT NULL) WHERE r = 1""")
def priority_pick(t: Tables) -> DataFrame:
    """One row of each group in the order of a ladder, then of the id; a map-side minimum."""
    ladder = F.when(F.col("spatial_confidence") == "exact", 0).when(F.col("spatial_confidence") == "reported", 1).otherwise(2)
    return t.reported_site.filter("document_id is not null").groupBy("document_id").agg(F.min(F.struct(ladder, "site_id"))["site_id"].alias("site_id"))


@R.query("SELECT region_name AS name, mentions, CAST(NULL AS DOUBLE) AS spatial_precision_m FROM document_study_region UNION ALL SELECT name, NULL, spatial_precision_m FROM reported_site")
def differing_columns(t: Tables) -> DataFrame:
    """Frames with different columns, one below the other."""
    a, b = t.document_study_region.select(F.col("region_name").alias("name"), "mentions"), t.reported_site.select("name", "spatial_precision_m")
    return a.unionByName(b, allowMissingColumns=True)


@R.query("""SELECT candidate_id, to_json(struct_pack(artifact_id := artifact_id, "row" := row_index, "column" := column_index, unit := unit_raw)) AS locator FROM normalized_table_measurement_candidates""")
def compact_json(t: Tables) -> DataFrame:
    """Compact JSON, keys in order, nulls kept."""
    fields = F.struct("artifact_id", F.col("row_index").alias("row"), F.col("column_index").alias("column"), F.col("unit_raw").alias("unit"))
    return t.normalized_table_measurement_candidates.select("candidate_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("locator"))


@R.query("SELECT l_orderkey, l_linenumber, floor(l_extendedprice * l_discount * 10 + 0.5) / 10 AS rounded FROM lineitem")
def rounded_values(t: Tables) -> DataFrame:
    """Rounded half up on the binary value, the same on every engine."""
    return t.lineitem.select("l_orderkey", "l_linenumber", (F.floor(F.col("l_extendedprice") * F.col("l_discount") * 10 + 0.5) / 10).alias("rounded"))


@R.query("""WITH b AS (SELECT document_id, min(latitude) AS s, max(latitude) AS n, min(longitude) AS w, max(longitude) AS e FROM reported_site WHERE document_id IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 GROUP BY 1)
SELECT document_id, sqrt(pow((n - s) * 111000, 2) + pow((e - w) * 111000 * cos(radians((s + n) / 2)), 2)) / 2 AS precision_m FROM b""")
def box_precision(t: Tables) -> DataFrame:
    """Half the diagonal of a bounding box in metres."""
    rows = t.reported_site.filter("document_id is not null and latitude between -90 and 90 and longitude between -180 and 180").groupBy("document_id")
    b = rows.agg(F.min("latitude").alias("s"), F.max("latitude").alias("n"), F.min("longitude").alias("w"), F.max("longitude").alias("e"))
    down, across = (F.col("n") - F.col("s")) * 111000, (F.col("e") - F.col("w")) * 111000 * F.cos(F.radians((F.col("s") + F.col("n")) / 2))
    return b.select("document_id", (F.hypot(down, across) / 2).alias("precision_m"))


@R.query("""WITH y AS (SELECT doc_id, list_sort(list_distinct(list_transform(regexp_extract_all(text, '\\b(?:18|19|20)[0-9]{2}\\b'), lambda x: CAST(x AS INTEGER)))) AS years FROM documents WHERE text IS NOT NULL)
SELECT doc_id, years[1] AS first_year, years[len(years)] AS last_year, CASE WHEN len(years) = 1 THEN 'single' WHEN years[len(years)] - years[1] <= 5 THEN 'range' ELSE 'many' END AS kind FROM y WHERE len(years) > 0""")
def stated_years(t: Tables) -> DataFrame:
    """Years that a text states, and whether they are one, a short range or many."""
    found = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"\b(?:18|19|20)[0-9]{2}\b"), F.lit(0)), lambda x: x.cast("int"))))
    rows = t.documents.filter("text is not null").select("doc_id", found.alias("y")).filter("size(y) > 0").select("doc_id", F.col("y")[0].alias("first_year"), F.element_at("y", -1).alias("last_year"), F.size("y").alias("n"))
    return rows.select("doc_id", "first_year", "last_year", F.when(F.col("n") == 1, "single").when(F.col("last_year") - F.col("first_year") <= 5, "range").otherwise("many").alias("kind"))


@R.query("SELECT o_orderkey, year(o_orderdate) AS y FROM orders")
def date_parts_year(t: Tables) -> DataFrame:
    """Year out of a nested array of date parts in JSON."""
    parts = F.format_string('{"date-parts":[[%d,%d,%d]]}', F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    return t.orders.select("o_orderkey", F.get_json_object(parts, "$.date-parts[0][0]").cast("long").alias("y"))


@R.query("""SELECT document_id, title FROM document WHERE regexp_matches(title, '(?i)soil|почв') AND NOT (regexp_matches(title, '(?i)profile|профил') AND NOT regexp_matches(title, '(?i)record|строение'))""")
def counter_condition(t: Tables) -> DataFrame:
    """A pattern and not (another without a third)."""
    has = lambda p: F.col("title").rlike(f"(?iu){p}")
    return t.document.filter(has("soil|почв") & ~(has("profile|профил") & ~has("record|строение"))).select("document_id", "title")


@R.query("""SELECT candidate_id, regexp_matches(lower(concat_ws(' ', property_header_raw, row_label_raw)), '(lsd|cv|mean|среднее|нср)( |$|,)') AS excluded FROM normalized_table_measurement_candidates WHERE NOT regexp_matches(lower(concat_ws(' ', property_header_raw, row_label_raw)), 'total|общ')""")
def analytic_exclusion(t: Tables) -> DataFrame:
    """Rules on header and label read together."""
    said = F.lower(F.concat_ws(" ", "property_header_raw", "row_label_raw"))
    return t.normalized_table_measurement_candidates.filter(~said.rlike("total|общ")).select("candidate_id", said.rlike("(lsd|cv|mean|среднее|нср)( |$|,)").alias("excluded"))


@R.query("""WITH p AS (SELECT d.property_id, canonical_name, category, canonical_unit, count(DISTINCT document_id) AS documents FROM property_definition d JOIN normalized_table_measurement_candidates USING (property_id) GROUP BY ALL)
SELECT * FROM p WHERE (contains(lower(property_id), 'or') OR contains(lower(canonical_name), 'or') OR contains(lower(category), 'or') OR contains(lower(canonical_unit), 'or')) AND category IN ('organic', 'macronutrient', 'hydrophysical') AND documents >= 2""")
def interactive_filter(t: Tables) -> DataFrame:
    """A text searched in four columns, a choice of categories, and properties of few documents hidden."""
    counts = t.normalized_table_measurement_candidates.groupBy("property_id").agg(F.count_distinct("document_id").alias("documents"))
    return agg.searched(t.property_definition.join(counts, "property_id"), "or", ["property_id", "canonical_name", "category", "canonical_unit"]).filter(F.col("category").isin("organic", "macronutrient", "hydrophysical") & (F.col("documents") >= 2)).select("property_id", "canonical_name", "category", "canonical_unit", "documents")


@R.query("SELECT corpus, count(*) FILTER (WHERE starts_with(document_id, corpus || ':')) AS own, count(*) AS rows FROM document WHERE corpus IS NOT NULL GROUP BY 1")
def prefix_probe(t: Tables) -> DataFrame:
    return t.document.filter("corpus is not null").groupBy("corpus").agg(F.count_if(F.col("document_id").startswith(F.concat("corpus", F.lit(":")))).alias("own"), _n().alias("rows"))


@R.query("""SELECT doc_id, regexp_matches(text, '(?is)(samples? were taken|образцы отобраны).{0,120}(horizon|горизонт)') OR regexp_matches(text, '(?is)(horizon|горизонт).{0,120}(samples? were taken|образцы отобраны)') AS near FROM documents WHERE text IS NOT NULL""")
def proximity(t: Tables) -> DataFrame:
    """An action within some characters of a label, on either side."""
    act, label = "(samples? were taken|образцы отобраны)", "(horizon|горизонт)"
    near = F.col("text").rlike(f"(?isu){act}.{{0,120}}{label}") | F.col("text").rlike(f"(?isu){label}.{{0,120}}{act}")
    return t.documents.filter("text is not null").select("doc_id", near.alias("near"))


@R.query("""SELECT doc_id, length(regexp_replace(text, '(?s)(References|Bibliography|Литература|Список литературы).*$', '')) AS kept, contains(regexp_replace(text, '(?s)(References|Bibliography|Литература|Список литературы).*$', ''), 'horizon') AS mentioned FROM documents WHERE text IS NOT NULL""")
def before_bibliography(t: Tables) -> DataFrame:
    """Nothing after the heading of the bibliography counts."""
    body = F.regexp_replace("text", r"(?s)(References|Bibliography|Литература|Список литературы).*$", "")
    return t.documents.filter("text is not null").select("doc_id", F.length(body).cast("long").alias("kept"), F.contains(body, F.lit("horizon")).alias("mentioned"))


@R.query("""WITH a(property_id, unit_raw) AS (VALUES ('clay', '%'), ('sand', '%'), ('zinc', 'mg/kg'), ('ph_h2o', 'pH')), c AS (SELECT property_id, unit_raw FROM normalized_table_measurement_candidates WHERE property_id IN (SELECT property_id FROM a))
SELECT c.property_id, count(a.property_id) AS allowed, count(*) - count(a.property_id) AS mismatched FROM c LEFT JOIN a ON a.property_id = c.property_id AND a.unit_raw = c.unit_raw GROUP BY 1""")
def allow_list(t: Tables) -> DataFrame:
    """Rows on a list of pairs, and rows of its keys that are not."""
    listed = t.spark.createDataFrame([("clay", "%"), ("sand", "%"), ("zinc", "mg/kg"), ("ph_h2o", "pH")], "property_id string, unit string")
    rows = t.normalized_table_measurement_candidates.select("property_id", "unit_raw").join(listed, "property_id")
    return rows.groupBy("property_id").agg(F.count_if(F.col("unit_raw") == F.col("unit")).alias("allowed"), F.count_if(~F.coalesce(F.col("unit_raw") == F.col("unit"), F.lit(False))).alias("mismatched"))


@R.query("""SELECT site_id, spatial_confidence IN ('exact', 'reported') AND latitude BETWEEN -90 AND 90 AS trusted, coalesce(spatial_precision_m <= 100, false) AS precise, coalesce(latitude BETWEEN 41 AND 82 AND longitude BETWEEN 19 AND 180, false) AS in_bounds,
CASE WHEN latitude BETWEEN 41 AND 82 AND longitude BETWEEN 19 AND 180 THEN latitude END AS lat, CASE WHEN latitude BETWEEN 41 AND 82 AND longitude BETWEEN 19 AND 180 THEN longitude END AS lon FROM reported_site""")
def trust_flags(t: Tables) -> DataFrame:
    """Derived flags, and coordinates that are null outside the bounds."""
    inside = F.col("latitude").between(41, 82) & F.col("longitude").between(19, 180)
    return t.reported_site.select(
        "site_id", (F.col("spatial_confidence").isin("exact", "reported") & F.col("latitude").between(-90, 90)).alias("trusted"), F.coalesce(F.col("spatial_precision_m") <= 100, F.lit(False)).alias("precise"),
        F.coalesce(inside, F.lit(False)).alias("in_bounds"), F.when(inside, F.col("latitude")).alias("lat"), F.when(inside, F.col("longitude")).alias("lon"),
    )


@R.query("""WITH f AS (SELECT artifact_id, row_index, sum(v) AS total, count(*) AS n FROM (SELECT artifact_id, row_index, property_id, min(value_num) AS v FROM normalized_table_measurement_candidates WHERE property_id IN ('clay', 'sand', 'silt') AND value_num IS NOT NULL AND NOT isnan(value_num) AND artifact_id IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT CASE WHEN abs(total - 100) <= 1 THEN 'within_1' WHEN abs(total - 100) <= 5 THEN 'within_5' ELSE 'other' END AS verdict, count(*) AS rows FROM f GROUP BY 1""")
def fraction_sums(t: Tables) -> DataFrame:
    """Whether the fractions of a table row add up to a hundred."""
    rows = t.normalized_table_measurement_candidates.filter("property_id in ('clay', 'sand', 'silt') and value_num is not null and not isnan(value_num) and artifact_id is not null")
    one = rows.groupBy("artifact_id", "row_index", "property_id").agg(F.min("value_num").alias("v"))
    f = one.groupBy("artifact_id", "row_index").agg(F.sum("v").alias("total"), _n().alias("n")).filter("n >= 2")
    off = F.abs(F.col("total") - 100)
    return f.groupBy(F.when(off <= 1, "within_1").when(off <= 5, "within_5").otherwise("other").alias("verdict")).agg(_n().alias("rows"))


@R.query("""WITH l AS (SELECT document_id, count(DISTINCT site_id) AS sites, max(CASE WHEN name IS NOT NULL AND trim(name) <> '' THEN 1 ELSE 0 END) AS named FROM reported_site WHERE document_id IS NOT NULL GROUP BY 1)
SELECT CASE WHEN sites IS NULL THEN 'no_site' WHEN sites = 1 AND named = 1 THEN 'single_labelled' WHEN sites = 1 THEN 'single_unlabelled' ELSE 'several' END AS linkage, count(*) AS documents FROM (SELECT DISTINCT document_id FROM document) d LEFT JOIN l USING (document_id) GROUP BY 1""")
def review_linkage(t: Tables) -> DataFrame:
    """Four classes of how the documents of a review queue are linked to sites."""
    l = t.reported_site.filter("document_id is not null").groupBy("document_id").agg(F.count_distinct("site_id").alias("sites"), F.max(F.coalesce((F.trim("name") != "").cast("int"), F.lit(0))).alias("named"))
    rows = t.document.select("document_id").distinct().join(l, "document_id", "left")
    kind = F.when(F.col("sites").isNull(), "no_site").when((F.col("sites") == 1) & (F.col("named") == 1), "single_labelled").when(F.col("sites") == 1, "single_unlabelled").otherwise("several")
    return rows.groupBy(kind.alias("linkage")).agg(_n().alias("documents"))


@R.query("""WITH f AS (SELECT artifact_id, row_index, min(document_id) AS d, max(document_id) AS e, string_agg(property_id, ';' ORDER BY property_id) AS v FROM normalized_table_measurement_candidates WHERE document_id IS NOT NULL AND property_id IS NOT NULL AND artifact_id IS NOT NULL GROUP BY 1, 2)
SELECT sha1(v) AS fingerprint, count(*) AS rows FROM f GROUP BY 1 HAVING min(d) <> max(e)""")
def exact_reuse(t: Tables) -> DataFrame:
    """Table rows of the same columns that stand in two or more documents."""
    rows = t.normalized_table_measurement_candidates.filter("document_id is not null and property_id is not null and artifact_id is not null").withColumn("at", F.struct("artifact_id", "row_index"))
    prints = agg.value_fingerprint(rows, "at", ["property_id"])
    owner = rows.groupBy("at").agg(F.min("document_id").alias("d"), F.max("document_id").alias("e"))
    return prints.join(owner, "at").groupBy("fingerprint").agg(_n().alias("rows"), F.min("d").alias("d"), F.max("e").alias("e")).filter("d <> e").select("fingerprint", "rows")


@R.query("""SELECT candidate_id, CASE WHEN abs(value_normalized) > 1000 AND NOT contains(coalesce(warning, ''), 'Outlier.') THEN concat_ws(' ', warning, 'Outlier.') ELSE warning END AS warning FROM table_measurement_candidate_normalization""")
def outlier_marker(t: Tables) -> DataFrame:
    """A mark appended once to the warning of values beyond a bound."""
    far = (F.abs("value_normalized") > 1000) & ~F.contains(F.coalesce("warning", F.lit("")), F.lit("Outlier."))
    return t.table_measurement_candidate_normalization.select("candidate_id", F.when(far, F.concat_ws(" ", "warning", F.lit("Outlier."))).otherwise(F.col("warning")).alias("warning"))


@R.query("""WITH y AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, median(o_totalprice) AS v, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) >= 8) SELECT y, count(*) AS months, regr_slope(v, m) AS slope, regr_r2(v, m) AS r2 FROM y GROUP BY 1 HAVING count(*) >= 3""")
def median_trend(t: Tables) -> DataFrame:
    """Trend of medians per period, periods of few rows left out."""
    y = agg.exact_quantiles(t.orders.select(F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"), "o_totalprice"), ["y", "m"], "o_totalprice", {"v": 0.5}).filter("n >= 8")
    return y.groupBy("y").agg(_n().alias("months"), F.regr_slope("v", "m").alias("slope"), F.regr_r2("v", "m").alias("r2")).filter("months >= 3")
