"""Joins of documents, places and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from humusgrid.operators import joins
from humusgrid.operators.spatial import points_in_polygons
from humusgrid.plans.registry import Registry, Tables

R = Registry()


@R.query("""SELECT sn.n_name AS supplied_from, cn.n_name AS ordered_from, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN nation cn ON c_nationkey = cn.n_nationkey GROUP BY 1, 2""")
def self_alias_dimension(t: Tables) -> DataFrame:
    """One dimension under two aliases; counted by key before the names are joined."""
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    keyed = rows.groupBy("s_nationkey", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    name = lambda key, as_: t.nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(as_))
    return keyed.join(name("s_nationkey", "supplied_from"), "s_nationkey").join(name("c_nationkey", "ordered_from"), "c_nationkey").select("supplied_from", "ordered_from", "n")


@R.query("""SELECT floor(latitude * 100000 + 0.5) / 100000 AS lat5, floor(longitude * 100000 + 0.5) / 100000 AS lon5, count(DISTINCT site_id) AS sites, min(site_id) AS first_site FROM reported_site
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 GROUP BY 1, 2 HAVING count(DISTINCT site_id) > 1""")
def rounded_coordinate_groups(t: Tables) -> DataFrame:
    """Sites that share a coordinate of five decimals."""
    five = lambda c: F.floor(F.col(c) * 100000 + 0.5) / 100000
    rows = t.reported_site.filter("latitude between -90 and 90 and longitude between -180 and 180")
    return rows.groupBy(five("latitude").alias("lat5"), five("longitude").alias("lon5")).agg(F.count_distinct("site_id").alias("sites"), F.min("site_id").alias("first_site")).filter("sites > 1")


@R.query("""WITH c AS (SELECT document_id FROM reported_site GROUP BY 1 HAVING count(latitude) = count(longitude) AND count(latitude) BETWEEN 2 AND 12),
a AS (SELECT document_id, latitude, row_number() OVER (PARTITION BY document_id ORDER BY site_id, latitude) - 1 AS position FROM reported_site WHERE latitude IS NOT NULL AND document_id IN (SELECT document_id FROM c)),
b AS (SELECT document_id, longitude, row_number() OVER (PARTITION BY document_id ORDER BY site_id, longitude) - 1 AS position FROM reported_site WHERE longitude IS NOT NULL AND document_id IN (SELECT document_id FROM c))
SELECT document_id, CAST(position AS INTEGER) AS position, latitude, longitude FROM a JOIN b USING (document_id, position)""")
def positional_zip(t: Tables) -> DataFrame:
    """Parallel lists of latitudes and longitudes of a document."""
    return joins.zip_lists(t.reported_site.filter("document_id is not null"), "document_id", "latitude", "longitude", "site_id")


_PLAIN = "' ' || regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
_TEXT, _LABEL = _PLAIN.format("d.text"), _PLAIN.format("split_part(s.name, ' ', 1)")


@R.query(f"""WITH x AS (SELECT DISTINCT d.doc_id, s.site_id FROM documents d JOIN reported_site s USING (document_id) WHERE trim({_LABEL}) <> '' AND contains({_TEXT}, ' ' || trim({_LABEL}) || ' '))
SELECT doc_id, count(*) AS sites, CASE WHEN count(*) = 1 THEN min(site_id) END AS only_site FROM x GROUP BY 1""")
def label_containment(t: Tables) -> DataFrame:
    """Place names of sites that stand in the texts of their document; a text that names one site only is linked to it."""
    names = t.reported_site.select("document_id", "site_id", F.split_part("name", F.lit(" "), F.lit(1)).alias("place"))
    found = joins.label_in_text(t.documents, names, "document_id", "doc_id", "text", "site_id", "place")
    n = F.count(F.lit(1))
    return found.groupBy("doc_id").agg(n.alias("sites"), F.min("site_id").alias("s")).select("doc_id", "sites", F.when(F.col("sites") == 1, F.col("s")).alias("only_site"))


@R.query("""WITH a AS (SELECT DISTINCT extraction_id, candidate_id, unnest(regexp_extract_all(context_text, '[0-9]{2,}')) AS label FROM location_candidate), b AS (SELECT DISTINCT extraction_id, unnest(regexp_extract_all(raw_text, '[0-9]{2,}')) AS label FROM extraction)
SELECT extraction_id, count(DISTINCT label) AS shared, count(DISTINCT candidate_id) AS candidates FROM a JOIN b USING (extraction_id, label) GROUP BY 1 HAVING count(DISTINCT candidate_id) = 1""")
def label_set_intersection(t: Tables) -> DataFrame:
    """Labels that a coordinate's context shares with the text it was read from, where they lead to one coordinate only."""
    labels = lambda c: F.explode(F.regexp_extract_all(F.col(c), F.lit("[0-9]{2,}"), F.lit(0))).alias("label")
    a = t.location_candidate.select("extraction_id", "candidate_id", labels("context_text")).distinct()
    b = t.extraction.select("extraction_id", labels("raw_text")).distinct()
    return a.join(b, ["extraction_id", "label"]).groupBy("extraction_id").agg(F.count_distinct("label").alias("shared"), F.count_distinct("candidate_id").alias("candidates")).filter("candidates = 1")


@R.query("""WITH m AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 10), s AS (SELECT l_orderkey FROM m GROUP BY 1 HAVING count(*) >= 2) SELECT l_orderkey, l_partkey FROM m WHERE l_orderkey IN (SELECT l_orderkey FROM s)""")
def series_corroboration(t: Tables) -> DataFrame:
    """Matches count only where at least two of one series match."""
    matched = t.lineitem.join(t.part.filter("p_size <= 10"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_partkey").distinct()
    return matched.join(matched.groupBy("l_orderkey").count().filter("count >= 2"), "l_orderkey", "left_semi")


@R.query("SELECT artifact_type, count(DISTINCT document_id) AS documents FROM source_artifact x WHERE document_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM document d WHERE d.document_id = x.document_id) GROUP BY 1")
def catalog_difference(t: Tables) -> DataFrame:
    """Documents of the extended catalogue that the core one lacks."""
    extended = t.source_artifact.filter("document_id is not null").select("artifact_type", "document_id")
    return extended.join(t.document.select("document_id"), "document_id", "left_anti").groupBy("artifact_type").agg(F.count_distinct("document_id").alias("documents"))


@R.query("""WITH p AS (SELECT profile_id, min(profile_label) AS label FROM profile GROUP BY 1) SELECT e.merge_evidence_id, r.label AS retired_label, c.label AS canonical_label FROM profile_merge_evidence e JOIN p r ON r.profile_id = e.retired_profile_id JOIN p c ON c.profile_id = e.canonical_profile_id""")
def row_by_two_keys(t: Tables) -> DataFrame:
    """Audited pairs looked up by both of their keys."""
    p = t.profile.groupBy("profile_id").agg(F.min("profile_label").alias("label"))
    side = lambda s: p.select(F.col("profile_id").alias(f"{s}_profile_id"), F.col("label").alias(f"{s}_label"))
    return t.profile_merge_evidence.join(side("retired"), "retired_profile_id").join(side("canonical"), "canonical_profile_id").select("merge_evidence_id", "retired_label", "canonical_label")


@R.query("""WITH w AS (SELECT DISTINCT floor(latitude * 10 + 0.5) AS y, floor(longitude * 10 + 0.5) AS x FROM location_candidate WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180),
h AS (SELECT floor(latitude * 10 + 0.5) AS y, floor(longitude * 10 + 0.5) AS x, count(DISTINCT site_id) AS n, min(site_id) AS have FROM reported_site WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 GROUP BY 1, 2)
SELECT CAST(w.y AS BIGINT) AS y, CAST(w.x AS BIGINT) AS x, CASE WHEN n IS NULL THEN 'site:' || substr(sha1(CAST(CAST(w.y AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(w.x AS BIGINT) AS VARCHAR)), 1, 12) WHEN n = 1 THEN have END AS site_id,
CASE WHEN n IS NULL THEN 'created' WHEN n = 1 THEN 'reused' ELSE 'ambiguous' END AS outcome FROM w LEFT JOIN h ON h.y = w.y AND h.x = w.x""")
def reuse_or_create(t: Tables) -> DataFrame:
    """Coordinates of a decimal degree cell: the site that is there, a new one, or too many."""
    cells = lambda df: df.filter("latitude between -90 and 90 and longitude between -180 and 180").withColumn("y", F.floor(F.col("latitude") * 10 + 0.5)).withColumn("x", F.floor(F.col("longitude") * 10 + 0.5))
    new = F.concat(F.lit("site:"), F.substring(F.sha1(F.concat_ws(",", F.col("y").cast("string"), F.col("x").cast("string"))), 1, 12))
    return joins.reuse_or_create(cells(t.location_candidate).select("y", "x").distinct(), cells(t.reported_site).select("y", "x", "site_id"), ["y", "x"], "site_id", new)


@R.query("""WITH a AS (SELECT c_nationkey AS n, floor(c_acctbal / 25) AS b FROM customer), l AS (SELECT s_nationkey AS n, floor(s_acctbal / 25) AS b FROM supplier), ca AS (SELECT n, b, count(*) AS k FROM a GROUP BY 1, 2), cl AS (SELECT n, b, count(*) AS k FROM l GROUP BY 1, 2)
SELECT CASE WHEN cl.k IS NULL THEN 'unmatched' WHEN ca.k > 1 THEN 'ambiguous_left' WHEN cl.k > 1 THEN 'ambiguous_right' ELSE 'linked' END AS outcome, count(*) AS rows FROM a LEFT JOIN ca ON ca.n = a.n AND ca.b = a.b LEFT JOIN cl ON cl.n = a.n AND cl.b = a.b GROUP BY 1""")
def composite_key_report(t: Tables) -> DataFrame:
    """How many rows a composite key links, and why it does not link the others."""
    a = t.customer.select(F.col("c_nationkey").alias("n"), F.floor(F.col("c_acctbal") / 25).alias("b"))
    b = t.supplier.select(F.col("s_nationkey").alias("n"), F.floor(F.col("s_acctbal") / 25).alias("b"))
    return joins.unique_key_report(a, b, ["n", "b"])


def _step(name: str, item: str, before: str) -> str:
    return f"""{name}a AS (SELECT DISTINCT k AS set_a, {item} AS v FROM s WHERE seg = 'BUILDING' AND k NOT IN (SELECT left_id FROM {before})), {name}b AS (SELECT DISTINCT k AS set_b, {item} AS v FROM s WHERE seg = 'MACHINERY' AND k NOT IN (SELECT right_id FROM {before})),
{name}p AS (SELECT set_a, set_b, count(*) AS shared FROM {name}a JOIN {name}b USING (v) GROUP BY 1, 2 HAVING count(*) >= 3),
{name}j AS (SELECT set_a, set_b, shared * 1.0 / (x.n + y.n - shared) AS j FROM {name}p JOIN (SELECT set_a, count(*) AS n FROM {name}a GROUP BY 1) x USING (set_a) JOIN (SELECT set_b, count(*) AS n FROM {name}b GROUP BY 1) y USING (set_b)),
{name}y AS (SELECT {name}j.* FROM {name}j JOIN d da ON da.id = set_a JOIN d db ON db.id = set_b WHERE j >= 0.03 AND abs(da.year - db.year) <= 1),
{name}w AS (SELECT *, row_number() OVER (PARTITION BY set_a ORDER BY j DESC, set_b) AS ra, lead(j) OVER (PARTITION BY set_a ORDER BY j DESC, set_b) AS la, row_number() OVER (PARTITION BY set_b ORDER BY j DESC, set_a) AS rb, lead(j) OVER (PARTITION BY set_b ORDER BY j DESC, set_a) AS lb FROM {name}y),
{name} AS (SELECT set_a AS left_id, set_b AS right_id FROM {name}w WHERE ra = 1 AND rb = 1 AND least(coalesce(j / la, 99), coalesce(j / lb, 99)) >= 1.1)"""


@R.query(f"""WITH s AS (SELECT c_mktsegment AS seg, o_custkey AS k, l_partkey AS part, l_suppkey AS supp FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
d AS (SELECT o_custkey AS id, min(year(o_orderdate)) AS year FROM orders GROUP BY 1), q AS (SELECT c_custkey AS id, c_mktsegment AS seg, c_nationkey AS n, floor(c_acctbal / 10) AS b FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
u AS (SELECT seg, n, b, min(id) AS id FROM q GROUP BY 1, 2, 3 HAVING count(*) = 1), z AS (SELECT x.id AS left_id, y.id AS right_id FROM u x JOIN u y ON x.n = y.n AND x.b = y.b AND x.seg = 'BUILDING' AND y.seg = 'MACHINERY'),
{_step('e', 'part', 'z')}, ze AS (SELECT * FROM z UNION ALL SELECT * FROM e), {_step('f', 'supp', 'ze')}
SELECT *, 'translation_of' AS relation, 'citation' AS evidence FROM z UNION ALL SELECT *, 'same_study', 'trusted_values' FROM e UNION ALL SELECT *, 'same_study', 'raw_cells' FROM f""")
def translation_links(t: Tables) -> DataFrame:
    """The three steps of linking two corpora, on customers of two segments: key, parts ordered, suppliers."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    year = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.min(F.year("o_orderdate")).alias("year"))
    sides, trusted, raw = [], [], []
    for segment in ("BUILDING", "MACHINERY"):
        own = rows.filter(F.col("c_mktsegment") == segment)
        side = t.customer.filter(F.col("c_mktsegment") == segment).select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n"), F.floor(F.col("c_acctbal") / 10).alias("b"))
        sides.append(side.join(year, "id", "left"))
        trusted.append(own.select(F.col("o_custkey").alias("id"), F.col("l_partkey").alias("value")))
        raw.append(own.select(F.col("o_custkey").alias("id"), F.col("l_suppkey").alias("value")))
    return joins.link_translations(*sides, ["n", "b"], tuple(trusted), tuple(raw), 3, 0.03, 1.1)


# Three polygons in degrees, as (name, rings).
_SHAPES = (
    ("west", [[[20.0, 45.0], [60.0, 42.0], [65.0, 60.0], [40.0, 70.0], [20.0, 45.0]], [[40.0, 50.0], [50.0, 50.0], [50.0, 58.0], [40.0, 50.0]]]),
    ("east", [[[100.0, 41.0], [140.0, 41.0], [150.0, 65.0], [110.0, 72.0], [100.0, 41.0]]]),
    ("middle", [[[55.0, 45.0], [105.0, 48.0], [95.0, 66.0], [60.0, 64.0]]]),
)


def _crossings(rings: list) -> str:
    out = []
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if y1 != y2:
                out.append(f"(CASE WHEN ({y1} > latitude) <> ({y2} > latitude) AND longitude < ({x2} - ({x1})) * (latitude - ({y1})) / ({y2} - ({y1})) + ({x1}) THEN 1 ELSE 0 END)")
    return " + ".join(out)


@R.query(" UNION ALL ".join(f"SELECT DISTINCT site_id AS id, '{name}' AS name FROM reported_site WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT (latitude = 0 AND longitude = 0) AND ({_crossings(rings)}) % 2 = 1" for name, rings in _SHAPES))
def polygon_sites(t: Tables) -> DataFrame:
    """Sites within polygons with holes, located in the slabs of their boundaries."""
    shapes = t.spark.createDataFrame(list(_SHAPES), "name string, rings array<array<array<double>>>")
    return points_in_polygons(t.reported_site.select(F.col("site_id").alias("id"), "latitude", "longitude"), shapes)
