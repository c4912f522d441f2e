"""Projections, joins, aggregates, windows and statistics over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from humusgrid.operators import aggregate as agg
from humusgrid.operators import joins, stats
from humusgrid.operators.spatial import nearest_other
from humusgrid.operators.topics import TOPICS, text_topics
from humusgrid.plans.registry import Registry, Tables

R = Registry()
REVENUE = "l_extendedprice * (1 - l_discount)"


@R.query("""SELECT n_name, count(*) AS observations, avg(l_extendedprice) AS mean_value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE l_discount < 0.08 GROUP BY n_name ORDER BY observations DESC, n_name LIMIT 40""")
def canned_property_means(t: Tables) -> DataFrame:
    """Star join, trust filter, means of the most observed groups (a top-k report)."""
    rows = t.lineitem.filter("l_discount < 0.08").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("observations"), F.avg("l_extendedprice").alias("mean_value")).orderBy(F.desc("observations"), "n_name").limit(40)


@R.query("SELECT CAST(floor(l_quantity / 10) * 10 AS INTEGER) AS bin, count(*) AS n, avg(l_extendedprice) AS mean_value FROM lineitem GROUP BY 1")
def canned_depth_bins(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(agg.truncated_bin(F.col("l_quantity"), 10).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("l_extendedprice").alias("mean_value"))


@R.query("""SELECT year(o_orderdate) AS y, count(*) AS n, 100.0 * sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*) AS pct FROM orders GROUP BY 1 HAVING count(*) >= 50""")
def canned_year_share_having(t: Tables) -> DataFrame:
    out = t.orders.groupBy(F.year("o_orderdate").cast("long").alias("y")).agg(F.count(F.lit(1)).alias("n"), (100.0 * agg.count_where(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("pct"))
    return out.filter("n >= 50")


@R.query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'O' AND l_quantity BETWEEN 10 AND 20 AND l_discount IN (0.04, 0.05)")
def canned_ready_subset(t: Tables) -> DataFrame:
    return t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") != "O") & F.col("l_quantity").between(10, 20) & F.col("l_discount").isin(0.04, 0.05)).select("l_orderkey", "l_linenumber", "l_partkey")


@R.query("SELECT p_type, count(*) AS n, count(DISTINCT p_brand) AS brands, 100.0 * count(*) / (SELECT count(*) FROM part) AS pct FROM part GROUP BY p_type")
def canned_category_pct(t: Tables) -> DataFrame:
    out = t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_brand").alias("brands"))
    return out.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


@R.query("""SELECT r_name, p_type, count(*) AS n, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def star_join(t: Tables) -> DataFrame:
    # partial sums per key pair before the wide joins: only two small keys travel
    rows = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr(REVENUE)).alias("rev"))
    rows = rows.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("r_name", "p_type").agg(F.sum("n").alias("n"), F.sum("rev").alias("revenue"))


@R.query("""SELECT c_custkey, count(o_orderkey) AS urgent FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' GROUP BY c_custkey""")
def left_join_on_filter(t: Tables) -> DataFrame:
    """The condition stays in the join, so customers without such orders keep a row."""
    return t.customer.join(t.orders, (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_orderpriority") == "1-URGENT"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("urgent"))


@R.query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def semi_exists(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.filter("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@R.query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_not_exists(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@R.query("SELECT document_id, count(*) AS n FROM source_artifact WHERE document_id NOT IN (SELECT document_id FROM document WHERE document_id IS NOT NULL) GROUP BY 1")
def anti_not_in(t: Tables) -> DataFrame:
    return joins.not_in(t.source_artifact, "document_id", t.document.select("document_id")).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))


@R.query("""WITH a AS (SELECT DISTINCT document_id, 'reported' AS tier FROM reported_site WHERE spatial_confidence IN ('exact', 'reported') AND document_id IS NOT NULL),
b AS (SELECT DISTINCT document_id, 'located' AS tier FROM reported_site WHERE document_id IS NOT NULL AND document_id NOT IN (SELECT document_id FROM a)),
c AS (SELECT DISTINCT document_id, 'region' AS tier FROM document_study_region WHERE document_id IS NOT NULL AND document_id NOT IN (SELECT document_id FROM a UNION SELECT document_id FROM b))
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def tier_merge(t: Tables) -> DataFrame:
    """Best spatial tier of each document: one aggregate over a union instead of stacked anti joins."""
    known = t.reported_site.select("document_id", F.when(F.col("spatial_confidence").isin("exact", "reported"), 1).otherwise(2).alias("rank")).unionByName(t.document_study_region.select("document_id", F.lit(3).alias("rank")))
    best = known.filter("document_id is not null").groupBy("document_id").agg(F.min("rank").alias("rank"))
    return best.select("document_id", F.element_at(F.array(F.lit("reported"), F.lit("located"), F.lit("region")), F.col("rank")).alias("tier"))


@R.query("SELECT document_id, min(site_id) AS site_id FROM reported_site WHERE document_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT site_id) = 1")
def unique_partner_join(t: Tables) -> DataFrame:
    return joins.unique_partner(t.reported_site.filter("document_id is not null"), "document_id", "site_id")


@R.query("""WITH k AS (SELECT o_custkey, o_orderdate, count(*) AS n, min(o_orderkey) AS o FROM orders GROUP BY 1, 2), f AS (SELECT * FROM k WHERE n = 1)
SELECT f.o AS order_a, g.o AS order_b FROM f JOIN f g ON f.o_custkey = g.o_custkey AND f.o_orderdate = g.o_orderdate""")
def unique_composite_link(t: Tables) -> DataFrame:
    a = t.orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("order_a"))
    b = t.orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("order_b"))
    return joins.unique_key_match(a, b, ["o_custkey", "o_orderdate"]).select("order_a", "order_b")


@R.query("""SELECT a.o_orderkey AS order_a, b.o_orderkey AS order_b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND abs(a.o_totalprice - b.o_totalprice) < 500 AND a.o_orderkey < b.o_orderkey""")
def epsilon_join(t: Tables) -> DataFrame:
    side = lambda s: t.orders.select("o_custkey", F.col("o_orderkey").alias(f"order_{s}"), F.col("o_totalprice").alias(f"v_{s}"))
    return joins.tolerance_join(side("a"), side("b"), ["o_custkey"], "v_a", "v_b", 500.0).filter("order_a < order_b").select("order_a", "order_b")


_SETS = """WITH s AS (SELECT DISTINCT c_mktsegment AS seg, o_custkey AS k, l_partkey AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
a AS (SELECT k, p FROM s WHERE seg = 'BUILDING'), b AS (SELECT k, p FROM s WHERE seg = 'MACHINERY'), na AS (SELECT k, count(*) AS n FROM a GROUP BY 1), nb AS (SELECT k, count(*) AS n FROM b GROUP BY 1),
j AS (SELECT a.k AS set_a, b.k AS set_b, count(*) AS shared FROM a JOIN b USING (p) GROUP BY 1, 2),
r AS (SELECT set_a, set_b, shared, na.n AS n_a, nb.n AS n_b, shared * 1.0 / (na.n + nb.n - shared) AS jaccard FROM j JOIN na ON na.k = set_a JOIN nb ON nb.k = set_b WHERE shared >= 3)"""


def _similar(t: Tables) -> DataFrame:
    sets = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_custkey", "l_partkey")
    return joins.jaccard_join(sets.filter("c_mktsegment = 'BUILDING'"), sets.filter("c_mktsegment = 'MACHINERY'"), "o_custkey", "l_partkey", 3, 0.0)


@R.query(_SETS + " SELECT set_a, set_b, shared, n_a, n_b, jaccard FROM r WHERE jaccard >= 0.04")
def jaccard_join(t: Tables) -> DataFrame:
    return _similar(t).filter("jaccard >= 0.04")


@R.query(_SETS + """, w AS (SELECT *, row_number() OVER (PARTITION BY set_a ORDER BY jaccard DESC, set_b) AS ra, lead(jaccard) OVER (PARTITION BY set_a ORDER BY jaccard DESC, set_b) AS la,
row_number() OVER (PARTITION BY set_b ORDER BY jaccard DESC, set_a) AS rb, lead(jaccard) OVER (PARTITION BY set_b ORDER BY jaccard DESC, set_a) AS lb FROM r)
SELECT set_a, set_b, shared FROM w WHERE ra = 1 AND rb = 1 AND least(coalesce(jaccard / la, 99), coalesce(jaccard / lb, 99)) >= 1.05""")
def mutual_best_match(t: Tables) -> DataFrame:
    return joins.mutual_best(_similar(t), "set_a", "set_b", "jaccard", 1.05).select("set_a", "set_b", "shared")


@R.query("""SELECT a.event_id, min(b.ts) AS matched_at FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.ts > a.ts WHERE a.event_type <> 'purchase' GROUP BY 1""")
def asof_forward(t: Tables) -> DataFrame:
    return joins.asof(t.events.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts"), t.events.filter("event_type = 'purchase'"), ["user_id"], "ts", "ts", [], forward=True).select("event_id", "matched_at")


@R.query("""SELECT a.event_id, max(b.ts) AS matched_at FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.ts <= a.ts WHERE a.event_type <> 'purchase' GROUP BY 1""")
def asof_backward(t: Tables) -> DataFrame:
    return joins.asof(t.events.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts"), t.events.filter("event_type = 'purchase'"), ["user_id"], "ts", "ts", []).select("event_id", "matched_at")


@R.query("SELECT event_id, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def adjacent_lead(t: Tables) -> DataFrame:
    return joins.next_rows(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], {"event_id": "next_id", "event_type": "next_type"}).select("event_id", "next_id", "next_type")


@R.query("""WITH s AS (SELECT DISTINCT o_custkey AS g, p_brand AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey), n AS (SELECT i, count(*) AS n FROM s GROUP BY 1)
SELECT a.i AS item_a, b.i AS item_b, count(*) AS shared, any_value(x.n) AS n_a, any_value(y.n) AS n_b, count(*) * 1.0 / (any_value(x.n) + any_value(y.n) - count(*)) AS jaccard
FROM s a JOIN s b ON a.g = b.g AND a.i < b.i JOIN n x ON x.i = a.i JOIN n y ON y.i = b.i GROUP BY 1, 2""")
def all_pairs_cooccurrence(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return agg.pair_counts(rows, "o_custkey", "p_brand")


@R.query("""WITH s AS (SELECT DISTINCT latitude AS y, longitude AS x FROM reported_site WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT (latitude = 0 AND longitude = 0))
SELECT a.y, a.x, min(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2))))) AS nearest_km
FROM s a JOIN s b ON a.y <> b.y OR a.x <> b.x GROUP BY ALL""")
def nearest_neighbour(t: Tables) -> DataFrame:
    """Distance to the nearest other of all unique positions."""
    s = t.reported_site.select(F.struct("latitude", "longitude").alias("id"), "latitude", "longitude")
    return nearest_other(s).select(F.col("latitude").alias("y"), F.col("longitude").alias("x"), F.col("km").alias("nearest_km"))


@R.query("""SELECT p_type, sum(CASE WHEN l_discount < 0.03 THEN 1 ELSE 0 END) AS low, sum(CASE WHEN l_tax > 0.05 THEN l_quantity ELSE 0 END) AS taxed, avg(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS returned_mean,
max(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS max_f FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def conditional_counts(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(
        agg.count_where(F.col("l_discount") < 0.03).alias("low"), F.sum(F.when(F.col("l_tax") > 0.05, F.col("l_quantity")).otherwise(0)).alias("taxed"),
        F.avg(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("returned_mean"), F.max(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))).alias("max_f"),
    )


@R.query("SELECT o_orderpriority, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS f_customers, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def distinct_conditional(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("f_customers"), F.count_distinct("o_custkey").alias("customers"))


@R.query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def group_concat_distinct(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))


@R.query("SELECT document_id, string_agg(DISTINCT printf('%.6f,%.6f', latitude, longitude), ';' ORDER BY printf('%.6f,%.6f', latitude, longitude)) AS points FROM reported_site WHERE document_id IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude IS NOT NULL GROUP BY 1")
def group_concat_points(t: Tables) -> DataFrame:
    point = F.format_string("%.6f,%.6f", "latitude", "longitude")
    return t.reported_site.filter("document_id is not null and latitude between -90 and 90 and longitude is not null").groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_set(point)), ";").alias("points"))


@R.query("""WITH a AS (SELECT document_id, count(*) AS artifacts FROM source_artifact GROUP BY 1), s AS (SELECT document_id, count(DISTINCT site_id) AS sites FROM reported_site GROUP BY 1)
SELECT d.document_id, coalesce(a.artifacts, 0) AS artifacts, coalesce(s.sites, 0) AS sites, CASE WHEN s.sites = 1 THEN 'single' WHEN s.sites > 1 THEN 'multiple' ELSE 'none' END AS readiness
FROM (SELECT DISTINCT document_id FROM document) d LEFT JOIN a ON a.document_id = d.document_id LEFT JOIN s ON s.document_id = d.document_id""")
def cte_preagg_join(t: Tables) -> DataFrame:
    """Pre-aggregates joined to one base, with a ladder on the result."""
    a = t.source_artifact.groupBy("document_id").agg(F.count(F.lit(1)).alias("artifacts"))
    s = t.reported_site.groupBy("document_id").agg(F.count_distinct("site_id").alias("sites"))
    out = t.document.select("document_id").distinct().join(a, "document_id", "left").join(s, "document_id", "left")
    ladder = F.when(F.col("sites") == 1, "single").when(F.col("sites") > 1, "multiple").otherwise("none")
    return out.select("document_id", F.coalesce("artifacts", F.lit(0)).alias("artifacts"), F.coalesce("sites", F.lit(0)).alias("sites"), ladder.alias("readiness"))


@R.query("""WITH r AS (SELECT property_id, value_num AS v, row_number() OVER (PARTITION BY property_id ORDER BY value_num) - 1 AS i, count(*) OVER (PARTITION BY property_id) AS n FROM normalized_table_measurement_candidates WHERE value_num IS NOT NULL)
SELECT property_id, max(n) AS n, max(CASE WHEN i = floor((n - 1) * 0.25) THEN v END) AS p25, max(CASE WHEN i = floor((n - 1) * 0.5) THEN v END) AS p50, max(CASE WHEN i = floor((n - 1) * 0.75) THEN v END) AS p75 FROM r GROUP BY 1""")
def lower_percentiles(t: Tables) -> DataFrame:
    return agg.lower_percentiles(t.normalized_table_measurement_candidates, ["property_id"], "value_num", (0.25, 0.5, 0.75))


@R.query("SELECT property_id, quantile_cont(value_num, 0.25) AS q25, quantile_cont(value_num, 0.5) AS q50, quantile_cont(value_num, 0.75) AS q75, min(value_num) AS lo, max(value_num) AS hi, avg(value_num) AS mean FROM normalized_table_measurement_candidates GROUP BY 1")
def linear_quantiles(t: Tables) -> DataFrame:
    q = agg.exact_quantiles(t.normalized_table_measurement_candidates, ["property_id"], "value_num", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    rest = t.normalized_table_measurement_candidates.groupBy(F.col("property_id").alias("p")).agg(F.min("value_num").alias("lo"), F.max("value_num").alias("hi"), F.avg("value_num").alias("mean"))
    return rest.join(q, F.col("p").eqNullSafe(F.col("property_id")), "left").select(F.col("p").alias("property_id"), "q25", "q50", "q75", "lo", "hi", "mean")


@R.query("""WITH c AS (SELECT property_id, unit_raw, count(*) AS n FROM normalized_table_measurement_candidates WHERE unit_raw IS NOT NULL GROUP BY 1, 2)
SELECT property_id, unit_raw AS mode_unit, n FROM (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY n DESC, unit_raw) AS r FROM c) WHERE r = 1""")
def mode_unit(t: Tables) -> DataFrame:
    c = t.normalized_table_measurement_candidates.filter("unit_raw is not null").groupBy("property_id", "unit_raw").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("property_id").agg(F.min(F.struct(-F.col("n"), "unit_raw")).alias("m"), F.max("n").alias("n")).select("property_id", F.col("m.unit_raw").alias("mode_unit"), "n")


@R.query("""WITH b AS (SELECT property_id, CAST(floor(depth_top_cm / 20) * 20 AS DOUBLE) AS bin, value_num AS v, row_number() OVER (PARTITION BY property_id, floor(depth_top_cm / 20) ORDER BY value_num) - 1 AS i, count(*) OVER (PARTITION BY property_id, floor(depth_top_cm / 20)) AS n
FROM normalized_table_measurement_candidates WHERE depth_top_cm IS NOT NULL AND value_num IS NOT NULL) SELECT property_id, bin, max(n) AS n, max(CASE WHEN i = floor((n - 1) * 0.5) THEN v END) AS p50 FROM b GROUP BY 1, 2 HAVING max(n) >= 3""")
def binned_median(t: Tables) -> DataFrame:
    rows = t.normalized_table_measurement_candidates.filter("depth_top_cm is not null").withColumn("bin", agg.floor_bin(F.col("depth_top_cm"), 20).cast("double"))
    return agg.lower_percentiles(rows, ["property_id", "bin"], "value_num", (0.5,)).filter("n >= 3")


@R.query("""SELECT property_id, ceil(depth_bottom_cm / 20) * 20 AS upper, count(*) AS n, avg(value_num) AS mean FROM normalized_table_measurement_candidates WHERE depth_bottom_cm > 0 AND value_num IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 8""")
def right_closed_bins(t: Tables) -> DataFrame:
    rows = t.normalized_table_measurement_candidates.filter("value_num is not null").withColumn("upper", agg.right_closed_bin(F.col("depth_bottom_cm"), 20).cast("double")).filter("upper is not null")
    return rows.groupBy("property_id", "upper").agg(F.count(F.lit(1)).alias("n"), F.avg("value_num").alias("mean")).filter("n >= 8")


@R.query("""WITH d AS (SELECT DISTINCT region, name, site_id FROM reported_site WHERE region IS NOT NULL AND name IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY name, site_id) AS r FROM d)
SELECT region, string_agg(name || '|' || site_id, ';' ORDER BY r) AS items FROM r WHERE r <= 6 GROUP BY 1""")
def capped_collection(t: Tables) -> DataFrame:
    """At most six named sites of each region, in name order (a map payload)."""
    lists = agg.capped_lists(t.reported_site.filter("region is not null and name is not null").select("region", "name", "site_id").distinct(), "region", ["name", "site_id"], 6)
    return lists.select("region", F.array_join(F.transform("items", lambda x: F.concat_ws("|", x["name"], x["site_id"])), ";").alias("items"))


@R.query("".join(f"{' UNION ALL ' if i else ''}SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL{e}) AS missing, count(*) - count(*) FILTER (WHERE {c} IS NULL{e}) AS present FROM reported_site" for i, (c, e) in enumerate((("name", " OR trim(name) = ''"), ("region", " OR trim(region) = ''"), ("latitude", " OR isnan(latitude)"), ("publication_year", ""), ("document_id", " OR trim(document_id) = ''")))))
def missingness(t: Tables) -> DataFrame:
    return agg.missingness(t.reported_site, ["name", "region", "latitude", "publication_year", "document_id"])


@R.query("SELECT candidate_id, property_id, value_text, count(*) AS rows FROM normalized_table_measurement_candidates GROUP BY ALL HAVING count(*) > 1")
def duplicate_groups(t: Tables) -> DataFrame:
    return agg.duplicate_groups(t.normalized_table_measurement_candidates, ["candidate_id", "property_id", "value_text"])


@R.query("""WITH f AS (SELECT artifact_id, property_id, value_num, row_number() OVER (PARTITION BY artifact_id, property_id ORDER BY row_index, column_index, candidate_id, value_num) AS r FROM normalized_table_measurement_candidates WHERE value_num IS NOT NULL)
SELECT artifact_id, max(CASE WHEN property_id = 'clay' THEN value_num END) AS clay, max(CASE WHEN property_id = 'sand' THEN value_num END) AS sand, max(CASE WHEN property_id = 'ph_h2o' THEN value_num END) AS ph_h2o FROM f WHERE r = 1 GROUP BY 1""")
def pivot_first(t: Tables) -> DataFrame:
    return agg.first_pivot(t.normalized_table_measurement_candidates.filter("value_num is not null"), "artifact_id", "property_id", "value_num", ["clay", "sand", "ph_h2o"], ["row_index", "column_index", "candidate_id"])


@R.query("""WITH b AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem)
SELECT CAST(least(19, floor((l_extendedprice - lo) / ((hi - lo) / 20))) AS INTEGER) AS bin, count(*) AS n FROM lineitem, b WHERE l_extendedprice BETWEEN lo AND hi GROUP BY 1""")
def histogram_clipped(t: Tables) -> DataFrame:
    bounds = agg.exact_quantiles(t.lineitem.select(F.lit(0).alias("g"), "l_extendedprice"), ["g"], "l_extendedprice", {"lo": 0.01, "hi": 0.99}).select("lo", "hi")
    rows = t.lineitem.select("l_extendedprice").join(F.broadcast(bounds), F.col("l_extendedprice").between(F.col("lo"), F.col("hi")))  # one row beside each
    return rows.groupBy(F.least(F.lit(19), F.floor((F.col("l_extendedprice") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / 20))).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@R.query("""SELECT property_id, count(*) AS rows, count(value_num) AS numeric, count(DISTINCT document_id) AS documents, count(DISTINCT artifact_id) AS tables, sum(CASE WHEN candidate_status = 'accepted' THEN 1 ELSE 0 END) AS accepted,
100.0 * count(unit_raw) / count(*) AS unit_pct, 100.0 * count(depth_top_cm) / count(*) AS depth_pct, 100.0 * count(horizon_label) / count(*) AS horizon_pct, min(value_num) AS lo, max(value_num) AS hi, avg(value_num) AS mean, stddev_samp(value_num) AS sd FROM normalized_table_measurement_candidates GROUP BY 1""")
def census(t: Tables) -> DataFrame:
    share = lambda c: 100.0 * F.count(c) / F.count(F.lit(1))
    return t.normalized_table_measurement_candidates.groupBy("property_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value_num").alias("numeric"), F.count_distinct("document_id").alias("documents"), F.count_distinct("artifact_id").alias("tables"), agg.count_where(F.col("candidate_status") == "accepted").alias("accepted"),
        share("unit_raw").alias("unit_pct"), share("depth_top_cm").alias("depth_pct"), share("horizon_label").alias("horizon_pct"), F.min("value_num").alias("lo"), F.max("value_num").alias("hi"), F.avg("value_num").alias("mean"), F.stddev_samp("value_num").alias("sd"),
    )


@R.query("""WITH f AS (SELECT artifact_id, sha1(string_agg(concat_ws(':', property_id, value_text), ';' ORDER BY concat_ws(':', property_id, value_text) COLLATE C)) AS fingerprint, count(*) AS size FROM normalized_table_measurement_candidates GROUP BY 1)
SELECT fingerprint, count(*) AS tables, max(size) AS size FROM f GROUP BY 1""".replace(" COLLATE C", ""))
def vector_fingerprint(t: Tables) -> DataFrame:
    prints = agg.value_fingerprint(t.normalized_table_measurement_candidates, "artifact_id", ["property_id", "value_text"])
    return prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("tables"), F.max("size").alias("size"))


@R.query("""WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY n) AS i, count(*) OVER () AS m, sum(n) OVER () AS s FROM c)
SELECT 2.0 * sum(i * n) / (max(m) * max(s)) - (max(m) + 1.0) / max(m) AS gini FROM r""")
def gini(t: Tables) -> DataFrame:
    return agg.gini(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), "n")


@R.query("SELECT p_type, n, CAST(sum(n) OVER (ORDER BY n DESC, p_type) AS BIGINT) AS running, sum(n) OVER (ORDER BY n DESC, p_type) * 1.0 / sum(n) OVER () AS share FROM (SELECT p_type, count(*) AS n FROM part GROUP BY 1)")
def cumulative_share(t: Tables) -> DataFrame:
    n = t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    run = F.sum("n").over(Window.orderBy(F.desc("n"), "p_type").rowsBetween(Window.unboundedPreceding, 0))
    return n.select("p_type", "n", run.alias("running"), (run / F.sum("n").over(Window.partitionBy())).alias("share"))


@R.query("""WITH c AS (SELECT DISTINCT floor(latitude / 5) * 5 AS y, floor(longitude / 5) * 5 AS x, publication_year < 2000 AS early FROM reported_site WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND publication_year IS NOT NULL)
SELECT a.y, a.x FROM c a JOIN c b ON a.y = b.y AND a.x = b.x WHERE a.early AND NOT b.early""")
def cell_overlap(t: Tables) -> DataFrame:
    """Grid cells occupied in both periods."""
    rows = t.reported_site.filter("latitude between -90 and 90 and longitude between -180 and 180 and publication_year is not null")
    cells = lambda d: d.select(agg.floor_bin(F.col("latitude"), 5).cast("double").alias("y"), agg.floor_bin(F.col("longitude"), 5).cast("double").alias("x"))
    return cells(rows.filter("publication_year < 2000")).intersect(cells(rows.filter("publication_year >= 2000")))


@R.query("""SELECT document_id, region_name, rank AS stated_rank, r FROM (SELECT document_id, region_name, rank, row_number() OVER (PARTITION BY document_id ORDER BY mentions DESC, region_name, rank) AS r FROM (SELECT DISTINCT document_id, region_name, mentions, rank FROM document_study_region)) WHERE r <= 3""")
def topk_ranked(t: Tables) -> DataFrame:
    """Three most mentioned regions of each document (a top-k report)."""
    rows = t.document_study_region.select("document_id", "region_name", "mentions", F.col("rank").alias("stated_rank")).distinct()
    w = Window.partitionBy("document_id").orderBy(F.desc("mentions"), "region_name", "stated_rank")
    return rows.withColumn("r", F.row_number().over(w)).filter("r <= 3").drop("mentions")


@R.query("""WITH s AS (SELECT document_id, region_name, max(mentions) AS m FROM document_study_region GROUP BY 1, 2), w AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY m DESC, region_name) AS r, lead(m) OVER (PARTITION BY document_id ORDER BY m DESC, region_name) AS nxt FROM s)
SELECT document_id, region_name, CASE WHEN nxt IS NULL THEN 'single_region' WHEN m >= 2 * nxt THEN 'dominant_region' ELSE 'multi_region' END AS verdict FROM w WHERE r = 1""")
def dominance_lead(t: Tables) -> DataFrame:
    s = t.document_study_region.groupBy("document_id", "region_name").agg(F.max("mentions").alias("m"))
    w = Window.partitionBy("document_id").orderBy(F.desc("m"), "region_name")
    top = s.withColumn("r", F.row_number().over(w)).withColumn("nxt", F.lead("m").over(w)).filter("r = 1")
    return top.select("document_id", "region_name", F.when(F.col("nxt").isNull(), "single_region").when(F.col("m") >= 2 * F.col("nxt"), "dominant_region").otherwise("multi_region").alias("verdict"))


@R.query("SELECT c_custkey, c_nationkey, rank() OVER w + (count(*) OVER (PARTITION BY c_nationkey, round(c_acctbal)) - 1) / 2.0 AS frank FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY round(c_acctbal))".replace("round(", "floor("))
def fractional_rank(t: Tables) -> DataFrame:
    return stats.fractional_rank(t.customer.select("c_custkey", "c_nationkey", F.floor("c_acctbal").alias("v")), ["c_nationkey"], "v", "frank").drop("v")


@R.query("SELECT user_id, arg_min(value, struct_pack(ts, event_id)) AS first_value, arg_max(value, struct_pack(ts, event_id)) AS last_value, arg_max(value, struct_pack(ts, event_id)) - arg_min(value, struct_pack(ts, event_id)) AS delta FROM events WHERE value IS NOT NULL GROUP BY 1 HAVING count(*) >= 4")
def first_last_delta(t: Tables) -> DataFrame:
    order = F.struct("ts", "event_id")
    out = t.events.filter("value is not null").groupBy("user_id").agg(F.min_by("value", order).alias("first_value"), F.max_by("value", order).alias("last_value"), F.count(F.lit(1)).alias("n"))
    return out.filter("n >= 4").select("user_id", "first_value", "last_value", (F.col("last_value") - F.col("first_value")).alias("delta"))


@R.query("""WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS rx,
rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS ry FROM lineitem) SELECT l_returnflag, count(*) AS n, corr(rx, ry) AS rho FROM r GROUP BY 1""")
def spearman(t: Tables) -> DataFrame:
    return stats.spearman(t.lineitem, ["l_returnflag"], "l_quantity", "l_extendedprice")


@R.query("""WITH c AS (SELECT p_brand, count(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_brand, n, r, (exp(2 * (atanh(r) - 1.96 / sqrt(n - 3))) - 1) / (exp(2 * (atanh(r) - 1.96 / sqrt(n - 3))) + 1) AS low, (exp(2 * (atanh(r) + 1.96 / sqrt(n - 3))) - 1) / (exp(2 * (atanh(r) + 1.96 / sqrt(n - 3))) + 1) AS high FROM c WHERE n >= 30""")
def pearson_fisher_ci(t: Tables) -> DataFrame:
    return stats.pearson(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["p_brand"], "l_quantity", "l_extendedprice", 30)


@R.query("SELECT p_type, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def ols_trend(t: Tables) -> DataFrame:
    return stats.ols_line(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["p_type"], "l_quantity", "l_extendedprice")


@R.query("""WITH y AS (SELECT property_id, depth_top_cm, median(value_num) AS v, count(*) AS n FROM normalized_table_measurement_candidates WHERE value_num > 0 AND depth_top_cm IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 8)
SELECT property_id, count(*) AS depths, -1 / regr_slope(ln(v), depth_top_cm) AS efold_cm FROM y GROUP BY 1 HAVING count(*) >= 3""")
def efold_depth(t: Tables) -> DataFrame:
    """Depth over which the median falls by e, from medians per depth."""
    y = t.normalized_table_measurement_candidates.filter("value_num > 0 and depth_top_cm is not null")
    y = agg.exact_quantiles(y, ["property_id", "depth_top_cm"], "value_num", {"v": 0.5}).filter("n >= 8")
    return y.groupBy("property_id").agg(F.count(F.lit(1)).alias("depths"), (-1 / F.regr_slope(F.log("v"), "depth_top_cm")).alias("efold_cm")).filter("depths >= 3")


@R.query("""WITH p AS (SELECT p_brand, 1.0 / (1 + count(*) % 17) / 20 AS p FROM part GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY p, p_brand) AS k, count(*) OVER () AS m FROM p)
SELECT p_brand, p, least(1.0, min(p * m / k) OVER (ORDER BY k DESC)) AS q FROM k""")
def bh_fdr(t: Tables) -> DataFrame:
    tests = t.part.groupBy("p_brand").agg((1.0 / (1 + F.count(F.lit(1)) % 17) / 20).alias("p"))
    return stats.bh_q(tests, "p", "p_brand")


@R.query("""WITH d AS (SELECT c_mktsegment AS g, c_acctbal AS v FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')), r AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS mid FROM d),
s AS (SELECT sum(CASE WHEN g = 'BUILDING' THEN mid END) AS ra, count(*) FILTER (WHERE g = 'BUILDING') AS n1, count(*) FILTER (WHERE g = 'MACHINERY') AS n2 FROM r), e AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT count(*)::DOUBLE AS c FROM d GROUP BY v))
SELECT n1, n2, ra - n1 * (n1 + 1) / 2.0 AS u, (ra - n1 * (n1 + 1) / 2.0 - n1 * n2 / 2.0) / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2)::DOUBLE * (n1 + n2 - 1)))) AS z FROM s, e""")
def mann_whitney_u(t: Tables) -> DataFrame:
    return stats.mann_whitney(t.customer, "c_mktsegment", "BUILDING", "MACHINERY", "c_acctbal")


@R.query("SELECT property_id, skewness(value_num) AS skew, stddev_samp(value_num) / avg(value_num) AS cv, avg(value_num) / median(value_num) AS mean_median, skewness(value_num) > 1 AND min(value_num) >= 0 AS use_log FROM normalized_table_measurement_candidates GROUP BY 1 HAVING count(value_num) > 2")
def skew_log_rule(t: Tables) -> DataFrame:
    skew = stats.sample_skewness("value_num")
    rows = t.normalized_table_measurement_candidates
    shape = rows.groupBy(F.col("property_id").alias("p")).agg(skew.alias("skew"), (F.stddev_samp("value_num") / F.avg("value_num")).alias("cv"), F.avg("value_num").alias("mean"), ((skew > 1) & (F.min("value_num") >= 0)).alias("use_log"), F.count("value_num").alias("k")).filter("k > 2")
    median = agg.exact_quantiles(rows, ["property_id"], "value_num", {"q": 0.5})
    return shape.join(median, F.col("p").eqNullSafe(F.col("property_id"))).select("property_id", "skew", "cv", (F.col("mean") / F.col("q")).alias("mean_median"), "use_log")


@R.query("""WITH s AS (SELECT DISTINCT site_id, latitude AS y, longitude AS x FROM reported_site WHERE latitude BETWEEN 41 AND 82 AND longitude BETWEEN 19 AND 180), d AS (SELECT a.site_id, a.y, a.x, min(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2))))) AS km
FROM s a JOIN s b ON a.site_id <> b.site_id GROUP BY ALL) SELECT count(*) AS n, avg(km) / (0.5 / sqrt(count(*) / 17098246.0)) AS ratio, avg(CASE WHEN km < 1 THEN 1.0 ELSE 0.0 END) AS under_1km FROM d""")
def clark_evans(t: Tables) -> DataFrame:
    """Clark-Evans ratio of all sites, each with the nearest of all others."""
    s = t.reported_site.filter("latitude between 41 and 82 and longitude between 19 and 180")
    n = F.count(F.lit(1))
    return nearest_other(s.select(F.col("site_id").alias("id"), "latitude", "longitude")).agg(n.alias("n"), (F.avg("km") / (0.5 / F.sqrt(n / 17098246.0))).alias("ratio"), F.avg(F.when(F.col("km") < 1, 1.0).otherwise(0.0)).alias("under_1km"))


@R.query()
def mixed_model(t: Tables) -> DataFrame:
    """Random-intercept trend of the log value on depth, documents as groups."""
    rows = t.normalized_table_measurement_candidates.filter("value_num > 0 and depth_top_cm is not null").withColumn("y", F.log("value_num"))
    return stats.random_intercept(rows, ["property_id"], "document_id", "depth_top_cm", "y")


@R.query("""SELECT corpus, CASE WHEN regexp_matches(lower(title), 'salin|solon|salt') THEN 'salinity' WHEN regexp_matches(lower(title), 'peat|bog|mire') THEN 'peat' WHEN regexp_matches(lower(title), 'forest|spruce|pine') THEN 'forest' ELSE 'other' END AS topic, count(*) AS n FROM document WHERE title IS NOT NULL GROUP BY ALL""")
def topic_census(t: Tables) -> DataFrame:
    """Ordered first-match classifier over titles (FLT-8); the topic census over texts: text_topic_counts, text_topic_pairs."""
    s = F.lower("title")
    topic = F.when(s.rlike("salin|solon|salt"), "salinity").when(s.rlike("peat|bog|mire"), "peat").when(s.rlike("forest|spruce|pine"), "forest").otherwise("other")
    return t.document.filter("title is not null").groupBy("corpus", topic.alias("topic")).agg(F.count(F.lit(1)).alias("n"))


# The engines' word boundary differs for Cyrillic letters; the SQL spells it out.
_TOPICS = ", ".join(f"('{name}', '" + pattern.replace("\\b", "(?:^|$|[^\\p{L}\\p{N}_])") + "')" for name, pattern in TOPICS.items())


@R.query(f"""SELECT split_part(document_id, ':', 1) AS corpus, topic, count(DISTINCT doc_id) AS documents FROM documents, (VALUES {_TOPICS}) AS t(topic, pattern) WHERE regexp_matches(text, '(?is)' || pattern) GROUP BY 1, 2""")
def text_topic_counts(t: Tables) -> DataFrame:
    """Census of 23 bilingual topics: documents of each corpus with the topic anywhere in their text, several topics a document."""
    corpus = t.documents.select("doc_id", F.split_part("document_id", F.lit(":"), F.lit(1)).alias("corpus")).distinct()
    return text_topics(t.documents, "doc_id", "text").join(corpus, "doc_id").groupBy("corpus", "topic").agg(F.count_distinct("doc_id").alias("documents"))


@R.query(f"""WITH s AS (SELECT DISTINCT doc_id, topic FROM documents, (VALUES {_TOPICS}) AS t(topic, pattern) WHERE regexp_matches(text, '(?is)' || pattern)), n AS (SELECT topic, count(*) AS n FROM s GROUP BY 1)
SELECT a.topic AS item_a, b.topic AS item_b, count(*) AS shared, any_value(x.n) AS n_a, any_value(y.n) AS n_b, count(*) * 1.0 / (any_value(x.n) + any_value(y.n) - count(*)) AS jaccard FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.topic < b.topic JOIN n x ON x.topic = a.topic JOIN n y ON y.topic = b.topic GROUP BY 1, 2""")
def text_topic_pairs(t: Tables) -> DataFrame:
    """Pairs of topics in the same documents, with Jaccard."""
    return agg.pair_counts(text_topics(t.documents, "doc_id", "text"), "doc_id", "topic")


@R.query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props) AND json_extract_string(props, '$.k') IS NOT NULL")
def json_locator(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k")).filter("k is not null")


@R.query("SELECT artifact_type, sum(CASE WHEN metadata_json IS NULL THEN 1 ELSE 0 END) AS absent, sum(CASE WHEN metadata_json IS NOT NULL AND json_valid(metadata_json) THEN 1 ELSE 0 END) AS good FROM source_artifact GROUP BY 1")
def json_tolerant(t: Tables) -> DataFrame:
    """Metadata that parses; broken JSON is null, not an error."""
    good = F.try_parse_json("metadata_json").isNotNull()
    return t.source_artifact.groupBy("artifact_type").agg(agg.count_where(F.col("metadata_json").isNull()).alias("absent"), agg.count_where(good).alias("good"))


@R.query("""SELECT user_id, date_trunc('day', ts) AS day, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2""")
def daily_totals(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@R.query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority), ())")
def marginals(t: Tables) -> DataFrame:
    return t.orders.groupingSets([["o_orderstatus"], ["o_orderpriority"], ["o_orderstatus", "o_orderpriority"], []], "o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@R.query("SELECT document_id, lower(title) AS key, length(title) AS len, substr(title, 1, 20) AS head, split_part(document_id, ':', 2) AS tail, CASE WHEN title ILIKE '%soil%' THEN 1 ELSE 0 END AS soil FROM document WHERE title IS NOT NULL AND authors IS NOT NULL AND trim(title) <> ''")
def text_projection(t: Tables) -> DataFrame:
    rows = t.document.filter("title is not null and authors is not null and trim(title) <> ''")
    return rows.select("document_id", F.lower("title").alias("key"), F.length("title").cast("long").alias("len"), F.substring("title", 1, 20).alias("head"), F.split_part("document_id", F.lit(":"), F.lit(2)).alias("tail"), F.col("title").ilike("%soil%").cast("int").alias("soil"))


@R.query("SELECT DISTINCT trim(a) AS author FROM (SELECT unnest(string_split(authors, ';')) AS a FROM document WHERE authors IS NOT NULL)")
def exploded_authors(t: Tables) -> DataFrame:
    return t.document.filter("authors is not null").select(F.explode(F.split("authors", ";")).alias("a")).select(F.trim("a").alias("author")).distinct()
