"""Tests and models over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from humusgrid.operators import stats
from humusgrid.operators.aggregate import exact_quantiles, ranked_values
from humusgrid.operators.autocorrelation import moran_near, moran_near_p
from humusgrid.operators.components import connected_components
from humusgrid.operators.spatial import near_distances
from humusgrid.plans.registry import Registry, Tables

R = Registry()
_SITES = "latitude BETWEEN 41 AND 82 AND longitude BETWEEN 19 AND 180"
_KM = "2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2))))"


@R.query("""WITH p AS (SELECT p_brand, count(*) FILTER (WHERE l_quantity < l_linenumber * 8) AS less, count(*) FILTER (WHERE l_quantity > l_linenumber * 8) AS more FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 2 GROUP BY 1)
SELECT p_brand, less, more, least(1.0, 2 * (SELECT sum(exp(lgamma(less + more + 1) - lgamma(k + 1) - lgamma(less + more - k + 1) - (less + more) * ln(2.0))) FROM range(0, least(less, more) + 1) AS r(k))) AS p FROM p""")
def sign_test(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part.filter("p_size <= 2"), F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.col("l_quantity").cast("double").alias("a"), (F.col("l_linenumber") * 8).cast("double").alias("b"))
    return stats.sign_test(rows, ["p_brand"], "a", "b")


@R.query("""WITH d AS (SELECT p_size, count(*) AS n, regr_slope(l_extendedprice, l_discount) AS slope, regr_r2(l_extendedprice, l_discount) AS r2 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) SELECT p_size, n, slope, r2, sign(slope) * sqrt(r2 * (n - 2) / (1 - r2)) AS t FROM d""")
def slope_t(t: Tables) -> DataFrame:
    """t of the slopes; their p is slope_p."""
    return stats.ols_test(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["p_size"], "l_discount", "l_extendedprice").select("p_size", "n", "slope", "r2", "t")


@R.query()
def slope_p(t: Tables) -> DataFrame:
    return stats.ols_test(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["p_size"], "l_discount", "l_extendedprice").select("p_size", "p")


@R.query("""WITH r AS (SELECT p_size AS g, l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE AS y FROM lineitem JOIN part ON l_partkey = p_partkey), l AS (SELECT g, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(x) AS m, regr_sxx(y, x) AS sxx, count(*) AS n, regr_syy(y, x) * (1 - regr_r2(y, x)) AS sse FROM r GROUP BY 1),
e AS (SELECT r.g, x, n, sse, y - a - b * x AS e, 1.0 / n + pow(x - m, 2) / sxx AS h FROM r JOIN l USING (g))
SELECT g AS p_size, count(*) AS n, count(*) * pow(corr(e * e, x), 2) AS breusch_pagan, count(*) FILTER (WHERE e * e * h / (2 * sse / (n - 2) * pow(1 - h, 2)) > 4.0 / n) AS influential FROM e GROUP BY 1""")
def residual_diagnostics(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_size", F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))
    return stats.residual_diagnostics(rows, ["p_size"], "x", "y").select("p_size", "n", "breusch_pagan", "influential")


@R.query(f"""WITH s AS (SELECT site_id, latitude, publication_year::DOUBLE AS year, floor(latitude / 2) AS cy, floor(longitude / 2) AS cx FROM reported_site WHERE {_SITES} AND publication_year IS NOT NULL AND site_id IS NOT NULL), r AS (SELECT *, md5('20260803:' || r || ':' || site_id) AS h FROM s, range(1, 201) AS q(r)),
p AS (SELECT r, cy, cx, arg_min(struct_pack(x := latitude, y := year), struct_pack(h := h, x := latitude, y := year)) AS d FROM r GROUP BY 1, 2, 3), k AS (SELECT r, regr_slope(d.y, d.x) AS slope FROM p GROUP BY 1)
SELECT count(*) AS replicates, quantile_cont(slope, 0.025) AS low, quantile_cont(slope, 0.5) AS median, quantile_cont(slope, 0.975) AS high FROM k""")
def thinned_trend(t: Tables) -> DataFrame:
    """Quantiles of the trend over 200 spatially thinned replicates."""
    rows = t.reported_site.filter(_SITES + " and publication_year is not null and site_id is not null").select("site_id", "latitude", F.col("publication_year").cast("double").alias("year"), F.floor(F.col("latitude") / 2).alias("cy"), F.floor(F.col("longitude") / 2).alias("cx"))
    slopes = stats.thinned_slopes(rows, ["cy", "cx"], "site_id", "latitude", "year", 200, 20260803).withColumn("_g", F.lit(0))
    return exact_quantiles(slopes, ["_g"], "slope", {"low": 0.025, "median": 0.5, "high": 0.975}).select(F.col("n").alias("replicates"), "low", "median", "high")


def _dated_sites(t: Tables) -> DataFrame:
    rows = t.reported_site.filter(_SITES + " and publication_year is not null and site_id is not null")
    return rows.groupBy("site_id").agg(F.min(F.struct("latitude", "longitude", "publication_year")).alias("m")).select(F.col("site_id").alias("id"), "m.latitude", "m.longitude", F.col("m.publication_year").cast("double").alias("value"))


@R.query(f"""WITH p AS (SELECT site_id AS id, min(struct_pack(y := latitude, x := longitude, v := publication_year)) AS m FROM reported_site WHERE {_SITES} AND publication_year IS NOT NULL AND site_id IS NOT NULL GROUP BY 1), s AS (SELECT id, m.y AS y, m.x AS x, m.v - avg(m.v) OVER () AS d FROM p),
w AS (SELECT a.d AS da, b.d AS db, 1 / greatest({_KM}, 0.001) AS w FROM s a JOIN s b ON a.id < b.id WHERE {_KM} <= 500), o AS (SELECT count(*) AS n, sum(d * d) AS ss FROM s) SELECT max(n) AS n, max(n) * sum(w * da * db) / (sum(w) * max(ss)) AS moran_i FROM w, o""")
def moran(t: Tables) -> DataFrame:
    """Moran's I of the publication years of sites, by inverse distance up to 500 km."""
    return moran_near(_dated_sites(t), 500.0)


@R.query()
def moran_permutations(t: Tables) -> DataFrame:
    """The same with its p over 99 seeded permutations."""
    return moran_near_p(_dated_sites(t), 500.0, 99, 20260803)


@R.query("""WITH g AS (SELECT DISTINCT c_mktsegment AS g FROM customer), p AS (SELECT a.g AS a, b.g AS b FROM g a JOIN g b ON a.g < b.g), d AS (SELECT a, b, c_mktsegment AS g, c_acctbal AS v FROM p JOIN customer ON c_mktsegment = a OR c_mktsegment = b),
r AS (SELECT *, rank() OVER (PARTITION BY a, b ORDER BY v) + (count(*) OVER (PARTITION BY a, b, v) - 1) / 2.0 AS mid FROM d)
SELECT a, b, count(*) FILTER (WHERE g = a) AS n1, count(*) FILTER (WHERE g = b) AS n2, sum(CASE WHEN g = a THEN mid END) - count(*) FILTER (WHERE g = a) * (count(*) FILTER (WHERE g = a) + 1) / 2.0 AS u FROM r GROUP BY 1, 2""")
def group_pairs_u(t: Tables) -> DataFrame:
    """Rank-sum U of every pair of groups; a group's rows enter each of its pairs."""
    groups = t.customer.select(F.col("c_mktsegment").alias("g")).distinct()
    pairs = groups.select(F.col("g").alias("a")).join(groups.select(F.col("g").alias("b")), F.col("a") < F.col("b"))  # groups are few
    member = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("c_mktsegment"))
    rows = t.customer.select("c_mktsegment", "c_acctbal").join(member, "c_mktsegment")
    own = rows.groupBy("a", "b", F.col("c_acctbal").alias("v")).agg(F.count_if(F.col("c_mktsegment") == F.col("a")).alias("na"), F.count_if(F.col("c_mktsegment") == F.col("b")).alias("nb"))
    ranks = ranked_values(rows, ["a", "b"], "c_acctbal").select("a", "b", F.col("_v").alias("v"), (F.col("_before") + (F.col("_c") + 1) / 2.0).alias("mid"))
    s = own.join(ranks, ["a", "b", "v"]).groupBy("a", "b").agg(F.sum("na").alias("n1"), F.sum("nb").alias("n2"), F.sum(F.col("na") * F.col("mid")).alias("ra"))
    return s.select("a", "b", "n1", "n2", (F.col("ra") - F.col("n1") * (F.col("n1") + 1) / 2.0).alias("u"))


@R.query(f"""WITH RECURSIVE s AS (SELECT DISTINCT site_id AS id, latitude AS y, longitude AS x FROM reported_site WHERE {_SITES} AND site_id IS NOT NULL), t(km) AS (VALUES (0.1), (0.5), (1.0), (2.0), (5.0), (10.0)),
d AS (SELECT a.id AS a, b.id AS b, min({_KM}) AS km FROM s a JOIN s b ON a.id <> b.id AND abs(a.y - b.y) < 0.2 GROUP BY 1, 2), e AS (SELECT t.km AS th, a, b FROM d JOIN t ON d.km <= t.km), r AS (SELECT th, a, a AS m FROM e UNION SELECT e.th, e.b, r.m FROM r JOIN e ON e.a = r.a AND e.th = r.th),
c AS (SELECT th, a, min(m) AS part FROM r GROUP BY 1, 2), k AS (SELECT th, count(DISTINCT part) AS parts, count(*) AS linked FROM c GROUP BY 1)
SELECT CAST(t.km AS DOUBLE) AS km, (SELECT count(DISTINCT id) FROM s) - coalesce(linked, 0) + coalesce(parts, 0) AS localities FROM t LEFT JOIN k ON k.th = t.km""")
def localities(t: Tables) -> DataFrame:
    """Single-linkage localities of sites at six thresholds: one graph, its parts by threshold."""
    thresholds = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0)
    sites = t.reported_site.filter(_SITES + " and site_id is not null").select(F.col("site_id").alias("id"), "latitude", "longitude")
    pairs = near_distances(sites, max(thresholds)).withColumn("th", F.explode(F.filter(F.array(*[F.lit(x) for x in thresholds]), lambda x: x >= F.col("km"))))
    named = lambda c: F.concat_ws("|", F.col("th").cast("string"), c)
    parts = connected_components(pairs.select(named("id_a").alias("a"), named("id_b").alias("b")), "a", "b")
    linked = parts.groupBy(F.substring_index("id", "|", 1).cast("double").alias("km")).agg(F.count_distinct("component").alias("parts"), F.count(F.lit(1)).alias("linked"))
    total = sites.agg(F.count_distinct("id").alias("n"))
    listed = t.spark.createDataFrame([(x,) for x in thresholds], "km double")
    return listed.join(linked, "km", "left").join(F.broadcast(total)).select("km", (F.col("n") - F.coalesce("linked", F.lit(0)) + F.coalesce("parts", F.lit(0))).alias("localities"))
