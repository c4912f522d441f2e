"""Rewriting of text, lookups, and measures in two steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from humusgrid.operators.stats import auto_log
from humusgrid.plans.registry import Registry, Tables

R = Registry()
_SOFT = "chr(173)"


@R.query(f"""SELECT extraction_id, trim(regexp_replace(regexp_replace(replace(raw_text, {_SOFT}, ''), '([a-zа-яё])-[ \\t]*\\r?\\n[ \\t]*([a-zа-яё])', '\\1\\2', 'g'), '\\s+', ' ', 'g')) AS text FROM extraction WHERE raw_text IS NOT NULL""")
def unwrapped_text(t: Tables) -> DataFrame:
    """Soft hyphens dropped, words joined over line ends, blanks as one space: the plain repair, without any vocabulary."""
    s = F.replace("raw_text", F.lit("­"), F.lit(""))
    s = F.regexp_replace(s, r"([a-zа-яё])-[ \t]*\r?\n[ \t]*([a-zа-яё])", "$1$2")
    return t.extraction.filter("raw_text is not null").select("extraction_id", F.trim(F.regexp_replace(s, r"\s+", " ")).alias("text"))


@R.query("""WITH p AS (SELECT doc_id, text, strpos(text, 'horizon') AS pos FROM documents WHERE strpos(text, 'horizon') > 0) SELECT doc_id, replace(replace(substr(text, greatest(pos - 30, 1), pos + 7 + 30 - greatest(pos - 30, 1)), chr(13), ' '), chr(10), ' ') AS snippet FROM p""")
def snippet_window(t: Tables) -> DataFrame:
    """Text around the first match, cut at the start of the text."""
    rows = t.documents.withColumn("at", F.instr("text", "horizon")).filter("at > 0")
    start = F.greatest(F.col("at") - 30, F.lit(1))
    return rows.select("doc_id", F.translate(F.substr("text", start, F.col("at") + 7 + 30 - start), "\r\n", "  ").alias("snippet"))


@R.query("""SELECT profile_id, translate(upper(trim(profile_label)), 'АВЕКМНОРСТУХ', 'ABEKMHOPCTYX') AS label FROM (SELECT DISTINCT profile_id, profile_label FROM profile WHERE trim(profile_label) <> '' AND regexp_full_match(profile_label, '[A-Za-zА-Яа-я0-9 .-]+'))""")
def homoglyph_labels(t: Tables) -> DataFrame:
    """Labels in one alphabet, letters that look alike as one."""
    rows = t.profile.filter("trim(profile_label) <> ''").filter(F.col("profile_label").rlike("^[A-Za-zА-Яа-я0-9 .-]+$")).select("profile_id", "profile_label").distinct()
    return rows.select("profile_id", F.translate(F.upper(F.trim("profile_label")), "АВЕКМНОРСТУХ", "ABEKMHOPCTYX").alias("label"))


@R.query("""SELECT DISTINCT region, regexp_replace(regexp_replace(region, '^(\\w+) oblast$', 'oblast of \\1'), '^(\\w+) krai$', 'krai of \\1') AS name FROM reported_site WHERE region IS NOT NULL""")
def rewrite_rules(t: Tables) -> DataFrame:
    """Ordered rewrites with references to what they matched."""
    s = F.col("region")
    for pattern, to in ((r"^(\w+) oblast$", "oblast of $1"), (r"^(\w+) krai$", "krai of $1")):
        s = F.regexp_replace(s, pattern, to)
    return t.reported_site.filter("region is not null").select("region", s.alias("name")).distinct()


@R.query("""SELECT land_use, CASE land_use WHEN 'пашня' THEN 'arable' WHEN 'лес' THEN 'forest' WHEN 'залежь' THEN 'fallow' WHEN 'луг' THEN 'meadow' ELSE coalesce(land_use, 'unknown') END AS english, count(*) AS n FROM profile GROUP BY 1, 2""")
def lookup_default(t: Tables) -> DataFrame:
    """A lookup with the value itself, then a word, as its default."""
    words = F.create_map(*[F.lit(x) for pair in (("пашня", "arable"), ("лес", "forest"), ("залежь", "fallow"), ("луг", "meadow")) for x in pair])
    english = F.coalesce(F.try_element_at(words, F.col("land_use")), F.col("land_use"), F.lit("unknown"))
    return t.profile.groupBy("land_use", english.alias("english")).agg(F.count(F.lit(1)).alias("n"))


@R.query("""SELECT document_id, CASE WHEN EXISTS (SELECT 1 FROM reported_site s WHERE s.document_id = d.document_id AND s.spatial_confidence = 'exact') THEN 'exact' WHEN EXISTS (SELECT 1 FROM reported_site s WHERE s.document_id = d.document_id) THEN 'located' ELSE 'none' END AS class FROM (SELECT DISTINCT document_id FROM document) d""")
def existence_class(t: Tables) -> DataFrame:
    """Existence within a ladder: one aggregate beside the documents instead of a question for each."""
    exact = F.coalesce((F.col("spatial_confidence") == "exact").cast("int"), F.lit(0))
    best = t.reported_site.filter("document_id is not null").groupBy("document_id").agg(F.max(exact).alias("e"))
    rows = t.document.select("document_id").distinct().join(best, "document_id", "left")
    return rows.select("document_id", F.when(F.col("e") == 1, "exact").when(F.col("e") == 0, "located").otherwise("none").alias("class"))


@R.query("""SELECT candidate_id, value_normalized, normalizer_version FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY normalized_at, normalizer_version, value_normalized, unit_normalized, normalization_status) AS r FROM table_measurement_candidate_normalization WHERE value_normalized IS NOT NULL AND normalized_at IS NOT NULL AND normalizer_version IS NOT NULL) WHERE r = 1""")
def keep_first(t: Tables) -> DataFrame:
    """First row of each key in a stated order; a map-side minimum."""
    rows = t.table_measurement_candidate_normalization.filter("value_normalized is not null and normalized_at is not null and normalizer_version is not null")
    first = rows.groupBy("candidate_id").agg(F.min(F.struct("normalized_at", "normalizer_version", "value_normalized")).alias("m"))
    return first.select("candidate_id", "m.value_normalized", "m.normalizer_version")


@R.query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(title), ' ')) AS word FROM document WHERE title IS NOT NULL) WHERE length(word) > 4 AND regexp_full_match(word, '[a-z]+') GROUP BY 1 ORDER BY n DESC, word LIMIT 20")
def most_common(t: Tables) -> DataFrame:
    """Most common words, ties by the word (a top-k report)."""
    words = t.document.filter("title is not null").select(F.explode(F.split(F.lower("title"), " ")).alias("word")).filter("length(word) > 4").filter(F.col("word").rlike("^[a-z]+$"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(20)


@R.query("SELECT corpus, count(DISTINCT trim(a)) AS authors, count(DISTINCT document_id) AS documents FROM (SELECT corpus, document_id, unnest(string_split(authors, ';')) AS a FROM document WHERE authors IS NOT NULL) WHERE trim(a) <> '' GROUP BY 1")
def delimited_count(t: Tables) -> DataFrame:
    """Distinct entries of a delimited list."""
    rows = t.document.filter("authors is not null").select("corpus", "document_id", F.explode(F.split("authors", ";")).alias("a")).filter("trim(a) <> ''")
    return rows.groupBy("corpus").agg(F.count_distinct(F.trim("a")).alias("authors"), F.count_distinct("document_id").alias("documents"))


@R.query("""WITH d AS (SELECT property_id, document_id, avg(value_num) AS m FROM normalized_table_measurement_candidates WHERE value_num IS NOT NULL AND NOT isnan(value_num) AND document_id IS NOT NULL GROUP BY 1, 2) SELECT property_id, count(*) AS documents, avg(m) AS mean, stddev_samp(m) AS sd FROM d GROUP BY 1""")
def document_means(t: Tables) -> DataFrame:
    """Means of documents first, then of properties, so that a document of many rows weighs as one."""
    rows = t.normalized_table_measurement_candidates.filter("value_num is not null and not isnan(value_num) and document_id is not null")
    return rows.groupBy("property_id", "document_id").agg(F.avg("value_num").alias("m")).groupBy("property_id").agg(F.count(F.lit(1)).alias("documents"), F.avg("m").alias("mean"), F.stddev_samp("m").alias("sd"))


@R.query("""WITH v AS (SELECT property_id, value_num AS v FROM normalized_table_measurement_candidates WHERE value_num IS NOT NULL AND NOT isnan(value_num)), s AS (SELECT property_id, skewness(v) > 1 AND min(v) >= 0 AND property_id <> 'ph_h2o' AS use_log, min(v) FILTER (WHERE v > 0) / 2 AS floor_ FROM v GROUP BY 1 HAVING count(*) > 2)
SELECT property_id, use_log, avg(CASE WHEN use_log THEN ln(greatest(v, floor_)) ELSE v END) AS mean, stddev_samp(CASE WHEN use_log THEN ln(greatest(v, floor_)) ELSE v END) AS sd FROM v JOIN s USING (property_id) GROUP BY 1, 2""")
def log_transform(t: Tables) -> DataFrame:
    """Skewed non-negative properties on the logarithm, zeros at half the least positive value; acidity is exempt."""
    rows = t.normalized_table_measurement_candidates.filter("value_num is not null and not isnan(value_num)").select("property_id", F.col("value_num").alias("v"))
    made = auto_log(rows, "property_id", "v", ["ph_h2o"])
    return made.groupBy("property_id", "use_log").agg(F.avg("transformed").alias("mean"), F.stddev_samp("transformed").alias("sd"))


@R.query("""WITH d AS (SELECT artifact_id, property_id, depth_top_cm AS x, avg(value_num) AS y FROM normalized_table_measurement_candidates WHERE artifact_id IS NOT NULL AND depth_top_cm IS NOT NULL AND value_num IS NOT NULL AND NOT isnan(value_num) GROUP BY 1, 2, 3)
SELECT artifact_id, property_id, count(*) AS depths, arg_min(y, x) AS top, arg_max(y, x) AS bottom, arg_max(y, x) - arg_min(y, x) AS change FROM d GROUP BY 1, 2 HAVING count(*) >= 2""")
def depth_sequences(t: Tables) -> DataFrame:
    """Values down a profile: top, bottom and change of sequences of at least two depths."""
    rows = t.normalized_table_measurement_candidates.filter("artifact_id is not null and depth_top_cm is not null and value_num is not null and not isnan(value_num)")
    d = rows.groupBy("artifact_id", "property_id", F.col("depth_top_cm").alias("x")).agg(F.avg("value_num").alias("y"))
    out = d.groupBy("artifact_id", "property_id").agg(F.count(F.lit(1)).alias("depths"), F.min_by("y", "x").alias("top"), F.max_by("y", "x").alias("bottom")).filter("depths >= 2")
    return out.select("artifact_id", "property_id", "depths", "top", "bottom", (F.col("bottom") - F.col("top")).alias("change"))
