"""Extraction from text: coordinates, regions, properties, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.operators import places
from humusgrid.operators.quality import datum_of
from humusgrid.plans.registry import Registry, Tables

R = Registry()
_USABLE = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT isnan(latitude) AND NOT isnan(longitude)"
_ABS = "SELECT DISTINCT site_id, abs(latitude) AS a, abs(longitude) AS o, CASE WHEN latitude < 0 THEN -1 ELSE 1 END AS sa, CASE WHEN longitude < 0 THEN -1 ELSE 1 END AS so FROM reported_site WHERE " + _USABLE
_H = "(floor({} * {} + 0.5) / {})"  # rounded half up before it is printed, the same on every engine
_DEC = tuple(_H.format(x, 10000, 10000) for x in "ao")
_MINUTES = tuple(_H.format(f"(({x} - floor({x})) * 60)", 100, 100) for x in "ao")
_MIN = tuple(f"floor({x}) + {m} / 60" for x, m in zip("ao", _MINUTES))
_MIN_OK = " AND ".join(f"{m} < 60" for m in _MINUTES)
_SECONDS = tuple(_H.format(f"(({x} * 60 - floor({x} * 60)) * 60)", 10, 10) for x in "ao")
_SEC = tuple(f"floor({x}) + floor(({x} - floor({x})) * 60) / 60 + {s} / 3600" for x, s in zip("ao", _SECONDS))
_SEC_OK = " AND ".join(f"{s} < 60" for s in _SECONDS)


def _printed(form: str, x: Column) -> Column:
    whole = F.floor(x)
    half_up = lambda v, n: F.floor(v * n + 0.5) / n
    if form == "decimal":
        return F.format_string("%.4f°", half_up(x, 10000))
    if form == "minutes":
        return F.format_string("%d°%.2f′", whole, half_up((x - whole) * 60, 100))
    return F.format_string("%d°%d′%.1f″", whole, F.floor((x - whole) * 60), half_up((x * 60 - F.floor(x * 60)) * 60, 10))


def _pair(notation: str, lat: Column, lon: Column) -> Column:
    """A coordinate as the notation prints it."""
    form, hemispheres, order, between = places.NOTATIONS[notation]
    a, o = _printed(form, F.abs(lat)), _printed(form, F.abs(lon))
    letters = (("S", "N"), ("W", "E")) if hemispheres == "letter" else ((" ю. ш.", " с. ш."), (" з. д.", " в. д."))
    ah, oh = F.when(lat < 0, letters[0][0]).otherwise(letters[0][1]), F.when(lon < 0, letters[1][0]).otherwise(letters[1][1])
    if order == "leading":
        return F.concat(ah, F.lit(" "), a, F.lit(", "), oh, F.lit(" "), o)
    parts = [F.concat(a, ah), F.concat(o, oh)]
    return F.concat_ws(",\n" if between == places.LINE_BREAK else ", ", *(parts if order == "lat" else parts[::-1]))


def _notation_sql() -> str:
    parts = []
    for name, (form, _, _, _) in places.NOTATIONS.items():
        (lat, lon), ok = {"decimal": (_DEC, "o >= 0"), "minutes": (_MIN, _MIN_OK), "seconds": (_SEC, _SEC_OK)}[form]
        # a pair with a line break between is read by the plain notation, whose separator may be blank
        parts.append(f"SELECT site_id, '{name}' AS printed, CASE WHEN '{name}' = 'minutes_line_break' THEN 'minutes' ELSE '{name}' END AS notation, sa * ({lat}) AS latitude, so * ({lon}) AS longitude FROM s WHERE {ok}")
    return f"WITH s AS ({_ABS}) " + " UNION ALL ".join(parts)


@R.query(_notation_sql())
def coordinate_notations(t: Tables) -> DataFrame:
    """Coordinates of sites printed in every notation amid text, and read back."""
    sites = t.reported_site.filter(_USABLE.replace("NOT isnan", "not isnan")).select("site_id", "latitude", "longitude").distinct()
    told = F.array(*[F.struct(F.lit(n).alias("printed"), F.concat(F.lit("Pit 3 lies at "), _pair(n, F.col("latitude"), F.col("longitude")), F.lit(" (depth 0-20 cm).")).alias("text")) for n in places.NOTATIONS])
    texts = sites.select("site_id", F.explode(told).alias("x")).select(F.concat_ws("\n", "site_id", "x.printed").alias("id"), "x.text")
    found = places.coordinates(texts, "id", "text")
    return found.select(F.substring_index("id", "\n", 1).alias("site_id"), F.substring_index("id", "\n", -1).alias("printed"), "notation", "latitude", "longitude")


_SERIES = """WITH s AS (SELECT DISTINCT site_id, 1 + abs(hash_no) % 60 AS zone, 200000.0 + (floor(abs(longitude) * 1000) % 6000) * 100 AS e, 1000000.0 + floor(abs(latitude) * 90000) AS n FROM (SELECT *, CAST(floor(abs(longitude) * 10) AS BIGINT) AS hash_no FROM reported_site WHERE """ + _USABLE + """)),
m AS (SELECT *, n / 0.9996 / (6378137.0 * (1 - 0.0066943799901413165 / 4 - 3 * pow(0.0066943799901413165, 2) / 64 - 5 * pow(0.0066943799901413165, 3) / 256)) AS mu, (1 - sqrt(1 - 0.0066943799901413165)) / (1 + sqrt(1 - 0.0066943799901413165)) AS e1, 0.0066943799901413165 / (1 - 0.0066943799901413165) AS ep FROM s),
f AS (SELECT *, mu + (3 * e1 / 2 - 27 * pow(e1, 3) / 32) * sin(2 * mu) + (21 * pow(e1, 2) / 16 - 55 * pow(e1, 4) / 32) * sin(4 * mu) + (151 * pow(e1, 3) / 96) * sin(6 * mu) AS p FROM m),
g AS (SELECT *, 6378137.0 / sqrt(1 - 0.0066943799901413165 * pow(sin(p), 2)) AS nn, 6378137.0 * (1 - 0.0066943799901413165) / pow(1 - 0.0066943799901413165 * pow(sin(p), 2), 1.5) AS r, pow(tan(p), 2) AS t, ep * pow(cos(p), 2) AS c FROM f), h AS (SELECT *, (e - 500000.0) / (nn * 0.9996) AS d FROM g)
SELECT site_id, degrees(p - nn * tan(p) / r * (pow(d, 2) / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep) * pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep - 3 * c * c) * pow(d, 6) / 720)) AS latitude,
degrees((d - (1 + 2 * t + c) * pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep + 24 * t * t) * pow(d, 5) / 120) / cos(p)) + zone * 6 - 183 AS longitude FROM h"""


@R.query(_SERIES)
def utm_positions(t: Tables) -> DataFrame:
    """Eastings and northings made of the sites' numbers, as degrees."""
    rows = t.reported_site.filter(_USABLE.replace("NOT isnan", "not isnan"))
    zone = 1 + F.floor(F.abs("longitude") * 10) % 60
    made = rows.select("site_id", zone.alias("zone"), (200000.0 + (F.floor(F.abs("longitude") * 1000) % 6000) * 100).alias("e"), (1000000.0 + F.floor(F.abs("latitude") * 90000)).alias("n")).distinct()
    at = places.utm_position(F.col("zone"), F.col("e"), F.col("n"), F.lit(0))
    return made.select("site_id", at.alias("p")).select("site_id", "p.latitude", "p.longitude")


_DATA = """SELECT document_id, regexp_replace(region_name, ' (oblast|krai)$', '') AS name, region_kind AS kind, CASE WHEN regexp_matches(region_name, ' (oblast|krai)$') THEN 4 ELSE 1 END AS weight, mentions FROM document_study_region WHERE document_id IS NOT NULL AND mentions > 0"""


@R.query(f"""WITH d AS ({_DATA}), k AS (SELECT name, max(kind) AS kind FROM d GROUP BY 1), m AS (SELECT document_id, name, sum(mentions * weight) AS n FROM d GROUP BY 1, 2), j AS (SELECT m.*, kind, max(CASE WHEN kind = 'subject' THEN 1 ELSE 0 END) OVER (PARTITION BY document_id) AS any_subject FROM m JOIN k USING (name)),
w AS (SELECT document_id, name, n, row_number() OVER o AS rank, lead(n) OVER o AS nxt FROM j WHERE any_subject = 0 OR kind = 'subject' WINDOW o AS (PARTITION BY document_id ORDER BY n DESC, name))
SELECT document_id, name, CAST(n AS BIGINT) AS mentions, CAST(rank AS INTEGER) AS rank, CASE WHEN max(CASE WHEN rank = 1 THEN coalesce(nxt, -1) END) OVER (PARTITION BY document_id) = -1 THEN 'single_region' WHEN max(CASE WHEN rank = 1 THEN n END) OVER (PARTITION BY document_id) >= 2 * max(CASE WHEN rank = 1 THEN nxt END) OVER (PARTITION BY document_id) THEN 'dominant_region' ELSE 'multi_region' END AS attribution
FROM w QUALIFY rank <= 3""")
def study_region(t: Tables) -> DataFrame:
    """Study regions of texts that mention regions as often as the table says, with and without their administrative word."""
    rows = t.document_study_region.filter("document_id is not null and mentions > 0").select("document_id", "region_name", "region_kind", "mentions")
    part = rows.select("document_id", F.repeat(F.concat(F.lit("Soils of "), "region_name", F.lit(" were described. ")), F.col("mentions")).alias("part"))
    # the text of a document is one row of its parts, as many as its regions
    texts = part.groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_list("part")), "").alias("text"))
    bare = F.regexp_replace("region_name", " (oblast|krai)$", "")
    kinds = rows.select(bare.alias("name"), F.col("region_kind").alias("kind")).distinct()
    mentions = places.region_mentions(texts, kinds, "document_id", "text")
    return places.study_regions(mentions, kinds, "document_id")


@R.query("""SELECT site_id, CASE WHEN latitude > 60 THEN 'WGS-84' WHEN latitude > 50 THEN 'SK-42' ELSE 'Pulkovo' END AS datum, CASE WHEN latitude > 60 THEN 'WGS 84' WHEN latitude > 50 THEN 'СК-42' ELSE 'Пулково' END AS match FROM (SELECT DISTINCT site_id, latitude FROM reported_site WHERE latitude BETWEEN -90 AND 90)""")
def datum_evidence(t: Tables) -> DataFrame:
    """Datum named in a text; here texts of sites that name one by their latitude."""
    sites = t.reported_site.filter("latitude between -90 and 90").select("site_id", "latitude").distinct()
    named = F.when(F.col("latitude") > 60, "WGS 84").when(F.col("latitude") > 50, "СК-42").otherwise("Пулково")
    text = F.concat(F.lit("The positions were taken by a receiver, system "), named, F.lit(", to the nearest metre."))
    return sites.select("site_id", datum_of(text).alias("d")).select("site_id", "d.datum", "d.match")


@R.query("""WITH k AS (SELECT DISTINCT property_header_raw AS header, trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(regexp_replace(regexp_replace(property_header_raw, '[–—−]', '-', 'g'), '[^\\w%+\\-./:(), а-яёА-ЯЁ°³²−·⁻¹µΩ]+', ' ', 'g'), '\\s+', ' ', 'g'))), '([a-z])\\s+([0-9])', '\\1\\2', 'g'), '\\s*([+-])\\s*', '\\1', 'g'), '\\s*:\\s*', ':', 'g')) AS key FROM normalized_table_measurement_candidates WHERE property_header_raw IS NOT NULL)
SELECT header, CASE key WHEN 'clay' THEN 'clay' WHEN 'clay, %' THEN 'clay' WHEN 'sand' THEN 'sand' WHEN 'sand, %' THEN 'sand' WHEN 'cec' THEN 'cation_exchange_capacity' WHEN 'soc' THEN 'soil_organic_carbon' WHEN 'corg' THEN 'soil_organic_carbon' WHEN 'corg, %' THEN 'soil_organic_carbon' WHEN 'гумус' THEN 'organic_matter' WHEN 'гумус, %' THEN 'organic_matter' WHEN 'humus' THEN 'organic_matter' WHEN 'humus, %' THEN 'organic_matter'
WHEN 'ca' THEN 'calcium' WHEN 'ec' THEN 'electrical_conductivity' WHEN 'ec, ds/m' THEN 'electrical_conductivity' WHEN 'zn' THEN 'zinc' WHEN 'cu' THEN 'copper' WHEN 'pb' THEN 'lead' WHEN 'ph h2o' THEN 'ph_h2o' WHEN 'ph' THEN 'ph_unspecified' WHEN 'organic carbon' THEN 'soil_organic_carbon' WHEN 'bulk density, g/cm3' THEN 'bulk_density' END AS property FROM k WHERE property IS NOT NULL""")
def curated_headers(t: Tables) -> DataFrame:
    """Headers that the curated map knows."""
    headers = t.normalized_table_measurement_candidates.filter("property_header_raw is not null").select(F.col("property_header_raw").alias("header")).distinct()
    return headers.select("header", places.curated_property(F.col("header")).alias("property")).filter("property is not null")


@R.query()
def prose_properties(t: Tables) -> DataFrame:
    """Quantities stated in the prose of all texts."""
    return places.prose_properties(t.documents, "doc_id", "text")


@R.query("""WITH s AS (SELECT doc_id, unnest(string_split(text, 'horizon ')[2:]) AS tail FROM documents WHERE contains(text, 'horizon ')) SELECT doc_id, count(*) AS segments, sum(length(tail) + 8) AS characters FROM s GROUP BY 1""")
def label_segments(t: Tables) -> DataFrame:
    """Text from each label to the next: their number and length for each document."""
    parts = places.text_segments(t.documents, "doc_id", "text", "horizon ")
    return parts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("segments"), F.sum(F.length("segment")).alias("characters"))


@R.query("""SELECT DISTINCT region, array_to_string(list_sort(list_filter(string_split(trim(regexp_replace(lower(region), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w NOT IN ('', 'oblast', 'krai', 'republic', 'region', 'district', 'raion', 'russia', 'russian', 'federation'))), ' ') AS tokens FROM reported_site WHERE region IS NOT NULL AND regexp_full_match(region, '[A-Za-z ]+')""")
def region_tokens(t: Tables) -> DataFrame:
    rows = t.reported_site.filter("region is not null").filter(F.col("region").rlike("^[A-Za-z ]+$")).select("region").distinct()
    return rows.select("region", F.array_join(F.array_sort(places.place_tokens(F.col("region"))), " ").alias("tokens"))


@R.query("SELECT DISTINCT profile_label, substr(trim(regexp_replace(profile_label, '[^\\p{L}\\p{N}-]+', '_', 'g'), '_'), 1, 40) AS label FROM profile WHERE profile_label IS NOT NULL")
def label_ids(t: Tables) -> DataFrame:
    return t.profile.filter("profile_label is not null").select("profile_label", places.clean_label(F.col("profile_label")).alias("label")).distinct()
