"""Coordinates, regions and properties named in running text."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from humusgrid.functions import rules

# Parts of printed coordinates.
DEGREES = {
    "decimal": r"(?P<{p}d>\d{{{n}}}[.,]\d{{2,7}})\s*°?",
    "minutes": r"(?P<{p}d>\d{{{n}}})\s*[°º]\s*(?P<{p}m>\d{{1,2}}(?:[.,]\d+)?)\s*[′'’]",
    "seconds": r"(?P<{p}d>\d{{{n}}})\s*[°º]\s*(?P<{p}m>\d{{1,2}})\s*[′'’]\s*(?P<{p}s>\d{{1,2}}(?:[.,]\d+)?)\s*[″\"”]",
}
HEMISPHERES = {
    "letter": (r"(?P<ah>[NSСЮ])", r"(?P<oh>[EWВЗ])"),
    "russian": (r"(?P<ah>[СЮ]\s*\.?\s*Ш\s*\.?)", r"(?P<oh>[ВЗ]\s*\.?\s*Д\s*\.?)"),
}
BETWEEN = r"\s*[,;()\-–— ]+\s*"
LINE_BREAK = r"\s*[,;]?\s*\n\s*"
UTM = r"UTM\s*(?:zone)?\s*(?P<zone>\d{1,2})\s*(?P<ah>[NSСЮ])?\D{1,20}?(?P<e>\d{6})(?:[.,]\d+)?\s*(?:m\s*)?E?[,;\s]+(?P<n>\d{6,8})"

#: Notation -> (form of the degrees, hemispheres, order, what stands between); order is lat, lon or leading (hemisphere first).
NOTATIONS: dict[str, tuple[str, str, str, str]] = {
    "decimal": ("decimal", "letter", "lat", BETWEEN),
    "decimal_reversed": ("decimal", "letter", "lon", BETWEEN),
    "decimal_leading": ("decimal", "letter", "leading", BETWEEN),
    "decimal_russian": ("decimal", "russian", "lat", BETWEEN),
    "minutes": ("minutes", "letter", "lat", BETWEEN),
    "minutes_reversed": ("minutes", "letter", "lon", BETWEEN),
    "minutes_russian": ("minutes", "russian", "lat", BETWEEN),
    "minutes_line_break": ("minutes", "letter", "lat", LINE_BREAK),
    "seconds": ("seconds", "letter", "lat", BETWEEN),
    "seconds_reversed": ("seconds", "letter", "lon", BETWEEN),
    "seconds_leading": ("seconds", "letter", "leading", BETWEEN),
    "seconds_russian": ("seconds", "russian", "lat", BETWEEN),
}


def pattern_of(notation: str) -> str:
    form, hemispheres, order, between = NOTATIONS[notation]
    lat, lon = DEGREES[form].format(p="a", n="1,2"), DEGREES[form].format(p="o", n="1,3")
    north, east = HEMISPHERES[hemispheres]
    if order == "leading":
        return rf"{north}\s*{lat}{between}{east}\s*{lon}"
    parts = [rf"{lat}\s*{north}", rf"{lon}\s*{east}"]
    return rf"(?<![\d.,]){between.join(parts if order == 'lat' else parts[::-1])}"


def _degrees(m: re.Match[str], p: str, most: float, negative: str) -> float | None:
    part = lambda k: float((m.groupdict().get(p + k) or "0").replace(",", "."))
    d, minutes, seconds = part("d"), part("m"), part("s")
    value = d + minutes / 60 + seconds / 3600
    if minutes >= 60 or seconds >= 60 or value > most:
        return None
    return -value if m[p + "h"].strip()[0].upper() in negative else value


def coordinates(df: DataFrame, id_col: str, text_col: str, notations: Sequence[str] = (*NOTATIONS, "utm")) -> DataFrame:
    """(id_col, position, notation, latitude, longitude) of every coordinate pair printed in a text.

    Whole texts are read. Of notations that read the same place of a text, the
    one that comes first in `notations` counts. Pairs out of range are left out;
    null and empty texts have none.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(name, re.compile(UTM if name == "utm" else pattern_of(name), re.I)) for name in notations]
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if not text or not any(ch.isdigit() for ch in text):
                    continue
                taken: set[int] = set()
                for name, pattern in compiled:
                    for m in pattern.finditer(text):
                        if taken.isdisjoint(range(m.start(), m.end())):
                            lat, lon = _utm(m) if name == "utm" else (_degrees(m, "a", 90, "SЮ"), _degrees(m, "o", 180, "WЗ"))
                            if lat is not None and lon is not None:
                                taken.update(range(m.start(), m.end()))
                                rows.append((i, m.start(), name, lat, lon))
            at, position, name, lat, lon = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(position, pa.int32()), pa.array(name, pa.string()), pa.array(lat, pa.float64()), pa.array(lon, pa.float64())], names=[id_col, "position", "notation", "latitude", "longitude"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, position int, notation string, latitude double, longitude double")


# The WGS-84 ellipsoid (half axis, squared eccentricity) and the scale of UTM.
HALF_AXIS, ECCENTRICITY, SCALE = 6378137.0, 0.0066943799901413165, 0.9996


def _series(zone, easting, northing, south, f):
    """Inverse transverse Mercator series, for columns and numbers alike; f names the functions."""
    es, ep = ECCENTRICITY, ECCENTRICITY / (1 - ECCENTRICITY)
    mu = (northing - south * 10_000_000.0) / SCALE / (HALF_AXIS * (1 - es / 4 - 3 * es**2 / 64 - 5 * es**3 / 256))
    e1 = (1 - math.sqrt(1 - es)) / (1 + math.sqrt(1 - es))
    foot = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * f.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * f.sin(4 * mu) + (151 * e1**3 / 96) * f.sin(6 * mu)
    sin2 = f.sin(foot) * f.sin(foot)
    n = HALF_AXIS / f.sqrt(1 - es * sin2)
    r = HALF_AXIS * (1 - es) / f.pow(1 - es * sin2, 1.5)
    t, c = f.tan(foot) * f.tan(foot), ep * f.cos(foot) * f.cos(foot)
    d = (easting - 500000.0) / (n * SCALE)
    p = lambda k: f.pow(d, float(k))
    lat = foot - n * f.tan(foot) / r * (p(2) / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep) * p(4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep - 3 * c * c) * p(6) / 720)
    lon = (d - (1 + 2 * t + c) * p(3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep + 24 * t * t) * p(5) / 120) / f.cos(foot)
    return f.degrees(lat), f.degrees(lon) + zone * 6 - 183


def utm_position(zone: Column, easting: Column, northing: Column, south: Column) -> Column:
    """struct(latitude, longitude) of a UTM position; south: 1 on the southern half, else 0."""
    lat, lon = _series(zone, easting, northing, south, F)
    return F.struct(lat.alias("latitude"), lon.alias("longitude"))


def _utm(m: re.Match[str]) -> tuple[float | None, float | None]:
    zone = int(m["zone"])
    if not 1 <= zone <= 60:
        return None, None
    lat, lon = _series(zone, float(m["e"]), float(m["n"]), float((m["ah"] or "N").upper() in "SЮ"), math)
    return (lat, lon) if abs(lat) <= 90 and abs(lon) <= 180 else (None, None)


# Words of addresses, beside which a name is no study region, and what follows the name of one.
AFFILIATION = (
    r"univer|institut|academy|akadem|faculty|department|laborator|e-?mail|@|research cent|state agrar|timiryazev|lomonosov|"
    r"dokuchaev|soil science society|publish|press\b"
)
REGION_SUFFIX = ("oblast", "krai", "republic", "region", "district", "okrug", "raion", "province")


def region_mentions(texts: DataFrame, gazetteer: DataFrame, id_col: str, text_col: str, start: int = 0, end: int | None = None, beside: int = 70, words: int = 3) -> DataFrame:
    """(id_col, name, mentions, bare, suffixed) of gazetteer names in texts.

    gazetteer: (name), of up to `words` words. Capitalised word groups are
    joined to the names, so the gazetteer may be of any size; a name within a
    longer one at the same place does not count, nor one with a word of an
    address less than `beside` characters away. mentions weighs a name with an
    administrative word four times a bare one.
    """
    kind = texts.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, address = re.compile(r"[^\W\d_](?:[\w-]*\w)?"), re.compile(AFFILIATION, re.I)
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                body = (text or "")[start:end]
                found = list(word.finditer(body))
                for k, first in enumerate(found):
                    if not first[0][0].isupper() or address.search(body, max(0, first.start() - beside), first.end() + beside):
                        continue
                    for n in range(1, words + 1):
                        if k + n > len(found) or n > 1 and not body[found[k + n - 2].end() : found[k + n - 1].start()].isspace():
                            break
                        last = found[k + n - 1]
                        following = found[k + n][0].lower() if k + n < len(found) and body[last.end() : found[k + n].start()].isspace() else ""
                        rows.append((i, " ".join(m[0] for m in found[k : k + n]), first.start(), last.end(), following in REGION_SUFFIX))
            at, name, a, b, suffix = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(name, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(suffix, pa.bool_())], names=["id", "name", "start", "end", "suffix"])

    phrases = texts.select(id_col, text_col).mapInArrow(run, f"id {kind}, name string, start int, end int, suffix boolean")
    met = phrases.join(gazetteer.select("name").distinct(), "name")
    # the window holds one text's names
    w = Window.partitionBy("id").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    own = met.withColumn("_taken", F.max("end").over(w)).filter("_taken is null or start >= _taken")
    return own.groupBy(F.col("id").alias(id_col), "name").agg(F.sum(F.when(F.col("suffix"), 4).otherwise(1)).alias("mentions"), F.count_if(~F.col("suffix")).alias("bare"), F.count_if(F.col("suffix")).alias("suffixed"))


def study_regions(mentions: DataFrame, kinds: DataFrame, id_col: str, most: int = 3) -> DataFrame:
    """(id_col, name, mentions, rank, attribution): subjects before macroregions, by mentions, then name (a top-k report).

    kinds: (name, kind). attribution: single_region, dominant_region where the
    first has twice the mentions of the second, else multi_region.
    """
    rows = mentions.join(kinds.groupBy("name").agg(F.max("kind").alias("kind")), "name")
    subjects = rows.filter("kind = 'subject'").select(F.col(id_col).alias("_id")).distinct()
    pool = rows.join(subjects, F.col(id_col) == F.col("_id"), "left").filter("_id is null or kind = 'subject'")
    # the windows hold one text's names
    w = Window.partitionBy(id_col).orderBy(F.desc("mentions"), "name")
    ranked = pool.withColumn("rank", F.row_number().over(w)).withColumn("_next", F.lead("mentions").over(w))
    first = ranked.filter("rank = 1").select(F.col(id_col).alias("_i"), F.when(F.col("_next").isNull(), "single_region").when(F.col("mentions") >= 2 * F.col("_next"), "dominant_region").otherwise("multi_region").alias("attribution"))
    return ranked.filter(F.col("rank") <= most).join(first, F.col(id_col) == F.col("_i")).select(id_col, "name", "mentions", "rank", "attribution")


def prose_properties(df: DataFrame, id_col: str, text_col: str, within: int = 90) -> DataFrame:
    """(id_col, position, property_id, value, unit, depth_top, depth_bottom, horizon): quantities stated in prose.

    A value belongs to a property named before it in the same fragment, at most
    `within` characters on, up to the end of a line or sentence; depth and
    horizon come from the surrounding text.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = [(p, re.compile(pattern, re.I)) for p, (_, _, pattern) in rules.PROSE_PROPERTIES.items()]
        value, depth, horizon, stop = (re.compile(p, re.I) for p in (rules.PROSE_VALUE, rules.PROSE_DEPTH, rules.PROSE_HORIZON, r"[\n.!?](?!\d)"))
        number = lambda s: float(s.replace(",", "."))
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for prop, pattern in named:
                    for m in pattern.finditer(text or ""):
                        tail = stop.split(text[m.end() : m.end() + within], 1)[0]
                        if v := value.search(tail):
                            around = text[max(0, m.start() - 180) : m.end() + 220]
                            d, h = depth.search(around), horizon.search(around)
                            rows.append((i, m.start(), prop, number(v[1]), v[2], number(d[1]) if d else None, number(d[2]) if d else None, h[1] if h else None))
            columns = list(zip(*rows)) or [()] * 8
            types = [pa.int32(), pa.string(), pa.float64(), pa.string(), pa.float64(), pa.float64(), pa.string()]
            names = [id_col, "position", "property_id", "value", "unit", "depth_top", "depth_bottom", "horizon"]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *[pa.array(c, k) for c, k in zip(columns[1:], types)]], names=names)

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, position int, property_id string, value double, unit string, depth_top double, depth_bottom double, horizon string")


def text_segments(df: DataFrame, id_col: str, text_col: str, label: str, most: int | None = None) -> DataFrame:
    """(id_col, position, label, segment): the text from each label to the next, at most `most` characters of it."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(label)
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                marks = list(pattern.finditer(text or ""))
                ends = [m.start() for m in marks[1:]] + [len(text or "")]
                rows += [(i, m.start(), m[0], text[m.start() : end if most is None else min(end, m.start() + most)]) for m, end in zip(marks, ends)]
            at, position, name, segment = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(position, pa.int32()), pa.array(name, pa.string()), pa.array(segment, pa.string())], names=[id_col, "position", "label", "segment"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, position int, label string, segment string")


# Latin letters for Cyrillic ones; letters of two signs, letters of one, letters without any.
DIGRAPHS = (("щ", "shch"), ("ж", "zh"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("ю", "yu"), ("я", "ya"))
SINGLE = ("абвгдеёзийклмнопрстуфыэ", "abvgdeeziyklmnoprstufye")
SILENT = "ъь"
# Words that say nothing of a place.
PLACE_STOP_WORDS = ("oblast", "krai", "republic", "region", "district", "raion", "russia", "russian", "federation", "область", "край", "район", "республика", "россия")


def transliterated(text: Column) -> Column:
    """Small Latin letters for Cyrillic ones."""
    s = F.lower(text)
    for letter, signs in DIGRAPHS:
        s = F.replace(s, F.lit(letter), F.lit(signs))
    return F.translate(s, SINGLE[0] + SILENT, SINGLE[1])


def place_tokens(text: Column) -> Column:
    """Distinct words of a place name in Latin letters, without words that say nothing."""
    words = F.split(F.trim(F.regexp_replace(transliterated(text), r"[^a-z0-9]+", " ")), " ")
    stop = F.array(*[F.lit(w) for w in PLACE_STOP_WORDS], *[transliterated(F.lit(w)) for w in PLACE_STOP_WORDS])
    return F.array_except(F.filter(words, lambda w: w != ""), stop)


# Endings of Russian place names in the genitive, and in the nominative, the longest first.
GENITIVE = ((r"ского района$", "ский район"), (r"ской области$", "ская область"), (r"ского края$", "ский край"), (r"ой республики$", "ая республика"), (r"ого округа$", "ый округ"))


def nominative(text: Column) -> Column:
    """Administrative names in the nominative; others as they are."""
    out = text
    for ending, to in GENITIVE:
        out = F.when(text.rlike(f"(?iu){ending}"), F.regexp_replace(text, f"(?iu){ending}", to)).otherwise(out)
    return out


def clean_label(text: Column, most: int = 40) -> Column:
    """A label as part of an id: other than letters, digits and hyphens as one underscore, at most so long."""
    return F.substring(F.btrim(F.regexp_replace(text, r"[^\p{L}\p{N}-]+", "_"), F.lit("_")), 1, most)


def positional_lines(df: DataFrame, id_col: str, text_col: str, values: int) -> DataFrame:
    """(id_col, line, label, top, bottom, values): lines of a label, a depth range and exactly so many numbers; others are rejected."""
    lines = df.select(id_col, F.posexplode(F.split(text_col, r"\r\n|\r|\n")).alias("line", "_s"))
    form = r"^\s*(\S+)\s+(\d+)\s*[–—-]\s*(\d+)((?:\s+-?\d+(?:[.,]\d+)?)+)\s*$"
    part = lambda i: F.regexp_extract("_s", form, i)
    told = lines.filter(F.col("_s").rlike(form)).withColumn("values", F.transform(F.split(F.trim(part(4)), r"\s+"), lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double")))
    return told.filter(F.size("values") == values).select(id_col, "line", part(1).alias("label"), part(2).cast("int").alias("top"), part(3).cast("int").alias("bottom"), "values")


# Rewrites of a header into the key of the curated map, in order.
KEY_REWRITES = (
    (r"[–—−]", "-"),
    (r"\\(?:mathrm|text)\s*", ""),
    (r"\\\(|\\\)", ""),
    (r"\^\{([^}]*)\}", "$1"),
    (r"_\{([^}]*)\}", "$1"),
    (r"[{}]", ""),
    (r"\\+", ""),
    (r"(?U)[^\w%+\-./:(), ]+", " "),
    (r"\s+", " "),
)


def header_key(header: Column) -> Column:
    """Key of a header in the curated map: without typesetting, in small letters, a repeated phrase once."""
    s = F.coalesce(header, F.lit(""))
    for pattern, to in KEY_REWRITES:
        s = F.regexp_replace(s, pattern, to)
    s = F.lower(F.trim(s))
    s = F.replace(F.regexp_replace(s, r"(?<=[a-z])\s+(?=\d)", ""), F.lit("_"), F.lit(""))
    s = F.regexp_replace(F.regexp_replace(s, r"\s*([+-])\s*", "$1"), r"\s*:\s*", ":")
    # a phrase that is said again and again is said once
    s = F.regexp_replace(s, r"^(.+?)(?: \1)+$", "$1")
    bare = F.replace(s, F.lit(" "), F.lit(""))
    return F.when(bare.isin("mg2+", "ca2+", "na+", "k+", "h+", "cl-", "so42-", "hco3-"), bare).otherwise(s)


def curated_property(header: Column) -> Column:
    """Property of a header in the curated map, else null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in rules.CURATED_HEADERS.items() for x in pair]), header_key(header))


def named_terms(df: DataFrame, id_col: str, text_col: str, patterns: dict[str, str], case: bool = False, before: int = 180, after: int = 220) -> DataFrame:
    """(id_col, position, kind, term, context) of every match of a dictionary of patterns, with the text around it."""
    id_kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(k, re.compile(p, 0 if case else re.I)) for k, p in patterns.items()]
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for k, pattern in compiled:
                    rows += [(i, m.start(), k, m[0], text[max(0, m.start() - before) : m.end() + after].replace("\n", " ")) for m in pattern.finditer(text or "")]
            at, position, k, term, context = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(position, pa.int32()), pa.array(k, pa.string()), pa.array(term, pa.string()), pa.array(context, pa.string())], names=[id_col, "position", "kind", "term", "context"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_kind}, position int, kind string, term string, context string")


def is_study_context(text: Column) -> Column:
    """A phrase says that the place was studied, and none of references or addresses stands there unless a sure one outweighs it."""
    has = lambda p: F.coalesce(text.rlike(f"(?iuU){p}"), F.lit(False))
    return has(rules.STUDY_CONTEXT) & ~(has(rules.REFERENCE_CONTEXT) & ~has(rules.SURE_CONTEXT))
