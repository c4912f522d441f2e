"""One unit for every quantity.

Distinct unit spellings are mapped once: each is brought to a written form,
looked up in a character n-gram inverted index over the known spellings, and
the candidates are verified by a weighted edit distance. The alias dictionary
that comes out has one row per distinct spelling and is joined to all rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.session import cut_lineage

# Unit -> (kind of quantity, factor and offset to the kind's base
# unit, spellings). A spelling is written as number_form() would leave it.
UNITS: dict[str, tuple[str, float, float, str]] = {
    "mg/kg": ("mass_fraction", 1.0, 0.0, "mg/kg мг/кг mg/1000g"),
    "g/kg": ("mass_fraction", 1e3, 0.0, "g/kg г/кг"),
    "ug/kg": ("mass_fraction", 1e-3, 0.0, "ug/kg мкг/кг mcg/kg"),
    "mg/g": ("mass_fraction", 1e3, 0.0, "mg/g мг/г"),
    "ug/g": ("mass_fraction", 1.0, 0.0, "ug/g мкг/г mcg/g"),
    "ng/g": ("mass_fraction", 1e-3, 0.0, "ng/g нг/г"),
    "g/g": ("mass_fraction", 1e6, 0.0, "g/g г/г kg/kg кг/кг"),
    "mg/100g": ("mass_fraction", 10.0, 0.0, "mg/100g мг/100г mg% мг% мг/100гпочвы"),
    "g/100g": ("mass_fraction", 1e4, 0.0, "g/100g г/100г"),
    "%": ("mass_fraction", 1e4, 0.0, "% percent pct wt% wt.% mass% w% мас% масс% мас.% масс.% %масс %мас %wt процент проценты"),
    "permille": ("mass_fraction", 1e3, 0.0, "‰ permille промилле"),
    "ppm": ("mass_fraction", 1.0, 0.0, "ppm /млн /mln ппм"),
    "ppb": ("mass_fraction", 1e-3, 0.0, "ppb /млрд ппб"),
    "cmolc/kg": ("charge", 1.0, 0.0, "cmolc/kg cmol/kg cmol(c)/kg cmol(+)/kg смоль(экв)/кг смоль/кг смоль(+)/кг смольэкв/кг"),
    "mmolc/kg": ("charge", 0.1, 0.0, "mmolc/kg mmol/kg mmol(c)/kg mmol(+)/kg ммоль(экв)/кг ммоль/кг ммоль(+)/кг"),
    "meq/100g": ("charge", 1.0, 0.0, "meq/100g me/100g mg-eq/100g mgeq/100g мг-экв/100г мг-экв./100г мг-экв/100гпочвы мг-экв./100гпочвы мгэкв/100г мэкв/100г"),
    "meq/kg": ("charge", 0.1, 0.0, "meq/kg me/kg мг-экв/кг мэкв/кг"),
    "molc/kg": ("charge", 100.0, 0.0, "molc/kg mol(c)/kg mol(+)/kg моль(экв)/кг"),
    "dS/m": ("conductivity", 1.0, 0.0, "ds/m дсм/м"),
    "S/m": ("conductivity", 10.0, 0.0, "s/m см/м"),
    "mS/cm": ("conductivity", 1.0, 0.0, "ms/cm мсм/см mmho/cm"),
    "mS/m": ("conductivity", 0.01, 0.0, "ms/m мсм/м"),
    "uS/cm": ("conductivity", 1e-3, 0.0, "us/cm мксм/см umho/cm"),
    "g/cm3": ("density", 1.0, 0.0, "g/cm3 г/см3 g/cc g/ml г/мл"),
    "kg/m3": ("density", 1e-3, 0.0, "kg/m3 кг/м3 g/l г/л"),
    "t/m3": ("density", 1.0, 0.0, "t/m3 т/м3"),
    "kg/dm3": ("density", 1.0, 0.0, "kg/dm3 кг/дм3 kg/l кг/л"),
    "MPa": ("pressure", 1.0, 0.0, "mpa мпа n/mm2 н/мм2"),
    "kPa": ("pressure", 1e-3, 0.0, "kpa кпа"),
    "hPa": ("pressure", 1e-4, 0.0, "hpa гпа mbar мбар"),
    "Pa": ("pressure", 1e-6, 0.0, "pa па"),
    "bar": ("pressure", 0.1, 0.0, "bar бар"),
    "atm": ("pressure", 0.101325, 0.0, "atm атм"),
    "kgf/cm2": ("pressure", 0.0980665, 0.0, "kgf/cm2 кгс/см2 kg/cm2 кг/см2"),
    "cm/day": ("velocity", 1.0, 0.0, "cm/day cm/d см/сут см/день"),
    "mm/day": ("velocity", 0.1, 0.0, "mm/day mm/d мм/сут мм/день"),
    "m/day": ("velocity", 100.0, 0.0, "m/day m/d м/сут м/день"),
    "mm/h": ("velocity", 2.4, 0.0, "mm/h mm/hr mm/hour мм/ч мм/час"),
    "cm/h": ("velocity", 24.0, 0.0, "cm/h cm/hr cm/hour см/ч см/час"),
    "m/h": ("velocity", 2400.0, 0.0, "m/h m/hr м/ч м/час"),
    "cm/min": ("velocity", 1440.0, 0.0, "cm/min см/мин"),
    "mm/min": ("velocity", 144.0, 0.0, "mm/min мм/мин"),
    "cm/s": ("velocity", 86400.0, 0.0, "cm/s cm/sec см/с см/сек"),
    "mm/s": ("velocity", 8640.0, 0.0, "mm/s mm/sec мм/с мм/сек"),
    "um/s": ("velocity", 8.64, 0.0, "um/s мкм/с"),
    "m/s": ("velocity", 8640000.0, 0.0, "m/s m/sec м/с м/сек"),
    "mV": ("potential", 1.0, 0.0, "mv мв millivolt милливольт"),
    "V": ("potential", 1e3, 0.0, "v в volt вольт"),
    "C": ("temperature", 1.0, 0.0, "c с °c °с degc °цельсия градусыцельсия градусцельсия градусовцельсия celsius degreescelsius degreecelsius"),
    "F": ("temperature", 5.0 / 9.0, -160.0 / 9.0, "f °f degf fahrenheit degreesfahrenheit градусыфаренгейта"),
    "K": ("temperature", 1.0, -273.15, "k к °k kelvin кельвин"),
    "pH": ("acidity", 1.0, 0.0, "ph рн ед.ph едph ед.рн units phunits единицph ед"),
}

GRAM = 2
BRACKETS = {"(": ")", "[": "]", "{": "}"}
# Cost of one edit by the kind of character.
COST_SEPARATOR, COST_ALIKE, COST_LETTER, COST_HEAD = 0.15, 0.1, 1.0, 3.0
# Fixed value: letters of the two alphabets that scans and keyboards exchange.
ALIKE = {frozenset(p) for p in ("aа", "eе", "oо", "pр", "cс", "xх", "kк", "mм", "tт", "bв", "hн", "rг", "nп", "uи", "1l", "0o")}


def written_form(text: str) -> str:
    """Spelling without variation that carries no meaning.

    Compatibility composition, lower case, one minus sign, exponents and the
    words per / на as a slash, no blanks or multiplication signs, no brackets
    around the whole.
    """
    s = unicodedata.normalize("NFKC", text).lower().strip()
    s = s.replace("μ", "u").replace("µ", "u")
    s = re.sub("[‐-―−]", "-", s)
    s = re.sub("[​-‏⁠﻿­]", "", s)
    while len(s) > 1 and _encloses(s):
        s = s[1:-1].strip()
    s = s.strip(" ,;:")
    s = re.sub(r"\s*(?:\bper\b|\bна\b)\s*", "/", s)
    s = re.sub(r"[·⋅∙*×^]", " ", s)
    s = re.sub(r"\s*\b(100\s*)?([a-zа-я]+)\s*-\s*([123])(?!\d)", lambda m: "/" + (m[1] or "").strip() + m[2] + (m[3] if m[3] != "1" else ""), s)
    s = re.sub(r"\s+", "", s)
    return re.sub("/+", "/", s).rstrip(".") if s != "/" else ""


def _encloses(s: str) -> bool:
    """The first character opens a bracket that the last one closes."""
    if BRACKETS.get(s[0]) != s[-1]:
        return False
    depth = 0
    for i, ch in enumerate(s):
        depth += (ch == s[0]) - (ch == s[-1])
        if depth == 0:
            return i == len(s) - 1
    return False


@lru_cache(maxsize=1)
def _known() -> tuple[dict[str, list[str]], dict[str, set[str]]]:
    """Spelling -> units, and the inverted index n-gram -> spellings."""
    spellings: dict[str, list[str]] = defaultdict(list)
    index: dict[str, set[str]] = defaultdict(set)
    for unit, (_, _, _, forms) in UNITS.items():
        for form in forms.split():
            spellings[form].append(unit)
            for gram in _grams(form):
                index[gram].add(form)
    return spellings, index


def _grams(form: str) -> set[str]:
    padded = f"^{form}$"
    return {padded[i : i + GRAM] for i in range(len(padded) - GRAM + 1)}


def _cost(a: str, b: str, head: bool) -> float:
    """Cost of writing a as b; an empty side is an insertion or a deletion."""
    if a == b:
        return 0.0
    pair = (a or b) + (b or a)
    if a and b and frozenset(pair) in ALIKE:
        return COST_ALIKE
    if not any(ch.isalnum() or ch in "/%" for ch in pair):
        return COST_SEPARATOR
    return COST_HEAD if head or any(ch.isdigit() for ch in pair) else COST_LETTER


def edit_cost(a: str, b: str) -> float:
    """Weighted edit distance; the first letter of a factor (its SI prefix) counts most."""
    heads = [i == 0 or a[i - 1] == "/" for i in range(len(a))] + [True]
    row = [0.0]
    for j in range(len(b)):
        row.append(row[-1] + _cost("", b[j], j == 0 or b[j - 1] == "/"))
    for i in range(len(a)):
        new = [row[0] + _cost(a[i], "", heads[i])]
        for j in range(len(b)):
            head = j == 0 or b[j - 1] == "/"
            new.append(min(row[j] + _cost(a[i], b[j], head or heads[i]), row[j + 1] + _cost(a[i], "", heads[i]), new[j] + _cost("", b[j], head)))
        row = new
    return row[-1]


def match_spelling(text: str | None, fuzzy: bool = True) -> list[str]:
    """Units that a spelling can stand for; none when nothing or no single best fits."""
    if text is None or not text.strip():
        return []
    form = written_form(text)
    spellings, index = _known()
    if form in spellings:
        return spellings[form]
    if not fuzzy or not form:
        return []
    grams = _grams(form)
    shared: dict[str, int] = defaultdict(int)
    for gram in grams:
        for known in index.get(gram, ()):
            shared[known] += 1
    best: dict[float, set[str]] = defaultdict(set)
    weight = sum(ch.isalnum() for ch in form)
    for known, n in shared.items():
        # letters that the known spelling has no room for cost one each at least
        if weight - len(known) > max(0.5, 0.15 * max(len(form), len(known))):
            continue
        if 2 * n >= 0.6 * (len(grams) + len(known) + 1) or n >= len(known) - 1:
            cost = edit_cost(form, known)
            if cost <= max(0.5, 0.15 * max(len(form), len(known))):
                best[cost].update(spellings[known])
    if not best:
        return []
    found = best[min(best)]
    return sorted(found) if len({UNITS[u][0] for u in found}) == len(found) else []


def stated_units(text: str | None, whole: bool) -> dict[str, str]:
    """Kind of quantity -> unit that a text states.

    whole: the text is nothing but the unit (a unit column, what follows a
    number). Otherwise (a column header) brackets, then what follows the last
    comma or colon, then the last words are read, longest first; bare last
    words must be a known spelling.
    """
    out: dict[str, str] = {}
    if text is None:
        return out

    def read(part: str, fuzzy: bool = True) -> None:
        for unit in match_spelling(part, fuzzy):
            out.setdefault(UNITS[unit][0], unit)

    if whole:
        read(text)
        return out
    parts = [m[1] or m[2] for m in re.finditer(r"\(((?:[^()]|\([^()]*\))*)\)|\[([^\[\]]*)\]", text)]
    parts += [text[m.end() :] for m in re.finditer(r"[,:;]\s+", text)]
    for part in reversed(parts):
        read(part)
    words = text.split()
    # longer endings than the longest known spelling can be written are none
    most = 3 * max(map(len, _known()[0]))
    n, letters = 0, 0
    while n < len(words) - 1 and letters <= most:
        n += 1
        letters += sum(ch.isalnum() for ch in words[-n]) if words[-n].lower() not in ("per", "на") else 0
    for k in range(n, 0, -1):
        read(" ".join(words[-k:]), fuzzy=False)
    return out


def find_unit(text: str | None, kind: str | None, whole: bool) -> str | None:
    """Unit of the wanted kind stated by a text, as stated_units() reads it."""
    return stated_units(text, whole).get(kind)


def alias_dictionary(spellings: DataFrame) -> DataFrame:
    """(spelling, whole) -> (spelling, whole, units), units: kind -> (unit, factor, offset).

    One row per distinct spelling that states any unit; null spellings have none.
    """
    schema = "spelling string, whole boolean, units map<string, struct<unit: string, factor: double, offset: double>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for spelling, whole in zip(batch["spelling"], batch["whole"]):
                if found := stated_units(spelling, whole):
                    rows.append((spelling, whole, {kind: {"unit": u, "factor": UNITS[u][1], "offset": UNITS[u][2]} for kind, u in found.items()}))
            yield pd.DataFrame(rows, columns=["spelling", "whole", "units"])

    return spellings.select("spelling", "whole").filter("spelling is not null").distinct().mapInPandas(run, schema)


# Fixed value: a number with decimal point or comma, perhaps with an exponent, and what follows it.
NUMBER = r"^[\s ]*[<>≤≥~≈]?[\s ]*([-−–+]?\d+(?:[.,]\d+)?(?:[eEеЕ][-−–+]?\d+)?)(.*)$"


def number_of(text: Column) -> Column:
    raw = F.regexp_extract(text, NUMBER, 1)
    plain = F.translate(raw, ",−–еЕ", ".--ee")
    return F.when(F.length(raw) > 0, plain.try_cast("double"))


def unit_text_of(text: Column) -> Column:
    rest = F.btrim(F.regexp_extract(text, NUMBER, 2), F.lit(" \t\n\r   "))
    return F.when(F.length(rest) > 0, rest)


def property_kinds(definitions: DataFrame) -> DataFrame:
    """property_id -> kind of quantity and conversion of its canonical unit.

    One row per property; a property whose canonical unit is unknown is left out.
    """
    known = [(u, *UNITS[u][:3]) for u in UNITS]
    spark = definitions.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = [next(iter(match_spelling(s)), None) for s in batch["canonical_unit"]]
            yield batch[["property_id"]].assign(canonical=units).dropna()

    mapped = definitions.select("property_id", "canonical_unit").filter("property_id is not null").mapInPandas(run, "property_id string, canonical string")
    units = spark.createDataFrame(known, "canonical string, kind string, to_base double, base_offset double")
    return mapped.join(units, "canonical").groupBy("property_id").agg(*[F.min(c).alias(c) for c in ("canonical", "kind", "to_base", "base_offset")])


def _raw_rows(candidates: DataFrame) -> DataFrame:
    """Number and the three texts of a record in which its unit may stand."""
    return candidates.select(
        "candidate_id",
        "property_id",
        F.coalesce(F.when(~F.isnan("value_num"), F.col("value_num")), number_of(F.col("value_text"))).alias("value_raw"),
        F.col("unit_raw").alias("in_column"),
        unit_text_of(F.col("value_text")).alias("in_value"),
        F.col("property_header_raw").alias("in_header"),
    )


def _spellings(rows: DataFrame) -> DataFrame:
    """(spelling, whole) of every text of the rows that may state a unit, in one reading."""
    told = F.array(*[F.struct(F.col(c).alias("spelling"), F.lit(whole).alias("whole")) for c, whole in (("in_column", True), ("in_value", True), ("in_header", False))])
    return rows.select(F.explode(told).alias("s")).select("s.spelling", "s.whole").filter("spelling is not null").distinct()


def _look_up(rows: DataFrame, aliases: DataFrame, columns: dict[str, bool]) -> DataFrame:
    """Join the one alias dictionary to all rows, once for each text column: adds struct `unit_<column>` of the row's kind."""
    for column, whole in columns.items():
        named = aliases.filter(F.col("whole") == whole).select(F.col("spelling").alias(f"_{column}"), F.col("units").alias(f"_units_{column}"))
        rows = rows.join(named, rows[column] == named[f"_{column}"], "left")
        rows = rows.withColumn(f"unit_{column}", F.try_element_at(F.col(f"_units_{column}"), F.col("kind"))).drop(f"_{column}", f"_units_{column}")
    return rows


def _converted(candidates: DataFrame, aliases: DataFrame, kinds: DataFrame) -> DataFrame:
    rows = _look_up(_raw_rows(candidates).join(kinds, "property_id", "left"), aliases, {"in_column": True, "in_value": True, "in_header": False})
    unit = F.coalesce("unit_in_column", "unit_in_value", "unit_in_header")
    rows = rows.withColumn("stated", unit)
    base = F.col("value_raw") * F.col("stated.factor") + F.col("stated.offset")
    return rows.withColumn("value_canonical", (base - F.col("base_offset")) / F.col("to_base"))


def convert_measurements(candidates: DataFrame, definitions: DataFrame) -> DataFrame:
    """Every raw quantity in its property's canonical unit.

    Returns (candidate_id, property_id, unit, canonical_unit, value_raw,
    value_canonical), one row per candidate row. The unit is read from
    unit_raw, else from what follows the number in value_text, else from the
    header.

    Defined results: value_num counts unless it is null or NaN, then the number
    in value_text; no number, no unit, or a unit of another kind than the
    property's gives a null value_canonical; unknown or null property ids give
    nulls; repeated rows come out once each; an empty table gives no rows; only
    the named columns are read.
    """
    aliases = cut_lineage(alias_dictionary(_spellings(_raw_rows(candidates))), "aliases")
    rows = _converted(candidates, aliases, property_kinds(definitions))
    return rows.select("candidate_id", "property_id", F.col("stated.unit").alias("unit"), F.col("canonical").alias("canonical_unit"), "value_raw", "value_canonical")


def newest_normalization(normalization: DataFrame) -> DataFrame:
    """Newest row per candidate_id; rows without a time come last, ties go to the larger version, then value."""
    # max of a struct combines on the map side, so replaced rows of a hot id never meet in one task
    at = F.struct(F.coalesce(F.col("normalized_at"), F.timestamp_seconds(F.lit(-62135596800))), F.coalesce(F.col("normalizer_version"), F.lit("")), F.col("value_normalized").isNotNull(), "value_normalized", "unit_normalized")
    return (
        normalization.filter("candidate_id is not null")
        .groupBy("candidate_id")
        .agg(F.max(at).alias("m"))
        .select("candidate_id", F.col("m.value_normalized").alias("value_normalized"), F.col("m.unit_normalized").alias("unit_normalized"))
    )


def wrong_normalizations(candidates: DataFrame, normalization: DataFrame, definitions: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Candidates whose newest stored result states another quantity than the raw record.

    Returns (candidate_id, value_canonical, stored_canonical). A stored row
    without a value (null or NaN) is a case; a stored value whose unit is
    missing, unknown or of another kind states no equal quantity and is one too.
    Raw records without number or unit, and candidates without a stored row, are
    none. Repeated candidate rows count as one record, the one converting to the
    smallest value.
    """
    stored = newest_normalization(normalization)
    spelled = normalization.select(F.col("unit_normalized").alias("spelling"), F.lit(True).alias("whole")).filter("spelling is not null").distinct()
    aliases = cut_lineage(alias_dictionary(_spellings(_raw_rows(candidates)).unionByName(spelled)), "aliases")
    raw = (
        _converted(candidates, aliases, property_kinds(definitions))
        .filter("value_canonical is not null and candidate_id is not null")
        .groupBy("candidate_id")
        .agg(F.min(F.struct("value_canonical", "property_id", "kind", "to_base", "base_offset")).alias("m"))
        .select("candidate_id", "m.value_canonical", "m.kind", "m.to_base", "m.base_offset")
    )
    rows = _look_up(raw.join(stored, "candidate_id"), aliases, {"unit_normalized": True})
    back = F.col("value_normalized") * F.col("unit_unit_normalized.factor") + F.col("unit_unit_normalized.offset")
    rows = rows.withColumn("stored_canonical", (back - F.col("base_offset")) / F.col("to_base"))
    same = F.abs(F.col("stored_canonical") - F.col("value_canonical")) <= tolerance * F.abs(F.col("value_canonical"))
    given = F.col("value_normalized").isNotNull() & ~F.isnan("value_normalized")
    return rows.filter(~(given & F.coalesce(same, F.lit(False)))).select("candidate_id", "value_canonical", "stored_canonical")
