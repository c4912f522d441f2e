"""Rules on values: safe conversion, plausibility, years, horizons, datum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from humusgrid.functions import rules


def _any(col: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(col.isin(*names), F.lit(False))


def unit_form(unit: Column, strict: bool = False) -> Column:
    """Known spelling of a unit, else the unit as it is; null for null and empty.

    strict: also Cyrillic kilograms, which the plain rule leaves as they are.
    """
    s = F.replace(F.replace(F.lower(unit), F.lit(" "), F.lit("")), F.lit("³"), F.lit("3"))
    if strict:
        s = F.replace(s, F.lit("кг"), F.lit("kg"))
    s = F.replace(F.replace(F.replace(s, F.lit("мг"), F.lit("mg")), F.lit("г"), F.lit("g")), F.lit("см"), F.lit("cm"))
    known = F.coalesce(*[F.when(s == f, F.lit(to)) for f, to in rules.UNIT_FORMS.items()])
    return F.when(F.length(unit) > 0, F.coalesce(known, unit))


def safe_conversion(value: Column, unit: Column, canonical: Column, prop: Column, strict: bool = False) -> Column:
    """struct(value, unit, status) of a conservative conversion; what is not known to be safe is incompatible."""
    u = unit_form(unit, strict)
    to_g = (u == "%") & (canonical == "g/kg") & _any(prop, rules.PERCENT_TO_G_KG)
    to_pct = (u == "g/kg") & (canonical == "%") & _any(prop, rules.G_KG_TO_PERCENT)
    out = lambda v, n, s: F.struct(v.cast("double").alias("value"), n.cast("string").alias("unit"), F.lit(s).alias("status"))
    none = F.lit(None)
    return (
        F.when(value.isNull(), out(none, none, "missing_value"))
        .when(u.isNull(), out(none, none, "missing_unit"))
        .when(canonical.isNull() | (canonical == "") | (u == canonical), out(value, u, "exact"))
        .when((u == "g/kg") & (canonical == "mg/kg"), out(value * 1000, canonical, "converted"))
        .when((u == "mg/kg") & (canonical == "g/kg"), out(value / 1000, canonical, "converted"))
        .when(to_g, out(value * 10, canonical, "converted"))
        .when(to_pct, out(value / 10, canonical, "converted"))
        .otherwise(out(none, none, "incompatible"))
    )


def plausibility(prop: Column, category: Column, value: Column, unit: Column, status: Column) -> Column:
    """struct(verdict, rule): unchecked, out_of_physical_range, negative_content or ok, and the rule that says so."""
    out = lambda verdict, rule: F.struct(F.lit(verdict).alias("verdict"), (rule if isinstance(rule, Column) else F.lit(rule)).cast("string").alias("rule"))

    def broken(key: Column, table: dict[str, tuple[float, float, str]]) -> Column:
        """Rule of the key's range where the value is outside it."""
        return F.coalesce(*[F.when((key == name) & ((value < low) | (value > high)), F.lit(rule)) for name, (low, high, rule) in table.items()])

    proven = F.coalesce(prop.startswith("ph_") | status.isin("exact", "converted"), F.lit(False))
    unit_key = F.regexp_replace(F.replace(F.replace(F.lower(F.trim(F.coalesce(unit, F.lit("")))), F.lit("º"), F.lit("°")), F.lit("в°"), F.lit("°")), r"\s+", "")
    physical = F.when(proven, broken(prop, rules.PHYSICAL_RANGE))
    generic = F.when(prop == "unclassified_table_metric", broken(unit_key, rules.UNIT_RANGE))
    percent = _any(prop, rules.PERCENT_PROPERTIES) & F.coalesce(F.trim(unit) == "%", F.lit(False)) & ((value < 0) | (value > 100))
    negative = (value < 0) & _any(category, rules.CONTENT_CATEGORIES) & ~_any(prop, rules.SIGNED_PROPERTIES)
    outside = F.coalesce(physical, generic, F.when(percent, F.lit(rules.PERCENT_RULE)))
    return F.when(value.isNull(), out("unchecked", rules.NO_VALUE_RULE)).when(outside.isNotNull(), out("out_of_physical_range", outside)).when(negative, out("negative_content", rules.NEGATIVE_RULE)).otherwise(out("ok", None))


# Fixed value: an article identifier, of which volume, year and issue are read.
ARTICLE_ID = r"(?i)S1064229(\d)(\d{2})(\d{2})(\d{3}[\dX])"


def decoded_year(identifier: Column) -> Column:
    """struct(year, confidence, uncertainty) read from an article identifier; null where there is none."""
    s = F.replace(identifier, F.lit("_"), F.lit("/"))
    two, block = F.regexp_extract(s, ARTICLE_ID, 2).try_cast("int"), F.regexp_extract(s, ARTICLE_ID, 3).try_cast("int")
    year = F.when(two <= 68, 2000 + two).otherwise(1900 + two)
    issue = block < 60
    return F.when(two.isNotNull(), F.struct(year.alias("year"), F.when(issue, "issue_number").otherwise("submission_year").alias("confidence"), F.when(issue, 0).otherwise(1).alias("uncertainty")))


def horizon_of(row_label: Column) -> Column:
    """Horizon at the start of a row label, where a depth range follows; else null."""
    label = F.regexp_extract(row_label, rules.HORIZON_PREFIX, 0)
    rest = F.substr(row_label, F.length(label) + 1)
    return F.when((label != "") & ~label.isin(*rules.HORIZON_REJECT) & rest.rlike(rules.HORIZON_TAIL), label)


def datum_of(text: Column, context: int = 70) -> Column:
    """struct(datum, match, snippet) of the first datum named, in the order of the rules; null where none is."""
    found = []
    for datum, pattern in rules.DATUM_PATTERNS:
        match = F.regexp_extract(text, f"(?iuU)({pattern})", 1)
        at = F.regexp_instr(text, F.lit(f"(?iuU)({pattern})"))
        start = F.greatest(at - context, F.lit(1))
        snippet = F.trim(F.translate(F.substr(text, start, at + F.length(match) + context - start), "\n", " "))
        found.append(F.when(match != "", F.struct(F.lit(datum).alias("datum"), match.alias("match"), snippet.alias("snippet"))))
    return F.coalesce(*found)
