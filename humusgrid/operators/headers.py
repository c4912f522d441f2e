"""Table headers: normal form, property, and how the property was recognised.

Headers recur, so each distinct header is classified once and the result is
joined back; the classification is a chain of JVM regular expressions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.functions import rules


# Rewrites of a header, in order: (pattern, replacement).
HEADER_REWRITES = (
    (r"\\(?:mathrm|textrm|text|mathit|left|right|rm|it)\b", " "),
    (r"\\[(){}\[\],;:!]", " "),
    (r"[\\{}$]", " "),
    (r"[_^]", " "),
    (r"\bH\s*2\s*O\b", "H2O"),
    (r"\s+", " "),
)


def normal_header(header: Column) -> Column:
    """Header without typesetting marks."""
    for pattern, to in HEADER_REWRITES:
        header = F.regexp_replace(header, pattern, to)
    return F.trim(header)


def _first(text: Column, tests: Iterable[tuple[str, str]]) -> Column:
    """Name of the first test whose pattern is found in the text, else null; literal patterns are compiled once a task."""
    return F.coalesce(*[F.when(text.rlike(pattern), F.lit(name)) for name, pattern in tests])


def _phrases() -> list[tuple[str, str]]:
    return [(name, f"(?iuU){pattern}") for name, pattern in rules.HEADER_PATTERNS]


def property_of(normal: Column) -> Column:
    """First phrase that fits; else the first element symbol of a header without digits; else null."""
    bare = F.regexp_replace(normal, f"(?iuU){rules.HEADER_UNIT}", " ")
    by_symbol = _first(bare, [(name, rf"\b{symbol}\b") for name, symbol in rules.SYMBOLS.items()])
    return F.coalesce(_first(normal, _phrases()), F.when(~bare.rlike(r"\d"), by_symbol))


def match_kind(normal: Column, prop: Column) -> Column:
    """phrase, symbol_clean or symbol_embedded; curated properties without a pattern count as phrase."""
    bare = F.regexp_replace(normal, f"(?iuU){rules.HEADER_UNIT}", " ")
    words = F.regexp_extract_all(bare, F.lit(r"([A-Za-zА-Яа-яЁё]+)"), 1)
    known = F.array(*[F.lit(w) for w in rules.SYMBOL_QUALIFIERS])
    literal = F.try_element_at(F.create_map(*[F.lit(x) for pair in rules.SYMBOLS.items() for x in pair]), prop)
    extra = F.filter(words, lambda w: (w != literal) & ~F.array_contains(known, F.lower(w)))
    by_symbol = F.when(literal.isNotNull(), F.when(F.size(extra) == 0, "symbol_clean").otherwise("symbol_embedded"))
    return F.when(_first(normal, _phrases()).isNotNull(), "phrase").otherwise(F.coalesce(by_symbol, F.lit("phrase")))


def classify_headers(df: DataFrame, header: str) -> DataFrame:
    """(header, property, kind) per distinct header; null headers have no row, a header without property has nulls."""
    distinct = df.select(F.col(header).alias("header")).filter("header is not null").distinct()
    found = distinct.withColumn("normal", normal_header(F.col("header"))).withColumn("property", property_of(F.col("normal")))
    return found.select("header", "property", F.when(F.col("property").isNotNull(), match_kind(F.col("normal"), F.col("property"))).alias("kind"))
