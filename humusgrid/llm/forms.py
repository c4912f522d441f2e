"""One form for text that prints alike.

Two forms are made, each once per distinct text of a table. canonical_form: compatibility normalisation, composed; full
case folding; blanks mapped to single spaces; default-ignorable characters
removed; look-alike letters of other scripts mapped to one letter. It is what
texts are compared and grouped by. look_form: the same steps without what the
eye sees, that is letter case and raised, lowered or framed characters; texts
with equal look_form print alike. Equal look implies equal canonical form.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.session import cut_lineage

# Letters of other scripts that print like a Latin letter, pairs of (other, Latin).
LOOK_ALIKE = (
    # Cyrillic
    "аa еe оo рp сc уy хx іi јj ѕs ԁd ԛq ԝw һh ӏl ѵv ɡg "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ԌG ԚQ ԜW ҺH ӀI ѴV "
    # Greek
    "οo νv ϲc ϳj "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ "
    # Latin letters and marks with a plain twin
    "ıi ‐- ‑- ﹣- ’' ʼ' ＇'"
)
TWINS = {ord(pair[0]): pair[1] for pair in LOOK_ALIKE.split()}
# Small letters whose capitals print like a Latin capital: without case they are the same letter.
FOLDED_TWINS = {ord(pair[0].casefold()): pair[1].casefold() for pair in LOOK_ALIKE.split() if pair[0].isupper()} | {k: v.casefold() for k, v in TWINS.items()}
# Default-ignorable characters, as ranges.
IGNORABLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
# Characters that print nothing although they are not blanks (controls).
CONTROL = "\x00-\x08\x0e-\x1b\x7f\x80-\x84\x86-\x9f"
DROPPED = re.compile(f"[{IGNORABLE}{CONTROL}]")
# U+2800 is a blank of the braille block; str.isspace covers the rest
BLANK = re.compile(r"[\s\u2800]+")
# Compatibility mappings that change what is seen.
SEEN_TAGS = ("<super>", "<sub>", "<fraction>", "<circle>", "<square>", "<font>", "<vertical>")
SEEN_SIGNS = "\u2116\u017f\u2122\u00a8\u00af\u00b4\u00b8\u203c\u2047\u2048\u2049"


def _compatible(ch: str, seen: bool) -> str:
    """Compatibility mapping of one character, but not where it changes the look."""
    if not seen or ch in SEEN_SIGNS or unicodedata.decomposition(ch).startswith(SEEN_TAGS):
        return unicodedata.normalize("NFC" if seen else "NFKC", ch)
    return unicodedata.normalize("NFKC", ch)


_SEEN: dict[str, str] = {}


def _plain_forms(text: str) -> str:
    """Wide, narrow and joined forms of letters as the plain letters; raised ones stay."""
    out = []
    for ch in text:
        if ch < "\x80":
            out.append(ch)
            continue
        got = _SEEN.get(ch)
        if got is None:
            got = _SEEN[ch] = _compatible(ch, True)
        out.append(got)
    return "".join(out)


def look_form(text: str) -> str:
    """What is seen of a text: equal exactly for texts that print alike. Blank texts give ''."""
    if text.isascii():
        return BLANK.sub(" ", DROPPED.sub("", text)).strip(" ")
    s = DROPPED.sub("", text)
    s = unicodedata.normalize("NFD", _plain_forms(unicodedata.normalize("NFC", s))).translate(TWINS)
    return BLANK.sub(" ", unicodedata.normalize("NFC", s)).strip(" ")


def canonical_form(text: str) -> str:
    """Form to compare by, coarser than the look: case and raised forms do not count.

    Letters that look alike in one case are one letter in both, as the Cyrillic
    ve, whose capital prints like B: else a look-alike would have no case.
    """
    s = look_form(text)
    if s.isascii():
        return s.casefold()
    s = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", s).casefold())
    s = unicodedata.normalize("NFC", unicodedata.normalize("NFD", s).translate(FOLDED_TWINS))
    return BLANK.sub(" ", s).strip(" ")


def per_distinct(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    """Vectorised column function that works each distinct value of a batch once; null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            codes, values = pd.factorize(batch)
            formed = pd.Series([fn(v) for v in values] + [None], dtype=object)
            yield formed.take(codes).reset_index(drop=True)

    return run


def canonical_text(col: Column) -> Column:
    return per_distinct(canonical_form)(col)


def look_text(col: Column) -> Column:
    return per_distinct(look_form)(col)


def distinct_looks(texts: DataFrame) -> DataFrame:
    """(text, look) of every distinct text of a column `text` that prints anything."""
    return texts.filter("text is not null").select("text").distinct().withColumn("look", look_text(F.col("text"))).filter("look <> ''")


def look_alike_pairs(df: DataFrame, id_col: str, text_col: str, scope_col: str | None = None) -> DataFrame:
    """Pairs of different ids whose stored texts print alike but differ in characters.

    Returns (id_a, id_b), id_a < id_b, each pair once. scope_col: only ids of
    the same value there are compared.

    The form is made once per distinct text; forms of a single text are left
    out, which leaves few. Of the others the texts of a form are paired, and
    then their ids, so that copies of one text never meet each other: the work
    grows with the pairs that come out. Letter case is seen, so the form that
    decides is look_form, canonical_form without its folding of case.

    Defined results: null texts, texts without anything printed, null ids and
    (with a scope) null scopes make no pair; ids with several rows are compared
    by each of their texts; an empty table gives no rows; only the named columns
    are read.
    """
    scope = F.col(scope_col) if scope_col else F.lit("")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), scope.alias("scope")).filter("id is not null and text is not null and scope is not null")
    looks = cut_lineage(distinct_looks(rows), "looks")
    forms = looks.groupBy("look").agg(F.min("text").alias("lo"), F.max("text").alias("hi")).filter("lo <> hi").select("look")
    varied = looks.join(forms, "look", "left_semi")
    kept = cut_lineage(rows.join(varied, "text").distinct(), "kept")
    texts = kept.select("look", "scope", "text").distinct()
    a, b = (texts.select("look", "scope", F.col("text").alias(f"text_{k}")) for k in "ab")
    pairs = a.join(b, ["look", "scope"]).filter("text_a < text_b").drop("look")
    first, second = (kept.select("scope", F.col("text").alias(f"text_{k}"), F.col("id").alias(f"id_{k}")) for k in "ab")
    met = pairs.join(first, ["scope", "text_a"]).join(second, ["scope", "text_b"]).filter("id_a <> id_b")
    return met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()


def look_classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, one_form, class_id, texts): every row with the form of its text.

    class_id is the smallest text of the same look, the representative of its
    class, and texts the number of different texts in the class: membership of
    any number of copies without their pairs. Null texts, and texts that print
    nothing, have nulls.
    """
    looks = cut_lineage(distinct_looks(df.select(F.col(text_col).alias("text"))), "looks")
    classes = looks.groupBy("look").agg(F.min("text").alias("class_id"), F.count(F.lit(1)).alias("texts"))
    named = looks.join(classes, "look").select(F.col("text").alias("_text"), F.col("look").alias("one_form"), "class_id", "texts")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.join(named, rows["text"] == named["_text"], "left").drop("_text")
