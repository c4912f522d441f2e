"""Best representative of each duplicate group, field by field.

Fields come from the most trusted and most recent member that gives them. Free
text comes by consensus. The texts of a group are aligned token by token,
progressively: all of them to the longest, which opens the columns; then what
found no column, to the longest of what is left at its place, and so on until
every token has one. Each column is voted on by weight, and the existing text
closest to the consensus is named. As no step depends on the order of the texts,
small groups are worked within a task and large ones by rounds over the cluster,
with the same result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.session import cut_lineage

#: Distinct texts of a group up to which it is worked within a task; larger groups go by rounds, to the same end.
CHUNK = 64
# What is written where nothing is known, in lower case.
PLACEHOLDERS = (
    "", "-", "--", "—", "–", ".", "...", "…", "?", "*", "n/a", "na", "n.a.", "n.a", "#n/a", "none", "null", "nil", "nan", "unknown", "not known",
    "not available", "not specified", "unspecified", "undefined", "no data", "missing", "tbd", "нет", "нет данных", "не указано", "не указан",
    "не указана", "неизвестно", "не известно", "н/д", "н.д.", "б/д", "без данных", "отсутствует", "не определено",
)
FILLER = re.compile(r"(?:\s*[.…·_]){2,}\s*|\s+")


def bare(col: Column) -> Column:
    return F.lower(F.btrim(col.cast("string"), F.lit(" \t\n\r    ​﻿")))


def given(col: Column) -> Column:
    """The value says something: not null, NaN, blank or a placeholder."""
    return F.coalesce(~bare(col).isin(*PLACEHOLDERS), F.lit(False))


def trust_rank(col: Column, order: Sequence[str]) -> Column:
    """Larger for more trusted; 0 for null and values outside the order."""
    out = F.lit(0)
    for i, value in enumerate(reversed(order)):
        out = F.when(bare(col) == value, F.lit(i + 1)).otherwise(out)
    return out


def field_sources(members: DataFrame, records: DataFrame, id_col: str, fields: Sequence[str], trust: Column, updated: str) -> DataFrame:
    """(group_id, field_name, source_id): the survivor as `*`, and the source of each field that some member gives.

    members: (id, group_id). Only members with a row in records can be sources.
    The survivor is first in the number of given fields, then time, then trust;
    a field's source is first in trust, then time, among those that give it;
    remaining ties go to the smaller id.

    Defined results: of several rows of an id each field is judged in each row;
    rows with a null id are ignored; a null time is the earliest; groups without
    any row have no result; empty tables give no rows. All choices are
    aggregates that combine on the map side, so a hot group is no hot task.
    """
    told = records.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.unix_micros(F.col(updated).cast("timestamp")), F.lit(-(1 << 62))).alias("at"),
        trust.alias("trust"),
        *[given(F.col(f)).alias(f"given_{i}") for i, f in enumerate(fields)],
    ).filter("id is not null")
    rows = told.join(members, "id")
    n = sum((F.col(f"given_{i}").cast("int") for i in range(len(fields))), F.lit(0))
    # min of a struct that counts down picks the best and the smallest id of ties
    best = [F.min(F.struct((-n).alias("n"), (-F.col("at")).alias("t"), (-F.col("trust")).alias("r"), F.col("id").alias("id")))["id"].alias("s")]
    best += [F.min(F.when(F.col(f"given_{i}"), F.struct((-F.col("trust")).alias("r"), (-F.col("at")).alias("t"), F.col("id").alias("id"))))["id"].alias(f"s{i}") for i in range(len(fields))]
    chosen = rows.groupBy("group_id").agg(*best)
    named = [F.struct(F.lit("*").alias("field_name"), F.col("s").alias("source_id"))]
    named += [F.struct(F.lit(f).alias("field_name"), F.col(f"s{i}").alias("source_id")) for i, f in enumerate(fields)]
    return chosen.select("group_id", F.explode(F.array(*named)).alias("x")).select("group_id", "x.field_name", "x.source_id").filter("source_id is not null")


def clean_text(text: str | None) -> str:
    """What a text says: blanks and rows of dots as one space, placeholders as nothing."""
    if text is None:
        return ""
    s = FILLER.sub(" ", text).strip()
    return "" if s.lower() in PLACEHOLDERS else s


def _common_lengths(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Length of the longest common subsequence of a and each start of b, by bit vectors."""
    where: dict[str, int] = defaultdict(int)
    for j, w in enumerate(b):
        where[w] |= 1 << j
    full = (1 << len(b)) - 1
    v = full
    for w in a:
        if m := where.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    taken = np.unpackbits(np.frombuffer((v ^ full).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(taken, dtype=np.int64)))


def common_tokens(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, found by halving in linear memory."""
    pairs: list[tuple[int, int]] = []
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1 or set(a[a0:a1]).isdisjoint(b[b0:b1]):
            continue
        if a1 - a0 == 1:
            pairs.append((a0, b.index(a[a0], b0)))
            continue
        mid = (a0 + a1) // 2
        fore = _common_lengths(a[a0:mid], b[b0:b1])
        back = _common_lengths(a[mid:a1][::-1], b[b0:b1][::-1])[::-1]
        cut = b0 + int((fore + back).argmax())
        open_ += [(a0, mid, b0, cut), (mid, a1, cut, b1)]
    return sorted(pairs)


def align(a: list[str], b: list[str]) -> list[tuple[bool, int, int, int, int]]:
    """Stretches (equal, a0, a1, b0, b1) of two token lists, exact at any length."""
    steps: list[tuple[bool, int, int, int, int]] = []
    at, to = 0, 0
    for i, j in [*common_tokens(a, b), (len(a), len(b))]:
        if i > at or j > to:
            steps.append((False, at, i, to, j))
        if i < len(a):
            if steps and steps[-1][0] and steps[-1][2] == i and steps[-1][4] == j:
                steps[-1] = (True, steps[-1][1], i + 1, steps[-1][3], j + 1)
            else:
                steps.append((True, i, i + 1, j, j + 1))
        at, to = i + 1, j + 1
    return steps


def _whole(lead: str, word: str) -> str:
    """What a column led by one word hears from another: a cut word is heard as the whole one."""
    return lead if len(lead) > len(word) and (lead.startswith(word) or lead.endswith(word)) else word


def heard(lead: list[str], words: list[str]) -> tuple[list[tuple[int, str]], list[tuple[int, list[str]]]]:
    """Votes (column, word) of a text, and what has no column: (column before which it stands, words).

    Gaps do not vote: what a copy lacks it does not deny.
    """
    votes: list[tuple[int, str]] = []
    rest: list[tuple[int, list[str]]] = []
    for equal, a0, a1, b0, b1 in align(lead, words):
        if equal:
            votes += zip(range(a0, a1), words[b0:b1])
            continue
        n = min(a1 - a0, b1 - b0)
        # a cut word stands at the start (or the end) of what a copy holds, next to what it shares
        from_end = b0 == 0 and b1 < len(words)
        first = a1 - n if from_end else a0
        paired = words[b1 - n : b1] if from_end else words[b0 : b0 + n]
        votes += [(first + k, _whole(lead[first + k], w)) for k, w in enumerate(paired)]
        more = words[b0 : b1 - n] if from_end else words[b0 + n : b1]
        if more:
            rest.append((first if from_end else first + n, more))
    return votes, rest


def leading(texts: Iterable[str]) -> str:
    """The longest text, of equally long ones the greatest."""
    return max(texts, key=lambda t: (len(t), t))


def elect(lead: str, votes: dict[str, float]) -> str:
    """Word of a column: most votes by weight and length; the votes of a cut lead go to the word that completes it."""
    longer = {w: v for w, v in votes.items() if w != lead and _whole(w, lead) == w}
    if longer:
        best = max(longer.items(), key=lambda kv: (kv[1], kv[0]))[0]
        votes = votes | {best: votes[best] + votes.get(lead, 0.0)}
    return max(votes.items(), key=lambda kv: (kv[1], kv[0]))[0]


def consensus_of(texts: Sequence[str], weights: Sequence[float]) -> str:
    """Consensus of some texts, whatever their order."""

    def grow(held: dict[str, float]) -> list[str]:
        lead = leading(held).split()
        columns: list[dict[str, float]] = [defaultdict(float) for _ in lead]
        between: dict[int, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        for text, weight in held.items():
            votes, rest = heard(lead, text.split())
            for k, word in votes:
                columns[k][word] += weight * len(word)
            for k, words in rest:
                between[k][" ".join(words)] += weight
        out: list[str] = []
        for k in range(len(lead) + 1):
            if k in between:
                out += grow(between[k])
            if k < len(lead):
                out.append(elect(lead[k], columns[k]))
        return out

    held: dict[str, float] = defaultdict(float)
    for text, weight in zip(texts, weights):
        held[" ".join(text.split())] += weight
    return " ".join(grow(held)) if held else ""


def consensus_distance(text: str, consensus: str) -> int:
    """Characters in tokens that only one of the two has."""
    if text == consensus:
        return 0
    a, b = text.split(), consensus.split()
    return sum(sum(map(len, a[a0:a1])) + sum(map(len, b[b0:b1])) for equal, a0, a1, b0, b1 in align(a, b) if not equal)


def _small_groups(rows: DataFrame) -> DataFrame:
    """(group_id, text, weight) of groups that a task may hold -> (group_id, consensus)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: str | None = None
        texts: list[str] = []
        weights: list[float] = []
        for batch in batches:
            out: list[tuple[str, str]] = []
            for group, text, weight in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if group != held:
                    if held is not None:
                        out.append((held, consensus_of(texts, weights)))
                    held, texts, weights = group, [], []
                texts.append(text)
                weights.append(weight)
            yield _batch(out)
        if held is not None:
            yield _batch([(held, consensus_of(texts, weights))])

    def _batch(out: list[tuple[str, str]]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string())], names=["group_id", "consensus"])

    return rows.repartition("group_id").sortWithinPartitions("group_id").select("group_id", "text", "weight").mapInArrow(run, "group_id string, consensus string")


def _large_groups(rows: DataFrame) -> DataFrame:
    """The same by rounds: (group_id, text, weight) -> (group_id, consensus), no group gathered in a task.

    A round aligns every text to the leading one of its place and passes what
    found no column on to the next round, under a longer place. Places and
    columns are numbered so that their order is the order of the words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for group, place, text, weight, lead in zip(*(batch.column(i).to_pylist() for i in range(5))):
                tokens = lead.split()
                votes, rest = heard(tokens, text.split())
                out += [(group, f"{place}{k:09d}b", tokens[k], word, None, weight * len(word)) for k, word in votes]
                out += [(group, f"{place}{k:09d}a", None, None, " ".join(words), weight) for k, words in rest]
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.string()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["group_id", "place", "lead", "word", "text", "weight"])

    schema = "group_id string, place string, lead string, word string, text string, weight double"
    # texts are compared as their words stand, blanks do not count
    open_ = rows.select("group_id", F.lit("").alias("place"), "text", "weight")
    words = None
    while True:
        lead = open_.groupBy("group_id", "place").agg(F.max(F.struct(F.length("text").alias("n"), "text"))["text"].alias("lead"))
        heard_ = cut_lineage(open_.join(lead, ["group_id", "place"]).select("group_id", "place", "text", "weight", "lead").mapInArrow(run, schema), "heard")
        votes = heard_.filter("word is not null")
        words = votes if words is None else words.unionByName(votes)
        left = heard_.filter("text is not null")
        if left.isEmpty():
            break
        open_ = left.groupBy("group_id", "place", "text").agg(F.sum("weight").alias("weight"))
    votes = words.groupBy("group_id", "place", "lead", "word").agg(F.sum("weight").alias("weight"))
    completes = (F.length("word") > F.length("lead")) & (F.col("word").startswith(F.col("lead")) | F.col("word").endswith(F.col("lead")))
    most = F.max(F.struct("weight", "word"))
    column = votes.groupBy("group_id", "place").agg(
        F.max(F.when(completes, F.struct("weight", "word"))).alias("longer"),
        F.coalesce(F.max(F.when(F.col("word") == F.col("lead"), F.col("weight"))), F.lit(0.0)).alias("cut"),
        most.alias("any"),
        F.max(F.when(~completes, F.struct("weight", "word"))).alias("other"),
    )
    joined = F.struct((F.col("longer.weight") + F.col("cut")).alias("weight"), F.col("longer.word").alias("word"))
    elected = F.when(F.col("longer").isNull(), F.col("any.word")).otherwise(F.greatest(joined, F.col("other"))["word"])
    told = column.select("group_id", "place", elected.alias("word"))
    return told.groupBy("group_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("consensus"))


def consensus_sources(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(group_id, source_id): of each group the row whose text is closest to the consensus.

    rows: (group_id, id, text). Defined results: texts that are null, blank or
    nothing but dots and placeholders say nothing and are no source; a group of
    such texts has no result; of equally close texts the smaller id is named;
    copies of a text count with their number but are aligned once; an empty
    table gives no rows.
    """
    says = F.pandas_udf(lambda s: s.map(clean_text), "string")
    said = cut_lineage(rows.select("group_id", "id", says(F.coalesce("text", F.lit(""))).alias("text")).filter("text <> '' and group_id is not null and id is not null"), "said")
    level = said.groupBy("group_id", "text").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    large = said.groupBy("group_id").agg(F.count_distinct("text").alias("n")).filter(F.col("n") > chunk).select("group_id")
    if large.isEmpty():
        wanted = _small_groups(level)
    else:
        wanted = _small_groups(level.join(large, "group_id", "left_anti")).unionByName(_large_groups(level.join(large, "group_id", "left_semi")))

    @F.pandas_udf("long")
    def distance(text: pd.Series, consensus: pd.Series) -> pd.Series:
        return pd.Series([consensus_distance(a, b) for a, b in zip(text, consensus)], dtype="int64")

    near = said.join(wanted, "group_id").withColumn("far", distance("text", "consensus"))
    return near.groupBy("group_id").agg(F.min(F.struct("far", "id"))["id"].alias("source_id"))
