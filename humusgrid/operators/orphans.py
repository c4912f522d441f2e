"""References to records that do not exist, are gone, or arrive later.

Both sides are co-partitioned by the normalised key, sorted, and merged
linearly: that is Spark's sort-merge join, asked for by a hint so that it never
turns into a broadcast of a parent table that grows with the data. The parent
side is reduced to one row per key first (map-side partial aggregation): the
time of its earliest row, the time from which it is never deleted, and the
distinct intervals that ended. So a hot parent key cannot multiply rows; a hot
reference key is split by the adaptive skew join, whose left side may be cut
freely in a left outer join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters that count as blank around a key.
BLANKS = " \t\n\r\x0b\x0c\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"


#: Seconds of the epoch before every time, the first second of the year 1.
BEFORE_ALL = -62135596800


def key_form(col: Column) -> Column:
    """Key without letter case and blanks around it; null for a blank key."""
    bare = F.btrim(col.cast("string"), F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.lower(bare))


@dataclass(frozen=True)
class Reference:
    """One reference: child.ref_col -> parent.parent_col.

    valid_to_col names the time a parent row was deleted (none: never deleted).
    """

    child_table: str
    key_col: str
    ref_col: str
    child_time: str
    parent_table: str
    parent_col: str
    parent_time: str
    valid_to_col: str | None = None


def orphan_references(child: DataFrame, parent: DataFrame, ref: Reference) -> DataFrame:
    """Rows of child whose reference finds no parent valid at the row's time.

    Returns (child_table, child_key, ref_key, at, state); state is `missing` (no
    parent row of that key), `late` (the earliest parent row is younger than the
    reference) or `deleted` (a parent row had been there, but none is valid at
    the time of the reference: ended, or ended and not yet back).

    Defined results: a null or blank reference is no case; a null child time
    can only be `missing`; parent rows with a null key are ignored, those with a
    null time are valid from ever; intervals include both their ends, one that
    ends before it begins covers nothing; repeated child rows come out
    once each as they are stored; an empty parent makes every reference
    `missing`; an empty child gives no rows. Only the named columns are read, so
    further columns with clashing names do no harm.
    """
    left = child.select(
        F.lit(ref.child_table).alias("child_table"),
        F.col(ref.key_col).cast("string").alias("child_key"),
        key_form(F.col(ref.ref_col)).alias("ref_key"),
        F.col(ref.child_time).alias("at"),
    ).filter(F.col("ref_key").isNotNull())
    ended = F.col(ref.valid_to_col) if ref.valid_to_col else F.lit(None).cast("timestamp")
    times = parent.select(
        key_form(F.col(ref.parent_col)).alias("parent_key"),
        F.coalesce(F.col(ref.parent_time), F.timestamp_seconds(F.lit(BEFORE_ALL))).alias("since"),
        ended.alias("until"),
    ).filter(F.col("parent_key").isNotNull())
    reduced = [F.min("since").alias("since"), F.min(F.when(F.col("until").isNull(), F.col("since"))).alias("open_since")]
    if ref.valid_to_col:
        reduced.append(F.collect_set(F.when(F.col("until").isNotNull(), F.struct("since", "until"))).alias("closed"))
    right = times.groupBy("parent_key").agg(*reduced)
    joined = left.join(right.hint("merge"), left["ref_key"] == right["parent_key"], "left")
    state = F.when(F.col("parent_key").isNull(), F.lit("missing")).when(F.col("since") > F.col("at"), F.lit("late"))
    if ref.valid_to_col:
        valid = F.coalesce(F.col("open_since") <= F.col("at"), F.lit(False)) | F.exists("closed", lambda x: (x["since"] <= F.col("at")) & (F.col("at") <= x["until"]))
        state = state.when(F.col("at").isNotNull() & ~valid, F.lit("deleted"))
    return (
        joined.withColumn("state", state)
        .filter(F.col("state").isNotNull())
        .select("child_table", "child_key", "ref_key", "at", "state")
    )


def all_orphans(pairs: Sequence[tuple[DataFrame, DataFrame, Reference]]) -> DataFrame:
    """Orphans of several references under one schema."""
    out = None
    for child, parent, ref in pairs:
        part = orphan_references(child, parent, ref)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no reference given")
    return out


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan rows per child table, month of the referring row and state.

    Rows without a time fall into the month null.
    """
    return (
        orphans.groupBy(
            "child_table", F.date_format("at", "yyyy-MM").alias("month"), "state"
        ).agg(F.count(F.lit(1)).alias("orphans"), F.count_distinct("child_key").alias("keys"))
    )
