"""Aggregation operators over measurement tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from humusgrid.operators.joins import asof, ordered_part


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def truncated_bin(value: Column, width: float) -> Column:
    """Lower edge of the bin, cut towards zero."""
    return (value / width).cast("int") * int(width)


def floor_bin(value: Column, width: float) -> Column:
    return F.floor(value / width) * width


def right_closed_bin(value: Column, width: float) -> Column:
    """Upper edge of the bin (lower, upper]; null for values at or below zero."""
    return F.when(value > 0, F.ceil(value / width) * width)


def lower_percentiles(df: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float]) -> DataFrame:
    """Order statistic at floor(f * (n - 1)) of each group, null values left out; by counted values, so that no group is gathered."""
    ranked = ranked_values(df, keys, value)
    at = lambda f: F.floor((F.col("_n") - 1) * f)
    picks = [F.max(F.when((at(f) >= F.col("_before")) & (at(f) < F.col("_before") + F.col("_c")), F.col("_v"))).alias(f"p{round(f * 100)}") for f in fractions]
    return ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *picks)


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, missing, present) of the columns, blank text counting as missing; one scan."""
    kinds = dict(df.dtypes)
    blank = {c: F.trim(F.col(c)) == "" if kinds[c] == "string" else F.isnan(c) if kinds[c] in ("double", "float") else F.lit(False) for c in columns}
    row = df.agg(*[F.count_if(F.col(c).isNull() | F.coalesce(blank[c], F.lit(False))).alias(f"m_{c}") for c in columns], F.count(F.lit(1)).alias("n"))
    parts = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"m_{c}").alias("missing"), (F.col("n") - F.col(f"m_{c}")).alias("present")) for c in columns])
    return row.select(F.explode(parts).alias("x")).select("x.*")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (nulls equal) that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def first_pivot(df: DataFrame, row: str, column: str, value: str, values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Long to wide; of several values the first in the given order."""
    pick = [F.min(F.when(F.col(column) == v, F.struct(*order, value)))[value].alias(v) for v in values]
    return df.groupBy(row).agg(*pick)


def gini(df: DataFrame, value: str) -> DataFrame:
    """Gini coefficient of a column of counts: one row, null for no rows or a zero sum; by counted values."""
    ranked = ranked_values(df.select(F.lit(0).alias("_g"), value), ["_g"], value)
    # sum of ranks of equal values: c * before + c (c + 1) / 2
    c = F.col("_c")
    terms = ranked.agg(F.sum("_c").alias("n"), F.sum(F.col("_v") * c).alias("s"), F.sum(F.col("_v") * (c * F.col("_before") + c * (c + 1) / 2)).alias("r"))
    return terms.select((2 * F.col("r") / F.expr("nullif(n * s, 0)") - (F.col("n") + 1) / F.col("n")).alias("gini"))


def pair_counts(df: DataFrame, group: str, item: str) -> DataFrame:
    """Pairs of items that share groups: shared groups, groups of each, Jaccard."""
    sets = df.select(group, item).filter(F.col(item).isNotNull()).distinct()
    sizes = sets.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    a, b = sets.select(group, F.col(item).alias("item_a")), sets.select(group, F.col(item).alias("item_b"))
    shared = a.join(b, group).filter("item_a < item_b").groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("shared"))
    out = shared.join(sizes.select(F.col(item).alias("item_a"), F.col("n").alias("n_a")), "item_a").join(sizes.select(F.col(item).alias("item_b"), F.col("n").alias("n_b")), "item_b")
    return out.withColumn("jaccard", F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared")))


def value_fingerprint(df: DataFrame, key: str, parts: Sequence[str]) -> DataFrame:
    """(key, fingerprint, size): digest of a key's sorted value list."""
    entry = F.concat_ws(":", *[F.col(p).cast("string") for p in parts])
    return df.groupBy(key).agg(F.sha1(F.array_join(F.array_sort(F.collect_list(entry)), ";")).alias("fingerprint"), F.count(F.lit(1)).alias("size"))


def capped_lists(df: DataFrame, key: str, item: Sequence[str], most: int) -> DataFrame:
    """First `most` items of each key in item order (a top-k report), by rank."""
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*item))).filter(F.col("_r") <= most)
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_r", *item))).alias("items")).select(key, F.transform("items", lambda x: F.struct(*[x[i].alias(i) for i in item])).alias("items"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, picks: dict[str, float]) -> DataFrame:
    """(keys, n, picks): quantiles by linear interpolation of each group, exact, null values left out.

    Equal values are counted first (map side), then ranked by prefix sums over
    ordered parts, so neither a group's values nor its ranks meet in one task
    however large the group is.
    """
    ranked = ranked_values(df, keys, value)
    at = {name: (F.col("_n") - 1) * q for name, q in picks.items()}
    # the value at a rank r covers the ranks from _before to _before + _c - 1
    holds = lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c"))
    both = [F.max(F.when(holds(end(a)), F.col("_v").cast("double"))).alias(f"_{side}_{name}") for name, a in at.items() for side, end in (("lo", F.floor), ("hi", F.ceil))]
    out = ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *both)
    part = {name: (F.col("n") - 1) * q - F.floor((F.col("n") - 1) * q) for name, q in picks.items()}
    return out.select(*keys, "n", *[(F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * part[name]).alias(name) for name in picks])


def ranked_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, _v, _c, _before, _n): each distinct value of a group, its rows, the rows below it, the rows of the group.

    Distinct values are cut into ordered parts by their magnitude and summed
    within a part; the sums of the parts before are added by a join, so a group
    of any size is spread over tasks, with no sampling and no pass more.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    spread = counted.withColumn("_part", ordered_part(F.col("_v")))
    parts = spread.groupBy(*keys, "_part").agg(F.sum("_c").alias("_s"))
    # one row per group and part
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_base", F.coalesce(F.sum("_s").over(earlier), F.lit(0))).withColumn("_n", F.sum("_s").over(Window.partitionBy(*keys)))
    within = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    own = spread.withColumn("_in", F.coalesce(F.sum("_c").over(within), F.lit(0)))
    right = offsets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_base", "_n")
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return own.join(right, on).select(*keys, "_v", "_c", (F.col("_in") + F.col("_base")).alias("_before"), "_n")


def clipped_histogram(df: DataFrame, value: str, least: int = 6, most: int = 20) -> DataFrame:
    """(bin, n): equal bins between the 1st and 99th percentile, as many as the square root of the count, from least to most."""
    bounds = exact_quantiles(df.select(F.lit(0).alias("_g"), value), ["_g"], value, {"lo": 0.01, "hi": 0.99}).select("lo", "hi")
    rows = df.select(value).join(F.broadcast(bounds), F.col(value).between(F.col("lo"), F.col("hi")))  # one row beside each
    bins = rows.agg(F.least(F.lit(most), F.greatest(F.lit(least), F.floor(F.sqrt(F.count(F.lit(1)))))).alias("k"))
    rows = rows.join(F.broadcast(bins))
    return rows.groupBy(F.least(F.col("k") - 1, F.floor((F.col(value) - F.col("lo")) / ((F.col("hi") - F.col("lo")) / F.col("k")))).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merged_values(df: DataFrame, key: str, columns: dict[str, str], separator: str) -> DataFrame:
    """(key, columns): distinct non-blank values of each column in order, joined; null where there is none."""
    told = lambda c: F.array_sort(F.collect_set(F.nullif(F.trim(c), F.lit(""))))
    return df.groupBy(key).agg(*[F.nullif(F.array_join(told(c), separator), F.lit("")).alias(name) for name, c in columns.items()])


def searched(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Rows that hold the text in any of the columns, letter case aside; a null column holds nothing."""
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(text.lower())), F.lit(False))
    return df.filter(found)


def nearest_marks(rows: DataFrame, marks: DataFrame, key: str, at: str) -> DataFrame:
    """rows with distance: signed microseconds to the nearest mark of the key, the one before on ties; rows without any mark are left out."""
    before = asof(rows, marks, [key], at, at, []).withColumnRenamed("matched_at", "_before")
    both = asof(before, marks, [key], at, at, [], forward=True).withColumnRenamed("matched_at", "_after")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    back, ahead = us("_before") - us(at), us("_after") - us(at)
    nearer = F.when(ahead.isNull() | (-back <= ahead), back).otherwise(ahead)
    return both.withColumn("distance", nearer).filter("distance is not null").drop("_before", "_after")
