"""Join operators beyond the plain kinds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_partner(links: DataFrame, key: str, partner: str) -> DataFrame:
    """Keys with exactly one distinct partner."""
    return links.groupBy(key).agg(F.count_distinct(partner).alias("_n"), F.min(partner).alias(partner)).filter("_n = 1").drop("_n")


def unique_key_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that name one row on either side; ambiguous keys find nothing."""
    one = lambda df: df.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").drop("_n"), list(keys), "left_semi")
    return one(left).join(one(right), list(keys))


def not_in(left: DataFrame, key: str, right: DataFrame) -> DataFrame:
    """Rows whose key is not among the right keys; null keys on the right are ignored, on the left dropped."""
    held = right.filter(F.col(right.columns[0]).isNotNull()).select(F.col(right.columns[0]).alias(key)).distinct()
    return left.filter(F.col(key).isNotNull()).join(held, key, "left_anti")


def tolerance_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_value: str, right_value: str, eps: float) -> DataFrame:
    """Rows of equal keys whose values differ by less than eps.

    The values are cut into cells of width eps and the right side is entered in
    its cell and both neighbours, so equal keys with many values stay an
    equi-join.
    """
    cell = lambda c: F.floor(F.col(c) / eps)
    a = left.withColumn("_cell", cell(left_value))
    b = right.withColumn("_cell", F.explode(F.sequence(cell(right_value) - 1, cell(right_value) + 1)))
    return a.join(b, [*on, "_cell"]).filter(F.abs(F.col(left_value) - F.col(right_value)) < eps).drop("_cell")


def jaccard_join(left: DataFrame, right: DataFrame, set_col: str, item_col: str, least_shared: int, least: float) -> DataFrame:
    """Pairs of sets of two sides by Jaccard similarity: an equi-join on items, never all pairs."""
    a, b = (df.select(F.col(set_col).alias(s), item_col).distinct() for df, s in ((left, "set_a"), (right, "set_b")))
    na, nb = (df.groupBy(s).agg(F.count(F.lit(1)).alias(f"n_{s[-1]}")) for df, s in ((a, "set_a"), (b, "set_b")))
    shared = a.join(b, item_col).groupBy("set_a", "set_b").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= least_shared)
    out = shared.join(na, "set_a").join(nb, "set_b").withColumn("jaccard", F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared")))
    return out.filter(F.col("jaccard") >= least)


def mutual_best(pairs: DataFrame, a: str, b: str, score: str, margin: float, no_second: float = 99.0) -> DataFrame:
    """Pairs that are best for both sides, the best at least `margin` times the runner-up; ties go to the smaller ids."""
    out = pairs
    for side, other in ((a, b), (b, a)):
        w = Window.partitionBy(side).orderBy(F.desc(score), other)
        out = out.withColumn(f"_rank_{side}", F.row_number().over(w)).withColumn(f"_next_{side}", F.lead(score).over(w))
    ratio = lambda side: F.coalesce(F.col(score) / F.expr(f"nullif(_next_{side}, 0)"), F.lit(no_second))
    out = out.withColumn("margin", F.least(ratio(a), ratio(b)))
    return out.filter(f"_rank_{a} = 1 and _rank_{b} = 1").filter(F.col("margin") >= margin).drop(*[f"_{k}_{s}" for k in ("rank", "next") for s in (a, b)])


#: Parts of an octave of magnitudes, and the width in microseconds of a part of times.
OCTAVE, DAY = 1024, 86_400_000_000


def ordered_part(value: Column, kind: str = "double") -> Column:
    """Number of the part a value falls into; a larger value is never in a lower part. Times go by days, numbers by magnitude."""
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.floor(F.unix_micros(value.cast("timestamp")) / DAY)
    v = value.cast("double")
    far, most = 4_000_000, 1 << 40
    part = F.floor(F.log2(F.abs(v)) * OCTAVE) + far
    return F.when(F.isnan(v), F.lit(most + 1)).when(F.abs(v) == float("inf"), F.when(v > 0, F.lit(most)).otherwise(F.lit(-most))).when(v > 0, part).when(v < 0, -part).when(v == 0, F.lit(0))


def asof(left: DataFrame, right: DataFrame, on: Sequence[str], left_at: str, right_at: str, carry: Sequence[str], forward: bool = False, within: Column | None = None) -> DataFrame:
    """Each left row with the nearest right row of its key at or before (or strictly after) it.

    Both sides are put in one stream, cut into ordered parts by time, and the
    last right row is carried along within each part and from one to the next,
    so a hot key is spread over tasks. Ties on the right go to the largest
    carried values (forward, the smallest); a left row without partner, and one
    with a null key or time, has nulls.
    """
    names = left.columns
    pack = F.struct(F.col(right_at).alias("at"), *[F.col(c).alias(c) for c in carry])
    r = right.select(*on, F.col(right_at).alias("_at"), F.lit(0 if not forward else 1).alias("_side"), pack.alias("_r")).dropna(subset=[*on, "_at"])
    own = left.select(*on, F.col(left_at).alias("_at"), F.lit(1 if not forward else 0).alias("_side"), F.struct(*names).alias("_l"))
    part = ordered_part(F.col("_at"), dict(right.dtypes)[right_at])
    spread = own.unionByName(r, allowMissingColumns=True).withColumn("_part", part)
    # forward, equal times do not count as after: they come later in the order of falling times
    order = [F.desc("_at"), "_side", F.desc("_r")] if forward else ["_at", "_side", "_r"]
    held = F.struct("_at", "_r")
    ends = r.withColumn("_part", part).groupBy(*on, "_part").agg((F.min(held) if forward else F.max(held))["_r"].alias("_end"))
    # parts of left rows alone, too, carry what came before: one row per key and part
    every = ends.unionByName(own.withColumn("_part", part).select(*on, "_part").distinct(), allowMissingColumns=True).groupBy(*on, "_part").agg(F.max("_end").alias("_end"))
    before = Window.partitionBy(*on).orderBy(F.desc("_part") if forward else F.asc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = every.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).drop("_end").withColumnsRenamed({**{c: f"_on_{c}" for c in on}, "_part": "_p"})
    w = Window.partitionBy(*on, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = spread.withColumn("_f", F.last("_r", ignorenulls=True).over(w)).filter("_l is not null")
    same = F.col("_part") == F.col("_p")
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    found = found.join(carried, same, "left").withColumn("_f", F.coalesce("_f", "_carried"))
    known = F.col("_at").isNotNull()
    for c in on:
        known = known & F.col(c).isNotNull()
    out = found.select("_l.*", F.when(known, F.col("_f.at")).alias("matched_at"), *[F.when(known, F.col(f"_f.{c}")).alias(f"matched_{c}") for c in carry])
    return out if within is None else out.filter(within)


def next_rows(df: DataFrame, on: Sequence[str], order: Sequence[str], carry: dict[str, str]) -> DataFrame:
    """df with columns of the next row of the key in order (names by carry), null for the last one.

    The first column of the order, a time or a number, cuts the rows into
    ordered parts, so a hot key is spread over tasks; its nulls come first.
    """
    pack = F.struct(*carry)
    part = F.coalesce(ordered_part(F.col(order[0]), dict(df.dtypes)[order[0]]), F.lit(-(1 << 50)))
    spread = df.withColumn("_part", part)
    first = spread.groupBy(*on, "_part").agg(F.min(F.struct(*order, pack.alias("_x")))["_x"].alias("_first"))
    ahead = Window.partitionBy(*on).orderBy("_part")
    following = first.withColumn("_over", F.lead("_first").over(ahead)).drop("_first").withColumnsRenamed({**{c: f"_on_{c}" for c in on}, "_part": "_p"})
    within = spread.withColumn("_next", F.lead(pack).over(Window.partitionBy(*on, "_part").orderBy(*order)))
    same = F.col("_part") == F.col("_p")
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    joined = within.join(following, same, "left").withColumn("_next", F.coalesce("_next", "_over"))
    return joined.select(*df.columns, *[F.col(f"_next.{c}").alias(name) for c, name in carry.items()])


def unique_key_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(outcome, rows) of the left rows: linked, ambiguous_left, ambiguous_right or unmatched; a null key is unmatched."""
    count = lambda df, name: df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    named = left.join(count(left, "_a"), list(keys), "left").join(count(right, "_b"), list(keys), "left")
    outcome = F.when(F.col("_b").isNull(), "unmatched").when(F.col("_a") > 1, "ambiguous_left").when(F.col("_b") > 1, "ambiguous_right").otherwise("linked")
    return named.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


def zip_lists(df: DataFrame, key: str, first: str, second: str, order: str, least: int = 2, most: int = 12) -> DataFrame:
    """(key, position, first, second): two lists of a key, nulls left out, paired by position where both are of one length from least to most.

    Each list is in the order of `order`, nulls last, then of its values; longer
    lists are left out by their counts before any list is made.
    """
    counts = df.groupBy(key).agg(F.count(first).alias("_a"), F.count(second).alias("_b")).filter((F.col("_a") == F.col("_b")) & F.col("_a").between(least, most)).select(key)
    kept = df.join(counts, key, "left_semi")
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(order).isNull().alias("last"), F.col(order).alias("o"), F.col(c).alias("v"))))), lambda x: x["v"])
    both = kept.groupBy(key).agg(F.arrays_zip(listed(first).alias(first), listed(second).alias(second)).alias("_z"))
    return both.select(key, F.posexplode("_z").alias("position", "_p")).select(key, "position", F.col(f"_p.{first}").alias(first), F.col(f"_p.{second}").alias(second))


def plain_tokens(text: Column) -> Column:
    """Letters and digits of a text in small letters, other characters as single blanks, a blank at either end."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def label_in_text(texts: DataFrame, labels: DataFrame, on: str, text_id: str, text: str, label_id: str, label: str) -> DataFrame:
    """(text_id, label_id) where the label stands in the text of the same `on` as whole tokens.

    An equi-join on `on` and the label's first token, then the whole label is
    looked for; so texts meet only labels that begin with one of their words.
    """
    t = texts.select(on, text_id, plain_tokens(F.col(text)).alias("_t")).filter(F.col(on).isNotNull() & F.col("_t").isNotNull())
    n = labels.select(F.col(on), label_id, plain_tokens(F.col(label)).alias("_l")).filter(F.col(on).isNotNull() & (F.trim("_l") != "")).distinct()
    n = n.withColumn("_l", F.concat(F.lit(" "), F.trim("_l"), F.lit(" "))).withColumn("_first", F.element_at(F.split(F.trim("_l"), " "), 1))
    words = t.select(on, text_id, "_t", F.explode(F.array_distinct(F.split(F.trim("_t"), " "))).alias("_first"))
    return words.join(n, [on, "_first"]).filter(F.contains(F.col("_t"), F.col("_l"))).select(text_id, label_id).distinct()


def only_partner(pairs: DataFrame, key: str, partner: str) -> DataFrame:
    """Pairs whose key has no second partner."""
    return unique_partner(pairs, key, partner)


def reuse_or_create(wanted: DataFrame, existing: DataFrame, keys: Sequence[str], id_col: str, new_id: Column) -> DataFrame:
    """wanted with (id_col, outcome): the existing id where the keys name exactly one, a new id where none, null where several."""
    held = existing.dropna(subset=list(keys)).groupBy(*keys).agg(F.count_distinct(id_col).alias("_n"), F.min(id_col).alias("_have"))
    joined = wanted.join(held, list(keys), "left")
    outcome = F.when(F.col("_n").isNull(), "created").when(F.col("_n") == 1, "reused").otherwise("ambiguous")
    made = F.when(F.col("_n").isNull(), new_id).when(F.col("_n") == 1, F.col("_have"))
    return joined.select(*wanted.columns, made.alias(id_col), outcome.alias("outcome"))


def link_translations(left: DataFrame, right: DataFrame, keys: Sequence[str], trusted: tuple[DataFrame, DataFrame], raw: tuple[DataFrame, DataFrame], least_shared: int = 5, least: float = 0.25, margin: float = 1.8, gap: int = 1) -> DataFrame:
    """Documents of two corpora that are one study: (left_id, right_id, relation, evidence).

    left, right: (id, year, keys...). Three steps, each on what is not linked
    yet: keys that name one document on either side (relation translation_of);
    then documents that are best for each other by the Jaccard similarity of
    their trusted values, then of their raw cells (same_study), the years at
    most `gap` apart where both are known. trusted, raw: (id, value) of both sides.
    """
    a, b = left.dropna(subset=list(keys)), right.dropna(subset=list(keys))
    cited = unique_key_match(a.select("id", *keys).distinct(), b.select(F.col("id").alias("other"), *keys).distinct(), keys)
    out = cited.select(F.col("id").alias("left_id"), F.col("other").alias("right_id"), F.lit("translation_of").alias("relation"), F.lit("citation").alias("evidence"))
    for sides, evidence in ((trusted, "trusted_values"), (raw, "raw_cells")):
        open_ = [side.join(out.select(F.col(c).alias("id")), "id", "left_anti") for side, c in zip(sides, ("left_id", "right_id"))]
        pairs = jaccard_join(*open_, "id", "value", least_shared, least)
        years = [side.groupBy("id").agg(F.min("year").alias("year")) for side in (left, right)]
        dated = pairs.join(years[0].select(F.col("id").alias("set_a"), F.col("year").alias("_y")), "set_a", "left").join(years[1].select(F.col("id").alias("set_b"), F.col("year").alias("_z")), "set_b", "left")
        near = dated.filter(F.coalesce(F.abs(F.col("_y") - F.col("_z")) <= gap, F.lit(True)))
        best = mutual_best(near, "set_a", "set_b", "jaccard", margin)
        out = out.unionByName(best.select(F.col("set_a").alias("left_id"), F.col("set_b").alias("right_id"), F.lit("same_study").alias("relation"), F.lit(evidence).alias("evidence")))
    return out
