"""Statistics over measurement tables, as expressions where they have a closed form."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from humusgrid.operators.aggregate import ranked_values


def fractional_rank(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """df with ranks from 1 within the keys, ties averaged, null values without a rank; by counted values."""
    ranks = ranked_values(df, keys, value).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_v", (F.col("_before") + (F.col("_c") + 1) / 2.0).alias(name))
    on = F.col(value) == F.col("_v")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(ranks, on, "left").select(*df.columns, name)


def pearson(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 3) -> DataFrame:
    """Pairwise complete Pearson r with its Fisher-z interval of 95 percent; groups of fewer rows are left out."""
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("r")).filter((F.col("n") >= least) & F.col("r").isNotNull())
    z = F.atanh(F.greatest(F.lit(-0.9999), F.least(F.lit(0.9999), F.col("r"))))
    half = 1.96 / F.sqrt(F.greatest(F.col("n") - 3, F.lit(1)))
    return out.withColumn("low", F.tanh(z - half)).withColumn("high", F.tanh(z + half))


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Rank correlation of each group, pairwise complete: (keys, n, rho). Equal pairs are counted before they are ranked."""
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, x, y)
    pairs = rows.groupBy(*keys, x, y).agg(F.count(F.lit(1)).alias("_m"))
    for c, name in ((x, "_x"), (y, "_y")):
        ranks = ranked_values(rows, keys, c).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_v", (F.col("_before") + (F.col("_c") + 1) / 2.0 - (F.col("_n") + 1) / 2.0).alias(name))
        on = F.col(c) == F.col("_v")
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        pairs = pairs.join(ranks, on).select(*pairs.columns, name)
    w = lambda a, b: F.sum(F.col("_m") * F.col(a) * F.col(b))
    return pairs.groupBy(*keys).agg(F.sum("_m").alias("n"), (w("_x", "_y") / F.sqrt(w("_x", "_x") * w("_y", "_y"))).alias("rho"))


def ols_line(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares line of each group: n, slope, intercept, r2."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def bh_q(df: DataFrame, p: str, id_col: str) -> DataFrame:
    """Benjamini-Hochberg q of a table of tests (one row per test, so of bounded size)."""
    w = Window.orderBy(p, id_col)
    ranked = df.withColumn("_k", F.row_number().over(w)).withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy()))
    raw = ranked.withColumn("_q", F.col(p) * F.col("_m") / F.col("_k"))
    down = Window.orderBy(F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)
    return raw.withColumn("q", F.least(F.lit(1.0), F.min("_q").over(down))).drop("_k", "_m", "_q")


def mann_whitney(df: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """Rank-sum U of two groups and its normal score with tie correction: one row, by counted values."""
    rows = df.filter(F.col(group).isin(a, b) & F.col(value).isNotNull()).select(F.lit(0).alias("_g"), group, value)
    own = rows.groupBy(F.col(value).alias("_w")).agg(F.count_if(F.col(group) == a).alias("na"), F.count_if(F.col(group) == b).alias("nb"))
    ranked = ranked_values(rows, ["_g"], value).join(own, F.col("_v") == F.col("_w")).withColumn("mid", F.col("_before") + (F.col("_c") + 1) / 2.0)
    t = F.col("_c").cast("double")
    s = ranked.agg(F.sum(F.col("na") * F.col("mid")).alias("ra"), F.sum("na").cast("double").alias("n1"), F.sum("nb").cast("double").alias("n2"), F.sum(t * t * t - t).alias("ties"))
    n = F.col("n1") + F.col("n2")
    u = F.col("ra") - F.col("n1") * (F.col("n1") + 1) / 2
    sd = F.sqrt(F.col("n1") * F.col("n2") / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    return s.select(F.col("n1").cast("long").alias("n1"), F.col("n2").cast("long").alias("n2"), u.alias("u"), ((u - F.col("n1") * F.col("n2") / 2) / sd).alias("z"))


def sample_skewness(value: str) -> Column:
    """Bias-corrected skewness."""
    n = F.count(value)
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def auto_log(df: DataFrame, key: str, value: str, exempt: Sequence[str] = (), least: int = 3) -> DataFrame:
    """df with (use_log, transformed): the logarithm where a key's values are skewed beyond 1 and none is negative.

    Values below half the least positive one are raised to it. Keys in exempt,
    and keys of fewer than `least` values, keep their values; the latter are left out.
    """
    skew = sample_skewness(value)
    rule = df.groupBy(F.col(key).alias("_k")).agg(((skew > 1) & (F.min(value) >= 0)).alias("_log"), (F.min(F.when(F.col(value) > 0, F.col(value))) / 2).alias("_floor"), F.count(value).alias("_n")).filter(F.col("_n") >= least)
    joined = df.join(rule, F.col(key) == F.col("_k")).withColumn("use_log", F.coalesce("_log", F.lit(False)) & ~F.col(key).isin(*exempt) if exempt else F.coalesce("_log", F.lit(False)))
    return joined.withColumn("transformed", F.when(F.col("use_log"), F.log(F.greatest(value, "_floor"))).otherwise(F.col(value))).drop("_k", "_log", "_floor", "_n")


def moran_i(points: DataFrame, pairs: DataFrame) -> DataFrame:
    """Moran's I by inverse distance. points: (id, value); pairs: (id_a, id_b, km) within the reach, each once."""
    mean = points.agg(F.avg("value").alias("m"))
    dev = points.crossJoin(F.broadcast(mean)).select("id", (F.col("value") - F.col("m")).alias("d"))  # one row beside each
    total = dev.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("d") * F.col("d")).alias("ss"))
    w = pairs.select("id_a", "id_b", (1 / F.greatest("km", F.lit(0.001))).alias("w"))
    j = w.join(dev.withColumnsRenamed({"id": "id_a", "d": "da"}), "id_a").join(dev.withColumnsRenamed({"id": "id_b", "d": "db"}), "id_b")
    sums = j.agg(F.sum(F.col("w") * F.col("da") * F.col("db")).alias("num"), F.sum("w").alias("w"))
    return sums.crossJoin(total).select("n", (F.col("n") * F.col("num") / (F.col("w") * F.col("ss"))).alias("moran_i"))


def random_intercept(df: DataFrame, keys: Sequence[str], group: str, x: str, y: str) -> DataFrame:
    """Random-intercept model by restricted likelihood: slope, its standard error, 95 percent interval and p, intraclass correlation.

    A group of rows enters the likelihood by seven sums only, which Spark makes;
    the fit of one key sees one row of sums per random group.
    """
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(group).isNotNull())
    sums = rows.groupBy(*keys, group).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).cast("double").alias("sx"), F.sum(y).cast("double").alias("sy"),
        F.sum(F.col(x) * F.col(x)).cast("double").alias("sxx"), F.sum(F.col(x) * F.col(y)).cast("double").alias("sxy"), F.sum(F.col(y) * F.col(y)).cast("double").alias("syy"),
    )
    # groups of equal size enter through their sums together: further moments of the group sums
    m = lambda a, b, name: F.sum(F.col(a) * F.col(b)).alias(name)
    by_size = sums.groupBy(*keys, "n").agg(F.count(F.lit(1)).alias("groups"), *[F.sum(c).alias(c) for c in ("sxx", "sxy", "syy", "sx", "sy")], m("sx", "sx", "gxx"), m("sx", "sy", "gxy"), m("sy", "sy", "gyy"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        t = {c: frame[c].to_numpy(float) for c in frame.columns if c not in keys}
        n, k = t["n"], t["groups"]

        def at(rho: float) -> tuple[float, float, float, float]:
            # V of a group is I + rho J; its inverse I - c J with c = rho / (1 + n rho)
            c = rho / (1 + n * rho)
            a11, a12, a22 = (k * n - c * k * n * n).sum(), (t["sx"] - c * n * t["sx"]).sum(), (t["sxx"] - c * t["gxx"]).sum()
            b1, b2, yy = (t["sy"] - c * n * t["sy"]).sum(), (t["sxy"] - c * t["gxy"]).sum(), (t["syy"] - c * t["gyy"]).sum()
            det = a11 * a22 - a12 * a12
            slope, icept = (a11 * b2 - a12 * b1) / det, (a22 * b1 - a12 * b2) / det
            df_ = (k * n).sum() - 2
            s2 = max((yy - icept * b1 - slope * b2) / df_, 1e-300)
            return df_ * np.log(s2) + (k * np.log1p(n * rho)).sum() + np.log(det), slope, np.sqrt(s2 * a11 / det), rho / (1 + rho)

        grid = np.concatenate(([0.0], np.logspace(-4, 3, 60)))
        with np.errstate(all="ignore"):
            best = min(range(len(grid)), key=lambda i: np.nan_to_num(at(grid[i])[0], nan=np.inf))
            low, high = grid[max(best - 1, 0)], grid[min(best + 1, len(grid) - 1)]
            for _ in range(60):
                a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
                low, high = (low, b) if at(a)[0] <= at(b)[0] else (a, high)
            _, slope, se, icc = at((low + high) / 2)
        return pd.DataFrame([[*(frame[key].iloc[0] for key in keys), int((k * n).sum()), int(k.sum()), float(slope), float(se), float(slope - 1.96 * se), float(slope + 1.96 * se), math.erfc(abs(slope / se) / math.sqrt(2)) if se > 0 else float("nan"), float(icc)]], columns=[*keys, "rows", "groups", "slope", "se", "low", "high", "p", "icc"])

    return by_size.groupBy(*keys).applyInPandas(fit, f"{kinds}, rows long, groups long, slope double, se double, low double, high double, p double, icc double")


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for k in range(1, 100_000):
        for term in (k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * out


def student_p(t: float, df: float) -> float:
    """Two-sided p of Student's t."""
    return beta_share(df / 2, 0.5, df / (df + t * t))


def sign_p(less: int, more: int) -> float:
    """Two-sided p of the sign test, exact."""
    n, k = less + more, min(less, more)
    return 1.0 if n == 0 else min(1.0, 2 * beta_share(n - k, k + 1, 0.5))


def with_p(df: DataFrame, name: str, fn: Callable[..., float], *columns: str) -> DataFrame:
    """df with a p-value made of its columns; one row per test, so few. A null in any of them gives null."""

    @F.pandas_udf("double")
    def run(*parts: pd.Series) -> pd.Series:
        return pd.Series([None if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*parts)], dtype="float64")

    return df.withColumn(name, run(*columns))


def ols_test(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Line of each group with t and p of its slope; groups of fewer than three rows, and exact lines, have nulls."""
    line = ols_line(df, keys, x, y)
    t = F.signum("slope") * F.sqrt(F.col("r2") * (F.col("n") - 2) / F.expr("nullif(1 - r2, 0)"))
    return with_p(line.withColumn("t", F.when(F.col("n") > 2, t)).withColumn("_df", (F.col("n") - 2).cast("double")), "p", student_p, "t", "_df").drop("_df")


def sign_test(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """(keys, less, more, p): pairs with a below and above b, ties left out, and the p of chance."""
    counts = df.filter(F.col(a) != F.col(b)).groupBy(*keys).agg(F.count_if(F.col(a) < F.col(b)).alias("less"), F.count_if(F.col(a) > F.col(b)).alias("more"))
    return with_p(counts, "p", sign_p, "less", "more")


def residual_diagnostics(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """(keys, n, breusch_pagan, influential, skew, kurtosis) of the residuals of each group's line.

    breusch_pagan is n R2 of the squared residuals on x; influential counts rows
    whose Cook's distance exceeds 4 / n. Null x or y are left out.
    """
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y"))
    line = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.regr_slope("_y", "_x").alias("_b"), F.regr_intercept("_y", "_x").alias("_a"), F.avg("_x").alias("_m"), F.regr_sxx("_y", "_x").alias("_sxx"), F.count(F.lit(1)).alias("_n"), (F.regr_syy("_y", "_x") * (1 - F.regr_r2("_y", "_x"))).alias("_sse")
    ).filter("_n > 2")
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    e = F.col("_y") - F.col("_a") - F.col("_b") * F.col("_x")
    own = rows.join(line, on).withColumn("_e", e).withColumn("_h", 1 / F.col("_n") + F.pow(F.col("_x") - F.col("_m"), 2) / F.col("_sxx"))
    cook = F.col("_e") * F.col("_e") * F.col("_h") / (2 * F.col("_sse") / (F.col("_n") - 2) * F.pow(1 - F.col("_h"), 2))
    n = F.count(F.lit(1))
    return own.groupBy(*keys).agg(n.alias("n"), (n * F.pow(F.corr(F.col("_e") * F.col("_e"), "_x"), 2)).alias("breusch_pagan"), F.count_if(cook > 4 / F.col("_n")).alias("influential"), F.skewness("_e").alias("skew"), F.kurtosis("_e").alias("kurtosis"))


def thinned_slopes(df: DataFrame, cell: Sequence[str], id_col: str, x: str, y: str, replicates: int, seed: int) -> DataFrame:
    """(replicate, n, slope): one row of each cell drawn by a seeded digest, and the line through them, for each replicate."""
    drawn = F.min(F.struct(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col("replicate").cast("string"), F.col(id_col).cast("string"))), F.col(x).alias("x"), F.col(y).alias("y")))
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    picked = rows.groupBy("replicate", *cell).agg(drawn.alias("d"))
    return picked.groupBy("replicate").agg(F.count(F.lit(1)).alias("n"), F.regr_slope("d.y", "d.x").alias("slope"))


def moran_p(points: DataFrame, pairs: DataFrame, replicates: int, seed: int) -> DataFrame:
    """(n, moran_i, p): Moran's I and the share of seeded permutations of the values that reach it.

    A permutation orders the points by a digest and hands the values on in that
    order; each replicate is a window of its own over the distinct points.
    """
    real = moran_i(points, pairs)
    copies = points.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    by_id = copies.withColumn("k", F.row_number().over(Window.partitionBy("r").orderBy("id"))).select("r", "k", "id")
    by_digest = copies.withColumn("k", F.row_number().over(Window.partitionBy("r").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), "r", F.col("id").cast("string"))), "id"))).select("r", "k", "value")
    shuffled = by_id.join(by_digest, ["r", "k"])
    mean = points.agg(F.avg("value").alias("m"))
    dev = shuffled.crossJoin(F.broadcast(mean)).select("r", "id", (F.col("value") - F.col("m")).alias("d"))  # one row beside each
    w = pairs.select("id_a", "id_b", (1 / F.greatest("km", F.lit(0.001))).alias("w"))
    j = w.join(dev.withColumnsRenamed({"id": "id_a", "d": "da"}), "id_a").join(dev.withColumnsRenamed({"id": "id_b", "d": "db", "r": "r2"}), "id_b").filter("r = r2")
    drawn = j.groupBy("r").agg((F.sum(F.col("w") * F.col("da") * F.col("db")) / F.sum("w")).alias("num"))
    spread = points.agg((F.var_pop("value")).alias("v"))
    found = drawn.crossJoin(F.broadcast(spread)).crossJoin(F.broadcast(real)).select((F.col("num") / F.col("v")).alias("i"), "moran_i", "n")  # one row beside each
    return found.groupBy("n", "moran_i").agg(((F.count_if(F.col("i") >= F.col("moran_i")) + 1) / (F.count(F.lit(1)) + 1)).alias("p"))
