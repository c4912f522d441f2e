"""Moran's I of points by inverse distance, without a table of their pairs.

The globe is cut into slabs twice as high as the reach and the slabs into cells,
as in `spatial`. A point is at home in one tile; its copies go to the other
tiles that its disc touches in its own and the next lower slab. A tile weighs
the pairs of its points with all that came to it and gives the sums only, so a
shuffle holds points, never pairs. Tiles of many points are divided into chunks,
and every chunk of points meets every chunk of copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from humusgrid.operators.spatial import EARTH_KM, _cell_at, _cells_around, _slab_at, usable
from humusgrid.session import cut_lineage

#: Points, and copies, of a tile that meet in one call; points whose permuted values are put together in one call.
CHUNK, BLOCK = 16_384, 2048
#: Pairs that are weighed at once: points by copies.
ROWS, COLUMNS = 256, 2048
_LAST = 2**63 - 1


def _numbered(points: DataFrame) -> DataFrame:
    """points as a table (k, id, lat, lon, value), numbered from 0 in the order of their ids."""
    rows = points.select("id", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"), F.col("value").cast("double").alias("value"))
    return cut_lineage(rows.withColumn("k", (F.row_number().over(Window.orderBy("id")) - 1).cast("long")), "points")


def _tiles(points: DataFrame, distance_km: float) -> DataFrame:
    """(k, lat, lon, value, slab, cell, i, j, own, after): the points of each tile (own) and the copies that they meet.

    A point meets the copies of the same slab, cell, i and j whose `after` is
    above its k: each pair of points within the distance once.
    """
    reach = math.degrees(distance_km / EARTH_KM) * 1.0001 + 1e-9
    high = 2 * reach
    # the disc's greatest half width in degrees of longitude, all around where it holds a pole
    half = F.when(F.abs("lat") + reach < 90, F.degrees(F.asin(F.least(F.sin(F.lit(math.radians(min(reach, 90.0)))) / F.cos(F.radians("lat")), F.lit(1.0)))) * 1.0001 + 1e-9).otherwise(180.0)
    rows = points.filter(usable(F.col("lat"), F.col("lon"))).select("k", "lat", "lon", "value", _slab_at(F.col("lat"), high).alias("home"), F.least(half, F.lit(180.0)).alias("half"))
    rows = rows.withColumn("slab", F.explode(F.sequence(F.greatest(_slab_at(F.col("lat") - reach, high), F.lit(0).cast("long")), F.col("home")))).withColumn("n", _cells_around(F.col("slab"), high))
    start = F.when(F.col("half") >= 180, F.lit(-180.0)).otherwise(F.col("lon") - F.col("half"))
    end = F.when(F.col("half") >= 180, F.lit(180.0)).otherwise(F.col("lon") + F.col("half"))
    touched = F.array_distinct(F.transform(F.sequence(_cell_at(start, F.col("n")), _cell_at(end, F.col("n"))), lambda i: F.pmod(i, F.col("n"))))
    rows = rows.withColumn("cell", F.explode(touched))
    own = (F.col("slab") == F.col("home")) & (F.col("cell") == F.pmod(_cell_at(F.col("lon"), F.col("n")), F.col("n")))
    rows = rows.select("k", "lat", "lon", "value", "slab", "cell", own.alias("at_home"), F.when(F.col("slab") < F.col("home"), F.lit(_LAST)).otherwise(F.col("k")).alias("after"))
    parts = lambda n: F.ceil(n / CHUNK).cast("long")
    sizes = rows.groupBy("slab", "cell").agg(parts(F.count_if("at_home")).alias("ni"), parts(F.count(F.lit(1))).alias("nj")).filter("ni > 0")
    chunk = lambda n: F.pmod(F.xxhash64("k"), F.col(n))
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    met = F.concat(
        F.transform(each("nj"), lambda j: F.struct(F.lit(True).alias("own"), chunk("ni").alias("i"), j.alias("j"))),
        F.transform(each("ni"), lambda i: F.struct(F.lit(False).alias("own"), i.alias("i"), chunk("nj").alias("j"))),
    )
    joined = rows.join(sizes, ["slab", "cell"]).withColumn("m", F.explode(F.filter(met, lambda x: F.col("at_home") | ~x["own"])))
    return joined.select("k", "lat", "lon", "value", "slab", "cell", "m.i", "m.j", "m.own", "after")


def _packed(rows: np.ndarray) -> pa.Array:
    """Rows of doubles as binaries, equal bytes of the doubles side by side, which compresses well."""
    n, m = rows.shape
    planes = np.ascontiguousarray(np.ascontiguousarray(rows).view(np.uint8).reshape(n, m, 8).transpose(0, 2, 1))
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n + 1, dtype=np.int32) * (8 * m)), pa.py_buffer(planes)])


def _unpacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 8, -1)
    return np.ascontiguousarray(flat.transpose(0, 2, 1)).view(np.float64).reshape(len(column), -1)


def _weighed(a: dict[str, np.ndarray], b: dict[str, np.ndarray], distance_km: float) -> tuple[float, np.ndarray]:
    """Sum of the weights of the pairs of a and b, and of their weighted products for each column of values."""
    reach = math.degrees(distance_km / EARTH_KM) * 1.0001 + 1e-9
    most = math.sin(min(distance_km / EARTH_KM / 2, math.pi / 2)) ** 2 * (1 + 1e-6) + 1e-15
    w, num = 0.0, np.zeros(a["v"].shape[1])
    for at in (a, b):
        y, x = np.radians(at["lat"]), np.radians(at["lon"])
        at["c"] = np.cos(y)
        at["u"] = np.stack([at["c"] * np.cos(x), at["c"] * np.sin(x), np.sin(y)], 1)
    # blocks of neighbouring points: strips of latitude about as high as a block is wide
    strips = max(1, round(math.sqrt(len(a["lat"]) / ROWS)))
    by_lat = np.argsort(a["lat"], kind="stable")
    strip = np.empty(len(by_lat), np.int64)
    strip[by_lat] = np.arange(len(by_lat)) * strips // max(1, len(by_lat))
    order = np.lexsort((a["lon"], strip))
    for start in range(0, len(order), ROWS):
        own = order[start : start + ROWS]
        lat, lon, k = a["lat"][own], a["lon"][own], a["k"][own]
        far = np.abs(lat).max() + reach
        half = 180.0 if far >= 90 else math.degrees(math.asin(min(math.sin(math.radians(reach)) / math.cos(math.radians(np.abs(lat).max())), 1.0))) * 1.0001 + 1e-9
        middle = (lon.min() + lon.max()) / 2
        beside = np.abs((b["lon"] - middle + 180) % 360 - 180) <= half + (lon.max() - lon.min()) / 2 + 1e-9
        near = np.flatnonzero(beside & (b["lat"] >= lat.min() - reach) & (b["lat"] <= lat.max() + reach) & (b["k"] > k.min()))
        for first in range(0, len(near), COLUMNS):
            other = near[first : first + COLUMNS]
            # half the chord's square tells who may be near; the distance itself is the SQL's
            i, j = np.nonzero(((1 - a["u"][own] @ b["u"][other].T) / 2 <= most) & (k[:, None] < b["k"][other]))
            ai, bj = own[i], other[j]
            s, t = np.sin(np.radians(b["lat"][bj] - a["lat"][ai]) / 2), np.sin(np.radians(b["lon"][bj] - a["lon"][ai]) / 2)
            km = 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(s * s + a["c"][ai] * b["c"][bj] * t * t, 1.0)))
            one = np.where(km <= distance_km, 1 / np.maximum(km, 0.001), 0.0)
            weights = np.zeros((len(own), len(other)))
            weights[i, j] = one
            w += one.sum()
            num += np.einsum("ij,ij->j", a["v"][own], weights @ b["v"][other])
    return w, num


def _sums(tiles: DataFrame, distance_km: float, mean: float, n: int) -> DataFrame:
    """(w, num): sums over each tile's pairs; num has one for each column of values."""

    def run(table: pa.Table) -> pa.Table:
        own = table["own"].to_numpy()
        values = table["value"]
        v = (_unpacked(values) if not pa.types.is_floating(values.type) else values.to_numpy().reshape(-1, 1)) - mean
        at = {"lat": table["lat"].to_numpy(), "lon": table["lon"].to_numpy(), "k": table["after"].to_numpy(), "v": v}
        ks = table["k"].to_numpy()
        w, num = _weighed({c: x[own] for c, x in at.items()} | {"k": ks[own]}, {c: x[~own] for c, x in at.items()}, distance_km)
        return pa.table({"w": pa.array([w], pa.float64()), "num": pa.array([num.tolist()], pa.list_(pa.float64()))})

    keys = ["slab", "cell", "i", "j"]
    return tiles.repartition(max(8, min(4096, n // BLOCK)), *keys).groupBy(*keys).applyInArrow(run, "w double, num array<double>")


def _permuted(points: DataFrame, tiles: DataFrame, replicates: int, seed: int) -> DataFrame:
    """tiles with the value of each point and those that the permutations hand to it, packed.

    Each replicate's values are sorted by digest and leave the sort in blocks,
    which meet the points of the same numbers.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, held = None, 0, np.empty(0)

        def out(values: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([now], pa.int32()), _packed(values.reshape(1, -1))], names=["block", "r", "drawn"])

        for batch in batches:
            rs, values = batch.column("r").to_numpy(), batch.column("value").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(rs)) + 1).tolist(), len(rs)]
            for low, high in zip(starts, starts[1:]):
                if low == high:
                    continue
                if rs[low] != now:
                    if len(held):
                        yield out(held)
                    now, block, held = int(rs[low]), 0, np.empty(0)
                held = np.concatenate([held, values[low:high]])
                while len(held) >= BLOCK:
                    yield out(held[:BLOCK])
                    block, held = block + 1, held[BLOCK:]
        if len(held):
            yield out(held)

    kept = [f.name for f in tiles.schema if f.name != "value"]

    def put(left: pa.Table, right: pa.Table) -> pa.Table:
        at = left["k"].to_numpy() % BLOCK
        values = np.zeros((at.max(initial=-1) + 1 if not len(right) else BLOCK, replicates + 1))
        for r, drawn in zip(right["r"].to_pylist(), right["drawn"]):
            column = _unpacked(pa.array([drawn.as_py()], pa.binary()))[0]
            values[: len(column), r] = column
        values[at, 0] = left["value"].to_numpy()
        return left.select(kept).append_column("value", _packed(values[at]))

    digest = F.unhex(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "r", F.col("id").cast("string"))), 1, 16))
    copies = points.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    drawn = copies.select("r", digest.alias("h"), "k", "value").repartition("r").sortWithinPartitions("r", "h", "k").select("r", "value").mapInArrow(cut, "block long, r int, drawn binary")
    schema = ", ".join(f"{c} {tiles.schema[c].dataType.simpleString()}" for c in kept) + ", value binary"
    blocks = tiles.select(*kept, "value", F.floor(F.col("k") / BLOCK).cast("long").alias("block"))
    return blocks.groupBy("block").cogroup(drawn.groupBy("block")).applyInArrow(put, schema)


def _count_and_mean(points: DataFrame) -> tuple[int, float]:
    n, mean = points.agg(F.count(F.lit(1)), F.avg("value")).first()
    return n, mean if mean is not None else 0.0


def moran_near(points: DataFrame, distance_km: float) -> DataFrame:
    """(n, moran_i): Moran's I by inverse distance, at least 1 m, of the points up to distance_km apart.

    points: (id, latitude, longitude, value), each id once. Without any pair
    both are null; where all values are equal the index is NaN.
    """
    held = _numbered(points)
    n, mean = _count_and_mean(held)
    sums = _sums(_tiles(held, distance_km), distance_km, mean, n).agg(F.sum(F.col("num")[0]).alias("num"), F.sum("w").alias("w")).filter("w > 0")
    total = held.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("value") - mean) * (F.col("value") - mean)).alias("ss"))
    below = F.col("w") * F.col("ss")
    found = sums.crossJoin(total).select("n", F.when(below == 0, F.lit(math.nan)).otherwise(F.col("n") * F.col("num") / below).alias("moran_i"))
    return found.agg(F.max("n").alias("n"), F.max("moran_i").alias("moran_i"))  # one row, nulls where there is no pair


def moran_near_p(points: DataFrame, distance_km: float, replicates: int, seed: int) -> DataFrame:
    """(n, moran_i, p): the same with the share of seeded permutations of the values that reach it, no row without any pair.

    A permutation orders the points by the first eight bytes of a digest, then
    by id, and hands the values on in that order. All permutations share the
    weights; an index that differs by rounding only (1e-12) reaches.
    """
    held = _numbered(points)
    n, mean = _count_and_mean(held)
    sums = _sums(_permuted(held, _tiles(held, distance_km), replicates, seed), distance_km, mean, n)
    sums = sums.select("w", F.posexplode("num").alias("r", "num")).groupBy("r").agg(F.sum("num").alias("num"), F.sum("w").alias("w")).filter("w > 0")
    total = held.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("value") - mean) * (F.col("value") - mean)).alias("ss"))
    below = F.col("w") * F.col("ss")
    index = sums.crossJoin(F.broadcast(total)).select("r", "n", F.when(below == 0, F.lit(math.nan)).otherwise(F.col("n") * F.col("num") / below).alias("i"))  # one row a replicate
    real = F.max(F.when(F.col("r") == 0, F.col("i")))
    found = index.groupBy("n").agg(real.alias("moran_i"), F.collect_list(F.when(F.col("r") > 0, F.col("i"))).alias("drawn"))
    reached = F.size(F.filter("drawn", lambda i: i + 1e-12 >= F.col("moran_i")))
    return found.select("n", "moran_i", ((reached + 1) / (F.size("drawn") + 1)).alias("p"))
