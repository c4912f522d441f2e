"""Points near points, in named regions and in polygons, on a sphere.

Regions: the boundaries are cut into a trapezoidal decomposition. Latitudes of
boundary vertices and crossings divide the plane into slabs; inside a slab the
boundary edges do not cross, so they have one order from west to east, and a
point is located by a binary search among the edges of its slab. The gap it
falls into names the regions that cover it; for discs an exact great-circle
check follows.

The decomposition is distributed. A region belongs to the wide slab, and in it
to the cells along the parallel, that are about as large as itself; points go
to the cells that hold any region, at each size in use. Cells are worked in
tasks: the regions of a cell come first, SHAPES at a time are cut into fine
slabs, in which a gap needs one bit for each of them, and the points of the cell
pass by in batches. Cells of many regions are divided into groups, cells of many
points by salt, so no task holds more than one group.

Sites: the same slabs of constant height, cut into cells that are at least one
search distance wide. A point probes the cells that its disc touches in its own
and the next slab, which is an equi-join on the cell, split by the adaptive skew
join where a place is dense.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from humusgrid.session import cut_lineage

EARTH_KM = 6371.0
#: Boundary pieces from the lowest to the highest latitude of a region.
PIECES = 16
#: Regions that are cut into slabs together; a gap between edges has one bit for each.
SHAPES = 16
#: Regions of one group, the bound of what a task holds at once, and points of one salt.
GROUP, POINTS = 1024, 100_000
#: Finest size of wide slabs, as halvings of 180 degrees.
FINEST = 20
#: Reach in degrees of each round of the search for nearest points, from the whole globe down to some metres.
REACHES = tuple(180 / 4**k for k in range(12))
#: Points of a cell, weighted by themselves, up to which the first round may take its reach.
CROWD = 16


def usable(lat: Column, lon: Column) -> Column:
    """Coordinates that name a place: not null, not NaN, in range, not 0,0."""
    return (
        lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
        & lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0))
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = EARTH_KM) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius_km * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _haversine(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(a, 1.0)))


@dataclass
class Slabs:
    """Trapezoidal decomposition of at most SHAPES shapes."""

    cuts: np.ndarray  # latitudes, ascending
    first_edge: np.ndarray  # per slab, with the end
    west: np.ndarray  # longitude of an edge at the slab's lower cut
    slope: np.ndarray  # and its change over the slab
    cover: np.ndarray  # per gap, one more than edges in each slab: bits of the shapes that cover it

    def locate(self, lat: np.ndarray, lon: np.ndarray, closed: bool) -> tuple[np.ndarray, np.ndarray]:
        """(point numbers, shape numbers) of the shapes that cover where the points fall; closed: the topmost latitude too."""
        none = np.empty(0, np.int64)
        if len(self.cuts) < 2 or not len(lat):
            return none, none
        point = np.flatnonzero((lat >= self.cuts[0]) & ((lat <= self.cuts[-1]) if closed else (lat < self.cuts[-1])))
        slab = np.minimum(np.searchsorted(self.cuts, lat[point], side="right") - 1, len(self.cuts) - 2)
        x, height = lon[point], self.cuts[slab + 1] - self.cuts[slab]
        t = (lat[point] - self.cuts[slab]) / height
        lo, hi = self.first_edge[slab].copy(), self.first_edge[slab + 1].copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            at = np.where(open_, mid, 0)
            right = open_ & (x >= self.west[at] + self.slope[at] * t)
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        # each slab before has one gap more than edges
        cover = self.cover[lo + slab]
        some = np.flatnonzero(cover)
        bits = (cover[some, None] >> np.arange(SHAPES, dtype=np.uint32)) & 1
        row, shape = np.nonzero(bits)
        return point[some[row]], shape


def _outline(lat: float, radius_km: float) -> tuple[np.ndarray, np.ndarray]:
    """Latitudes and half widths in degrees of a polygon around the cap, never inside it."""
    r = min(radius_km / EARTH_KM, math.pi) * 1.001 + 1e-9
    phi = math.radians(lat)
    low, high = max(-math.pi / 2, phi - r), min(math.pi / 2, phi + r)
    fine = np.linspace(low, high, PIECES * 8 + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = (math.cos(r) - math.sin(phi) * np.sin(fine)) / (math.cos(phi) * np.cos(fine))
    width = np.degrees(np.arccos(np.clip(np.nan_to_num(c, nan=1.0 if r < math.pi / 2 else -1.0), -1, 1)))
    if phi + r >= math.pi / 2:
        width[-1] = 180.0
    if phi - r <= -math.pi / 2:
        width[0] = 180.0
    # each vertex takes the widest point of both pieces it ends, so every chord stays outside
    piece = np.array([width[i * 8 : i * 8 + 9].max() for i in range(PIECES)])
    vertex = np.maximum(np.concatenate((piece[:1], piece)), np.concatenate((piece, piece[-1:])))
    return np.degrees(fine[::8]), np.minimum(vertex * 1.01 + 1e-6, 180.0)


def disc_edges(lat: float, lon: float, radius_km: float) -> np.ndarray:
    """Boundary (x0, y0, x1, y1) of a disc; one over the 180th meridian is entered once more a turn aside."""
    y, w = _outline(lat, radius_km)
    out = []
    for turn in (-360.0, 0.0, 360.0):
        centre = lon + turn
        if centre + w.max() < -180 or centre - w.max() > 180:
            continue
        for sign in (-1, 1):
            x = centre + sign * w
            out.append(np.stack((x[:-1], y[:-1], x[1:], y[1:]), axis=1))
    return np.concatenate(out)


def build_slabs(shapes: list[np.ndarray], low: float = -90.0, high: float = 90.0) -> Slabs:
    """Decomposition, between two latitudes, of shapes given by their boundary edges (x0, y0, x1, y1)."""
    if len(shapes) > SHAPES:
        raise ValueError(f"at most {SHAPES} shapes")
    edges = np.concatenate([*shapes, np.zeros((0, 4))])
    who = np.repeat(np.arange(len(shapes), dtype=np.uint32), [len(s) for s in shapes])
    down = edges[:, 1] > edges[:, 3]
    edges[down] = edges[down][:, [2, 3, 0, 1]]
    kept = (edges[:, 3] > edges[:, 1]) & (edges[:, 3] > low) & (edges[:, 1] < high)
    order = np.argsort(edges[kept, 1], kind="stable")
    (x0, y0, x1, y1), who = edges[kept][order].T, who[kept][order]
    slope = (x1 - x0) / (y1 - y0)
    if not len(x0):
        return Slabs(np.zeros(0), np.zeros(1, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, np.uint32))

    def slabs_of(cuts: np.ndarray) -> Iterator[tuple[float, float, np.ndarray]]:
        """Slab after slab with the edges through it."""
        here, entered = np.empty(0, np.int64), 0
        for bottom, top in zip(cuts[:-1], cuts[1:]):
            upto = int(np.searchsorted(y0, bottom, side="right"))
            here = np.concatenate((here[y1[here] > bottom], np.arange(entered, upto)[y1[entered:upto] > bottom]))
            entered = upto
            yield bottom, top, here

    cuts = np.unique(np.clip(np.concatenate((y0, y1)), low, high))
    more = []
    for bottom, top, e in slabs_of(cuts):
        a, b = x0[e] + slope[e] * (bottom - y0[e]), x0[e] + slope[e] * (top - y0[e])
        rank = np.argsort(a, kind="stable")
        if len(e) > 1 and (np.diff(b[rank]) < 0).any():
            i, j = np.nonzero((a[:, None] < a[None, :]) & (b[:, None] > b[None, :]))
            more.append(bottom + (a[j] - a[i]) / ((b[i] - a[i]) - (b[j] - a[j])) * (top - bottom))
    if more:
        cuts = np.unique(np.concatenate((cuts, *more)))
    first_edge, west, run, cover = [0], [], [], []
    for bottom, top, e in slabs_of(cuts):
        e = e[np.argsort(x0[e] + slope[e] * ((bottom + top) / 2 - y0[e]), kind="stable")]
        west.append(x0[e] + slope[e] * (bottom - y0[e]))
        run.append(slope[e] * (top - bottom))
        first_edge.append(first_edge[-1] + len(e))
        # behind each edge its shape is entered or left
        cover.append(np.concatenate((np.zeros(1, np.uint32), np.bitwise_xor.accumulate(np.uint32(1) << who[e]))).astype(np.uint32))
    cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
    return Slabs(cuts, np.array(first_edge), cat(west), cat(run), cat(cover).astype(np.uint32))


_CELL = ("level", "slab", "cell")


def _height(level: Column) -> Column:
    return F.lit(180.0) / F.pow(F.lit(2.0), level)


def _in_cells(shapes: DataFrame) -> DataFrame:
    """Shapes with the cells they touch: each in the finest wide slabs that are at least as high as itself."""
    size = F.greatest(F.col("y1") - F.col("y0"), F.lit(1e-9))
    level = F.least(F.lit(FINEST), F.greatest(F.lit(0), F.floor(F.log2(F.lit(180.0) / size)))).cast("int")
    rows = shapes.withColumn("level", level).withColumn("height", _height(F.col("level")))
    slab = lambda y: F.floor((y + 90) / F.col("height"))
    last = F.floor(F.lit(180.0) / F.col("height")) - 1
    rows = rows.withColumn("slab", F.explode(F.sequence(F.least(slab(F.col("y0")), last), F.least(slab(F.col("y1")), last))))
    rows = rows.withColumn("n", _cells_around(F.col("slab"), F.col("height")))
    around = F.sequence(_cell_at(F.col("x0"), F.col("n")), _cell_at(F.col("x1"), F.col("n")))
    touched = F.when(F.col("x1") - F.col("x0") >= 360, F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).otherwise(F.array_distinct(F.transform(around, lambda i: F.pmod(i, F.col("n")))))
    return rows.withColumn("cell", F.explode(touched)).drop("height", "n", "x0", "x1", "y0", "y1")


def _located(points: DataFrame, shapes: DataFrame, edges_of: Callable, checked: Callable | None, group: int) -> DataFrame:
    """(id, name[, distance_km]) of the points that fall into shapes.

    points: (id, lat, lon); shapes: (name, body, x0, x1, y0, y1), body an array
    of numbers from which edges_of makes the boundary and by which checked
    gives, for points and shapes found, (the ones that hold, their distance).
    """
    shapes = cut_lineage(_in_cells(shapes.withColumn("number", F.monotonically_increasing_id())), "cells")
    held = shapes.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("n"))
    levels = sorted(r[0] for r in shapes.select("level").distinct().collect())  # at most FINEST + 1
    placed = points.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]) if levels else F.array().cast("array<int>"))).withColumn("height", _height(F.col("level")))
    slab = F.least(F.floor((F.col("lat") + 90) / F.col("height")), F.floor(F.lit(180.0) / F.col("height")) - 1)
    placed = placed.withColumn("slab", slab).withColumn("m", _cells_around(F.col("slab"), F.col("height")))
    placed = placed.withColumn("cell", F.pmod(_cell_at(F.col("lon"), F.col("m")), F.col("m"))).select(*_CELL, "id", "lat", "lon")
    crowd = placed.join(held, list(_CELL), "left_semi").groupBy(*_CELL).agg(F.count(F.lit(1)).alias("m"))
    plan = held.join(crowd, list(_CELL)).select(*_CELL, F.ceil(F.col("n") / group).alias("groups"), F.ceil(F.col("m") / POINTS).alias("salts"))
    plan = cut_lineage(plan, "plan")
    id_kind, name_kind = points.schema["id"].dataType.simpleString(), shapes.schema["name"].dataType.simpleString()
    bodies = shapes.join(plan, list(_CELL)).select(
        *_CELL, F.pmod(F.xxhash64("number"), F.col("groups")).alias("group"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"),
        F.lit(None).cast(id_kind).alias("id"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), "name", "body", "number",
    )
    asked = placed.join(plan, list(_CELL)).select(
        *_CELL, F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"), F.pmod(F.xxhash64("lat", "lon", "id"), F.col("salts")).alias("salt"), F.lit(1).alias("kind"),
        "id", "lat", "lon", F.lit(None).cast(name_kind).alias("name"), F.lit(None).cast("array<double>").alias("body"), F.lit(None).cast("bigint").alias("number"),
    )
    key = [*_CELL, "group", "salt"]
    routed = bodies.unionByName(asked).repartition(*key).sortWithinPartitions(*key, "kind", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        names: list = []
        bodies: list[np.ndarray] = []
        built: list[Slabs] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)], axis=1)
            edge = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            lat, lon = (batch.column(i).to_numpy(zero_copy_only=False) for i in (7, 8))
            rows, told, far = [], [], []
            for start, end in zip([0, *edge], [*edge, batch.num_rows]):
                if (at := tuple(keys[start, :5])) != now:
                    now, names, bodies, built = at, [], [], []
                if keys[start, 5] == 0:
                    part = batch.slice(start, end - start)
                    names += part.column(9).to_pylist()
                    bodies += [np.array(b) for b in part.column(10).to_pylist()]
                    continue
                if not built:
                    height = 180.0 / 2.0 ** float(at[0])
                    low = at[1] * height - 90
                    built = [build_slabs([edges_of(b) for b in bodies[k : k + SHAPES]], low - 1e-9, low + height + 1e-9) for k in range(0, len(bodies), SHAPES)]
                y, x = lat[start:end], lon[start:end]
                for k, slabs in enumerate(built):
                    p, r = slabs.locate(y, x, checked is not None)
                    if not len(p):
                        continue
                    if checked is not None:
                        keep, d = checked(y[p], x[p], np.array(bodies[k * SHAPES : (k + 1) * SHAPES])[r])
                        p, r = p[keep], r[keep]
                        far.append(d)
                    rows.append(start + p)
                    told += [names[k * SHAPES + i] for i in r]
            if rows:
                out = [batch.column(6).take(pa.array(np.concatenate(rows))), pa.array(told, batch.column(9).type)]
                fields = ["id", "name"]
                if checked is not None:
                    out.append(pa.array(np.concatenate(far)))
                    fields.append("distance_km")
                yield pa.RecordBatch.from_arrays(out, names=fields)

    schema = f"id {id_kind}, name {name_kind}" + (", distance_km double" if checked is not None else "")
    return routed.mapInArrow(run, schema)


def points_in_regions(points: DataFrame, regions: DataFrame, group: int = GROUP) -> DataFrame:
    """Named regions around each point.

    points: (id, latitude, longitude); regions: (name, latitude, longitude,
    radius_km). Returns (id, name, distance_km), one row per point row, region
    name and region row that holds.

    Defined results: points without usable coordinates, regions with a null
    name, unusable centre or a null, NaN or non-positive radius give no row;
    distance equal to the radius is inside; repeated region rows count once;
    empty tables give no rows; only the named columns are read.
    """
    known = (
        regions.select("name", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"), F.col("radius_km").cast("double").alias("km"))
        .filter(F.col("name").isNotNull() & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & (F.col("km") > 0) & ~F.isnan("km"))
        .distinct()
    )
    reach = F.least(F.degrees(F.col("km") / EARTH_KM), F.lit(180.0)) * 1.0001 + 1e-9
    rows = known.withColumn("reach", reach)
    # the greatest half width of a disc, all around where it holds a pole
    polar = F.abs("lat") + F.col("reach") >= 90
    half = F.when(polar, 180.0).otherwise(F.degrees(F.asin(F.least(F.sin(F.radians("reach")) / F.cos(F.radians("lat")), F.lit(1.0)))) * 1.0001 + 1e-9)
    shapes = rows.withColumn("half", half).select(
        "name", F.array("lat", "lon", "km").alias("body"), (F.col("lon") - F.col("half")).alias("x0"), (F.col("lon") + F.col("half")).alias("x1"),
        F.greatest(F.lit(-90.0), F.col("lat") - F.col("reach")).alias("y0"), F.least(F.lit(90.0), F.col("lat") + F.col("reach")).alias("y1"),
    )
    placed = points.select("id", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon")).filter(usable(F.col("lat"), F.col("lon")))

    def checked(lat: np.ndarray, lon: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = _haversine(lat, lon, body[:, 0], body[:, 1])
        keep = far <= body[:, 2]
        return keep, far[keep]

    return _located(placed, shapes, lambda b: disc_edges(*b.tolist()), checked, group)


def points_in_polygons(points: DataFrame, polygons: DataFrame, group: int = GROUP) -> DataFrame:
    """(id, name) of the polygons around each point, each once.

    points: (id, latitude, longitude); polygons: (name, rings), rings as in
    GeoJSON: the outer ring and its holes, each a list of (longitude, latitude);
    several rows of a name are its parts. A point on an edge to the east is
    outside, on one to the west inside; a point in a hole is outside.

    Defined results: points without usable coordinates and polygons with a null
    name or no ring of three corners give no row; rings need not be closed;
    empty tables give no rows.
    """

    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, rings in zip(batch["name"], batch["rings"]):
                edges = []
                for ring in rings if rings is not None else ():
                    at = np.array([[float(v) for v in p[:2]] for p in ring if p is not None and len(p) > 1 and p[0] is not None and p[1] is not None])
                    if len(at) > 2:
                        edges.append(np.hstack((at, np.roll(at, -1, axis=0))))
                if edges:
                    e = np.concatenate(edges)
                    out.append((name, e.ravel(), e[:, 0].min(), e[:, 0].max(), e[:, 1].min(), e[:, 1].max()))
            yield pd.DataFrame(out, columns=["name", "body", "x0", "x1", "y0", "y1"])

    kind = polygons.schema["name"].dataType.simpleString()
    shapes = polygons.select("name", "rings").filter("name is not null").mapInPandas(flat, f"name {kind}, body array<double>, x0 double, x1 double, y0 double, y1 double")
    placed = points.select("id", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon")).filter(usable(F.col("lat"), F.col("lon")))
    return _located(placed, shapes, lambda b: b.reshape(-1, 4), None, group).distinct()


def _near(points: DataFrame, distance_km: float) -> DataFrame:
    """(id_a, id_b, km) of rows of different ids at most distance_km apart, as often as rows meet."""
    reach = math.degrees(distance_km / EARTH_KM) * 1.0001 + 1e-9  # height of a slab in degrees
    rows = (
        points.select("id", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
        .filter(usable(F.col("lat"), F.col("lon")) & F.col("id").isNotNull())
        .distinct()
    )
    slab = F.floor((F.col("lat") + 90) / reach)

    home = rows.withColumn("slab", slab).withColumn("n", _cells_around(F.col("slab"), reach))
    home = home.withColumn("cell", F.pmod(_cell_at(F.col("lon"), F.col("n")), F.col("n"))).select("id", "lat", "lon", "slab", "cell")
    # the disc's greatest half width in degrees of longitude
    c = F.cos(F.radians(F.least(F.abs(F.col("lat")) + reach, F.lit(90.0))))
    half = F.when(c * 180 > reach * 1.001, reach * 1.001 / c).otherwise(F.lit(180.0))
    probes = rows.withColumn("own", slab).withColumn("half", F.least(half, F.lit(180.0)))
    probes = probes.withColumn("slab", F.explode(F.array("own", F.col("own") + 1))).withColumn("n", _cells_around(F.col("slab"), reach))
    start = F.when(F.col("half") >= 180, F.lit(-180.0)).otherwise(F.when(F.col("slab") == F.col("own"), F.col("lon")).otherwise(F.col("lon") - F.col("half")))
    end = F.when(F.col("half") >= 180, F.lit(180.0)).otherwise(F.col("lon") + F.col("half"))
    touched = F.array_distinct(F.transform(F.sequence(_cell_at(start, F.col("n")), _cell_at(end, F.col("n"))), lambda i: F.pmod(i, F.col("n"))))
    probes = probes.withColumn("cell", F.explode(touched)).select(F.col("id").alias("id2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "slab", "cell")
    near = home.join(probes, ["slab", "cell"]).filter(F.col("id") != F.col("id2")).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).filter(F.col("km") <= distance_km)
    return near.select(F.least("id", "id2").alias("id_a"), F.greatest("id", "id2").alias("id_b"), "km")


def points_near_points(points: DataFrame, distance_km: float = 1.0) -> DataFrame:
    """Pairs of different ids at most distance_km apart.

    points: (id, latitude, longitude). Returns (id_a, id_b) with id_a < id_b,
    each pair once, whatever the number of rows of an id. Points without usable
    coordinates or with a null id make no pair; copies of one point make every
    pair between different ids; an empty table gives no rows.
    """
    return _near(points, distance_km).select("id_a", "id_b").distinct()


def near_distances(points: DataFrame, distance_km: float) -> DataFrame:
    """The same pairs with km, the smallest distance between any rows of the two ids."""
    return _near(points, distance_km).groupBy("id_a", "id_b").agg(F.min("km").alias("km"))


def _cells_around(slab: Column, reach: Column | float) -> Column:
    """Cells around the globe in a slab, each at least one reach wide at its narrowest latitude."""
    far = F.greatest(F.abs(slab * reach - 90), F.abs((slab + 1) * reach - 90))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(F.least(far, F.lit(90.0)))) * 360 / reach)).cast("long")


def _cell_at(lon: Column, n: Column) -> Column:
    return F.floor((lon + 180) / 360 * n).cast("long")


def _slab_at(lat: Column, reach: float) -> Column:
    return F.floor((lat + 90) / reach).cast("long")


def _nearest_within(asked: DataFrame, places: DataFrame, reach: float) -> DataFrame:
    """asked with km, the smallest distance found; every place at most `reach` degrees away is looked at."""
    wide = reach * 1.0001 + 1e-9
    home = places.withColumn("slab", _slab_at(F.col("lat"), wide))
    home = home.withColumn("n", _cells_around(F.col("slab"), wide)).withColumn("cell", F.pmod(_cell_at(F.col("lon"), F.col("n")), F.col("n")))
    home = home.select("slab", "cell", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    # the greatest half width of the disc, all around where it holds a pole
    half = F.when(F.abs("lat") + wide < 90, F.degrees(F.asin(F.least(F.sin(F.lit(math.radians(min(wide, 90.0)))) / F.cos(F.radians("lat")), F.lit(1.0)))) * 1.0001 + 1e-9).otherwise(180.0)
    own = _slab_at(F.col("lat"), wide)
    probes = asked.withColumn("half", F.least(half, F.lit(180.0))).withColumn("slab", F.explode(F.array(own - 1, own, own + 1))).withColumn("n", _cells_around(F.col("slab"), wide))
    start = F.when(F.col("half") >= 180, F.lit(-180.0)).otherwise(F.col("lon") - F.col("half"))
    end = F.when(F.col("half") >= 180, F.lit(180.0)).otherwise(F.col("lon") + F.col("half"))
    touched = F.array_distinct(F.transform(F.sequence(_cell_at(start, F.col("n")), _cell_at(end, F.col("n"))), lambda i: F.pmod(i, F.col("n"))))
    probes = probes.withColumn("cell", F.explode(touched)).select("lat", "lon", "low", "high", "slab", "cell")
    # a place that holds nothing but the same id is no other
    other = ((F.col("lat") != F.col("lat2")) | (F.col("lon") != F.col("lon2"))) & ((F.col("low2") != F.col("low")) | (F.col("high2") != F.col("low")))
    near = probes.join(home, ["slab", "cell"]).filter(other)
    near = near.groupBy("lat", "lon").agg(F.min(haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).alias("km"))
    return asked.join(near, ["lat", "lon"], "left")


def _first_reach(places: DataFrame) -> int:
    """Number of the greatest reach whose cells hold few places."""
    at = [F.struct(F.lit(k).alias("k"), _slab_at(F.col("lat"), r).alias("slab"), F.pmod(_cell_at(F.col("lon"), n), n).alias("cell")) for k, r in enumerate(REACHES) for n in (_cells_around(_slab_at(F.col("lat"), r), r),)]
    crowd = places.select(F.explode(F.array(*at)).alias("c")).groupBy("c.k", "c.slab", "c.cell").count()
    crowd = crowd.groupBy("k").agg((F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("m")).filter(F.col("m") <= CROWD)
    return crowd.agg(F.min("k")).first()[0] if not crowd.isEmpty() else len(REACHES) - 1


def nearest_other(points: DataFrame) -> DataFrame:
    """Distance from each point to the nearest point of another id, wherever it is.

    points: (id, latitude, longitude). Returns (id, latitude, longitude, km),
    each distinct point once. Points are reduced to their distinct places. A
    place searches the cells that a disc of some reach touches; what is found
    within the reach is proven smallest, and the other places search again with
    four times the reach, up to the whole globe.

    Defined results: points without usable coordinates or with a null id give
    no row; places shared by several ids are 0 km apart; where there is no other
    id at all, there is no row.
    """
    rows = points.select("id", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    rows = rows.filter(usable(F.col("lat"), F.col("lon")) & F.col("id").isNotNull()).distinct()
    places = cut_lineage(rows.groupBy("lat", "lon").agg(F.min("id").alias("low"), F.max("id").alias("high")), "places")
    out = places.filter("low <> high").select("lat", "lon", F.lit(0.0).alias("km"))
    open_ = places.filter("low = high")
    k = _first_reach(places)
    while not open_.isEmpty():
        tried = cut_lineage(_nearest_within(open_, places, REACHES[k]), "nearest")
        proven = F.col("km") <= (math.inf if k == 0 else math.radians(REACHES[k]) * EARTH_KM)
        out = out.unionByName(tried.filter(proven).select("lat", "lon", "km"))
        if k == 0:
            break
        open_ = tried.filter(~F.coalesce(proven, F.lit(False))).select("lat", "lon", "low", "high")
        k -= 1
    return rows.join(out, ["lat", "lon"]).select("id", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "km")
