"""Nearest other points against brute force, wherever they are."""

import os

import numpy as np
import pandas as pd
import pytest

from humusgrid.operators.spatial import nearest_other
from humusgrid.plans import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(ids, lat, lon):
    p, q = np.radians(lat), np.radians(lon)
    a = np.sin((p[:, None] - p) / 2) ** 2 + np.cos(p)[:, None] * np.cos(p) * np.sin((q[:, None] - q) / 2) ** 2
    d = 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(a, 1.0)))
    d[np.equal.outer(ids, ids)] = np.inf
    return d.min(axis=1)


def compare(spark, rows):
    rows = sorted(set(rows))
    got = {(r["id"], r["latitude"], r["longitude"]): r["km"] for r in nearest_other(spark.createDataFrame(rows, "id int, latitude double, longitude double")).collect()}
    ids, lat, lon = (np.array(c) for c in zip(*rows))
    want = {r: d for r, d in zip(rows, brute(ids, lat, lon)) if np.isfinite(d)}
    assert got.keys() == want.keys()
    assert all(got[r] == pytest.approx(want[r], rel=1e-6, abs=1e-6) for r in want)


def test_nearest_other(spark):
    rng = np.random.default_rng(3)
    globe = [(i, float(np.degrees(np.arcsin(y))), float(x)) for i, (y, x) in enumerate(zip(rng.uniform(-1, 1, 150), rng.uniform(-180, 180, 150)))]
    town = [(200 + i, float(y), float(x)) for i, (y, x) in enumerate(rng.normal((59.9999, 30.0001), 0.002, (150, 2)))]
    edges = [(500, 70.0, 179.9999), (501, 70.0, -179.9999), (502, 70.0, 180.0), (503, 89.99, 10.0), (504, 89.99, -170.0), (505, -90.0, 0.0), (506, -89.9, 100.0)]
    # shared places, one id at two places beside each other
    shared = [(600, 50.0, 50.0), (601, 50.0, 50.0), (602, 51.0, 51.0), (602, 51.0, 51.00001)]
    compare(spark, globe + town + edges + shared)


def test_nearest_other_of_few_points(spark):
    compare(spark, [(1, 10.0, 10.0), (2, -10.0, -170.0)])
    compare(spark, [(1, 10.0, 10.0), (1, 20.0, 10.0)])
    odd = [(1, 10.0, 10.0), (2, float("nan"), 1.0), (3, None, 1.0), (None, 10.0, 10.0), (4, 0.0, 0.0)]
    assert nearest_other(spark.createDataFrame(odd, "id int, latitude double, longitude double")).count() == 0


def test_clark_evans_keeps_every_site(spark):
    s = pd.read_parquet(f"{DATA}/reported_site.parquet", columns=["site_id", "latitude", "longitude"])
    s = s[s.latitude.between(41, 82) & s.longitude.between(19, 180)].drop_duplicates()
    km = brute(s.site_id.to_numpy(), s.latitude.to_numpy(), s.longitude.to_numpy())
    r = catalog.QUERIES["clark_evans"](spark, DATA).first()
    assert r["n"] == len(s)
    assert r["ratio"] == pytest.approx(km.mean() / (0.5 / np.sqrt(len(s) / 17098246.0))) and r["under_1km"] == pytest.approx((km < 1).mean())


def test_nearest_neighbour_takes_all_positions(spark):
    s = pd.read_parquet(f"{DATA}/reported_site.parquet", columns=["latitude", "longitude"])
    s = s[s.latitude.between(-90, 90) & s.longitude.between(-180, 180) & ~((s.latitude == 0) & (s.longitude == 0))].drop_duplicates()
    want = dict(zip(zip(s.latitude, s.longitude), brute(np.arange(len(s)), s.latitude.to_numpy(), s.longitude.to_numpy())))
    got = {(r["y"], r["x"]): r["nearest_km"] for r in catalog.QUERIES["nearest_neighbour"](spark, DATA).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6, abs=1e-6) for k in want)
