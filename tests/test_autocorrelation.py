"""Moran's I without a table of pairs, against brute force."""

import gc
import hashlib
import math

import numpy as np
import pytest

from humusgrid.operators import autocorrelation
from humusgrid.operators.autocorrelation import moran_near, moran_near_p
from humusgrid.plans import catalog

SCHEMA = "id string, latitude double, longitude double, value double"
SITES = "site_id string, latitude double, longitude double, publication_year int"


def brute(rows, reach, replicates=0, seed=0):
    rows = sorted(rows)
    lat, lon, v = (np.array([r[i] for r in rows], float) for i in (1, 2, 3))
    s, t = np.sin(np.radians(lat[:, None] - lat) / 2), np.sin(np.radians(lon[:, None] - lon) / 2)
    c = np.cos(np.radians(lat))
    km = 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(s * s + c[:, None] * c * t * t, 1)))
    w = np.triu(np.where(km <= reach, 1 / np.maximum(km, 0.001), 0), 1)
    index = lambda d: len(d) * (w * np.outer(d, d)).sum() / (w.sum() * (d * d).sum())
    drawn = []
    for r in range(1, replicates + 1):
        order = sorted(range(len(rows)), key=lambda i: (hashlib.md5(f"{seed}:{r}:{rows[i][0]}".encode()).hexdigest(), rows[i][0]))
        drawn.append(index(v[order] - v.mean()))
    real = index(v - v.mean())
    return real, (sum(i >= real for i in drawn) + 1) / (replicates + 1)


def shuffled(spark, df):
    """Bytes of the files that df's run leaves to its shuffles."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles().toList()
        return {found.apply(i).getPath(): found.apply(i).length() for i in range(found.size())}

    gc.disable()
    before = set(files())
    df.collect()
    after = files()
    gc.enable()
    return sum(n for path, n in after.items() if path not in before)


@pytest.mark.parametrize("chunk", [autocorrelation.CHUNK, 7])
@pytest.mark.parametrize("reach", [0.5, 500.0, 4000.0, 30000.0])
def test_against_brute_force(spark, monkeypatch, reach, chunk):
    if chunk == 7 and reach == 0.5:
        pytest.skip("its tiles are small anyway")
    monkeypatch.setattr(autocorrelation, "CHUNK", chunk)
    monkeypatch.setattr(autocorrelation, "BLOCK", 32)
    monkeypatch.setattr(autocorrelation, "ROWS", 5)
    monkeypatch.setattr(autocorrelation, "COLUMNS", 11)
    rng = np.random.default_rng(int(reach))
    globe = [(np.degrees(np.arcsin(y)), x) for y, x in zip(rng.uniform(-1, 1, 90), rng.uniform(-180, 180, 90))]
    edges = [(10.0, 180.0), (10.001, -180.0), (10.0, 179.999), (90.0, 5.0), (89.999, -170.0), (-90.0, 0.0), (-89.9, 77.0), (10.0, 180.0)]
    rows = [(f"p{i}", float(a), float(b), float(i % 7 + a / 9)) for i, (a, b) in enumerate([*globe, *edges])]
    points = spark.createDataFrame(rows, SCHEMA)
    real, p = brute(rows, reach, 19, 5)
    assert moran_near(points, reach).first()["moran_i"] == pytest.approx(real, rel=1e-9)
    got = moran_near_p(points, reach, 19, 5).first()
    assert got["n"] == len(rows) and got["moran_i"] == pytest.approx(real, rel=1e-9) and got["p"] == pytest.approx(p)


def test_without_pairs_or_spread(spark):
    far = spark.createDataFrame([("a", 50.0, 20.0, 1.0), ("b", 60.0, 90.0, 2.0)], SCHEMA)
    for points in (far, far.limit(1), far.limit(0)):
        assert tuple(moran_near(points, 500.0).first()) == (None, None) and moran_near_p(points, 500.0, 9, 1).count() == 0
    same = moran_near(spark.createDataFrame([("a", 50.0, 20.0, 1.0), ("b", 50.0, 20.1, 1.0)], SCHEMA), 500.0).first()
    assert same["n"] == 2 and math.isnan(same["moran_i"])


def sites(spark, tmp_path, n):
    rng = np.random.default_rng(3)
    rows = [(f"s{i:05}", float(a), float(b), int(y)) for i, (a, b, y) in enumerate(zip(rng.uniform(60, 62, n), rng.uniform(60, 63, n), rng.integers(1960, 2020, n)))]
    spark.createDataFrame(rows, SITES).coalesce(1).write.parquet(f"{tmp_path}/reported_site.parquet")
    return [(*r[:3], float(r[3])) for r in rows]


def test_moran_shuffles_no_pairs(spark, tmp_path):
    rows = sites(spark, tmp_path, 2000)  # two million pairs
    df = catalog.QUERIES["moran"](spark, str(tmp_path))
    assert shuffled(spark, df) < 2_000_000
    assert df.first()["moran_i"] == pytest.approx(brute(rows, 500.0)[0], rel=1e-9)


def test_moran_permutations_shuffles_no_pairs(spark, tmp_path):
    rows = sites(spark, tmp_path, 300)  # 45 thousand pairs, 4.4 million with their replicates
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES["moran_permutations"](spark, str(tmp_path))
        assert shuffled(spark, df) < 4_000_000
        assert df.first()["p"] == pytest.approx(brute(rows, 500.0, 99, 20260803)[1])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
