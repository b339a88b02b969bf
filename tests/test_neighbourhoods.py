"""Discs, medians, sweeps, clusters and their folds against plain Python."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from canopyflow.operators import alerts, evaluate, raster


@pytest.mark.parametrize("tile", [4, 16])
def test_focal_mean_equals_every_disc(spark, tile):
    rng, offsets = random.Random(tile), raster.disc(30.0, 10.0)
    cells = {(k, r, c): None if rng.random() < 0.1 else rng.random() for k in "ab" for r in range(-9, 12) for c in range(-6, 20) if rng.random() < 0.8}
    px = spark.createDataFrame([(k, r, c, v, "x") for (k, r, c), v in cells.items()], "k string, r int, c long, v double, more string")
    got = {(x.k, x.r, x.c): x.v_mean for x in raster.focal_mean(px, "v", keys=("k",), tile=tile).collect()}
    assert got.keys() == cells.keys()
    for (k, r, c), mean in got.items():
        near = [v for i, j in offsets if (v := cells.get((k, r + i, c + j))) is not None]
        assert mean == (None if not near else pytest.approx(sum(near) / len(near)))


def test_focal_mean_has_one_shuffle(spark):
    plan = raster.focal_mean(spark.range(100).select(F.col("id").alias("r"), F.col("id").alias("c"), F.rand(1).alias("v")), "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_median_by_selection(spark):
    rng = random.Random(5)
    for values in ([3.0], [1.0, 2.0], [rng.gauss(0, 1e6) for _ in range(999)], [rng.choice([1.5, 1.5, 2.5, -7.0]) for _ in range(1000)], [5e-324 * k for k in range(50)], [-1e308, 1e308, 3.0, 4.0], [1e16 + 2 * k for k in range(40)], [None, None, 4.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        known = [v for v in values if v is not None]
        for ranges, sort in ((4, 3), (16, 1), (4096, 1000)):
            assert raster.exact_median(df, "v", ranges, sort) == statistics.median(known)
    assert raster.exact_median(df.where("v < 0"), "v") is None


def test_sweep_with_a_size_for_each_threshold(spark):
    rng, thresholds, least = random.Random(8), [0.35, 0.40, 0.45], [5, 20]
    rows = [(rng.choice([None, 0.36, 0.41, 0.45, 0.9]), [rng.choice([0, 4, 5, 19, 20, 100]) for _ in thresholds], rng.choice([0, 1, None]), rng.choice([0, 1]), rng.random()) for _ in range(400)]
    got = evaluate.sweep(spark.createDataFrame(rows, "dist double, px array<long>, greener int, loss int, w double"), thresholds, least).collect()
    assert len(got) == 12
    for x in got:
        i = thresholds.index(x.threshold)
        hit = [d is not None and d >= x.threshold and p[i] >= x.least and not (x.gate and g == 1) for d, p, g, _, _ in rows]
        assert x.tp == pytest.approx(sum(r[4] for h, r in zip(hit, rows, strict=True) if h and r[3]))
        assert x.fp == pytest.approx(sum(r[4] for h, r in zip(hit, rows, strict=True) if h and not r[3]))
        assert x.n_fp == sum(h and not r[3] for h, r in zip(hit, rows, strict=True))


def metres(a, b):
    return alerts._metres(*a, *b)


def test_nearest_over_the_whole_globe(spark):
    rng = random.Random(2)
    spots = [(180.0, 10.0), (-180.0, -66.0), (0.0, 90.0), (123.0, -90.0), (74.7, 14.9), (-179.9999, 89.99), (0.0, 0.0)]
    near = lambda lon, lat: ((lon + rng.uniform(-2e-3, 2e-3) / max(math.cos(math.radians(lat)), 1e-3) + 180) % 360 - 180, max(-90.0, min(90.0, lat + rng.uniform(-2e-3, 2e-3))))
    points, places = ([near(*s) for s in spots for _ in range(30)] for _ in range(2))
    frame = lambda rows, n: spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], f"{n} long, lon double, lat double")
    got = {r.pid: r.match_id for r in alerts.nearest_within(frame(points, "pid"), frame(places, "kid")).collect()}
    for i, p in enumerate(points):
        best = min((metres(p, q), k) for k, q in enumerate(places))
        assert got[i] == (best[1] if best[0] <= 150 else None)
    assert sum(v is not None for v in got.values()) > 60


def test_fold_by_cluster_equals_one_fold_of_an_area(spark):
    rng, day = random.Random(4), lambda: f"2026-01-0{rng.randint(1, 4)}"
    # all pairs close to 180 degrees, in chains of places within reach of one another, and far apart
    spot = lambda: (rng.choice([179.999, -179.999, 74.7]) + rng.uniform(-0.004, 0.004), rng.choice([10.0, 10.02]) + rng.uniform(-0.004, 0.004))
    rows = [(a, k, *(lambda p: ((p[0] + 180) % 360 - 180, p[1]))(spot()), rng.uniform(0.1, 2), day()) for a in ("a", "b") for k in range(150)]
    frame = lambda some: spark.createDataFrame(some, "aoi string, seq long, lon double, lat double, area_ha double, observed_on string")
    first = alerts.ingest(frame([r for r in rows if r[1] < 70]), None, "2026-01-04")
    got = alerts.ingest(frame([r for r in rows if r[1] >= 70]), first, "2026-02-01").collect()
    want = []
    for a in ("a", "b"):
        store: list[dict] = []
        for today, some in (("2026-01-04", range(70)), ("2026-02-01", range(70, 150))):
            for _, _, lon, lat, area, seen in (r for r in rows if r[0] == a and r[1] in some):
                near = min(((metres((lon, lat), (x["lon"], x["lat"])), x["alert_id"], x) for x in store if metres((lon, lat), (x["lon"], x["lat"])) <= 150), default=None, key=lambda x: x[:2])
                if near is None:
                    fresh: dict = {}
                    alerts.fold(fresh, [(lon, lat, area, seen)], today)
                    store.append(next(iter(fresh.values())))
                else:
                    x = near[2]
                    x["confirmations"] += x["last_seen"] != seen
                    x["last_seen"], x["area_ha"] = seen, max(x["area_ha"], area)
                    if x["notified_on"] is None and x["confirmations"] >= 2:
                        x["notified_on"] = today
        want += [(a, *(x[n] for n in ("alert_id", "lon", "lat", "area_ha", "first_seen", "last_seen", "confirmations", "notified_on"))) for x in store]
    assert sorted(tuple(r) for r in got) == sorted(want)
    alone = {(r.aoi, r.seq) for r in alerts.isolated(frame(rows)).collect()}
    assert alone and all(min(metres(p[2:4], q[2:4]) for q in rows if q[0] == p[0] and q[1] != p[1]) > 150 for p in rows if (p[0], p[1]) in alone)
