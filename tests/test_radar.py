"""Radar from scenes to patches, against plain Python on small areas."""

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from canopyflow.operators import detect, radar

GRID = {"pixel_m": 10.0, "dem_m": 20.0, "coarse_m": 40.0}
SCENES = "aoi string, scene int, ts timestamp, orbit_pass string, mode string, pols array<string>"


def tables(spark, n=16, cleared=None, since=6, slope=1.0, passes=10):
    """One area, flat radar of -12 dB but where it was cleared; heights rise to the east."""
    days = [datetime(2025, 1, 1) + timedelta(days=12 * k) for k in range(passes)]
    scenes = spark.createDataFrame([("a", k, t, "DESCENDING", "IW", ["VV", "VH"]) for k, t in enumerate(days)] + [("a", 90, days[0], "ASCENDING", "IW", ["VV", "VH"]), ("a", 91, days[-1], "DESCENDING", "EW", ["VV", "VH"]), ("a", 92, days[-1], "DESCENDING", "IW", ["VV"])], SCENES)
    gone = cleared or (lambda r, c: False)
    rows = [("a", k, r, c, -8.0, -20.0 if gone(r, c) and since <= k < 90 else -12.0, 35.0 + 0.01 * c) for k in [*range(passes), 90, 91, 92] for r in range(n) for c in range(n)]
    pixels = spark.createDataFrame(rows, "aoi string, scene int, r int, c int, vv double, vh double, angle double")
    dem = spark.createDataFrame([("a", r, c, slope * 20.0 * c) for r in range(n // 2) for c in range(n // 2)], "aoi string, r int, c int, dem double")
    return scenes, pixels, dem, days


def test_prepared_keeps_one_orbit_and_flattens_slopes(spark):
    scenes, pixels, dem, days = tables(spark, slope=0.1, passes=2)
    out = radar.prepared(scenes, pixels, dem, date(2025, 1, 1), date(2025, 12, 31), keys=("aoi",), **GRID).toPandas()
    assert sorted(out.scene.unique()) == [0, 1] and set(out.columns) == {"aoi", "scene", "ts", "r", "c", "vv", "vh"}
    # heights and the angle both rise to the east, so the ground falls off along the look direction by its whole slope
    a, th = math.atan(0.1), math.radians(35.08)
    want = -12 - 10 * math.log10(math.cos(th)) - 10 * math.log10(math.tan(math.pi / 2 - th + a) / math.tan(math.pi / 2 - th))
    assert out[(out.r == 8) & (out.c == 8)].vh.tolist() == pytest.approx([want] * 2, abs=0.01)
    # beside the border no gradient is known, but the disc of a corner reaches pixels that have one
    assert out[(out.r == 0) & (out.c == 0)].vh.notna().all()
    assert out.groupby(["scene", "r", "c"]).size().max() == 1


def test_layover_is_masked(spark):
    scenes, pixels, dem, _ = tables(spark, slope=2.0, passes=1)
    out = radar.prepared(scenes, pixels, dem, date(2025, 1, 1), date(2025, 12, 31), bands=("vh",), **GRID)
    assert out.count() == 256 and out.where("vh is not null").count() == 0


def test_an_area_too_small_for_a_look_direction(spark):
    scenes, pixels, dem, _ = tables(spark, passes=1)
    with pytest.raises(Exception, match="too small for a look direction"):
        radar.prepared(scenes, pixels, dem, date(2025, 1, 1), date(2025, 12, 31), bands=("vh",), pixel_m=10.0, dem_m=20.0).collect()


def test_disturbance_needs_forest_and_passes_that_stay_low(spark):
    scenes, pixels, dem, days = tables(spark, n=20, cleared=lambda r, c: 4 <= r < 14 and 4 <= c < 14, since=7, slope=0.1, passes=9)
    wood = pixels.select("aoi", "r", "c").distinct().withColumn("forest", F.col("c") < 12)
    start, end = days[5].date(), days[8].date() + timedelta(days=1)
    found = radar.disturbance(scenes, pixels, dem, wood, start, end, detect.Radar(passes=2), least=4, **GRID).toPandas()
    assert len(found) and found.c.max() == 11 and found.component.nunique() == 1
    inner = found[(found.r == 8) & (found.c == 8)].iloc[0]
    # of four passes watched two are eight decibels lower
    assert inner.n_dropped == 2 and inner.drop_db == pytest.approx(4.0) and inner.first_drop.to_pydatetime() == days[7]
    assert radar.disturbance(scenes, pixels, dem, wood, start, end, detect.Radar(passes=3), least=4, **GRID).isEmpty()
    with pytest.raises(ValueError, match="begin before"):
        radar.drops(scenes, pixels, dem, end, start)
