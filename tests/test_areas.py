"""Areas, seasons, collections, outlines, the cycle, and rasters with holes and with several areas."""

from datetime import date
from random import Random

import pytest
from pyspark.sql import functions as F

from canopyflow.functions import season, stats
from canopyflow.operators import area, components, cycle, detect, evaluate, raster
from canopyflow.sources import collections


def test_boxes_and_areas():
    b = area.Box(74.5, 14.7, 74.9, 15.1)
    assert b.centroid == pytest.approx((74.7, 14.9)) and b.coords == [74.5, 14.7, 74.9, 15.1] and 1800 < b.km2 < 2000
    assert area.Area("Yellow Hill_North", b).slug == "yellow-hill-north" and area.Area("x", b).epsg == 32643 and area.Area("x", b, 3857).epsg == 3857
    tiles = b.tiles(2)
    assert len(tiles) == 4 and tiles[1].south == pytest.approx(14.9) and tiles[2].west == pytest.approx(74.7)
    for bad in ((75, 14, 74, 15), (74, 15, 75, 14), (70, 10, 75, 15)):
        with pytest.raises(ValueError):
            area.Box(*bad)
    with pytest.raises(ValueError):
        area.Area("", b)


def test_seasons_and_codes(spark):
    s = season.Season(10, 12)
    got = spark.createDataFrame([(2024, date(2026, 12, 5))], "y int, day date").select(*(x.cast("string") for x in s.dates(F.col("y"))), s.complete_year(F.col("day"))).first()
    assert tuple(got) == ("2024-10-01", "2025-01-01", 2025)
    assert season.Season(1, 3).compared_today(date(2026, 4, 1), 2) == (2024, 2026) and season.Season(1, 3).compared_today(date(2026, 3, 31)) == (2024, 2025)
    assert season.code_of_year(2001) == 1 and season.year_of_code(25) == 2025
    for wrong in (lambda: season.Season(5, 2), lambda: season.Season(0, 2), lambda: season.code_of_year(2000), lambda: season.code_of_year(2026), lambda: season.year_of_code(0), lambda: season.Season(1, 3).compared_today(date(2026, 4, 1), 0), lambda: season.baseline(F.col("d"), 0)):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(Exception, match="no code for year"):
        spark.range(1).select(season.code_of_year(F.lit(1999))).collect()


def test_collections(spark):
    rows = [(f"{y}-05-01 00:00:00", i, 1.0 * y, 0.0, 0.0, 1.0, 1.0) for y in (2019, 2021) for i in range(3)]
    s = spark.createDataFrame(rows, "t string, p long, v double, west double, south double, east double, north double").withColumn("ts", F.to_timestamp_ntz("t"))
    assert sorted(r.year for r in collections.available_years(s).collect()) == [2019, 2021] and collections.latest_year(s) == 2021
    assert collections.annual(s, 2019, ["p"], "v", "p").count() == 3
    with pytest.raises(ValueError, match="2019 to 2021"):
        collections.annual(s, 2020, ["p"], "v", "p")
    far = area.Box(10, 10, 10.1, 10.1)
    with pytest.raises(ValueError):
        collections.latest_year(s, far)
    with pytest.raises(ValueError, match="none"):
        collections.annual(s, 2019, ["p"], "v", "p", far)


def test_gradients_beside_a_hole_are_null(spark):
    cells = [(r, c, 30.0 * c, a) for a in ("x", "y") for r in range(5) for c in range(5) if (r, c) != (2, 2)]
    got = {(x.a, x.r, x.c): x.slope for x in raster.slope_aspect(spark.createDataFrame(cells, "r int, c int, dem double, a string"), keys=("a",)).collect()}
    assert got["x", 1, 1] == pytest.approx(45) == got["y", 3, 3] and got["x", 2, 1] is None and got["x", 2, 3] is None and got["x", 1, 2] is None and got["x", 0, 1] is None


def test_components_equal_a_flood_fill(spark):
    rng = Random(3)
    cells = {(a, rng.randrange(-20, 20), rng.randrange(-20, 20)) for a in (0, 1) for _ in range(700)}
    got = {(x.a, x.r, x.c): x.component for x in components.label_components(spark.createDataFrame(list(cells), "a int, r int, c int"), tile=8, keys=("a",)).collect()}
    assert got.keys() == cells
    left = set(cells)
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            a, r, c = x = todo.pop()
            group.add(x)
            near = {(a, r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            todo += near
        assert {got[x] for x in group} == {min(r * 2**31 + c for _, r, c in group)}


def test_rings_hold_what_they_enclose(spark):
    shape = [(0, 0), (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1), (2, 2), (3, 3)]  # a square with a hole, and a pixel that touches its corner
    out = cycle.outlines(spark.createDataFrame([(r, c, 0) for r, c in shape], "r int, c int, component long")).collect()
    ring = [(p.r, p.c) for p in out[0].ring]
    area2 = sum(a[1] * b[0] - b[1] * a[0] for a, b in zip(ring, ring[1:], strict=False))
    assert len(out) == 1 and ring[0] == ring[-1] and abs(area2) == 2 * 10 and out[0].holes == 1 and out[0].sides == 20
    one = cycle.outlines(spark.createDataFrame([(5, 7, 1)], "r int, c int, component long")).first()
    assert {(p.r, p.c) for p in one.ring} == {(5, 7), (5, 8), (6, 8), (6, 7)} and len(one.ring) == 5 and one.holes == 0


def test_cycle_from_pixels_to_alerts(spark):
    # two clearings of 3 x 3 and 2 x 2 pixels far apart, and one of a single pixel
    hit = {(r, c) for r in range(3) for c in range(3)} | {(40 + r, 40 + c) for r in range(2) for c in range(2)} | {(90, 90)}
    pixels = spark.createDataFrame([(r, c, 0.9, True, 1.0) for r, c in sorted(hit)], "r int, c int, distance double, forest boolean, greenness_loss double")
    config, kept = detect.Embedding(min_ha=0.03), []
    run = lambda store, day, **how: cycle.run_cycle(pixels, store, "a", (2024, 2025), day, 74.0, 15.0, 0.0001, config, least=2, **how)
    first = run(None, "2026-01-01", save=kept.append)
    assert (first.patches, first.pending, first.notified, first.dry_run, len(kept)) == (2, 2, 0, False, 1) and first.due.count() == 0
    second = run(first.store, "2026-02-01")
    assert (second.pending, second.notified, second.dry_run, len(kept)) == (0, 2, True, 1) and second.due.count() == 2 and "(dry run)" in second.lines[1]
    assert run(second.store, "2026-03-01").due.count() == 0
    with pytest.raises(ValueError):
        cycle.run_cycle(pixels, None, "a", (2025, 2025), "2026-01-01", 74.0, 15.0, 0.0001, config)


def test_the_seeded_sample_draws_in_every_stratum():
    some = [{"alert_id": f"{i:04d}", "area_ha": a} for i, a in enumerate([0.2] * 3 + [0.7] * 60)]
    rng = Random(42)
    want = rng.sample([a["alert_id"] for a in some[:3]], 3) + rng.sample([a["alert_id"] for a in some[3:]], 5)
    assert [a["alert_id"] for a in evaluate.stratified_sample(some[::-1], 5, 42)] == want
    with pytest.raises(ValueError):
        evaluate.stratified_sample(some, 0)


def test_arguments_are_checked(spark):
    for k, n in ((5, 3), (-1, 3), (0, -1)):
        with pytest.raises(Exception, match="not a share"):
            spark.range(1).select(*stats.wilson(F.lit(k), F.lit(n))).collect()
    with pytest.raises(Exception, match="above 0"):
        spark.range(1).select(stats.size_stratum(F.lit(0.0))).collect()
