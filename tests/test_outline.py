"""Rings across tiles against rings traced one side at a time."""

import json
import random

import pytest
from pyspark.sql import functions as F

from canopyflow.operators import cycle, detect, outline


def traced(cells):
    """{component: sorted [(corners, area)]} of cells {(r, c): component}."""
    sides = set()
    for (r, c), k in cells.items():
        for d, (sr, sc, nr, nc) in enumerate(((0, 0, -1, 0), (0, 1, 0, 1), (1, 1, 1, 0), (1, 0, 0, -1))):
            if cells.get((r + nr, c + nc)) != k:
                sides.add((k, r + sr, c + sc, d))
    out = {}
    while sides:
        at = first = min(sides)
        ring, area = [], 0
        while True:
            sides.discard(at)
            k, r, c, d = at
            ring.append((r, c, d))
            dr, dc = outline.STEP[d]
            area += c * (r + dr) - (c + dc) * r
            leave = [x for x in ((k, r + dr, c + dc, (d + t) % 4) for t in (3, 0, 1)) if x in sides or x == first]
            if not leave or leave[0] == first:
                break
            at = leave[0]
        corners = [(r, c) for i, (r, c, d) in enumerate(ring) if d != ring[i - 1][2]]
        out.setdefault(first[0], []).append((corners + corners[:1], area / 2))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("tile", [3, 8, 64])
def test_rings_equal_traced_ones(spark, tile):
    rng = random.Random(tile)
    cells = {(r, c): 0 for r in range(-7, 15) for c in range(-5, 18) if rng.random() < 0.6}
    # one component as it were, and another that surrounds and touches it
    cells |= {(r, c): 1 for r in range(-12, 20) for c in range(-12, 24) if not (-9 < r < 17 and -9 < c < 21) and rng.random() < 0.95}
    px = spark.createDataFrame([(r, c, k, "a") for (r, c), k in cells.items()], "r int, c int, component long, aoi string")
    got = {}
    for x in outline.rings(px, ("aoi",), tile).collect():
        got.setdefault(x.component, []).append(([(p.r, p.c) for p in x.points], x.area))
    assert {k: sorted(v) for k, v in got.items()} == traced(cells)
    assert sum(a for v in got.values() for _, a in v) == len(cells)


def test_one_long_border_over_many_tiles(spark):
    cells = {(r, c): 7 for r in range(40) for c in range(40) if r % 4 == 0 or (c == (39 if r % 8 < 4 else 0))}
    got = outline.outlines(spark.createDataFrame([(r, c, k) for (r, c), k in cells.items()], "r int, c int, component long"), tile=4).first()
    assert got.holes == 0 and [(p.r, p.c) for p in got.ring] == traced(cells)[7][0][0]
    assert outline.rings(spark.createDataFrame([], "r int, c int, component long")).count() == 0


def test_holes_are_inner_rings_of_records(spark):
    rows = [(r, c, 9.0, True, 1.0) for r in range(7) for c in range(9) if (r, c) not in {(2, 2), (4, 5), (4, 6)}]
    px = spark.createDataFrame(rows, "r int, c int, distance double, forest boolean, greenness_loss double")
    got = cycle.patch_records(px, 74.0, 15.0, 0.0001, detect.Embedding(min_ha=0.1)).first()
    rings = json.loads(got.record)["geometry"]["coordinates"]
    area = [sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(k, k[1:], strict=False)) / 2 / 1e-8 for k in rings]
    assert [len(k) for k in rings] == [5, 5, 5] and all(k[0] == k[-1] for k in rings)
    # rows go south, so the outer ring is clockwise and holes are not; together they hold the pixels
    assert round(abs(area[0])) == 63 and sorted(round(abs(a)) for a in area[1:]) == [1, 2] and area[0] * area[1] < 0
    assert got.n_px == 60 and round(abs(sum(area))) == 60


def test_text(spark):
    row = spark.createDataFrame([(0, 0, 1)], "r int, c int, component long")
    assert outline.outlines(row).select(outline.text(F.col("ring")).alias("t")).first().t == "0 0, 0 1, 1 1, 1 0, 0 0"
