"""Exports that are whole or absent, and rows that are set aside."""

import os

import pytest
from pyspark.sql import functions as F

from canopyflow.operators import alerts
from canopyflow.sources import exports


def pixels(spark):
    rows = [("a", r, c, None if (r, c) == (1, 1) else float(r * 10 + c)) for r in range(5) for c in range(4)] + [("b", 0, 0, 7.0)]
    return spark.createDataFrame(rows, "aoi string, r int, c int, v double")


def test_export_and_its_overviews(spark, tmp_path):
    path = f"{tmp_path}/out"
    got = exports.export(pixels(spark), path, ["v"], 2, ("aoi",))
    assert got.written and got.rows == {0: 21, 1: 7, 2: 3}
    one = {(x.aoi, x.r, x.c): x.v for x in exports.read(spark, path, 1).collect()}
    assert one["a", 0, 0] == pytest.approx((0 + 1 + 10) / 3) and one["a", 2, 1] == pytest.approx(42.5) and one["b", 0, 0] == 7.0
    two = {(x.aoi, x.r, x.c): x.v for x in exports.read(spark, path, 2).collect()}
    # the mean of all pixels below, not of means
    assert two["a", 0, 0] == pytest.approx(sum(r * 10 + c for r in range(4) for c in range(4) if (r, c) != (1, 1)) / 15)
    assert {n for n in os.listdir(path) if not n.startswith(".")} == {"level=0", "level=1", "level=2", exports.MANIFEST}
    again = exports.export(pixels(spark).limit(1), path, ["v"], 2, ("aoi",))
    assert not again.written and again.rows == got.rows and again.files == got.files
    assert exports.export(pixels(spark).limit(1), path, ["v"], 0, ("aoi",), again=True).rows == {0: 1}


def test_a_write_that_breaks_off_leaves_nothing_and_can_be_run_again(spark, tmp_path):
    path = f"{tmp_path}/out"
    broken = pixels(spark).withColumn("v", F.when(F.col("r") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        exports.export(broken, path, ["v"], 1, ("aoi",))
    assert os.listdir(tmp_path) == [] and not exports.exists(spark, path)
    with pytest.raises(TimeoutError):
        exports.wait_for(spark, path, 0.05, 0.02)
    # killed after the move, before the manifest
    exports.export(pixels(spark), path, ["v"], 0, ("aoi",))
    os.remove(f"{path}/{exports.MANIFEST}")
    assert not exports.exists(spark, path)
    with pytest.raises(FileNotFoundError):
        exports.read(spark, path)
    assert exports.export(pixels(spark), path, ["v"], 0, ("aoi",)).written
    assert exports.wait_for(spark, path, 1, 0.1)["rows"] == {"0": 21}


def test_unfit_detections_are_set_aside(spark):
    rows = [("a", 0, 74.7, 14.9, 1.0, "2026-01-01"), ("a", 1, 74.7, 14.9, 0.0, "2026-01-01"), ("a", 2, None, 14.9, 1.0, "2026-01-01"), ("a", 3, 181.0, 14.9, 1.0, "2026-01-01"), ("a", 4, 74.7, 14.9, 1.0, "soon"), ("a", 5, 74.7, 14.9, float("nan"), "2026-01-01")]
    fit, unfit = alerts.checked(spark.createDataFrame(rows, "aoi string, seq long, lon double, lat double, area_ha double, observed_on string"))
    assert alerts.ingest(fit, None, "2026-01-01").count() == 1
    assert {r.seq: r.reason for r in unfit.collect()} == {1: "no area", 2: "no place", 3: "off the globe", 4: "no day", 5: "no area"}
