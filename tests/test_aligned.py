"""Aligned rasters, medians by area, unfit detections, settings."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from canopyflow.functions import geo, stats
from canopyflow.operators import alerts, cycle, detect, raster, report, scenes
from canopyflow.settings import Settings
from canopyflow.sources import aligned, collections


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_aligned_tables_join_where_they_lie(spark, no_broadcast):
    grid = spark.range(400).select(F.lit("a").alias("aoi"), F.floor(F.col("id") / 20).alias("r"), (F.col("id") % 20).cast("int").alias("c"), F.col("id").alias("v"))
    one = aligned.save(grid, "aligned_one", ("aoi",), buckets=4, mode="overwrite")
    two = aligned.save(grid.where("v % 3 > 0").withColumn("w", F.col("v") * 2).drop("v"), "aligned_two", ("aoi",), buckets=4, mode="overwrite")
    try:
        both = aligned.overlay(one, two, ("aoi",))
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        assert both.count() == 266 and both.where("w <> 2 * v").isEmpty()
        masks = aligned.mask_overlap(one.select("aoi", "r", "c", (F.col("v") % 2 == 0).alias("set")), two.select("aoi", "r", "c", F.lit(True).alias("set")), ("aoi",))
        assert "Exchange" not in masks._jdf.queryExecution().executedPlan().toString()
        assert sorted(masks.groupBy("predicted", "truth").count().toPandas().itertuples(index=False, name=None)) == [(False, False, 67), (False, True, 133), (True, False, 67), (True, True, 133)]
    finally:
        spark.sql("drop table aligned_one")
        spark.sql("drop table aligned_two")


def test_masked_pixels_are_not_set(spark):
    m = lambda rows: spark.createDataFrame(rows, "r int, c int, set boolean")
    got = aligned.mask_overlap(m([(0, 0, True), (0, 1, None)]), m([(0, 0, None), (5, 5, True)])).collect()
    assert sorted(map(tuple, got)) == [(0, 0, True, False), (0, 1, False, False), (5, 5, False, True)]
    assert aligned.mask_overlap(m([]), m([])).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_medians_by_area(spark, seed):
    rng = random.Random(seed)
    rows = [("hot", rng.choice([rng.gauss(0, 1), 0.25, 1e6])) for _ in range(900)] + [("even", float(i)) for i in range(10)] + [("same", 3.0)] * 50 + [("one", -7.5), ("none", None), ("even", None)]
    got = {r.aoi: r.median for r in raster.exact_medians(spark.createDataFrame(rows, "aoi string, v double"), "v", ("aoi",), ranges=8, sort=5).collect()}
    assert got == {a: statistics.median(v for b, v in rows if b == a and v is not None) for a in ("hot", "even", "same", "one")}


def test_each_area_has_its_own_landscape(spark):
    rows = [(a, r, c, 0.8, 0.8 - gone - (0.3 if r < 2 and c < 2 else 0.0), 5, 5, True) for a, gone in (("dry", 0.4), ("wet", 0.0)) for r in range(6) for c in range(6)]
    pixels = spark.createDataFrame(rows, "aoi string, r int, c int, before double, after double, n_before int, n_after int, forest boolean")
    found = detect.optical_disturbance(pixels, detect.Optical(), least=2, keys=("aoi",))
    assert sorted((r.aoi, r.r, r.c) for r in found.collect()) == [(a, r, c) for a in ("dry", "wet") for r in range(2) for c in range(2)]


def test_a_cycle_sets_unfit_detections_aside(spark):
    pixels = spark.createDataFrame([(r, c, 2.0, True, 1.0) for r in range(3) for c in (*range(3), *range(20, 23))], "r int, c int, distance double, forest boolean, greenness_loss double")
    # the second patch lies past 180 degrees
    run = cycle.run_cycle(pixels, None, "a", (2024, 2025), "2026-01-01", 179.999, 10.0, 0.0001, detect.Embedding(min_ha=0.01), least=2)
    assert run.patches == 2 and run.store.count() == 1 and run.n_rejected == 1
    assert [(r.reason, r.aoi) for r in run.rejected.collect()] == [("off the globe", "a")] and run.lines[-1] == "1 detections set aside as unfit"


def test_change_stack(spark):
    v = spark.createDataFrame([(2024, 0, 0, [1.0, 0.0]), (2025, 0, 0, [0.0, 1.0]), (2024, 0, 1, [1.0, 0.0])], "year int, r int, c int, v array<float>")
    (one,) = scenes.change_stack(v, (2024, 2025)).collect()
    assert (one.base, one.change, one.cosine) == ([1.0, 0.0], [-1.0, 1.0], 1.0) and one.l2 == pytest.approx(2**0.5)
    with pytest.raises(ValueError, match="first"):
        scenes.change_stack(v, (2025, 2024))
    with pytest.raises(ValueError, match="2026"):
        scenes.change_stack(v, (2025, 2026))


def test_ranks_over_many_tasks(spark):
    rows = [(f"{i:03d}", float(i * 37 % 50)) for i in range(200)]
    got = report.ranked(spark.createDataFrame(rows, "alert_id string, area_ha double").repartition(7)).collect()
    assert [r.alert_id for r in sorted(got, key=lambda r: r.place)] == [a for a, _ in sorted(rows, key=lambda x: (-x[1], x[0]))]
    assert sorted(r.place for r in got) == list(range(1, 201))
    assert report.ranked(spark.createDataFrame([], "alert_id string, area_ha double")).count() == 0


def test_counts_below_zero_and_places_off_the_globe(spark):
    one = spark.range(1)
    with pytest.raises(Exception, match="below 0"):
        one.select(stats.confusion(F.lit(-1), F.lit(1), F.lit(1))["precision"]).collect()
    for lon, lat in ((181.0, 0.0), (0.0, -90.5)):
        with pytest.raises(ValueError, match="no place on the globe"):
            geo.zone_of(lon, lat)


def test_catalogue(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "cover_pixels.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "scene_pixels.parquet"))
    assert collections.load(spark, str(tmp_path), "cover").count() == 3
    with pytest.raises(ValueError, match="lacks ts"):
        collections.load(spark, str(tmp_path), "optical")
    with pytest.raises(ValueError, match="no table"):
        collections.load(spark, str(tmp_path), "moon")


def test_settings(tmp_path):
    file = tmp_path / "env"
    file.write_text("# remark\nCANOPYFLOW_CHECKPOINT_DIR='/shared/a'\nCANOPYFLOW_APP_NAME=b\nOTHER=1\nCANOPYFLOW_NEW=2\n")
    got = Settings.load({"canopyflow_app_name": "c", "CANOPYFLOW_SHUFFLE_PARTITIONS": "64", "CANOPYFLOW_MASTER": ""}, str(file))
    assert got == Settings(app_name="c", checkpoint_dir="/shared/a", shuffle_partitions=64)
    with pytest.raises(ValueError, match="SHUFFLE_PARTITIONS"):
        Settings.load({"CANOPYFLOW_SHUFFLE_PARTITIONS": "-1"}, str(file))
    assert Settings.load({}, str(tmp_path / "none")) == Settings()
