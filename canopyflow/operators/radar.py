"""Radar from scenes to disturbance: one orbit's passes, flattened over terrain worked out once an area, freed of speckle, held against a baseline."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyflow.functions import spectral
from canopyflow.functions.geo import min_clearing_pixels
from canopyflow.functions.masks import update_mask
from canopyflow.operators import detect, raster
from canopyflow.operators.area import Box
from canopyflow.sources import collections

BANDS = ("vv", "vh")


def look_directions(angles: DataFrame, keys: tuple[str, ...] = ("aoi",), pixel_m: float = 10.0, coarse_m: float = 1000.0) -> DataFrame:
    """(keys, look): the mean direction, in radians, in which the angle of incidence (keys, r, c, angle in degrees) falls off, on coarse pixels.

    A gradient needs three coarse pixels each way; an area with fewer is an error when it is read.
    """
    coarse = raster.overview(angles, "angle", max(1, round(coarse_m / pixel_m)), keys)
    look = collections.look_direction("aspect")
    found = F.when(look.isNotNull(), look).otherwise(F.raise_error(F.lit(f"an area is too small for a look direction at {coarse_m} m")).cast("double"))
    return raster.slope_aspect(coarse, "angle", coarse_m, keys).groupBy(*keys).agg(found.alias("look"))


def terrain(dem: DataFrame, looks: DataFrame, keys: tuple[str, ...] = ("aoi",), dem_m: float = 30.0) -> DataFrame:
    """(keys, r, c, alpha_r, alpha_az): slopes along and across the look direction, on the grid of heights (keys, r, c, dem)."""
    along, across = spectral.terrain_angles(F.radians("slope"), F.radians("aspect"), F.col("look"))
    return raster.slope_aspect(dem, "dem", dem_m, keys).join(looks, list(keys)).select(*keys, "r", "c", along.alias("alpha_r"), across.alias("alpha_az"))


def prepared(scenes: DataFrame, pixels: DataFrame, dem: DataFrame, start: date, end: date, config: detect.Radar = detect.Radar(), keys: tuple[str, ...] = ("aoi",), bands: tuple[str, ...] = BANDS, box: Box | None = None, pixel_m: float = 10.0, dem_m: float = 30.0, coarse_m: float = 1000.0) -> DataFrame:  # noqa: B008
    """(keys, scene, ts, r, c, bands): passes of one orbit from a day up to another, in decibels, layover and shadow left out of every mean.

    scenes (keys, scene, ts, orbit_pass, mode, pols); pixels (keys, scene, r, c, bands, angle); dem (keys, r, c, dem) on coarser pixels that begin at
    the same corner. The look direction comes from each area's first scene. Terrain has a row for each height, whatever the number of passes.
    Pixels without heights around them are masked.
    """
    seen = collections.radar_scenes(collections.within(scenes, box), config.orbit)
    kept = seen.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end))).select(*keys, "scene", "ts")
    looks = look_directions(pixels.join(collections.first_scene(kept, list(keys)), [*keys, "scene"], "left_semi"), keys, pixel_m, coarse_m)
    ground = terrain(dem, looks, keys, dem_m).withColumnsRenamed({"r": "_gr", "c": "_gc"})
    step = dem_m / pixel_m
    passes = pixels.join(kept, [*keys, "scene"]).withColumns({"_gr": F.floor(F.col("r") / step), "_gc": F.floor(F.col("c") / step)}).join(ground, [*keys, "_gr", "_gc"], "left")
    flat = {b: update_mask(*spectral.slope_correction(F.col(b), F.radians("angle"), F.col("alpha_r"), F.col("alpha_az"), config.model)) for b in bands}
    out = passes.select(*keys, "scene", "ts", "r", "c", *(f.alias(b) for b, f in flat.items()))
    for b in bands:
        out = raster.speckle_filter(out, b, config.speckle_m, pixel_m, (*keys, "scene")).drop(b).withColumnRenamed(f"{b}_mean", b)
    return out


def drops(scenes: DataFrame, pixels: DataFrame, dem: DataFrame, start: date, end: date, config: detect.Radar = detect.Radar(), keys: tuple[str, ...] = ("aoi",), **grid) -> DataFrame:  # noqa: B008
    """(keys, r, c, run, first_drop, n_dropped, drop_db) of the passes from start up to end, against each pixel's median over the days before. grid: as in prepared."""
    if start >= end:
        raise ValueError(f"the days to watch have to begin before they end: {start}, {end}")
    at = [*keys, "r", "c"]
    of = lambda low, high: prepared(scenes, pixels, dem, low, high, config, keys, ("vh",), **grid)
    base = of(start - timedelta(days=config.baseline_days), start).groupBy(*at).agg(F.median("vh").alias("base"))
    return detect.radar_drops(of(start, end), base, at, "vh", "ts", config)


def disturbance(scenes: DataFrame, pixels: DataFrame, dem: DataFrame, forest: DataFrame, start: date, end: date, config: detect.Radar = detect.Radar(), optical: detect.Optical = detect.Optical(), keys: tuple[str, ...] = ("aoi",), least: int | None = None, **grid) -> DataFrame:  # noqa: B008
    """(keys, r, c, component, drop_db, n_dropped, first_drop): forest (keys, r, c, forest) whose backscatter fell and stayed low, in large enough patches."""
    fell = drops(scenes, pixels, dem, start, end, config, keys, **grid).join(forest.select(*keys, "r", "c", "forest"), [*keys, "r", "c"])
    return detect.radar_disturbance(fell, least or min_clearing_pixels(optical.min_ha, grid.get("pixel_m", optical.pixel_m)), keys)
