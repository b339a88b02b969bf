"""From scenes and yearly vectors to the pixels that a detector takes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyflow.functions import spectral
from canopyflow.functions.season import Season
from canopyflow.operators import detect, raster


def seasonal_greenness(scenes: DataFrame, season: Season, year: int, config: detect.Optical = detect.Optical(), keys: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """(keys, r, c, ndvi, n_obs): the median of the index over a season's scenes (ts, cloud_pct, r, c, scl, red, nir) with little cloud, clouds masked."""
    start, end = season.dates(F.lit(year))
    usable = scenes.where((F.col("ts") >= start) & (F.col("ts") < end) & (F.col("cloud_pct") < config.max_cloud))
    ndvi = spectral.mask_clouds(spectral.normalized_difference(F.col("nir"), F.col("red")), F.col("scl"))
    return raster.composite(usable, [*keys, "r", "c"], {"ndvi": ndvi}, ndvi)


def years_held(vectors: DataFrame) -> list[int]:
    return sorted(r.year for r in vectors.select("year").distinct().collect())


def years_to_compare(vectors: DataFrame, season: Season, today: date, gap: int = 1) -> tuple[int, int]:
    """(base, target): the newest year that is both over by the calendar and among the vectors, and the one `gap` years before."""
    _, recent = season.compared_today(today, gap)
    held = years_held(vectors)
    if not held:
        raise ValueError("no year of vectors")
    target = min(recent, held[-1])
    missing = [y for y in (target - gap, target) if y not in held]
    if missing:
        raise ValueError(f"no vectors of {', '.join(map(str, missing))}; there are those of {', '.join(map(str, held))}")
    return target - gap, target


def change_stack(vectors: DataFrame, years: tuple[int, int], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, r, c, base, change, l2, cosine) of vectors (year, r, c, v): what a pixel was, how it moved, and how far. Pixels without both years are masked."""
    base, target = years
    if base >= target:
        raise ValueError(f"the year to compare with has to come first: {years}")
    if lacking := sorted({base, target} - set(years_held(vectors))):
        raise ValueError(f"no vectors of {', '.join(map(str, lacking))}")
    at = [*keys, "r", "c"]
    of = lambda year, name: vectors.where(F.col("year") == year).select(*at, F.col("v").cast("array<double>").alias(name))
    both, x, y = of(base, "base").join(of(target, "_y"), at), F.col("base"), F.col("_y")
    return both.select(*at, "base", spectral.difference(y, x).alias("change"), spectral.l2_distance(x, y).alias("l2"), spectral.cosine_distance(x, y).alias("cosine"))


def change_pixels(vectors: DataFrame, land: DataFrame, scenes: DataFrame | None, season: Season, years: tuple[int, int], optical: detect.Optical = detect.Optical(), keys: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """(keys, r, c, distance, forest, greenness_loss) between two years, one row for each pixel with vectors of both.

    vectors (year, r, c, v), land (r, c, treecover, lossyear, datamask), scenes as in seasonal_greenness; without scenes there is no greenness_loss.
    Equi-joins by pixel throughout; a pixel without land data is masked.
    """
    base, target = years
    if base >= target:
        raise ValueError(f"the year to compare with has to come first: {years}")
    at = [*keys, "r", "c"]
    of = lambda year, name: vectors.where(F.col("year") == year).select(*at, F.col("v").cast("array<double>").alias(name))
    wood = land.select(*at, detect.forest(F.col("treecover"), F.col("lossyear"), F.col("datamask"), base, optical.treecover).alias("forest"))
    out = of(base, "_x").join(of(target, "_y"), at).join(wood, at, "left").select(*at, spectral.l2_distance(F.col("_x"), F.col("_y")).alias("distance"), "forest")
    if scenes is None:
        return out.withColumn("greenness_loss", F.lit(None).cast("double"))
    green = lambda year, name: seasonal_greenness(scenes, season, year, optical, keys).select(*at, F.col("ndvi").alias(name))
    return out.join(green(base, "_before"), at, "left").join(green(target, "_after"), at, "left").withColumn("greenness_loss", F.col("_before") - F.col("_after")).drop("_before", "_after")
