"""Disturbance detectors: DataFrame to DataFrame, over whole areas without tile seams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopyflow.functions.geo import min_clearing_pixels
from canopyflow.functions.masks import mask_and, mask_or
from canopyflow.functions.season import code_of_year as loss_code
from canopyflow.operators.components import drop_small
from canopyflow.operators.raster import consecutive_run, minus_landscape


@dataclass(frozen=True)
class Optical:
    ndvi_drop: float = 0.15
    forest_ndvi: float = 0.60
    treecover: int = 30
    min_ha: float = 0.2
    max_cloud: float = 60.0
    min_observations: int = 3
    pixel_m: float = 10.0

    def __post_init__(self):
        if not (0 < self.ndvi_drop <= 2 and -1 <= self.forest_ndvi <= 1 and 0 <= self.treecover <= 100 and self.min_ha > 0 and 0 < self.max_cloud <= 100 and self.min_observations >= 1 and self.pixel_m > 0):
            raise ValueError(f"out of range: {self}")


@dataclass(frozen=True)
class Embedding:
    distance: float = 0.45
    min_ha: float = 0.2
    gate: bool = True
    pixel_m: float = 10.0

    def __post_init__(self):
        if not (self.distance > 0 and self.min_ha > 0 and self.pixel_m > 0):
            raise ValueError(f"out of range: {self}")


@dataclass(frozen=True)
class Radar:
    orbit: str = "DESCENDING"
    model: str = "volume"
    speckle_m: float = 30.0
    baseline_days: int = 365
    drop_db: float = 2.5
    passes: int = 2

    def __post_init__(self):
        if not (self.orbit in ("ASCENDING", "DESCENDING") and self.model in ("volume", "surface") and self.speckle_m > 0 and self.baseline_days >= 60 and self.drop_db > 0 and self.passes >= 1):
            raise ValueError(f"out of range: {self}")


def forest(treecover: Column, lossyear: Column, datamask: Column, year: int, pct: int = 30) -> Column:
    """Forest at the start of a year: enough cover, not lost before; a null loss year means never lost."""
    lost = F.coalesce(lossyear, F.lit(0))
    return mask_and(mask_and(treecover >= pct, mask_or(lost == 0, lost >= loss_code(year))), datamask == 1)


def loss(lossyear: Column, after: int, through: int) -> Column:
    if after >= through:
        raise ValueError("after must lie before through")
    return F.coalesce(lossyear, F.lit(0)).between(loss_code(after) + 1, loss_code(through))


def _large(pixels: DataFrame, least: int, value: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    kept = drop_small(pixels.select(*keys, "r", "c"), least, keys=keys)
    return pixels.join(kept, [*keys, "r", "c"]).select(*keys, "r", "c", "component", *value)


def embedding_disturbance(pixels: DataFrame, config: Embedding = Embedding(), least: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """(r, c, component, distance) of pixels (r, c, distance, forest, greenness_loss) that changed, in large enough patches; the gate comes before the patches."""
    hit = mask_and(F.col("distance") >= config.distance, F.col("forest"))
    if config.gate:
        hit = mask_and(hit, F.col("greenness_loss") > 0)
    return _large(pixels.where(hit), least or min_clearing_pixels(config.min_ha, config.pixel_m), ["distance"], keys)


def optical_disturbance(pixels: DataFrame, config: Optical = Optical(), normalise: bool = True, least: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """(keys, r, c, component, ndvi_drop) of pixels (keys, r, c, before, after, n_before, n_after, forest); each area has a landscape of its own."""
    dropped = pixels.withColumn("ndvi_drop", F.col("before") - F.col("after"))
    dropped = minus_landscape(dropped, "ndvi_drop", keys) if normalise else dropped
    looks = mask_and(F.col("n_before") >= config.min_observations, F.col("n_after") >= config.min_observations)
    ok = mask_and(mask_and(mask_and(F.col("ndvi_drop") >= config.ndvi_drop, F.col("before") >= config.forest_ndvi), F.col("forest")), looks)
    return _large(dropped.where(ok), least or min_clearing_pixels(config.min_ha, config.pixel_m), ["ndvi_drop"], keys)


def radar_drops(passes: DataFrame, baseline: DataFrame, keys: list[str], value: str, ts: str, config: Radar = Radar()) -> DataFrame:  # noqa: B008
    """Per pixel: run of passes, first_drop, n_dropped, drop_db (mean over all passes), against a baseline (keys, base)."""
    fell = passes.join(baseline, keys).withColumn("fall", F.col("base") - F.col(value)).withColumn("dropped", F.coalesce(F.col("fall") >= config.drop_db, F.lit(False)))
    runs = consecutive_run(fell, keys, "dropped", [ts, *([c for c in ("event_id", "scene") if c in passes.columns])], config.passes)
    stats = fell.groupBy(*keys).agg(F.min(F.when(F.col("dropped"), F.col(ts))).alias("first_drop"), F.sum(F.col("dropped").cast("int")).alias("n_dropped"), F.avg("fall").alias("drop_db"))
    return stats.join(runs, keys)


def radar_disturbance(drops: DataFrame, least: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(r, c, component, drop_db, n_dropped, first_drop) of radar drops (r, c, forest, run, ...)."""
    return _large(drops.where(F.col("run") & F.col("forest")), least, ["drop_db", "n_dropped", "first_drop"], keys)
