"""From pixels to patches with outlines, and the cycle that detects, confirms and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyflow.functions import geo
from canopyflow.operators import alerts, detect
from canopyflow.operators.components import _checkpoint
from canopyflow.operators.outline import outlines
from canopyflow.sources import stores


def large_patches(pixels: DataFrame, lat, min_ha: float, keys: tuple[str, ...] = (), pixel_m: float = 10.0) -> DataFrame:
    """(keys, component, n_px, area_ha) of components (r, c, component) whose exact area reaches the floor."""
    sized = pixels.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("n_px"), F.sum(geo.pixel_ha(lat, pixel_m)).alias("area_ha"))
    return sized.where(F.col("area_ha") >= min_ha)


def patch_records(pixels: DataFrame, west: float, north: float, step: float, config: detect.Embedding, keys: tuple[str, ...] = (), least: int | None = None) -> DataFrame:
    """(keys, component, n_px, area_ha, record): GeoJSON features of what changed, holes as inner rings, for pixels of a grid that begins at a corner, rows going south."""
    hit = detect.embedding_disturbance(pixels, config, least=least, keys=keys)
    kept = large_patches(hit, F.lit(north) - (F.col("r") + 0.5) * step, config.min_ha, keys, config.pixel_m)
    drawn = outlines(hit.join(kept.select(*keys, "component"), [*keys, "component"], "left_semi"), keys)
    every = F.transform(F.concat(F.array("ring"), "inner"), lambda ring: F.transform(ring, lambda p: F.array(F.lit(west) + p.c * step, F.lit(north) - p.r * step)))
    geometry = F.struct(F.lit("Polygon").alias("type"), every.alias("coordinates"))
    record = F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct("area_ha", F.lit(1).alias("label")).alias("properties")))
    return drawn.join(kept, [*keys, "component"]).select(*keys, "component", "n_px", "area_ha", record.alias("record"))


@dataclass(frozen=True)
class Result:
    store: DataFrame
    due: DataFrame
    patches: int
    total_ha: float
    pending: int
    notified: int
    dry_run: bool
    rejected: DataFrame
    n_rejected: int

    @property
    def lines(self) -> list[str]:
        return [f"{self.patches} patches, {self.total_ha:.2f} ha", f"{self.due.count()} newly confirmed, {self.pending} pending, {self.notified} notified in all" + " (dry run)" * self.dry_run] + [f"{self.n_rejected} detections set aside as unfit"] * (self.n_rejected > 0)


def run_cycle(pixels: DataFrame, store: DataFrame | None, area: str, years: tuple[int, int], today: str, west: float, north: float, step: float, config: detect.Embedding = detect.Embedding(), least: int | None = None, save=None) -> Result:  # noqa: B008
    """Detect, confirm, record. save takes the new store; without it nothing is kept (a dry run). Unfit detections are set aside with their reason and stop nothing."""
    if years[0] >= years[1]:
        raise ValueError(f"the year to compare with has to come first: {years}")
    records = patch_records(pixels, west, north, step, config, least=least).persist()
    try:
        found = records.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("area_ha"), F.lit(0.0)).alias("ha")).first()
        seen = stores.detections(records.select(F.lit(area).alias("aoi"), F.col("component").alias("seq"), "record"), today)
        fit, unfit = alerts.checked(seen)
        rejected = _checkpoint(unfit)
        after = _checkpoint(alerts.ingest(fit, store, today))
    finally:
        records.unpersist()
    before = after.limit(0) if store is None else store
    due = _checkpoint(after.where(F.col("notified_on") == today).join(before.where("notified_on is not null").select("alert_id"), "alert_id", "left_anti"))
    told = after.agg(F.count("notified_on").alias("notified"), F.count(F.lit(1)).alias("n")).first()
    if save is not None:
        save(after)
    return Result(after, due, found.n, found.ha, told.n - told.notified, told.notified, save is None, rejected, rejected.count())
