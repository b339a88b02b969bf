"""Collections of scenes by year: what there is, and one year's mosaic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.operators.area import Box, touches
from canopyflow.operators.raster import mosaic

#: Tables that the engine knows, by name, with the columns that hold time and value. (Fixed values.)
CATALOGUE = {"optical": ("scene_pixels", "ts"), "radar": ("radar_pixels", "ts"), "vectors": ("vector_tiles", "ts"), "loss": ("loss_pixels", None), "cover": ("cover_pixels", None), "terrain": ("terrain_pixels", None), "basemaps": ("basemaps", "ts"), "rain": ("rain_pixels", "ts")}


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the catalogue under a folder; one that lacks a column that it needs is an error at once."""
    if name not in CATALOGUE:
        raise ValueError(f"no table {name}; there are {', '.join(sorted(CATALOGUE))}")
    table, ts = CATALOGUE[name]
    out = spark.read.parquet(f"{root}/{table}.parquet")
    if lacking := missing(out, [ts] if ts else []):
        raise ValueError(f"{table} lacks {', '.join(lacking)}")
    return out


def missing(pixels: DataFrame, bands: list[str]) -> list[str]:
    """Bands that a table lacks, in the order asked for."""
    return [b for b in bands if b not in pixels.columns]


def valid_counts(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """(band, n): how many pixels of each band are valid, 0 for a band that isn't there; one pass, a row for each band."""
    of = lambda b: F.count(b) if b in pixels.columns else F.count(F.lit(None).cast("int"))
    each = F.array(*(F.struct(F.lit(b).alias("band"), of(b).alias("n")) for b in bands))
    return pixels.agg(each.alias("all")).select(F.inline("all"))


def within(scenes: DataFrame, box: Box | None) -> DataFrame:
    """Scenes (west, south, east, north, ...) that meet a box; all where none is given."""
    return scenes if box is None else scenes.where(touches(box, *(F.col(c) for c in ("west", "south", "east", "north"))))


def available_years(scenes: DataFrame, box: Box | None = None, ts: str = "ts") -> DataFrame:
    return within(scenes, box).select(F.year(ts).alias("year")).distinct()


def latest_year(scenes: DataFrame, box: Box | None = None, ts: str = "ts") -> int:
    last = available_years(scenes, box, ts).agg(F.max("year").alias("year")).first().year
    if last is None:
        raise ValueError("no scene covers this area")
    return last


def annual(scenes: DataFrame, year: int, keys: list[str], band: str, order: str, box: Box | None = None, ts: str = "ts") -> DataFrame:
    """One calendar year's mosaic, the last valid tile on top; a year without scenes is an error that says which there are."""
    of_year = within(scenes, box).where((F.col(ts) >= F.to_timestamp_ntz(F.lit(f"{year}-01-01 00:00:00"))) & (F.col(ts) < F.to_timestamp_ntz(F.lit(f"{year + 1}-01-01 00:00:00"))))
    if of_year.isEmpty():
        got = sorted(r.year for r in available_years(scenes, box, ts).collect())
        raise ValueError(f"nothing for {year}; available: {f'{got[0]} to {got[-1]}' if got else 'none'}")
    return mosaic(of_year, keys, band, F.struct(ts, order))


def radar_scenes(scenes: DataFrame, orbit: str, polarisations: tuple[str, ...] = ("VV", "VH"), mode: str = "IW") -> DataFrame:
    """Scenes (orbit_pass, mode, pols) of one orbit and mode that hold all polarisations."""
    out = scenes.where((F.col("orbit_pass") == orbit) & (F.col("mode") == mode))
    for p in polarisations:
        out = out.where(F.array_contains("pols", p))
    return out


def first_scene(scenes: DataFrame, keys: list[str], ts: str = "ts", scene: str = "scene") -> DataFrame:
    """(keys, scene): the earliest of each key, ties to the smaller id."""
    return scenes.groupBy(*keys).agg(F.min_by(scene, F.struct(ts, scene)).alias(scene))


def property_list(scenes: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """(keys, values): what a property takes among scenes, each once, in order. For properties with few values, as years."""
    return scenes.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("values"))


def with_properties(scenes: DataFrame, said: dict[str, str], ts: str = "ts") -> DataFrame:
    """scenes with properties told, and the year that they are of."""
    return scenes.withColumns({"year": F.date_format(ts, "yyyy"), **{n: F.lit(v) for n, v in said.items()}})


def look_direction(aspect_degrees: str):
    """A scene's look direction: the plain mean of its angles in degrees, as radians."""
    return F.radians(F.avg(aspect_degrees))


def newest_within_year(tiles: DataFrame, year: int, day: str = "captured") -> DataFrame:
    """The latest from 1 January up to, not on, 31 December; no row where there is none."""
    return tiles.where(F.col(day).between(f"{year}-01-01", f"{year}-12-30")).orderBy(F.desc(day)).limit(1)
