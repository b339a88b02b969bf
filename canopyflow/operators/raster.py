"""Raster algebra on long tables: composites, mosaics, neighbourhoods, zonal statistics, runs of passes."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopyflow.functions import spectral
from canopyflow.operators.components import _checkpoint


def composite(scenes: DataFrame, keys: list[str], bands: dict[str, Column], count_of: Column | None = None) -> DataFrame:
    """Per pixel the median of each band (of the index, not an index of medians), and the number of usable looks."""
    counted = {} if count_of is None else {"n_obs": F.count(count_of)}
    return scenes.groupBy(*keys).agg(*(F.median(c).alias(n) for n, c in bands.items()), *(c.alias(n) for n, c in counted.items()))


def mosaic(scenes: DataFrame, keys: list[str], band: str, order: Column) -> DataFrame:
    """Per pixel the last valid value in order."""
    return scenes.where(F.col(band).isNotNull()).groupBy(*keys).agg(F.max_by(band, order).alias(band))


def disc(radius_m: float, pixel_m: float) -> list[tuple[int, int]]:
    """Offsets of the pixels whose centres lie within a radius."""
    k = math.floor(radius_m / pixel_m)
    return [(i, j) for i in range(-k, k + 1) for j in range(-k, k + 1) if (i * i + j * j) * pixel_m * pixel_m <= radius_m * radius_m]


def focal_mean(pixels: DataFrame, band: str, radius_m: float = 30.0, pixel_m: float = 10.0, keys: tuple[str, ...] = (), tile: int = 256) -> DataFrame:
    """pixels with {band}_mean, the mean over a disc, masked pixels left out; null where all are masked. One row a pixel.

    Tiles with a halo a radius wide, so one shuffle in which only pixels near a seam go twice or more; inside a tile each row of the disc is a few sums of runs.
    """
    import pandas as pd

    k = math.floor(radius_m / pixel_m)
    widths = [max(j for i2, j in disc(radius_m, pixel_m) if i2 == i) for i in range(-k, k + 1)]
    names = pixels.columns
    schema = ", ".join(f"`{n}` {t}" for n, t in pixels.dtypes) + f", `{band}_mean` double"

    def work(key, pdf):
        own = (pdf._tr == key[-2]) & (pdf._tc == key[-1])
        r0, c0 = key[-2] * tile - k, key[-1] * tile - k
        r, c = (pdf.r.to_numpy("int64") - r0), (pdf.c.to_numpy("int64") - c0)
        value = pd.to_numeric(pdf[band]).to_numpy("float64", na_value=np.nan)
        there = ~np.isnan(value)
        # a column of zeros before the first, so that a run's count is one difference; values are added by runs of 1, 2, 4, ... pixels and never
        # subtracted, as the difference of two large sums would lose a small one
        runs, count = [np.zeros((tile + 2 * k, tile + 2 * k))], np.zeros((tile + 2 * k, tile + 2 * k + 1), np.int64)
        runs[0][r[there], c[there]], count[r[there], c[there] + 1] = value[there], 1
        count = count.cumsum(1)
        while 2 ** len(runs) <= 2 * k + 1:
            half = 2 ** (len(runs) - 1)
            runs.append(runs[-1].copy())
            runs[-1][:, :-half] += runs[-2][:, half:]
        rr, cc = r[own.to_numpy()], c[own.to_numpy()]
        s, n = np.zeros(len(rr)), np.zeros(len(rr), np.int64)
        for i, w in zip(range(-k, k + 1), widths, strict=True):
            at = cc - w
            for j, run in enumerate(runs):
                if (2 * w + 1) >> j & 1:
                    s += run[rr + i, at]
                    at = at + 2**j
            n += count[rr + i, cc + w + 1] - count[rr + i, cc - w]
        out = pdf.loc[own, names].copy()
        out[f"{band}_mean"] = np.where(n > 0, s / np.maximum(n, 1), np.nan)
        return out

    t = lambda x, d: F.floor((F.col(x) + d) / tile)
    spread = pixels.withColumn("_a", F.explode(F.sequence(t("r", -k), t("r", k)))).withColumn("_b", F.explode(F.sequence(t("c", -k), t("c", k)))).withColumn("_tr", t("r", 0)).withColumn("_tc", t("c", 0))
    out = spread.groupBy(*keys, "_a", "_b").applyInPandas(work, schema)
    return out.withColumn(f"{band}_mean", F.when(~F.isnan(f"{band}_mean"), F.col(f"{band}_mean")))


#: Ranges that a selection counts at a time, and values that it sorts at last.
RANGES, SORTED = 4096, 1_000_000


def exact_median(rows: DataFrame, band: str, ranges: int = RANGES, sort: int = SORTED) -> float | None:
    """The median of a column, as F.median gives it, without all values in one place; null for none. Values have to be finite or null.

    Counts by range find the one range that holds the middle; it is cut into ranges again until what it holds can be sorted, or is one value.
    """
    v = F.col(band).cast("double")
    lo, hi, n = rows.agg(F.min(v), F.max(v), F.count(v)).first()
    if not n:
        return None

    def at(rank: int, lo: float, hi: float, inside: int) -> float:
        """The value of a rank (from 0) among those from lo to hi."""
        while lo < hi and inside > sort:
            width = (hi - lo) / ranges
            if not 0 < width < math.inf or lo + width == lo:
                width = max(math.ulp(lo), math.ulp(hi))
            place = F.least(F.floor((v - lo) / width), F.lit(ranges - 1)).alias("place")
            held = sorted(tuple(r) for r in rows.where(v.between(lo, hi)).groupBy(place).agg(F.count(F.lit(1)), F.min(v), F.max(v)).collect())
            for _, count, low, high in held:
                if rank < count:
                    lo, hi, inside = low, high, count
                    break
                rank -= count
        if lo == hi:
            return lo
        return rows.where(v.between(lo, hi)).orderBy(v).select(v).offset(rank).limit(1).first()[0]

    if n % 2:
        return at(n // 2, lo, hi, n)
    return (at(n // 2 - 1, lo, hi, n) + at(n // 2, lo, hi, n)) / 2


def exact_medians(rows: DataFrame, band: str, keys: tuple[str, ...], ranges: int = RANGES, sort: int = SORTED) -> DataFrame:
    """(keys, median) as F.median gives it, whatever share of the rows one key holds; finite or null values, keys without nulls.

    Every key's middle is narrowed down at once: counts by range, summed map-side, pick the range that holds it, until what is inside can be sorted.
    A key without a value has no row.
    """
    at = [*keys, "_half"]
    own = rows.select(*keys, F.col(band).cast("double").alias("_v")).where("_v is not null")
    sized = own.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("_v").alias("_inside"))
    middle = F.array(F.floor((F.col("_inside") - 1) / 2), F.floor(F.col("_inside") / 2))
    want = _checkpoint(sized.select(*keys, "_lo", "_hi", "_inside", F.posexplode(middle).alias("_half", "_rank")))
    wide = (F.col("_lo") < F.col("_hi")) & (F.col("_inside") > sort)
    inside = lambda w: own.join(w, list(keys)).where("_v between _lo and _hi")
    while not want.where(wide).isEmpty():
        width = F.col("_hi") / ranges - F.col("_lo") / ranges
        place = F.when(F.col("_lo") + width == F.col("_lo"), (F.col("_v") > F.col("_lo")).cast("long")).otherwise(F.least(F.floor(F.col("_v") / width - F.col("_lo") / width), F.lit(ranges - 1)))
        held = inside(want.where(wide)).groupBy(*at, "_rank", place.alias("_place")).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_inside"))
        held = held.withColumn("_before", F.sum("_inside").over(Window.partitionBy(*at).orderBy("_place")) - F.col("_inside"))
        found = held.where("_before <= _rank and _rank < _before + _inside").withColumn("_rank", F.col("_rank") - F.col("_before"))
        want = _checkpoint(want.where(~wide).unionByName(found.select(want.columns)))
    ordered = inside(want.where("_lo < _hi")).withColumn("_k", F.row_number().over(Window.partitionBy(*at).orderBy("_v")) - 1).where("_k = _rank")
    return want.where("_lo = _hi").select(*keys, F.col("_lo").alias("_v")).unionByName(ordered.select(*keys, "_v")).groupBy(*keys).agg(F.avg("_v").alias("median"))


def slope_aspect(dem: DataFrame, band: str = "dem", pixel_m: float = 30.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """Slope and aspect in degrees from the four neighbours; null on the border and beside a hole, where a neighbour is missing."""

    def across(along: str, other: str):
        w = Window.partitionBy(*keys, other).orderBy(along)
        beside = (F.lead(along).over(w) == F.col(along) + 1) & (F.lag(along).over(w) == F.col(along) - 1)
        return F.when(beside, (F.lead(band).over(w) - F.lag(band).over(w)) / (2 * pixel_m))

    out = dem.withColumn("dx", across("c", "r")).withColumn("dy", across("r", "c"))
    return out.withColumn("slope", F.degrees(F.atan(F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))))).withColumn("aspect", F.pmod(F.degrees(F.atan2(-F.col("dx"), F.col("dy"))) + 360, F.lit(360.0))).drop("dx", "dy")


def overview(pixels: DataFrame, band: str, factor: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Coarser pixels by mean."""
    return pixels.groupBy(*keys, F.floor(F.col("r") / factor).alias("r"), F.floor(F.col("c") / factor).alias("c")).agg(F.avg(band).alias(band))


def speckle_filter(pixels: DataFrame, band: str, radius_m: float = 30.0, pixel_m: float = 10.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """A band in decibels averaged over a disc in linear power, then in decibels again."""
    linear = focal_mean(pixels.withColumn("_power", spectral.to_linear(F.col(band))), "_power", radius_m, pixel_m, keys)
    return linear.withColumn(f"{band}_mean", spectral.to_db(F.col("_power_mean"))).drop("_power", "_power_mean")


def minus_landscape(pixels: DataFrame, band: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The band less its median over the whole area, each area's own where keys name areas; found by selection."""
    if keys:
        return pixels.join(exact_medians(pixels, band, keys), list(keys), "left").withColumn(band, F.col(band) - F.col("median")).drop("median")
    middle = exact_median(pixels, band)
    return pixels.withColumn(band, F.col(band) - F.lit(middle).cast("double"))


def consecutive_run(passes: DataFrame, keys: list[str], flag: str, order: list[str], n: int) -> DataFrame:
    """Per pixel whether n consecutive passes were flagged; a masked pass breaks a run, fewer passes than n make none."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.currentRow, n - 1)
    hit = (F.min(F.coalesce(F.col(flag), F.lit(False)).cast("int")).over(w) == 1) & (F.count(F.lit(1)).over(w) == n)
    return passes.withColumn("run", hit).groupBy(*keys).agg(F.max("run").alias("run"))


def zonal(pixels: DataFrame, x: str, y: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.sum(x).alias("total"), F.avg(x).alias("mean"), F.median(x).alias("median"), F.corr(x, y).alias("correlation"))


def display_value(v: Column, low: float, high: float, gamma: float = 1.0) -> Column:
    """A band's value from 0 to 255 for display."""
    return F.pow(F.least(F.greatest((v - low) / (high - low), F.lit(0.0)), F.lit(1.0)), F.lit(1 / gamma)) * 255
