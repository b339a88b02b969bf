"""Rasters of one grid as tables that join pixel by pixel without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save(pixels: DataFrame, table: str, keys: tuple[str, ...] = (), buckets: int = 256, mode: str = "error") -> DataFrame:
    """Write pixels (keys, r, c, ...) as a table bucketed and sorted by pixel, one file a bucket.

    Tables with the same keys, types and number of buckets join on (keys, r, c) where they lie. Choose buckets so that one fits a task: some
    hundred megabytes of the widest table.
    """
    at = [*keys, "r", "c"]
    # long on every side, as the bucket of a number depends on its type
    ready = pixels.withColumns({n: F.col(n).cast("long") for n in ("r", "c")})
    ready.repartition(buckets, *at).write.mode(mode).bucketBy(buckets, *at).sortBy(*at).saveAsTable(table)
    return pixels.sparkSession.table(table)


def overlay(one: DataFrame, other: DataFrame, keys: tuple[str, ...] = (), how: str = "inner") -> DataFrame:
    """Band arithmetic between two rasters: a pixel that either has masked out is no row; full keeps what either has."""
    return one.join(other, [*keys, "r", "c"], how)


def mask_overlap(predicted: DataFrame, truth: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, r, c, predicted, truth) of all pixels that either mask (keys, r, c, set) has; absent and masked ones are not set."""
    set_ = lambda m, name: m.select(*keys, "r", "c", F.col("set").alias(name))
    both = overlay(set_(predicted, "predicted"), set_(truth, "truth"), keys, "full")
    return both.withColumns({n: F.coalesce(n, F.lit(False)) for n in ("predicted", "truth")})
