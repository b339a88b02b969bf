"""Rasters written once and for all: staged, sealed by a manifest, with overviews from the same pass.

An export is a folder of level=0, 1, ... tables. All is written beside its place first, then moved there, and a manifest of rows and files
comes last: what has no manifest was broken off and counts as absent, what has one is whole. So an export can be asked for again after any
failure, and a second call for the same thing writes nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest.json"


@dataclass(frozen=True)
class Export:
    path: str
    written: bool
    rows: dict[int, int]
    files: int


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What a sealed export holds; None where there is none, or one that was broken off."""
    p, files = _path(spark, f"{path}/{MANIFEST}")
    if not files.exists(p):
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(f"{path}/{MANIFEST}").collect()))


def exists(spark: SparkSession, path: str) -> bool:
    return manifest(spark, path) is not None


def wait_for(spark: SparkSession, path: str, timeout: float = 3600.0, poll: float = 20.0) -> dict:
    """The manifest of an export that another job makes; a TimeoutError leaves that job alone."""
    end = time.monotonic() + timeout
    while (found := manifest(spark, path)) is None:
        if time.monotonic() + poll > end:
            raise TimeoutError(f"{path} was not sealed within {timeout} s")
        time.sleep(poll)
    return found


def halved(level: DataFrame, bands: list[str], keys: tuple[str, ...]) -> DataFrame:
    """The next overview: sums and counts of four pixels, so that means stay those of all pixels below, masked ones left out."""
    return level.groupBy(*keys, F.floor(F.col("r") / 2).alias("r"), F.floor(F.col("c") / 2).alias("c")).agg(*(F.sum(f"{n}_{b}").alias(f"{n}_{b}") for b in bands for n in ("sum", "n")))


def overviews(pixels: DataFrame, bands: list[str], levels: int, keys: tuple[str, ...] = ()) -> list[DataFrame]:
    """Means over 2, 4, 8, ... pixels each way; each level comes from the one before it."""
    level = pixels.select(*keys, "r", "c", *(c for b in bands for c in (F.col(b).cast("double").alias(f"sum_{b}"), F.col(b).isNotNull().cast("long").alias(f"n_{b}"))))
    out = []
    for _ in range(levels):
        level = halved(level, bands, keys)
        out.append(level)
    return out


def means(level: DataFrame, bands: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    return level.select(*keys, "r", "c", *(F.try_divide(f"sum_{b}", f"n_{b}").alias(b) for b in bands))


def export(pixels: DataFrame, path: str, bands: list[str], levels: int = 0, keys: tuple[str, ...] = (), again: bool = False) -> Export:
    """Write pixels (keys, r, c, bands) and their overviews under a path, once; again: replace a sealed export.

    The sums of each level are staged, and the next is halved from them, so the pixels are read once.
    """
    spark = pixels.sparkSession
    if not again and (held := manifest(spark, path)) is not None:
        return Export(path, False, {int(k): v for k, v in held["rows"].items()}, held["files"])
    home, files = _path(spark, path)
    stage = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    rows: dict[int, int] = {}
    try:
        pixels.select(*keys, "r", "c", *bands).write.parquet(f"{stage}/level=0")
        base = spark.read.parquet(f"{stage}/level=0")
        rows[0] = base.count()
        level = base.select(*keys, "r", "c", *(c for b in bands for c in (F.col(b).cast("double").alias(f"sum_{b}"), F.col(b).isNotNull().cast("long").alias(f"n_{b}"))))
        for k in range(1, levels + 1):
            halved(level, bands, keys).write.parquet(f"{stage}/sums={k}")
            level = spark.read.parquet(f"{stage}/sums={k}")
            means(level, bands, keys).write.parquet(f"{stage}/level={k}")
            rows[k] = level.count()
        for k in range(1, levels + 1):
            files.delete(_path(spark, f"{stage}/sums={k}")[0], True)
        # what was broken off, or is to be replaced, loses its manifest first
        files.delete(_path(spark, f"{path}/{MANIFEST}")[0], False)
        files.delete(home, True)
        if not files.rename(_path(spark, stage)[0], home):
            raise OSError(f"{stage} can't be moved to {path}")
    except BaseException:
        files.delete(_path(spark, stage)[0], True)
        raise
    found = sum(1 for k in rows for f in files.listStatus(_path(spark, f"{path}/level={k}")[0]) if f.getPath().getName().startswith("part-"))
    out = files.create(_path(spark, f"{path}/{MANIFEST}")[0], True)
    out.write(bytearray(json.dumps({"rows": rows, "files": found, "bands": bands, "keys": list(keys)}).encode()))
    out.close()
    return Export(path, True, rows, found)


def read(spark: SparkSession, path: str, level: int = 0) -> DataFrame:
    """A level of a sealed export; one that is not sealed is an error."""
    if manifest(spark, path) is None:
        raise FileNotFoundError(f"{path} holds no sealed export")
    return spark.read.parquet(f"{path}/level={level}")
