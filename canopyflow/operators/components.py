"""8-connected components of a raster given as rows.

Each tile is labelled by union-find in one Arrow group; only pixels on tile edges then meet those of neighbouring tiles, and the small graph of
labels is closed by min-label rounds with pointer jumping. No tile seam is left. Lineage is cut in every round by a table written and read again.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    """The folder of this session's tables: in that of checkpoints, which all executors share; it goes when the session ends."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="canopyflow-"))
    root = f"{sc.getCheckpointDir()}/canopyflow"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return root


def _checkpoint(df: DataFrame, *earlier: DataFrame) -> DataFrame:
    """df written and read again; earlier: tables of this kind that nothing needs any more.

    checkpoint() cuts the lineage but keeps the estimate of its size, and that of a join is the product of its sides: a table joined with itself
    round by round doubles the digits of a number that the driver works with, until it has no memory or time left. A table read from files is as large as they are.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    for x in earlier:
        # a table's files lie in one folder
        for at in {f.rpartition("/")[0] for f in x.inputFiles()}:
            old = spark._jvm.org.apache.hadoop.fs.Path(at)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(df.schema).parquet(path)


def label_components(cells: DataFrame, tile: int = 512, keys: tuple[str, ...] = ()) -> DataFrame:
    """cells (keys, r, c; one row per set pixel) with component: the label r * 2**31 + c of its first pixel."""
    big = 1 << 31
    schema = ", ".join(f"{n} {t}" for n, t in cells.select(*keys).dtypes) + (", " if keys else "") + "r long, c long, local long"

    def work(pdf):
        # runs of set pixels in a row, then a union of the runs that touch from one row to the next
        order = np.lexsort((pdf.c, pdf.r))
        r, c = pdf.r.to_numpy(np.int64)[order], pdf.c.to_numpy(np.int64)[order]
        new = np.concatenate([[True], (np.diff(r) != 0) | (np.diff(c) != 1)])
        run, first = np.cumsum(new) - 1, np.flatnonzero(new)
        rr, lo, hi = r[first], c[first], c[np.append(first[1:], len(r)) - 1]
        root = list(range(len(first)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        # runs of the row above that begin no later than one past this run's end and end no earlier than one before its start
        at = rr * (4 * big) + lo + big
        begin, end = np.searchsorted(rr * (4 * big) + hi + big, at - 4 * big - 1), np.searchsorted(at, (rr - 1) * (4 * big) + hi + big + 1, "right")
        for i in np.flatnonzero(begin < end).tolist():
            for j in range(int(begin[i]), int(end[i])):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
        label = (rr * big + lo)[[find(i) for i in range(len(first))]][run]
        out = pdf.iloc[order]
        return out.assign(local=label)[[*keys, "r", "c", "local"]]

    rows = cells.select(*keys, F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c")).distinct()
    local = _checkpoint(rows.groupBy(*keys, F.floor(F.col("r") / tile).alias("tr"), F.floor(F.col("c") / tile).alias("tc")).applyInPandas(work, schema))
    m = lambda x: F.pmod(F.col(x), F.lit(tile))
    edge = local.where((m("r") == 0) | (m("r") == tile - 1) | (m("c") == 0) | (m("c") == tile - 1))
    steps = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j))).alias("s")
    near = edge.select(*keys, "r", "c", F.col("local").alias("u"), steps).select(*keys, (F.col("r") + F.col("s.i")).alias("r"), (F.col("c") + F.col("s.j")).alias("c"), "u")
    links = near.join(edge.select(*keys, "r", "c", F.col("local").alias("v")), [*keys, "r", "c"]).where("u <> v").select(*keys, "u", "v").distinct()
    low = close(links, keys)
    return local.join(low.select(*keys, F.col("u").alias("local"), "label"), [*keys, "local"], "left").select(*keys, "r", "c", F.coalesce("label", "local").alias("component"))


def close(links: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, u, label): the least label reachable from each label by links (keys, u, v) that hold both ways.

    Min-label rounds, each followed by a jump along the labels found, so that far ends meet in a number of rounds that grows with the logarithm.
    """
    links = _checkpoint(links)
    label = links.select(*keys, "u").distinct().withColumn("label", F.col("u"))
    if links.isEmpty():
        return label
    label = _checkpoint(label)
    while True:
        low = links.join(label.withColumnRenamed("u", "v").withColumnRenamed("label", "other"), [*keys, "v"]).groupBy(*keys, "u").agg(F.min("other").alias("other"))
        new = label.join(low, [*keys, "u"]).select(*keys, "u", F.least("label", "other").alias("label"), F.col("label").alias("was"))
        jump = new.select(*keys, F.col("u").alias("label"), F.col("label").alias("next"))
        new = _checkpoint(new.join(jump, [*keys, "label"], "left").select(*keys, "u", F.coalesce("next", "label").alias("label"), "was"), label)
        label = new.drop("was")
        if new.where("label <> was").isEmpty():
            return label


def component_sizes(cells: DataFrame, **how) -> DataFrame:
    """Pixels with their component and its size, counted exactly; sizes are joined back, so no component meets in one task."""
    keys = list(how.get("keys", ()))
    out = label_components(cells, **how)
    return out.join(out.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("size")), [*keys, "component"])


def drop_small(cells: DataFrame, least: int, **how) -> DataFrame:
    """Pixels in components of at least so many; sizes are joined back, so no component meets in one task."""
    keys = list(how.get("keys", ()))
    out = label_components(cells, **how)
    keep = out.groupBy(*keys, "component").count().where(F.col("count") >= least).drop("count")
    return out.join(keep, [*keys, "component"], "left_semi")


def patches(pixels: DataFrame, area: str = "ha", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per component: patch pixels, area and pixel centroid."""
    return pixels.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("n_px"), F.sum(area).alias("area_ha"), F.avg("r").alias("row"), F.avg("c").alias("col"))


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "r long, c long, component long")
