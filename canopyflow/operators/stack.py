"""Components of a raster at several thresholds at once, and the stack that a threshold sweep samples.

The components of falling thresholds form a tree: as the threshold sinks they grow and merge, never part. Each tile builds its tree in one
pass over its pixels, highest level first, merging what touches; the trees of neighbouring tiles are then tied level by level along
their seams, all levels in one run. A pixel carries only its node at the level where it comes in; sizes are handed down the tree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopyflow.functions.masks import mask_and
from canopyflow.operators.components import _checkpoint, close

_BIG, _NONE = 1 << 31, -(1 << 62)
_BESIDE = ((0, 1), (1, -1), (1, 0), (1, 1))


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the components of a and b pair by pair, in place; the least member stands for its component."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def tree(r: np.ndarray, c: np.ndarray, level: np.ndarray, levels: int) -> np.ndarray:
    """Labels (levels, pixels) of the pixels' components at each level, _NONE where a pixel isn't in yet; pixels sorted by (r, c), level 0 comes in first."""
    n = len(r)
    root, at = np.arange(n), r * (4 * _BIG) + c
    edges = []
    for dr, dc in _BESIDE:
        want = at + dr * (4 * _BIG) + dc
        to = np.searchsorted(at, want)
        hit = (to < n) & (at[np.minimum(to, n - 1)] == want)
        edges.append((np.flatnonzero(hit), to[hit]))
    u, v = np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges])
    comes = np.maximum(level[u], level[v])
    out, label = np.full((levels, n), _NONE, np.int64), r * _BIG + c
    for k in range(levels):
        _merge(root, u[comes == k], v[comes == k])
        out[k] = np.where(level <= k, label[root], _NONE)
    return out


def component_tree(cells: DataFrame, levels: int, keys: tuple[str, ...] = (), tile: int = 512) -> DataFrame:
    """cells (keys, r, c, level; one row a pixel, level 0 to levels - 1) with sizes array<long>: of the pixel's 8-connected component at each level, 0 before it comes in.

    A component at level k is one of the pixels of level k or below it. Counted exactly, whatever tiles it spans.
    """
    kinds = ", ".join(f"{n} {t}" for n, t in cells.select(*keys).dtypes) + (", " if keys else "")
    # a pixel (n null): its node, and at the tile's edge its nodes at all further levels; a node (n set): pixels, and its parent one level on
    schema = kinds + "r long, c long, level int, node long, further array<long>, parent long, n long"

    def work(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["r", "c"], kind="stable")
        r, c, level = pdf.r.to_numpy(np.int64), pdf.c.to_numpy(np.int64), pdf.level.to_numpy(np.int64)
        label = tree(r, c, level, levels)
        edge = (r % tile == 0) | (r % tile == tile - 1) | (c % tile == 0) | (c % tile == tile - 1)
        pixels = pd.DataFrame({"r": r, "c": c, "level": level, "node": label[level, np.arange(len(r))]})
        pixels["further"] = [label[k:, i].tolist() if e else None for i, (k, e) in enumerate(zip(level, edge, strict=True))]
        nodes = []
        for k in range(levels):
            node, first, n = np.unique(label[k], return_index=True, return_counts=True)
            real = node != _NONE
            up = label[k + 1, first[real]] if k + 1 < levels else np.full(real.sum(), _NONE)
            nodes.append(pd.DataFrame({"level": k, "node": node[real], "parent": up, "n": n[real]}))
        out = pd.concat([pixels, *nodes])
        out["further"] = [*pixels["further"], *[None] * (len(out) - len(pixels))]
        for name in keys:
            out[name] = pdf[name].iat[0]
        for name in ("r", "c", "parent", "n"):
            out[name] = out[name].astype("Int64") if name in out else pd.array([None] * len(out), "Int64")
        return out[[*keys, "r", "c", "level", "node", "further", "parent", "n"]]

    rows = cells.select(*keys, F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.col("level").cast("int").alias("level"))
    built = _checkpoint(rows.groupBy(*keys, F.floor(F.col("r") / tile).alias("tr"), F.floor(F.col("c") / tile).alias("tc")).applyInPandas(work, schema))
    pixels, nodes = built.where("n is null").drop("parent", "n"), built.where("n is not null").select(*keys, "level", "node", "parent", "n")
    # along seams: the nodes of two touching pixels are one, at every level where both are in
    edge = pixels.where("further is not null").select(*keys, "r", "c", "level", "further")
    steps = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j))).alias("s")
    near = edge.select(*keys, F.col("r").alias("_r"), F.col("c").alias("_c"), F.col("level").alias("_from"), F.col("further").alias("_mine"), steps)
    near = near.withColumn("r", F.col("_r") + F.col("s.i")).withColumn("c", F.col("_c") + F.col("s.j")).drop("s")
    t = lambda x: F.floor(F.col(x) / tile)
    met = near.join(edge, [*keys, "r", "c"]).where((t("r") != t("_r")) | (t("c") != t("_c")))
    met = met.withColumn("_at", F.explode(F.sequence(F.greatest("_from", "level"), F.lit(levels - 1))))
    links = met.select(*keys, F.col("_at").alias("level"), F.element_at("_mine", F.col("_at") - F.col("_from") + 1).alias("u"), F.element_at("further", F.col("_at") - F.col("level") + 1).alias("v")).where("u <> v").distinct()
    low = close(links, (*keys, "level"))
    nodes = nodes.join(low.withColumnRenamed("u", "node"), [*keys, "level", "node"], "left").withColumn("label", F.coalesce("label", "node"))
    total = nodes.groupBy(*keys, "level", "label").agg(F.sum("n").alias("size"))
    nodes = _checkpoint(nodes.join(total, [*keys, "level", "label"]).select(*keys, "level", "node", "parent", "size"))
    # down the tree: a node's sizes are its own and its parent's
    sizes = done = nodes.where(F.col("level") == levels - 1).select(*keys, "level", "node", F.array("size").alias("sizes"))
    for k in range(levels - 2, -1, -1):
        above = sizes.select(*keys, F.col("node").alias("parent"), F.col("sizes").alias("more"))
        sizes = nodes.where(F.col("level") == k).join(above, [*keys, "parent"]).select(*keys, "level", "node", F.concat(F.array("size"), "more").alias("sizes"))
        done = done.unionByName(sizes)
    zeros = F.array_repeat(F.lit(0).cast("long"), F.col("level"))
    return pixels.join(done, [*keys, "level", "node"]).select(*keys, "r", "c", "level", F.concat(zeros, "sizes").alias("sizes"))


def build_stack(pixels: DataFrame, thresholds: list[float], keys: tuple[str, ...] = (), score: str = "distance", forest: str = "forest", greenness: str = "greenness_loss", gate_first: bool = False, tile: int = 512) -> DataFrame:
    """pixels of forest with greener (1 where greenness did not fall) and px array<long>, the size of the pixel's patch at each threshold (in the order given).

    A patch at a threshold is what lies together with a score of at least that in the forest; with gate_first also with a loss of greenness, as the
    detector counts them. Pixels below every threshold, masked ones and gated ones have zeros.
    """
    if not thresholds or any(a == b for a, b in zip(sorted(thresholds), sorted(thresholds)[1:], strict=False)):
        raise ValueError(f"thresholds have to differ: {thresholds}")
    falling = sorted(thresholds, reverse=True)
    inside = mask_and(F.col(score) >= falling[-1], F.col(forest))
    if gate_first:
        inside = mask_and(inside, F.col(greenness) > 0)
    level: Column = F.lit(len(falling) - 1)
    for k in range(len(falling) - 2, -1, -1):
        level = F.when(F.col(score) >= falling[k], k).otherwise(level)
    sized = component_tree(pixels.where(inside).select(*keys, "r", "c", level.alias("level")), len(falling), keys, tile)
    order = F.array(*(F.coalesce(F.col("sizes")[falling.index(t)], F.lit(0).cast("long")) for t in thresholds))
    out = pixels.where(F.col(forest)).join(sized.drop("level"), [*keys, "r", "c"], "left")
    return out.withColumn("greener", (F.col(greenness) <= 0).cast("int")).withColumn("px", order).drop("sizes")
