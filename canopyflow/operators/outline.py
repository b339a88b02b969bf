"""Outlines of components with their holes: sides of pixels, stitched to chains tile by tile, and chains tied to rings by pointer jumping.

A side that two pixels of a component share is nobody's border. The others are directed with the component on their right, and each has one
successor: the side that leaves where it ends, and where two pixels meet in a corner the one to the left, as they are joined. Successors are
followed inside a tile; what leaves a tile is a chain that points to the chain it runs into. Pointer jumping finds the ring of each
chain and its place in it in rounds that grow with the logarithm of a ring's chains, so no component's border meets in one task;
only a ring as a value is one row, as whoever writes it out needs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopyflow.operators.components import _checkpoint

#: Directions of a side: east, south, west, north; one less is a turn to the left.
STEP = ((0, 1), (1, 0), (0, -1), (-1, 0))
_POINT = "struct<r: long, c: long, d: int>"


def boundary(pixels: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, component, r0, c0, r1, c1): the pixel sides between a component and what is not it, directed with the component on the right."""
    r, c = F.col("r").cast("long"), F.col("c").cast("long")
    side = lambda a, b, x, y: F.struct(a.alias("r0"), b.alias("c0"), x.alias("r1"), y.alias("c1"))
    sides = F.explode(F.array(side(r, c, r, c + 1), side(r, c + 1, r + 1, c + 1), side(r + 1, c + 1, r + 1, c), side(r + 1, c, r, c))).alias("s")
    s = pixels.select(*keys, "component", sides).select(*keys, "component", "s.*")
    low, high = F.least(F.struct("r0", "c0"), F.struct(F.col("r1").alias("r0"), F.col("c1").alias("c0"))), F.greatest(F.struct("r0", "c0"), F.struct(F.col("r1").alias("r0"), F.col("c1").alias("c0")))
    # a side that two pixels of a component share comes twice, once each way
    once = s.withColumn("low", low).withColumn("high", high).groupBy(*keys, "component", "low", "high").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("r0", "c0", "r1", "c1")).alias("s"))
    return once.where("n = 1").select(*keys, "component", "s.*")


def follow(component: np.ndarray, r: np.ndarray, c: np.ndarray, d: np.ndarray) -> list[tuple[np.ndarray, bool, bool]]:
    """Chains of sides as indexes in order, (sides, closed, crossing): crossing if two sides of the component leave where the chain begins."""
    order = np.lexsort((d, c, r, component))
    at: dict[tuple[int, int, int], list[int]] = {}
    for i in order.tolist():
        at.setdefault((int(component[i]), int(r[i]), int(c[i])), []).append(i)
    after, before = np.full(len(r), -1), np.full(len(r), -1)
    for i in range(len(r)):
        dr, dc = STEP[d[i]]
        leaving = at.get((int(component[i]), int(r[i] + dr), int(c[i] + dc)), ())
        to = leaving[0] if len(leaving) == 1 else next((j for j in leaving if d[j] == (d[i] + 3) % 4), -1)
        if to >= 0:
            after[i], before[to] = to, i
    out, seen = [], np.zeros(len(r), bool)
    for i in [*np.flatnonzero(before < 0).tolist(), *order.tolist()]:
        if seen[i]:
            continue
        chain, j = [], i
        while j >= 0 and not seen[j]:
            seen[j] = True
            chain.append(j)
            j = int(after[j])
        out.append((np.array(chain), j == i, len(at[int(component[i]), int(r[i]), int(c[i])]) > 1))
    return out


def chains(sides: DataFrame, keys: tuple[str, ...] = (), tile: int = 512) -> DataFrame:
    """(keys, component, id, head, need, tail, way, points, sides, doubled): chains of sides within a tile.

    head: where it begins; need: the direction of a side that may run into it, -1 for any; tail and way: where it ends, and in which direction;
    points: its first place and each where it turns, with the direction that leaves; closed chains have no tail. doubled: twice its signed area.
    """
    kinds = ", ".join(f"{n} {t}" for n, t in sides.select(*keys, "component").dtypes)
    schema = f"{kinds}, id long, head {_POINT}, need int, tail {_POINT}, way int, points array<{_POINT}>, sides long, doubled long"
    way = F.when(F.col("c1") > F.col("c0"), 0).when(F.col("r1") > F.col("r0"), 1).when(F.col("c1") < F.col("c0"), 2).otherwise(3)

    def work(pdf):
        import pandas as pd

        r, c, d, own = pdf.r0.to_numpy(np.int64), pdf.c0.to_numpy(np.int64), pdf.d.to_numpy(np.int64), pdf.component.to_numpy(np.int64)
        step, rows = np.array(STEP), []
        for chain, closed, crossing in follow(own, r, c, d):
            cr, cc, cd = r[chain], c[chain], d[chain]
            er, ec = cr + step[cd, 0], cc + step[cd, 1]
            turn = np.flatnonzero(np.concatenate([[not closed or cd[0] != cd[-1]], cd[1:] != cd[:-1]]))
            points = [{"r": a, "c": b, "d": x} for a, b, x in zip(cr[turn].tolist(), cc[turn].tolist(), cd[turn].tolist(), strict=True)]
            first = {"r": int(cr[0]), "c": int(cc[0]), "d": int(cd[0])}
            rows.append({**{k: pdf[k].iat[0] for k in keys}, "component": own[chain[0]], "id": int(((cr[0] << 30) + cc[0]) * 4 + cd[0]), "head": first, "need": int((cd[0] + 1) % 4) if crossing else -1, "tail": None if closed else {"r": int(er[-1]), "c": int(ec[-1]), "d": 0}, "way": int(cd[-1]), "points": points, "sides": len(chain), "doubled": int((cc * er - ec * cr).sum())})
        return pd.DataFrame(rows, columns=[f.split()[0] for f in (*(f"{k} x" for k in keys), *"component,id,head,need,tail,way,points,sides,doubled".split(","))])

    placed = sides.withColumn("d", way)
    return placed.groupBy(*keys, F.floor(F.col("r0") / tile).alias("tr"), F.floor(F.col("c0") / tile).alias("tc")).applyInPandas(work, schema)


def rings(pixels: DataFrame, keys: tuple[str, ...] = (), tile: int = 512) -> DataFrame:
    """(keys, component, ring, area, sides, points): every closed ring of every component.

    points: (r, c) of its corners from the least one on, closed; area: in pixels, below 0 for a hole; ring: a number.
    """
    part = _checkpoint(chains(boundary(pixels, keys), keys, tile))
    whole, loose = part.where("tail is null"), part.where("tail is not null")
    end = loose.select(*keys, "component", F.col("id").alias("mine"), F.col("tail.r").alias("r"), F.col("tail.c").alias("c"), "way")
    start = loose.select(*keys, "component", F.col("id").alias("next"), F.col("head.r").alias("r"), F.col("head.c").alias("c"), "need", F.col("head.d").alias("leaves"))
    ties = end.join(start, [*keys, "component", "r", "c"]).where((F.col("need") == -1) | (F.col("need") == F.col("way")))
    ties = _checkpoint(ties.select(*keys, "component", F.col("mine").alias("id"), "next", (F.col("way") == F.col("leaves")).alias("straight")))
    own = [*keys, "component"]
    if not ties.isEmpty():
        # the least id of each ring, over stretches that double
        low = ties.select(*own, "id", "next", F.col("id").alias("ring"))
        rounds = 0
        while True:
            ahead = low.select(*own, F.col("id").alias("next"), F.col("next").alias("then"), F.col("ring").alias("other"))
            low = _checkpoint(low.join(ahead, [*own, "next"]).select(*own, "id", F.col("then").alias("next"), F.least("ring", "other").alias("ring"), (F.col("other") < F.col("ring")).alias("moved")), *([low] if rounds else []))
            rounds += 1
            moved = not low.where("moved").isEmpty()
            low = low.drop("moved")
            if not moved:
                break
        # steps from each chain to the last of its ring, the one that runs into the least
        far = ties.join(low.select(*own, "id", "ring"), [*own, "id"]).select(*own, "ring", "id", F.when(F.col("next") != F.col("ring"), F.col("next")).alias("next"), F.when(F.col("next") != F.col("ring"), 1).otherwise(0).cast("long").alias("steps"))
        far = _checkpoint(far)
        while not far.where("next is not null").isEmpty():
            ahead = far.select(*own, F.col("id").alias("next"), F.col("next").alias("then"), F.col("steps").alias("more"))
            far = _checkpoint(far.join(ahead, [*own, "next"], "left").select(*own, "ring", "id", F.col("then").alias("next"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), far)
        # a chain's first place is no corner if the chain before it runs straight into it
        run_in = ties.where("straight").select(*own, F.col("next").alias("id"), F.lit(True).alias("straight"))
        loose = loose.join(far.select(*own, "ring", "id", "steps"), [*own, "id"]).join(run_in, [*own, "id"], "left")
        points = F.when(F.col("straight"), F.slice("points", F.lit(2), F.greatest(F.size("points") - 1, F.lit(0)))).otherwise(F.col("points"))
        tied = loose.withColumn("points", points).groupBy(*own, "ring").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("steps")).alias("k"), F.col("points").alias("p")))), lambda x: x.p)).alias("points"), F.sum("sides").alias("sides"), F.sum("doubled").alias("doubled"))
        part = whole.select(*own, F.col("id").alias("ring"), "points", "sides", "doubled").unionByName(tied)
    else:
        part = whole.select(*own, F.col("id").alias("ring"), "points", "sides", "doubled")
    # from the least corner on
    at, p = F.array_position("points", F.array_min("points")), F.col("points")
    turned = F.concat(F.slice(p, at, F.size(p)), F.slice(p, F.lit(1), at - 1))
    corners = F.transform(turned, lambda x: F.struct(x.r.alias("r"), x.c.alias("c")))
    return part.select(*own, "ring", (F.col("doubled") / 2).alias("area"), "sides", F.concat(corners, F.slice(corners, 1, 1)).alias("points"))


def outlines(pixels: DataFrame, keys: tuple[str, ...] = (), tile: int = 512) -> DataFrame:
    """(keys, component, ring, inner, holes, sides): each component's outer ring as corners (r, c), and those of its holes in order of their least corner."""
    found = rings(pixels, keys, tile)
    hole = F.when(F.col("area") < 0, F.col("points"))
    out = found.groupBy(*keys, "component").agg(F.first(F.when(F.col("area") > 0, F.col("points")), ignorenulls=True).alias("ring"), F.array_sort(F.collect_list(hole)).alias("inner"), F.sum("sides").alias("sides"))
    return out.select(*keys, "component", "ring", "inner", F.size("inner").alias("holes"), "sides")


def text(points: Column) -> Column:
    """Corners as `r c, r c, ...`."""
    return F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p.r, p.c)), ", ")
