"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is grown on a bounded sample; every row is then put into the leaf that it falls to. A query walks the tree with a priority
queue, always opening the node whose centre promises the largest inner product, and so orders the leaves. How many leaves a search
visits is calibrated: for some queries the true neighbours are found by brute force (in blocks of rows, each keeping its best), and visits
widen until the recall asked for is reached, to all leaves if need be. Visits go in rounds of four times as many leaves, and each round returns
only what beats the bound that a query has from those before: some dozens of rows a query and round, however many leaves.
Neighbouring leaves are bundled into units of bounded rows, so that a query is sent to a unit once; a leaf that holds more, such as copies of one
vector, is dealt over several units by hash of the id.

Defined results: rows that take no part (see _vectors.valid, and a null id) are neither queries nor candidates; rows that repeat an id are all
candidates, but a query finds an id once, by its nearest row, and never its own; queries that share an id find what any of them finds; with
fewer candidates than asked for, all are returned, and an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopyflow.llm._common import Scratch
from canopyflow.llm._vectors import lengths, matrix, valid

#: Bounds: rows that the tree is grown on, queries that calibrate, rows of a unit, queries that walk the tree or visit a unit together.
SAMPLE, CALIBRATE, UNIT, TOGETHER = 20_000, 128, 8_192, 256
#: Leaves of the first round of visits, and how many times as many each next one takes.
FIRST, WIDER = 4, 4
#: Queries that one task compares with a unit at the most, about.
CALLED = 16_384
BRANCH, LEAF = 8, 256


class Tree:
    """Nodes in arrays: centre, children (none for a leaf), leaf number."""

    def __init__(self):
        self.centres, self.children, self.leaf = [], [], []

    def order(self, q: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves in the order of a best-bin-first walk."""
        out, heap = [], [(0.0, 0)]
        while heap and (most is None or len(out) < most):
            _, n = heapq.heappop(heap)
            while self.children[n]:
                kids = self.children[n]
                at = self.stack[n] @ q
                best = int(np.argmax(at))
                for i, k in enumerate(kids):
                    if i != best:
                        heapq.heappush(heap, (-float(at[i]), k))
                n = kids[best]
            out.append(self.leaf[n])
        return out

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row falls to: at each node the nearest centre."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            n, rows = todo.pop()
            if not self.children[n]:
                out[rows] = self.leaf[n]
                continue
            c = self.stack[n]
            near = np.argmin((c * c).sum(1) - 2 * x[rows] @ c.T, axis=1)
            todo += [(k, rows[near == i]) for i, k in enumerate(self.children[n])]
        return out

    def finish(self) -> Tree:
        self.stack = [np.array([self.centres[k] for k in kids]) if kids else None for kids in self.children]
        self.leaves = max(self.leaf) + 1
        return self


def grow(x: np.ndarray, per_leaf: int, branch: int = BRANCH, seed: int = 7) -> Tree:
    """k-means in each node until it has at most per_leaf rows or these can't be told apart."""
    rng, tree, leaves = np.random.default_rng(seed), Tree(), 0
    todo = [(None, np.arange(len(x)))]
    while todo:
        parent, rows = todo.pop()
        n = len(tree.centres)
        tree.centres.append(x[rows].mean(0))
        tree.children.append([])
        tree.leaf.append(-1)
        if parent is not None:
            tree.children[parent].append(n)
        parts = []
        if len(rows) > per_leaf:
            y = x[rows]
            c = y[rng.choice(len(y), min(branch, len(y)), replace=False)]
            for _ in range(8):
                near = np.argmin((c * c).sum(1) - 2 * y @ c.T, axis=1)
                c = np.array([y[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
            near = np.argmin((c * c).sum(1) - 2 * y @ c.T, axis=1)
            parts = [rows[near == i] for i in range(len(c)) if (near == i).any()]
        if len(parts) > 1:
            todo += [(n, p) for p in parts]
        else:
            tree.leaf[n] = leaves
            leaves += 1
    return tree.finish()


def best(q: np.ndarray, qids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, bound: np.ndarray | None = None, seen: np.ndarray | None = None):
    """(query row, id, score) of the k largest inner products of each query, ties to the smaller id, none below its bound.

    seen: which rows a query may look at. Scores are summed the same way for every row, so equal vectors have equal scores.
    """
    out = []
    for s in range(0, len(q), TOGETHER):
        got = q[s : s + TOGETHER] @ x.T
        got[qids[s : s + TOGETHER, None] == ids[None, :]] = -np.inf
        if seen is not None:
            got[~seen[s : s + TOGETHER]] = -np.inf
        least = np.partition(got, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(got), -np.inf)
        if bound is not None:
            least = np.maximum(least, bound[s : s + TOGETHER])
        slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(least), least, 1.0)))
        i, j = np.nonzero((got >= (least - slack)[:, None]) & (got > -np.inf))
        exact = np.concatenate([(x[b] * q[s + a]).sum(1) for a, b in zip(np.array_split(i, len(i) // 65_536 + 1), np.array_split(j, len(j) // 65_536 + 1), strict=True)])
        order = np.lexsort((ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        out.append((i[keep] + s, ids[j[keep]], exact[keep]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


FOUND = "query_id long, vec_id long, score double"


def _top(found: DataFrame, k: int) -> DataFrame:
    """found ranked within each query, the k first."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def brute_force(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Exact neighbours of a bounded set of queries (it is sent to every task): each block of rows returns its best."""
    held = rows.sparkSession.sparkContext.broadcast([(r.vec_id, r.v) for r in queries.collect()])

    def work(batches):
        import pandas as pd

        qids, q = np.array([i for i, _ in held.value], np.int64), np.array([v for _, v in held.value], np.float64)
        for pdf in batches:
            if len(pdf) and len(q):
                i, ids, s = best(q, qids, matrix(pdf.v), pdf.vec_id.to_numpy(), k)
                yield pd.DataFrame({"query_id": qids[i], "vec_id": ids, "score": s})

    return _top(rows.mapInPandas(work, FOUND), k)


def nearest(rows: DataFrame, queries, k: int = 20, recall: float = 0.97, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): neighbours, by inner product, of the rows that the condition `queries` on vec_id picks, among all other rows."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "ann")
    data = scratch.save(valid(rows, id_col, vec_col), "vectors")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for d in lengths(data):  # vectors of different lengths have no product
        out = out.unionByName(_nearest(data.where(F.size("v") == d), queries, k, recall, Scratch(spark, f"ann{d}")))
    scratch.drop("vectors")
    return out


def _nearest(data: DataFrame, queries, k: int, recall: float, scratch: Scratch) -> DataFrame:
    spark, total = data.sparkSession, data.count()
    sample = data.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(SAMPLE).collect()
    tree = grow(np.array([r.v for r in sample], np.float64), max(8, LEAF * len(sample) // max(total, len(sample))))
    del sample
    held = spark.sparkContext.broadcast(tree)

    def place(batches):
        for pdf in batches:
            yield pdf.assign(leaf=held.value.assign(matrix(pdf.v)) if len(pdf) else np.zeros(0, np.int32))

    placed = scratch.save(data.mapInPandas(place, "vec_id long, v array<double>, leaf int"), "placed")
    # a row for each leaf, of which the sample bounds the number
    units = unit_of_leaf({r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()})
    dealt = F.broadcast(spark.createDataFrame([(leaf, u, n) for leaf, (u, n) in units.items()], "leaf int, unit int, parts int"))
    index = placed.join(dealt, "leaf").select("vec_id", "v", "leaf", (F.col("unit") + F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("parts"))).cast("int").alias("unit"))
    asked = scratch.save(data.where(queries), "asked")

    # calibration
    some = scratch.save(asked.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(CALIBRATE), "calibrating")
    truth = brute_force(some, data, k).join(placed.select("vec_id", "leaf").distinct(), "vec_id").select("query_id", "leaf").collect()
    at: dict[int, dict[int, int]] = {r.vec_id: {leaf: n for n, leaf in enumerate(tree.order(np.array(r.v)))} for r in some.collect()}
    needed = np.sort([at[r.query_id][r.leaf] + 1 for r in truth]) if truth else np.array([tree.leaves])
    visits = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])

    def walk(lo: int, hi: int):
        """(unit, queries, vectors, bounds, leaves): what a group of queries has to visit in a unit, between two places of its walk."""

        def work(batches):
            import pandas as pd

            for pdf in batches:
                for s in range(0, len(pdf), TOGETHER):
                    part = pdf.iloc[s : s + TOGETHER]
                    q, ids, bound = matrix(part.v), part.vec_id.to_numpy(), part.bound.to_numpy()
                    by: dict[int, dict[int, list[int]]] = {}
                    for i, v in enumerate(q):
                        for leaf in held.value.order(v, hi)[lo:]:
                            u, n = units.get(leaf, (0, 0))
                            for x in range(u, u + n):
                                by.setdefault(x, {}).setdefault(i, []).append(leaf)
                    rows = []
                    for x, wanted in by.items():
                        i = list(wanted)
                        rows.append((x, ids[i].tobytes(), q[i].tobytes(), bound[i].tobytes(), np.array([len(w) for w in wanted.values()], np.int64).tobytes(), np.array([leaf for w in wanted.values() for leaf in w], np.int64).tobytes()))
                    yield pd.DataFrame(rows, columns=["unit", "qids", "qs", "bounds", "counts", "leaves"])

        return work

    def visit(key, left, right):
        import pandas as pd

        parts = []
        if len(right):
            x, ids, leaf = matrix(right.v), right.vec_id.to_numpy(), right.leaf.to_numpy()
            known, where = np.unique(leaf, return_inverse=True)
            for r in left.itertuples(index=False):
                qids, counts, leaves = (np.frombuffer(b, np.int64) for b in (r.qids, r.counts, r.leaves))
                visits = np.zeros((len(qids), len(known)), bool)
                at = np.minimum(np.searchsorted(known, leaves), len(known) - 1)
                ok = known[at] == leaves
                visits[np.repeat(np.arange(len(qids)), counts)[ok], at[ok]] = True
                i, found, s = best(np.frombuffer(r.qs, np.float64).reshape(len(qids), -1), qids, x, ids, k, np.frombuffer(r.bounds, np.float64), visits[:, where])
                parts.append(pd.DataFrame({"query_id": qids[i], "vec_id": found, "score": s}))
        return pd.concat(parts) if parts else pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    out, lo, hi = None, 0, min(visits, FIRST)
    while lo < visits:
        if out is None:
            q = asked.withColumn("bound", F.lit(float("-inf")))
        else:
            worst = out.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("s")).otherwise(float("-inf")).alias("bound"))
            q = asked.join(worst, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        # the walk is dealt over tasks by number, which no later planning folds together
        calls = q.repartition(max(8, -(-total // (20 * TOGETHER))), "vec_id").mapInPandas(walk(lo, hi), "unit int, qids binary, qs binary, bounds binary, counts binary, leaves binary")
        calls = scratch.save(calls, f"calls{hi}")
        # a unit that very many queries visit is a task for each so many of them
        parts = calls.groupBy("unit").agg(F.ceil(F.sum(F.length("qids")) / (8 * CALLED)).cast("int").alias("parts"))
        left = calls.join(parts, "unit").withColumn("part", F.pmod(F.xxhash64("qids"), F.col("parts")).cast("int")).drop("parts")
        right = index.join(parts, "unit").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        new = left.groupBy("unit", "part").cogroup(right.groupBy("unit", "part")).applyInPandas(visit, FOUND)
        # one of the rows of an id counts, the nearest
        new = (new if out is None else out.unionByName(new)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        out = scratch.save(_top(new, k).drop("rank"), f"found{hi}")
        scratch.drop(f"calls{hi}", f"found{lo}")
        lo, hi = hi, min(visits, hi * WIDER)
    scratch.keep(f"found{lo}")
    return _top(out, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def unit_of_leaf(rows: dict[int, int]) -> dict[int, tuple[int, int]]:
    """By leaf its first unit and how many it is dealt over; leaves that follow one another in the tree share a unit while they fit."""
    out, unit, held = {}, 0, 0
    for leaf in sorted(rows):
        n = rows[leaf]
        if held and held + n > UNIT:
            unit, held = unit + 1, 0
        parts = max(1, -(-n // UNIT))
        out[leaf] = (unit, parts)
        if parts > 1:
            unit, held = unit + parts, 0
        else:
            held += n
    return out


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
