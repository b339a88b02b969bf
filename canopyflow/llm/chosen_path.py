"""N-gram Jaccard join by chosen paths.

Texts become sets of word n-grams, sketched by 128 min-hashes. A run splits all sets recursively: at each node some coordinates are sampled, by a
hash of the node, and a set goes to the child that its value there (a sampled token of it) names; one coordinate always, a second
with the chance that keeps the expected number of copies of a similar pair from falling. The first steps are taken together; a node with
few pairs that aren't of one component already is then a leaf, whose pairs are all compared by sketch, and one set alone, or sets of one
component, are dropped before anything is joined to them. A larger node goes on down, and all its sets are compared with its first one, the pivot: those so like it that all their partners are linked to it as well
are settled by that. The deeper a node lies, the less likeness to the pivot is asked for, so that this ends.
Runs are repeated until a pair at the threshold has met with the recall asked for, reckoned for the depth really reached (see met). Components
are formed after the first runs, which unite nearly all that there is to unite, and at the end.

What the sketches unite (four standard deviations below the threshold, so as to lose no pair, and far from what texts that only share a passage
reach) is a component of candidates. Inside it all pairs are compared exactly, on the n-grams of the whole texts, by blocks of
bounded bytes; only counts and the links that unite leave a task.

Defined results: texts are compared by their words [^\\x20\\x09-\\x0D]+, unchanged. A text of fewer words than an n-gram has one, all of
its words. A null text or one without words links with nothing, not even its like. Equal texts link. Rows that share a doc_id are
documents of their own; of a class, the least doc_id stays (of rows that repeat it, the first by text, once). A null doc_id sorts last and comes back null.
An empty table gives an empty result; very long texts are hashed a part at a time; columns other than id and text are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.llm._common import Scratch, components
from canopyflow.llm._repeats import flat, hashes, mix, prefix, words
from canopyflow.llm.projection_dedup import _unite

#: Coordinates of a sketch, steps taken together at first and later, runs made together at first and, at most, later.
COORDINATES, START, STEPS, FIRST, BATCH = 128, 3, 2, 4, 16
#: Pairs to compare in a leaf, and its sets, at most; a node beyond either goes on down.
LEAF_PAIRS, LEAF_SETS = 1 << 20, 1 << 13
#: Sets, and bytes of n-gram hashes, that a task of the exact comparison takes from each side.
BLOCK_SETS, BLOCK_BYTES = 1024, 4 << 20
_ODD = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def gram_hashes(sym: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words that lie one text after another, and where each text's begin; a shorter text has one of all its words."""
    count = np.diff(bounds)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(grams)])
    start = np.repeat(bounds[:-1] - at[:-1], grams) + np.arange(at[-1])
    end = np.minimum(start + n, np.repeat(bounds[1:], grams))
    return hashes(prefix(sym), start, end), at


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, node, grams, sketch): node is the text's hash, grams the number of its n-grams; rows without words have no sketch."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            data, at = flat(batch.column("text"))
            for s, e in _parts(at):
                sym, bounds = words(data[at[s] : at[e]], at[s : e + 1] - at[s])
                g, begins = gram_hashes(sym, bounds, n)
                full = np.flatnonzero(np.diff(begins))
                out = np.zeros((e - s, COORDINATES), "<u2")
                if len(full):
                    for i, odd in enumerate(_ODD):  # the low bits of the least product say which gram it is
                        out[full, i] = np.minimum.reduceat(g * odd, begins[full]) & np.uint64(0xFFFF)
                some = np.zeros(e - s, bool)
                some[full] = True
                col = pa.array([x.tobytes() if k else None for x, k in zip(out, some, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[s:e], batch.column("node")[s:e], pa.array(np.diff(begins), pa.int32()), col], names=["doc_id", "node", "grams", "sketch"])

    return docs.select("doc_id", "node", "text").mapInArrow(work, "doc_id long, node long, grams int, sketch binary")


def _parts(at: np.ndarray, size: int = 1 << 20):
    """Ranges of texts of about so many bytes together."""
    s = 0
    while s < len(at) - 1:
        e = max(s + 1, int(np.searchsorted(at, at[s] + size, "right")) - 1)
        yield s, e
        s = e


def _matrix(sketch) -> np.ndarray:
    return np.frombuffer(b"".join(sketch), "<u2").reshape(-1, COORDINATES)


def _step(keys: np.ndarray, sketch: np.ndarray, second: float):
    """(row, child key): one coordinate of each row, sampled by its node, and a second one for nodes whose hash says so."""
    rows = np.arange(len(keys))
    for b in range(2):
        h = mix(keys + np.uint64(0x632BE59BD9B4E019 * (b + 1) % 2**64))
        if b:
            rows = np.flatnonzero((h >> np.uint64(11)).astype(np.float64) / 2**53 < second)
        i = (h[rows] % np.uint64(COORDINATES)).astype(np.int64)
        yield rows, mix(h[rows] ^ mix(sketch[rows, i].astype(np.uint64) + (i.astype(np.uint64) << np.uint64(32))))


def descend(sets: DataFrame, threshold: float, runs: range | None = None) -> DataFrame:
    """(path, node, part), with runs: what the first steps of each run reach from the root; else (path, node, part, sketch): the rows' paths some steps on."""
    second, new = 1 / threshold - 1, runs is not None

    def work(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            sketch, node, part = _matrix(pdf.sketch), pdf.node.to_numpy(), pdf.part.to_numpy()
            for r in runs if new else [None]:
                keys = np.full(len(pdf), mix(np.array([r + 1], np.uint64) * _ODD[0])[0]) if new else pdf.path.to_numpy().view(np.uint64)
                rows = np.arange(len(pdf))
                for _ in range(START if new else STEPS):
                    steps = [(rows[i], child) for i, child in _step(keys, sketch[rows], second)]
                    rows, keys = (np.concatenate(x) for x in zip(*steps, strict=True))
                out = pd.DataFrame({"path": keys.view(np.int64), "node": node[rows], "part": part[rows]})
                yield out if new else out.assign(sketch=pdf.sketch.to_numpy()[rows])

    return sets.mapInPandas(work, "path long, node long, part long" + ", sketch binary" * (not new))


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label, with those of a and b that stand side by side, and what they lead to, made one."""
    while len(a):
        to = np.arange(int(label.max()) + 1)
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
        while (to != (further := to[to])).any():
            to = further
        label, a, b = to[label], to[a], to[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return label


def leaf_links(rows: DataFrame, floor: float) -> DataFrame:
    """(u, v): for (path, node, part, sketch), sorted by path, pairs of one path and of different parts whose sketches agree in at least
    that share, as far as they unite."""

    def work(batches):
        left, parent = None, {}

        def compare(path, node, part, sketch):
            if not len(path):
                return pd.DataFrame({"u": [], "v": []}, dtype="int64")
            # rows of one path and one part, and later those that a link has joined, share a label and need no comparing
            order = np.lexsort((part, path))
            new = np.concatenate([[0], (np.diff(path[order]) != 0) | (np.diff(part[order]) != 0)])
            label, links, d, live = np.empty(len(path), np.int64), [], 1, np.arange(len(path) - 1)
            label[order] = np.cumsum(new)
            while len(live):
                live = live[live + d < len(path)]
                live = live[path[live] == path[live + d]]
                can = live[label[live] != label[live + d]]
                for i in np.array_split(can, len(can) // 16_384 + 1):
                    hit = i[np.count_nonzero(sketch[i] == sketch[i + d], axis=1) >= floor * COORDINATES]
                    links += list(_unite(zip(node[hit].tolist(), node[hit + d].tolist(), strict=True), parent))
                    label = joined(label, label[hit], label[hit + d])
                d += 1
            return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

        for pdf in batches:
            if not len(pdf):
                continue
            now = (*(pdf[c].to_numpy() for c in ("path", "node", "part")), _matrix(pdf.sketch))
            if left is not None:
                now = tuple(np.concatenate([a, b]) for a, b in zip(left, now, strict=True))
            cut = int(np.searchsorted(now[0], now[0][-1], "left"))
            left = tuple(x[cut:] for x in now)
            if len(parent) > 500_000:
                parent.clear()
            yield compare(*(x[:cut] for x in now))
        if left is not None:
            yield compare(*left)

    ordered = rows.repartition("path").sortWithinPartitions("path", "node")
    return ordered.mapInPandas(work, "u long, v long")


def met(threshold: float, depth: int, runs: int) -> float:
    """The chance that a pair at the threshold has stood in one node of that depth in some run.

    How many coordinates of the pair's sketches agree is binomial; given that, its copies are a branching process with one or two trials a step.
    """
    a = np.arange(COORDINATES + 1) / COORDINATES
    weight = np.array([math.comb(COORDINATES, k) * threshold**k * (1 - threshold) ** (COORDINATES - k) for k in range(COORDINATES + 1)])
    second, alive = min(1.0, 1 / threshold - 1) * (1 - 1 / COORDINATES), np.ones(COORDINATES + 1)
    for _ in range(depth):
        lost = 1 - a * alive
        alive = 1 - (1 - second) * lost - second * lost * lost
    return float((weight * (1 - (1 - alive) ** runs)).sum())


def runs_for(threshold: float, depth: int, recall: float) -> int:
    """The least number of runs with which met reaches the recall."""
    runs = 1
    while met(threshold, depth, runs) < recall:
        runs += 1
    return runs


def agreement(a: str, b: str):
    """The share of coordinates that agree."""

    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(np.count_nonzero(_matrix(x) == _matrix(y), axis=1) / COORDINATES, dtype="float64")

    return share(F.col(a), F.col(b))


def run_links(sets: DataFrame, groups: DataFrame | None, threshold: float, runs: range, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame | None, int]:
    """(u, v) of nodes that some leaf or pivot of these runs unites, (node) of those that went deeper than the first steps, and the depth reached.

    groups: (node, component) of nodes united before.
    """
    deviation = math.sqrt(threshold * (1 - threshold) / COORDINATES)
    floor = max(0.1, threshold - 4 * deviation)
    start = sets.select("node", "sketch")
    start = start.withColumn("part", F.col("node")) if groups is None else start.join(groups, "node", "left").select("node", "sketch", F.coalesce("component", "node").alias("part"))
    deep, paths, depth, leaves, links = None, scratch.save(descend(start, threshold, runs), f"{name}-paths{START}"), START, [], []
    while True:
        # a node with one set, or with sets that are united already, has no pair to compare and ends here
        if groups is None:
            sizes = paths.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.count(F.lit(1)).alias("same"), F.min("node").alias("pivot"))
        else:
            sizes = paths.groupBy("path", "part").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"))
            sizes = sizes.groupBy("path").agg(F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("same"), F.min("low").alias("pivot"))
        pairs = (F.col("size") * F.col("size") - F.col("same")) / 2
        sizes = sizes.where(pairs > 0).select("path", "pivot", ((pairs <= LEAF_PAIRS) & (F.col("size") <= LEAF_SETS)).alias("leaf"))
        sizes = scratch.save(sizes, f"{name}-sizes{depth}")
        here = paths.join(sizes, "path")
        if depth == START:  # from here on the few rows left carry their sketches
            here = here.join(sets.select("node", "sketch"), "node")
        here = scratch.save(here, f"{name}-here{depth}")
        scratch.drop(f"{name}-paths{depth}")
        leaves.append(here.where("leaf").select("path", "node", "part", "sketch"))
        if sizes.where("not leaf").isEmpty():
            break
        large = here.where("not leaf").select("path", "node", "part", "pivot", "sketch")
        deep = scratch.save(large.select("node").distinct(), f"{name}-deep") if deep is None else deep
        # partners of a set this like the pivot agree with the pivot in `near` themselves, but for 3.3 deviations
        near = max(0.2, floor - 0.04 * (depth - START))
        pivots = large.where("node = pivot").select("path", F.col("sketch").alias("first")).dropDuplicates(["path"])
        large = scratch.save(large.join(pivots, "path").where("node <> pivot").withColumn("like", agreement("sketch", "first")).drop("first"), f"{name}-likes{depth}")
        links.append(large.where(F.col("like") >= near).select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct())
        rest = large.where(F.col("like") < near + 1 - threshold + 3.3 * deviation)
        depth += STEPS
        paths = scratch.save(descend(rest.select("path", "node", "part", "sketch"), threshold), f"{name}-paths{depth}")
    every = leaves[0]
    for x in leaves[1:]:
        every = every.unionByName(x)
    found = leaf_links(every, floor)
    for x in links:
        found = found.unionByName(x)
    found = scratch.save(found, f"{name}-links")
    scratch.drop(*(f"{name}-{what}{d}" for what in ("sizes", "here", "likes") for d in range(START, depth + 1, STEPS)))
    return found, deep, depth


def candidate_groups(sets: DataFrame, threshold: float, recall: float, scratch: Scratch) -> DataFrame:
    """(node, component) of sets that may have a partner, of runs repeated until the recall is reached.

    A pair that stands in one node after the first steps has met, unless that node is large, and then both sets go deeper. So all sets take
    the runs that the first steps ask for, and those the depth reached asks for beyond them are for sets that once went deeper.
    """
    groups, links, runs, deepest, deep = None, [], 0, START, None
    every = runs_for(threshold, START, recall)
    while runs < (most := every if deep is None else runs_for(threshold, deepest, recall)):
        some = sets if runs < every else scratch.save(sets.join(deep.distinct(), "node", "left_semi"), f"run{runs}-sets")
        turn = range(runs, min(runs + (BATCH if runs else FIRST), every if runs < every else most))
        found, went, depth = run_links(some, groups, threshold, turn, scratch, f"run{runs}")
        if groups is None:
            groups = components(found, scratch, name="first").withColumnRenamed("id", "node")
        else:
            links.append(found)
        deep = went if deep is None else deep if went is None else deep.unionByName(went)
        runs, deepest = turn.stop, max(deepest, depth)
    links = [x for x in links if not x.isEmpty()]
    if not links:
        return groups
    edges = groups.select(F.col("node").alias("u"), F.col("component").alias("v"))
    for x in links:
        edges = edges.unionByName(x)
    return components(edges, scratch, name="near").withColumnRenamed("id", "node")


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of a shares with each of b; the sets are sorted and distinct."""
    every, which = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    rows = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    # a column that one row alone holds adds nothing
    used = np.bincount(which, minlength=len(every)) > 1
    number = np.cumsum(used) - 1
    keep = used[which]
    rows, cols = rows[keep], number[which[keep]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for s in range(0, int(used.sum()), 4096):
        i, j = np.searchsorted(cols, [s, s + 4096])
        m = np.zeros((len(a) + len(b), 4096), np.float32)
        m[rows[i:j], cols[i:j] - s] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return out.astype(np.int64)


def exact_links(members: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """(u, links, v): for (component, node, weight, grams), each node's links (sum of the weights, v null), and links that unite (v not null).

    sizes (component, size, bytes) says how many blocks a component is cut into; every pair of blocks is a task, and small components share tasks.
    """
    shared = max(8, -(-sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first().n // BLOCK_BYTES))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_SETS, F.least(F.col("size"), F.col("bytes") / BLOCK_BYTES))).cast("int")
    m = members.join(sizes.select("component", blocks.alias("blocks")), "component")
    m = m.withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")))
    m = m.select("component", "node", "weight", "grams", "own", "other", task.alias("task"))

    def work(pdf):
        us, links, vs, parent = [], [], [], {}

        def add(u, n, v=None):
            us.append(np.asarray(u, np.int64))
            links.append(np.broadcast_to(np.asarray(n, np.int64), us[-1].shape))
            vs.append(np.ma.masked_all(us[-1].shape, np.int64) if v is None else np.ma.array(np.asarray(v, np.int64), mask=np.zeros(len(v), bool)))

        for _, g in pdf.groupby(["component", np.minimum(pdf.own, pdf.other), np.maximum(pdf.own, pdf.other)], sort=False):
            two = bool((g.own != g.other).any())
            a = g[g.own < g.other] if two else g
            b = g[g.own > g.other] if two else g
            sa, sb = ([np.frombuffer(x, np.int64) for x in part.grams] for part in (a, b))
            if not sa or not sb:
                continue
            both = intersections(sa, sb)
            union = np.array([len(x) for x in sa])[:, None] + np.array([len(x) for x in sb])[None, :] - both
            near = both >= threshold * union - 1e-9
            if not two:
                np.fill_diagonal(near, False)
            na, nb = a.node.to_numpy(), b.node.to_numpy()
            add(na, near @ b.weight.to_numpy())
            if two:
                add(nb, near.T @ a.weight.to_numpy())
            i, j = np.nonzero(near)
            ties = list(_unite(zip(na[i].tolist(), nb[j].tolist(), strict=True), parent))
            add([x for x, _ in ties], 0, [y for _, y in ties])
        if not us:
            add([], 0)
        v = np.ma.concatenate(vs)
        return pd.DataFrame({"u": np.concatenate(us), "links": np.concatenate(links), "v": pd.arrays.IntegerArray(v.data, np.ma.getmaskarray(v).copy())})

    return m.groupBy("task").applyInPandas(work, "u long, links long, v long")


def jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, class_id (least doc_id of the class), n_links (other documents at the threshold or above), kept (one row of each class)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("node"), text.alias("text"))
    rows = scratch.save(sketches(base, n).withColumn("rid", F.monotonically_increasing_id()), "sketches")
    sets = rows.where("sketch is not null").groupBy("node").agg(F.count(F.lit(1)).alias("weight"), F.min("doc_id").alias("holder"), F.min("grams").alias("grams"), F.min("sketch").alias("sketch"))
    sets = scratch.save(sets, "sets")
    near = candidate_groups(sets, threshold, recall, scratch)
    members = scratch.save(sets.select("node", "weight", "holder", "grams").join(near, "node"), "members")
    sizes = scratch.save(members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("grams").cast("long") * 8).alias("bytes")), "sizes")

    def grams(batches):
        import pyarrow as pa

        for batch in batches:
            data, at = flat(batch.column("text"))
            col = []
            for s, e in _parts(at):
                g, begins = gram_hashes(*words(data[at[s] : at[e]], at[s : e + 1] - at[s]), n)
                col += [np.unique(g[i:j]).view(np.int64).tobytes() for i, j in zip(begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("component", "node", "weight")), pa.array(col, pa.binary())], names=["component", "node", "weight", "grams"])

    # one row holds the text of each node: that of the least doc_id; members grow with the documents, so at no size are they broadcast
    holders = base.join(members.hint("merge"), (base.node == members.node) & base.doc_id.eqNullSafe(members.holder)).select("component", members.node, "weight", "text")
    holders = holders.mapInArrow(grams, "component long, node long, weight long, grams binary")
    if not rows.groupBy("node", "doc_id").count().where("count > 1").isEmpty():
        holders = holders.dropDuplicates(["node"])
    exact = exact_links(holders, sizes, threshold)
    exact = scratch.save(exact, "exact")
    counts = exact.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(exact.where("v is not null").select("u", "v"), scratch, name="classes").withColumnRenamed("id", "node")
    final = sets.select("node", "weight", "holder").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node")).join(counts, "node", "left")
    least = final.groupBy("component").agg(F.min("holder").alias("class_id"))
    final = final.join(least, "component").select("node", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    final = scratch.save(final, "final")
    out = rows.select("doc_id", "rid", F.col("node").alias("text_hash"), (F.col("sketch").isNotNull()).alias("has")).join(final, (F.col("text_hash") == F.col("node")) & F.col("has"), "left")
    out = out.select("doc_id", "text_hash", "rid", "has", "component", F.when(F.col("has"), F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    # of a class the row with the least id stays; rows that repeat that id are told apart by text and then by place
    one = out.where(F.col("has") & F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("component").agg(F.min(F.struct("text_hash", "rid")).alias("one")).select("component", F.col("one.rid").alias("at"))
    out = out.join(one, "component", "left")
    return out.select("doc_id", "text_hash", "class_id", "n_links", F.when(F.col("has"), F.col("rid") == F.col("at")).otherwise(True).alias("kept"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "n_links", "kept")


OP4_SQL = r"""
WITH RECURSIVE ws AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, len(ws) AS total, unnest(ws) AS word FROM ws),
win AS (SELECT doc_id, total, string_agg(word, ' ') OVER ahead AS gram, count(*) OVER ahead AS n
        FROM w WINDOW ahead AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
grams AS (SELECT DISTINCT doc_id, gram FROM win WHERE n = least(total, 5)),
size AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM both_ JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE both_.n >= 0.8 * (x.n + y.n - both_.n)),
reach AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
low AS (SELECT u, min(v) AS low FROM reach GROUP BY u), many AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, coalesce(n, 0) AS n_links, doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN low ON doc_id = low.u LEFT JOIN many ON doc_id = many.u
"""
