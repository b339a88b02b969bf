"""Embedding near-dedup by sorted projection passes.

Exact copies are joined first. In each pass every vector gets the signs of random projections, joined into one number; Spark sorts the
vectors by it and each is compared with a bounded window of those after it. Signs are of the vectors less the mean of all, as a common part
would make them alike; the cosine is of the vectors themselves. Pairs that it confirms are united across passes. The first passes follow
from the number of vectors, the window, the cosine left to a pair at the threshold without the mean, and the recall wanted. A bounded set of
vectors is then compared with all, and passes are added until their partners stand in their components in that share, at every size of table
alike; MOST passes that don't reach it are an error. Vectors of each length are sorted apart. Windows reach over the ends of partitions: the rows at both
ends are compared once more with those of the next one. A window can't
hold all partners of a vector in a large group, so links are then counted exactly, block by block, within each component found.

Defined results: a vector that takes no part (see _vectors.valid) links with nothing and is its own component; a null vec_id takes no part
and its component_id is null; rows that share a vec_id are linked as the vectors that they are and have one component; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.llm._common import Scratch, components
from canopyflow.llm._vectors import lengths, matrix, valid

WINDOW, BITS, BLOCK = 64, 48, 512
#: Passes made together, and vectors compared with all to measure the recall.
ROUND, QUERIES = 64, 2_048
#: Passes after which recall that is still missed is an error.
MOST = 4_096
#: Members of small components that share a task, about.
SHARED = 4_096


def passes_for(n: int, threshold: float, window: int, recall: float) -> int:
    """Passes after which a pair at the threshold has stood within a window with the probability asked for.

    Two vectors agree in one sign with probability 1 - angle / pi; with n vectors, about log2(n / window) leading signs decide.
    """
    agree = (1 - math.acos(threshold) / math.pi) ** max(0.0, math.log2(max(n, 1) / window) + 1)
    return max(2, math.ceil(math.log(1 - recall) / math.log(max(1 - agree, 1e-9)))) if agree < 1 else 2


def _unite(pairs, parent: dict[int, int]):
    """The pairs that join what was apart, so that a task sends on fewer links than it has vectors."""

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            yield a, b


def mean_vector(vectors: DataFrame) -> np.ndarray:
    """The mean of the vectors, each at length 1."""

    def add(batches):
        import pandas as pd

        for pdf in batches:
            if len(pdf):
                x = matrix(pdf.v)
                yield pd.DataFrame({"n": [len(x)], "s": [(x / np.sqrt((x * x).sum(1))[:, None]).sum(0)]})

    parts = vectors.select("v").mapInPandas(add, "n long, s array<double>").select("n", F.posexplode("s").alias("i", "s"))
    sums = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return np.array([r.s / r.n for r in sums])


def measured(named: DataFrame, queries: list, threshold: float, window: int) -> float:
    """The least of two shares of partners that stand in their query's component, for named (node, v, component): of all partners, and the
    mean over the queries whose partners fit a window, as large groups would outweigh them."""
    at = {r.node: i for i, r in enumerate(queries)}
    own = {r.node: r.component for r in named.join(F.broadcast(named.sparkSession.createDataFrame([(k,) for k in at], "node long")), "node").select("node", "component").collect()}
    ids, q = np.array(list(at)), matrix_of(queries)
    comp = np.array([own[k] for k in at])

    def count(batches):
        import pandas as pd

        partners, met = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for pdf in batches:
            if not len(pdf):
                continue
            x, node, c = matrix(pdf.v), pdf.node.to_numpy(), pdf.component.to_numpy()
            x = x / np.sqrt((x * x).sum(1))[:, None]
            for s in range(0, len(x), BLOCK):
                i, j = np.nonzero(x[s : s + BLOCK] @ q.T >= threshold)
                i += s
                i, j = i[node[i] != ids[j]], j[node[i] != ids[j]]
                partners += np.bincount(j, minlength=len(ids))
                met += np.bincount(j[c[i] == comp[j]], minlength=len(ids))
        some = np.flatnonzero(partners)
        yield pd.DataFrame({"i": some, "partners": partners[some], "met": met[some]})

    found = named.select("node", "v", "component").mapInPandas(count, "i long, partners long, met long")
    found = found.groupBy("i").agg(F.sum("partners").alias("partners"), F.sum("met").alias("met"))
    few = F.when(F.col("partners") <= window, F.col("met") / F.col("partners"))
    r = found.agg((F.sum("met") / F.sum("partners")).alias("all"), F.avg(few).alias("few")).first()
    return min((x for x in (r["all"], r.few) if x is not None), default=1.0)


def matrix_of(rows: list) -> np.ndarray:
    """The vectors of collected rows, each at length 1."""
    x = np.array([r.v for r in rows], np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def candidate_links(vectors: DataFrame, threshold: float, passes: range, window: int, mean: np.ndarray, scratch: Scratch, name: str, seed: int = 11) -> DataFrame:
    """(u, v): confirmed pairs of (node, v) that unite what the passes find."""

    def sign(batches):
        import pandas as pd

        for pdf in batches:
            x = matrix(pdf.v)
            x = x / np.sqrt((x * x).sum(1))[:, None] - mean if len(pdf) else x
            for p in passes if len(pdf) else ():
                planes = np.random.default_rng([seed, p]).standard_normal((x.shape[1], BITS))
                bits = (x @ planes > 0).astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                yield pd.DataFrame({"turn": p, "sig": bits, "node": pdf.node, "v": pdf.v})

    def near(x, ids, turn, own=None):
        """Confirmed pairs within the window; own: only pairs of rows of two partitions."""
        for d in range(1, min(window, len(ids) - 1) + 1):
            close = ((x[:-d] * x[d:]).sum(1) >= threshold) & (turn[:-d] == turn[d:])
            close = np.flatnonzero(close if own is None else close & (own[:-d] != own[d:]))
            yield from zip(ids[close].tolist(), ids[close + d].tolist(), strict=True)

    def compare(batches):
        import pandas as pd
        from pyspark import TaskContext

        part, head, tail, parent = TaskContext.get().partitionId(), None, None, {}
        for pdf in batches:
            if not len(pdf):
                continue
            x, ids, turn = matrix(pdf.v), pdf.node.to_numpy(), pdf.turn.to_numpy()
            x = x / np.sqrt((x * x).sum(1))[:, None]
            if head is None or len(head) < window:
                head = pd.concat([head, pdf])[:window] if head is not None else pdf[:window]
            last = pd.concat([last, pdf])[-window:] if tail is not None else pdf[-window:]
            if tail is not None:
                x, ids, turn = (np.concatenate([a, b]) for a, b in zip(tail, (x, ids, turn), strict=True))
            links = list(near(x, ids, turn))
            tail = x[-window:], ids[-window:], turn[-window:]
            if len(parent) > 1_000_000:
                parent = {}
            out = pd.DataFrame(list(_unite(links, parent)), columns=["u", "v"], dtype="int64").reindex(columns=names)
            yield out.assign(e=np.full(len(out), None, object))
        if head is not None:  # what the neighbouring partitions have to see
            for seam, some in ((part - 1, head), (part, last)):
                yield pd.DataFrame({"u": some.node, "seam": seam, "part": part, "turn": some.turn, "sig": some.sig, "e": some.v}).reindex(columns=names)

    def over_seam(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["turn", "sig", "u"], kind="stable")
        x = matrix(pdf.e)
        links = near(x / np.sqrt((x * x).sum(1))[:, None], pdf.u.to_numpy(), pdf.turn.to_numpy(), pdf.part.to_numpy())
        return pd.DataFrame(list(_unite(links, {})), columns=["u", "v"], dtype="int64")

    names = ["u", "v", "seam", "part", "turn", "sig", "e"]
    signed = vectors.mapInPandas(sign, "turn int, sig long, node long, v array<double>")
    ordered = signed.repartitionByRange("turn", "sig", "node").sortWithinPartitions("turn", "sig", "node")
    both = scratch.save(ordered.mapInPandas(compare, "u long, v long, seam int, part int, turn int, sig long, e array<double>"), name)
    # a seam has two windows of rows at the most
    seams = both.where("seam is not null").groupBy("seam").applyInPandas(over_seam, "u long, v long")
    return both.where("seam is null").select("u", "v").unionByName(seams)


def count_links(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(node, links): for (component, node, weight, v), the weights of all other nodes of the component at the threshold or above, summed.

    A component of more than a block's members is cut into blocks by hash, and every pair of blocks is a task of its own; smaller ones share tasks.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    shared = max(8, members.count() // SHARED)
    small = F.col("size") <= block
    m = members.join(sizes, "component").withColumn("blocks", F.when(small, 1).otherwise(F.ceil(F.col("size") / (block / 2))).cast("int"))
    m = m.withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.select("component", "node", "weight", "v", "own", "other", F.when(small, F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other"))).alias("task"))

    def count(pdf):
        import pandas as pd

        ids, links = [], []
        for _, g in pdf.groupby(["component", np.minimum(pdf.own, pdf.other), np.maximum(pdf.own, pdf.other)], sort=False):
            x, w, own = matrix(g.v), g.weight.to_numpy(), g.own.to_numpy()
            x = x / np.sqrt((x * x).sum(1))[:, None]
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if (g.own != g.other).any():  # two blocks: only pairs between them
                near &= own[:, None] != own[None, :]
            ids.append(g.node.to_numpy())
            links.append(near @ w)
        return pd.DataFrame({"node": np.concatenate(ids), "links": np.concatenate(links).astype(np.int64)})

    return m.groupBy("task").applyInPandas(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def find_groups(nodes: DataFrame, threshold: float, window: int, recall: float, scratch: Scratch, label: str = "") -> DataFrame:
    """(id, component) of nodes (node, v) of one length that have a partner, of passes added until the measured recall is reached."""
    vectors, n = nodes.select("node", "v"), nodes.count()
    mean = mean_vector(vectors)
    common = min(float(mean @ mean), 0.999)
    queries = vectors.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(QUERIES).collect()
    wanted, done, links, turn = passes_for(n, max(0.0, (threshold - common) / (1 - common)), window, recall), 0, None, 0
    while True:
        wanted = min(wanted, MOST)
        while done < wanted:
            more = range(done, min(wanted, done + ROUND))
            got = candidate_links(vectors, threshold, more, window, mean, scratch, f"{label}passes{done}")
            got = scratch.save(got, f"{label}links{done}")
            scratch.drop(f"{label}passes{done}")
            links, done = got if links is None else links.unionByName(got), more.stop
        groups = components(links, scratch, name=f"{label}cc{turn}-")
        named = vectors.join(groups.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        if (got := measured(named, queries, threshold, window)) >= recall:
            return groups
        if done >= MOST:
            raise RuntimeError(f"{done} passes reach a recall of {got:.4f}, not {recall}")
        wanted, turn = done + max(8, done // 2), turn + 1


def near_dedup(rows: DataFrame, threshold: float = 0.9, window: int = WINDOW, recall: float = 0.999, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "projection")
    data = valid(rows, id_col, vec_col)
    nodes = scratch.save(data.groupBy("v").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("weight")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    groups = spark.createDataFrame([], "id long, component long")
    for d in lengths(nodes):
        groups = groups.unionByName(find_groups(nodes.where(F.size("v") == d), threshold, window, recall, scratch, f"{d}-"))
    again = data.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if not again.isEmpty():  # rows that share an id lie in one component, whatever their vectors
        held = scratch.save(data.join(again, "vec_id").join(nodes.select("v", "node"), "v").select("vec_id", "node").distinct(), "shared")
        ties = held.join(held.groupBy("vec_id").agg(F.min("node").alias("u")), "vec_id").select("u", F.col("node").alias("v")).where("u <> v")
        groups = components(groups.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(ties), scratch, name="shared-")
    # rows that share an id may tie vectors of two lengths, which have no cosine
    within = F.concat_ws("-", F.col("component"), F.size("v")).alias("component")
    counted = count_links(nodes.join(groups.withColumnRenamed("id", "node"), "node").select(within, "node", "weight", "v"), threshold)
    named = nodes.join(groups.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    result = named.join(least, "component").join(counted, "node", "left").select("v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    result = scratch.save(result, "result")
    scratch.keep("result")
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    out = out.join(result, out.v == result.v, "left").select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op8_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP8_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
low AS (SELECT u, min(v) AS low FROM reach GROUP BY u), many AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN low ON vec_id = low.u LEFT JOIN many ON vec_id = many.u
"""
