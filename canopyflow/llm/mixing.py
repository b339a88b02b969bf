"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a token target. Among all document rates r in [0, most] whose tokens meet the targets, the one nearest to the plain corpus
in relative entropy is r = min(most, exp(lambda * size / mean size)): the exponential tilt by the document's own share in its constraint.
lambda, one for each source, solves a convex dual. Newton steps, kept inside a bracket, are summed over a histogram of (source, size),
which Spark builds with map-side combining, so a source with a third of all rows costs no more than another.
The rates become whole copies: each document gets the whole part, and one more if its toss (a fixed hash) divided by the fractional part is
at most the source's edge, the point where its tokens come nearest the target; then single documents, known by their toss, move by
one copy while that brings it nearer. So a document's copies follow from its size, its toss and its source's row of a small table,
and only narrow columns (source, size, toss) are ever written or shuffled, never a text.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source, the last; repeated rows are documents of their own,
but rows equal in id, source and text are taken alike; very long texts are counted whole; columns other than these three are left as they are;
with no tokens at all every target is 0, and an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopyflow.llm._common import Scratch

#: Ranges of the rounding order counted to find where a source meets its target; only one range of a source is sorted.
RANGES = 4096
#: Sources up to which their table is sent to every task; beyond that it is joined by a shuffle of the documents.
SENT = 10_000
#: Single documents that a source moves at most to come nearer its target.
MOVES = 2


def word_count(text: str = "text"):
    """Number of [^\\x20\\x09-\\x0D]+ in a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(sid, source, source_size, docs, target): sources by code point, null last, with the weights in turn; no target above most times the size.

    Sharing the excess by weight again and again ends at one level L with target = min(weight * L, most * size), found here from sorted sums.
    The table has a row for each source.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    src = src.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    src = src.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") - 1) % len(weights) + 1))
    src = src.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), "sid")
    src = src.withColumn("full", F.sum("cap").over(by_ratio) - F.col("cap")).withColumn("rest", F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"))
    src = src.withColumn("level", (F.sum("source_size").over(everything) - F.col("full")) / F.col("rest"))
    src = src.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything))
    return src.select("sid", "source", "source_size", "docs", F.least("cap", F.col("weight") * F.coalesce("level", F.lit(0.0))).alias("target"))


def balance(hist: DataFrame, src: DataFrame, most: float, scratch: Scratch, rounds: int = 200) -> DataFrame:
    """src with the dual solution lam; sources without tokens or with a target of most times their size need none (null: all copies or none).

    A bracket halves at worst, so that so many rounds always suffice; where they do not, this is an error.
    """
    top = math.log(most)
    mean = F.col("source_size") / F.col("docs")
    lam = src.where("source_size > 0 and target > 0").where(F.col("target") < F.col("source_size") * F.lit(most)).select(
        "sid", "target", mean.alias("mean"), F.when(F.col("target") <= F.col("source_size"), mean * F.log(F.col("target") / F.col("source_size"))).otherwise(0.0).alias("lo"),
        F.when(F.col("target") <= F.col("source_size"), 0.0).otherwise(mean * F.lit(top)).alias("hi"), F.lit(0.0).alias("lam"))
    lam = scratch.save(lam, "lam0")
    for k in range(1, rounds + 1):
        rate = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(top)))
        tokens = F.col("n") * F.col("size") * rate
        free = F.col("lam") * F.col("size") / F.col("mean") < top
        sums = hist.join(lam, "sid").groupBy("sid").agg(F.sum(tokens).alias("got"), F.sum(F.when(free, tokens * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
        at = lam.join(sums, "sid").withColumn("lo", F.when(F.col("got") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("got") < F.col("target"), F.col("hi")).otherwise(F.col("lam")))
        step = F.col("lam") - F.try_divide(F.col("got") - F.col("target"), F.col("slope"))
        # as near as the target or doubles allow
        near = (F.abs(F.col("got") - F.col("target")) <= F.col("target") * 1e-4) | (F.col("hi") - F.col("lo") <= 1e-12 * F.abs(F.col("hi") + F.col("lo")))
        at = at.withColumn("next", F.when(near, F.col("lam")).when((step > F.col("lo")) & (step < F.col("hi")), step).otherwise((F.col("lo") + F.col("hi")) / 2))
        at = scratch.save(at.select("sid", "target", "mean", "lo", "hi", F.col("next").alias("lam"), near.alias("near")), f"lam{k}")
        done = at.where("not near").isEmpty()
        lam = at.drop("near")
        if done:
            break
    else:
        raise RuntimeError(f"no solution of the dual after {rounds} rounds")
    return src.join(lam.select("sid", "lam", "mean"), "sid", "left")


def plan(sizes: DataFrame, weights: tuple[int, ...], most: int, scratch: Scratch) -> DataFrame:
    """For (source, size, toss): source, source_size, target, lam, mean, and what rounds the rates: edge, and moves (toss, step)."""
    src = scratch.save(targets(sizes, weights, float(most)), "targets")
    near = _sent(src)
    base = sizes.where("size > 0").join(near(src.select("source", "sid")), sizes.source.eqNullSafe(src.source)).select("sid", "size", "toss")
    hist = scratch.save(base.groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    solved = scratch.save(balance(hist, src, float(most), scratch), "solved")
    rated = base.join(near(solved), "sid").withColumn("rate", _rate(F.col, most)).withColumn("whole", _whole(F.col("rate"))).withColumn("order", _order(F.col("rate"), F.col("toss")))
    rated = rated.withColumn("range", F.floor(F.col("order") * RANGES))
    per = rated.groupBy("sid", "range").agg(F.sum("size").alias("tokens"), F.sum(F.col("whole") * F.col("size")).alias("held"))
    up = Window.partitionBy("sid").orderBy(F.col("range").asc_nulls_first())
    per = per.withColumn("need", F.sum("held").over(Window.partitionBy("sid"))).where("range is not null").withColumn("past", F.sum("tokens").over(up)).select("sid", "range", "need", "past", "tokens")
    per = per.join(solved.select("sid", "target"), "sid").withColumn("need", F.col("target") - F.col("need"))
    cross = per.groupBy("sid").agg(F.min(F.when(F.col("past") >= F.col("need"), F.struct("range", "need", (F.col("past") - F.col("tokens")).alias("before")))).alias("x"))
    cross = scratch.save(cross.select("sid", F.col("x.range").alias("edge_range"), F.col("x.need").alias("need"), F.col("x.before").alias("before")), "edges")
    # only the range that holds the edge is sorted; a source without one takes every fraction
    inside = rated.join(near(cross.where("edge_range is not null")), "sid").where(F.col("range") == F.col("edge_range")).select("sid", "size", "order", "before", "need")
    run = F.sum("size").over(Window.partitionBy("sid").orderBy("order").rangeBetween(Window.unboundedPreceding, 0))
    taken = inside.withColumn("run", F.col("before") + run).where(F.col("run") - F.col("size") / 2.0 <= F.col("need")).groupBy("sid").agg(F.max("order").alias("last"))
    edge = F.when(F.col("edge_range").isNull(), 8.0).otherwise(F.coalesce("last", F.col("edge_range") / float(RANGES) - 1e-12))
    none = F.array().cast("array<struct<toss: double, step: long>>")
    out = solved.join(cross, "sid", "left").join(taken, "sid", "left").select("sid", "source", "source_size", "target", "lam", "mean", edge.alias("edge"), none.alias("moves"))
    out = scratch.save(out, "plan0")
    for k in range(1, MOVES + 1):
        held = base.join(near(out), "sid").withColumn("copies", _copies(F.col, most)).select("sid", "size", "toss", "target", "copies")
        short = scratch.save(held.groupBy("sid").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("short")), f"short{k}")
        off = F.abs(F.abs("short") - F.col("size"))
        can = held.join(near(short), "sid").where(F.when(F.col("short") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)).where(off < F.abs("short"))
        best = can.groupBy("sid").agg(F.min(F.struct(off.alias("off"), F.col("toss"), F.signum("short").cast("long").alias("step"))).alias("b"))
        best = best.select("sid", F.array(F.struct(F.col("b.toss").alias("toss"), F.col("b.step").alias("step"))).alias("new"))
        out = scratch.save(out.join(best, "sid", "left").withColumn("moves", F.concat("moves", F.coalesce("new", none))).drop("new"), f"plan{k}")
        if out.where(F.size("moves") == k).isEmpty():
            break
    return out.drop("sid")


def _sent(sources: DataFrame):
    """How tables with a row for each source are joined: sent along if there are few sources, else by a shuffle."""
    return F.broadcast if sources.count() <= SENT else lambda small: small


def _rate(of, most: int):
    tilt = F.exp(F.least(of("lam") * of("size") / of("mean"), F.lit(math.log(most))))
    return F.when(of("size") == 0, 0.0).when(of("lam").isNull(), F.when(of("target") > 0, float(most)).otherwise(0.0)).otherwise(tilt)


def _whole(rate):
    return F.floor(rate + 1e-9)


def _order(rate, toss):
    part = rate - _whole(rate)
    return F.when(part > 1e-9, F.least(toss / part, F.lit(4.0)))


def _copies(of, most: int):
    """A document's copies, of its size and toss and its source's row of the plan."""
    rate = _rate(of, most)
    moved = F.aggregate(F.filter(of("moves"), lambda m: m.toss == of("toss")), F.lit(0).cast("long"), lambda acc, m: acc + m.step)
    return F.when(of("size") == 0, 0).otherwise(_whole(rate) + F.coalesce((_order(rate, of("toss")) <= of("edge")).cast("int"), F.lit(0)) + moved).cast("long")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", prefix: str = "") -> DataFrame:
    """docs and, with the prefix, columns size, source_size, target, rate, copies (0 to most) and taken = copies * size."""
    scratch = Scratch(docs.sparkSession, "mixing")
    toss = (F.pmod(F.xxhash64(F.lit("mix"), F.col(id_col), F.col(source_col).cast("string"), F.col(text_col).cast("string")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    own = F.struct(F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"), toss.alias("toss"))
    made = scratch.save(plan(scratch.save(docs.select(own.alias("own")).select("own.*"), "sizes"), weights, most, scratch), "plan")
    made = made.select(F.struct(*made.columns).alias("__plan"))
    out = docs.withColumn("__own", own).join(_sent(made)(made), F.col("__own.source").eqNullSafe(F.col("__plan.source")))
    of = lambda c: F.col(f"__own.{c}" if c in ("size", "toss") else f"__plan.{c}")
    out = out.withColumn("__copies", _copies(of, most))
    new = {"size": of("size"), "source_size": of("source_size"), "target": of("target"), "rate": _rate(of, most), "copies": F.col("__copies"), "taken": F.col("__copies") * of("size")}
    return out.withColumns({prefix + c: x for c, x in new.items()}).drop("__own", "__plan", "__copies")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
