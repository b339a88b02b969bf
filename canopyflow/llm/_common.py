"""Pieces that the operators share: scratch tables in the cluster's shared folder, document keys and connected components."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset (tests), a local one that ends with the process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="canopyflow-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return f"file://{_LOCAL[0]}"


class Scratch:
    """Tables that cut lineage: written once in the shared folder, read by any executor, dropped when no longer needed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, *names: str) -> None:
        """Drop all tables but these, which the result is still read from."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        self.drop(*{f.getPath().getName() for f in files.listStatus(root)} - set(names))

    def drop(self, *names: str) -> None:
        """Delete tables, then let Spark remove the shuffle files of plans that are no longer referenced."""
        jvm, hadoop = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(hadoop).delete(path, True)
        gc.collect()
        jvm.System.gc()


#: What stands for a null doc_id inside an operator: it sorts before any other.
NULL_ID = -(2**63)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, sub, text): doc_id with null as NULL_ID, and a number from 0, in order of text, among rows that share a doc_id.

    Rows that repeat an id are rare, so only these are numbered; the others pass through without a shuffle.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    again = base.groupBy("doc").count().where("count > 1").select("doc")
    if again.isEmpty():
        return base.select("doc", F.lit(0).alias("sub"), "text")
    from pyspark.sql import Window

    twice = base.join(again, "doc", "left_semi").withColumn("sub", F.row_number().over(Window.partitionBy("doc").orderBy(F.col("text").asc_nulls_first())) - 1)
    return base.join(again, "doc", "left_anti").select("doc", F.lit(0).alias("sub"), "text").unionByName(twice.select("doc", "sub", "text"))


def unkey(col: str = "doc"):
    return F.when(F.col(col) != NULL_ID, F.col(col))


def components(edges: DataFrame, scratch: Scratch, u: str = "u", v: str = "v", name: str = "cc") -> DataFrame:
    """(id, component): the smallest id reachable, for every id that stands in an edge.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each is a min by node with map-side combining and a join back,
    so no node's neighbours meet in one task; a round's edges are written before the next reads them.
    """
    cur = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    cur, before, k = scratch.save(cur, f"{name}0"), None, 0
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        k += 1
        cur = scratch.save(small, f"{name}{k}")
        scratch.drop(f"{name}{k - 1}")
        # a round that changes no edge ends it
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
