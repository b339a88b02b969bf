"""Files that the engine reads and writes: alert stores, patch records, worksheets, verdicts, releases."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ALERT = "alert_id string, lon double, lat double, area_ha double, first_seen string, last_seen string, confirmations int, notified_on string"
PATCH = "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, properties struct<area_ha: double, label: int>, area_ha double, label int"
WORKSHEET = "alert_id stratum area_ha lat lon first_seen confirmations satellite_view map_view verdict note".split()
VERDICTS = ("true_positive", "false_positive", "unclear")
VERSION = 1


def is_there(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def put(spark: SparkSession, path: str, content: str) -> None:
    """A small text file on any file system that Spark knows: written beside its place, then moved there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, beside = hadoop.Path(path), hadoop.Path(f"{path}.part")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    # no checksum beside it, as people fill in worksheets by hand
    files.setWriteChecksum(False)
    try:
        out = files.create(beside, True)
        out.write(bytearray(content.encode()))
        out.close()
    finally:
        files.setWriteChecksum(True)
    files.delete(at, False)
    if not files.rename(beside, at):
        raise OSError(f"{path} can't be written")


def load_store(spark: SparkSession, path: str, aoi: str) -> DataFrame:
    """Alerts of a versioned JSON store; none where it is missing; another version is refused."""
    if not is_there(spark, path):
        return spark.createDataFrame([], f"aoi string, {ALERT}")
    doc = spark.read.schema(f"version int, updated string, alerts array<struct<{', '.join(x.replace(' ', ': ', 1) for x in ALERT.split(', '))}>>").json(path, multiLine=True)
    version = doc.first().version
    if version != VERSION:
        raise ValueError(f"store version {version} is not {VERSION}; migrate it rather than deleting it")
    return doc.select(F.inline("alerts")).select(F.lit(aoi).alias("aoi"), "*")


def dump_store(store: DataFrame, updated: str) -> str:
    """The store of one area as JSON, in order of id; stores are small."""
    rows = [r.asDict() for r in store.drop("aoi").orderBy("alert_id").collect()]
    return json.dumps({"version": VERSION, "updated": updated, "alerts": rows}, indent=2)


def save_store(spark: SparkSession, store: DataFrame, path: str, updated: str) -> None:
    put(spark, path, dump_store(store, updated))


def detections(records: DataFrame, observed_on: str, column: str = "record") -> DataFrame:
    """GeoJSON patch records (aoi, seq, record) as detections at the mean of all vertices of the outer ring, a closing one counted twice."""
    r = records.withColumn("p", F.from_json(column, PATCH))
    ring = F.col("p.geometry.coordinates")[0]
    mean = lambda k: F.aggregate(F.transform(ring, lambda v: v[k]), F.lit(0.0), lambda s, x: s + x) / F.size(ring)
    return r.select("aoi", "seq", mean(0).alias("lon"), mean(1).alias("lat"), F.coalesce("p.properties.area_ha", "p.area_ha").alias("area_ha"), F.lit(observed_on).alias("observed_on"))


def worksheet(alerts: DataFrame) -> DataFrame:
    """alerts with their stratum and links in 11 columns, verdict and note blank."""
    from canopyflow.functions import geo, stats

    c = F.col
    return alerts.select("alert_id", stats.size_stratum(c("area_ha")).alias("stratum"), F.format_string("%.3f", "area_ha").alias("area_ha"), F.format_string("%.6f", "lat").alias("lat"), F.format_string("%.6f", "lon").alias("lon"), "first_seen", "confirmations", geo.satellite_url(c("lat"), c("lon")).alias("satellite_view"), geo.map_url(c("lat"), c("lon")).alias("map_view"), F.lit("").alias("verdict"), F.lit("").alias("note"))


def write_worksheet(alerts: DataFrame, path: str) -> None:
    out = worksheet(alerts)
    out.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def judged(rows: DataFrame) -> DataFrame:
    """Rows with a verdict, in plain form; an unknown one is an error."""
    v = F.trim(F.lower(F.coalesce("verdict", F.lit(""))))
    rows = rows.withColumns({"verdict": v, "note": F.trim(F.coalesce("note", F.lit("")))}).where("verdict <> ''")
    return rows.withColumn("verdict", F.when(F.col("verdict").isin(*VERDICTS), F.col("verdict")).otherwise(F.raise_error(F.concat(F.lit("unknown verdict: "), F.col("verdict")))))


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(alert_id, stratum, area_ha, verdict, note) of judged rows, from either layout."""
    return judged(spark.read.option("header", True).option("escape", '"').csv(path)).select("alert_id", "stratum", F.col("area_ha").cast("double").alias("area_ha"), "verdict", "note")


def worksheet_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path).select("alert_id").where("trim(alert_id) <> ''")


def releases(titles: DataFrame) -> DataFrame:
    """(release, captured) from titles that hold a date."""
    return titles.select("release", F.try_to_timestamp(F.regexp_extract("title", r"(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")).cast("date").alias("captured")).where("captured is not null")


def newest_release(rel: DataFrame) -> DataFrame:
    """One row: the release captured last, ties to the smaller id."""
    return rel.orderBy(F.desc("captured"), "release").limit(1)


def on_worksheet(rows: DataFrame, listed: DataFrame, key: str = "alert_id") -> DataFrame:
    """Rows whose id a worksheet lists."""
    return rows.join(listed.select(key), key, "left_semi")


#: Days of the calendar that are searched together for the nearest release.
SPAN = 64


def nearest_release(days: DataFrame, rel: DataFrame, day: str = "target") -> DataFrame:
    """For each day the release nearest in time, ties to the newest, then to the smaller id; for a null day the newest. Releases without a date are never the nearest.

    Of releases of one day only the smallest id can win. What is left, a row a day at most, is searched by spans of days: the last release up
    to a day and the first from it on; where a span holds none, that of the nearest span, found over one row a span.
    """
    c = F.col
    own = rel.where("captured is not null").groupBy("captured").agg(F.min("release").alias("release")).select(c("captured").alias("at"), F.struct("captured", "release").alias("r"), F.lit(False).alias("asked"))
    asked = days.select(c(day).alias("at")).distinct()
    rows = own.unionByName(asked.where("at is not null").withColumn("asked", F.lit(True)), allowMissingColumns=True).withColumn("span", F.floor(F.unix_date("at") / SPAN))
    upward, downward = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("span").agg(F.min("r").alias("first"), F.max("r").alias("last"))
    around = ends.select("span", F.last("last", True).over(upward).alias("before"), F.last("first", True).over(downward).alias("after"))
    inside = Window.partitionBy("span").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = rows.select("at", "asked", "span", F.last("r", True).over(inside.orderBy("at")).alias("low"), F.last("r", True).over(inside.orderBy(F.desc("at"))).alias("high")).where("asked").join(around, "span")
    pick = lambda r: F.when(r.isNotNull(), F.struct(F.abs(F.datediff("at", r.captured)).alias("gap"), (-F.unix_date(r.captured)).alias("newest"), r.release.alias("release"), r.captured.alias("captured")))
    found = near.select("at", F.least(pick(F.coalesce("low", "before")), pick(F.coalesce("high", "after"))).alias("m")).where("m is not null")
    newest = own.agg(F.max("r").alias("r")).where("r is not null").select("r.release", "r.captured")
    undated = asked.where("at is null").crossJoin(newest).select("at", "release", "captured", F.lit(None).cast("int").alias("gap"))
    return found.select("at", "m.release", "m.captured", "m.gap").unionByName(undated).withColumnRenamed("at", day)


#: Images that a reviewer needs of an alert, by the ends of their names.
CHIPS = ("before", "after")


def chip_sets(alerts: DataFrame, files: DataFrame | None, needed: tuple[str, ...] = CHIPS) -> DataFrame:
    """(alert_id, paths, missing, complete): images `<alert_id>-<kind>.png` (path, length) of each alert; empty files count as missing, and alerts without any stay."""
    kinds = F.array(*(F.lit(k) for k in needed))
    if files is None:
        return alerts.select("alert_id", F.expr("map()").cast("map<string, string>").alias("paths"), kinds.alias("missing"), F.lit(False).alias("complete"))
    name = F.regexp_extract("path", r"([^/]+)\.png$", 1)
    found = files.where("length > 0").select(F.regexp_extract(name, r"^(.*)-[^-]+$", 1).alias("alert_id"), F.regexp_extract(name, r"-([^-]+)$", 1).alias("kind"), "path").where(F.col("kind").isin(*needed))
    held = found.groupBy("alert_id", "kind").agg(F.min("path").alias("path")).groupBy("alert_id").agg(F.map_from_entries(F.collect_list(F.struct("kind", "path"))).alias("paths"))
    out = alerts.select("alert_id").join(held, "alert_id", "left")
    missing = F.array_except(kinds, F.coalesce(F.map_keys("paths"), F.array().cast("array<string>")))
    return out.select("alert_id", F.coalesce("paths", F.expr("map()").cast("map<string, string>")).alias("paths"), missing.alias("missing"), (F.size(missing) == 0).alias("complete"))


def missing_tiles(wanted: DataFrame, done: DataFrame, key: str = "tile") -> DataFrame:
    """What is left to do after a break."""
    return wanted.join(done.select(key), key, "left_anti")
