"""The alert store: matching of detections within a radius and the fold that confirms and notifies once."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopyflow.functions import geo
from canopyflow.operators.components import _checkpoint, close

STORE = "aoi string, alert_id string, lon double, lat double, area_ha double, first_seen string, last_seen string, confirmations int, notified_on string"
RADIUS_M, CONFIRMATIONS = 150.0, 2


def nearest_within(points: DataFrame, known: DataFrame, radius_m: float = RADIUS_M, point_id: str = "pid", known_id: str = "kid") -> DataFrame:
    """points with the nearest known place within a radius (null: none), ties to the smaller id.

    Both sides are put into cubes of a grid through the earth, twice the radius wide; a point looks into the eight at most that its radius
    reaches, so the join is an equi-join that grows with the input, alike at 180 degrees and at the poles.
    Of known places that coincide only the smallest id can win, so it alone is joined.
    """
    wide = 2 * radius_m
    k = known.select(F.col(known_id).alias("_k"), F.col("lon").alias("_klon"), F.col("lat").alias("_klat")).groupBy("_klon", "_klat").agg(F.min("_k").alias("_k")).withColumn("_cell", geo.sphere_cell(F.col("_klon"), F.col("_klat"), wide))
    p = points.select(F.col(point_id).alias("_p"), F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    p = p.withColumn("_cell", F.explode(geo.sphere_cells_within(F.col("_lon"), F.col("_lat"), radius_m * 1.0001 + 0.01, wide)))
    d = geo.haversine_m(F.col("_lon"), F.col("_lat"), F.col("_klon"), F.col("_klat"))
    best = p.join(k, "_cell").withColumn("_d", d).where(F.col("_d") <= radius_m).groupBy("_p").agg(F.min(F.struct(F.col("_d"), F.col("_k"))).alias("_m"))
    return points.join(best, points[point_id] == best["_p"], "left").select(points["*"], F.col("_m._k").alias("match_id"), F.col("_m._d").alias("distance_m"))


def clusters(places: DataFrame, radius_m: float = RADIUS_M, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, cell, cluster): occupied cubes a radius wide, tied where they touch; places of different clusters are further apart than the radius."""
    cells = places.select(*keys, geo.sphere_cell(F.col("lon"), F.col("lat"), radius_m * 1.0001 + 0.01).alias("cell")).distinct()
    near = cells.select(*keys, F.col("cell").alias("u"), F.explode(geo.cells_beside(F.col("cell"))).alias("cell")).where("u <> cell")
    links = near.join(cells, [*keys, "cell"]).select(*keys, "u", F.col("cell").alias("v"))
    low = close(links, keys)
    return cells.join(low.select(*keys, F.col("u").alias("cell"), "label"), [*keys, "cell"], "left").select(*keys, "cell", F.coalesce("label", "cell").alias("cluster"))


def _metres(lon1, lat1, lon2, lat2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.MEAN_RADIUS_M * math.asin(min(1.0, math.sqrt(a)))


def cell_of(lon: float, lat: float, radius_m: float) -> tuple[int, int, int]:
    """The cube a little over a radius wide that a place lies in, of a grid through the earth."""
    phi, lam, wide = math.radians(lat), math.radians(lon), radius_m * 1.0001 + 0.01
    return tuple(math.floor(geo.MEAN_RADIUS_M * v / wide) for v in (math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)))


def cells_around(lon: float, lat: float, radius_m: float) -> list[tuple[int, int, int]]:
    x, y, z = cell_of(lon, lat, radius_m)
    return [(x + i, y + j, z + k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]


def fold(store: dict[str, dict], detections, today: str, radius_m: float = RADIUS_M, confirmations: int = CONFIRMATIONS) -> list[dict]:
    """Take detections (lon, lat, area_ha, observed_on) in order into one area's store; the alerts that became due today.

    The place of an alert never moves; another day confirms it; its area is the largest seen; it is emitted once. Of equally near alerts the
    smaller id counts. Alerts are looked up by cell, so a fold is linear in the detections.
    """
    cells: dict[tuple[int, int, int], list[dict]] = {}

    def put(alert):
        cells.setdefault(cell_of(alert["lon"], alert["lat"], radius_m), []).append(alert)

    for alert in store.values():
        put(alert)
    due = []
    for lon, lat, area, seen in detections:
        if area <= 0:
            raise ValueError("a detection needs an area above 0")
        beside = [(_metres(lon, lat, a["lon"], a["lat"]), a["alert_id"], a) for cell in cells_around(lon, lat, radius_m) for a in cells.get(cell, ())]
        near = min((x for x in beside if x[0] <= radius_m), default=None, key=lambda x: x[:2])
        if near is None:
            key = hashlib.sha256(f"{lon:.6f},{lat:.6f},{seen}".encode()).hexdigest()[:16]
            alert = {"alert_id": key, "lon": lon, "lat": lat, "area_ha": area, "first_seen": seen, "last_seen": seen, "confirmations": 1, "notified_on": None}
            if key not in store:
                store[key] = alert
                put(alert)
            alert = store[key]
        else:
            alert = near[2]
            alert["confirmations"] += alert["last_seen"] != seen
            alert["last_seen"] = seen
            alert["area_ha"] = max(alert["area_ha"], area)
        if alert["notified_on"] is None and alert["confirmations"] >= confirmations:
            alert["notified_on"] = today
            due.append(alert)
    return due


def ingest(detections: DataFrame, store: DataFrame | None, today: str, radius_m: float = RADIUS_M, confirmations: int = CONFIRMATIONS) -> DataFrame:
    """STORE after the fold of detections (aoi, seq, lon, lat, area_ha, observed_on), in order of seq.

    Within an area the order decides which sighting becomes an alert, but only among places within reach of one another: detections and alerts are
    dealt by (area, cluster of touching cells), and each cluster is folded by itself. The result is that of one fold over the whole area.
    """
    names = [f.split()[0] for f in STORE.split(", ")]

    def work(key, old, new):
        import pandas as pd

        held = {r.alert_id: {n: (None if pd.isna(getattr(r, n)) else getattr(r, n)) for n in names[1:]} for r in old.itertuples(index=False)}
        new = new.sort_values("seq", kind="stable")
        fold(held, zip(new.lon, new.lat, new.area_ha, new.observed_on, strict=True), today, radius_m, confirmations)
        return pd.DataFrame([{"aoi": key[0], **a} for a in held.values()], columns=names)

    spark = detections.sparkSession
    store = spark.createDataFrame([], STORE) if store is None else store
    cell = geo.sphere_cell(F.col("lon"), F.col("lat"), radius_m * 1.0001 + 0.01)
    d = detections.select("aoi", "seq", "lon", "lat", "area_ha", F.col("observed_on").cast("string").alias("observed_on"), cell.alias("cell"))
    before = store.withColumn("cell", cell)
    placed = _checkpoint(clusters(d.select("aoi", "lon", "lat").unionByName(store.select("aoi", "lon", "lat")), radius_m, ("aoi",)))
    # columns of their own on each side, as both come from one table of cells
    d, before = ((y := x.join(placed, ["aoi", "cell"])).select(*(F.col(n).alias(n) for n in y.columns if n != "cell")) for x in (d, before))
    return before.groupBy("aoi", "cluster").cogroup(d.groupBy("aoi", "cluster")).applyInPandas(work, STORE)


def isolated(detections: DataFrame, radius_m: float = RADIUS_M) -> DataFrame:
    """Detections with no other detection of their area in their cell or in one that touches it: each is an alert by itself."""
    d = detections.withColumn("cell", geo.sphere_cell(F.col("lon"), F.col("lat"), radius_m * 1.0001 + 0.01))
    held = d.groupBy("aoi", "cell").agg(F.count(F.lit(1)).alias("_n"))
    around = held.select("aoi", F.col("cell").alias("_from"), "_n", F.explode(geo.cells_beside(F.col("cell"))).alias("cell")).groupBy("aoi", "cell").agg(F.sum("_n").alias("_n"))
    return d.join(around.where("_n = 1"), ["aoi", "cell"]).drop("_n", "cell")


def checked(detections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fit, unfit) detections: unfit ones carry a reason (no place, a place off the globe, no area above 0, no day) and stop no run."""
    c = F.col
    day = F.try_to_timestamp(c("observed_on").cast("string"), F.lit("yyyy-MM-dd"))
    reason = F.when(c("lon").isNull() | c("lat").isNull() | F.isnan("lon") | F.isnan("lat"), "no place").when(~c("lon").between(-180, 180) | ~c("lat").between(-90, 90), "off the globe")
    reason = reason.when(c("area_ha").isNull() | F.isnan("area_ha") | (c("area_ha") <= 0), "no area").when(day.isNull(), "no day")
    marked = detections.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def pending(store: DataFrame) -> DataFrame:
    return store.where("notified_on is null")


def notified(store: DataFrame) -> DataFrame:
    return store.where("notified_on is not null")


def confirmations_of_fixed(sightings: DataFrame, keys: list[str], day: str, order: list[str]) -> DataFrame:
    """Confirmations where identity is settled: the changes of day along the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return sightings.withColumn("_new", (F.lag(day).over(w).isNull() | (F.lag(day).over(w) != F.col(day))).cast("int")).groupBy(*keys).agg(F.sum("_new").alias("confirmations"))
