"""Queries over the driver's tables, each beside the SQL that gives the same rows.

Tables stand in for rasters: embeddings in two halves for two years of vectors on a grid 25 wide, events for passes over a pixel (user_id),
orders for scenes, part for class codes, lineitem for masks with areas, customer and orders for known places and sightings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopyflow.functions import geo, season, spectral, stats, text
from canopyflow.operators import alerts, area, components, detect, evaluate, raster
from canopyflow.sources import stores

QUERIES, SQL = {}, {}
#: The distance that separates changed from unchanged vectors in the stand-in table, and the least patch.
FAR, LEAST = 1.45, 3


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _r(c, n: int = 6):
    return F.round(c, n) + 0.0


c = F.col

# --- vectors -------------------------------------------------------------------------------------------------------------------------

PAIR = """n AS (SELECT count(*) // 2 AS h FROM embeddings), pair AS (SELECT b.vec_id AS p, b.vec_id // 25 AS r, b.vec_id % 25 AS c, b.label, b.embedding::DOUBLE[] AS x, t.embedding::DOUBLE[] AS y
FROM embeddings b, n, embeddings t WHERE b.vec_id < n.h AND t.vec_id = b.vec_id + n.h)"""


def pairs(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", "label", c("embedding").cast("array<double>").alias("v"))
    half = e.count() // 2
    base = e.where(c("vec_id") < half).select(c("vec_id").alias("p"), "label", c("v").alias("x"))
    target = e.where((c("vec_id") >= half) & (c("vec_id") < 2 * half)).select((c("vec_id") - half).alias("p"), c("v").alias("y"))
    return base.join(target, "p").withColumn("r", F.floor(c("p") / 25)).withColumn("c", c("p") % 25)


@query("embedding_l2", f"WITH {PAIR} SELECT p, round(list_distance(x, y), 6) AS distance FROM pair")
def _(spark, d):
    return pairs(spark, d).select("p", _r(spectral.l2_distance(c("x"), c("y"))).alias("distance"))


@query("embedding_cosine", f"WITH {PAIR} SELECT p, round(1 - list_inner_product(x, y), 6) + 0.0 AS distance FROM pair")
def _(spark, d):
    return pairs(spark, d).select("p", _r(spectral.cosine_distance(c("x"), c("y"))).alias("distance"))


@query("embedding_change_stack", f"WITH {PAIR} SELECT p, i - 1 AS band, round(x[i], 6) + 0.0 AS base, round(y[i] - x[i], 6) + 0.0 AS change, round(list_distance(x, y), 6) AS l2 FROM pair, unnest(range(1, 65)) AS u(i)")
def _(spark, d):
    s = pairs(spark, d).select("p", "x", spectral.difference(c("y"), c("x")).alias("d"), spectral.l2_distance(c("x"), c("y")).alias("l2"))
    s = s.select("p", "l2", F.posexplode(F.arrays_zip("x", "d")).alias("band", "z"))
    return s.select("p", c("band").cast("long").alias("band"), _r(c("z.x")).alias("base"), _r(c("z.d")).alias("change"), _r(c("l2")).alias("l2"))


def candidates(spark, d):
    forest = (c("label") != 0).alias("forest")
    return pairs(spark, d).select("p", "r", "c", spectral.l2_distance(c("x"), c("y")).alias("distance"), forest, (c("y")[0] - c("x")[0]).alias("greenness_loss"))


CAND = f"{PAIR}, cand AS (SELECT p, r, c, list_distance(x, y) AS distance, label <> 0 AS forest, y[1] - x[1] AS greenness_loss FROM pair)"


@query("embedding_candidates", f"WITH {CAND} SELECT p, r, c, round(distance, 6) AS distance FROM cand WHERE distance >= {FAR} AND forest")
def _(spark, d):
    return candidates(spark, d).where((c("distance") >= FAR) & c("forest")).select("p", "r", "c", _r(c("distance")).alias("distance"))


def _cc(where: str) -> str:
    return f"""WITH RECURSIVE {CAND}, cell AS (SELECT r, c, distance FROM cand WHERE {where}),
reach(r, c, r0, c0) AS (SELECT r, c, r, c FROM cell UNION SELECT n.r, n.c, reach.r0, reach.c0 FROM reach JOIN cell n ON abs(n.r - reach.r) <= 1 AND abs(n.c - reach.c) <= 1),
lab AS (SELECT r, c, min(r0 * 2147483648 + c0) AS component FROM reach GROUP BY ALL), sized AS (SELECT lab.*, cell.distance, count(*) OVER (PARTITION BY component) AS size FROM lab JOIN cell USING (r, c))"""


PX = f"{(10.0 / 6378137.0) ** 2 * 6371008.8**2 / 1e4!r} * cos(radians(14.8 + r / 10000.0))"


@query("component_sizes", f"{_cc(f'distance >= {FAR}')} SELECT r, c, component, size FROM sized")
def _(spark, d):
    return components.component_sizes(candidates(spark, d).where(c("distance") >= FAR).select("r", "c"), tile=8).select("r", "c", "component", "size")


def _patches(spark, d):
    hit = components.label_components(candidates(spark, d).where(c("distance") >= FAR).select("r", "c"), tile=8)
    return components.patches(hit.withColumn("ha", geo.pixel_ha(F.lit(14.8) + c("r") / 10000.0)))


@query("disturbance_patches", f"{_cc(f'distance >= {FAR}')} SELECT component, count(*) AS n_px, round(sum({PX}), 6) AS area_ha, round(avg(r), 6) AS row, round(avg(c), 6) AS col FROM sized GROUP BY component HAVING count(*) >= {LEAST}")
def _(spark, d):
    return _patches(spark, d).where(c("n_px") >= LEAST).select("component", "n_px", _r(c("area_ha")).alias("area_ha"), _r(c("row")).alias("row"), _r(c("col")).alias("col"))


@query("patch_summary", f"{_cc(f'distance >= {FAR}')}, p AS (SELECT component, sum({PX}) AS a FROM sized GROUP BY component) SELECT count(*) AS patch_count, round(coalesce(sum(a), 0), 6) AS total_ha, round(coalesce(max(a), 0), 6) AS largest_ha, round(coalesce(median(a), 0), 6) AS median_ha FROM p")
def _(spark, d):
    z = lambda x: _r(F.coalesce(x, F.lit(0.0)))
    return _patches(spark, d).agg(F.count(F.lit(1)).alias("patch_count"), z(F.sum("area_ha")).alias("total_ha"), z(F.max("area_ha")).alias("largest_ha"), z(F.median("area_ha")).alias("median_ha"))


@query("embedding_detect", f"{_cc(f'distance >= {FAR} AND forest AND greenness_loss > 0')} SELECT r, c, component, round(distance, 6) AS distance FROM sized WHERE size >= {LEAST}")
def embedding_detect(spark, d):
    out = detect.embedding_disturbance(candidates(spark, d), detect.Embedding(distance=FAR), least=LEAST)
    return out.select("r", "c", "component", _r(c("distance")).alias("distance"))


# --- time series ---------------------------------------------------------------------------------------------------------------------

CLOUD = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def scenes(spark, d):
    e = _t(spark, d, "events")
    return e.withColumn("cloud", F.get_json_object("props", "$.k").cast("int"))


@query("seasonal_composite", f"SELECT user_id, round(median(value), 6) AS ndvi, round(median(value * 0.5 + 1), 6) AS nbr, count(value) AS n_obs FROM events WHERE {CLOUD} < 60 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY user_id")
def _(spark, d):
    s = scenes(spark, d).where("cloud < 60 and ts >= timestamp_ntz'2024-01-05' and ts < timestamp_ntz'2024-01-25'")
    out = raster.composite(s, ["user_id"], {"ndvi": c("value"), "nbr": c("value") * 0.5 + 1}, c("value"))
    return out.select("user_id", _r(c("ndvi")).alias("ndvi"), _r(c("nbr")).alias("nbr"), "n_obs")


@query("rgb_composite", f"SELECT user_id, round(median(value), 6) AS b4, round(median(value / 2), 6) AS b3, round(median(value / 4), 6) AS b2 FROM events WHERE {CLOUD} < 60 GROUP BY user_id")
def _(spark, d):
    out = raster.composite(scenes(spark, d).where("cloud < 60"), ["user_id"], {"b4": c("value"), "b3": c("value") / 2, "b2": c("value") / 4})
    return out.select("user_id", *(_r(c(b)).alias(b) for b in ("b4", "b3", "b2")))


@query("ndvi_nbr_indices", "SELECT p_partkey, round((p_retailprice - p_size) / (p_retailprice + p_size), 6) AS ndvi, CASE WHEN p_size - 10 >= 0 THEN round((p_retailprice - (p_size - 10)) / (p_retailprice + (p_size - 10)), 6) END AS nbr FROM part")
def _(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", _r(spectral.normalized_difference(c("p_retailprice"), c("p_size"))).alias("ndvi"), _r(spectral.normalized_difference(c("p_retailprice"), c("p_size") - 10)).alias("nbr"))


@query("cloud_mask_recode", "SELECT p_size % 12 AS scl, count(*) AS n, count(CASE WHEN p_size % 12 IN (4,5,6,7) THEN p_retailprice END) AS clear, round(avg(CASE WHEN p_size % 12 IN (4,5,6,7) THEN p_retailprice END), 6) AS mean FROM part GROUP BY 1")
def _(spark, d):
    p = _t(spark, d, "part").withColumn("scl", c("p_size") % 12).withColumn("v", spectral.mask_clouds(c("p_retailprice"), c("scl")))
    return p.groupBy("scl").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("clear"), _r(F.avg("v")).alias("mean"))


@query("mosaic_latest_valid", f"SELECT user_id, round(arg_max(value, (ts, event_id)) FILTER (WHERE {CLOUD} < 60), 6) AS value FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE {CLOUD} < 60) > 0")
def _(spark, d):
    s = scenes(spark, d).withColumn("value", F.when(c("cloud") < 60, c("value")))
    return raster.mosaic(s, ["user_id"], "value", F.struct("ts", "event_id")).select("user_id", _r(c("value")).alias("value"))


YEARS = """s AS (SELECT o_custkey AS p, o_custkey // 50 AS r, o_custkey % 50 AS c, year(o_orderdate) AS y, o_totalprice AS v FROM orders),
m AS (SELECT p, r, c, median(v) FILTER (WHERE y <= 1997) AS a, median(v) FILTER (WHERE y > 1997) AS b, count(v) FILTER (WHERE y <= 1997) AS na, count(v) FILTER (WHERE y > 1997) AS nb FROM s GROUP BY ALL),
k AS (SELECT p, r, c, a / 400000 AS before, b / 400000 AS after, na, nb, a / 400000 - b / 400000 AS fall FROM m WHERE a IS NOT NULL AND b IS NOT NULL)"""


def two_seasons(spark, d):
    y, v = F.year("o_orderdate"), c("o_totalprice")
    m = _t(spark, d, "orders").groupBy(c("o_custkey").alias("p")).agg(F.median(F.when(y <= 1997, v)).alias("a"), F.median(F.when(y > 1997, v)).alias("b"), F.count(F.when(y <= 1997, v)).alias("n_before"), F.count(F.when(y > 1997, v)).alias("n_after"))
    return m.where("a is not null and b is not null").select("p", F.floor(c("p") / 50).alias("r"), (c("p") % 50).alias("c"), (c("a") / 400000).alias("before"), (c("b") / 400000).alias("after"), "n_before", "n_after")


@query("landscape_normalised_drop", f"WITH {YEARS} SELECT p, round(fall - (SELECT median(fall) FROM k), 6) + 0.0 AS fall FROM k")
def _(spark, d):
    s = two_seasons(spark, d).withColumn("fall", c("before") - c("after"))
    return raster.minus_landscape(s.select("p", "fall"), "fall").select("p", _r(c("fall")).alias("fall"))


@query("optical_detect", f"""WITH RECURSIVE {YEARS}, cell AS (SELECT r, c, fall - (SELECT median(fall) FROM k) AS fall FROM k WHERE fall - (SELECT median(fall) FROM k) >= 0.05 AND before >= 0.3 AND na >= 2 AND nb >= 2 AND p % 10 <> 0),
reach(r, c, r0, c0) AS (SELECT r, c, r, c FROM cell UNION SELECT n.r, n.c, reach.r0, reach.c0 FROM reach JOIN cell n ON abs(n.r - reach.r) <= 1 AND abs(n.c - reach.c) <= 1),
lab AS (SELECT r, c, min(r0 * 2147483648 + c0) AS component FROM reach GROUP BY ALL), sized AS (SELECT lab.*, cell.fall, count(*) OVER (PARTITION BY component) AS size FROM lab JOIN cell USING (r, c))
SELECT r, c, component, round(fall, 6) AS ndvi_drop FROM sized WHERE size >= {LEAST}""")
def _(spark, d):
    s = two_seasons(spark, d).withColumn("forest", c("p") % 10 != 0)
    out = detect.optical_disturbance(s, detect.Optical(ndvi_drop=0.05, forest_ndvi=0.3, min_observations=2), least=LEAST)
    return out.select("r", "c", "component", _r(c("ndvi_drop")).alias("ndvi_drop"))


BASE = "b AS (SELECT user_id, median(value) AS base FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY user_id)"
DROPS = f"""{BASE}, f AS (SELECT user_id, event_id, ts, base - value AS fall, base - value >= 60 AS dropped FROM events JOIN b USING (user_id) WHERE ts >= TIMESTAMP '2024-01-11'),
w AS (SELECT *, min(dropped::INT) OVER q = 1 AND count(*) OVER q = 2 AS hit FROM f WINDOW q AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)),
g AS (SELECT user_id, min(ts) FILTER (WHERE dropped) AS first_drop, sum(dropped::INT)::BIGINT AS n_dropped, avg(fall) AS drop_db, max(hit) AS run FROM w GROUP BY user_id)"""


def _drops(spark, d):
    e = _t(spark, d, "events")
    base = e.where("ts < timestamp_ntz'2024-01-11'").groupBy("user_id").agg(F.median("value").alias("base"))
    return detect.radar_drops(e.where("ts >= timestamp_ntz'2024-01-11'").select("user_id", "event_id", "ts", "value"), base, ["user_id"], "value", "ts", detect.Radar(drop_db=60.0, passes=2))


@query("radar_baseline", f"WITH {BASE} SELECT user_id, round(base, 6) AS base FROM b")
def _(spark, d):
    return _t(spark, d, "events").where("ts < timestamp_ntz'2024-01-11'").groupBy("user_id").agg(_r(F.median("value")).alias("base"))


@query("radar_consecutive_run", f"WITH {DROPS} SELECT user_id, run FROM g")
def _(spark, d):
    return _drops(spark, d).select("user_id", "run")


@query("radar_detect", f"WITH {DROPS} SELECT user_id, run, n_dropped, round(drop_db, 6) + 0.0 AS drop_db, epoch_ms(first_drop)::BIGINT AS first_drop_millis FROM g WHERE run AND user_id % 10 <> 0")
def _(spark, d):
    g = _drops(spark, d).where(c("run") & (c("user_id") % 10 != 0))
    # the nearest millisecond, as in the SQL, not the one before
    millis = F.expr("round(unix_micros(cast(first_drop AS timestamp)), -3) div 1000")
    return g.select("user_id", "run", "n_dropped", _r(c("drop_db")).alias("drop_db"), millis.alias("first_drop_millis"))


# --- radar geometry and neighbourhoods ------------------------------------------------------------------------------------------------

GEOM = "g AS (SELECT p_partkey, -p_retailprice / 100 AS db, radians(30 + p_size % 15) AS th, radians(p_size % 30) AS sl, radians((p_partkey * 37) % 360) AS asp, radians(100) AS look FROM part), a AS (SELECT *, atan(tan(sl) * cos(look - asp)) AS ar, atan(tan(sl) * sin(look - asp)) AS az, radians(90) - th AS h FROM g)"


def _geometry(spark, d, model):
    p = _t(spark, d, "part").select("p_partkey", (-c("p_retailprice") / 100).alias("db"), F.radians(30 + c("p_size") % 15).alias("th"), F.radians(c("p_size") % 30).alias("sl"), F.radians((c("p_partkey") * 37) % 360).alias("asp"))
    ar, az = spectral.terrain_angles(c("sl"), c("asp"), F.radians(F.lit(100)))
    flat, valid = spectral.slope_correction(c("db"), c("th"), ar, az, model)
    return p.select("p_partkey", _r(flat).alias("flat_db"), valid.alias("valid"))


@query("slope_correction_volume", f"WITH {GEOM} SELECT p_partkey, round(10 * log10(pow(10, db / 10) / cos(th) / (tan(h + ar) / tan(h))), 6) AS flat_db, ar < th AND ar > -h AS valid FROM a")
def _(spark, d):
    return _geometry(spark, d, "volume")


@query("slope_correction_surface", f"WITH {GEOM} SELECT p_partkey, round(10 * log10(pow(10, db / 10) / cos(th) / (cos(h) / (cos(az) * cos(h + ar)))), 6) AS flat_db, ar < th AND ar > -h AS valid FROM a")
def _(spark, d):
    return _geometry(spark, d, "surface")


@query("db_linear_roundtrip", "SELECT p_partkey, round(pow(10, -p_retailprice / 100 / 10), 9) AS linear, round(10 * log10(pow(10, -p_retailprice / 100 / 10)), 6) AS db FROM part")
def _(spark, d):
    lin = spectral.to_linear(-c("p_retailprice") / 100)
    return _t(spark, d, "part").select("p_partkey", _r(lin, 9).alias("linear"), _r(spectral.to_db(lin)).alias("db"))


GRID = "g AS (SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, p_retailprice AS v FROM part)"


def _grid(spark, d):
    return _t(spark, d, "part").select(F.floor(c("p_partkey") / 50).alias("r"), (c("p_partkey") % 50).alias("c"), c("p_retailprice").alias("v"))


@query("speckle_focal_mean", f"WITH {GRID} SELECT a.r, a.c, round(avg(b.v), 6) AS mean FROM g a JOIN g b ON (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 9 GROUP BY ALL")
def _(spark, d):
    return raster.focal_mean(_grid(spark, d), "v").select("r", "c", _r(c("v_mean")).alias("mean"))


@query("terrain_slope_aspect", f"WITH {GRID}, n AS (SELECT a.r, a.c, (e.v - w.v) / 60 AS dx, (s.v - n.v) / 60 AS dy FROM g a LEFT JOIN g e ON e.r = a.r AND e.c = a.c + 1 LEFT JOIN g w ON w.r = a.r AND w.c = a.c - 1 LEFT JOIN g s ON s.r = a.r + 1 AND s.c = a.c LEFT JOIN g n ON n.r = a.r - 1 AND n.c = a.c) SELECT r, c, round(degrees(atan(sqrt(dx * dx + dy * dy))), 6) AS slope, round((degrees(atan2(-dx, dy)) + 360) % 360, 6) AS aspect FROM n")
def _(spark, d):
    out = raster.slope_aspect(_grid(spark, d).withColumnRenamed("v", "dem"))
    return out.select("r", "c", _r(c("slope")).alias("slope"), _r(c("aspect")).alias("aspect"))


@query("overview_mean", f"WITH {GRID} SELECT r // 4 AS r, c // 4 AS c, round(avg(v), 6) AS v FROM g GROUP BY ALL")
def _(spark, d):
    return raster.overview(_grid(spark, d), "v", 4).select("r", "c", _r(c("v")).alias("v"))


@query("zonal_stats", "SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean, round(median(l_extendedprice), 4) AS median, round(corr(l_extendedprice, l_quantity), 6) AS correlation, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1")
def _(spark, d):
    p = _t(spark, d, "lineitem")
    z = raster.zonal(p, "l_extendedprice", "l_quantity", ("l_returnflag",)).drop("total").join(p.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("total")), "l_returnflag")
    return z.select("l_returnflag", _r(c("mean"), 4).alias("mean"), _r(c("median"), 4).alias("median"), _r(c("correlation")).alias("correlation"), _r(c("total"), 2).alias("total"))


# --- class codes ---------------------------------------------------------------------------------------------------------------------

CODES = "k AS (SELECT p_partkey, p_retailprice / 20 AS tc, nullif(p_size % 26, 0) AS ly, (p_partkey % 7 <> 0)::INT AS dm FROM part)"


def _codes(spark, d):
    return _t(spark, d, "part").select("p_partkey", (c("p_retailprice") / 20).alias("tc"), F.nullif(c("p_size") % 26, F.lit(0)).alias("ly"), (c("p_partkey") % 7 != 0).cast("int").alias("dm"))


@query("forest_mask", f"WITH {CODES} SELECT p_partkey, tc >= 30 AND (coalesce(ly, 0) = 0 OR coalesce(ly, 0) >= 15) AND dm = 1 AS forest FROM k")
def _(spark, d):
    return _codes(spark, d).select("p_partkey", detect.forest(c("tc"), c("ly"), c("dm"), 2015).alias("forest"))


@query("loss_mask", f"WITH {CODES} SELECT p_partkey, coalesce(ly, 0) BETWEEN 11 AND 15 AS lost FROM k")
def _(spark, d):
    return _codes(spark, d).select("p_partkey", detect.loss(c("ly"), 2010, 2015).alias("lost"))


@query("loss_code_roundtrip", "SELECT p_partkey, (p_size % 25 + 2001)::INT AS year, (p_size % 25 + 1)::INT AS code, (p_size % 25 + 2001)::INT AS back FROM part")
def _(spark, d):
    year = (c("p_size") % 25 + 2001).cast("int")
    return _t(spark, d, "part").select("p_partkey", year.alias("year"), season.code_of_year(year).alias("code"), season.year_of_code(season.code_of_year(year)).alias("back"))


# --- accuracy ------------------------------------------------------------------------------------------------------------------------

CONF = "s AS (SELECT coalesce(sum(CASE WHEN p AND t THEN a END), 0) AS tp, coalesce(sum(CASE WHEN p AND NOT t THEN a END), 0) AS fp, coalesce(sum(CASE WHEN NOT p AND t THEN a END), 0) AS fn FROM (SELECT l_returnflag = 'R' AS p, l_discount >= 0.05 AS t, l_quantity AS a FROM lineitem))"


def _confusion(spark, d):
    return evaluate.confusion_ha(_t(spark, d, "lineitem"), c("l_returnflag") == "R", c("l_discount") >= 0.05, c("l_quantity"))


@query("score_confusion", f"WITH {CONF} SELECT round(tp, 2) AS tp, round(fp, 2) AS fp, round(fn, 2) AS fn FROM s")
def _(spark, d):
    return _confusion(spark, d).select(*(_r(c(x), 2).alias(x) for x in ("tp", "fp", "fn")))


@query("score_metrics", f"WITH {CONF}, q AS (SELECT *, tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM s) SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1, round(tp / (tp + fp + fn), 6) AS iou FROM q")
def _(spark, d):
    return evaluate.metrics(_confusion(spark, d)).select(*(_r(c(x)).alias(x) for x in ("precision", "recall", "f1", "iou")))


STRATUM = "CASE WHEN {0} < 0.5 THEN 'under_0.5ha' WHEN {0} < 1 THEN '0.5_to_1ha' WHEN {0} < 5 THEN '1_to_5ha' ELSE 'over_5ha' END"


def _wilson(k, n):
    z = 1.96
    return (f"coalesce(greatest(0, ({k}/{n} + {z * z / 2}/{n}) / (1 + {z * z}/{n}) - {z} / (1 + {z * z}/{n}) * sqrt({k}/{n} * (1 - {k}/{n}) / {n} + {z * z / 4} / ({n} * {n}))), 0)",
            f"coalesce(least(1, ({k}/{n} + {z * z / 2}/{n}) / (1 + {z * z}/{n}) + {z} / (1 + {z * z}/{n}) * sqrt({k}/{n} * (1 - {k}/{n}) / {n} + {z * z / 4} / ({n} * {n}))), 1)")


_LO, _HI = _wilson("tp::DOUBLE", "nullif(judged, 0)::DOUBLE")


@query("precision_by_stratum", f"""WITH v AS (SELECT {STRATUM.format("n_chars / 1000.0")} AS stratum, CASE WHEN toxic = 1 THEN 'u' WHEN quality = 1 THEN 't' ELSE 'f' END AS v FROM labels JOIN documents USING (doc_id)),
g AS (SELECT stratum, count(*) FILTER (WHERE v = 't') AS tp, count(*) FILTER (WHERE v = 'f') AS fp, count(*) FILTER (WHERE v = 'u') AS unclear FROM v GROUP BY 1), s AS (SELECT * FROM (VALUES ('under_0.5ha'), ('0.5_to_1ha'), ('1_to_5ha'), ('over_5ha')) x(stratum)),
j AS (SELECT stratum, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(unclear, 0) AS unclear, coalesce(tp + fp, 0) AS judged FROM s LEFT JOIN g USING (stratum))
SELECT stratum, tp, fp, unclear, judged, round(coalesce(tp::DOUBLE / nullif(judged, 0), 0), 6) AS precision, round({_LO}, 6) AS lo, round({_HI}, 6) AS hi FROM j""")
def _(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", stats.size_stratum(c("n_chars") / 1000.0).alias("stratum"))
    v = _t(spark, d, "labels").join(docs, "doc_id").select("stratum", F.when(c("toxic") == 1, "unclear").when(c("quality") == 1, "true_positive").otherwise("false_positive").alias("verdict"))
    return evaluate.precision_report(v).select("stratum", "tp", "fp", "unclear", "judged", *(_r(c(x)).alias(x) for x in ("precision", "lo", "hi")))


@query("wilson_interval", f"WITH q AS (SELECT p_partkey, p_size % 20 AS judged, (p_size % 20) // 2 AS tp FROM part) SELECT p_partkey, round({_LO}, 6) AS lo, round({_HI}, 6) AS hi FROM q")
def _(spark, d):
    n = c("p_size") % 20
    lo, hi = stats.wilson(F.floor(n / 2), n)
    return _t(spark, d, "part").select("p_partkey", _r(lo).alias("lo"), _r(hi).alias("hi"))


def _chi(z, df):
    return f"({df} * pow(1 - 2 / (9 * {df}) + {z} * sqrt(2 / (9 * {df})), 3))"


def _poisson(k):
    z = stats.Z_EXACT
    return f"CASE WHEN {k} = 0 THEN 0 ELSE 0.5 * {_chi(-z, f'(2 * nullif({k}, 0)::DOUBLE)')} END", f"0.5 * {_chi(z, f'(2 * {k} + 2)::DOUBLE')}"


@query("poisson_interval", f"SELECT p_partkey, round({_poisson('(p_size % 20)')[0]}, 6) AS lo, round({_poisson('(p_size % 20)')[1]}, 6) AS hi FROM part")
def _(spark, d):
    lo, hi = stats.poisson(c("p_size") % 20)
    return _t(spark, d, "part").select("p_partkey", _r(lo).alias("lo"), _r(hi).alias("hi"))


def _samples(spark, d):
    return _t(spark, d, "lineitem").select((c("l_extendedprice") / 100000).alias("dist"), (c("l_discount") >= 0.05).cast("int").alias("loss"), (c("l_tax") * 100 >= 5).cast("int").alias("greener"), (c("l_linenumber") * 10).alias("px"), c("l_quantity").alias("w"))


_plo, _phi = _poisson("n_fp")
SWEEP = f"""s AS (SELECT l_extendedprice / 100000 AS dist, l_discount >= 0.05 AS loss, l_tax * 100 >= 5 AS greener, l_linenumber * 10 AS px, l_quantity AS w FROM lineitem),
g AS (SELECT * FROM (VALUES (false), (true)) a(gate), (VALUES (0.35), (0.4), (0.45), (0.5), (0.55)) b(threshold), (VALUES (5), (10), (20), (40)) k("least")),
f AS (SELECT gate, threshold::DOUBLE AS threshold, "least", loss, w, dist >= threshold AND px >= "least" AND NOT (gate AND greener) AS fires FROM s, g),
t AS (SELECT gate, threshold, "least", coalesce(sum(w) FILTER (WHERE fires AND loss), 0) AS tp, coalesce(sum(w) FILTER (WHERE fires AND NOT loss), 0) AS fp, count(*) FILTER (WHERE fires AND NOT loss) AS n_fp, coalesce(sum(w) FILTER (WHERE NOT fires AND loss), 0) AS fn, coalesce(avg(w) FILTER (WHERE NOT loss), 0) AS sw FROM f GROUP BY ALL),
e AS (SELECT *, CASE WHEN n_fp > 0 THEN fp / n_fp ELSE sw END AS each FROM t),
u AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r, coalesce(tp / nullif(tp + {_phi} * each, 0), 0) AS p_lo, coalesce(tp / nullif(tp + {_plo} * each, 0), 0) AS p_hi FROM e)"""


def _sweep(spark, d):
    return evaluate.sweep(_samples(spark, d), [0.35, 0.4, 0.45, 0.5, 0.55], [5, 10, 20, 40])


@query("threshold_sweep", f'WITH {SWEEP} SELECT gate, threshold, "least", n_fp, round(p, 6) AS precision, round(p_lo, 6) AS p_lo, round(p_hi, 6) AS p_hi, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1 FROM u')
def _(spark, d):
    return _sweep(spark, d).select("gate", "threshold", "least", "n_fp", *(_r(c(x)).alias(x) for x in ("precision", "p_lo", "p_hi", "recall", "f1")))


@query("sweep_top5", f'WITH {SWEEP} SELECT gate, threshold, "least", round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1 FROM u WHERE n_fp > 0 ORDER BY f1 DESC, gate DESC, threshold DESC, "least" DESC LIMIT 5')
def _(spark, d):
    return _sweep(spark, d).where("n_fp > 0").select("gate", "threshold", "least", _r(c("f1")).alias("f1")).orderBy(F.desc("f1"), F.desc("gate"), F.desc("threshold"), F.desc("least")).limit(5)


@query("stratified_sample_hash", "SELECT p_partkey, p_size % 3 AS class FROM part QUALIFY row_number() OVER (PARTITION BY p_size % 3 ORDER BY (p_partkey * 2654435761) % 4294967296, p_partkey) <= 20")
def _(spark, d):
    p = _t(spark, d, "part").select("p_partkey", (c("p_size") % 3).alias("class"))
    return evaluate.stratified_top(p, ["class"], [stats.shared_hash(c("p_partkey")), c("p_partkey")], 20)


# --- places and alerts ---------------------------------------------------------------------------------------------------------------

LONLAT = "74.55 + ({0} * 7919 % 3500) / 10000.0 AS lon, 14.80 + ({0} * 104729 % 3500) / 10000.0 AS lat"
PLACES = f"k AS (SELECT c_custkey AS kid, {LONLAT.format('c_custkey')} FROM customer), s AS (SELECT o_orderkey AS pid, k.lon::DOUBLE + ((o_orderkey * 7919) % 401 - 200) / 100000.0 AS lon, k.lat::DOUBLE + ((o_orderkey * 104729) % 401 - 200) / 100000.0 AS lat, o_totalprice / 100000 AS area, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders JOIN k ON kid = o_custkey)"


def _lonlat(key):
    return [(F.lit(74.55) + (c(key) * 7919 % 3500) / 10000.0).alias("lon"), (F.lit(14.80) + (c(key) * 104729 % 3500) / 10000.0).alias("lat")]


def known(spark, d):
    """A place per customer; the formula repeats a place every 3,500 keys."""
    return _t(spark, d, "customer").select(c("c_custkey").alias("kid"), *_lonlat("c_custkey"))


def sightings(spark, d):
    o = _t(spark, d, "orders").join(known(spark, d), c("kid") == c("o_custkey"))
    return o.select(c("o_orderkey").alias("pid"), (c("lon") + ((c("o_orderkey") * 7919) % 401 - 200) / 100000.0).alias("lon"), (c("lat") + ((c("o_orderkey") * 104729) % 401 - 200) / 100000.0).alias("lat"), (c("o_totalprice") / 100000).alias("area_ha"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("observed_on"))


NEAR = f"""WITH {PLACES}, m AS (SELECT pid, kid, 2 * 6371008.8 * asin(sqrt(least(1, pow(sin(radians(k.lat::DOUBLE - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(k.lat::DOUBLE)) * pow(sin(radians(k.lon::DOUBLE - s.lon) / 2), 2)))) AS dist
FROM s JOIN k ON abs(k.lat::DOUBLE - s.lat) < 0.002 AND abs(k.lon::DOUBLE - s.lon) < 0.0025), b AS (SELECT * FROM m WHERE dist <= 150 QUALIFY row_number() OVER (PARTITION BY pid ORDER BY dist, kid) = 1)"""


@query("alert_id", f"WITH {PLACES} SELECT kid, substr(sha256(printf('%.6f,%.6f,%s', lon::DOUBLE, lat::DOUBLE, '2026-01-01')), 1, 16) AS alert_id FROM k")
def _(spark, d):
    return known(spark, d).select("kid", geo.alert_id(c("lon"), c("lat"), F.lit("2026-01-01")).alias("alert_id"))


@query("haversine_nearest", f"{NEAR} SELECT pid, kid AS match_id, round(dist, 4) AS distance_m FROM b")
def _(spark, d):
    return alerts.nearest_within(sightings(spark, d), known(spark, d)).where("match_id is not null").select("pid", "match_id", _r(c("distance_m"), 4).alias("distance_m"))


@query("radius_dedup", f"{NEAR} SELECT pid, kid IS NULL AS is_new FROM s LEFT JOIN b USING (pid)")
def _(spark, d):
    return alerts.nearest_within(sightings(spark, d), known(spark, d)).select("pid", c("match_id").isNull().alias("is_new"))


def _ingested(spark, d):
    s = sightings(spark, d).where("area_ha > 0").select(F.concat(F.lit("area"), (F.floor(c("lat") * 10) % 4).cast("string")).alias("aoi"), c("pid").alias("seq"), "lon", "lat", "area_ha", "observed_on")
    return alerts.ingest(s, None, "2026-01-01")


@query("alert_ingest", None)
def _(spark, d):
    return _ingested(spark, d)


@query("alert_status", f"WITH {PLACES} SELECT pid, CASE WHEN pid % 3 = 0 THEN 'confirmed on multiple passes - requires ground verification' ELSE 'UNCONFIRMED - seen ' || (pid % 4 + 1) || CASE WHEN pid % 4 + 1 = 1 THEN ' pass' ELSE ' passes' END || ', awaiting more' END AS status FROM s")
def _(spark, d):
    return sightings(spark, d).select("pid", text.status(F.when(c("pid") % 3 == 0, "x"), c("pid") % 4 + 1).alias("status"))


@query("size_stratum_counts", f"SELECT {STRATUM.format('o_totalprice / 100000')} AS stratum, count(*) AS n FROM orders GROUP BY 1")
def _(spark, d):
    return _t(spark, d, "orders").groupBy(stats.size_stratum(c("o_totalprice") / 100000).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


@query("size_description", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'about ' || format('{:,}', p_size * 1000) || ' square metres' WHEN p_size < 40 THEN 'roughly ' || printf('%.1f', p_size / 4.0) || ' football pitches' ELSE 'about ' || (p_size * 10) || ' hectares' END AS size FROM part")
def _(spark, d):
    ha = F.when(c("p_size") < 10, c("p_size") / 10.0).when(c("p_size") < 40, c("p_size") / 4.0).otherwise(c("p_size") * 10.0)
    return _t(spark, d, "part").select("p_partkey", text.size_description(ha).alias("size"))


@query("map_urls", f"WITH {PLACES} SELECT kid, printf('https://www.google.com/maps/@%.6f,%.6f,16z/data=!3m1!1e3', lat::DOUBLE, lon::DOUBLE) AS satellite, printf('https://www.openstreetmap.org/?mlat=%.6f&mlon=%.6f#map=16/%.6f/%.6f', lat::DOUBLE, lon::DOUBLE, lat::DOUBLE, lon::DOUBLE) AS map FROM k")
def _(spark, d):
    return known(spark, d).select("kid", geo.satellite_url(c("lat"), c("lon")).alias("satellite"), geo.map_url(c("lat"), c("lon")).alias("map"))


@query("utm_zone", f"WITH {PLACES} SELECT kid, (least(floor((lon::DOUBLE * 2 - 150 + kid % 300 - 100 + 180) / 6)::INT + 1, 60) + CASE WHEN kid % 2 = 0 THEN 32600 ELSE 32700 END)::INT AS epsg FROM k")
def _(spark, d):
    return known(spark, d).select("kid", geo.utm_epsg(c("lon") * 2 - 150 + c("kid") % 300 - 100, F.when(c("kid") % 2 == 0, c("lat")).otherwise(-c("lat"))).alias("epsg"))


@query("bbox_area", f"WITH {PLACES} SELECT kid, round(abs(pow(6371007.181, 2) * radians(0.1) * (sin(radians(lat::DOUBLE + 0.1)) - sin(radians(lat::DOUBLE)))) / 1e6, 6) AS km2 FROM k")
def _(spark, d):
    return known(spark, d).select("kid", _r(geo.bbox_area_km2(F.lit(0.0), c("lat"), F.lit(0.1), c("lat") + 0.1)).alias("km2"))


@query("web_mercator_tile", f"WITH {PLACES} SELECT kid, floor((lon::DOUBLE + 180) / 360 * pow(2, 17))::BIGINT AS x, floor((1 - ln(tan(radians(lat::DOUBLE)) + 1 / cos(radians(lat::DOUBLE))) / pi()) / 2 * pow(2, 17))::BIGINT AS y FROM k")
def _(spark, d):
    x, y = geo.mercator_px(c("lon"), c("lat"), 17)
    return known(spark, d).select("kid", F.floor(x / 256).alias("x"), F.floor(y / 256).alias("y"))


@query("grid_tiles", f"WITH {PLACES} SELECT floor((lon::DOUBLE - 74.55) / 0.0875)::BIGINT AS i, floor((lat::DOUBLE - 14.8) / 0.0875)::BIGINT AS j, count(*) AS n FROM k GROUP BY ALL")
def _(spark, d):
    i, j = area.cell_of(74.55, 14.8, 0.0875, c("lon"), c("lat"))
    return known(spark, d).groupBy(i.alias("i"), j.alias("j")).agg(F.count(F.lit(1)).alias("n"))


@query("tile_union_antijoin", "WITH t AS (SELECT DISTINCT c_custkey % 36 AS tile FROM customer UNION SELECT s_suppkey % 40 FROM supplier) SELECT tile FROM t WHERE tile NOT IN (SELECT n_nationkey FROM nation)")
def _(spark, d):
    t = _t(spark, d, "customer").select((c("c_custkey") % 36).alias("tile")).unionByName(_t(spark, d, "supplier").select((c("s_suppkey") % 40).alias("tile"))).distinct()
    return stores.missing_tiles(t, _t(spark, d, "nation").select(c("n_nationkey").cast("long").alias("tile")))


@query("worksheet_semijoin", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(spark, d):
    w = _t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(c("c_custkey").alias("o_custkey"))
    return stores.on_worksheet(_t(spark, d, "orders"), w, "o_custkey").select("o_orderkey")


# --- dates and texts -----------------------------------------------------------------------------------------------------------------


@query("season_windows", "SELECT DISTINCT y, make_date(y, 10, 1) AS season_start, make_date(y + 1, 1, 1) AS season_end FROM (SELECT year(o_orderdate)::INT AS y FROM orders)")
def _(spark, d):
    y = _t(spark, d, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    start, end = season.Season(10, 12).dates(c("y"))
    return y.select("y", start.alias("season_start"), end.alias("season_end"))


@query("complete_year", "SELECT o_orderkey, (CASE WHEN month(o_orderdate) > 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END)::INT AS complete, (CASE WHEN month(o_orderdate) > 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END - 1)::INT AS base FROM orders")
def _(spark, d):
    base, complete = season.Season(1, 3).compared_years(c("o_orderdate"))
    return _t(spark, d, "orders").select("o_orderkey", complete.alias("complete"), base.alias("base"))


@query("baseline_window", "SELECT o_orderkey, (o_orderdate::DATE - 365) AS window_start, o_orderdate::DATE AS window_end FROM orders")
def _(spark, d):
    day = c("o_orderdate").cast("date")
    start, end = season.baseline(day, 365)
    return _t(spark, d, "orders").select("o_orderkey", start.alias("window_start"), end.alias("window_end"))


@query("nearest_release", "WITH r AS (SELECT s_suppkey AS release, DATE '1995-01-01' + (s_suppkey * 37 % 2400)::INT AS captured FROM supplier), t AS (SELECT DISTINCT o_orderdate::DATE AS target FROM orders) SELECT target, release, captured, abs(target - captured)::INT AS gap FROM t, r QUALIFY row_number() OVER (PARTITION BY target ORDER BY abs(target - captured), captured DESC, release) = 1")
def _(spark, d):
    rel = _t(spark, d, "supplier").select(c("s_suppkey").alias("release"), F.date_add(F.lit("1995-01-01").cast("date"), (c("s_suppkey") * 37 % 2400).cast("int")).alias("captured"))
    return stores.nearest_release(_t(spark, d, "orders").select(c("o_orderdate").cast("date").alias("target")), rel)


def _probe_sql() -> str:
    return " ".join(f"WHEN {' OR '.join(f'''contains(m, '{p}')''' for p in probes)} THEN '{kind}'" for kind, probes in text.PROBES)


@query("error_classification", f"WITH t AS (SELECT doc_id, lower(text || CASE doc_id % 6 WHEN 0 THEN ' Quota exceeded' WHEN 1 THEN ' project not registered' WHEN 2 THEN ' SSLError at /token' WHEN 3 THEN ' please authenticate' WHEN 4 THEN ' 403 Forbidden' ELSE '' END) AS m FROM documents) SELECT doc_id, CASE {_probe_sql()} ELSE 'unknown' END AS kind FROM t")
def _(spark, d):
    tail = F.element_at(F.array(*(F.lit(x) for x in (" Quota exceeded", " project not registered", " SSLError at /token", " please authenticate", " 403 Forbidden", ""))), (c("doc_id") % 6 + 1).cast("int"))
    return _t(spark, d, "documents").select("doc_id", text.error_kind(F.concat("text", tail)).alias("kind"))
