"""Further queries over the driver's tables: areas, collections, masks, outlines, records, reports, settings of an evaluation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from canopyflow.functions import geo, masks, season, spectral, stats, text
from canopyflow.operators import alerts, area, components, cycle, detect, evaluate, outline, radar, raster, report, scenes, stack
from canopyflow.plans.catalog import CAND, FAR, GRID, PLACES, PX, STRATUM, _cc, _grid, _r, _t, c, candidates, known, pairs, query, sightings
from canopyflow.sources import aligned, collections, stores

BOX = area.Box(74.60, 14.85, 74.80, 15.00)
INSIDE = "lon BETWEEN 74.60 AND 74.80 AND lat BETWEEN 14.85 AND 15.00"

# --- areas ---------------------------------------------------------------------------------------------------------------------------


@query("footprint_filter", f"WITH {PLACES} SELECT kid FROM k WHERE lon::DOUBLE <= 74.8 AND lon::DOUBLE + 0.05 >= 74.6 AND lat::DOUBLE <= 15.0 AND lat::DOUBLE + 0.05 >= 14.85")
def _(spark, d):
    k = known(spark, d)
    return k.where(area.touches(BOX, c("lon"), c("lat"), c("lon") + 0.05, c("lat") + 0.05)).select("kid")


@query("clip_to_area", f"WITH {PLACES} SELECT kid FROM (SELECT kid, lon::DOUBLE AS lon, lat::DOUBLE AS lat FROM k) WHERE {INSIDE}")
def _(spark, d):
    return area.clip(known(spark, d), BOX).select("kid")


@query("area_tiles", f"WITH {PLACES} SELECT least(floor((lon - 74.6) / ((74.8 - 74.6) / 4)), 3)::BIGINT AS i, least(floor((lat - 14.85) / ((15.0 - 14.85) / 4)), 3)::BIGINT AS j, count(*) AS n FROM (SELECT lon::DOUBLE AS lon, lat::DOUBLE AS lat FROM k) WHERE {INSIDE} GROUP BY ALL")
def _(spark, d):
    i, j = area.tile_of(BOX, 4, c("lon"), c("lat"))
    return area.clip(known(spark, d), BOX).groupBy(i.alias("i"), j.alias("j")).agg(F.count(F.lit(1)).alias("n"))


@query("chip_bounds", f"WITH {PLACES} SELECT kid, round(lon::DOUBLE - 250 / (111320.0 * cos(radians(lat::DOUBLE))), 6) AS west, round(lat::DOUBLE - 250 / 111320.0, 6) AS south, round(lon::DOUBLE + 250 / (111320.0 * cos(radians(lat::DOUBLE))), 6) AS east, round(lat::DOUBLE + 250 / 111320.0, 6) AS north FROM k")
def _(spark, d):
    x, y = geo.half_width_degrees(250.0, c("lat"))
    return known(spark, d).select("kid", _r(c("lon") - x).alias("west"), _r(c("lat") - y).alias("south"), _r(c("lon") + x).alias("east"), _r(c("lat") + y).alias("north"))


@query("area_slugs", "SELECT n_nationkey, regexp_replace(lower(n_name), '[ _]', '-', 'g') AS slug FROM nation")
def _(spark, d):
    return _t(spark, d, "nation").select("n_nationkey", geo.slug(c("n_name")).alias("slug"))


@query("pixels_to_hectares", "SELECT p_partkey, round(p_size * (30.0 * 30.0 / 1e4), 6) AS ha FROM part")
def _(spark, d):
    return _t(spark, d, "part").select("p_partkey", _r(geo.pixels_to_ha(c("p_size"), 30.0)).alias("ha"))


# --- collections ---------------------------------------------------------------------------------------------------------------------


@query("scene_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) = '1' AND o_custkey % 3 <> 0")
def _(spark, d):
    pols = F.when(c("o_custkey") % 3 == 0, F.array(F.lit("VV"))).otherwise(F.array(F.lit("VV"), F.lit("VH")))
    s = _t(spark, d, "orders").select("o_orderkey", c("o_orderstatus").alias("orbit_pass"), F.substring("o_orderpriority", 1, 1).alias("mode"), pols.alias("pols"))
    return collections.radar_scenes(s, "F", mode="1").select("o_orderkey")


@query("available_years", "SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders")
def _(spark, d):
    return collections.available_years(_t(spark, d, "orders"), ts="o_orderdate")


@query("latest_year_mosaic", "WITH y AS (SELECT max(year(o_orderdate)) AS y FROM orders) SELECT o_custkey, round(max_by(o_totalprice, (o_orderdate, o_orderkey)), 6) AS value FROM orders, y WHERE year(o_orderdate) = y GROUP BY o_custkey")
def _(spark, d):
    o = _t(spark, d, "orders")
    last = collections.latest_year(o, ts="o_orderdate")
    return collections.annual(o, last, ["o_custkey"], "o_totalprice", "o_orderkey", ts="o_orderdate").select("o_custkey", _r(c("o_totalprice")).alias("value"))


@query("first_scene", "SELECT user_id, min_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def _(spark, d):
    return collections.first_scene(_t(spark, d, "events"), ["user_id"], scene="event_id")


@query("property_list", "SELECT o_orderstatus, array_to_string(list_sort(list(DISTINCT year(o_orderdate))), ',') AS years FROM orders GROUP BY o_orderstatus")
def _(spark, d):
    held = collections.property_list(_t(spark, d, "orders"), ["o_orderstatus"], F.year("o_orderdate"))
    return held.select("o_orderstatus", F.array_join("values", ",").alias("years"))


@query("scene_properties", "SELECT event_id, event_type AS sensor, strftime(ts, '%Y') AS year, 'median' AS reducer FROM events")
def _(spark, d):
    return collections.with_properties(_t(spark, d, "events"), {"reducer": "median"}).select("event_id", c("event_type").alias("sensor"), "year", "reducer")


BANDS_SQL = "SELECT unnest(['vec_id', 'embedding', 'label', 'text']) AS band, unnest([count(vec_id), count(embedding), count(label), NULL]) AS n FROM embeddings"


@query("missing_bands", f"WITH b AS ({BANDS_SQL}) SELECT band FROM b WHERE coalesce(n, 0) = 0")
def _(spark, d):
    held = collections.valid_counts(_t(spark, d, "embeddings"), ["vec_id", "embedding", "label", "text"])
    return held.where("n = 0").select("band")


@query("band_names", f"WITH b AS ({BANDS_SQL}) SELECT band, n FROM b WHERE n IS NOT NULL")
def _(spark, d):
    e = _t(spark, d, "embeddings")
    return collections.valid_counts(e, e.columns)


@query("newest_basemap", "SELECT o_orderkey, o_orderdate::DATE AS captured FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1995-12-30' QUALIFY row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) = 1")
def _(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", c("o_orderdate").cast("date").alias("captured"))
    return collections.newest_within_year(o.groupBy("captured").agg(F.min("o_orderkey").alias("o_orderkey")), 1995).select("o_orderkey", "captured")


@query("release_titles", "SELECT s_suppkey AS release, DATE '2015-01-01' + (s_suppkey % 900)::INT AS captured FROM supplier WHERE s_suppkey % 5 <> 0")
def _(spark, d):
    day = F.date_add(F.lit("2015-01-01").cast("date"), (c("s_suppkey") % 900).cast("int")).cast("string")
    titles = _t(spark, d, "supplier").select(c("s_suppkey").alias("release"), F.when(c("s_suppkey") % 5 != 0, F.concat(F.lit("World imagery ("), day, F.lit(")"))).otherwise(F.lit("World imagery")).alias("title"))
    return stores.releases(titles)


@query("newest_release", "SELECT s_suppkey AS release, DATE '2015-01-01' + (s_suppkey * 37 % 900)::INT AS captured FROM supplier QUALIFY row_number() OVER (ORDER BY s_suppkey * 37 % 900 DESC, s_suppkey) = 1")
def _(spark, d):
    rel = _t(spark, d, "supplier").select(c("s_suppkey").alias("release"), F.date_add(F.lit("2015-01-01").cast("date"), (c("s_suppkey") * 37 % 900).cast("int")).alias("captured"))
    return stores.newest_release(rel)


# --- masks and codes -----------------------------------------------------------------------------------------------------------------

TRI = "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS a, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b, p_size::DOUBLE AS v FROM part"


def _tri(spark, d):
    three = lambda x: F.when(x % 3 == 0, True).when(x % 3 == 1, False)
    return _t(spark, d, "part").select("p_partkey", three(c("p_size")).alias("a"), three(c("p_partkey")).alias("b"), c("p_size").cast("double").alias("v"))


@query("mask_logic", f"WITH t AS ({TRI}) SELECT p_partkey, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a AND b END AS both, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a OR b END AS either, coalesce(a, false) AS known FROM t")
def _(spark, d):
    return _tri(spark, d).select("p_partkey", masks.mask_and(c("a"), c("b")).alias("both"), masks.mask_or(c("a"), c("b")).alias("either"), masks.unmask(c("a")).alias("known"))


@query("mask_update", f"WITH t AS ({TRI}) SELECT p_partkey, CASE WHEN a THEN v END AS kept, CASE WHEN v % 2 <> 0 THEN v % 2 END AS own FROM t")
def _(spark, d):
    return _tri(spark, d).select("p_partkey", masks.update_mask(c("v"), c("a")).alias("kept"), masks.self_mask(c("v") % 2).alias("own"))


@query("loss_codes", "SELECT p_partkey, (p_size % 25 + 1)::INT AS code, (p_size % 25 + 2001)::INT AS year FROM part")
def _(spark, d):
    code = (c("p_size") % 25 + 1).cast("int")
    return _t(spark, d, "part").select("p_partkey", season.code_of_year(season.year_of_code(code)).alias("code"), season.year_of_code(code).alias("year"))


@query("comparison_years", "SELECT o_orderkey, (CASE WHEN month(o_orderdate) > 5 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END - 2)::INT AS base, (CASE WHEN month(o_orderdate) > 5 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END)::INT AS recent FROM orders")
def _(spark, d):
    base, recent = season.Season(2, 5).compared_years(c("o_orderdate"), 2)
    return _t(spark, d, "orders").select("o_orderkey", base.alias("base"), recent.alias("recent"))


@query("season_dates", "SELECT DISTINCT y, make_date(y, 2, 1) AS first, make_date(y, 6, 1) AS past FROM (SELECT year(o_orderdate)::INT AS y FROM orders)")
def _(spark, d):
    first, past = season.Season(2, 5).dates(c("y"))
    return _t(spark, d, "orders").select(F.year("o_orderdate").alias("y")).distinct().select("y", first.alias("first"), past.alias("past"))


@query("remedies", "SELECT p_partkey, CASE p_size % 2 WHEN 0 THEN 'The service could not be reached; check proxy, certificates and connection.' ELSE 'No valid credentials; sign in again or name a key file.' END AS remedy FROM part")
def _(spark, d):
    kind = F.when(c("p_size") % 2 == 0, "network").otherwise("not_authenticated")
    return _t(spark, d, "part").select("p_partkey", text.remedy(kind).alias("remedy"))


@query("chip_pairs_match", "SELECT a.vec_id, avg(abs(a.x - b.x)) < 3 AS same FROM (SELECT vec_id, unnest(embedding)::DOUBLE * 40 AS x, unnest(range(64)) AS i FROM embeddings) a JOIN (SELECT vec_id - 1 AS vec_id, unnest(embedding)::DOUBLE * 40 AS x, unnest(range(64)) AS i FROM embeddings) b USING (vec_id, i) GROUP BY a.vec_id")
def _(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.transform(c("embedding").cast("array<double>"), lambda x: x * 40).alias("x"))
    both = e.join(e.select((c("vec_id") - 1).alias("vec_id"), c("x").alias("y")), "vec_id")
    return both.select("vec_id", spectral.pairs_match(c("x"), c("y")).alias("same"))


@query("display_values", "SELECT p_partkey, round(pow(least(greatest((p_retailprice - 950) / 800, 0), 1), 1 / 1.4) * 255, 6) AS shown FROM part")
def _(spark, d):
    return _t(spark, d, "part").select("p_partkey", _r(raster.display_value(c("p_retailprice"), 950.0, 1750.0, 1.4)).alias("shown"))


# --- rasters -------------------------------------------------------------------------------------------------------------------------


@query("speckle_linear_power", f"WITH {GRID} SELECT a.r, a.c, round(10 * log10(avg(pow(10, b.v / 1000))), 6) AS mean FROM g a JOIN g b ON (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 9 GROUP BY ALL")
def _(spark, d):
    return raster.speckle_filter(_grid(spark, d).withColumn("v", c("v") / 100), "v").select("r", "c", _r(c("v_mean")).alias("mean"))


@query("look_direction", "SELECT event_type, round(radians(avg(value)), 6) AS look FROM events GROUP BY event_type")
def _(spark, d):
    return _t(spark, d, "events").groupBy("event_type").agg(_r(collections.look_direction("value")).alias("look"))


@query("overview_by_area", f"WITH {GRID} SELECT r % 2 AS area, r // 4 AS r, c // 4 AS c, round(avg(v), 6) AS v FROM g GROUP BY ALL")
def _(spark, d):
    return raster.overview(_grid(spark, d).withColumn("area", c("r") % 2), "v", 4, ("area",)).select("area", "r", "c", _r(c("v")).alias("v"))


@query("embedding_distances", f"WITH {CAND.split(', cand AS')[0]} SELECT p, round(list_distance(x, y), 6) AS l2, round(1 - list_inner_product(x, y), 6) + 0.0 AS cosine FROM pair")
def _(spark, d):
    return pairs(spark, d).select("p", _r(spectral.l2_distance(c("x"), c("y"))).alias("l2"), _r(spectral.cosine_distance(c("x"), c("y"))).alias("cosine"))


def _labelled(spark, d):
    return components.label_components(candidates(spark, d).where(c("distance") >= FAR).select("r", "c"), tile=8)


#: Every ring of every patch: sides with the patch on the right, each followed by the side that leaves where it ends, where two do the one to the left.
RINGS = f"""{_cc(f"distance >= {FAR}")}, way(d, dr, dc, sr, sc, nr, nc) AS (VALUES (0, 0, 1, 0, 0, -1, 0), (1, 1, 0, 0, 1, 0, 1), (2, 0, -1, 1, 1, 1, 0), (3, -1, 0, 1, 0, 0, -1)),
side AS (SELECT s.component, s.r + sr AS r, s.c + sc AS c, d, dr, dc FROM sized s, way LEFT JOIN sized n ON n.component = s.component AND n.r = s.r + nr AND n.c = s.c + nc WHERE n.r IS NULL),
many AS (SELECT component, r, c, count(*) AS n FROM side GROUP BY ALL),
tie AS (SELECT a.component, a.r, a.c, a.d, b.r AS r2, b.c AS c2, b.d AS d2 FROM side a JOIN side b ON b.component = a.component AND b.r = a.r + a.dr AND b.c = a.c + a.dc JOIN many m ON m.component = b.component AND m.r = b.r AND m.c = b.c WHERE m.n = 1 OR b.d = (a.d + 3) % 4),
walk(component, r0, c0, d0, r, c, d, k) AS (SELECT component, r, c, d, r, c, d, 0 FROM side UNION ALL SELECT w.component, w.r0, w.c0, w.d0, t.r2, t.c2, t.d2, w.k + 1 FROM walk w JOIN tie t ON t.component = w.component AND t.r = w.r AND t.c = w.c AND t.d = w.d WHERE (t.r2, t.c2, t.d2) > (w.r0, w.c0, w.d0)),
full_ring AS (SELECT w.component, w.r0, w.c0, w.d0 FROM walk w JOIN tie t ON t.component = w.component AND t.r = w.r AND t.c = w.c AND t.d = w.d WHERE (t.r2, t.c2, t.d2) = (w.r0, w.c0, w.d0)),
place AS (SELECT w.*, lag(w.d) OVER (PARTITION BY w.component, w.r0, w.c0, w.d0 ORDER BY w.k) AS was FROM walk w JOIN full_ring f USING (component, r0, c0, d0)),
ring AS (SELECT component, r0, c0, string_agg(r || ' ' || c, ', ' ORDER BY k) FILTER (WHERE was IS NULL OR was <> d) || ', ' || r0 || ' ' || c0 AS points, count(*) AS sides, sum(CASE d WHEN 0 THEN -r WHEN 1 THEN c WHEN 2 THEN r ELSE -c END) / 2.0 AS area FROM place GROUP BY component, r0, c0, d0)"""


@query("patch_rings", f"{RINGS} SELECT component, points, sides, area FROM ring")
def _(spark, d):
    return outline.rings(_labelled(spark, d), tile=5).select("component", outline.text(c("points")).alias("points"), "sides", "area")


@query("patch_outlines", f"{RINGS} SELECT component, max(points) FILTER (WHERE area > 0) AS ring, count(*) FILTER (WHERE area < 0) AS holes, sum(sides)::BIGINT AS sides FROM ring GROUP BY component")
def _(spark, d):
    return outline.outlines(_labelled(spark, d)).select("component", outline.text(c("ring")).alias("ring"), c("holes").cast("long").alias("holes"), "sides")


FLOOR = 0.029


@query("patches_by_area", f"{_cc(f'distance >= {FAR}')} SELECT component, count(*) AS n_px, round(sum({PX}), 6) AS area_ha FROM sized GROUP BY component HAVING sum({PX}) >= {FLOOR}")
def _(spark, d):
    return cycle.large_patches(_labelled(spark, d), F.lit(14.8) + c("r") / 10000.0, FLOOR).select("component", "n_px", _r(c("area_ha")).alias("area_ha"))


#: The grid of the cycle's stand-in: rows go south from 15 degrees.
STEP, NORTH, WEST = 0.0001, 15.0, 74.6
SOUTHWARD = f"{(10.0 / 6378137.0) ** 2 * 6371008.8**2 / 1e4!r} * cos(radians({NORTH} - (r + 0.5) * {STEP}))"


@query("cycle_patches", f"{_cc(f'distance >= {FAR} AND forest AND greenness_loss > 0')} SELECT component, count(*) AS n_px, round(sum({SOUTHWARD}), 6) AS area_ha FROM sized WHERE size >= 2 GROUP BY component HAVING sum({SOUTHWARD}) >= 0.015")
def _(spark, d):
    found = cycle.patch_records(candidates(spark, d), WEST, NORTH, STEP, detect.Embedding(distance=FAR, min_ha=0.015), least=2)
    return found.select("component", "n_px", _r(c("area_ha")).alias("area_ha"))


@query("run_cycle", None)
def _(spark, d):
    """The store after two cycles over the same pixels: what the second sees again is confirmed."""
    config, store = detect.Embedding(distance=FAR, min_ha=0.015), None
    for day in ("2026-01-01", "2026-02-01"):
        store = cycle.run_cycle(candidates(spark, d), store, "area", (2024, 2025), day, WEST, NORTH, STEP, config, least=2).store
    return store


@query("radar_patches", "WITH e AS (SELECT user_id, ts, event_id, value, lead(value) OVER w AS next FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), u AS (SELECT user_id, avg(100 - value) AS drop_db, count(*) FILTER (WHERE value <= 97.5) AS n_dropped, bool_or(value <= 97.5 AND next <= 97.5) AS run FROM e GROUP BY user_id), p AS (SELECT user_id // 25 AS r, user_id % 25 AS c, * FROM u WHERE run AND user_id % 4 <> 0), z AS (SELECT a.r, a.c, a.drop_db, a.n_dropped FROM p a WHERE EXISTS (SELECT 1 FROM p b WHERE abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND (a.r, a.c) <> (b.r, b.c))) SELECT r, c, round(drop_db, 6) AS drop_db, n_dropped FROM z")
def _(spark, d):
    e = _t(spark, d, "events").select("user_id", "ts", "event_id", "value")
    base = e.select("user_id").distinct().withColumn("base", F.lit(100.0))
    drops = detect.radar_drops(e, base, ["user_id"], "value", "ts").withColumn("r", F.floor(c("user_id") / 25)).withColumn("c", c("user_id") % 25).withColumn("forest", c("user_id") % 4 != 0)
    return detect.radar_disturbance(drops, 2).select("r", "c", _r(c("drop_db")).alias("drop_db"), "n_dropped")


# --- records, stores, reports ----------------------------------------------------------------------------------------------------------


def _store(spark, d):
    """A store of one area: an alert per order."""
    s = sightings(spark, d)
    return s.select("pid", geo.alert_id(c("lon"), c("lat"), F.lit("2026-01-01")).alias("alert_id"), "lon", "lat", (c("area_ha")).alias("area_ha"), F.lit("2026-01-01").alias("first_seen"), F.lit("2026-02-01").alias("last_seen"), (c("pid") % 4 + 1).cast("int").alias("confirmations"), F.when(c("pid") % 3 == 0, "2026-02-01").alias("notified_on"))


@query("patch_record_centroids", f"WITH {PLACES} SELECT kid AS seq, round((lon::DOUBLE * 5 + 0.002) / 5, 6) AS lon, round((lat::DOUBLE * 5 + 0.002) / 5, 6) AS lat, round(0.25 + kid % 7, 6) AS area_ha FROM k")
def _(spark, d):
    at = lambda x, y: F.array(c("lon") + x, c("lat") + y)
    ring = F.array(at(0.0, 0.0), at(0.001, 0.0), at(0.001, 0.001), at(0.0, 0.001), at(0.0, 0.0))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    record = F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct((0.25 + c("kid") % 7).alias("area_ha")).alias("properties")))
    got = stores.detections(known(spark, d).select(F.lit("a").alias("aoi"), c("kid").alias("seq"), record.alias("record")), "2026-01-01")
    return got.select("seq", _r(c("lon")).alias("lon"), _r(c("lat")).alias("lat"), _r(c("area_ha")).alias("area_ha"))


@query("store_totals", f"WITH {PLACES} SELECT count(*) AS alerts, count(*) FILTER (WHERE pid % 3 = 0) AS notified, count(*) FILTER (WHERE pid % 3 <> 0) AS pending, round(sum(area), 4) AS total_ha FROM s")
def _(spark, d):
    s = _store(spark, d)
    one = lambda df, n: df.agg(F.count(F.lit(1)).alias(n))
    return one(s, "alerts").crossJoin(one(alerts.notified(s), "notified")).crossJoin(one(alerts.pending(s), "pending")).crossJoin(s.agg(_r(F.sum("area_ha"), 4).alias("total_ha")))


@query("worksheet_rows", f"WITH {PLACES} SELECT substr(sha256(printf('%.6f,%.6f,%s', lon, lat, '2026-01-01')), 1, 16) AS alert_id, {STRATUM.format('area')} AS stratum, printf('%.6f', lat) AS lat, printf('%.6f', lon) AS lon, (pid % 4 + 1)::INT AS confirmations, '' AS verdict FROM s")
def _(spark, d):
    return stores.worksheet(_store(spark, d)).select("alert_id", "stratum", "lat", "lon", "confirmations", "verdict")


@query("verdicts_cleaned", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'true_positive' WHEN 1 THEN 'false_positive' ELSE 'unclear' END AS verdict FROM orders WHERE o_orderkey % 4 <> 0")
def _(spark, d):
    raw = F.when(c("o_orderkey") % 4 == 0, "  ").when(c("o_orderkey") % 3 == 0, " True_Positive").when(c("o_orderkey") % 3 == 1, "FALSE_POSITIVE ").otherwise("unclear")
    return stores.judged(_t(spark, d, "orders").select("o_orderkey", raw.alias("verdict"), F.lit(None).cast("string").alias("note"))).select("o_orderkey", "verdict")


@query("sample_ids", "SELECT o_orderstatus, substr(sha256(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR)), 1, 12) AS sample_id FROM orders GROUP BY o_orderstatus")
def _(spark, d):
    return evaluate.sample_id(_t(spark, d, "orders"), ["o_orderstatus"], c("o_orderkey"))


@query("alert_lines", f"WITH {PLACES} SELECT pid, '  Location      : ' || printf('%.5f, %.5f', lat, lon) AS location, '  Confirmations : ' || (pid % 4 + 1) || CASE WHEN pid % 4 = 0 THEN ' separate satellite pass' ELSE ' separate satellite passes' END AS confirmed FROM s")
def _(spark, d):
    lines = F.split(report.alert_text("area"), "\n")
    return _store(spark, d).select("pid", lines[2].alias("location"), lines[5].alias("confirmed"))


@query("geojson_status", f"WITH {PLACES} SELECT substr(sha256(printf('%.6f,%.6f,%s', lon, lat, '2026-01-01')), 1, 16) AS alert_id, round(lon, 6) AS lon, round(lat, 6) AS lat, (pid % 4 + 1)::BIGINT AS confirmations FROM s")
def _(spark, d):
    at = lambda path: F.get_json_object("feature", path)
    return report.features(_store(spark, d)).select(at("$.properties.alert_id").alias("alert_id"), _r(at("$.geometry.coordinates[0]").cast("double")).alias("lon"), _r(at("$.geometry.coordinates[1]").cast("double")).alias("lat"), at("$.properties.confirmations").cast("long").alias("confirmations"))


@query("digest_order", f"WITH {PLACES} SELECT row_number() OVER (ORDER BY area DESC, pid) AS place, pid FROM s WHERE pid % 3 = 0")
def _(spark, d):
    return report.ranked(alerts.notified(_store(spark, d)), "pid").select("place", "pid")


@query("confirmations_of_fixed", "WITH d AS (SELECT user_id, ts::DATE AS day, lag(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT user_id, count(*) FILTER (WHERE before IS NULL OR before <> day) AS confirmations FROM d GROUP BY user_id")
def _(spark, d):
    e = _t(spark, d, "events").withColumn("day", c("ts").cast("date"))
    return alerts.confirmations_of_fixed(e, ["user_id"], "day", ["ts", "event_id"]).select("user_id", c("confirmations").cast("long").alias("confirmations"))


# --- evaluation ----------------------------------------------------------------------------------------------------------------------


@query("pooled_precision", "WITH t AS (SELECT count(*) FILTER (WHERE o_orderkey % 3 = 0) AS tp, count(*) FILTER (WHERE o_orderkey % 3 = 1) AS fp FROM orders) SELECT tp, fp, round(tp / (tp + fp), 6) AS precision FROM t")
def _(spark, d):
    v = F.when(c("o_orderkey") % 3 == 0, "true_positive").when(c("o_orderkey") % 3 == 1, "false_positive").otherwise("unclear")
    judged = _t(spark, d, "orders").select(stats.size_stratum(c("o_totalprice") / 100000).alias("stratum"), v.alias("verdict"))
    return evaluate.pooled(evaluate.precision_report(judged)).select("tp", "fp", _r(c("precision")).alias("precision"))


@query("sample_weights", "WITH a AS (SELECT o_custkey % 36 AS tile, o_orderstatus AS loss, sum(o_totalprice) AS ha FROM orders GROUP BY ALL), s AS (SELECT o_custkey % 36 AS tile, o_orderstatus AS loss, o_orderkey FROM orders WHERE o_orderkey % 10 = 0) SELECT o_orderkey, round(ha / count(*) OVER (PARTITION BY tile, loss) + 0.001, 2) AS w FROM s JOIN a USING (tile, loss)")
def _(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", (c("o_custkey") % 36).alias("tile"), c("o_orderstatus").alias("loss"), "o_totalprice")
    areas = evaluate.stratum_areas(o, ["tile", "loss"], "o_totalprice")
    return evaluate.weighted(o.where("o_orderkey % 10 = 0"), areas, ["tile", "loss"]).select("o_orderkey", _r(c("w") + 0.001, 2).alias("w"))


@query("stratum_areas", "SELECT o_custkey % 36 AS tile, o_orderstatus AS loss, round(sum(o_totalprice), 2) AS stratum_ha FROM orders GROUP BY ALL")
def _(spark, d):
    o = _t(spark, d, "orders").select((c("o_custkey") % 36).alias("tile"), c("o_orderstatus").alias("loss"), "o_totalprice")
    return evaluate.stratum_areas(o, ["tile", "loss"], "o_totalprice").select("tile", "loss", _r(c("stratum_ha"), 2).alias("stratum_ha"))


# --- thresholds at once, isolated sightings ---------------------------------------------------------------------------------------------

#: Thresholds of the stand-in sweep.
STEPS = (1.35, 1.40, 1.45, 1.50, 1.55)
STACK = f"""WITH RECURSIVE {CAND}, t(i, t) AS (VALUES {", ".join(f"({i}, {t})" for i, t in enumerate(STEPS))}), cell AS (SELECT i, r, c FROM cand, t WHERE distance >= t AND forest),
reach(i, r, c, r0, c0) AS (SELECT i, r, c, r, c FROM cell UNION SELECT n.i, n.r, n.c, reach.r0, reach.c0 FROM reach JOIN cell n ON n.i = reach.i AND abs(n.r - reach.r) <= 1 AND abs(n.c - reach.c) <= 1),
size AS (SELECT i, r, c, count(*) AS n FROM reach GROUP BY ALL), stack AS (SELECT c.r, c.c, c.distance, c.p, (c.greenness_loss <= 0)::INT AS greener, {", ".join(f"coalesce(max(n) FILTER (WHERE i = {i}), 0) AS px{i}" for i in range(5))} FROM cand c LEFT JOIN size s USING (r, c) WHERE c.forest GROUP BY ALL)"""


def _stack(spark, d):
    return stack.build_stack(candidates(spark, d), list(STEPS), tile=6)


@query("sweep_stack", f"{STACK} SELECT r, c, greener, px0, px1, px2, px3, px4 FROM stack")
def _(spark, d):
    return _stack(spark, d).select("r", "c", "greener", *(c("px")[i].alias(f"px{i}") for i in range(5)))


@query("stack_sweep", f"""{STACK}, grid AS (SELECT gate, t.i, t.t AS threshold, k AS least FROM (VALUES (false), (true)) g(gate), t, (VALUES (2), (4), (8), (16)) l(k)),
fire AS (SELECT grid.*, CASE i {" ".join(f"WHEN {i} THEN px{i}" for i in range(5))} END >= least AND NOT (gate AND greener = 1) AS hit, p % 3 = 0 AS lost FROM stack, grid)
SELECT gate, threshold::DOUBLE AS threshold, "least", count(*) FILTER (WHERE hit AND lost) AS tp, count(*) FILTER (WHERE hit AND NOT lost) AS fp, count(*) FILTER (WHERE lost AND NOT hit) AS fn FROM fire GROUP BY ALL""")
def _(spark, d):
    samples = _stack(spark, d).withColumn("loss", (c("p") % 3 == 0).cast("int")).withColumn("w", F.lit(1.0))
    out = evaluate.sweep(samples, list(STEPS), [2, 4, 8, 16], score="distance")
    return out.select("gate", "threshold", "least", *(c(x).cast("long").alias(x) for x in ("tp", "fp", "fn")))


CUBE = "floor(6371008.8 * cos(radians(lat)) * cos(radians(lon)) / 150.025)::BIGINT AS x, floor(6371008.8 * cos(radians(lat)) * sin(radians(lon)) / 150.025)::BIGINT AS y, floor(6371008.8 * sin(radians(lat)) / 150.025)::BIGINT AS z"


@query("isolated_alerts", f"WITH {PLACES}, p AS (SELECT 'area' || (floor(lat * 10)::BIGINT % 4) AS aoi, lon, lat, {CUBE} FROM s WHERE area > 0), held AS (SELECT aoi, x, y, z, count(*) AS n FROM p GROUP BY ALL), off AS (SELECT unnest([-1, 0, 1]) AS o), around AS (SELECT h.aoi, h.x + a.o AS x, h.y + b.o AS y, h.z + e.o AS z, sum(h.n) AS n FROM held h, off a, off b, off e GROUP BY ALL) SELECT p.aoi, count(*) AS n FROM p JOIN around USING (aoi, x, y, z) WHERE around.n = 1 GROUP BY p.aoi")
def _(spark, d):
    s = sightings(spark, d).where("area_ha > 0").withColumn("aoi", F.concat(F.lit("area"), (F.floor(c("lat") * 10) % 4).cast("string")))
    return alerts.isolated(s).groupBy("aoi").agg(F.count(F.lit(1)).alias("n"))


@query("single_alerts", f"WITH {PLACES}, p AS (SELECT 'area' || (floor(lat * 10)::BIGINT % 4) AS aoi, lon, lat, {CUBE} FROM s WHERE area > 0), held AS (SELECT aoi, x, y, z, count(*) AS n FROM p GROUP BY ALL), off AS (SELECT unnest([-1, 0, 1]) AS o), around AS (SELECT h.aoi, h.x + a.o AS x, h.y + b.o AS y, h.z + e.o AS z, sum(h.n) AS n FROM held h, off a, off b, off e GROUP BY ALL) SELECT p.aoi, round(p.lon, 6) AS lon, round(p.lat, 6) AS lat, 1 AS confirmations FROM p JOIN around USING (aoi, x, y, z) WHERE around.n = 1")
def _(spark, d):
    """Alerts of the folded store that lie where only one sighting was made."""
    s = sightings(spark, d).where("area_ha > 0").withColumn("aoi", F.concat(F.lit("area"), (F.floor(c("lat") * 10) % 4).cast("string"))).withColumn("seq", c("pid"))
    one = alerts.isolated(s).select("aoi", "lon", "lat")
    return alerts.ingest(s, None, "2026-01-01").join(one, ["aoi", "lon", "lat"], "left_semi").select("aoi", _r(c("lon")).alias("lon"), _r(c("lat")).alias("lat"), "confirmations")


# --- radar from scenes, change stacks, overlaid masks, unfit sightings ---------------------------------------------------------------------

#: The stand-in: vectors as pixels of two areas, a component a pass, nations as scenes, heights on pixels twice as wide.
RADAR_SCENES = """e AS (SELECT vec_id // 25 AS r, vec_id % 25 AS c, CASE WHEN vec_id % 25 < 12 THEN 'west' ELSE 'east' END AS aoi, embedding::DOUBLE[] AS x FROM embeddings),
sc AS (SELECT aoi, n_nationkey AS scene, TIMESTAMP '2024-01-01' + n_nationkey * INTERVAL 20 DAY AS ts FROM nation, (VALUES ('west'), ('east')) v(aoi) WHERE n_nationkey % 4 <> 0 AND n_nationkey % 5 <> 0 AND n_nationkey % 7 <> 0),
px AS (SELECT e.aoi, scene, ts, r, c, 40 * x[scene + 1] - 14 AS vh, 35 + 0.05 * c * (1 + r % 3) + 0.02 * r + 0.001 * scene * r AS angle FROM e JOIN sc USING (aoi)),
dem AS (SELECT aoi, r // 2 AS r, c // 2 AS c, avg(x[40]) * 200 AS v FROM e GROUP BY ALL)"""
RADAR_DAY = "TIMESTAMP '2024-10-27'"


def _slopes(table: str, name: str, step: int) -> str:
    beside = " ".join(f"LEFT JOIN {table} {n} ON {n}.aoi = a.aoi AND {n}.r = a.r + {i} AND {n}.c = a.c + {j}" for n, i, j in (("e", 0, 1), ("w", 0, -1), ("s", 1, 0), ("n", -1, 0)))
    return f"{name} AS (SELECT aoi, r, c, atan(sqrt(dx * dx + dy * dy)) AS slope, (degrees(atan2(-dx, dy)) + 360) % 360 AS aspect FROM (SELECT a.aoi, a.r, a.c, (e.v - w.v) / {2 * step} AS dx, (s.v - n.v) / {2 * step} AS dy FROM {table} a {beside}))"


def _prepared_sql(k: str, when: str) -> str:
    """Passes of some days, prepared, as table done{k}."""
    return f"""kept{k} AS (SELECT * FROM px WHERE {when}), one{k} AS (SELECT aoi, min_by(scene, (ts, scene)) AS scene FROM kept{k} GROUP BY aoi),
wide{k} AS (SELECT aoi, r // 4 AS r, c // 4 AS c, avg(angle) AS v FROM kept{k} SEMI JOIN one{k} USING (aoi, scene) GROUP BY ALL), {_slopes(f"wide{k}", f"tilt{k}", 40)}, look{k} AS (SELECT aoi, radians(avg(aspect)) AS look FROM tilt{k} GROUP BY aoi),
{_slopes("dem", f"hill{k}", 20)}, ground{k} AS (SELECT aoi, r, c, atan(tan(slope) * cos(look - radians(aspect))) AS ar FROM hill{k} JOIN look{k} USING (aoi)),
turned{k} AS (SELECT p.*, ar, radians(angle) AS th, radians(90 - angle) AS h FROM kept{k} p LEFT JOIN ground{k} g ON g.aoi = p.aoi AND g.r = p.r // 2 AND g.c = p.c // 2),
flat{k} AS (SELECT aoi, scene, ts, r, c, CASE WHEN ar < th AND ar > -h THEN pow(10, vh / 10) / cos(th) / (tan(h + ar) / tan(h)) END AS power FROM turned{k}),
off{k} AS (SELECT i, j FROM range(-3, 4) a(i), range(-3, 4) b(j) WHERE i * i + j * j <= 9),
done{k} AS (SELECT a.aoi, a.scene, a.ts, a.r, a.c, CASE WHEN avg(b.power) > 0 THEN 10 * log10(avg(b.power)) END AS vh FROM flat{k} a, off{k} o LEFT JOIN flat{k} b ON b.aoi = a.aoi AND b.scene = a.scene AND b.r = a.r + o.i AND b.c = a.c + o.j GROUP BY ALL)"""


RADAR_GRID = {"pixel_m": 10.0, "dem_m": 20.0, "coarse_m": 40.0}
RADAR_CONFIG = detect.Radar(drop_db=1.0)


def _radar(spark, d):
    """(scenes, pixels, dem) of the stand-in."""
    e = _t(spark, d, "embeddings").select(F.floor(c("vec_id") / 25).alias("r"), (c("vec_id") % 25).alias("c"), F.when(c("vec_id") % 25 < 12, "west").otherwise("east").alias("aoi"), c("embedding").cast("array<double>").alias("x"))
    k = c("n_nationkey").cast("int")
    pols = F.when(k % 7 == 0, F.array(F.lit("VV"))).otherwise(F.array(F.lit("VV"), F.lit("VH")))
    passes = _t(spark, d, "nation").select(F.explode(F.array(F.lit("west"), F.lit("east"))).alias("aoi"), k.alias("scene"), F.date_add(F.lit("2024-01-01").cast("date"), k * 20).cast("timestamp_ntz").alias("ts"), F.when(k % 4 == 0, "ASCENDING").otherwise("DESCENDING").alias("orbit_pass"), F.when(k % 5 == 0, "EW").otherwise("IW").alias("mode"), pols.alias("pols"))
    # in thousandths of a degree, as the SQL adds them up as decimals: 90 is 90
    angle = (35000 + 50 * c("c") * (1 + c("r") % 3) + 20 * c("r") + c("scene") * c("r")) / 1000.0
    pixels = e.join(passes.select("aoi", "scene"), "aoi").select("aoi", "scene", "r", "c", (40 * F.get("x", c("scene")) - 14).alias("vh"), angle.alias("angle"))
    dem = raster.overview(e.select("aoi", "r", "c", F.get("x", F.lit(39)).alias("dem")), "dem", 2, ("aoi",)).withColumn("dem", c("dem") * 200)
    return passes, pixels, dem


@query("radar_collection", f"WITH {RADAR_SCENES}, {_prepared_sql('', f'ts < {RADAR_DAY}')} SELECT aoi, scene, r, c, round(vh, 6) AS vh FROM done")
def _(spark, d):
    out = radar.prepared(*_radar(spark, d), date(2023, 10, 28), date(2024, 10, 27), RADAR_CONFIG, bands=("vh",), **RADAR_GRID)
    return out.select("aoi", "scene", "r", "c", _r(c("vh")).alias("vh"))


@query("radar_change", f"""WITH {RADAR_SCENES}, {_prepared_sql('0', f'ts < {RADAR_DAY}')}, {_prepared_sql('1', f'ts >= {RADAR_DAY}')}, base AS (SELECT aoi, r, c, median(vh) AS base FROM done0 GROUP BY ALL),
fell AS (SELECT aoi, r, c, scene, ts, base - vh AS fall, coalesce(base - vh >= 1, false) AS dropped FROM done1 JOIN base USING (aoi, r, c)),
run AS (SELECT *, dropped AND coalesce(lead(dropped) OVER (PARTITION BY aoi, r, c ORDER BY ts, scene), false) AS hit FROM fell)
SELECT aoi, r, c, bool_or(hit) AS run, sum(dropped::INT)::BIGINT AS n_dropped, min(scene) FILTER (WHERE dropped) AS first_scene, round(avg(fall), 6) + 0.0 AS drop_db FROM run GROUP BY ALL""")
def _(spark, d):
    out = radar.drops(*_radar(spark, d), date(2024, 10, 27), date(2026, 1, 1), RADAR_CONFIG, **RADAR_GRID)
    first = (F.datediff("first_drop", F.lit("2024-01-01")) / 20).cast("int")
    return out.select("aoi", "r", "c", "run", "n_dropped", first.alias("first_scene"), _r(c("drop_db")).alias("drop_db"))


@query("change_stack", "WITH n AS (SELECT count(*) // 2 AS h FROM embeddings) SELECT b.vec_id // 25 AS r, b.vec_id % 25 AS c, round(b.embedding[3]::DOUBLE, 6) + 0.0 AS base_2, round(t.embedding[3]::DOUBLE - b.embedding[3]::DOUBLE, 6) + 0.0 AS change_2, round(list_distance(b.embedding::DOUBLE[], t.embedding::DOUBLE[]), 6) AS l2, round(1 - list_inner_product(b.embedding::DOUBLE[], t.embedding::DOUBLE[]), 6) + 0.0 AS cosine FROM embeddings b, n, embeddings t WHERE b.vec_id < n.h AND t.vec_id = b.vec_id + n.h")
def _(spark, d):
    e = _t(spark, d, "embeddings")
    half = e.count() // 2
    at = c("vec_id") % half
    vectors = e.where(c("vec_id") < 2 * half).select(F.when(c("vec_id") < half, 2024).otherwise(2025).alias("year"), F.floor(at / 25).alias("r"), (at % 25).alias("c"), c("embedding").alias("v"))
    out = scenes.change_stack(vectors, (2024, 2025))
    return out.select("r", "c", _r(c("base")[2]).alias("base_2"), _r(c("change")[2]).alias("change_2"), _r(c("l2")).alias("l2"), _r(c("cosine")).alias("cosine"))


@query("mask_overlap", "WITH a AS (SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS m FROM part), b AS (SELECT c_custkey // 50 AS r, c_custkey % 50 AS c, c_nationkey % 2 = 0 AS m FROM customer WHERE c_custkey % 3 <> 0) SELECT r, c, coalesce(a.m, false) AS predicted, coalesce(b.m, false) AS truth FROM a FULL JOIN b USING (r, c)")
def _(spark, d):
    at = lambda k: (F.floor(c(k) / 50).alias("r"), (c(k) % 50).alias("c"))
    a = _t(spark, d, "part").select(*at("p_partkey"), F.when(c("p_size") % 3 == 0, True).when(c("p_size") % 3 == 1, False).alias("set"))
    b = _t(spark, d, "customer").where("c_custkey % 3 <> 0").select(*at("c_custkey"), (c("c_nationkey") % 2 == 0).alias("set"))
    return aligned.mask_overlap(a, b)


@query("unfit_sightings", f"WITH {PLACES}, m AS (SELECT CASE pid % 11 WHEN 1 THEN NULL WHEN 2 THEN lon + 200 ELSE lon END AS lon, CASE pid % 11 WHEN 3 THEN NULL ELSE lat END AS lat, CASE pid % 11 WHEN 4 THEN 0 WHEN 5 THEN NULL ELSE area END AS area, pid % 11 = 6 AS no_day FROM s) SELECT CASE WHEN lon IS NULL OR lat IS NULL THEN 'no place' WHEN lon > 180 THEN 'off the globe' WHEN area IS NULL OR area <= 0 THEN 'no area' WHEN no_day THEN 'no day' ELSE 'fit' END AS reason, count(*) AS n FROM m GROUP BY ALL")
def _(spark, d):
    k = c("pid") % 11
    s = sightings(spark, d).select(F.when(k == 1, None).when(k == 2, c("lon") + 200).otherwise(c("lon")).alias("lon"), F.when(k != 3, c("lat")).alias("lat"), F.when(k == 4, 0.0).when(k != 5, c("area_ha")).alias("area_ha"), F.when(k == 6, "soon").otherwise("2026-01-01").alias("observed_on"))
    fit, unfit = alerts.checked(s)
    return unfit.select("reason").unionByName(fit.select(F.lit("fit").alias("reason"))).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
