"""Functions, operators and folds against known values."""

import json
import math

import pytest
from pyspark.sql import functions as F

from canopyflow.functions import geo, masks, stats, text
from canopyflow.operators import alerts, components, detect, evaluate, raster, report
from canopyflow.sources import stores

REGION_ROWS = 5


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_mask_truth_table(spark):
    t, n = F.lit(True), F.lit(None).cast("boolean")
    assert tuple(one(spark, masks.mask_or(t, n), masks.mask_and(F.lit(False), n), masks.mask_and(t, t), masks.unmask(n))) == (None, None, True, False)


@pytest.mark.parametrize(("lon", "lat", "epsg"), [(74.725, 14.975, 32643), (-177, 10, 32601), (177, 10, 32660), (0, 0, 32631), (74.725, -14.975, 32743), (-74, -10, 32718), (180, 0, 32660)])
def test_utm(spark, lon, lat, epsg):
    assert one(spark, geo.utm_epsg(F.lit(float(lon)), F.lit(float(lat))))[0] == epsg


def test_distances_and_areas(spark):
    z = F.lit(0.0)
    d, a = one(spark, geo.haversine_m(z, z, z, F.lit(1.0)), geo.bbox_area_km2(z, z, F.lit(1.0), F.lit(1.0)))
    assert abs(d - 111195) < 1112 and abs(a - 12363) < 124
    assert geo.min_clearing_pixels(0.2, 10) == 20 and geo.min_clearing_pixels(0.001, 10) == 1


def test_intervals(spark):
    lo, hi = one(spark, *stats.wilson(F.lit(5), F.lit(13)))
    assert abs(lo - 0.17709) < 1e-5 and abs(hi - 0.64478) < 1e-5
    assert tuple(one(spark, *stats.wilson(F.lit(0), F.lit(0)))) == (0.0, 1.0)
    for k, want in ((0, (0, 3.66801)), (1, (0.013072, 5.563756)), (5, (1.611348, 11.668164))):
        assert one(spark, *stats.poisson(F.lit(k))) == pytest.approx(want, abs=1e-5)


def test_strata_and_texts(spark):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (0.2, 0.5, 1.0, 5.0)], "x double").select(stats.size_stratum(F.col("x"))).collect()]
    assert got == ["under_0.5ha", "0.5_to_1ha", "1_to_5ha", "over_5ha"]
    kinds = [r[0] for r in spark.createDataFrame([("429 permission",), ("SSL: bad at /token",), ("hm",)], "m string").select(text.error_kind(F.col("m"))).collect()]
    assert kinds == ["quota_exhausted", "network", "unknown"]
    assert set(k for k, _ in text.PROBES) < set(text.REMEDIES)


def test_components_across_tiles(spark):
    cells = [(i, i) for i in range(40)] + [(0, 30), (1, 30), (20, 0), (39, 0)]
    got = components.component_sizes(spark.createDataFrame(cells, "r int, c int"), tile=8).collect()
    assert sorted({(r.component, r["size"]) for r in got}, key=lambda x: x[1]) == sorted({(0, 40), (30, 2), (20 << 31, 1), (39 << 31, 1)}, key=lambda x: x[1])
    assert components.label_components(components.empty(spark).drop("component")).count() == 0


def test_consecutive_runs(spark):
    rows = [(1, t, f) for t, f in enumerate((True, False, True, True))] + [(2, t, f) for t, f in enumerate((True, None, True))] + [(3, 0, True)]
    got = raster.consecutive_run(spark.createDataFrame(rows, "p int, t int, f boolean"), ["p"], "f", ["t"], 2).collect()
    assert {r.p: r.run for r in got} == {1: True, 2: False, 3: False}


def test_focal_disc():
    assert len(raster.disc(30, 10)) == 29


def test_configs_refuse_nonsense():
    for bad in (lambda: detect.Radar(baseline_days=30), lambda: detect.Optical(ndvi_drop=3), lambda: detect.Embedding(distance=0)):
        with pytest.raises(ValueError, match="out of range"):
            bad()
    with pytest.raises(ValueError, match="before"):
        detect.loss(F.lit(1), 2020, 2020)


def test_confusion(spark):
    rows = spark.createDataFrame([(True, True, 75.0), (True, False, 25.0), (None, True, 25.0)], "p boolean, t boolean, a double")
    m = evaluate.metrics(evaluate.confusion_ha(rows, F.col("p"), F.col("t"), F.col("a"))).first()
    assert (m.precision, m.recall, m.f1, m.iou) == pytest.approx((0.75, 0.75, 0.75, 0.6))
    assert tuple(evaluate.metrics(evaluate.confusion_ha(rows.limit(0), F.col("p"), F.col("t"), F.col("a"))).first()) == (0.0,) * 7


def test_precision_report_has_all_strata(spark):
    v = spark.createDataFrame([("under_0.5ha", "true_positive"), ("under_0.5ha", "unclear")], "stratum string, verdict string")
    got = evaluate.precision_report(v).orderBy("ord").collect()
    assert [(r.stratum, r.tp, r.judged, r.precision) for r in got][:2] == [("under_0.5ha", 1, 1, 1.0), ("0.5_to_1ha", 0, 0, 0.0)] and len(got) == 4


def test_sample_takes_all_of_small_strata():
    some = [{"alert_id": f"{k}{i:03}", "area_ha": a} for k, n, a in (("s", 200, 0.3), ("m", 20, 2.0), ("l", 3, 9.0)) for i in range(n)]
    got = evaluate.stratified_sample(some, 5)
    assert len(got) == 13 and sum(a["area_ha"] == 9.0 for a in got) == 3 and got == evaluate.stratified_sample(some[::-1], 5)


def fold(days, store=None, **how):
    store = {} if store is None else store
    return store, [alerts.fold(store, d, t, **how) for t, d in days]


def test_fold_confirms_and_notifies_once():
    at = lambda day, lat=14.95, area=1.2: (74.70, lat, area, day)
    store, due = fold([("d1", [at("d1")]), ("d1", [at("d1", area=2.0)]), ("d2", [at("d2", 14.95018)]), ("d3", [at("d3", area=0.5)])])
    (a,) = store.values()
    assert [len(x) for x in due] == [0, 0, 1, 0] and a["confirmations"] == 3 and a["area_ha"] == 2.0 and a["lat"] == 14.95 and a["notified_on"] == "d2"
    assert len(fold([("d", [at("d"), at("d", 14.96)])])[0]) == 2
    with pytest.raises(ValueError, match="area"):
        fold([("d", [at("d", area=0)])])


def test_ingest_restart_and_isolation(spark):
    d = lambda day: spark.createDataFrame([("x", 0, 74.7, 14.95, 1.0, day), ("y", 0, 74.7, 14.95, 1.0, day)], "aoi string, seq long, lon double, lat double, area_ha double, observed_on string")
    first = alerts.ingest(d("2026-01-01"), None, "2026-01-01")
    second = alerts.ingest(d("2026-01-13"), spark.createDataFrame(first.collect(), alerts.STORE), "2026-01-13")
    assert [(r.aoi, r.confirmations, r.notified_on) for r in second.orderBy("aoi").collect()] == [("x", 2, "2026-01-13"), ("y", 2, "2026-01-13")]


def test_nearest_at_every_latitude(spark):
    import random

    rng = random.Random(1)
    known = [(i, rng.uniform(-180, 180), rng.uniform(-80, 80)) for i in range(200)]
    near = [(i, lon + rng.uniform(-1, 1) * 0.0008 / math.cos(math.radians(lat)), lat + rng.uniform(-1, 1) * 0.0008) for i, lon, lat in known]
    got = alerts.nearest_within(spark.createDataFrame(near, "pid long, lon double, lat double"), spark.createDataFrame(known, "kid long, lon double, lat double"))
    assert sum(r.match_id == r.pid for r in got.collect()) == 200


def test_store_round_trip(spark, tmp_path):
    path = str(tmp_path / "a.json")
    assert stores.load_store(spark, path, "a").count() == 0
    rows = spark.createDataFrame([("a", "id1", 74.7, 14.95, 1.0, "2026-01-01", "2026-01-01", 1, None)], alerts.STORE)
    (tmp_path / "a.json").write_text(stores.dump_store(rows, "2026-01-01"))
    assert stores.load_store(spark, path, "a").collect() == rows.collect()
    (tmp_path / "a.json").write_text(json.dumps({"version": 2, "alerts": []}))
    with pytest.raises(ValueError, match="migrate"):
        stores.load_store(spark, path, "a")


def test_patch_records_and_worksheets(spark, tmp_path):
    ring = [[74.70, 14.95], [74.71, 14.95], [74.71, 14.96], [74.70, 14.96]]
    rec = json.dumps({"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"area_ha": 1.4, "label": 1}})
    d = stores.detections(spark.createDataFrame([("a", 0, rec)], "aoi string, seq long, record string"), "2026-01-01").first()
    assert (d.lon, d.lat, d.area_ha) == pytest.approx((74.705, 14.955, 1.4))
    (tmp_path / "v.csv").write_text('alert_id,stratum,area_ha,verdict,note\na,under_0.5ha,0.3, TRUE_positive ,"say ""hm"""\nb,under_0.5ha,0.3,,\n')
    got = stores.read_verdicts(spark, str(tmp_path / "v.csv")).collect()
    assert [(r.alert_id, r.verdict, r.note) for r in got] == [("a", "true_positive", 'say "hm"')]
    (tmp_path / "w.csv").write_text("alert_id,stratum,area_ha,verdict,note\na,x,1,maybe,\n")
    with pytest.raises(Exception, match="unknown verdict"):
        stores.read_verdicts(spark, str(tmp_path / "w.csv")).collect()


def test_report_wording(spark):
    a = spark.createDataFrame([("a", "3aad293b1f7961ed", 74.6358, 15.0265, 2.4, "2026-07-05", "2026-08-04", 2, "2026-08-04")], alerts.STORE)
    body = report.digest(a, "Somewhere", "2026-08-04")
    assert "possible disturbance" in body and "ground" in body and "roughly 2.4 football pitches" in body and "2 separate satellite passes" in body
    assert not any(w in body.lower() for w in ("illegal", "logging", "encroach", "crime", "culprit", "poach"))
    assert json.loads(report.features(a).first().feature)["properties"]["status"].startswith("confirmed")
    assert "No newly confirmed" in report.digest(a.limit(0), "Somewhere", "2026-08-04")


def test_streaming_notifies_once(spark, tmp_path):
    from canopyflow.streaming.alerts import due_alerts

    schema = "aoi string, seq long, lon double, lat double, area_ha double, observed_on string"
    for i, day in enumerate(("2026-01-01", "2026-01-13", "2026-01-25")):
        spark.createDataFrame([("a", i, 74.7, 14.95, 1.0, day)], schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = due_alerts(src).writeStream.format("memory").queryName("due").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select count(*) from due").first()[0] == 1


def _stream(spark, root, name, **how):
    from canopyflow.streaming.alerts import due_alerts

    schema = "aoi string, seq long, lon double, lat double, area_ha double, observed_on string"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{root}/in")
    q = due_alerts(src, **how).writeStream.format("parquet").option("path", f"{root}/{name}").option("checkpointLocation", f"{root}/cp-{name}").trigger(availableNow=True).start()
    q.awaitTermination(180)
    return sorted((r.aoi, round(r.lon, 4), r.confirmations, r.last_seen, r.notified_on) for r in spark.read.parquet(f"{root}/{name}").collect())


def _arrive(spark, root, *rows):
    spark.createDataFrame(rows, "aoi string, seq long, lon double, lat double, area_ha double, observed_on string").coalesce(1).write.mode("append").json(f"{root}/in")


def test_stream_keeps_its_state_over_a_restart_and_takes_late_sightings(spark, tmp_path):
    _arrive(spark, tmp_path, ("a", 0, 179.99999, 10.0, 1.0, "2026-01-13"), ("b", 0, 179.99999, 10.0, 1.0, "2026-01-13"), ("a", 1, 50.0, 10.0, 1.0, "2026-01-13"))
    assert _stream(spark, tmp_path, "due", confirmations=3) == []
    # the other side of 180 degrees, an older day, then the first day again: three in all, and the last day moves back
    _arrive(spark, tmp_path, ("a", 2, -179.99999, 10.0, 2.0, "2026-01-01"))
    assert _stream(spark, tmp_path, "due", confirmations=3) == []
    _arrive(spark, tmp_path, ("a", 3, 179.99999, 10.0, 1.0, "2026-01-13"), ("b", 1, 179.99999, 10.0, 1.0, "2026-01-13"))
    assert _stream(spark, tmp_path, "due", confirmations=3) == [("a", 180.0, 3, "2026-01-13", "2026-01-13")]
    _arrive(spark, tmp_path, ("a", 4, 179.99999, 10.0, 1.0, "2026-01-25"))
    assert len(_stream(spark, tmp_path, "due", confirmations=3)) == 1


def test_settled_cells_are_cleared_by_a_timer():
    import pandas as pd

    from canopyflow.streaming.alerts import AlertFold

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v

        def clear(self):
            self.held = None

    class Cells(dict):
        containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.pop

        def iterator(self):
            return list(self.items())

    class Handle:
        timers: list[int] = []

        def getMapState(self, *_):
            return Cells()

        def getValueState(self, *_):
            return Value()

        def registerTimer(self, at):
            self.timers.append(at)

    class Now:
        def getCurrentProcessingTimeInMs(self):
            return 1000

    one, handle = AlertFold(150.0, 2, 90, 50), Handle()
    one.init(handle)
    names = ["aoi", "seq", "lon", "lat", "area_ha", "observed_on"]
    send = lambda *rows: [r for out in one.handleInputRows(("a",), iter([pd.DataFrame(rows, columns=names)]), Now()) for r in out.lon.tolist()]
    assert send(("a", 0, 50.0, 10.0, 1.0, "2024-01-01"), ("a", 1, 60.0, 10.0, 1.0, "2026-01-01")) == [] and handle.timers == [1050]
    assert send(("a", 2, 70.0, 10.0, 1.0, "2026-01-01")) == [] and handle.timers == [1050] and len(one.cells) == 3
    assert [len(x) for x in one.handleExpiredTimer(("a",), Now(), None)] == [0] and len(one.cells) == 2
    # the first place begins anew, the second is confirmed; what arrives sets the next timer
    assert send(("a", 3, 50.0, 10.0, 1.0, "2026-01-13"), ("a", 4, 60.0, 10.0, 1.0, "2026-01-13")) == [60.0] and len(handle.timers) == 2
