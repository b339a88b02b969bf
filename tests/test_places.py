"""Queries on known places take every customer and every order."""

import math

import pandas as pd

from canopyflow.operators import alerts
from canopyflow.plans import catalog

KNOWN = ["alert_id", "map_urls", "utm_zone", "bbox_area", "web_mercator_tile"]


def place(key):
    return 74.55 + (key * 7919 % 3500) / 10000.0, 14.80 + (key * 104729 % 3500) / 10000.0


def spot(order, key):
    lon, lat = place(key)
    return lon + ((order * 7919) % 401 - 200) / 100000.0, lat + ((order * 104729) % 401 - 200) / 100000.0


def test_all_customers_and_orders_take_part(spark, tmp_path):
    # keys on both sides of 1,500, and keys 3,500 apart, which share a place
    keys = [*range(1, 40), *range(1490, 1560), *range(3501, 3520), *range(8501, 8530)]
    orders = [(o, keys[o % len(keys)]) for o in range(1, 1200)]
    pd.DataFrame({"c_custkey": keys}).to_parquet(tmp_path / "customer.parquet")
    day = pd.Timestamp("1996-01-01")
    pd.DataFrame({"o_orderkey": [o for o, _ in orders], "o_custkey": [k for _, k in orders], "o_totalprice": [1000.0 + o for o, _ in orders], "o_orderdate": [day + pd.Timedelta(days=o % 9) for o, _ in orders]}).astype({"o_orderdate": "datetime64[us]"}).to_parquet(tmp_path / "orders.parquet")
    run = lambda name: catalog.QUERIES[name](spark, str(tmp_path)).collect()

    for name in KNOWN:
        assert sorted(r.kid for r in run(name)) == sorted(keys)
    assert sum(r.n for r in run("grid_tiles")) == len(keys)
    assert sorted(r.pid for r in run("alert_status")) == [o for o, _ in orders]

    best = {}
    for o, k in orders:
        near = [(alerts._metres(*spot(o, k), *place(j)), j) for j in keys]
        d = min(x for x, _ in near)
        if d <= 150:
            best[o] = (d, min(j for x, j in near if x - d < 1e-6))
    got = {r.pid: r for r in run("haversine_nearest")}
    assert got.keys() == best.keys() and any(j >= 1500 for _, j in best.values())
    assert all(got[o].match_id == j and math.isclose(got[o].distance_m, d, abs_tol=1e-3) for o, (d, j) in best.items())
    assert {r.pid: r.is_new for r in run("radius_dedup")} == {o: o not in best for o, _ in orders}

    stores = {}
    for o, k in orders:
        lon, lat = spot(o, k)
        stores.setdefault(f"area{math.floor(lat * 10) % 4}", []).append((lon, lat, (1000.0 + o) / 100000, str((day + pd.Timedelta(days=o % 9)).date())))
    expected = {}
    for aoi, rows in stores.items():
        alerts.fold(held := {}, rows, "2026-01-01")
        expected |= {(aoi, a): (x["confirmations"], x["notified_on"]) for a, x in held.items()}
    assert {(r.aoi, r.alert_id): (r.confirmations, r.notified_on) for r in run("alert_ingest")} == expected
