"""Commands from tables to files."""

import csv
import json
import os
from datetime import date, datetime

import pytest

from canopyflow import cli
from canopyflow.functions.season import Season
from canopyflow.operators import scenes
from canopyflow.sources import stores


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Pixels of 8 x 8, of which 5 x 5 lose their trees between 2024 and 2025, but one pixel that greens."""
    root = str(tmp_path_factory.mktemp("tables"))
    gone = {(r, c) for r in range(1, 6) for c in range(1, 6)}
    spark.createDataFrame([(y, r, c, [1.0, 0.0] if y < 2025 or (r, c) not in gone else [0.0, 1.0]) for y in (2023, 2024, 2025) for r in range(8) for c in range(8)], "year int, r int, c int, v array<double>").write.parquet(f"{root}/vectors")
    spark.createDataFrame([(r, c, 80, None, 1) for r in range(8) for c in range(8)], "r int, c int, treecover int, lossyear int, datamask int").write.parquet(f"{root}/land")
    rows = []
    for y, nir in ((2024, 0.8), (2025, 0.3)):
        for k, (cloud, scl) in enumerate(((10.0, 4), (20.0, 4), (30.0, 9), (99.0, 4))):
            for r in range(8):
                for c in range(8):
                    n = 0.9 if (r, c) == (3, 3) and y == 2025 else nir if (r, c) in gone else 0.8
                    rows.append((datetime(y, 1 + k % 3, 5), cloud, r, c, scl, 0.1, n if cloud < 25 else 0.0))
    rows.append((datetime(2025, 4, 1), 0.0, 2, 2, 4, 0.1, 0.99))
    spark.createDataFrame(rows, "ts timestamp, cloud_pct double, r int, c int, scl int, red double, nir double").write.parquet(f"{root}/scenes")
    return root


def run(tables, out, *more, today="2026-01-05"):
    return cli.main(["run", "--aoi", "North Block", "--vectors", f"{tables}/vectors", "--land", f"{tables}/land", "--store", f"{out}/store", "--reports", f"{out}/reports", "--west", "74.6", "--north", "15.0", "--today", today, *more])


def test_change_pixels(spark, tables):
    t = {n: spark.read.parquet(f"{tables}/{n}") for n in ("vectors", "land", "scenes")}
    px = {(p.r, p.c): p for p in scenes.change_pixels(t["vectors"], t["land"], t["scenes"], Season(1, 3), (2024, 2025)).collect()}
    assert len(px) == 64 and px[2, 2].distance == pytest.approx(2**0.5) and px[0, 0].distance == 0 and all(p.forest for p in px.values())
    # cloudy scenes, clouds and the scene of April are left out
    assert px[2, 2].greenness_loss == pytest.approx(0.7 / 0.9 - 0.2 / 0.4) and px[3, 3].greenness_loss < 0
    assert scenes.years_to_compare(t["vectors"], Season(1, 3), date(2026, 1, 5)) == (2024, 2025)
    assert scenes.years_to_compare(t["vectors"], Season(1, 3), date(2025, 2, 5)) == (2023, 2024)
    with pytest.raises(ValueError, match="2022"):
        scenes.years_to_compare(t["vectors"], Season(1, 3), date(2026, 1, 5), 3)


def test_run_confirms_and_notifies_once(spark, tables, tmp_path, capsys):
    assert run(tables, tmp_path, "--scenes", f"{tables}/scenes", "--dry-run") == 0
    assert "dry run" in capsys.readouterr().out and not os.path.exists(f"{tmp_path}/store")
    for today, new in (("2026-01-05", 0), ("2026-01-17", 1), ("2026-01-29", 0)):
        assert run(tables, tmp_path, "--scenes", f"{tables}/scenes", today=today) == 0
        assert f"{new} newly confirmed" in capsys.readouterr().out
        text = open(f"{tmp_path}/reports/north-block-{today}.txt", encoding="utf-8").read()
        assert ("1 newly confirmed possible disturbance, 0.2" in text) == bool(new)
    held = json.load(open(f"{tmp_path}/store/north-block.json"))
    assert held["version"] == 1 and len(held["alerts"]) == 1 and held["alerts"][0]["confirmations"] == 3 and held["alerts"][0]["notified_on"] == "2026-01-17"
    features = json.load(open(f"{tmp_path}/reports/north-block-alerts.geojson"))["features"]
    assert len(features) == 1 and "ground verification" in features[0]["properties"]["status"]


def test_run_without_a_year_to_compare(tables, tmp_path, capsys):
    assert run(tables, tmp_path, today="2020-01-01") == 1
    assert "no vectors of" in capsys.readouterr().out


def test_sample_chips_and_report(spark, tmp_path, capsys):
    store = f"{tmp_path}/store"
    sample = ["validate-sample", "--aoi", "a", "--store", store, "--out", str(tmp_path)]
    assert cli.main(sample) == 1
    alerts = spark.createDataFrame([(f"id{i:02d}", 74.0 + i, 15.0, 0.3 if i < 8 else 2.0, "2026-01-01", "2026-01-13", 2, None) for i in range(12)], stores.ALERT)
    stores.save_store(spark, alerts, f"{store}/a.json", "2026-01-13")
    assert cli.main([*sample, "--per-stratum", "5", "--seed", "7"]) == 0
    sheet = f"{tmp_path}/a-sample-seed7.csv"
    rows = list(csv.DictReader(open(sheet)))
    assert len(rows) == 9 and list(rows[0]) == stores.WORKSHEET and [float(r["area_ha"]) for r in rows] == [0.3] * 5 + [2.0] * 4 and not any(r["verdict"] for r in rows)
    again = open(sheet).read()
    assert cli.main([*sample, "--per-stratum", "5", "--seed", "7"]) == 0 and open(sheet).read() == again
    # images: one alert has both, one an empty file, the others none
    chips = tmp_path / "chips"
    chips.mkdir()
    one, two = rows[0]["alert_id"], rows[1]["alert_id"]
    for name, content in ((f"{one}-before", b"x"), (f"{one}-after", b"y"), (f"{two}-before", b""), (f"{two}-after", b"z")):
        (chips / f"{name}.png").write_bytes(content)
    capsys.readouterr()
    listing = ["validate-chips", "--aoi", "a", "--store", store, "--chips", str(chips)]
    assert cli.main([*listing, "--worksheet", f"{tmp_path}/none.csv"]) == 1
    assert cli.main([*listing, "--worksheet", sheet]) == 0
    said = capsys.readouterr().out
    assert f"{one}  complete" in said and f"{two}  missing: before\n" in said and "1 of 9 complete" in said and said.count("missing: before, after") == 7
    # verdicts
    report = ["validate-report", "--verdicts", sheet]
    assert cli.main(report) == 1 and cli.main(["validate-report", "--verdicts", f"{tmp_path}/none.csv"]) == 1
    for r, v in zip(rows, ["true_positive", " False_Positive ", "unclear", "true_positive", "", "", "", "", ""], strict=True):
        r["verdict"] = v
    with open(sheet, "w", newline="") as f:
        w = csv.DictWriter(f, stores.WORKSHEET)
        w.writeheader()
        w.writerows(rows)
    capsys.readouterr()
    assert cli.main(report) == 0
    assert "all: 2 of 3 judged, precision 0.67" in capsys.readouterr().out


def test_doctor(spark, capsys):
    assert cli.main(["doctor"]) == 0
    said = capsys.readouterr().out
    assert said.startswith("PASS  round trip\nPASS  functions\n")
    assert cli.diagnosis([("functions", True, ""), ("checkpoints", False, "not set")]) == ["PASS  functions", "FAIL  checkpoints: not set", f"  checkpoints: {cli.REMEDIES['checkpoints']}"]

    class Dead:
        def sql(self, _):
            raise RuntimeError("gone\nmore")

    assert cli.doctor(Dead()) == [("round trip", False, "gone")]
    assert cli.main(["version"]) == 0
