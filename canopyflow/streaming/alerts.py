"""The alert fold on a stream: each area's alerts by cell, every alert emitted once.

State is a map from cells a radius wide to the alerts in them, so a batch reads and writes the cells that its sightings touch, not an area's whole store.
Nothing is too late: an older sighting confirms and moves the last day back, as in a batch, for order of arrival decides.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from canopyflow.operators.alerts import CONFIRMATIONS, RADIUS_M, cell_of, cells_around, fold

DUE = "aoi string, alert_id string, lon double, lat double, area_ha double, first_seen string, last_seen string, confirmations int, notified_on string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class AlertFold(StatefulProcessor):
    """One area. keep_days: cells whose alerts no one has seen for so many days before the newest sighting are cleared, when a timer of sweep_ms runs out."""

    def __init__(self, radius_m: float, confirmations: int, keep_days: int | None, sweep_ms: int):
        self.radius_m, self.confirmations, self.keep_days, self.sweep_ms = radius_m, confirmations, keep_days, sweep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("cells", "cell string", "alerts string")
        self.newest = handle.getValueState("newest", "day string")
        self.waiting = handle.getValueState("waiting", "set int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("seq", kind="stable")
        near = {c for lon, lat in zip(new.lon, new.lat, strict=True) for c in cells_around(lon, lat, self.radius_m)}
        held = {}
        for cell in near:
            if self.cells.containsKey((str(cell),)):
                held |= {a["alert_id"]: a for a in json.loads(self.cells.getValue((str(cell),))[0])}
        due = []
        # a run of sightings of one day is notified on that day
        for _, part in new.groupby((new.observed_on != new.observed_on.shift()).cumsum(), sort=False):
            due += [dict(a) for a in fold(held, zip(part.lon, part.lat, part.area_ha, part.observed_on, strict=True), part.observed_on.iat[0], self.radius_m, self.confirmations)]
        by_cell: dict[tuple, list[dict]] = {}
        for a in held.values():
            by_cell.setdefault(cell_of(a["lon"], a["lat"], self.radius_m), []).append(a)
        for cell, some in by_cell.items():
            self.cells.updateValue((str(cell),), (json.dumps(some),))
        if self.keep_days is not None:
            before = self.newest.get()[0] if self.newest.exists() else ""
            self.newest.update((max(before, str(new.observed_on.max())),))
            if not self.waiting.exists():  # one timer at a time, set by what arrives
                self.waiting.update((1,))
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.sweep_ms)
        yield pd.DataFrame([{"aoi": key[0], **a} for a in due], columns=[f.split()[0] for f in DUE.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = (date.fromisoformat(self.newest.get()[0]) - timedelta(days=self.keep_days)).isoformat()
        settled = [cell for cell, (alerts,) in self.cells.iterator() if all(a["last_seen"] < last for a in json.loads(alerts))]
        for cell in settled:
            self.cells.removeKey(cell)
        self.waiting.clear()
        yield pd.DataFrame(columns=[f.split()[0] for f in DUE.split(", ")])

    def close(self) -> None:
        pass


def due_alerts(detections: DataFrame, radius_m: float = RADIUS_M, confirmations: int = CONFIRMATIONS, keep_days: int | None = None, sweep_ms: int = 3_600_000) -> DataFrame:
    """Alerts as they become due, from a stream of (aoi, seq, lon, lat, area_ha, observed_on string), notified on the day of the sighting. Sets the state store to the one that keeps maps."""
    detections.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    mode = "none" if keep_days is None else "processingTime"
    return detections.groupBy("aoi").transformWithStateInPandas(AlertFold(radius_m, confirmations, keep_days, sweep_ms), DUE, "append", mode)
