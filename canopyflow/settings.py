"""Settings from the environment or a file, and the session that they ask for."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import SparkSession

PREFIX = "CANOPYFLOW_"


@dataclass(frozen=True)
class Settings:
    """What a run needs to be told; None leaves it to Spark's own configuration."""

    app_name: str = "canopyflow"
    master: str | None = None
    checkpoint_dir: str | None = None
    warehouse_dir: str | None = None
    shuffle_partitions: int | None = None

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None, file: str = ".env") -> Settings:
        """Variables with the prefix, whatever their case; those of the environment win over the file's; others are ignored, and empty ones count as not told."""
        told: dict[str, str] = {}
        for source in (_lines(file), os.environ if env is None else env):
            told |= {k.upper(): v for k, v in source.items()}
        held = {}
        for f in fields(cls):
            value = told.get(PREFIX + f.name.upper(), "")
            if value:
                held[f.name] = _whole(f.name, value) if f.name == "shuffle_partitions" else value
        return cls(**held)


def _whole(name: str, value: str) -> int:
    if not value.isdigit() or int(value) < 1:
        raise ValueError(f"{PREFIX}{name.upper()} has to be a whole number above 0, not {value}")
    return int(value)


def _lines(file: str) -> dict[str, str]:
    """NAME=value lines; blank ones, remarks and quotes around values don't count."""
    if not Path(file).is_file():
        return {}
    pairs = (x.split("=", 1) for x in Path(file).read_text(encoding="utf-8").splitlines() if "=" in x and not x.lstrip().startswith("#"))
    return {k.removeprefix("export ").strip(): v.strip().strip("'\"") for k, v in pairs}


def session(settings: Settings | None = None) -> SparkSession:
    """The running session, or a new one as the settings ask; time is UTC and plans adapt as they run."""
    s = settings or Settings.load()
    told = {
        "spark.master": s.master, "spark.checkpoint.dir": s.checkpoint_dir, "spark.sql.warehouse.dir": s.warehouse_dir, "spark.sql.shuffle.partitions": s.shuffle_partitions,
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    builder = SparkSession.builder.appName(s.app_name)
    for key, value in told.items():
        builder = builder if value is None else builder.config(key, str(value))
    return builder.getOrCreate()
