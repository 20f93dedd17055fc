"""Session settings that the operators count on."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass, fields, replace

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "plotweave", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app).config(map={**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}})
    return (b.master(master) if master else b).getOrCreate()


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a session of a single machine gets a default."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints/plotweave"
    return base.rstrip("/")


@dataclass(frozen=True)
class Options:
    """What a run of the survey plans can be told; unknown names and values out of range are errors, never ignored."""

    do_dense: bool = True
    require_depth_bundle: bool = False
    min_dense_points: int = 1000
    min_matches: int = 15
    oblique_pitch: float = -80.0
    iqr_factor: float = 0.3
    ground_margin: float = 0.3
    canopy_cap: float = 0.5

    def __post_init__(self):
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, bool) != isinstance(f.default, bool) or not isinstance(value, (int, float)):
                raise TypeError(f"{f.name}: {type(f.default).__name__} wanted")
        if self.min_dense_points < 0 or self.min_matches < 1 or self.iqr_factor < 0 or self.canopy_cap <= 0:
            raise ValueError("counts and factors are not negative")

    def set(self, **changes) -> tuple[Options, dict[str, tuple]]:
        """New options, and what changed as name: (old, new)."""
        unknown = set(changes) - {f.name for f in fields(self)}
        if unknown:
            raise KeyError(f"unknown options: {', '.join(sorted(unknown))}")
        return replace(self, **changes), {k: (getattr(self, k), v) for k, v in changes.items() if getattr(self, k) != v}
