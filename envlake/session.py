"""Spark sessions, settings of a deployment and logs."""

from __future__ import annotations

import logging
import os
import sys
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}
#: The categories of logs, and the file of each.
LOGS = {"run": "run.log", "treatment": "treatment.log", "insertion": "insertion.log"}


def session(name: str = "envlake", **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution and dynamic partition overwrite."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class Places:
    """Where a deployment keeps its data, and how it calls endpoints."""

    raw: str = "data/raw"
    tables: str = "data/tables"
    reports: str = "data/reports"
    relational: str = "data/relational"
    logs: str = "logs"
    per_minute: int = 30
    timeout: float = 15.0

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, root: str = "") -> Places:
        """Settings from ENVLAKE_RAW, ENVLAKE_TABLES and so on; blank ones keep the defaults; relative folders lie below root; a wrong number is an error."""
        env = os.environ if env is None else env
        found = {}
        for name, default in vars(cls()).items():
            text = env.get(f"ENVLAKE_{name.upper()}", "").strip()
            value = type(default)(text) if text else default
            if isinstance(value, str):
                value = value if "://" in value or os.path.isabs(value) or not root else f"{root.rstrip('/')}/{value}"
            elif value <= 0:
                raise ValueError(f"ENVLAKE_{name.upper()} must be above 0")
            found[name] = value
        return cls(**found)


def configure_logging(folder: str, category: str = "run") -> logging.Logger:
    """Logs of a category on the console and in its file; returns the logger envlake.<category>."""
    if category not in LOGS:
        raise ValueError(f"no such category of logs: {category}")
    Path(folder).mkdir(parents=True, exist_ok=True)
    log = logging.getLogger(f"envlake.{category}")
    for old in list(log.handlers):
        log.removeHandler(old)
        old.close()
    log.setLevel(logging.INFO)
    for handler in (logging.FileHandler(Path(folder) / LOGS[category], encoding="utf-8"), logging.StreamHandler(sys.stdout)):
        handler.setFormatter(logging.Formatter("%(asctime)s - %(levelname)s - %(message)s", "%d-%m-%Y %H:%M"))
        log.addHandler(handler)
    return log
