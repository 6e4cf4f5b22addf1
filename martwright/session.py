"""Session defaults for local runs, and the shared folder that long jobs write through."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "martwright", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller brings its own session."""
    cores = cores or os.cpu_count() or 1
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.warehouse.dir": os.path.join(tempfile.gettempdir(), "martwright-warehouse"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: the one named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a folder of one machine
    would be lost with that machine, so the setting is required there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="martwright-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def require_ansi(spark: SparkSession) -> None:
    """Sums of cents and casts to money must raise when they do not fit, not wrap or turn NULL."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError("set spark.sql.ansi.enabled to true: amounts must not wrap silently")
