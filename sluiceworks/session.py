"""Spark session settings and the shared folder intermediate tables go to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

# What the plans in this package profit from. Nothing here is needed for right results.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The split write has two partition values: keep both files open instead of sorting rows.
    OPEN_FILES: "4",
    # Checkpoints of key findings are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Independent tables are submitted from several threads.
    "spark.scheduler.mode": "FAIR",
}


def session(app: str = "sluiceworks", master: str | None = None, **settings: str) -> SparkSession:
    """A session with this package's settings; ``settings`` use ``_`` for ``.`` in the key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_files_open(spark: SparkSession) -> None:
    """A session that does not say how many files a task may have open sorts all rows of a partitioned write first."""
    if int(spark.conf.get(OPEN_FILES)) < int(SETTINGS[OPEN_FILES]):
        spark.conf.set(OPEN_FILES, SETTINGS[OPEN_FILES])


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder: what ``spark.checkpoint.dir`` names.

    Executors must all see it, so a temporary folder, removed at exit, stands in only for a local master
    without one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="sluiceworks-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; all those of one application are in one folder."""
    return f"{checkpoint_folder(spark)}/sluiceworks/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
