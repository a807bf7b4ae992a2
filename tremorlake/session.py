"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings that results depend on. Epoch values become UTC clock times, and a
# JSON object that repeats a key keeps the last value.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "tremorlake", master: str | None = None, **options: str) -> SparkSession:
    """A session with the engine's settings; the cluster's own settings stay."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **RESULT_SETTINGS,
        "spark.sql.adaptive.enabled": "true",
        # Call sites of column expressions in error texts cost more than planning.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        **options,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made elsewhere."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the cluster names.

    Without that setting only a local master may fall back to a temporary
    folder: on a cluster it would be a different folder on every machine.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
        root = _local_root()
    path = f"{root.rstrip('/')}/tremorlake/{label}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete all scratch folders this process has asked for; how many were there.

    Call it when no frame that starts from them is needed any more. Folders of other
    processes stay.
    """
    removed = 0
    while _made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        removed += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return removed


# Scratch folders of this process.
_made: list[str] = []


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tremorlake-")
