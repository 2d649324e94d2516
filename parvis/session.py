"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_local_scratch: str | None = None


def get_spark(master: str | None = None, app: str = "parvis", **conf: str) -> SparkSession:
    """A session with the settings the library assumes; ``conf`` keys use ``__`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="parvis-")
    return _local_scratch
