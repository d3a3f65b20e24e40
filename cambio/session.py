"""Session settings and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings the results depend on: zone-less times are UTC, and a bad cast is an error, not a NULL."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def build_session(app: str = "cambio", master: str | None = None, **settings: str) -> SparkSession:
    """A session for the job. Adaptive execution is what resizes, coalesces and splits shuffles at run time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shuffle_settings(shuffle_gb: float) -> dict[str, str]:
    """Settings for shuffles of up to this size: enough initial partitions to hold about 128 MB each.

    Adaptive execution merges what turns out smaller, so an estimate on the high side costs little.
    """
    partitions = max(200, math.ceil(shuffle_gb * 1024 / 128))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.files.maxPartitionBytes": "128MB",
    }


_local_folders: dict[str, str] = {}


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, uniquely named folder on the storage every executor can reach (``spark.checkpoint.dir``).

    Only a local master may fall back to a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        application = spark.sparkContext.applicationId
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="cambio-")
        shared = _local_folders[application]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
