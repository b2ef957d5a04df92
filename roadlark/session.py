"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Spark options this engine expects.  A cluster deployment sizes shuffle partitions itself:
# AQE coalesces from a generous initial number and splits skewed join partitions.
OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM never compiles methods above 8000 bytes; wide projections generated as one such
    # method run four times slower than the same projection split into several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_SPARKS_METHOD_LIMIT = "65535"


def build_session(app: str = "roadlark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**OPTIONS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def speed_up(spark: SparkSession) -> None:
    """Give a session that ``build_session`` did not make the limit that keeps wide rows compiled.

    A limit that the caller has set stays.  It changes how rows are computed, not which."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name, None) in (None, _SPARKS_METHOD_LIMIT):
        spark.conf.set(name, OPTIONS[name])


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Every executor must see it, so a cluster has to name the folder.  Only a local master,
    where driver and executors share one machine, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="roadlark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
