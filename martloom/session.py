"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(app: str = "martloom", **conf: str) -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE, skew-join splitting)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query shuffled leaves the disk when the query ends.

    Otherwise it stays until the driver's memory happens to be collected, for a long refresh mostly until its end.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is only ever used when the session itself is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/martloom/{purpose}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"martloom-{purpose}-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
