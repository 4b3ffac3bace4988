"""Spark session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Temporary work folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates and hours in every job are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Shuffle files go with the statement that wrote them, and a scan's task takes that much of a table.
_LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.files.maxPartitionBytes": "32m"}


@contextmanager
def lean_steps(spark: SparkSession) -> Iterator[None]:
    """Settings for a run of many steps; the session's own come back at its end.

    Left alone, shuffle files stay until the driver happens to collect garbage, so a run holds those of most of its
    steps at once. Small scan tasks let rows that are sorted straight from a table stay in memory.
    """
    before = {name: spark.conf.get(name) for name in _LEAN}
    try:
        for name, value in _LEAN.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def local_session(app: str, cores: str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shoptrail-"))
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; on a cluster the
    setting is required, since a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _LOCAL_ROOTS.get(context.applicationId)
        if root is None:
            root = _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="shoptrail-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{work_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
