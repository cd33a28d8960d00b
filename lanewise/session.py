"""Session helpers: a local session for tests and benches, and the shared folder used to stage tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(app: str = "lanewise", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session. On a cluster, use the session the cluster hands out instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LANEWISE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; a cluster without it is an error,
    because a machine-local folder would be lost with the machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lanewise-"))
    return context.getCheckpointDir()


_SCRATCH = threading.local()


def _scratch_folders() -> list[str]:
    """Folders of the open `scratch` blocks of this thread, the innermost last."""
    if not hasattr(_SCRATCH, "folders"):
        _SCRATCH.folders = []
    return _SCRATCH.folders


def staging_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets; in a `scratch` block, in that block's folder."""
    folders = _scratch_folders()
    folder = folders[-1] if folders else f"{shared_dir(spark).rstrip('/')}/staged"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store holds it; none is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """What is staged in this block goes to a folder of its own, which is removed at the end, also after an error.

    Only what was written for good may be read afterwards. A driver that was killed leaves the folder; a block of the same name
    removes it first, so names must differ between runs that go on at the same time. Blocks of one thread follow each other or
    lie in one another; other threads of the driver stage where their own blocks say.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/staged/{name}"
    remove(spark, folder)
    _scratch_folders().append(folder)
    try:
        yield
    finally:
        _scratch_folders().pop()
        remove(spark, folder)


_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query of this block shuffles is removed when that query ends, not when the driver next collects garbage.

    For chains of staged tables, none of which is computed twice.
    """
    before = spark.conf.get(_REMOVAL, None)
    spark.conf.set(_REMOVAL, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVAL)
        else:
            spark.conf.set(_REMOVAL, before)
