"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CONF = "spark.sql.shuffle.partitions"
SHUFFLE_BYTES = 128 << 20


def build_session(app: str, master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        # RocksDB keeps streaming state off the heap, so it may outgrow executor memory.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where none is named and all runs in one process (a test) is a folder made here; a cluster
    has to name one, as its machines don't see each other's folders.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="skygauge-"))
    return (folder or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/skygauge/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def adaptive(spark: SparkSession):
    """Adaptive execution for the queries of a micro-batch, where a stream's session has it off.

    The stream's own plan, with its state, is made before and isn't touched.
    """
    return setting(spark, "spark.sql.adaptive.enabled", "true")


@contextmanager
def shuffles_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions for the input, so that one fits into the memory of a task.

    The session's number is raised only; adaptive execution merges partitions that turn out small.
    """
    needed = max(math.ceil(input_bytes / SHUFFLE_BYTES), int(spark.conf.get(SHUFFLE_CONF)))
    with setting(spark, SHUFFLE_CONF, needed):
        yield
