"""Session factory and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins, splits skewed join partitions and merges
# small shuffle partitions; Arrow carries pandas batches; UTC keeps dates fixed;
# call sites are not recorded, which takes several calls to the JVM per column expression;
# checkpoints go once nothing refers to them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "loomwell", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; keyword names use ``__`` for dots.

    On a cluster leave ``master`` unset and give shuffle partitions through
    spark-submit: adaptive execution merges what is too small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; a
    cluster job must name one that every executor can reach.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="loomwell-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


HANDED_OUT: list[str] = []
INNER: ContextVar[list[str] | None] = ContextVar("INNER", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    held = INNER.get()
    (HANDED_OUT if held is None else held).append(path)
    return path


def remove_paths(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark._jvm
    removed = len(paths)
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


@contextmanager
def inner_scratch(spark: SparkSession) -> Iterator[None]:
    """What lies at the paths this thread is handed inside goes at the end, where no frame made from it is needed any more."""
    held: list[str] = []
    token = INNER.set(held)
    try:
        yield
    finally:
        INNER.reset(token)
        remove_paths(spark, held)


def release_scratch(spark: SparkSession) -> int:
    """Remove what lies at all paths handed out so far, once no frame made from it is needed; returns their number."""
    return remove_paths(spark, HANDED_OUT)
