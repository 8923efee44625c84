"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "millrace", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the session given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> SparkSession:
    """Put this package's parent folder on the search path of Python workers.

    Enough where workers see the folder (one machine, a shared one); elsewhere
    ship the package with ``--py-files`` or install it.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, root])
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its
    own; elsewhere a missing setting is an error, because a machine-local
    folder would be invisible to other executors.
    """
    root = spark.conf.get(_CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_CONF
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_CHECKPOINT_CONF} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a table written in the shared scratch folder.

    Unlike a cached frame it survives losing executors without recomputing,
    and unlike an RDD checkpoint it stays columnar and prunable. The folder
    goes when the application ends.
    """
    return _written(df, scratch_path(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``written`` for the length of a block: its folder goes when the block ends."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        yield _written(df, path)
    finally:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with passing_shuffles(spark):
        df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.parquet(path)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries in the block go as each of them ends.

    Else they stay until the driver happens to collect its garbage, and a run
    of many steps holds the shuffles of all of them on disk.
    """
    before = spark.conf.get(_CLEANUP_CONF, None)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_CONF)
        else:
            spark.conf.set(_CLEANUP_CONF, before)
