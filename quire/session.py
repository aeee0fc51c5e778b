"""Session helpers: a local session for tests/bench and a shared scratch root.

Scratch data (stream checkpoints, materialised tables) always lives under the
folder named by ``spark.checkpoint.dir``; on a cluster that is a shared file
system. Only when it is unset (tests, local runs) do we set one ourselves.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str | None = None, shuffle_partitions: int = 8,
                  app: str = "quire") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. Where none is set, a local
    master gets a temporary one; on a cluster, whose executors do not share
    local folders, that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


#: Tasks for each core that list, or scan, many small files.
FILE_TASKS_PER_CORE = 4


def many_files(spark: SparkSession) -> SparkSession:
    """A session of its own, with all settings of ``spark``, for sources of many
    small files: they are listed, and scanned, by a few tasks for each core.
    By default a listing takes a task for each path (up to 10,000), and a scan
    one for each 30 files or so, which costs more than the files."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    tasks = str(FILE_TASKS_PER_CORE * max(2, spark.sparkContext.defaultParallelism))
    other.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)
    other.conf.set("spark.sql.files.maxPartitionNum", tasks)
    return other


#: Spark then removes the shuffle files of an action at its end; it goes by the value that held when the frame was made.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def frees_shuffles(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator (spark, ...) of several jobs, with the shuffle files of each
    removed as it ends. Otherwise they stay until the driver's garbage collector
    finds them, and the disk holds those of all jobs before. Frames made inside
    are meant for one action; the result is a frame under the caller's settings,
    which may be used again."""

    @functools.wraps(operator)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        before = spark.conf.get(FREE_SHUFFLES, None)
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            made = operator(spark, *args, **kwargs)
        finally:
            if before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)
        return made.select("*")

    return run


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root (never reused)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quire-{name}-{uuid.uuid4().hex[:12]}"


@frees_shuffles
def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read again, for a frame that is
    used several times; what it was shuffled with is freed."""
    path = scratch_path(spark, name)
    df.select("*").write.parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in Python workers (what ``--py-files`` does):
    zip the package once per driver and add it to the SparkContext."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="quire-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "quire"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="quire")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
