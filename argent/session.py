"""Spark session settings the library relies on.

Only one setting changes results: the session time zone (timestamp text is
rendered in it); every cast is a ``try_cast``, so the ANSI flag does not matter.
The rest are throughput settings, applied only where the deployment or the
existing session sets nothing of its own.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

#: Time zone used to render timestamps as text (the reference renders in the
#: session zone; we pin it so results repeat across machines).
SESSION_TIME_ZONE = "UTC"


def get_session(master: str | None = None, app_name: str = "argent",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": SESSION_TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Broadcast only behind a measured size: the static planner's choice
        # rests on size *estimates* (compressed file size), so it is off;
        # AQE's runtime choice uses the measured shuffle output of the small
        # side, and explicit broadcasts go through operators.joins.fits_broadcast.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    active = SparkSession.getActiveSession()
    given = _given(active)
    memory = _half_of_memory()
    if active is None and memory and (master or given("spark.master") or "").startswith("local"):
        conf["spark.driver.memory"] = memory  # local mode: the driver is the executor
    # what the deployment or the session already sets wins over our defaults
    conf = {k: v for k, v in conf.items() if given(k) is None}
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def _given(active: SparkSession | None):
    """Lookup of a setting that is set already, in the session or else in the
    launch configuration; None where it is not."""
    if active is not None:
        return lambda key: active.conf.get(key, None)
    launch = SparkConf()
    return lambda key: launch.get(key, None)


def _half_of_memory() -> str | None:
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return None
    return f"{min(16, max(1, total // 2 ** 31))}g"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that results depend on; safe to call on any session."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    On a cluster this setting names the shared (distributed) folder; without
    it nothing is written, for a folder of one machine would be seen by that
    machine alone. Only a ``local[...]`` master, where there is one machine,
    gets a folder of our own under the system temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="argent-ckpt-")
    sc.setCheckpointDir(local)
    # Spark appends a random sub-folder; use what it actually set.
    return (sc.getCheckpointDir() or local).rstrip("/")


_RUN_FOLDERS: dict[str, SparkSession] = {}


def run_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared one for intermediate tables, removed by
    :func:`remove_run_folders` or at the end of the driver program."""
    path = f"{shared_dir(spark)}/argent-run-{uuid.uuid4().hex}"
    _RUN_FOLDERS[path] = spark
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def remove_run_folders() -> None:
    """Delete this program's run folders; frames that read them end with them."""
    for path, spark in list(_RUN_FOLDERS.items()):
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 -- the session may be gone already
            pass
        _RUN_FOLDERS.pop(path, None)


#: Spark's setting to delete what an execution has shuffled at its end.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict[SparkSession, int] = {}
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a write made within shuffles is deleted when that write ends. Else it
    stays on disk until the driver happens to collect its garbage, beside all that
    is written meanwhile. Writes of several threads may overlap; what the deployment
    or the session says about it wins."""
    with _FREEING_LOCK:
        ours = spark in _FREEING or spark.conf.get(_FREE_SHUFFLES, None) is None
        if ours:
            _FREEING[spark] = _FREEING.get(spark, 0) + 1
            spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            if ours:
                _FREEING[spark] -= 1
                if not _FREEING[spark]:
                    del _FREEING[spark]
                    spark.conf.unset(_FREE_SHUFFLES)


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: str | None = None) -> None:
    """Write ``df`` to a folder. Parquet is written as zstd where the session
    names no codec: two thirds of the default's bytes, which stay for good."""
    spark = df.sparkSession
    writer = df.write.mode(mode).format(fmt)
    if fmt == "parquet" and spark.conf.get("spark.sql.parquet.compression.codec", None) is None:
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with shuffles_freed(spark):
        writer.save(path)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to a run folder (``path``, or one of its own) and
    return a frame reading it back: an intermediate consumed by several branches of one plan is
    computed once, its columns are pruned per branch, and its lineage is cut
    (a lost executor re-reads files that all can see)."""
    path = path or run_folder(df.sparkSession)
    write_files(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
