"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.session import run_folder

_SHIPPED: set[str] = set()
#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``, removed when
    the driver program ends (results are read lazily, so not earlier)."""
    return f"{run_folder(spark)}/{name}"


def ship(spark: SparkSession) -> None:
    """Make the Python workers ready: this package's code, sent once per
    application (they need not share the driver's folders or its import path),
    and, unless the session sets a size itself, small Arrow batches, since a
    row here is a whole text."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    package = Path(__file__).resolve().parent.parent
    if app in _SHIPPED or not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="argent-code-")) / f"{package.name}-code.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def give_back() -> None:
    """Return to the system what this worker has freed: a worker outlives its
    task, and idle ones count against their executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; what its task held is given back at its end."""

    @wraps(run)
    def and_give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return and_give_back


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back:
    lineage is cut, and a lost executor re-reads files that all can see."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def boxed(df: DataFrame, **columns: Column) -> DataFrame:
    """Every row of ``df`` as one column ``row`` beside ``columns`` of our own:
    whatever names ``df`` has, none clashes. ``select("row.*")`` gives the rows back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(name) for name, c in columns.items()])


def unit_interval(hash64: Column) -> Column:
    """A 64-bit hash as a double strictly between 0 and 1."""
    return (F.shiftrightunsigned(hash64, 11).cast("double") + 0.5) / float(1 << 53)
