"""Session helpers: shipping this package, tables written to the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_shipped: set[str] = set()

#: Bytes of an Arrow batch for Python workers, where the session names none.  Spark's default of 64 MiB, held in buffers that grow by doubling, is much beside a small executor's heap.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that workers import it wherever they run.

    Also bounds the session's Arrow batches, unless it sets a bound itself.
    """
    if (bound := "spark.sql.execution.arrow.maxBytesPerBatch") not in spark.conf.getAll:
        spark.conf.set(bound, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="jobloom-")
    atexit.register(shutil.rmtree, folder, True)
    target = os.path.join(os.path.realpath(folder), "jobloom_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local one is set only where it is unset (tests)."""
    sc = spark.sparkContext
    set_already = sc._jsc.sc().getCheckpointDir()
    found = spark.conf.get("spark.checkpoint.dir", None) or (set_already.get() if set_already.isDefined() else None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="jobloom-shared-")
        atexit.register(shutil.rmtree, found, True)
        sc.setCheckpointDir(found)
        found = sc._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


_written: set[str] = set()
_scopes = threading.local()


class Stored:
    """A table written to the shared folder: it cuts lineage and survives the loss of executors."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/jobloom-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        _written.add(self.path)
        if scopes := getattr(_scopes, "open", []):
            scopes[-1].add(self.path)

    @property
    def df(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def drop(self) -> None:
        """Removes the files; only for tables that no result still reads."""
        _delete(self.spark, self.path)


def stored(df: DataFrame) -> DataFrame:
    return Stored(df).df


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], Stored]]:
    """Removes at its end what this thread has stored within, but for the tables stored by the function that it gives.

    For steps that end in written tables: lazy results made within may read no other
    table of the step.  Scopes may be nested; what an inner one keeps, the outer one
    holds.
    """
    scopes = _scopes.open = getattr(_scopes, "open", [])
    outer = scopes[-1] if scopes else set()
    scopes.append(set())

    def keep(df: DataFrame) -> Stored:
        result = Stored(df)
        scopes[-1].discard(result.path)
        outer.add(result.path)
        return result

    try:
        yield keep
    finally:
        for name in sorted(scopes.pop()):
            _delete(spark, name)


def _delete(spark: SparkSession, name: str) -> None:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    _written.discard(name)


def release(spark: SparkSession) -> None:
    """Removes all tables that this process has written to the shared folder; for when no lazy result is needed any more."""
    for name in sorted(_written):
        _delete(spark, name)


def numbered(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Rows with their place (from 0) in the order of a column: numbers within the sorted ranges of tasks, and one row for each range to carry them on."""
    each = stored(rows.orderBy(order).withColumn("__m", F.monotonically_increasing_id()))
    part, row = F.shiftright("__m", 33), F.col("__m") % (1 << 33)
    sizes = each.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__b", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return each.join(F.broadcast(before), part == F.col("__p")).select(*rows.columns, (F.col("__b") + row).alias(name))
