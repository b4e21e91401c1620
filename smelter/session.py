"""What a run needs of its session: a folder that every executor can read, and jobs that run side by side."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writes: WeakKeyDictionary[SparkSession, tuple[int, str]] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, and where that is unset a folder in the warehouse.

    Both are places that the driver and all executors share; the rule doesn't ask where the session runs.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Let the session's file system remove a scratch folder when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(place)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go as soon as each job ends: for writes whose shuffles aren't read again.

    Writes may run side by side: the first one changes the session's setting, and the last one puts it back.
    """
    with _lock:
        running, before = _writes.get(spark) or (0, spark.conf.get(SHUFFLES_GO))
        _writes[spark] = running + 1, before
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _lock:
            running, before = _writes.pop(spark)
            if running > 1:
                _writes[spark] = running - 1, before
            else:
                spark.conf.set(SHUFFLES_GO, before)


def written_once(df: DataFrame, label: str, **facts: Column) -> tuple[DataFrame, dict]:
    """The rows, written to the shared folder and read again, and aggregates over them, taken while they are written.

    So the frame is evaluated once, whatever is done with its rows. The folder goes when the application ends.
    """
    path, seen = new_folder(df.sparkSession, label), Observation()
    remove_at_exit(df.sparkSession, path)
    rows = df.observe(seen, *[fact.alias(name) for name, fact in facts.items()]) if facts else df
    with shuffles_go(df.sparkSession):
        rows.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get if facts else {}


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], object]]) -> None:
    """Run independent Spark jobs at the same time, so that small ones fill the executors that large ones leave idle.

    Waits for all of them; then the first error, if any, is raised.
    """
    target = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=8) as pool:
        futures = [pool.submit(target(job)) for job in jobs]
    for future in futures:
        future.result()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, also where it is not installed; Spark hands out the archive itself."""
    context = spark.sparkContext
    if not any(name.endswith("/smelter.zip") for name in context.listFiles):
        root = Path(__file__).resolve().parents[1]
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='run-')}/smelter", "zip", root, "smelter"))
