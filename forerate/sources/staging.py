"""Staged tables: intermediate results written once to the cluster's shared folder.

A staged table cuts lineage in a way that survives the loss of executors, is computed once however
often it is read, and has a known size on disk. The size lets the planner broadcast it when it is
small and shuffle it when it is not, so no join in this package needs a broadcast hint.
"""

from __future__ import annotations

import atexit
import contextvars
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")


def side_by_side(spark: SparkSession, jobs: Iterable[Callable[[], R]], at_once: int = 4) -> list[R]:
    """Results of independent Spark jobs that are submitted at the same time, in the given order."""
    jobs = list(jobs)
    contexts = [contextvars.copy_context() for _ in jobs]
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda job, context: context.run(job)), jobs, contexts))


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application.

    What runs in a task can then be imported there, wherever the driver found the package.
    """
    sc = spark.sparkContext
    with _shipping:  # jobs side by side need it at the same time
        if sc.applicationId in _shipped:
            return
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="forerate-code-"), f"{package.name}.zip")
        atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        sc.addPyFile(str(archive))
        _shipped.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="forerate-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def staging_folder(spark: SparkSession) -> str:
    """The folder that holds the staged tables of this application."""
    return f"{checkpoint_root(spark)}/forerate-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged_paths", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables staged inside are deleted at the end, but for those staged by the function it yields.

    These belong to the scope around this one, if there is one. What is built lazily from a deleted
    table can't be read any more, so whatever leaves the scope must be kept that way.
    """
    mine: list[str] = []
    outer = _scope.set(mine)
    around = outer.old_value if outer.old_value is not contextvars.Token.MISSING else None

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = staged(df, name)
        kept = mine.pop()
        if around is not None:
            around.append(kept)
        return out

    try:
        yield keep
    finally:
        _scope.reset(outer)
        for path in mine:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a table of the shared folder."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True))


_caches: list[dict] = []


def forget_with_staging(cache: dict) -> None:
    """Register a cache of staged tables, or of what reads them, to be emptied when they are deleted."""
    _caches.append(cache)


def drop_staged(spark: SparkSession) -> bool:
    """Delete every staged table of this application, and forget what was kept of them."""
    for cache in _caches:
        cache.clear()
    return delete(spark, staging_folder(spark))


def write_tables(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Sink for result tables: one folder per table, as Parquet, CSV (with header) or JSON."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(paths[name])
    return paths
