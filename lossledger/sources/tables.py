"""Table input and output."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LOCAL_WORK = "/tmp/checkpoints"
#: Folders of the blocks of work tables one is in, the innermost last.
_SCOPE: ContextVar[tuple[str, ...]] = ContextVar("work_tables", default=())
#: Shuffle files go once the command that wrote them has ended, not when the driver happens to collect its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Executors on other machines must see it, so a cluster without that setting is an error. Only a local master,
    where driver and executor are one process, gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return f"{LOCAL_WORK}/{spark.sparkContext.applicationId}"
    raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[str]:
    """Tables that ``materialise`` writes inside the block are dropped at its end: write the result before that. Blocks may
    lie in one another."""
    folder = os.path.join(work_folder(spark), f"work-{uuid.uuid4().hex}")
    token = _SCOPE.set((*_SCOPE.get(), folder))
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        drop_table(spark, folder)


@contextmanager
def outside_block() -> Iterator[None]:
    """What is written inside outlives the innermost block of work tables one is in."""
    token = _SCOPE.set(_SCOPE.get()[:-1])
    try:
        yield
    finally:
        _SCOPE.reset(token)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table, or a folder of them."""
    place, files = _files(spark, path)
    files.delete(place, True)


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, before) if before is not None else spark.conf.unset(_SHUFFLES_GO)


def save_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Create or replace a table and read it back. This also cuts the lineage, on storage that outlives executors, and
    the shuffles behind the table leave the disk."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _shuffles_go(df.sparkSession):
        writer.parquet(path)
    # The schema is known, so no file is opened to infer it (columns named by folders come last in it).
    fields = [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    return df.sparkSession.read.schema(StructType(fields)).parquet(path)


def materialise(df: DataFrame, label: str = "table", outside: bool = False) -> DataFrame:
    """Write a table that several branches read once, in the shared work folder.

    The readers then start from a file scan: the branches do not repeat its joins, the lost-executor cost is a
    re-read, and the optimizer sees the table's real size. ``outside`` writes it where it outlives the block of
    ``work_tables`` one is in, as the result of what the block's tables were for.
    """
    if outside:
        with outside_block():
            return materialise(df, label)
    folder = _SCOPE.get()[-1] if _SCOPE.get() else work_folder(df.sparkSession)
    return save_table(df, os.path.join(folder, f"{label}-{uuid.uuid4().hex}"))


# --- tables and models that are replaced as a whole ---------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions' pointers, in order."""
    place, files = _files(spark, os.path.join(path, "_versions"))
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.getPath().getName().isdigit()) if files.exists(place) else []


def _point(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Publish a version under a number, whole or not at all; False if the number is taken."""
    jvm = spark._jvm
    draft, files = _files(spark, os.path.join(path, "_versions", f"draft-{uuid.uuid4().hex}"))
    out = files.create(draft)
    out.write(bytearray(folder.encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(path, f"_versions/{number:012d}")
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, never)
    except Py4JJavaError as e:
        files.delete(draft, False)
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    return True


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Create or replace what lies at ``path``: ``write`` fills a folder of its own, and only then a pointer to it gets the
    next number. Readers resolve the highest number, so they see the old version or the new one, never a part, and what
    is written may be made from the old version. A writer that fails leaves no pointer. Of several at once each gets a
    number of its own, and the last one holds. Needs a store whose rename fails when the target exists."""
    folder = f"data-{uuid.uuid4().hex}"
    write(os.path.join(path, folder))
    number = int((_versions(spark, path) or ["0"])[-1]) + 1
    while not _point(spark, path, number, folder):
        number += 1
    return os.path.join(path, folder)


def published(spark: SparkSession, path: str) -> str:
    """The folder of the current version."""
    names = _versions(spark, path)
    if not names:
        raise FileNotFoundError(f"nothing is published at {path}")
    return os.path.join(path, spark.read.text(os.path.join(path, "_versions", names[-1])).first()[0])


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """CREATE OR REPLACE TABLE: publish the rows as a new version, and read it."""
    return df.sparkSession.read.schema(df.schema).parquet(publish(df.sparkSession, path, df.write.parquet))


def current_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(published(spark, path))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions, pointers first, and drafts of failed writers that no pointer names and
    that are older than the kept versions. Returns how many folders went. A reader of an old version fails, so keep what may be read."""
    names = _versions(spark, path)
    place, files = _files(spark, path)
    kept = {spark.read.text(os.path.join(path, "_versions", n)).first()[0] for n in names[-keep:]}
    if not kept:
        return 0
    oldest = min(files.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(path, f)).getModificationTime() for f in kept)
    for n in names[:-keep]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, f"_versions/{n}"), False)
    gone = 0
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("data-") and name not in kept and status.getModificationTime() <= oldest:
            files.delete(status.getPath(), True)
            gone += 1
    return gone
