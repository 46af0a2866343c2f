"""Session settings the library relies on, and its folder in shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="trawl-")
        spark.conf.set("spark.checkpoint.dir", path)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of a written table that Spark may send whole to every task. Its own limit is in bytes of
#: files, which keys that repeat compress to a hundredth of what they take in memory.
SENT_ROWS = 500_000

_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
#: Catalog names of bucketed tables in a scratch folder.
_tables: list[tuple[str, str]] = []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables of :func:`written` when the block ends.

    Results must be stored or collected inside the block, as they read them.
    """
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path, table in [t for t in _tables if t[0] in paths]:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            _tables.remove((path, table))
        for path in paths:
            remove_folder(spark, path)


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the shared folder.

    Used where one result feeds several joins: it is computed once, survives
    the loss of executors, and its size decides whether it is broadcast
    (:func:`unsent` where its files say too little of it).
    """
    path = new_folder(rows.sparkSession, name)
    if (paths := _scratch.get()) is not None:
        paths.append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def few(rows: DataFrame) -> bool:
    """Whether ``rows`` of a written table may be sent whole to every task."""
    return rows.count() <= SENT_ROWS


def unsent(rows: DataFrame) -> DataFrame:
    """``rows`` of a written table to join; more than ``SENT_ROWS`` never go through the driver."""
    return rows if few(rows) else rows.hint("merge")


def slices(rows: DataFrame, key: str) -> list[DataFrame]:
    """``rows`` of a written table by ``key``, in slices that may be sent, unless nothing may be."""
    if not SENT_ROWS or few(rows):
        return [rows]
    # half full on average, as keys have more or fewer rows
    count = -(-2 * rows.count() // SENT_ROWS)
    return [rows.where(F.pmod(F.xxhash64(key), F.lit(count)) == n) for n in range(count)]


#: Rows that a task may hold as the hash table of a join, on average.
HELD_ROWS = 500_000


def held(rows: DataFrame, count: int, tasks: int) -> DataFrame:
    """``rows`` of unique keys to join with many more, which are then not sorted.

    Each of ``tasks`` holds its share as a hash table. Where that would be more than
    ``HELD_ROWS`` rows both sides are sorted, which needs no memory for them.
    """
    return rows.hint("shuffle_hash" if count <= HELD_ROWS * tasks else "merge")


def bucketed(rows: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``rows`` as a table in the shared folder, dealt into buckets by ``keys``.

    Joins and groups by ``keys`` read it where it lies: only their other side is
    moved. Without ``buckets`` there are as many as shuffle partitions. A task
    opens one file per bucket it has rows of, so ``rows`` should come from a
    shuffle by ``keys`` or hold few keys per task.
    """
    return BucketedTable(rows.sparkSession, name, keys, buckets).append(rows)


class BucketedTable:
    """A table of :func:`bucketed` that can grow.

    Rows appended later lie in the same buckets; ``by`` names a column whose
    values get a folder each, so that rows of one value are read alone.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        keys: Sequence[str],
        buckets: int | None = None,
        by: str | None = None,
    ):
        self.spark, self.keys, self.by = spark, list(keys), by
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = new_folder(spark, name)
        self.table = f"trawl_{uuid.uuid4().hex}"
        if (paths := _scratch.get()) is not None:
            paths.append(self.path)
            _tables.append((self.path, self.table))

    def append(self, rows: DataFrame) -> DataFrame:
        """Add ``rows``; all rows so far."""
        writer = rows.write.mode("append").bucketBy(self.buckets, *self.keys)
        if self.by is not None:
            writer = writer.partitionBy(self.by)
        writer.format("parquet").option("path", self.path).saveAsTable(self.table)
        return self.rows()

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)


#: Rows that a task is dealt at most, on average: what it sorts fits its memory at any input size.
DEALT_ROWS = 4_000


def dealt(rows: DataFrame, partitions: int | None) -> DataFrame:
    """``rows`` over so many tasks, or more if they are many; as they lie if ``partitions`` is None."""
    if partitions is None:
        return rows
    return rows.repartition(max(partitions, -(-rows.count() // DEALT_ROWS)))
