"""Keep an index store up to date: page batches, or a stream of page files."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trawl.plans.index import analyse, page_fields
from trawl.sources.pages import html_pages, one_per_url
from trawl.sources.store import IndexStore

PAGES = "url string, html string"


ARRIVAL = ("_arrived", "_file", "_row")


def index_batch(
    store: IndexStore,
    pages: DataFrame,
    epoch: int,
    stopwords: Collection[str] | None = None,
    version: str | None = None,
    source: str = "batch",
    partitions: int | None = None,
) -> None:
    """Add or replace the pages of one batch, an ``epoch`` of a ``source``.

    A url may occur more than once if ``version`` names a column: the row with
    the highest one wins. Without it a repeated url is an error.
    """
    order = [F.desc(version)] if version else []
    _index(store, pages, epoch, stopwords, order, source, partitions)


def _index(store, pages, epoch, stopwords, order, source, partitions=None) -> None:
    fetched = pages.where("url IS NOT NULL AND html IS NOT NULL")
    newest = html_pages(one_per_url(fetched, *order))
    store.append(analyse(page_fields(newest, partitions), stopwords), epoch, source)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of a stream: written into its checkpoint once, then read back."""
    path = f"{checkpoint.rstrip('/')}/stream-id"
    try:
        return spark.read.text(path).first().value
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    name = f"stream-{uuid.uuid4().hex}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(path)
    return name


def index_stream(
    spark: SparkSession,
    source: str,
    store: IndexStore,
    checkpoint: str,
    schema: str = PAGES,
    stopwords: Collection[str] | None = None,
    version: str | None = None,
    files_per_batch: int = 1000,
    path_filter: str = "*.parquet",
    partitions: int | None = None,
) -> StreamingQuery:
    """Index the page files that have arrived under ``source``, in order of arrival.

    Every micro-batch is one batch of the store, known by the stream's own name
    and number, so a restart indexes nothing twice and other writers of the store
    are not mistaken for it. Of a url that comes more than once the later row
    wins: by ``version`` if given, else by the file's time of change, its path
    and the row's place, whatever the number of files in a micro-batch. The
    stream itself keeps no state beyond its checkpoint. ``partitions`` deals a
    micro-batch over more tasks than its files make.
    """
    metadata = [
        F.col(f"_metadata.{name}").alias(alias)
        for name, alias in zip(("file_modification_time", "file_path", "row_index"), ARRIVAL)
    ]
    pages = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", path_filter)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .select("*", *metadata)
    )
    name = _stream_id(spark, checkpoint)
    order = [F.desc(column) for column in ((version,) if version else ()) + ARRIVAL]

    def write(batch_pages: DataFrame, epoch: int) -> None:
        _index(store, batch_pages, epoch, stopwords, order, name, partitions)

    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
