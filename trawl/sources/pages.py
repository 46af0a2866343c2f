"""Page tables: raw HTML rows, or plain texts in the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.session import written

HEADER_COLUMNS = ("last_modified", "date", "size")


def html_pages(table: DataFrame) -> DataFrame:
    """Normalise a table of fetched pages to ``url, html`` and the header columns.

    A missing header column counts as a header no page sent. A row without html
    is a failed fetch and is dropped.
    """
    headers = [
        (F.col(name) if name in table.columns else F.lit(None)).cast("string").alias(name)
        for name in HEADER_COLUMNS
    ]
    return table.select("url", "html", *headers).where(
        F.col("url").isNotNull() & F.col("html").isNotNull()
    )


def one_per_url(table: DataFrame, *newest_first) -> DataFrame:
    """One row per url, the first in the given order; html of unique urls stays put.

    The urls that occur more than once are found on the url column alone. Only
    their rows are compared; as a rule they are few, and Spark sends the list of
    them to the rows. Without an order, a repeated url is an error: no row of a
    table is the later one by itself.
    """
    repeated = written(
        table.groupBy("url").agg(F.count("*").alias("n")).where("n > 1").select("url"), "repeated"
    )
    some = repeated.take(3)
    if not some:
        return table
    if not newest_first:
        raise ValueError(f"urls occur more than once, give their version: {[r.url for r in some]}")
    compared = latest_pages(table.join(repeated, "url", "left_semi"), *newest_first)
    return table.join(repeated, "url", "left_anti").unionByName(compared)


def latest_pages(table: DataFrame, *newest_first) -> DataFrame:
    """One row per url: the first in the given order.

    Spark keeps the best row per url within each input task before it shuffles,
    so a url fetched over and over does not fill one task.
    """
    newest = F.row_number().over(Window.partitionBy("url").orderBy(*newest_first))
    return table.withColumn("_version", newest).where("_version = 1").drop("_version")
