"""The text report: one block per page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the line between two pages.
RULE = "-" * 91


def index_report(forward: DataFrame) -> DataFrame:
    """``url, report`` from forward-index rows, inside the row.

    Title, address, date and size, keywords by falling frequency, child links,
    rule. Words of equal frequency come in alphabetical order.
    """
    by_frequency = F.array_sort(
        F.transform(
            "terms",
            lambda term: F.struct(-term["term_frequency"], term["word"]),
        )
    )
    keywords = F.array_join(
        F.transform(
            by_frequency,
            lambda pair: F.concat_ws(" ", pair["word"], -pair["col1"], F.lit(";")),
        ),
        " ",
    )
    modified = F.coalesce(
        F.date_format("modified", "yyyy-MM-dd HH:mm:ss"), F.lit("None")
    )
    lines = F.concat(
        F.array(
            F.col("title"),
            F.col("url"),
            F.concat_ws(" , ", modified, F.col("document_size").cast("string")),
            keywords,
        ),
        F.transform("children", lambda child: F.concat(F.lit("Child "), child)),
        F.array(F.lit(RULE)),
    )
    return forward.select("url", F.array_join(lines, "\n").alias("report"))


def write_report(report: DataFrame, path: str) -> None:
    report.select(F.col("report").alias("value")).write.mode("overwrite").text(path)
