"""Answer a table of queries: ranked results with details, or as JSON lines."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.queries import parse
from trawl.operators.linkgraph import PARENTS_PER_PART, parent_lists
from trawl.operators.scoring import Matches, hit_counts, matched_keywords, matches, top_results
from trawl.plans.index import Index
from trawl.session import unsent, written
from trawl.sources.stopwords import default_stopwords

SHOWN = 50


def parse_queries(queries: DataFrame, stopwords: Collection[str] | None = None) -> DataFrame:
    """Parse a table ``query_id, query``; a single search is a table of one row."""
    return parse(queries, default_stopwords() if stopwords is None else stopwords)


def search(
    index: Index,
    parsed: DataFrame,
    k: int = SHOWN,
    per_part: int = PARENTS_PER_PART,
    found: Matches | None = None,
) -> DataFrame:
    """The first ``k`` results per query with keywords, parents and children.

    The ranking is written to the shared folder first, since three joins start
    from it. Link and keyword details are fetched for shown results only. A result whose
    page has more than about ``per_part`` parents continues in further rows:
    ``part`` numbers them from 0 and ``parts`` is their count.
    """
    top = written(top_results(index, parsed, k, found), "top")
    keywords = matched_keywords(index, parsed, top)
    parents = parent_lists(index, top.select("url").distinct(), per_part)
    children = index.documents.select(
        "url", F.filter("children", lambda child: child != F.col("url")).alias("children")
    )
    no_urls = F.array().cast("array<string>")
    return (
        unsent(top).join(keywords, ["query_id", "url"])
        .join(children, "url")
        .join(parents, "url", "left")
        .select(
            "query_id",
            "position",
            F.coalesce("part", F.lit(0)).alias("part"),
            F.coalesce("parts", F.lit(1)).alias("parts"),
            "url",
            F.col("score").alias("rank"),
            "title",
            F.col("modified_text").alias("modified"),
            F.col("document_size").alias("size"),
            "keywords",
            F.coalesce("parents", no_urls).alias("parents"),
            F.when(F.coalesce("part", F.lit(0)) == 0, F.col("children"))
            .otherwise(no_urls)
            .alias("children"),
        )
    )


def _wrapped(*fields) -> Column:
    """A JSON object as a string inside ``{"result": ...}``."""
    inner = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return F.to_json(F.struct(inner.alias("result"))).alias("json")


def search_json(index: Index, parsed: DataFrame, k: int = SHOWN) -> DataFrame:
    """JSON lines per query: ``query_id, position, part, json``.

    Position 0 holds the number of results, or the error of a query without
    any; the shown results follow. What the queries match feeds both the counts and
    the ranking, so it is written to the shared folder once.
    """
    found = matches(index, parsed)
    counts = hit_counts(index, parsed, k, found)
    none_found = F.concat(F.lit("No results found for: "), F.coalesce("query", F.lit("")))
    heads = counts.select(
        "query_id",
        F.lit(0).alias("position"),
        F.lit(0).alias("part"),
        F.when(F.col("total") == 0, _wrapped(none_found.alias("error")))
        .otherwise(_wrapped("total_results"))
        .alias("json"),
    )
    results = search(index, parsed, k, found=found).join(counts.select("query_id", "total_results"), "query_id")
    lines = results.select(
        "query_id",
        "position",
        "part",
        _wrapped(
            "total_results", "url", "rank", "title", "modified", "size",
            "keywords", "parents", "children",
        ),
    )
    return heads.unionByName(lines)


def write_search_json(lines: DataFrame, path: str) -> None:
    """One folder per query; files and lines in result order within it."""
    (
        lines.repartitionByRange("query_id", "position", "part")
        .sortWithinPartitions("query_id", "position", "part")
        .select("query_id", F.col("json").alias("value"))
        .write.mode("overwrite")
        .partitionBy("query_id")
        .text(path)
    )
