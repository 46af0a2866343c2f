"""Query strings: search terms and quoted phrases as Spark columns."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.words import NOT_WORD, drop_stopwords, stems

# Fixed value: what a phrase is.
PHRASE = r'"([^"]+)"'


def _stems_of(text: Column, stopwords: Collection[str]) -> Column:
    lower = F.filter(
        F.transform(F.split(text, NOT_WORD), F.lower), lambda word: F.length(word) > 0
    )
    return stems(drop_stopwords(lower, stopwords))


def parse(queries: DataFrame, stopwords: Collection[str]) -> DataFrame:
    """Add ``terms`` (distinct stems) and ``phrases`` (stem lists, none empty).

    The words of a phrase are terms as well. A phrase of stopwords only is no
    phrase.
    """
    phrases = F.transform(
        F.regexp_extract_all("query", F.lit(PHRASE), 1), lambda p: _stems_of(p, stopwords)
    )
    return queries.select(
        "query_id",
        "query",
        F.array_distinct(_stems_of(F.col("query"), stopwords)).alias("terms"),
        F.filter(phrases, lambda p: F.size(p) > 0).alias("phrases"),
    )
