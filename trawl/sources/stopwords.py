"""Stopword lists: plain text, words parted by white space or lines."""

from __future__ import annotations

from functools import cache
from importlib.resources import files

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def read_stopwords(spark: SparkSession, path: str) -> frozenset[str]:
    """Distinct words of a list in shared storage; lines opening with # are notes.

    The list is a parameter of the index, a few hundred words, so it is brought
    to the driver and becomes a literal set in the plans that use it.
    """
    words = (
        spark.read.text(path)
        .where(~F.col("value").startswith("#"))
        .select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word"))
        .where(F.col("word") != "")
        .distinct()
    )
    return frozenset(row.word for row in words.collect())


@cache
def default_stopwords() -> frozenset[str]:
    """The list that ships with the package."""
    lines = files("trawl").joinpath("data/stopwords.txt").read_text().splitlines()
    return frozenset(
        word for line in lines if not line.startswith("#") for word in line.split()
    )
