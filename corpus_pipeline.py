"""From raw documents to a training mix, in five stages.

Each stage works on all that its predecessor kept. A stage takes the session,
the documents and the table folder and returns documents; all but the last have
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.decontaminate import decontaminated
from trawl.llm.language import accepted
from trawl.llm.lines import without_spread_lines
from trawl.llm.mixing import mixed_documents
from trawl.llm.near_dup import first_of_each_group
from trawl.session import new_folder, remove_folder, scratch

NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that have no letter or no language the network is sure of."""
    return accepted(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines found on many sites; ``n_chars`` follows the new text."""
    found, *_ = without_spread_lines(docs)
    return found.select(*[
        F.char_length("text").cast("bigint").alias("n_chars")
        if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns
    ])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return first_of_each_group(docs, NEAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item, unchanged or slightly edited."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def training_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes something of: how often whole, and which words once more."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("lines", without_boilerplate),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("mix", training_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    A stage's own tables, and what its predecessor wrote, are deleted when it is done.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        with scratch(spark):
            after = stage(spark, docs, sf_dir)
            after.write.parquet(path)
        if before is not None:
            remove_folder(spark, before)
        docs, before = spark.read.schema(after.schema).parquet(path), path
    return docs


#: Language ID and the MinHash tables have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None
