"""Removal of lines that spread over many sites, by mergeable distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import fresh, kept

MIN_SITES = 5
#: Log2 of the buckets of a sketch; 12 gives a relative error of 1.6 %.
SKETCH_LOG2 = 12
#: Estimates this near to the threshold, relatively, are counted exactly.
BAND = 0.2
_BLANK = r"^[\x20\x09-\x0D]*\z"
NO_SITE = "\x00"


def _lines(text: Column | str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _codes(text: Column | str) -> Column:
    """Hashes of a text's lines that are not blank, in order."""
    return F.transform(
        F.filter(_lines(text), lambda line: ~F.rlike(line, F.lit(_BLANK))),
        lambda line: F.xxhash64(line),
    )


def _key(side: str = "") -> Column:
    """What a row's lines are looked up by: its id, or a hash of its text if it has none."""
    return F.coalesce(f"{side}doc_id", F.xxhash64(f"{side}text"))


def line_uses(docs: DataFrame) -> DataFrame:
    """One row per document and line in it: line, site, text, a hash of the whole text."""
    return docs.select(
        F.explode(F.array_distinct(_codes("text"))).alias("line"),
        F.coalesce("source", F.lit(NO_SITE)).alias("site"),
        F.xxhash64("text").alias("text"),
    )


def spread_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    band: float = BAND,
) -> DataFrame:
    """Hashes of lines found on at least ``min_sites`` sites: line.

    All occurrences count. Copies of a whole text are one text, and a line must
    stand in ``min_sites`` different texts too, so that a text copied to many
    sites keeps its own lines.

    HyperLogLog sketches of sites and texts per line merge by aggregation. Lines
    with an estimate near the threshold are counted exactly.
    """
    uses = kept(line_uses(docs), "line-uses")
    counted = ("site", "text")
    sketches = uses.groupBy("line").agg(
        *[F.hll_sketch_agg(c, F.lit(SKETCH_LOG2)).alias(c) for c in counted]
    )
    least = F.least(*[F.hll_sketch_estimate(c) for c in counted])
    guessed = sketches.select("line", least.alias("sites")).where(
        F.col("sites") >= min_sites * (1 - band)
    )
    guessed = kept(guessed, "line-sites")
    sure = guessed.where(F.col("sites") > min_sites * (1 + band)).select("line")
    near = guessed.where(F.col("sites") <= min_sites * (1 + band)).select("line")
    exact = uses.join(near, "line", "left_semi").groupBy("line").agg(
        *[F.count_distinct(c).alias(c) for c in counted]
    )
    for c in counted:
        exact = exact.where(F.col(c) >= min_sites)
    return sure.unionByName(exact.select("line"))


def without_spread_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    band: float = BAND,
) -> tuple[DataFrame, str, str]:
    """Documents without their boilerplate lines, and two columns of counts.

    A site is a value of ``source`` (null is one site); a line is what stands
    between line feeds; blank lines are neither counted nor removed. Every
    occurrence of a line on ``min_sites`` sites or more is removed
    (:func:`spread_lines`); the other lines are joined as they were. A text that
    loses nothing stays as it is, null included; one that loses everything
    becomes empty and stays in the table.

    Returns the documents with two columns more, and their names: the number of
    lines that are not blank, and of lines removed. Rows that share a doc_id may
    share lines looked up for them, which changes no result, as a line is
    removed everywhere. A hot line is looked up in pieces, and rows without id by
    their texts. An empty table gives no rows.
    """
    marked = kept(spread_lines(docs, min_sites, band), "spread-lines")
    lines = docs.select(_key().alias("hit_id"), F.explode(F.array_distinct(_codes("text"))).alias("line"))
    found = (
        lines.join(marked, "line", "left_semi")
        .groupBy("hit_id").agg(F.collect_set("line").alias("hit_lines"))
    )
    total, removed, gone = (fresh(docs, n) for n in ("n_lines", "n_removed", "hit_lines"))
    joined = docs.alias("d").join(
        found.alias("f"), _key("d.") == F.col("f.hit_id"), "left"
    ).select("d.*", F.col("f.hit_lines").alias(gone))
    hits = F.filter(_codes("text"), lambda code: F.array_contains(gone, code))
    rest = F.filter(
        _lines("text"),
        lambda line: F.rlike(line, F.lit(_BLANK)) | ~F.array_contains(gone, F.xxhash64(line)),
    )
    counted = joined.select(
        *[F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n")).alias("text")
          if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.size(_codes("text")).cast("bigint").alias(total),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(hits)).cast("bigint").alias(removed),
    )
    return counted, total, removed
