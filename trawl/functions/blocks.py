"""Blocks of pages: what they hold of a word, in one number and one bit per page.

A word's part in a page's score is ``term_frequency / max_tf``, a thousandfold if the
title has the word, times what the query contributes, by the page's length. The
highest one in a block bounds that of all its pages that the bits name; with the
lengths of its pages, a search can leave out those that cannot be among its results.
The bits also tell how many pages hold any of several words without looking at a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value.
TITLE_BOOST = 1000
#: Bits of a block's number for its batch (the highest), task, and place in the task.
_TASK_BITS, _PLACE_BITS = 21, 22
#: Pages of a block, as a power of two; a bit of a bigint each.
SLOT_BITS = 6
_ROW_BITS = 33  # of monotonically_increasing_id


def impact() -> Column:
    """The part of a posting's weight that no query and no other posting changes."""
    boost = F.when(F.col("in_title"), TITLE_BOOST).otherwise(1)
    return F.col("term_frequency") * boost / F.col("max_tf")


def in_blocks(pages: DataFrame, batch: int) -> DataFrame:
    """Pages with their ``block`` and their ``slot`` in it, as they lie in a task.

    A task's pages are sorted by length first: blocks of similar pages have bounds near
    to their scores. Nothing is moved between tasks. The numbers are settled when the
    rows are written.
    """
    number = F.col("_number")
    row = number.bitwiseAND((1 << _ROW_BITS) - 1)
    task = F.shiftright(number, _ROW_BITS)
    block = (
        F.lit(batch << (_TASK_BITS + _PLACE_BITS)).cast("bigint")
        + F.shiftleft(task, _PLACE_BITS)
        + F.shiftright(row, SLOT_BITS)
    )
    return (
        pages.sortWithinPartitions("document_size")
        .withColumn("_number", F.monotonically_increasing_id())
        .withColumn("block", block)
        .withColumn("slot", number.bitwiseAND((1 << SLOT_BITS) - 1).cast("int"))
        .drop("_number")
    )


def bits_of_slots() -> Column:
    """The bits of slots, of all rows of a group."""
    return F.bit_or(F.expr("shiftleft(1L, slot)"))


def block_bounds(postings: DataFrame) -> DataFrame:
    """``word, block, top, pages``: highest impact, and a bit per page, of a word in a block.

    Pages with the word in their title have a row of their own, as it weighs a thousandfold.
    """
    return postings.groupBy("word", "block", "in_title").agg(
        F.max(impact()).alias("top"), bits_of_slots().alias("pages")
    ).drop("in_title")


def page_bounds(parts: Column, sizes: Column) -> Column:
    """For each page of a block, the sum of the ``part`` of words whose ``pages`` have it, by its length."""
    def of_page(size: Column, slot: Column) -> Column:
        total = F.aggregate(
            parts, F.lit(0.0),
            lambda total, word: total + F.when(F.getbit(word["pages"], slot) == 1, word["part"]).otherwise(0.0),
        )
        return (total / F.greatest(size, F.lit(1))).cast("float")

    return F.transform(sizes, of_page)


def bits_of(slots: Column) -> Column:
    """An array of slots as bits."""
    return F.aggregate(
        slots, F.lit(0).cast("bigint"),
        lambda bits, slot: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot)),
    )


def pages_reaching(bounds: Column, least: Column) -> Column:
    """The bits of pages whose bound is ``least`` or more."""
    slots = F.sequence(F.lit(0), F.size(bounds) - 1)
    return bits_of(F.filter(slots, lambda slot: F.get(bounds, slot) >= least))


def block_sizes(pages: DataFrame) -> DataFrame:
    """``block, sizes``: the lengths of the pages of a block, by slot."""
    sizes = F.array_sort(F.collect_list(F.struct("slot", "document_size")))
    return pages.groupBy("block").agg(sizes.getField("document_size").alias("sizes"))


def dead_pages(gone: DataFrame) -> DataFrame:
    """``block, gone``: the bits of pages that a later batch replaced."""
    return gone.groupBy("block").agg(bits_of_slots().alias("gone"))
