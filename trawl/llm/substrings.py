"""Repeated passages by content-defined chunks: a gear rolling hash and digests."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import by_arrow, kept, mixed

#: A chunk ends where four bits of the rolling hash are zero, at the earliest
#: after MIN_CHUNK bytes, at the latest after MAX_CHUNK; about 35 bytes on average.
MIN_CHUNK = 20
MAX_CHUNK = 64
CUT_BITS = 4
GEAR_BYTES = 16
#: Chunks that are looked up together, so that common phrases do not count.
UNIT_CHUNKS = 2
#: Least words of a run of repeated units. A run starts and ends at chunk ends,
#: so a passage of 50 words leaves one of 41 on average.
MIN_WORDS = 25
#: Digests that may be sent to all tasks: those with more than this part of all units.
HOT_DIGESTS = 10_000
_BLOCK = 1 << 22
_GEAR = (mixed(np.arange(256, dtype=np.uint64), 17) >> np.uint64(32)).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _gear(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 16 bytes up to each place, modulo 2**32.

    The hash shifts by one bit per byte, so the sum over 16 bytes is that over
    8 plus that over the 8 before, shifted by 8; likewise for 8, 4 and 2.
    """
    out = _GEAR[data]
    span = 1
    while span < GEAR_BYTES:
        wider = out.copy()
        wider[span:] += out[:-span] << np.uint32(span)
        out, span = wider, 2 * span
    return out


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of a text end; a change moves only the ends near it."""
    ends, last = [], 0
    shift, mask = np.uint32(GEAR_BYTES - CUT_BITS), np.uint32((1 << CUT_BITS) - 1)
    for start in range(0, len(data), _BLOCK):
        lead = min(start, GEAR_BYTES - 1)
        hashed = _gear(data[start - lead : start + _BLOCK])[lead:]
        for end in (np.flatnonzero((hashed >> shift) & mask == 0) + (start + 1)).tolist():
            if end - last < MIN_CHUNK:
                continue
            while end - last > MAX_CHUNK:
                last += MAX_CHUNK
                ends.append(last)
            if end - last >= MIN_CHUNK:
                ends.append(end)
                last = end
    while len(data) - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


def units(text: str) -> Iterator[tuple[int, int, int, int, int]]:
    """Digest, first and stop code point, words begun before and in it, of runs of two chunks."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    ends = chunk_ends(data)
    if len(ends) < UNIT_CHUNKS:
        return
    edges = [0, *ends]
    digests = np.array(
        [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(edges, ends)], np.uint64
    )
    joined = np.zeros(len(ends) - UNIT_CHUNKS + 1, np.uint64)
    for i in range(UNIT_CHUNKS):
        joined = mixed(joined + digests[i : i + len(joined)], 19 + i)
    at = np.array(edges)
    space = _SPACE[data]
    begins = np.append(0, np.cumsum(~space & np.append(True, space[:-1])))[at]
    points = at if len(raw) == len(text) else np.append(0, np.cumsum((data & 0xC0) != 0x80))[at]
    yield from zip(
        joined.view(np.int64).tolist(),
        points[:-UNIT_CHUNKS].tolist(),
        points[UNIT_CHUNKS:].tolist(),
        begins[:-UNIT_CHUNKS].tolist(),
        (begins[UNIT_CHUNKS:] - begins[:-UNIT_CHUNKS]).tolist(),
    )


def _who() -> Column:
    """A document's name: its id, or a hash of its text if it has none."""
    return F.coalesce("doc_id", F.xxhash64("text"))


def _runs(found: list[dict], min_words: int) -> Iterator[dict]:
    """Passages of a text: first, stop, words, source.

    Units that overlap form a run. One of ``min_words`` or more is cut where the
    first document that has its units changes; neighbouring passages share the chunk
    in which it does.
    """
    runs: list[list[dict]] = []
    stop = 0
    for unit in sorted(found, key=lambda u: (u["first"], u["stop"])):
        if not runs or unit["first"] >= stop:
            runs.append([])
        runs[-1].append(unit)
        stop = unit["stop"]
    for run in runs:
        if run[-1]["word"] + run[-1]["words"] - run[0]["word"] < min_words:
            continue
        for source, part in groupby(run, key=lambda u: u["source"]):
            units_of = list(part)
            first, last = units_of[0], units_of[-1]
            yield {
                "first": first["first"], "stop": last["stop"],
                "words": last["word"] + last["words"] - first["word"], "source": source,
            }


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages that more than one document has, a row per document and passage.

    Returns doc_id, first and stop (code points), words (that begin in it),
    first_doc_id (the smallest that has it) and is_first (the row's own id is that
    one). Texts are cut into chunks where their content says so, whole and whatever
    stands before; pairs of neighbouring chunks with one digest in two documents
    or more are repeated, and overlapping ones are joined to a run. Runs of
    ``min_words`` or more are reported, cut where first_doc_id changes: of a run
    whose halves come from two documents, each half is a passage of its own,
    however short.

    Digests are counted before they are shuffled, and those that are over a
    10,000th of all units, at most 10,000, are looked up where the units lie; so a
    passage may stand in any part of the documents. Null and empty texts
    have no passage; passages inside one document, or in repeated rows of one
    doc_id, are not repeated. A document without id is known by its text's hash
    and reported with a null id. An empty table gives no rows. Other columns are
    not read.
    """
    named = docs.select("doc_id", _who().alias("who"), "text").where(F.col("text").isNotNull())

    def cut(batches):
        for batch in batches:
            who, text = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            known = batch.column(0).is_valid().to_pylist()
            step = 256
            for i in range(0, len(who), step):
                rows: list[tuple] = []
                for name, ok, t in zip(who[i : i + step], known[i : i + step], text[i : i + step]):
                    rows += [(name, ok, *u) for u in units(t)]
                yield dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

    names = ("who", "known", "digest", "first", "stop", "word", "words")
    table = kept(
        by_arrow(named, "who bigint, known boolean, digest bigint, first int, stop int, word int, words smallint", cut),
        "units",
    )
    repeated = kept(
        table.groupBy("digest").agg(
            F.min("who").alias("source"), F.max("who").alias("last"), F.count("*").alias("times")
        ).where("source <> last").select("digest", "source", "times"),
        "repeated",
    )
    packed = table.select("digest", "who", "known", F.struct("first", "stop", "word", "words").alias("at"))
    # not more than HOT_DIGESTS rows can each be so large a part of all
    hot_from = table.count() / HOT_DIGESTS
    hot = F.broadcast(repeated.where(F.col("times") > hot_from).drop("times"))
    rest = repeated.where(F.col("times") <= hot_from).drop("times")
    marked = packed.join(hot, "digest").unionByName(
        packed.join(hot, "digest", "left_anti").join(rest, "digest")
    )
    found = marked.groupBy("who", "known").agg(
        F.collect_list(F.struct("at.first", "at.stop", "at.word", "at.words", "source")).alias("units")
    )

    def join(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in passages}
            for who, known, found_units in zip(*[c.to_pylist() for c in batch.columns]):
                for run in _runs(found_units, min_words):
                    for n, v in zip(passages, (
                        who if known else None, run["first"], run["stop"], run["words"],
                        run["source"], run["source"] == who,
                    )):
                        out[n].append(v)
            yield out

    passages = ("doc_id", "first", "stop", "words", "first_doc_id", "is_first")
    return by_arrow(
        found,
        "doc_id bigint, first bigint, stop bigint, words bigint, first_doc_id bigint, is_first boolean",
        join,
    )


def without_repeats(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """Texts without the passages that an earlier document has, by doc_id.

    What is removed from a document stands in one with a smaller id, and there it
    is kept or stands in a still smaller one: one copy of everything stays. Rows
    without a passage, or without doc_id, stay as they are, null texts too; an empty
    table gives no rows. Rows that share a doc_id are taken for rows of one text.
    """
    gone = passages.where(~F.col("is_first") & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("gone_id")).agg(
        F.sort_array(F.collect_set(F.struct("first", "stop"))).alias("gone_spans")
    )
    joined = docs.alias("d").join(gone.alias("g"), F.col("d.doc_id") == F.col("g.gone_id"), "left")
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("at"))
    cut = F.aggregate(
        F.coalesce("g.gone_spans", F.array().cast("array<struct<first:bigint,stop:bigint>>")),
        start,
        lambda done, span: F.struct(
            F.concat(done["text"], F.substring(F.col("d.text"), (done["at"] + 1).cast("int"),
                                               (span["first"] - done["at"]).cast("int"))).alias("text"),
            span["stop"].alias("at"),
        ),
        lambda done: F.concat(done["text"], F.substring(F.col("d.text"), (done["at"] + 1).cast("int"), F.length("d.text"))),
    )
    return joined.select(*[
        F.when(F.col("g.gone_id").isNull(), F.col("d.text")).otherwise(cut).alias("text")
        if c == "text" else F.col(f"d.`{c}`") for c in docs.columns
    ])
