"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import fresh, kept, words_column

#: A list of sources beyond this is refused, as their plan is made by the driver.
MAX_SOURCES = 100_000
SHARD_WORDS = 1 << 18
SHARDS_PER_RANGE = 4096
#: Repeated rows numbered at once.
COPIES_AT_ONCE = 1 << 14
BLOCK_WORDS = 256
#: The smallest target holds at least so many blocks.
LEAST_BLOCKS = 200

_MIX = (
    "doc_id bigint, source string, size bigint, text_hash bigint, source_size bigint, target double, "
    "taken bigint, passes int, picks array<struct<first:bigint,stop:bigint>>"
)


@dataclass(frozen=True)
class SourceShare:
    source: str | None
    size: int
    target: float
    blocks: int


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = 3.0) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its source's size.

    What a source cannot take is shared among the others by weight, until none
    is above its bound.
    """
    total, free = float(sum(sizes)), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while free:
        rest = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        share = {i: rest * weights[i] / weight for i in sorted(free)}
        above = {i for i in free if share[i] > most * sizes[i]}
        for i in above or free:
            out[i] = float(most * sizes[i]) if i in above else share[i]
        free = free - above if above else set()
    return out


def sainte_lague(votes: Sequence[float], seats: int) -> list[int]:
    """Seats by the highest quotients votes / (2 * held + 1); ties go to the first.

    Rounding by the common divisor leaves fewer seats open than there are
    parties; those are settled one by one.
    """
    total = float(sum(votes))
    if not total or seats <= 0:
        return [0] * len(votes)
    held = [int(v * seats / total + 0.5) for v in votes]
    gap = seats - sum(held)
    if gap >= 0:
        queue = [(-v / (2 * h + 1), i) for i, (v, h) in enumerate(zip(votes, held))]
    else:
        queue = [(v / (2 * h - 1), -i) for i, (v, h) in enumerate(zip(votes, held)) if h]
    heapq.heapify(queue)
    for _ in range(abs(gap)):
        i = abs(heapq.heappop(queue)[1])
        held[i] += 1 if gap > 0 else -1
        if gap > 0:
            heapq.heappush(queue, (-votes[i] / (2 * held[i] + 1), i))
        elif held[i]:
            heapq.heappush(queue, (votes[i] / (2 * held[i] - 1), -i))
    return held


def source_shares(
    sized: DataFrame, weights: Sequence[float], most: float
) -> tuple[int, list[SourceShare]]:
    """Block length, and each source's size, target and number of blocks."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], most)
    least = min((g for g in goals if g), default=0.0)
    block = max(1, min(BLOCK_WORDS, int(least / LEAST_BLOCKS)))
    blocks = sainte_lague(goals, round(sum(goals) / block))
    shares = [SourceShare(r["source"], *x) for r, x in zip(rows, zip(sizes, goals, blocks))]
    return block, shares


def _spans(first: int, stop: int, starts: np.ndarray, stops: np.ndarray) -> list[dict]:
    """Word ranges inside a document of what lies in [first, stop), neighbours joined."""
    out: list[dict] = []
    for a, b in zip(starts.tolist(), stops.tolist()):
        a, b = max(a, first) - first, min(b, stop) - first
        if out and out[-1]["stop"] == a:
            out[-1]["stop"] = b
        elif a < b:
            out.append({"first": a, "stop": b})
    return out


def _shard(table: pa.Table, block: int, most: int, seed: int) -> Iterator[dict]:
    """Full passes over one shard, then blocks drawn without repetition.

    The shard is cut into blocks of equal length to a word, so their last one
    is not shorter than the others.
    """
    ids = table["doc_id"].fill_null(-1).to_numpy()
    size = table["size"].to_numpy()
    ties = [table[c].to_numpy() for c in ("copy", "text_hash")]
    order = np.lexsort((*ties, size, ids, table["draw"].to_numpy()))
    stop = np.cumsum(size[order])
    start = stop - size[order]
    words = int(stop[-1])
    wanted = min(table["quota"][0].as_py() * block, most * words)
    if table["blocks"][0].as_py() * block > most * table["source_size"][0].as_py() - block:
        wanted = most * words  # the source is at its bound, so are all its shards
    passes, rest = divmod(wanted, words)
    count = max(1, round(words / block))
    edges = np.arange(count + 1, dtype=np.int64) * words // count
    key = [seed, table["rank"][0].as_py(), table["shard"][0].as_py()]
    draw = np.random.default_rng(key).permutation(count)[: round(rest * count / words)]
    chosen = np.sort(draw)
    lo, hi = edges[chosen], edges[chosen + 1]
    # the first and the one after the last chosen block that meet a document
    left, right = np.searchsorted(hi, start, "right"), np.searchsorted(lo, stop, "left")
    for k, row in enumerate(order.tolist()):
        a, b = int(start[k]), int(stop[k])
        picks = _spans(a, b, lo[left[k] : right[k]], hi[left[k] : right[k]])
        taken = passes * (b - a) + sum(p["stop"] - p["first"] for p in picks)
        yield {"row": row, "taken": taken, "passes": passes, "picks": picks}


def numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows``, equal ones numbered from 0 in a column copy.

    Equal rows are counted and laid out again from their number, so that copies
    beyond any number stay apart and no task gathers them.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    step = F.lit(COPIES_AT_ONCE).cast("bigint")
    chunks = counted.withColumn("at", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES_AT_ONCE}L)")))
    last = F.least(F.col("copies"), F.col("at") + step) - 1
    return chunks.withColumn("copy", F.explode(F.sequence("at", last))).drop("copies", "at")


def shard_quotas(dealt: DataFrame) -> DataFrame:
    """Blocks of every shard: quota_rank, quota_shard, quota.

    The blocks of a source are cut at the rounded shares of the words up to each
    shard. So a shard gets its share to less than a block, and those of a source
    add up to its blocks.
    """
    each = dealt.groupBy("rank", "shard").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("whole"),
        F.first("blocks").alias("blocks"),
    )
    # sums up to a range of shards, then within it, so no task holds a source's shards
    each = each.withColumn("range", F.floor(F.col("shard") / SHARDS_PER_RANGE))
    by_range, by_shard = (
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        for *keys, order in (("rank", "range"), ("rank", "range", "shard"))
    )
    ranges = each.groupBy("rank", "range").agg(F.sum("words").alias("words")).select(
        "rank", "range", (F.sum("words").over(by_range) - F.col("words")).alias("before")
    )
    each = each.withColumn("up_to", F.sum("words").over(by_shard)).join(ranges, ["rank", "range"])
    each = each.withColumn("up_to", F.col("up_to") + F.col("before"))
    stop, start = (
        F.floor(F.col("blocks") * (words / F.col("whole")) + 0.5)
        for words in (F.col("up_to"), F.col("up_to") - F.col("words"))
    )
    return each.select(
        F.col("rank").alias("quota_rank"), F.col("shard").alias("quota_shard"),
        (stop - start).cast("bigint").alias("quota"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    seed: int = 42,
) -> DataFrame:
    """What a mix takes of every document.

    Sources in code point order, null last, weigh ``weights``, repeated. Their
    targets share the size of the whole input (:func:`targets`). The targets are
    cut into blocks of equal words, given to the sources by Sainte-Laguë. A
    source is dealt by a hash into shards of about ``SHARD_WORDS``; a shard gets
    its quota of the blocks (:func:`shard_quotas`), laid out in seeded order:
    whole passes first, then blocks drawn at random for the rest. So one source
    may hold any part of the input, and a task sees one shard.

    Returns doc_id, source, size, text_hash, source_size, target, taken (words, repeats
    counted), passes (times the whole text is taken) and picks (word ranges taken
    once more). No document is taken more than ``most`` times its size. The same
    rows give the same mix, whatever their order and partitions.

    A text without words, or null, is never taken. Null doc_ids are allowed. A
    repeated row counts and is drawn on its own, also of rows without id: the hash that
    deals them reads id, text and the number of the copy. An empty table gives no rows.
    Columns other than doc_id, text and source are not read.
    """
    sized = docs.select(
        "doc_id", "source", words_column("text").alias("size"), F.xxhash64("text").alias("text_hash")
    )
    sized = kept(numbered_copies(sized), "sizes")
    block, shares = source_shares(sized, weights, most)
    plan = docs.sparkSession.createDataFrame(
        [
            (i, s.source, s.size, s.target, s.blocks, max(1, -(-s.size // SHARD_WORDS)))
            for i, s in enumerate(shares)
        ],
        "rank bigint, source string, source_size bigint, target double, blocks bigint, shards bigint",
    )
    # at most MAX_SOURCES rows
    planned = sized.alias("d").join(
        F.broadcast(plan.alias("p")), F.col("d.source").eqNullSafe(F.col("p.source"))
    ).select("d.*", "rank", "source_size", "target", "blocks", "shards")
    row = ("doc_id", "size", "text_hash", "copy")
    draw = F.xxhash64(F.lit(seed), *row)
    shard = F.pmod(F.xxhash64(F.lit(seed + 1), *row), "shards")
    dealt = planned.where("size > 0").select(
        "*", draw.alias("draw"), shard.alias("shard")
    ).drop("shards")
    quotas = shard_quotas(dealt)
    dealt = dealt.join(
        quotas,
        (F.col("rank") == F.col("quota_rank")) & (F.col("shard") == F.col("quota_shard")),
    ).drop("quota_rank", "quota_shard")

    def laid(table: pa.Table) -> pa.Table:
        rows = list(_shard(table, block, most, seed))
        out = table.take(pa.array([r["row"] for r in rows], pa.int64()))
        picks = pa.array(
            [r["picks"] for r in rows],
            pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())])),
        )
        out = out.select(["doc_id", "source", "size", "text_hash", "source_size", "target"])
        out = out.append_column("taken", pa.array([r["taken"] for r in rows], pa.int64()))
        out = out.append_column("passes", pa.array([r["passes"] for r in rows], pa.int32()))
        return out.append_column("picks", picks)

    taken = dealt.groupBy("rank", "shard").applyInArrow(laid, _MIX)
    none = planned.where("size = 0").select(
        "doc_id", "source", "size", "text_hash", "source_size", "target",
        F.lit(0).cast("bigint").alias("taken"), F.lit(0).alias("passes"),
        F.array().cast("array<struct<first:bigint,stop:bigint>>").alias("picks"),
    )
    return taken.unionByName(none)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that a mix takes something of, with what it takes.

    Adds mix_taken, mix_passes and mix_picks of :func:`mix` to the columns of
    ``docs`` (with ``_`` behind a name that ``docs`` has already). Documents
    nothing is taken of are left out. Rows that agree in id, source and text
    share the largest of their counts. An empty table gives no rows.
    """
    chosen = mix(docs, **options).where("taken > 0")
    keys = [F.col(c).alias(f"mix_{c}") for c in ("doc_id", "source", "text_hash")]
    best = chosen.groupBy(*keys).agg(
        F.max(F.struct("taken", "passes", "picks")).alias("best")
    )
    own = {c: fresh(docs, f"mix_{c}") for c in ("taken", "passes", "picks")}
    hashed = fresh(docs, "mix_text_hash")
    left = docs.withColumn(hashed, F.xxhash64("text")).alias("d")
    joined = left.join(
        best.alias("m"),
        F.col("d.doc_id").eqNullSafe(F.col("m.mix_doc_id"))
        & F.col("d.source").eqNullSafe(F.col("m.mix_source"))
        & (F.col(f"d.{hashed}") == F.col("m.mix_text_hash")),
    )
    return joined.select(
        *[F.col(f"d.`{c}`") for c in docs.columns],
        *[F.col(f"m.best.{c}").alias(name) for c, name in own.items()],
    )
