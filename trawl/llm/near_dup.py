"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import (
    SHINGLE_WORDS, WordHashes, by_arrow, drop_kept, kept, lower_words, mixed, shingles,
)

#: Bands of each of the two collections, and minhashes of a band.
BANDS = 12
BAND_ROWS = 3
#: Rounds that compare a table's documents with one of them, before the exact rest.
_WORD = r"[^\x20\x09-\x0D]"
ROUNDS = 2
#: Counters that order shingles by frequency; any order is right, rare ones first is fast.
ORDER_BITS = 18
_BLOCK = 1 << 13


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes; empty without words."""
    return np.unique(shingles(hashes.of(lower_words(text or "")), SHINGLE_WORDS))


def digest(members: np.ndarray) -> bytes:
    """128 bits that name a shingle set: texts that agree in it form one class."""
    return xxhash.xxh3_128_digest(members.tobytes())


def band_keys(members: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """Keys of ``2 * bands`` bands, a row per collection, from as many times ``rows`` minhashes.

    Table (i, j) is keyed by band i of the first and band j of the second
    collection: bands² tables of 2 * rows minhashes each for 2 * bands * rows
    computed ones.
    """
    count = 2 * bands * rows
    odd = mixed(np.arange(count, dtype=np.uint64), 7) | np.uint64(1)
    add = mixed(np.arange(count, dtype=np.uint64), 8)
    low = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(members), _BLOCK):
        values = members[i : i + _BLOCK, None] * odd + add
        low = np.minimum(low, (values ^ (values >> np.uint64(29))).min(axis=0))
    keys = np.zeros(2 * bands, np.uint64)
    for column in low.reshape(2 * bands, rows).T:
        keys = mixed(keys * np.uint64(31) + column, 3)
    return keys.view(np.int64).reshape(2, bands)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest and the keys of both collections."""

    def job(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, hashes) for t in batch.column(2).to_pylist()]
            keys = [band_keys(s) if len(s) else np.empty((2, 0), np.int64) for s in sets]
            yield {
                "doc_id": batch.column(0),
                "text_hash": batch.column(1),
                "n_shingles": [len(s) for s in sets],
                "digest": [digest(s) if len(s) else None for s in sets],
                "first": [k[0] for k in keys],
                "second": [k[1] for k in keys],
            }

    schema = (
        "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, "
        "first array<bigint>, second array<bigint>"
    )
    return by_arrow(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), schema, job)


def _sided(keys: str, side: int) -> Column:
    return F.transform(
        keys, lambda v, i: F.struct(F.lit(side).alias("side"), i.alias("band"), v.alias("value"))
    )


def table_members(classes: DataFrame) -> DataFrame:
    """table, digest, n_shingles, weight for tables that hold two classes or more.

    Bands that only one class has cannot make a shared table key; they go
    before pairs are formed. ``weight`` counts a class's shared bands: the
    original of many copies shares more than each of them.
    """
    bands = classes.select(
        "digest", "n_shingles",
        F.explode(F.concat(_sided("first", 0), _sided("second", 1))).alias("b"),
    ).select("digest", "n_shingles", "b.*")
    shared = bands.groupBy("side", "band", "value").count().where("count > 1").drop("count")
    own = (
        bands.join(shared, ["side", "band", "value"], "left_semi")
        .groupBy("digest", "n_shingles")
        .agg(
            F.collect_list(F.when(F.col("side") == 0, F.struct("band", "value"))).alias("first"),
            F.collect_list(F.when(F.col("side") == 1, F.struct("band", "value"))).alias("second"),
        )
    )
    pairs = own.select(
        "digest", "n_shingles", (F.size("first") + F.size("second")).alias("weight"),
        F.explode("first").alias("a"), "second",
    ).select("digest", "n_shingles", "weight", "a", F.explode("second").alias("b"))
    keyed = pairs.select(
        F.xxhash64("a.band", "a.value", "b.band", "b.value").alias("table"),
        "digest", "n_shingles", "weight",
    )
    full = keyed.groupBy("table").count().where("count > 1").drop("count")
    return keyed.join(full, "table", "left_semi")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of classes whose full sets are at least ``percent`` alike."""
    both = pairs.join(sets.select(F.col("digest").alias("x"), F.col("members").alias("mx")), "x").join(
        sets.select(F.col("digest").alias("y"), F.col("members").alias("my")), "y"
    )
    common = F.size(F.array_intersect("mx", "my"))
    union = F.size("mx") + F.size("my") - common
    return both.where(100 * common >= percent * union).select("x", "y")


def _could_link(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be so alike."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node it reaches, of all nodes of ``edges`` (x, y).

    Large-star and small-star steps: every node is linked to the smallest one
    near it, until all are linked to their component's. Minima combine before
    the shuffle and joins may be split, so a node may have any number of links.
    """
    spark = edges.sparkSession
    pairs = edges.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    edges = kept(pairs.distinct(), "edges")
    sum_of = (F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")))
    state = edges.agg(*sum_of).first()
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("low"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("x"), F.col("low").alias("y"))
        large = kept(large.where("x <> y").distinct(), "edges")
        low = large.groupBy("x").agg(F.min("y").alias("low"))
        small = large.join(low, "x").select(F.col("y").alias("x"), F.col("low").alias("y"))
        small = small.unionByName(low.select("x", F.col("low").alias("y")))
        after = kept(small.where("x <> y").distinct(), "edges")
        now = after.agg(*sum_of).first()
        drop_kept(spark, edges, large)
        edges = after
        if now == state:
            break
        state = now
    labels = edges.select(F.col("x").alias("node"), F.col("y").alias("label"))
    return labels.unionByName(edges.select(F.col("y").alias("node"), F.col("y").alias("label")).distinct())


@dataclass
class _Labels:
    """Classes and the component found for them so far."""

    table: DataFrame

    def merged(self, links: DataFrame) -> _Labels:
        """After joining the components at both ends of ``links``."""
        spark = links.sparkSession
        x = self.table.select(F.col("digest").alias("x"), F.col("label").alias("lx"))
        y = self.table.select(F.col("digest").alias("y"), F.col("label").alias("ly"))
        found = components(
            links.join(x, "x").join(y, "y").select(F.col("lx").alias("x"), F.col("ly").alias("y"))
        )
        new = self.table.join(
            found.select(F.col("node").alias("label"), F.col("label").alias("better")), "label", "left"
        ).select("digest", F.coalesce("better", "label").alias("label"), "n_shingles")
        out = kept(new, "labels")
        drop_kept(spark, found, self.table)
        return _Labels(out)


def _star_pairs(members: DataFrame, labels: _Labels, turn: int, percent: int) -> DataFrame:
    """Each class of a table that holds several components, with one class of the table."""
    named = members.join(labels.table.select("digest", "label"), "digest")
    order = F.struct(
        (-F.col("weight")).alias("w") if turn == 0 else F.xxhash64(F.lit(turn), "digest").alias("w"),
        F.col("digest"), F.col("label"), F.col("n_shingles"),
    )
    centre = named.groupBy("table").agg(
        F.min(order).alias("c"), F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low <> high")
    return (
        named.join(centre, "table")
        .where((F.col("label") != F.col("c.label")))
        .where(_could_link(F.col("n_shingles"), F.col("c.n_shingles"), percent))
        .select(F.col("digest").alias("x"), F.col("c.digest").alias("y")).distinct()
    )


def _rest_pairs(
    members: DataFrame, labels: _Labels, sets: DataFrame, percent: int
) -> DataFrame:
    """Every further pair of different components that can still be a link.

    Classes in tables that still hold several components are joined on the
    shingles of their prefixes, rare ones first: sets so alike must share one of
    the first n - ceil(n * percent / 100) + 1, and what stands before the first
    shared one is lost to their overlap.
    """
    spark = members.sparkSession
    named = members.select("table", "digest").join(labels.table.select("digest", "label"), "digest")
    mixed_tables = named.groupBy("table").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low <> high").select("table")
    active = named.join(mixed_tables, "table", "left_semi").select("digest", "label").distinct()
    rows = kept(sets.join(active, "digest").select("digest", "label", "members"), "active-sets")
    shift = np.uint64(64 - ORDER_BITS)

    def count(batches):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            total += np.bincount((mixed(values, 5) >> shift).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield {"slot": at, "times": total[at]}

    # at most 2 ** ORDER_BITS rows
    counted = by_arrow(rows.select("members"), "slot int, times bigint", count)
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    for slot, times in counted.groupBy("slot").agg(F.sum("times")).collect():
        counts[slot] = times

    def prefixes(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("token", "digest", "label", "n", "pos")}
            for name, label, values in zip(*[c.to_pylist() for c in batch.columns]):
                values = np.array(values, np.int64)
                times = counts[(mixed(values.view(np.uint64), 5) >> shift).astype(np.int64)]
                size = len(values) + (-len(values) * percent // 100) + 1
                first = np.lexsort((values, times))[:size]
                out["token"] += values[first].tolist()
                out["pos"] += range(len(first))
                for column, value in (("digest", name), ("label", label), ("n", len(values))):
                    out[column] += [value] * len(first)
            yield out

    entries = by_arrow(
        rows.select("digest", "label", "members"),
        "token bigint, digest binary, label binary, n int, pos int", prefixes,
    )
    entries = kept(entries, "prefixes")
    several = entries.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low <> high").select("token")
    open_entries = entries.join(several, "token", "left_semi")
    a, b = open_entries.alias("a"), open_entries.alias("b")
    left = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    return a.join(b, "token").where(
        (F.col("a.label") < F.col("b.label"))
        & _could_link(F.col("a.n"), F.col("b.n"), percent)
        & (left * (100 + percent) >= percent * (F.col("a.n") + F.col("b.n")))
    ).select(F.col("a.digest").alias("x"), F.col("b.digest").alias("y")).distinct()


def near_duplicates(
    docs: DataFrame, percent: int = 85, with_group: bool = False
) -> DataFrame:
    """Components of documents whose shingle sets are at least ``percent`` alike.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable) and
    kept (it is that document); with ``with_group`` also text_hash (xxhash64) and
    group, a name of the component that does not depend on ids and is null without
    words. Words are cut at white space, with A-Z in lower case; a set holds the
    distinct runs of five words, or the whole of a shorter text. Texts with one set form one class. Classes that share a MinHash table
    are candidates; every link is confirmed on the full sets.

    A table's classes are compared with one of them, in several rounds; tables
    whose classes then belong to one component are done. All pairs that remain
    possible in the others are found by prefixes of their sets. So a group of
    any size costs what its members cost, no cap is set, and only candidates the
    tables miss are lost (about 1 pair in 50,000 at 85 %).

    Null and empty texts, or those of blanks only, have no set and no links, and
    are kept. Rows that share a doc_id stay separate rows. A null doc_id never
    names a component unless all ids in it are null. An empty table gives no
    rows. Other columns are not read.
    """
    spark = docs.sparkSession
    signed = kept(signatures(docs), "signatures")
    classes = kept(
        signed.where("n_shingles > 0").groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
            F.first("first").alias("first"), F.first("second").alias("second"),
            F.max(F.struct("doc_id", "text_hash")).alias("row"),
        ),
        "classes",
    )
    members = kept(table_members(classes), "tables")
    involved = members.select("digest").distinct()
    wanted = classes.join(involved, "digest", "left_semi").select(
        F.col("row.doc_id").alias("wanted_id"), F.col("row.text_hash").alias("wanted_hash"),
        F.col("digest").alias("wanted"),
    )

    def full_sets(batches):
        hashes, seen = WordHashes(), set()
        for batch in batches:
            found = []
            for text, name in zip(*[c.to_pylist() for c in batch.columns]):
                if name not in seen and digest(members := shingle_set(text, hashes)) == name:
                    seen.add(name)
                    found.append((name, members))
            yield {"digest": [n for n, _ in found], "members": [s.view(np.int64) for _, s in found]}

    # by id and text, as many rows may have no id
    texts = docs.select("doc_id", "text").join(
        wanted,
        F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.xxhash64("text") == F.col("wanted_hash")),
    ).select("text", "wanted")
    sets = kept(by_arrow(texts, "digest binary, members array<bigint>", full_sets), "sets")

    labels = _Labels(kept(
        members.select("digest", F.col("digest").alias("label"), "n_shingles").distinct(), "labels"
    ))
    for turn in range(ROUNDS):
        labels = labels.merged(_links(_star_pairs(members, labels, turn, percent), sets, percent))
    labels = labels.merged(_links(_rest_pairs(members, labels, sets, percent), sets, percent))

    ids = classes.select("digest", "doc_id").join(labels.table.select("digest", "label"), "digest", "left")
    ids = ids.select("digest", "doc_id", F.coalesce("label", "digest").alias("label"))
    lowest = ids.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = kept(ids.join(lowest, "label").select("digest", "component_id", F.col("label").alias("group")), "components")
    drop_kept(spark, members, sets, labels.table)
    out = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        *(["text_hash", "group"] if with_group else []),
    )


def first_of_each_group(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each group of :func:`near_duplicates`, with all its columns.

    It is the one with the smallest doc_id; a group without any id is represented by
    the text of the smallest hash. Of rows that agree in id and text one is kept.
    Texts without words, null ones too, are linked with nothing and all stay. An
    empty table gives no rows.
    """
    found = near_duplicates(docs, percent, with_group=True).where("kept AND n_shingles > 0")
    texts = found.groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("times"))
    names = kept(
        texts.groupBy("group").agg(
            F.min(F.struct(F.col("text_hash").alias("kept_hash"), "times", F.col("doc_id").alias("kept_id"))).alias("of")
        ).select("of.*"),
        "firsts",
    )
    held = docs.where(F.rlike(F.coalesce("text", F.lit("")), F.lit(_WORD)))

    def rows_of(chosen: DataFrame) -> DataFrame:
        same = held["doc_id"].eqNullSafe(chosen["kept_id"]) & (F.xxhash64(held["text"]) == chosen["kept_hash"])
        return held.join(chosen, same, "left_semi")

    # copies are combined before they are moved, so a hot group never meets in a task
    copies = rows_of(names.where("times > 1")).groupBy("doc_id", F.xxhash64("text").alias("hash")).agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")
    )
    return (
        rows_of(names.where("times = 1")).unionByName(copies.select("row.*"))
        .unionByName(docs.where(~F.rlike(F.coalesce("text", F.lit("")), F.lit(_WORD))))
    )
