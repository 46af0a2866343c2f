"""The best documents for each query text, by the Best Position Algorithm over impact lists."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import by_arrow, kept
from trawl.llm.packing import ranges

#: Postings of a shard on average; a shard's lists are in one task's memory.
SHARD_POSTINGS = 1 << 20
#: Bytes of query texts that are answered by one pass over the documents.
QUERY_BYTES = 4 << 20
#: Positions of each list read before the first look at the threshold; doubled from there.
FIRST_DEPTH = 16
_PIECE = 1 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Fixed value: what a term is, A-Z being lower-cased before.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# the same for UTF-8: all other bytes separate
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms_column(text: Column | str) -> Column:
    """Distinct terms of a text, in ascending order."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_sort(F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))))


def term_counts(text: str | None) -> Counter[bytes]:
    """How often each term occurs in a text, counted piece by piece."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES)
    counts: Counter[bytes] = Counter()
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + _PIECE)
        stop = len(data) if stop < 0 else stop
        counts.update(data[start:stop].split())
        start = stop
    return counts


def postings(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """A row per document: row, doc_id, n (its terms with repeats), terms, tfs.

    ``terms`` are places in ``vocabulary``; ``row`` numbers the rows. Documents
    without any term at all are left out.
    """
    places = {t.encode("utf-8", "surrogatepass"): i for i, t in enumerate(vocabulary)}

    def job(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("doc_id", "n", "terms", "tfs")}
            for doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                counts = term_counts(text)
                if counts:
                    held = counts.keys() & places.keys()
                    out["doc_id"].append(doc_id)
                    out["n"].append(counts.total())
                    out["terms"].append([places[t] for t in held])
                    out["tfs"].append([counts[t] for t in held])
            yield out

    rows = by_arrow(
        docs.select("doc_id", "text"), "doc_id bigint, n bigint, terms array<int>, tfs array<int>", job
    )
    return rows.select(F.monotonically_increasing_id().alias("row"), "*")


@dataclass
class Lists:
    """Impact lists of one shard, and the same postings by document.

    ``at[start[t] + p]`` is the posting at position ``p`` of the list of term ``t``.
    """

    doc: np.ndarray
    term: np.ndarray
    impact: np.ndarray
    position: np.ndarray
    at: np.ndarray
    start: np.ndarray
    first: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, terms: pa.ListArray, tfs: pa.ListArray, m: np.ndarray, weight: np.ndarray) -> Lists:
        count = np.diff(terms.offsets.to_numpy())
        term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tf = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(count)), count)
        impact = weight[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * m[doc]))
        at = np.lexsort((doc, -impact, term))
        start = np.searchsorted(term[at], np.arange(len(weight) + 1))
        position = np.empty(len(at), np.int64)
        position[at] = np.arange(len(at)) - start[term[at]]
        return cls(doc, term, impact, position, at, start, np.cumsum(count) - count, count)


def best_positions(lists: Lists, query: np.ndarray, weight: np.ndarray, k: int, slot: np.ndarray):
    """Documents that can be among the ``k`` best of a shard, and their scores.

    Sorted accesses go down all lists in step. Each document met is looked up in
    all lists (direct accesses), which marks its positions as seen too. The best
    position of a list is the last one before its first unseen position; no unseen
    document scores more than the sum of impacts at the best positions. Reading stops
    when that sum is strictly below the k-th score, so that ties are all found.

    Terms that more than half of all documents hold weigh nothing or less. They
    cannot raise a score, so their lists are only accessed directly. ``slot`` holds
    -1 for each term of the vocabulary, before and after.
    """
    length = lists.start[query + 1] - lists.start[query]
    listed = query[(weight[query] > 0) & (length > 0)]
    start, length = lists.start[listed], lists.start[listed + 1] - lists.start[listed]
    # a place per position of each list, and one behind it that is never seen
    offset = np.cumsum(length + 1) - (length + 1)
    seen = np.zeros(int((length + 1).sum()), bool)
    met = np.zeros(len(lists.count), bool)
    docs, scores = [], []
    best = np.zeros(0, np.int64)
    slot[query] = len(listed)
    slot[listed] = np.arange(len(listed))
    low, high, deepest = 0, FIRST_DEPTH, int(length.max(initial=0))
    while low < deepest:
        upto = np.minimum(length, high)
        found = lists.doc[lists.at[ranges(start + np.minimum(low, upto), upto - np.minimum(low, upto))]]
        new = np.unique(found[~met[found]])
        if len(new):
            met[new] = True
            count = lists.count[new]
            i = ranges(lists.first[new], count)
            where = slot[lists.term[i]]
            held = np.where(where >= 0, lists.impact[i], 0)
            total = np.add.reduceat(held, np.cumsum(count) - count)
            of_list = (where >= 0) & (where < len(listed))
            seen[offset[where[of_list]] + lists.position[i[of_list]]] = True
            good = total > 0
            docs.append(new[good])
            scores.append(total[good])
            best = np.concatenate([best, total[good]])
            if len(best) > k:
                best = np.partition(best, len(best) - k)[-k:]
        unseen = np.flatnonzero(~seen)
        reached = unseen[np.searchsorted(unseen, offset)] - offset
        open_ = reached < length
        bound = lists.impact[lists.at[(start + np.maximum(reached, 1) - 1)[open_]]].sum()
        if not open_.any() or (len(best) == k and bound < best.min()):
            break
        low, high = high, 2 * high
    slot[query] = -1
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, score = np.concatenate(docs), np.concatenate(scores)
    enough = score >= (best.min() if len(best) == k else 1)
    return doc[enough], score[enough]


def _ranked_block(docs: DataFrame, queries: dict[int, str], k: int) -> DataFrame:
    """The best documents of queries, given as terms with spaces between: number, rank, doc_id, score."""
    vocabulary = sorted({t for q in queries.values() for t in q.split(" ")})
    place = {t: i for i, t in enumerate(vocabulary)}
    asked = {n: np.array([place[t] for t in q.split(" ")], np.int64) for n, q in queries.items()}
    rows = kept(postings(docs, vocabulary), "term-rows")
    n_docs, n_terms, n_postings = rows.agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))
    ).first()
    # at most a row per word of the vocabulary
    df = {r.term: r.df for r in rows.select(F.explode("terms").alias("term"))
          .groupBy("term").agg(F.count("*").alias("df")).collect()}
    weight = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))],
        np.int64,
    )
    shards = max(1, math.ceil(n_postings / SHARD_POSTINGS))

    def rank(shard: pa.Table) -> pa.Table:
        shard = shard.combine_chunks()
        ids, n = shard["doc_id"].to_pylist(), shard["n"].to_pylist()
        m = np.array([10 + (90 * x * n_docs) // n_terms for x in n], np.int64)
        terms, tfs = shard["terms"].chunk(0), shard["tfs"].chunk(0)
        lists = Lists.of(terms, tfs, m, weight)
        slot = np.full(len(vocabulary), -1, np.int64)
        out: list[tuple[int, int | None, int]] = []
        for number, query in asked.items():
            doc, score = best_positions(lists, query, weight, k, slot)
            found = [(number, ids[d], s) for d, s in zip(doc.tolist(), score.tolist())]
            found.sort(key=lambda f: (-f[2], f[1] is None, f[1] or 0))
            out += found[:k]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("number", "doc_id", "score"), columns)})

    held = rows.where(F.size("terms") > 0).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    local = held.groupBy("shard").applyInArrow(rank, "number bigint, doc_id bigint, score bigint")
    by_score = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = local.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return best.select("number", "rank", "doc_id", "score")


def _query_blocks(queries: DataFrame) -> Iterator[dict[int, str]]:
    """Numbered queries in parts of about ``QUERY_BYTES``."""
    total = queries.agg(F.coalesce(F.sum(F.octet_length("query")), F.lit(0))).first()[0]
    blocks = math.ceil(total / QUERY_BYTES)
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        yield {r.number: r.query for r in mine.collect()}


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score.

    ``items`` has item_id and text. Scores are sums of integer impacts of the
    item's distinct terms; equal scores are ranked by ascending doc_id, those
    without id last. Documents that score nothing are no results.

    Documents are dealt into shards of about ``SHARD_POSTINGS`` postings of query
    words. Each shard has its own impact lists and answers all queries by
    :func:`best_positions`; a query's best documents of all shards are merged. A shard
    holds its share of every list, so no word is too frequent for a task. Queries are
    answered in parts of ``QUERY_BYTES``, each one pass over the documents that is
    written before the next.

    Null and empty texts hold no term: as documents they count for nothing, as
    items they have no results. A repeated document is ranked as often as it
    comes, a repeated item gets its results as often as it comes. An empty table
    on either side gives no rows; other columns are not read.
    """
    keyed = items.select("item_id", F.array_join(terms_column("text"), " ").alias("query")).where(
        F.col("query") != ""
    )
    distinct = keyed.select("query").distinct()
    queries = kept(distinct.select(F.monotonically_increasing_id().alias("number"), "query"), "queries")
    best = None
    for block in _query_blocks(queries):
        found = kept(_ranked_block(docs, block, k), "ranked")
        best = found if best is None else best.unionByName(found)
    if best is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame(
            [], f"item_id {kind}, rank int, doc_id bigint, score bigint"
        )
    return keyed.join(queries, "query").join(best, "number").select("item_id", "rank", "doc_id", "score")
