"""Bounds by block: the same results as scoring every hit, read from fewer postings."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trawl import IndexStore, analyse, parse_queries, plain_fields, search_json, session
from trawl.functions import blocks
from trawl.operators import scoring
from trawl.session import new_folder, written


@pytest.fixture(scope="module")
def store(spark):
    """Two batches of texts of many lengths; the second one replaces a third of the first."""
    rng = random.Random(7)
    words = [f"word{i}" for i in range(120)]

    def rows(ids):
        return [
            (f"doc:{i}", " ".join(rng.choices(words, weights=range(1, 121), k=rng.choice([3, 20, 150, 400]))))
            for i in ids
        ]

    store = IndexStore(spark, new_folder(spark, "blocks"), buckets=4)
    for epoch, ids in enumerate((range(1_500), range(0, 1_500, 3))):
        table = spark.createDataFrame(rows(ids), "name string, text string")
        store.append(analyse(plain_fields(table, F.col("name"), F.col("text"))), epoch)
    return store


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"word{rng.randrange(140)}" for _ in range(1 + i % 12))) for i in range(25)]
    rows += [(100, '"word118 word119"'), (101, "nowhere"), (102, '"word110" word3'), (103, "")]
    return parse_queries(spark.createDataFrame(rows, "query_id int, query string"))


def shown(rows):
    return sorted((r.query_id, r.position, r.url, f"{r.score:.8e}") for r in rows.collect())


@pytest.mark.parametrize("k", [1, 7, 50])
def test_top_results_are_those_of_all_scores(store, queries, k):
    index = store.load()
    plain = replace(index, bounds=None, dead=None)
    assert shown(scoring.top_results(index, queries, k)) == shown(scoring.top_results(plain, queries, k))


def test_counts_without_scores(store, queries):
    index = store.load()
    counts = {r.query_id: r.total for r in scoring.hit_counts(index, queries).collect()}
    plain = {r.query_id: r.total for r in scoring.hit_counts(replace(index, bounds=None), queries).collect()}
    assert counts == plain and counts[101] == 0 and counts[100] > 0


def test_few_pages_are_scored(store, queries):
    index = store.load()
    found = scoring.matches(index, queries.where("size(phrases) = 0"))
    hits = found.blocks.agg(F.sum("hits")).first()[0]
    assert scoring.contenders(index, found, 5).count() < hits / 10


def test_bounds_hold(store, queries):
    """Every page's score is within the bound of its place in its block."""
    index = store.load()
    found = scoring.matches(index, queries.where("size(phrases) = 0"))
    places = store._documents(store.batches()).select("url", "block", "slot")
    rows = scoring.scores(index, queries, found).join(places, "url").join(found.blocks, ["query_id", "block"])
    checked = rows.select(
        (F.col("score") <= F.get("bounds", F.col("slot")) * (1 + scoring.MARGIN)).alias("holds"),
        (F.getbit("pages", F.col("slot")) == 1).alias("named"),
    ).groupBy("holds", "named").count().collect()
    assert [(r.holds, r.named) for r in checked] == [(True, True)]
    assert found.blocks.agg(F.sum("hits")).first()[0] == scoring.scores(
        index, queries.where("size(phrases) = 0"), found
    ).count()


def test_blocks_are_numbered_within_batches(store):
    places = store._documents(store.batches()).select("batch", "block", "slot", "document_size")
    assert places.select("block", "slot").distinct().count() == places.count()
    tops = places.groupBy("batch").agg(F.min("block").alias("low"), F.max("block").alias("high")).orderBy("batch").collect()
    assert tops[0].high < tops[1].low and places.agg(F.max("slot")).first()[0] < 1 << blocks.SLOT_BITS


def test_json_counts_and_results_agree(store, queries):
    lines = search_json(store.load(), queries, 10).collect()
    heads = {r.query_id: r.json for r in lines if r.position == 0}
    assert len(heads) == queries.count() and "No results found" in heads[101] and "No results found" in heads[103]
    assert max(r.position for r in lines) == 10


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def _counts(rows):
    return sorted((r.query_id, r.total) for r in rows.collect())


def test_counting_hits_makes_no_bounds_and_moves_blocks_once(store, queries, monkeypatch):
    index = store.load()
    expected = _counts(scoring.hit_counts(replace(index, bounds=None, dead=None), queries))
    known = written(scoring.known_terms(index, queries), "terms")
    for rows in (scoring.block_hits(index, known), scoring.query_blocks(index, known)):
        assert "hashpartitioning(block" in _plan(rows) and "hashpartitioning(query_id" not in _plan(rows)
    monkeypatch.setattr(scoring, "query_blocks", None)
    assert _counts(scoring.hit_counts(index, queries)) == expected


def test_large_tables_are_not_sent_whole(store, queries, monkeypatch):
    index = store.load()
    index = replace(index, replaced=None, postings=index.all_postings.drop("batch"))
    known = written(scoring.known_terms(index, queries), "terms")
    expected = shown(scoring.top_results(store.load(), queries, 7))
    assert "BroadcastHashJoin" in _plan(scoring.on_postings(index, known, ["word_bucket", "word"]))
    monkeypatch.setattr(session, "SENT_ROWS", 0)
    assert "BroadcastHashJoin" not in _plan(scoring.on_postings(index, known, ["word_bucket", "word"]))
    assert shown(scoring.top_results(store.load(), queries, 7)) == expected
