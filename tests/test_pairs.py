"""Phrases by pairs of neighbouring frequent words: the same hits from fewer postings."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trawl import IndexStore, analyse, parse_queries, plain_fields
from trawl.operators import matching
from trawl.session import new_folder
from trawl.sources import store as stores

FREQUENT = [f"word{i}" for i in range(30, 40)]


@pytest.fixture(scope="module")
def pages():
    """First texts of 200 pages, and new ones for a third of them."""
    rng = random.Random(3)
    words = [f"word{i}" for i in range(40)]
    weights = [1] * 30 + [12] * 10

    def text():
        return rng.choices(words, weights, k=rng.choice([0, 1, 2, 20, 90]))

    return [{i: text() for i in ids} for ids in (range(200), range(0, 220, 3))]


@pytest.fixture(scope="module")
def index(spark, pages):
    store = IndexStore(spark, new_folder(spark, "pairs"), buckets=3)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(stores, "FREQUENT_WORDS", 10)
        empty = spark.createDataFrame([], "name string, text string")
        store.append(analyse(plain_fields(empty, F.col("name"), F.col("text"))), 0)
        for epoch, texts in enumerate(pages, 1):
            rows = [(f"doc:{i}", " ".join(words)) for i, words in texts.items()]
            table = spark.createDataFrame(rows, "name string, text string")
            store.append(analyse(plain_fields(table, F.col("name"), F.col("text"))), epoch)
    return store.load()


@pytest.fixture(scope="module")
def phrases():
    rng = random.Random(5)
    rare = [f"word{i}" for i in range(30)]
    chosen = [[rng.choice(FREQUENT if rng.random() < 0.8 else rare) for _ in range(1 + i % 5)] for i in range(60)]
    return [*chosen, ["word31"] * 3, ["word31", "unknown", "word32"]]


@pytest.fixture(scope="module")
def queries(spark, phrases):
    rows = [(i, f'"{" ".join(words)}"') for i, words in enumerate(phrases)]
    return parse_queries(spark.createDataFrame(rows, "query_id int, query string"))


def hits(index, queries):
    return sorted((r.query_id, r.url) for r in matching.phrase_hits(index, queries).collect())


def test_hits_by_brute_force(index, queries, pages, phrases):
    assert list(index.frequent) == sorted(FREQUENT)
    texts = {**pages[0], **pages[1]}
    expected = []
    for i, phrase in enumerate(phrases):
        known = [w for w in phrase if w != "unknown"]
        for page, words in texts.items():
            if any(words[at : at + len(known)] == known for at in range(len(words))):
                expected.append((i, f"doc:{page}"))
    assert hits(index, queries) == sorted(expected) and len(expected) > 500
    assert hits(replace(index, pairs=None, frequent=()), queries) == sorted(expected)


def test_two_frequent_words_are_one_key(index, queries, phrases):
    units = matching.phrase_units(index, matching.known_phrase_words(index, queries)).collect()
    for i, phrase in enumerate(phrases):
        own = sorted((u.offset, u.word) for u in units if u.query_id == i)
        known = [w for w in phrase if w != "unknown"]
        covered = {at + k for at, word in own for k in range(len(word.split()))}
        assert covered == set(range(len(known)))
        assert all(word.split() == known[at : at + len(word.split())] for at, word in own)
        if all(w in FREQUENT for w in known):
            assert len(own) == (len(known) + 1) // 2
        assert sum(u.is_rarest for u in units if u.query_id == i) == 1
        assert {u.n_words for u in units if u.query_id == i} == {len(own)}


def test_pairs_of_replaced_pages_are_kept_apart(index):
    pairs = index.pairs.groupBy("batch").count().collect()
    assert {r.batch for r in pairs} == {1, 2}
    assert index.pairs.where("size(split(word, ' ')) <> 2").count() == 0
