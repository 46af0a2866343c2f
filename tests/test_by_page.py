"""Short queries: pages are bounded by the words that matter, and blocks are not stored."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trawl import IndexStore, analyse, html_pages, page_fields, parse_queries, session
from trawl.operators import scoring
from trawl.session import new_folder
from conftest import page


def _html(rng, i):
    words = [f"w{n}x" for n in range(200)]
    title = " ".join(rng.choices(words[:60], k=3))
    return f"http://h.test/{i}", page(title, " ".join(rng.choices(words, k=rng.choice([5, 30, 60]))))


@pytest.fixture(scope="module")
def store(spark):
    """Pages with short titles; a second batch replaces a third of them."""
    rng = random.Random(3)
    store = IndexStore(spark, new_folder(spark, "by-page"), buckets=2)
    for epoch, ids in enumerate((range(400), range(0, 400, 3))):
        rows = spark.createDataFrame([_html(rng, i) for i in ids], "url string, html string")
        store.append(analyse(page_fields(html_pages(rows))), epoch)
    return store


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(80)}x" for _ in range(1 + i % 4))) for i in range(40)]
    rows += [(100, '"w1x w2x"'), (101, "nowhere"), (102, "w190x"), (103, "")]
    return parse_queries(spark.createDataFrame(rows, "query_id int, query string"))


def _shown(rows):
    return sorted((r.query_id, r.position, r.url, f"{r.score:.8e}") for r in rows.collect())


def test_results_are_those_of_all_scores_and_no_block_is_stored(store, queries, monkeypatch):
    index = store.load()
    expected = _shown(scoring.top_results(replace(index, bounds=None, dead=None), queries, 5))
    names = []

    def recorded(rows, name, write=scoring.written):
        names.append(name)
        return write(rows, name)

    monkeypatch.setattr(scoring, "written", recorded)
    assert _shown(scoring.top_results(index, queries, 5)) == expected
    assert "query-blocks" not in names and "reaching" in names


def test_slices_of_queries_give_the_same(store, queries, monkeypatch):
    index = store.load()
    plain = replace(index, bounds=None, dead=None)
    expected = _shown(scoring.top_results(plain, queries, 50))
    counts = {r.query_id: r.total for r in scoring.hit_counts(plain, queries).collect()}
    monkeypatch.setattr(session, "SENT_ROWS", 90)
    found = scoring.matches(index, queries)
    assert found.by_page
    assert _shown(scoring.top_results(index, queries, 50, found)) == expected
    assert {r.query_id: r.total for r in scoring.hit_counts(index, queries, found=found).collect()} == counts


def test_urls_held_twice_are_bounded_by_block(spark, queries):
    rng = random.Random(4)
    rows = spark.createDataFrame([_html(rng, i) for i in [*range(100), 7]], "url string, html string")
    twice = IndexStore(spark, new_folder(spark, "twice"), buckets=2)
    twice.append(analyse(page_fields(html_pages(rows))), 0)
    known = scoring.known_terms(twice.load(), queries).where(F.col("n_phrases") == 0)
    assert not scoring._is_sparse(twice.load(), known)
