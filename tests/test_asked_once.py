"""What moves and what is computed does not grow with repeated queries or with the input of a task."""

import pytest
from pyspark.sql import functions as F

from trawl import IndexStore, analyse, index_stream, parse_queries, plain_fields
from trawl import session
from trawl.operators import matching, scoring
from trawl.session import dealt, new_folder, written

TEXTS = ["red apple pie", "red apple tart", "green apple", "red wine and apple pie", "plum"]


@pytest.fixture(scope="module")
def store(spark):
    texts = spark.createDataFrame(enumerate(TEXTS), "id int, text string")
    url = F.concat(F.lit("http://h.test/"), F.col("id").cast("string"))
    store = IndexStore(spark, new_folder(spark, "asked"), buckets=4)
    store.append(analyse(plain_fields(texts, url, F.col("text"))), 0)
    return store


def queries(spark, rows):
    return parse_queries(spark.createDataFrame(rows, "query_id int, query string"))


def pages_of(hits):
    found = {}
    for row in hits.collect():
        found.setdefault(row.query_id, set()).add(int(row.url.rsplit("/", 1)[1]))
    return found


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_words_select_postings_before_they_move(spark, store):
    index, parsed = store.load(), queries(spark, [(1, "plum")])
    known = written(matching.known_terms(index, parsed), "terms")
    wanted = known.withColumn("url", F.lit("http://h.test/4"))
    keys = ["word_bucket", "word", "url"]
    found = matching.on_postings(index, wanted, keys, known)
    assert "LeftSemi" in plan_of(found)
    assert [row.word for row in found.collect()] == [row.word for row in known.collect()]


def test_sums_find_their_rows_where_pages_were_dealt(spark, store):
    plan = plan_of(scoring.scores(store.load(), queries(spark, [(1, "red apple"), (2, "pie")])))
    assert "hashpartitioning(url" in plan
    assert "hashpartitioning(query_id" not in plan


def test_equal_queries_are_answered_once(spark, store, monkeypatch):
    asked = []
    known_terms = scoring.known_terms

    def counted(index, parsed):
        asked.append(parsed.count())
        return known_terms(index, parsed)

    monkeypatch.setattr(scoring, "known_terms", counted)
    rows = [(n, '"red apple" pie') for n in range(20)] + [(20, "plum"), (21, None)]
    found = pages_of(scoring.scores(store.load(), queries(spark, rows)))
    assert found == {**{n: {0, 1} for n in range(20)}, 20: {4}}
    assert asked == [3]


def test_phrases_are_looked_up_once_and_all_of_them_needed(spark, store, monkeypatch):
    asked = []
    phrase_hits = matching.phrase_hits

    def counted(index, parsed):
        asked.append(parsed.count())
        return phrase_hits(index, parsed)

    monkeypatch.setattr(matching, "phrase_hits", counted)
    rows = [
        (0, '"red apple" "apple pie"'), (1, '"apple pie" "red apple" x'), (2, '"apple pie"'),
        (3, '"apple pie" "zq"'), (4, '"apple pie" "apple pie"'), (5, '"red apple" "apple tart" "red apple"'),
    ]
    found = pages_of(matching.pages_with_all_phrases(store.load(), queries(spark, rows)))
    assert found == {0: {0}, 1: {0}, 2: {0, 3}, 4: {0, 3}, 5: {1}}
    assert asked == [4]


def test_rows_of_one_query_id_stay_one_query(spark, store):
    rows = [(1, "red"), (1, "red"), (2, "red"), (None, "red"), (None, "plum")]
    hits = scoring.scores(store.load(), queries(spark, rows)).collect()
    found = {}
    for row in hits:
        found.setdefault(row.query_id, []).append(row.url)
    assert sorted(found[1]) == sorted(found[2]) and len(found[1]) == 3
    assert len(found[None]) == 4


def test_many_rows_are_dealt_over_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "DEALT_ROWS", 10)
    assert dealt(spark.range(100), 4).rdd.getNumPartitions() == 10
    assert dealt(spark.range(30), 4).rdd.getNumPartitions() == 4


def test_a_stream_deals_its_batches(spark):
    source = new_folder(spark, "few-files")
    html = F.concat(F.lit("<html><body>word"), F.col("id").cast("string"), F.lit("</body></html>"))
    pages = spark.range(60).select(
        F.concat(F.lit("http://h.test/"), F.col("id").cast("string")).alias("url"), html.alias("html")
    )
    pages.coalesce(1).write.parquet(source)
    store = IndexStore(spark, new_folder(spark, "dealt-stream"), buckets=4)
    index_stream(spark, source, store, new_folder(spark, "ck"), partitions=6).awaitTermination()
    blocks = store.load().blocks.select("block").distinct().count()
    assert store.load().documents.count() == 60 and blocks == 6


def test_frequencies_follow_from_the_bits_of_blocks(store):
    held = {r.word: r.n for r in store._held(0).groupBy("word").agg(F.sum("pages").alias("n")).collect()}
    index = store.load()
    postings = {r.word: r["count"] for r in index.postings.groupBy("word").count().collect()}
    assert held == postings == {r.word: r.document_frequency for r in index.keywords.collect()}


def test_urls_held_twice_and_uneven_rows_are_settled_by_count(spark):
    texts = spark.createDataFrame([(0, "plum"), (0, "plum"), (1, "plum"), (2, "plum pear")], "id int, text string")
    url = F.concat(F.lit("http://h.test/"), F.col("id").cast("string"))
    store = IndexStore(spark, new_folder(spark, "twice"), buckets=4)
    store.append(analyse(plain_fields(texts, url, F.col("text"))), 0)
    parsed = queries(spark, [(0, '"plum"'), (1, '"plum"'), (1, '"plum" "pear"')])
    found = pages_of(matching.pages_with_all_phrases(store.load(), parsed.where("query_id = 0")))
    assert found == {0: {1, 2}}
    assert 2 in pages_of(matching.pages_with_all_phrases(store.load(), parsed.where("query_id = 1")))[1]
