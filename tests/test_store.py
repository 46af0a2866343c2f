import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import PAGES, link, page
from trawl import IndexStore, analyse, html_pages, index_batch, index_of, index_report, index_stream
from trawl import latest_pages, page_fields, parse_queries, read_stopwords
from trawl.operators.matching import known_terms, postings_for
from trawl.operators.scoring import scores
from trawl.sources.pages import one_per_url
from trawl.session import new_folder, scratch, shared_dir, written
from trawl.sources.store import next_merge

SEEN = '<p class="right">Last updated on 2015-03-07</p>'
CHANGED = [
    ("http://h.test/b", page("Plums", "plum tart pie" + link("/d"))),
    ("http://h.test/e", page("Extra", "rain tart")),
]


def tables(index):
    postings = {
        (r.word, r.url): (r.term_frequency, r.in_title, tuple(r.positions))
        for r in index.postings.collect()
    }
    keywords = {r.word: r.document_frequency for r in index.keywords.collect()}
    links = {(r.parent_url, r.child_url) for r in index.links.collect()}
    documents = {r.url: (r.title, r.document_size, r.max_tf) for r in index.documents.collect()}
    return postings, keywords, links, documents, index.corpus.first()[0]


@pytest.fixture(scope="module")
def changed(spark):
    return spark.createDataFrame(CHANGED, "url string, html string")


@pytest.fixture(scope="module")
def expected(spark):
    """A fresh index of the newest pages."""
    newest = dict(PAGES) | dict(CHANGED)
    rows = spark.createDataFrame(list(newest.items()), "url string, html string")
    return tables(index_of(analyse(page_fields(html_pages(rows)))))


def test_batches_equal_a_rebuild(spark, pages, changed, expected):
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    index_batch(store, pages, 0)
    index_batch(store, changed, 1)
    assert tables(store.load()) == expected
    # a batch that comes again, and one that changes nothing
    index_batch(store, changed, 1)
    index_batch(store, changed, 2)
    assert tables(store.load()) == expected
    assert store.forward().count() == 5
    compact = IndexStore(spark, new_folder(spark, "compact"), buckets=2)
    compact.append(store.forward(), 0)
    assert tables(compact.load()) == expected
    seen = [set(s.load().documents.select("url", "fetched").collect()) for s in (store, compact)]
    assert seen[0] == seen[1]


def test_failed_batch_is_invisible_and_can_be_repeated(spark, pages, changed, expected, monkeypatch):
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    index_batch(store, pages, 0)
    before = tables(store.load())
    write = IndexStore._write

    def fail_at_commit(self, rows, table, batch):
        if table == "batches":
            raise RuntimeError("lost")
        write(self, rows, table, batch)

    monkeypatch.setattr(IndexStore, "_write", fail_at_commit)
    with pytest.raises(RuntimeError):
        index_batch(store, changed, 1)
    monkeypatch.setattr(IndexStore, "_write", write)
    assert tables(store.load()) == before
    index_batch(store, changed, 1)
    assert tables(store.load()) == expected


def test_modified_and_fetched_survive(spark):
    def batch(body):
        rows = [("http://h.test/a", page("A", body))]
        return spark.createDataFrame(rows, "url string, html string")

    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    index_batch(store, batch(SEEN), 0)
    first = store.load().documents.first()
    index_batch(store, batch("no date now"), 1)
    second = store.load().documents.first()
    assert str(first.modified) == "2015-03-07 00:00:00"
    assert (second.modified, second.fetched) == (first.modified, first.fetched)
    assert second.document_size == 4


def test_newest_version_wins(spark):
    rows = [("u", "old", 1), ("u", "new", 3), ("u", "mid", 2), ("v", "x", 1)]
    table = spark.createDataFrame(rows, "url string, html string, version int")
    newest = latest_pages(table, F.desc("version"))
    assert {(r.url, r.html) for r in newest.collect()} == {("u", "new"), ("v", "x")}
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_stream_equals_batches(spark, pages, changed, expected, tmp_path):
    source = str(tmp_path / "in")
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    checkpoint = new_folder(spark, "checkpoint")

    def drain():
        index_stream(spark, source, store, checkpoint, files_per_batch=1).awaitTermination()

    pages.coalesce(1).write.parquet(source)
    drain()
    assert len(store.batches()) == 1
    changed.coalesce(1).write.mode("append").parquet(source)
    drain()
    drain()
    assert len(store.batches()) == 2
    assert tables(store.load()) == expected


def test_report(spark, analysed):
    blocks = {r.url: r.report for r in index_report(analysed).collect()}
    assert blocks["http://h.test/a"].split("\n") == [
        "Tart pie", "http://h.test/a", "None , 7", "tart 3 ; pie 2 ; shop 1 ;",
        "Child http://h.test/b", "Child http://h.test/a", "Child http://h.test/c.html", "-" * 91,
    ]


def test_read_stopwords(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("# note\nthe\n of \nthe\n")
    assert read_stopwords(spark, str(path)) == {"the", "of"}


def page_rows(spark, *rows):
    return spark.createDataFrame([(u, page(u, b)) for u, b in rows], "url string, html string")


def test_every_writer_keeps_its_own_epochs(spark, tmp_path):
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    index_batch(store, page_rows(spark, ("http://h.test/a", "one")), 0)
    for name in ("b", "c"):
        source = str(tmp_path / name)
        page_rows(spark, (f"http://h.test/{name}", "two")).write.parquet(source)
        for checkpoint in (new_folder(spark, "checkpoint"),) * 2:
            index_stream(spark, source, store, checkpoint).awaitTermination()
    assert {r.url[-1] for r in store.load().documents.collect()} == {"a", "b", "c"}
    assert len(store.batches()) == 3
    # the same files under a new checkpoint come again and replace themselves
    index_stream(spark, source, store, new_folder(spark, "checkpoint")).awaitTermination()
    assert len(store.batches()) == 4 and store.load().corpus.first()[0] == 3


def test_a_lower_epoch_that_comes_later_replaces(spark):
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    index_batch(store, page_rows(spark, ("http://h.test/a", "apple")), 5)
    index_batch(store, page_rows(spark, ("http://h.test/a", "plum")), 3)
    index = store.load()
    assert index.corpus.first()[0] == 1 and index.documents.count() == 1
    assert "plum" in {r.word for r in index.keywords.collect()}


def test_buckets_belong_to_the_store(spark):
    root = new_folder(spark, "store")
    index_batch(IndexStore(spark, root, buckets=4), page_rows(spark, ("http://h.test/a", "one")), 0)
    assert IndexStore(spark, root).buckets == 4
    with pytest.raises(ValueError):
        IndexStore(spark, root, buckets=8)


def test_the_later_file_wins_whatever_the_micro_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    for body in ("zebra", "apple"):
        rows = page_rows(spark, ("http://h.test/a", body)).coalesce(1)
        rows.write.mode("append").parquet(source)
        time.sleep(0.05)
    for files in (1, 1000):
        store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
        stream = index_stream(
            spark, source, store, new_folder(spark, "checkpoint"), files_per_batch=files
        )
        stream.awaitTermination()
        words = {r.word for r in store.load().keywords.collect()}
        assert "appl" in words and "zebra" not in words


def test_repeated_urls_need_a_version(spark):
    rows = spark.createDataFrame(
        [("u", "old", 1), ("u", "new", 2), ("v", "x", 1)], "url string, html string, version int"
    )
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    with pytest.raises(ValueError):
        index_batch(store, rows, 0)
    index_batch(store, rows, 0, version="version")
    assert store.load().documents.count() == 2


def test_html_of_unique_urls_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "pages")
    page_rows(spark, ("http://h.test/a", "one"), ("http://h.test/b", "two")).write.parquet(path)
    pages = spark.read.parquet(path)
    plan = one_per_url(pages, F.desc("html"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_staging_and_scratch_leave_nothing(spark, pages, changed):
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    index_batch(store, pages, 0)
    index_batch(store, changed, 1)
    assert not os.listdir(os.path.join(store.root, "staging"))
    before = set(os.listdir(shared_dir(spark)))
    with scratch(spark):
        assert written(changed, "some").count() == 2
        assert set(os.listdir(shared_dir(spark))) > before
    assert set(os.listdir(shared_dir(spark))) == before


def test_size_header_and_text_after_the_body(spark):
    rows = [
        ("http://h.test/a", "<body>inside</body>after</html>", "2147483648"),
        ("http://h.test/b", "<body>b</body>", "12x"),
    ]
    table = spark.createDataFrame(rows, "url string, html string, size string")
    found = {r.url[-1]: r for r in page_fields(html_pages(table)).collect()}
    assert found["a"].document_chars == 2147483648 and found["b"].document_chars == 14
    assert found["a"].body_text.split() == ["inside", "after"]


def test_search_after_a_recrawl(spark, pages, changed, expected):
    store = IndexStore(spark, new_folder(spark, "store"), buckets=2)
    index_batch(store, pages, 0)
    index_batch(store, changed, 1)
    newest = dict(PAGES) | dict(CHANGED)
    rows = spark.createDataFrame(list(newest.items()), "url string, html string")
    rebuilt = index_of(analyse(page_fields(html_pages(rows))))
    queries = spark.createDataFrame(
        [(1, "tart pie plum"), (2, '"tart pie" shop'), (3, '"pie shop"'), (4, "apple")],
        "query_id int, query string",
    )
    parsed = parse_queries(queries)
    found = [
        sorted((r.query_id, r.url, round(r.score, 9)) for r in scores(index, parsed).collect())
        for index in (store.load(), rebuilt)
    ]
    assert found[0] == found[1] and found[0]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = postings_for(store.load(), known_terms(store.load(), parsed))
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" not in plan and plan.index("LeftOuter") < plan.index("Join Inner")


def test_batches_are_merged_by_size():
    sizes, written_pages, most = {}, 0, 0
    for n in range(50):
        sizes[1000 * n] = 100
        while group := next_merge(sizes):
            merged = sum(sizes.pop(batch) for batch in group)
            sizes[group[-1] + 1] = merged
            written_pages += merged
        most = max(most, len(sizes))
    assert sum(sizes.values()) == 5000 and most <= 8
    assert written_pages <= 3 * 5000
    assert next_merge({}) == [] and next_merge({0: 0, 1: 0, 2: 1}) == []
    assert next_merge({3: 0, 1: 0, 2: 1, 5: 0, 9: 0}) == [1, 2, 3, 5]


def test_merged_batches_equal_a_rebuild(spark, pages, changed, expected):
    root = new_folder(spark, "merged")
    store = IndexStore(spark, root, buckets=2)
    index_batch(store, pages.where("url < 'http://h.test/c'"), 0)
    index_batch(store, pages.where("url >= 'http://h.test/c'"), 1)
    index_batch(store, changed, 2)
    loaded = store.load()
    assert store.compact(fanout=2) == 1
    assert [row.batch for row in store.batches()] == [2, 3]
    assert tables(loaded) == expected and tables(store.load()) == expected
    # the version that batch 2 replaced is gone from the merged batch
    assert store._read("documents", "url string", [3]).count() == 3
    # an epoch that was merged comes again
    index_batch(store, changed, 1)
    assert len(store.batches()) == 2
    # a batch that replaces pages of both, merged with the smaller one
    index_batch(store, pages, 5)
    store._merge([2, 4])
    assert [row.batch for row in store.batches()] == [3, 5]
    newest = spark.createDataFrame(CHANGED[1:] + PAGES, "url string, html string")
    again = tables(index_of(analyse(page_fields(html_pages(newest)))))
    assert tables(store.load()) == again
    assert store.compact(fanout=2) in (0, 1)
    store.remove_merged()
    assert tables(IndexStore(spark, root).load()) == again
