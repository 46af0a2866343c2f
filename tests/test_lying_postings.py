"""Postings of a large batch are written by the tasks that read its pages, and are the same."""

from pyspark.sql import functions as F

from trawl import IndexStore, analyse, parse_queries, plain_fields
from trawl.operators import scoring
from trawl.session import new_folder
from trawl.sources import store as stores

TABLES = {
    "postings": stores.POSTINGS, "bounds": stores.BOUNDS, "pairs": stores.PAIRS, "keywords": stores.KEYWORDS,
}


def test_postings_of_large_batches_do_not_move(spark, monkeypatch):
    texts = [(f"doc:{i}", f"tart pie {'shop ' * (i % 4)} word{i % 9} pie") for i in range(150)]
    table = spark.createDataFrame(texts, "name string, text string").repartition(3, "name")
    analysed = analyse(plain_fields(table, F.col("name"), F.col("text"))).cache()
    plans, write = {}, IndexStore._write_bucketed

    def recorded(self, rows, name, *args, **more):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        plans[name, "moves"] = more.get("move", True)
        write(self, rows, name, *args, **more)

    def built(limit):
        monkeypatch.setattr(stores, "MOVED_PAGES", limit)
        store = IndexStore(spark, new_folder(spark, f"lying-{limit}"), buckets=2)
        store.append(analysed, 0)
        return store

    moved = built(1_000)
    monkeypatch.setattr(IndexStore, "_write_bucketed", recorded)
    lying = built(0)
    for name in ("postings", "pairs"):
        assert "Exchange" not in plans[name] and not plans[name, "moves"]

    def words(store, name):
        rows = store._read(name, TABLES[name], [0])
        kept = [c for c in rows.columns if c not in ("block", "slot", "pages")]
        return sorted(map(str, rows.select(*kept).collect()))

    for name in ("postings", "pairs", "keywords"):
        assert words(lying, name) == words(moved, name)
    queries = parse_queries(spark.createDataFrame([(1, '"tart pie" shop'), (2, "word3")], "query_id int, query string"))

    def shown(store):
        return sorted((r.query_id, r.url, f"{r.score:.9e}") for r in scoring.top_results(store.load(), queries).collect())

    assert shown(lying) == shown(moved)


def test_frequencies_of_a_first_batch_are_summed_once(spark, monkeypatch):
    calls, held = [], IndexStore._held
    monkeypatch.setattr(IndexStore, "_held", lambda self, batch: calls.append(batch) or held(self, batch))
    table = spark.createDataFrame([("a", "tart pie pie"), ("b", "pie")], "name string, text string")
    store = IndexStore(spark, new_folder(spark, "once"), buckets=2)
    store.append(analyse(plain_fields(table, F.col("name"), F.col("text"))), 0)
    assert calls == [0]
    assert {r.word: r.document_frequency for r in store.load().keywords.collect()} == {"tart": 1, "pie": 2}
    assert store._frequent() == ("pie", "tart")
