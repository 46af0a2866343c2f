import duckdb
import pytest

import __spark_entry__ as entry
import trawl_oracle
from conftest import link, page

SF = "/root/testdata/sf0.001"
CHECKED = (
    "page_tokens", "documents_table", "position_lists", "resolved_links", "parsed_queries",
    "term_weights", "search_multi_phrase", "crawl_order",
)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(v[i]) for i in order) for v in values)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in ("pages", "documents", "benchmark", "orders", "lineitem"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_a_check():
    assert set(trawl_oracle.oracle_sql()) == set(entry._QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_against_sql(spark, db, name):
    frame = entry.queries()[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    expected = rows([d[0] for d in cursor.description], cursor.fetchall())
    assert rows(frame.columns, frame.collect()) == expected


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "rank" in frame.columns


@pytest.mark.parametrize("name", ("incremental_index", "incremental_links", "compacted_index"))
def test_of_a_url_that_comes_twice_the_later_page_is_indexed(spark, tmp_path, name):
    french = page("Quai", "quai <nav>" + link("/x") + "</nav>" + link("/y")).replace(
        "<html>", '<html lang="fr">'
    )
    pages = [
        (2, "http://h.test/a", page("Plum", "plum" + link("/b"))),
        (1, "http://h.test/a", page("Tart", "tart" + link("/c"))),
        (3, "http://h.test/f", page("Pie", "pie" + link("/z"))),
        (4, "http://h.test/f", french),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    found = entry.queries()[name](spark, str(tmp_path)).collect()
    if name == "incremental_links":
        assert {(r.parent_url[-1], r.child_url[-1]) for r in found} == {("a", "b"), ("f", "y")}
    else:
        assert {(r.word, r.url[-1], r.document_frequency) for r in found} == {
            ("plum", "a", 1), ("quai", "f", 1)
        }


def test_results_show_a_url_that_comes_twice_once(spark, tmp_path):
    pages = [
        (1, "http://h.test/a", page("Tart", "tart pie")),
        (2, "http://h.test/a", page("Tart", "tart plum")),
        (3, "http://h.test/b", page("Rain", "rain")),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    for name in ("search_results", "search_json"):
        found = entry.queries()[name](spark, str(tmp_path)).where("position > 0").collect()
        assert sorted((r.query_id, r.url[-1], r.keywords) for r in found) == [
            (1, "a", "tart:2"), (2, "a", "tart:2"), (3, "b", "rain:2")
        ]


def test_a_word_is_weighed_once_however_many_queries_ask(spark, tmp_path, monkeypatch):
    pages = [(n, f"http://h.test/{n}", page("Tart", f"pie {n}")) for n in range(6)]
    pages.append((6, "http://h.test/6", page("Rain", "rain")))
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    weighed = []

    def spy(*args, of=entry.scoring.term_weights):
        weighed.append(of(*args))
        return weighed[-1]

    monkeypatch.setattr(entry.scoring, "term_weights", spy)
    found = entry.queries()["term_weights"](spark, str(tmp_path)).collect()
    assert [(r.query_id, r.word, r.pages) for r in sorted(found)] == [
        *((n, "tart", 6) for n in range(6)), (6, "rain", 1)
    ]
    assert weighed[0].count() == 7
