import json

import pytest
from pyspark.sql import functions as F

from trawl import parse_queries, search, search_json
from trawl.operators.matching import known_phrase_words, known_terms
from trawl.operators.scoring import all_results, hit_counts, significant, top_results

SEARCHES = {
    "tart shop": [("c.html", 166.666667), ("a", 142.880952)],
    "tart Tart zzz shop": [("c.html", 166.666667), ("a", 142.880952)],
    '"shop pie"': [("c.html", 166.735840)],
    '"tart the pie"': [("a", 162.620833)],
    '"tart zzz pie"': [("a", 162.620833)],
    '"zzz" tart': [],
    '"tart pie" "pie shop"': [("a", 108.429762)],
    '"tart shop"': [],
    '"tart tart"': [("a", 285.714286)],
    "the of": [],
    "zzz": [],
    "": [],
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, query) for i, query in enumerate(SEARCHES)]
    return parse_queries(spark.createDataFrame(rows, "query_id int, query string"))


def one(spark, query):
    return parse_queries(spark.createDataFrame([(0, query)], "query_id int, query string"))


def test_expected_searches(index, parsed):
    got = {i: [] for i in range(len(SEARCHES))}
    for r in top_results(index, parsed).orderBy("query_id", "position").collect():
        got[r.query_id].append((r.url.rsplit("/", 1)[1], round(r.score, 6)))
    assert got == {i: hits for i, hits in enumerate(SEARCHES.values())}


def test_top_is_prefix_of_all(index, parsed):
    full = {}
    for r in all_results(index, parsed).collect():
        full.setdefault(r.query_id, []).append(r.url)
    for k in (1, 2):
        top = {}
        for r in top_results(index, parsed, k).orderBy("query_id", "position").collect():
            top.setdefault(r.query_id, []).append(r.url)
        assert top == {q: urls[:k] for q, urls in full.items()}


def test_parse(spark):
    row = one(spark, 'The Apples -x "Tart of pies" "" "the" apple').first()
    assert row.terms == ["appl", "-x", "tart", "pi"]
    assert row.phrases == [["tart", "pi"]]


def test_unbalanced_quotes(spark):
    assert one(spark, 'a" tart "pie "rain').first().phrases == [["tart"]]


def test_known_terms_and_phrase_offsets(spark, index):
    rows = one(spark, '"tart zzz pie" tart')
    known = {r.word: r.document_frequency for r in known_terms(index, rows).collect()}
    assert known == {"tart": 1, "pie": 3}
    offsets = {r.word: (r.offset, r.n_words) for r in known_phrase_words(index, rows).collect()}
    assert offsets == {"tart": (0, 2), "pie": (1, 2)}


def test_hit_counts(index, parsed):
    got = {r.query: r.total_results for r in hit_counts(index, parsed, k=1).collect()}
    assert got["tart shop"] == "2 (1 shown)"
    assert got['"shop pie"'] == "1"
    assert got["zzz"] == "0"


def test_result_details(spark, index):
    first, second = search(index, one(spark, "tart shop")).orderBy("position").collect()
    assert first.keywords == {"shop": 1}
    assert second.keywords == {"tart": 3, "shop": 1}
    assert second.parents == ["http://h.test/a", "http://h.test/b"]
    assert second.children == ["http://h.test/b", "http://h.test/c.html"]
    assert first.parents == ["http://h.test/a"] and first.children == []
    assert (second.title, second.size, second.modified) == ("Tart pie", 7, None)


def test_many_parents_continue_in_further_rows(spark, index):
    rows = search(index, one(spark, "tart"), per_part=1).collect()
    assert {r.url for r in rows} == {"http://h.test/a"}
    assert sorted(p for r in rows for p in r.parents) == ["http://h.test/a", "http://h.test/b"]
    assert sum(len(r.children) for r in rows if r.part == 0) in (0, 2)
    assert {r.parts for r in rows} == {2}


def test_json(index, parsed):
    lines = {}
    for r in search_json(index, parsed).orderBy("query_id", "position", "part").collect():
        lines.setdefault(r.query_id, []).append(json.loads(json.loads(r.json)["result"]))
    queries = list(SEARCHES)
    assert lines[queries.index("zzz")] == [{"error": "No results found for: zzz"}]
    stats, best, _ = lines[queries.index("tart shop")]
    assert stats == {"total_results": "2"}
    assert best == {
        "total_results": "2", "url": "http://h.test/c.html", "rank": pytest.approx(166.666667),
        "title": "Shop", "modified": None, "size": 3, "keywords": {"shop": 1},
        "parents": ["http://h.test/a"], "children": [],
    }


def test_word_in_every_document_scores_zero_but_hits(spark):
    from trawl import analyse, index_of, plain_fields

    texts = spark.createDataFrame([("1", "cat dog"), ("2", "cat")], "id string, body string")
    index = index_of(analyse(plain_fields(texts, F.col("id"), F.col("body"))))
    rows = top_results(index, one(spark, "cat")).collect()
    assert [(r.score, r.url) for r in sorted(rows, key=lambda r: r.position)] == [
        (0.0, "1"), (0.0, "2"),
    ]


def test_plans_have_no_nested_loops_or_python(index, parsed):
    top = top_results(index, parsed)
    for frame in (top, search(index, parsed), hit_counts(index, parsed)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "Python" not in plan
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_small_scores_are_ranked_by_their_digits(spark):
    values = [2.6e-10, 1.3e-10, 1.3000000001e-10, 0.0, 9.9999999999e-5, 1e-4]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, score double")
    order = [r.i for r in rows.orderBy(significant(F.col("score")).desc(), "i").collect()]
    assert order == [4, 5, 0, 1, 2, 3]
