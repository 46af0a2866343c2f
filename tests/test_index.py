from pyspark.sql import functions as F

from conftest import page
from trawl import analyse, html_pages, index_of, page_fields, plain_fields


def short(url):
    return url.rsplit("/", 1)[1]


def test_documents(index):
    got = {
        short(r.url): (r.title, r.document_size, r.max_tf, r.modified)
        for r in index.documents.collect()
    }
    assert got == {
        "a": ("Tart pie", 7, 3, None),
        "b": ("Apples", 4, 2, None),
        "c.html": ("Shop", 3, 1, None),
        "d": ("Rain", 3, 3, None),
    }


def test_postings_and_positions(index):
    got = {
        (short(r.url), r.word): (r.term_frequency, r.in_title, r.positions)
        for r in index.postings.collect()
    }
    assert got == {
        ("a", "tart"): (3, True, [0, 2, 3]),
        ("a", "pie"): (2, True, [1, 4]),
        ("a", "shop"): (1, False, [5]),
        ("b", "appl"): (2, False, [0, 1]),
        ("b", "pie"): (1, False, [2]),
        ("c.html", "shop"): (1, True, [0]),
        ("c.html", "pie"): (1, False, [1]),
        ("d", "rain"): (3, True, [0, 1, 2]),
    }
    assert index.positions.count() == 14


def test_keywords(index):
    got = {r.word: r.document_frequency for r in index.keywords.collect()}
    assert got == {"pie": 3, "shop": 2, "tart": 1, "appl": 1, "rain": 1}


def test_links(index):
    got = sorted((short(r.parent_url), short(r.child_url)) for r in index.links.collect())
    assert got == [("a", "a"), ("a", "b"), ("a", "c.html"), ("b", "a")]


def test_title_match_by_stem(pages):
    index = index_of(analyse(page_fields(html_pages(pages)), title_match="stem"))
    row = index.postings.where("word = 'appl'").first()
    assert row.in_title and row.term_frequency == 2


def test_properties_on_driver_pages(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = analyse(page_fields(html_pages(raw)))
    checks = rows.select(
        (F.aggregate("terms.term_frequency", F.lit(0), lambda a, x: a + x)).alias("tf"),
        F.array_sort(F.flatten("terms.positions")).alias("positions"),
        F.size("terms").alias("n_terms"),
        F.size(F.array_distinct("terms.word")).alias("n_words"),
        "max_tf",
        F.array_max("terms.term_frequency").alias("top"),
    ).collect()
    assert len(checks) == raw.count()
    for row in checks:
        assert row.positions == list(range(row.tf))
        assert row.n_terms == row.n_words
        assert row.max_tf == row.top


def test_empty_page_has_max_tf_one(spark):
    rows = spark.createDataFrame([("u", page("", "the of"))], "url string, html string")
    row = analyse(page_fields(html_pages(rows))).first()
    assert (row.max_tf, row.document_size, row.terms) == (1, 2, [])


def test_failed_fetch_is_dropped(spark):
    rows = spark.createDataFrame([("u", None), ("v", page("t", "x"))], "url string, html string")
    assert [r.url for r in html_pages(rows).collect()] == ["v"]


def test_custom_stopwords_and_plain_text(spark):
    texts = spark.createDataFrame([(1, "the Cats sat"), (2, None)], "id int, body string")
    fields = plain_fields(texts, F.col("id").cast("string"), F.col("body"))
    (row,) = analyse(fields, stopwords={"sat"}).collect()
    assert [t.word for t in row.terms] == ["cat", "the"]


def test_no_keyed_shuffle_and_no_python_before_the_vocabulary(pages):
    index = index_of(analyse(page_fields(html_pages(pages))))
    for table in (index.documents, index.postings, index.links, index.positions):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan
        assert "Python" not in plan
