"""One word on every page, one link target of every page, one query that hits all."""

import pytest
from pyspark.sql import functions as F

from trawl import IndexStore, analyse, parse_queries, plain_fields, search
from trawl.operators.scoring import hit_counts, top_results
from trawl.session import new_folder

N = 600


@pytest.fixture(scope="module")
def skewed(spark):
    texts = spark.range(N).select(
        F.concat(F.lit("http://h.test/"), F.col("id").cast("string")).alias("url"),
        F.concat(F.lit("hot cold word"), F.col("id").cast("string"), F.lit(" hot")).alias("text"),
    )
    fields = plain_fields(texts, F.col("url"), F.col("text")).withColumn(
        "children", F.array(F.lit("http://h.test/0"))
    )
    store = IndexStore(spark, new_folder(spark, "skew"), buckets=4)
    store.append(analyse(fields), 0)
    return store.load()


def test_hot_query_keeps_every_hit(spark, skewed):
    rows = [(0, '"hot cold"'), (1, "hot"), (2, '"hot cold word7"')]
    parsed = parse_queries(spark.createDataFrame(rows, "query_id int, query string"))
    totals = {r.query_id: r.total_results for r in hit_counts(skewed, parsed).collect()}
    assert totals == {0: f"{N} (50 shown)", 1: f"{N} (50 shown)", 2: "1"}
    assert top_results(skewed, parsed).groupBy("query_id").count().count() == 3


def test_popular_page_keeps_every_parent(spark, skewed):
    parsed = parse_queries(spark.createDataFrame([(0, "word0")], "query_id int, query string"))
    rows = search(skewed, parsed, per_part=50).collect()
    assert len(rows) > 5 and max(len(r.parents) for r in rows) < N / 2
    assert sum(len(r.parents) for r in rows) == N
    assert len({p for r in rows for p in r.parents}) == N


def test_query_words_prune_the_postings_folders(spark, skewed):
    from trawl.operators.scoring import term_weights

    parsed = parse_queries(spark.createDataFrame([(0, "word0")], "query_id int, query string"))
    plan = term_weights(skewed, parsed)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    scan = plan[plan.index("PushedFilters"):]
    assert "positions" not in scan[: scan.index("\n")]
