import pytest

LONG = "So many words of one long text, which never ends. " * 4000
# clashing names: columns that operators add or use inside
EXTRA = "size bigint, taken bigint, lang_pred string, score double, digest string, mix_taken int, n_lines int"

ROWS = [
    (1, "one two three four five six\nshared line\nseven", "en", "a"),
    (2, "one two three four five six\nshared line\nseven", "en", "b"),  # an exact copy
    (2, "one two three four five six\nshared line\nseven", "en", "b"),  # a repeated row
    (3, "", "en", "c"),
    (4, None, None, None),
    (5, " \n\t\n ", "fr", "d"),
    (6, LONG, "en", "a"),
    (7, LONG + "And a new end.", "en", None),
    (None, "no id but some words here to read", "en", "e"),
    (8, "1234 5678 !!", None, "f"),
    (9, "état où l’âme naïve\nshared line\n日本語の文章 👍", "fr", "g"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(*r, len(r[1] or ""), 1, 2, "x", 0.5, "y", 3, 4) for r in ROWS]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def documents(spark, rows):
    return spark.createDataFrame(
        [(*r, len(r[1])) for r in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
