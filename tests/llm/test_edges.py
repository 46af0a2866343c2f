"""Nulls, empty and very long texts, repeated rows, empty tables, clashing columns."""

from collections import defaultdict

import pytest

import corpus_pipeline
from trawl.llm import mixing
from trawl.llm.decontaminate import contaminations, decontaminated
from trawl.llm.fingerprints import edited_fingerprints, fingerprints
from trawl.llm.html_text import extract
from trawl.llm.language import accepted, identify
from trawl.llm.lines import without_spread_lines
from trawl.llm.mixing import mix, mixed_documents
from trawl.llm.near_dup import first_of_each_group, near_duplicates
from trawl.llm.pii import find_personal_data, redacted
from trawl.llm.substrings import repeated_passages, without_repeats
from trawl.llm.tokens import token_counts
from .conftest import LONG, ROWS, documents

IDS = [r[0] for r in ROWS]


def by_id(rows):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in rows)


ALL = sorted((i is None, i or 0) for i in IDS)


def tokens(docs):
    import public_tokenizers

    return token_counts(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "many words of one long text which never ends"), (2, None), (3, ""), (1, "x y")],
        "item_id bigint, text string",
    )


PER_ROW = (mix, near_duplicates, tokens, fingerprints, edited_fingerprints, identify, find_personal_data)


@pytest.mark.parametrize("operator", PER_ROW, ids=lambda f: f.__name__)
def test_a_row_for_every_row(edge_docs, no_docs, operator):
    assert by_id(operator(edge_docs).collect()) == ALL
    assert operator(no_docs).collect() == []


def test_filters_keep_columns(edge_docs, no_docs, items):
    for stage in (accepted, first_of_each_group, redacted, lambda d: decontaminated(d, items)):
        assert stage(edge_docs).schema.names == edge_docs.columns
        assert stage(no_docs).collect() == []


def test_mixing(edge_docs):
    rows = mix(edge_docs).collect()
    assert all(r.taken <= 3 * r.size for r in rows)
    assert {r.doc_id for r in rows if r.size == 0} == {3, 4, 5}
    mixed = mixed_documents(edge_docs)
    assert mixed.columns[: len(edge_docs.columns)] == edge_docs.columns
    assert mixed.columns[-3] == "mix_taken_" and all(r["mix_taken_"] > 0 for r in mixed.collect())


@pytest.mark.parametrize("shard_words", [1_000, 500, 300])
def test_shards_of_a_hot_source_add_up(spark, monkeypatch, shard_words):
    """Shards with about 1.2, 0.6 and 0.35 blocks each take the target of their source."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", shard_words)
    texts = ["w " * 50] * 4_000
    rows = [(i, t, "en", "c" if i < 3_400 else "abd"[i % 3]) for i, t in enumerate(texts)]
    found = mix(documents(spark, rows), (5, 5, 1, 5), most=60).collect()
    taken = defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
    goal = {r.source: r.target for r in found}
    assert abs(taken["c"] - goal["c"]) <= 0.08 * goal["c"], (taken["c"], goal["c"])


def test_near_duplicates(edge_docs):
    rows = near_duplicates(edge_docs).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert found[3] == (0, 3, True) and found[4] == (0, 4, True) and found[5] == (0, 5, True)
    assert found[2][1:] == (1, False) and found[None][1:] == (None, True)
    kept = first_of_each_group(edge_docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id in (1, 2)) == [1]


def test_language(edge_docs):
    rows = {r.doc_id: r for r in identify(edge_docs).collect()}
    assert [rows[i].lang_pred for i in (3, 4, 5, 8)] == ["und"] * 4 and rows[4].score == 0
    assert not {3, 4, 5, 8} & {r.doc_id for r in accepted(edge_docs).collect()}


def test_lines(edge_docs, no_docs):
    docs, total, removed = without_spread_lines(edge_docs, min_sites=2)
    rows = {r.doc_id: r for r in docs.collect()}
    # the copies are one place of the line; the text of 9 is another
    assert rows[1].text == "one two three four five six\nseven" and rows[1][removed] == 1
    assert rows[9].text == "état où l’âme naïve\n日本語の文章 👍"
    assert total == "n_lines_" and rows[4].text is None and rows[4][total] == 0
    assert rows[5].text == " \n\t\n " and rows[6].text == LONG
    assert without_spread_lines(no_docs)[0].collect() == []


def test_lines_of_a_block_on_many_sites(spark):
    """Every line of an unchanged footer goes; a text copied to many sites stays."""
    footer = "Footer A\nFooter B\nFooter C"
    rows = [(i, f"own text {i}\n{footer}", "en", f"s{i:02}") for i in range(20)]
    rows += [(100 + i, "copied one\ncopied two\ncopied three", "en", f"s{i:02}") for i in range(20)]
    # one site, many texts
    rows += [(200 + i, f"mine {i}\nonly here\nend {i}", "en", "s00") for i in range(20)]
    found, _, removed = without_spread_lines(documents(spark, rows))
    got = {r.doc_id: r for r in found.collect()}
    assert all(got[i].text == f"own text {i}" and got[i][removed] == 3 for i in range(20))
    assert all(got[i].text == t and got[i][removed] == 0 for i, t, *_ in rows if i >= 100)


def test_passages(edge_docs, no_docs):
    rows = repeated_passages(edge_docs).collect()
    assert {r.doc_id for r in rows} == {6, 7}
    assert {r.first_doc_id for r in rows} == {6} and {r.is_first for r in rows if r.doc_id == 6} == {True}
    cut = {r.doc_id: r.text for r in without_repeats(edge_docs, repeated_passages(edge_docs)).collect()}
    assert cut[6] == LONG and len(cut[7]) < 200 and cut[4] is None and cut[7].endswith("new end.")
    assert repeated_passages(no_docs).collect() == []


def test_benchmark(edge_docs, no_docs, items):
    rows = contaminations(edge_docs, items).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in rows} == {(6, 1, 0), (7, 1, 0)}
    assert rows[0].passage == LONG[rows[0].first : rows[0].stop] == "many words of one long text, which never ends"
    assert {r.doc_id for r in decontaminated(edge_docs, items).collect()} == set(IDS) - {6, 7}
    assert contaminations(no_docs, items).collect() == []
    assert contaminations(edge_docs, items.limit(0)).collect() == []
    assert decontaminated(edge_docs, items.limit(0)).count() == len(ROWS)


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "http://a.test/x", ""), (2, "http://a.test/x", ""), (None, "no url", "<p>a &amp; b"),
         (4, "http://[bad", "<p " * 2000), (5, "http://a.test/y", "<b>" * 3000 + "deep" + "<p>x</p>" * 2000)],
        "page_id bigint, url string, html string",
    )
    rows = {r.page_id: r for r in extract(pages).collect()}
    assert extract(pages).count() == 6 and rows[1].text == "" and rows[2].n_chars == 0
    assert rows[None].text == "a & b" and rows[5].text.startswith("deep\n\nx")
    assert extract(pages.limit(0)).collect() == []


def test_pipeline_stages(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns
            out.collect()
