"""Registered queries against SQL or plain versions, over whole tables."""

import hashlib
import html
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from trawl.llm.common import kept
from trawl.llm.near_dup import near_duplicates
from trawl.llm.queries import ORACLE_SQL, QUERIES
from .brute import near_components, words
from .conftest import documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return {
        name: duckdb.sql(f"FROM '{SF}/{name}.parquet'").fetchall()
        for name in ("documents", "pages", "benchmark")
    }


@pytest.fixture(scope="module")
def texts(tables):
    return {d: t for d, t, *_ in tables["documents"]}


def run(spark, name, sf=SF):
    return QUERIES[name](spark, sf).collect()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "benchmark", "mix"]


def test_mixing(spark, tables, texts):
    rows = run(spark, "op1_mixing")
    assert {r.doc_id: r.size for r in rows} == {d: len(words(t)) for d, t in texts.items()}
    source = {d: s for d, _, _, s, _ in tables["documents"]}
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= max(8, 0.02 * target[s]) for s in target)
    assert sorted(rows) == sorted(run(spark, "op1_mixing"))


def test_personal_data(spark, texts):
    from .test_methods import plain_spans

    for r in run(spark, "op2_pii"):
        base = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert hashlib.sha256(joined.encode()).hexdigest() == r.base_sha256
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(base)


def test_near_duplicates(spark, texts):
    expected = near_components(texts.items(), 85)
    rows = run(spark, "op3_near_dup")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_a_large_group_of_near_copies(spark):
    """Copies with up to four changes: linked by the original, by each other or not at all."""
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        for k in range(i % 5):
            text[(7 * i + 29 * k) % 150] = f"x{i}-{k}"
        rows.append((i, " ".join(text), "en", "a"))
    rows += [(1000 + i, " ".join(f"y{i}-{j}" for j in range(20)), "en", "a") for i in range(50)]
    found = near_duplicates(documents(spark, rows), 85).collect()
    expected = near_components([(d, t) for d, t, *_ in rows], 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_token_counts(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r in run(spark, "op4_token_counts"):
        text = texts[r.doc_id]
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False))
        assert r.n_bytes == len(text.encode()) and r.over_limit == (r.n_tokens > 1024)


def test_repeated_passages(spark, texts):
    grams = defaultdict(set)
    for d, t in texts.items():
        w = words(t)
        for size in (20, 50):
            for i in range(len(w) - size + 1):
                if size == 20 or len(set(w[i : i + size])) > 3:
                    grams[size, tuple(w[i : i + size])].add(d)
    repeated = {s: {d for (n, _), ds in grams.items() if n == s and len(ds) > 1 for d in ds} for s in (20, 50)}
    rows = run(spark, "op5_substring_dedup")
    found = {r.doc_id for r in rows}
    assert repeated[50] <= found <= repeated[20]
    for r in rows:
        assert 0 <= r.first < r.stop <= len(texts[r.doc_id]) and r.first_doc_id <= r.doc_id


def test_fingerprints(spark, texts):
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in run(spark, "op6_fingerprints")}
    by_text = {}
    for i, d in enumerate(order):
        text, after = texts[d], texts[order[(i + 1) % len(order)]]
        cut = len(text) // 3
        new = text[: len(text) - cut] + after[:cut]
        r = rows[d]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(text)
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(rows) == len(texts)
    mean = lambda c: sum(r[c] for r in rows.values()) / len(rows)
    assert mean("near_edited") > 0.5 > 0.1 > mean("near_next")


def test_page_texts(spark, tables):
    pages = {p: h for p, _, h in tables["pages"]}
    rows = run(spark, "op7_html_text")
    for r in rows:
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    assert len(rows) == len(pages)


def test_lines_by_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    expected = db.execute(ORACLE_SQL["op8_line_dedup"])
    columns = [c[0] for c in expected.description]
    assert sorted(expected.fetchall()) == sorted(tuple(r[c] for c in columns) for r in run(spark, "op8_line_dedup"))


def test_benchmark_items(spark, tables, texts):
    rows = run(spark, "op9_decontamination")
    exact = {(d, i) for d, t in texts.items() for i, item in tables["benchmark"] if item in t}
    assert exact <= {(r.doc_id, r.item_id) for r in rows}
    assert all(r.edits <= 0.2 * r.item_words and texts[r.doc_id][r.first : r.stop] == r.passage for r in rows)


def test_language_of_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    docs = {d: lang for d, _, lang, *_ in duckdb.sql(f"FROM '{sf}/documents.parquet'").fetchall()}
    rows = run(spark, "op10_language_id", sf)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(docs)


def test_pipeline_stage_by_stage(spark, tables):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    state = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, SF), name)
        state.append({r.doc_id: getattr(r, "text") for r in docs.collect()})
    raw, language, lines, near, clean, mixed = state
    assert language == {d: t for d, t in raw.items() if re.search(r"[^\W\d_]", t)}
    assert lines.keys() == language.keys()
    expected = near_components(lines.items(), 80)
    assert near == {d: t for d, t in lines.items() if expected[d][1] == d}
    held = {d for d, t in near.items() if any(item in t for _, item in tables["benchmark"])}
    assert clean.keys() <= near.keys() - held and len(near) - len(clean) <= len(held) + 3
    assert mixed.keys() <= clean.keys()
    assert all(0 < r.mix_taken <= 3 * len(words(r.text)) for r in docs.collect())
