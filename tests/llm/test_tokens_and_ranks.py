"""Ranked search, alignment and byte-level BPE against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from trawl.llm import alignment, ranking
from trawl.llm.alignment import align, overlaps
from trawl.llm.bytepairs import decoded, encode_word, encoded, read_ranks
from trawl.llm.queries import ORACLE_SQL, QUERIES
from trawl.llm.ranking import Lists, best_positions, ranked
from .conftest import LONG, ROWS, documents

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
FILES = [str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


# -- ranked search --


def plain_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_ranks(docs, items, k=10):
    """(item_id, rank, doc_id, score), every document scored."""
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    counts = [(d, c, c.total()) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for d, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(plain_terms(text)) if t in c
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item_id, i, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k], 1)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_ranked_search(spark, texts):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    rows = QUERIES["op11_ranked_search"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(plain_ranks(texts.items(), items))
    assert rows[0].asDict().keys() == {"item_id", "rank", "doc_id", "score"}


def test_ranked_search_by_sql(spark):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    expected = db.execute(ORACLE_SQL["op11_ranked_search"])
    columns = [c[0] for c in expected.description]
    got = QUERIES["op11_ranked_search"](spark, SF).collect()
    assert sorted(expected.fetchall()) == sorted(tuple(r[c] for c in columns) for r in got)


def test_ranked_search_over_shards_and_ties(spark, monkeypatch):
    """Many equal scores, a word in most documents, small shards and query parts."""
    monkeypatch.setattr(ranking, "SHARD_POSTINGS", 300)
    monkeypatch.setattr(ranking, "QUERY_BYTES", 200)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [
        (i, " ".join(["the"] * (i % 7 > 0) + rng.choices(words[: 10 + i % 50], k=rng.randint(1, 12))), "en", "a")
        for i in range(600)
    ]
    rows += [(1000 + i, "W1 w2, w3", "en", "a") for i in range(50)]
    items = [(i, " ".join(rng.sample([*words, "the", "unknown"], rng.randint(1, 9)))) for i in range(30)]
    items += [(99, "w1 w2 w3"), (99, "w1 w2 w3"), (100, "The the THE")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted(map(tuple, ranked(documents(spark, rows), table).collect()))
    assert found == sorted(plain_ranks([r[:2] for r in rows], items))


def test_ranked_search_edges(spark, edge_docs, no_docs):
    items = [(1, "many words shared LINE"), (2, None), (3, "..."), (None, "日本語の文章"), (1, "seven"), (4, "état")]
    table = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", ranking.F.lit(0))
    found = [tuple(r) for r in ranked(edge_docs, table).collect()]
    # the repeated document comes as often in both
    assert sorted(found, key=key) == sorted(plain_ranks([r[:2] for r in ROWS], items), key=key)
    assert ranked(no_docs, table).collect() == ranked(edge_docs, table.limit(0)).collect() == []


def test_best_positions_stops_early():
    """A document far ahead ends the reading; what the bound leaves out is not looked up."""
    import pyarrow as pa

    n = 20_000
    tf = np.ones(2 * n, int)
    tf[:20] = 50
    terms = pa.ListArray.from_arrays(pa.array(range(0, 2 * n + 1, 2), pa.int32()), pa.array([0, 1] * n))
    tfs = pa.ListArray.from_arrays(pa.array(range(0, 2 * n + 1, 2), pa.int32()), pa.array(tf))
    weight = np.array([700, 900, 500])
    lists = Lists.of(terms, tfs, np.full(n, 100), weight)
    reads = []
    lists.at = Watched.of(lists.at, reads)
    doc, _ = best_positions(lists, np.array([0, 1, 2]), weight, 10, np.full(3, -1))
    assert sorted(doc.tolist()) == list(range(10)) and sum(reads) < 200


class Watched(np.ndarray):
    @classmethod
    def of(cls, values, reads):
        out = values.view(cls)
        out.reads = reads
        return out

    def __getitem__(self, places):
        self.reads.append(np.size(places))
        return self.view(np.ndarray)[places]


# -- alignment --


def plain_alignment(texts):
    """doc_id to the contract's columns, pair by pair."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    letters = {v: k for k, v in _letters().items()}
    out, links = {}, {}
    for d, text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        target = (" " + (text or "")).encode()
        if b"".join(bytes_a) != target or b"".join(bytes_b) != target:
            ids_a = ids_b = bytes_a = bytes_b = []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups = [([], []) for _ in cuts]
        for side, ids, ends in ((0, ids_a, ends_a), (1, ids_b, ends_b)):
            for i, e in zip(ids, ends):
                groups[next(n for n, c in enumerate(cuts) if c >= e)][side].append(str(i))
        text_of = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        pairs = [
            (ids_a[i], ids_b[j])
            for i in range(len(ids_a)) for j in _around(ends_b, ends_a[i] - len(bytes_a[i]), ends_a[i])
        ]
        links[len(links)] = (d, len(ids_a), len(ids_b), len(cuts), pairs, text_of)
    count = Counter(p for *_, pairs, _ in links.values() for p in pairs)
    highest = defaultdict(int)
    for (_, y), n in count.items():
        highest[y] = max(highest[y], n)
    return [
        (d, na, nb, ng, len(pairs), sum(count[p] == highest[p[1]] for p in pairs), sum(count[p] for p in pairs),
         hashlib.sha256(t.encode()).hexdigest() if na else "")
        for d, na, nb, ng, pairs, t in links.values()
    ]


def _around(ends, low, high):
    """Tokens with a byte in [low, high)."""
    return range(np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "left") + 1)


def _letters():
    from trawl.llm.tokens import _byte_of_letter

    return {b: c for c, b in _byte_of_letter().items()}


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment(spark, texts):
    rows = QUERIES["op12_alignment"](spark, SF).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == sorted(plain_alignment(texts.items()))


ODD = [
    "", None, " ", "a", "  two  blanks ", "tab\there", "▁ underline", "<|endoftext|> plain", "<s></s><unk>",
    "naïve état 日本語 👍🏽 ﬁ", "line\nfeed\r\n", "a" * 5_000, " " * 300, "é" * 999, "\x00\x01", "nothing … here",
]


def test_alignment_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 500)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 300)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, "a"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("groups", ranking.F.lit(1))
    found = align(docs, *FILES)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    got = [
        (*(r[c] for c in COLUMNS[:-1]), hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else r.groups)
        for r in found.collect()
    ]
    assert sorted(got, key=key) == sorted(plain_alignment(rows), key=key)
    assert align(docs.limit(0), *FILES).collect() == []


def test_overlaps_are_all_pairs():
    rng = random.Random(2)
    for _ in range(50):
        sides, length = [], rng.randint(1, 40)
        for _ in "ab":
            cuts = sorted({*rng.sample(range(1, length + 1), rng.randint(0, length)), length})
            ends = np.array(cuts)
            sides.append(pd.DataFrame({
                "doc": 0, "id": 0, "at": np.append(0, ends[:-1]), "end": ends, "place": np.arange(len(ends))
            }))
        a, b = sides
        found = sorted(overlaps(a, b)[["a", "b"]].itertuples(index=False, name=None))
        assert found == [
            (i, j) for i in a.place for j in b.place
            if a["at"][i] < b["end"][j] and b["at"][j] < a["end"][i]
        ]


# -- byte-level BPE --


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, texts, library):
    rows = {r.doc_id: r for r in QUERIES["op13_byte_bpe"](spark, SF).collect()}
    assert rows.keys() == texts.keys()
    for d, text in texts.items():
        ids = library.encode_ordinary(text)
        assert rows[d].n_tokens == len(ids)
        assert rows[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_words_as_the_library_encodes_them(ranks, library):
    rng = random.Random(3)
    letters = ["abcdefghijklmnop", "ab", "é日👍x", " ", "\x00\x80ÿ", "-=!"]
    for _ in range(3_000):
        word = "".join(rng.choice(rng.choice(letters)) for _ in range(rng.randint(1, 30))).encode()
        assert encode_word(word, ranks) == library._core_bpe.encode_single_piece(word)
    for word in (b"a" * 20_000, b"ab" * 9_999, bytes(rng.randrange(256) for _ in range(9_999))):
        assert encode_word(word, ranks) == library._core_bpe.encode_single_piece(word)


def test_words_are_cut_as_the_library_cuts_them(spark, ranks, library):
    """Every code point between letters, digits and marks."""
    chars = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}a1{c}1!{c}! {c} {c}{c}" for c in chars[i : i + 500]) for i in range(0, len(chars), 500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r.ids for r in encoded(docs, ranks, public_tokenizers.PATTERN).collect()}
    assert all(rows[i] == library.encode_ordinary(t) for i, t in enumerate(texts))


def test_byte_bpe_edges(spark, ranks, library, edge_docs, no_docs, monkeypatch):
    from trawl.llm import bytepairs

    monkeypatch.setattr(bytepairs, "BLOCK_BYTES", 700)
    monkeypatch.setattr(bytepairs, "WORDS_AT_ONCE", 50)
    monkeypatch.setattr(bytepairs, "PACK_CHARS", 100)
    monkeypatch.setattr(bytepairs, "BYTES_PER_PART", 300)
    odd = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = edge_docs.select("doc_id", "text").unionByName(odd)
    ids = encoded(docs.withColumn("ids", ranking.F.lit(1)), ranks, public_tokenizers.PATTERN)
    rows = ids.select("doc_id", "ids", decoded("ids", ranks).alias("bytes")).collect()
    want = [(r[0], r[1] or "") for r in ROWS] + [(100 + i, t or "") for i, t in enumerate(ODD)]
    got = [(r.doc_id, r.ids, bytes(r.bytes)) for r in rows]
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0)) == sorted(
        [(d, library.encode_ordinary(t), t.encode()) for d, t in want], key=lambda r: (r[0] is None, r[0] or 0)
    )
    assert LONG in {r[2].decode() for r in got}
    assert encoded(no_docs, ranks, public_tokenizers.PATTERN).collect() == []
    none = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>").select(decoded("ids", ranks)).collect()
    assert [r[0] for r in none] == [None, b"", b'!"']
