"""Cases that once went wrong: endless digits, split repeats, copies without ids, numbers as letters."""

import random

from pyspark.sql import functions as F

from trawl.llm import substrings
from trawl.llm.language import has_letter, identify
from trawl.llm.near_dup import first_of_each_group
from trawl.llm.pii import base_spans, find_personal_data, redacted
from trawl.llm.substrings import repeated_passages, without_repeats
from .brute import words
from .conftest import documents


def test_long_runs_of_zeros_are_addresses(spark):
    """Also beyond the digits that Python turns into a number."""
    text = "at 1.2.3." + "0" * 5_000 + "9 and 1.2.3." + "0" * 5_000 + "256"
    assert base_spans(text)[0] == ("ip", 3, 3 + 6 + 5_001)
    assert [s for s in base_spans(text) if s[0] == "ip"] == [("ip", 3, 5_010)]
    rows = documents(spark, [(1, text, "en", "a"), (2, "+" + "1 " * 9_000, "en", "a"), (3, "1" * 20_000, "en", "a")])
    found = {r.doc_id: r for r in find_personal_data(rows).collect()}
    assert found[1].n_ip == 1 and found[2].n_phone == found[3].n_card == 0
    assert redacted(rows).count() == 3


def plain_chunks(data):
    """Chunk ends, the hash of the 16 bytes up to each place summed anew."""
    ends, last = [], 0
    for i in range(len(data)):
        window = sum(int(substrings._GEAR[b]) << k for k, b in enumerate(reversed(data[max(0, i - 15) : i + 1])))
        cut = (window >> (16 - substrings.CUT_BITS)) & ((1 << substrings.CUT_BITS) - 1) == 0
        size = i + 1 - last
        if (cut and size >= substrings.MIN_CHUNK) or size == substrings.MAX_CHUNK:
            ends.append(i + 1)
            last = i + 1
    return ends if last == len(data) else [*ends, len(data)]


def plain_passages(docs, min_words):
    """(doc_id, first, stop, words, first_doc_id, is_first) from pairs of chunks as byte strings."""
    held, pairs = {}, {}
    for d, text in docs:
        data = text.encode()
        edges = [0, *plain_chunks(data)]
        pairs[d] = [(data[a:c], a, c, (data[a:b], data[b:c])) for a, b, c in zip(edges, edges[1:], edges[2:])]
        for *_, pair in pairs[d]:
            held.setdefault(pair, set()).add(d)
    out = []
    for d, text in docs:
        data = text.encode()
        runs = []
        for _, a, c, pair in pairs[d]:
            if len(held[pair]) > 1:
                if not runs or a >= runs[-1][-1][1]:
                    runs.append([])
                runs[-1].append((a, c, min(held[pair])))
        for run in runs:
            if begun(data, run[0][0], run[-1][1]) < min_words:
                continue
            parts = [[run[0]]]
            for unit in run[1:]:
                if unit[2] != parts[-1][-1][2]:
                    parts.append([])
                parts[-1].append(unit)
            for part in parts:
                a, c, source = part[0][0], part[-1][1], part[0][2]
                points = [len(data[:x].decode(errors="ignore")) for x in (a, c)]
                out.append((d, *points, begun(data, a, c), source, source == d))
    return sorted(out)


def begun(data, a, c):
    blank = {32, *range(9, 14)}
    return sum(data[i] not in blank and (i == 0 or data[i - 1] in blank) for i in range(a, c))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_passages_by_brute_force(spark):
    rng = random.Random(11)
    parts = [prose(rng, 80) for _ in range(8)]
    docs = []
    for i in range(40):
        chosen = [rng.choice(parts) if rng.random() < 0.5 else prose(rng, rng.randint(1, 60)) for _ in range(3)]
        docs.append((i, " ".join(chosen)))
    table = documents(spark, [(d, t, "en", "a") for d, t in docs])
    rows = repeated_passages(table).collect()
    got = sorted((r.doc_id, r.first, r.stop, r.words, r.first_doc_id, r.is_first) for r in rows)
    assert got == plain_passages(docs, substrings.MIN_WORDS) and len(got) > 30


def test_one_copy_of_everything_stays(spark):
    """Halves of a repeat that come from two documents; repeated rows; many mixtures."""
    rng = random.Random(4)
    a, b = prose(rng, 80), prose(rng, 80)
    parts = [prose(rng, 70) for _ in range(6)]
    docs = [(1, a), (2, a + " " + b), (3, a + " " + b), (3, a + " " + b)]
    docs += [(10 + i, " ".join(rng.sample(parts, rng.randint(1, 4)))) for i in range(30)]
    table = documents(spark, [(d, t, "en", "a") for d, t in docs])
    left = without_repeats(table, repeated_passages(table)).collect()
    texts = [r.text for r in left]
    assert sorted(r.doc_id for r in left) == sorted(d for d, _ in docs)
    pieces = sum(map(len, texts))
    assert pieces < 0.4 * sum(len(t) for _, t in docs)
    # every three words of the input stand somewhere still, but for those cut at an edge of a passage
    everywhere = {tuple(w[i : i + 3]) for w in map(words, texts) for i in range(len(w) - 2)}
    for part in (a, b, *parts):
        w = words(part)
        missing = [i for i in range(len(w) - 2) if tuple(w[i : i + 3]) not in everywhere]
        assert len(missing) <= 9, missing
    second = next(r.text for r in left if r.doc_id == 2)
    assert second.endswith(b[60:]) and a[:200] not in second


def test_one_document_of_each_group(spark):
    rng = random.Random(8)
    long = [f"w{i}" for i in range(100)]
    near = [" ".join([*long[:i], "x", *long[i + 1 :]]) for i in (3, 50, 90)]
    other = prose(rng, 50)
    rows = [(None, near[0], "en", "a"), (None, near[1], "en", "b"), (None, near[2], "en", "c"), (None, near[2], "en", "c")]
    rows += [(7, other, "en", "a")] * 3 + [(9, other, "en", "b"), (None, other, "en", "b")]
    rows += [(5, prose(rng, 40), "en", "a"), (6, "", "en", "a"), (8, " ", "en", "a")]
    table = documents(spark, rows).withColumn("times", F.lit(0))
    kept = first_of_each_group(table)
    assert kept.columns == table.columns
    found = kept.collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [5, 6, 7, 8]
    assert len([r for r in found if r.doc_id is None]) == 1
    assert next(r for r in found if r.doc_id == 7).text == other


def test_numbers_are_no_letters(spark):
    assert not any(map(has_letter, (None, "", "½ ² ①", "Ⅷ", "12_ !")))
    assert all(map(has_letter, ("Ⅷ x", "日", "ñ", "ʰ")))
    docs = documents(spark, [(i, f"some english words {i}", "en", "a") for i in range(12)] + [(50, "½ ² ①", "en", "a"), (51, "Ⅷ", None, "a")])
    rows = {r.doc_id: r for r in identify(docs).collect()}
    assert rows[50].lang_pred == rows[51].lang_pred == "und" and rows[1].lang_pred == "en"
