"""Phrases that many items share, rows without ids, repeated rows, benchmarks of many blocks."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import decontaminate, mixing
from trawl.llm.decontaminate import allowed_edits, contaminations, decontaminated, seed_places
from trawl.llm.mixing import mix, mixed_documents

from .conftest import documents


def edited(rng, words, edits):
    part = list(words)
    for at in sorted(rng.sample(range(len(part)), edits), reverse=True):
        rng.choice([lambda: part.__setitem__(at, "new"), lambda: part.insert(at, "new"),
                    lambda: part.__delitem__(at)])()
    return part


def test_one_seed_outlives_the_edits():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(6, 60)
        words, edits = [str(i) for i in range(n)], allowed_edits(n)
        held = np.array([rng.choice([1, 5, 9, 30, 400]) for _ in range(n - 2)])
        places = seed_places(held, 3, edits + 1)
        assert set(np.flatnonzero(held <= decontaminate.RARE_RUN)) <= set(places)
        # no other choice of runs apart has a smaller largest count
        worst = max(held[places].max(), decontaminate.RARE_RUN)
        if worst > decontaminate.RARE_RUN:
            assert len(decontaminate._apart(np.flatnonzero(held < worst), 3)) < edits + 1
        text = edited(rng, words, edits)
        runs = {tuple(text[i : i + 3]) for i in range(len(text) - 2)}
        assert any(tuple(words[p : p + 3]) in runs for p in places)


def test_shared_opening_lays_no_windows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3_000)]
    opening = "which of the following is".split()
    items = [(i, " ".join(opening + rng.choices(vocabulary, k=rng.randint(10, 30)))) for i in range(20_000)]
    block = decontaminate.Items(items)
    text = " ".join(" ".join(opening + rng.choices(vocabulary, k=3)) for _ in range(24_000))
    assert len(text) > 1_000_000
    began = time.process_time()
    assert list(block.find([text])) == []
    assert time.process_time() - began < 10
    missed, sought = Counter(), Counter()
    for i, item in rng.sample(items, 600):
        words = item.split()
        for edits in {0, 1, allowed_edits(len(words))}:
            whole = opening + ["so"] + edited(rng, words, edits) + rng.choices(vocabulary, k=20)
            sought[edits] += 1
            missed[edits] += i not in {block.ids[x][0] for _, x, *_ in block.find([" ".join(whole)])}
    assert sum(missed.values()) <= 0.02 * sum(sought.values()), (missed, sought)
    assert not missed[0]


def test_benchmark_of_many_blocks(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdef", k=5)) for _ in range(12)) for _ in range(9)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(20, texts[0]), (20, texts[0]), (None, texts[1]), (30, None)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    docs = documents(spark, [(i, f"before {t} after", "en", "a") for i, t in enumerate(texts[:5])] + [(9, "clean", "en", "a")])
    expected = sorted((d, i) for d in range(5) for i, t in rows if t == texts[d] and i is not None) + [(1, None)]
    for passes, size in ((20_000, 1 << 20), (3, 1 << 20), (20_000, 200)):
        monkeypatch.setattr(decontaminate, "ITEMS_PER_PASS", passes)
        monkeypatch.setattr(decontaminate, "BYTES_PER_PASS", size)
        found = [(r.doc_id, r.item_id) for r in contaminations(docs, items).collect()]
        assert Counter(found) == Counter(expected)
        assert [r.doc_id for r in decontaminated(docs, items).collect()] == [9]


def test_rows_without_ids_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 1_000)
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 300)
    docs = spark.range(6_000).select(
        F.lit(None).cast("bigint").alias("doc_id"),
        F.when(F.col("id") < 3_000, F.lit("same text of five words")).otherwise(
            F.concat(F.lit("a b c d w"), F.col("id").cast("string"))).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"),
    )
    sized = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"))
    numbered = mixing.numbered_copies(sized)
    shard = F.pmod(F.xxhash64(F.lit(43), "doc_id", "text_hash", "copy"), F.lit(30))
    counts = [r["count"] for r in numbered.groupBy(shard).count().collect()]
    assert len(counts) == 30 and sum(counts) == 6_000 and max(counts) < 300
    rows = mix(docs).collect()
    assert len(rows) == 6_000 and sum(r.taken for r in rows) == pytest.approx(30_000, rel=0.02)
    again = mix(docs.repartition(7)).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))
    assert mixed_documents(docs).count() == 6_000


@pytest.mark.parametrize("per_range", [1, 3, 4096])
def test_quotas_over_ranges_of_shards(spark, monkeypatch, per_range):
    monkeypatch.setattr(mixing, "SHARDS_PER_RANGE", per_range)
    rng = random.Random(6)
    rows = [(rank, shard, rng.randint(1, 500)) for rank in (0, 1) for shard in range(20) for _ in range(3)]
    whole = {k: sum(n for r, _, n in rows if r == k) for k in (0, 1)}
    blocks = {0: 13, 1: 977}
    dealt = spark.createDataFrame(
        [(r, s, n, whole[r], blocks[r]) for r, s, n in rows],
        "rank bigint, shard bigint, size bigint, source_size bigint, blocks bigint",
    )
    found = {(r.quota_rank, r.quota_shard): r.quota for r in mixing.shard_quotas(dealt).collect()}
    for rank in (0, 1):
        before = done = 0
        for shard in range(20):
            before += sum(n for r, s, n in rows if (r, s) == (rank, shard))
            stop = int(blocks[rank] * (before / whole[rank]) + 0.5)
            assert found[rank, shard] == stop - done
            done = stop
        assert done == blocks[rank]
