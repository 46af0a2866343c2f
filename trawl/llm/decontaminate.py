"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import WordHashes, by_arrow, kept, mixed

#: Edits allowed, as a share of an item's words.
MAX_EDITS = 0.2
#: Repeats of the embedding and positions sampled from each. By simulation 48
#: repeats of 3 find 98 of 100 windows at the most edits allowed, all at fewer.
REPEATS = 48
SAMPLED = 3
SEED_WORDS = 3
#: Runs of words that at most so many items hold always lay windows; of the others
#: only as many as the allowed edits can not all destroy.
RARE_RUN = 2
#: Items, and bytes of them, compared in one pass over the documents; more take more passes.
ITEMS_PER_PASS = 20_000
BYTES_PER_PASS = 32 << 20
PACK_BYTES = 8 << 20
_SLOT_BITS = 22
_KEY = np.uint64(0x9E3779B97F4A7C15)
#: Scripts written without spaces: Thai, Lao, Burmese, Khmer, kana, Han and such.
_UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF),
    (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x302F), (0x3031, 0x312F), (0x31A0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x323AF),
)
_SCRIPTS_END = 0x323B0


def _class_of(points: Iterable[int]) -> str:
    """A regular expression's class of code points."""
    runs: list[list[int]] = []
    for c in points:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def _word_pattern() -> str:
    single, letters, marks = [], [], []
    for c in range(_SCRIPTS_END):
        kind = unicodedata.category(chr(c))[0]
        if kind == "M":
            marks.append(c)
        elif kind in "LN":
            (single if any(a <= c <= b for a, b in _UNSPACED) else letters).append(c)
    one, mark = _class_of(single), _class_of(marks)
    run = _class_of(sorted(letters + marks))
    return rf"[{one}][{mark}]*+|[{run}]++"


_WORD = re.compile(_word_pattern())
#: Latin letters, and ASCII. In texts of these alone bytes from 0x80 on are letters.
_NOT_LATIN = re.compile(r"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]")
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c >= 128 else 32 for c in range(256)
)


def _words(text: str) -> list[bytes]:
    """Runs of letters, digits and their marks by Unicode, with A-Z in lower case.

    In scripts without spaces each letter is a word.
    """
    if _NOT_LATIN.search(text):
        text = " ".join(_WORD.findall(text))
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def allowed_edits(words: int, share: float = MAX_EDITS) -> int:
    """None below six words: an edit could leave no run of three of them."""
    return math.floor(words * share + 1e-9) if words >= 6 else 0


class Embedding:
    """CGK random walks over windows of ``size`` words, read at sampled steps.

    A walk writes a word at each step and goes on to the next one or stays, by a
    random bit of step and word. After an edit the walks of two windows meet
    again, so that few edits leave most steps equal. A key holds the words at the
    sampled steps of one repeat.
    """

    def __init__(self, size: int, seed: int = 42):
        rng = np.random.default_rng([seed, size])
        steps = max(SAMPLED, 2 * size - size // 3)
        self.size = size
        self.odd = rng.integers(0, 2**63, (REPEATS, steps)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        order = rng.random((REPEATS, steps)).argsort(axis=1)
        self.sampled = order < min(SAMPLED, steps)

    def keys(self, words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """A key per repeat and window (REPEATS, N); nothing is read from ``stops`` on."""
        ends = np.minimum(starts + self.size, stops)
        at = np.repeat(starts[None, :], REPEATS, axis=0)
        keys = np.zeros(at.shape, np.uint64)
        for step in range(self.odd.shape[1]):
            word = np.where(at < ends, words[np.minimum(at, len(words) - 1)], np.uint64(0))
            rows = self.sampled[:, step]
            if rows.any():
                keys[rows] = keys[rows] * _KEY + word[rows] + np.uint64(1)
            at += (mixed(word) * self.odd[:, step : step + 1] >> np.uint64(63)).astype(np.int64)
        return keys


def _last_row(item: np.ndarray, text: np.ndarray, anchored: bool) -> np.ndarray:
    """Edit distances of the item to parts of ``text`` that end at each place.

    The parts begin anywhere, or at 0 if ``anchored``.
    """
    steps = np.arange(len(text) + 1)
    row = steps.copy() if anchored else np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.minimum(row + 1, np.concatenate([[i], row[:-1] + (text != word)]))
        row = np.minimum.accumulate(new - steps) + steps
    return row


def best_part(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Fewest edits from the item to a part of ``text``, and the part's first and stop."""
    ends = _last_row(item, text, False)
    stop = int(ends.argmin())
    back = _last_row(item[::-1], text[:stop][::-1], True)
    return int(ends[stop]), stop - int(back.argmin()), stop


class Items:
    """A block of benchmark items, prepared for the search."""

    def __init__(self, rows: list[tuple[int, str | None]], max_edits: float = MAX_EDITS):
        hashes = WordHashes()
        same: dict[bytes, tuple[list[int], np.ndarray]] = {}  # items of the same words
        for i, t in rows:
            words = hashes.of(_words(t or ""))
            if len(words):
                same.setdefault(words.tobytes(), ([], words))[0].append(i)
        found = list(same.values())
        self.ids = [ids for ids, _ in found]
        self.hashes = WordHashes()
        self.words = [w for _, w in found]
        self.edits = [allowed_edits(len(w), max_edits) for w in self.words]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.embeddings = {n: Embedding(n) for n in sorted(set(self.sizes.tolist()))}
        self.keys = np.zeros((len(self.words), REPEATS), np.uint64)
        for n, embedding in self.embeddings.items():
            own = np.flatnonzero(self.sizes == n)
            for i in range(0, len(own), 4096):
                part = own[i : i + 4096]
                stops = np.arange(1, len(part) + 1) * n
                joined = np.concatenate([self.words[x] for x in part])
                self.keys[part] = embedding.keys(joined, stops - n, stops).T
        self.seeds = {}
        for size in range(1, SEED_WORDS + 1):
            own = [i for i, w in enumerate(self.words) if min(len(w), SEED_WORDS) == size]
            runs = [_runs(self.words[i], size) for i in own]
            held = _item_counts(runs)
            parts = [
                (int(run[at]), i, at)
                for i, run, counts in zip(own, runs, held)
                for at in seed_places(counts, size, self.edits[i] + 1)
            ]
            if parts:
                parts.sort()
                code = np.array([p[0] for p in parts], np.uint64)
                slots = np.zeros(1 << _SLOT_BITS, bool)
                slots[(code >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)] = True
                self.seeds[size] = (
                    code, np.array([p[1] for p in parts]), np.array([p[2] for p in parts]), slots
                )

    def windows(self, words: np.ndarray, owner: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and starts of the windows to look at.

        A text within the allowed edits of an item shares one of its seeds
        (:func:`seed_places`); each shared one lays an item-sized window over the text.
        """
        items, starts = [], []
        for size, (code, item, offset, slots) in self.seeds.items():
            runs = _runs(words, size)
            at = np.flatnonzero(slots[(runs >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)])
            at = at[owner[at] == owner[at + size - 1]]
            lo, hi = np.searchsorted(code, runs[at], "left"), np.searchsorted(code, runs[at], "right")
            times = hi - lo
            place = np.repeat(at, times)
            which = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
            items.append(item[which])
            starts.append(np.maximum(place - offset[which], first[owner[place]]))
        pair = np.unique(np.stack([np.concatenate(items), np.concatenate(starts)]), axis=1)
        return pair[0], pair[1]

    def find(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """Text, item, edits, first word and stop word of the best part per text and item."""
        each = [self.hashes.of(_words(t)) for t in texts]
        lengths = np.array([len(w) for w in each])
        words = np.concatenate(each) if each else np.zeros(0, np.uint64)
        if len(words) < SEED_WORDS:
            words = np.concatenate([words, np.zeros(SEED_WORDS, np.uint64)])
        stops = np.cumsum(lengths)
        first = stops - lengths
        owner = np.append(np.repeat(np.arange(len(texts)), lengths), np.full(SEED_WORDS, -1))
        if not self.seeds or not len(owner) - SEED_WORDS:
            return
        items, starts = self.windows(words, owner, first)
        near: dict[tuple[int, int], list[int]] = defaultdict(list)
        for size, embedding in self.embeddings.items():
            own = np.flatnonzero(self.sizes[items] == size)
            for i in range(0, len(own), 4096):
                part = own[i : i + 4096]
                at, item = starts[part], items[part]
                same = (embedding.keys(words, at, stops[owner[at]]) == self.keys[item].T).any(axis=0)
                for x, s in zip(item[same].tolist(), at[same].tolist()):
                    near[int(owner[s]), x].append(s)
        for (text, x), found in sorted(near.items()):
            size, edits = len(self.words[x]), self.edits[x]
            best = None
            group: list[int] = []
            for s in [*sorted(found), None]:
                if group and (s is None or s - group[-1] > size):
                    lo = max(int(first[text]), group[0] - edits)
                    hi = min(int(stops[text]), group[-1] + size + edits)
                    cost, a, b = best_part(self.words[x], words[lo:hi])
                    if cost <= edits and (best is None or cost < best[0]):
                        best = cost, a + lo - int(first[text]), b + lo - int(first[text])
                    group = []
                if s is not None:
                    group.append(s)
            if best:
                yield text, x, *best


def _item_counts(runs: list[np.ndarray]) -> list[np.ndarray]:
    """How many items hold each run."""
    if not runs:
        return []
    every = np.concatenate([np.unique(r) for r in runs])
    code, count = np.unique(every, return_counts=True)
    return [count[np.searchsorted(code, r)] for r in runs]


def _apart(places: np.ndarray, size: int) -> list[int]:
    """As many of the places as possible whose runs share no word."""
    out: list[int] = []
    for at in places.tolist():
        if not out or at >= out[-1] + size:
            out.append(at)
    return out


def seed_places(held: np.ndarray, size: int, needed: int) -> list[int]:
    """Places of an item's runs that lay windows; ``held`` tells how many items hold each.

    An edit destroys one of several runs that share no word, so of ``needed`` =
    edits + 1 such runs one is left. They are the rarest that there are: a phrase
    that many items begin with is not among them, as long as the rest of the
    item has enough runs. Rare runs all count, as more windows find more. An item
    too short for ``needed`` runs is sought by all it has.
    """
    rare = np.flatnonzero(held <= RARE_RUN)
    if len(_apart(rare, size)) >= needed:
        return rare.tolist()
    if len(_apart(np.arange(len(held)), size)) < needed:
        return list(range(len(held)))
    limits = np.unique(held[held > RARE_RUN])
    lo, hi = 0, len(limits) - 1
    while lo < hi:
        mid = (lo + hi) // 2
        if len(_apart(np.flatnonzero(held <= limits[mid]), size)) >= needed:
            hi = mid
        else:
            lo = mid + 1
    chosen = _apart(np.flatnonzero(held <= limits[lo]), size)
    return sorted({*rare.tolist(), *chosen})


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of exactly ``size`` words."""
    count = max(0, len(words) - size + 1)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * _KEY + words[i : i + count]
    return mixed(out, 11)


def _packs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + PACK_BYTES, "right")))
        yield start, stop
        start = stop


def item_blocks(benchmark: DataFrame, max_edits: float) -> Iterator[tuple[Items, bool]]:
    """The benchmark in blocks that the driver can hold and send along, and which is the last.

    What is done with a block but the last should be written before the next one
    is asked for, so that one block at a time is held.
    """
    slim = benchmark.select("item_id", "text")
    count, size = slim.agg(F.count("*"), F.sum(F.octet_length("text").cast("bigint"))).first()
    blocks = max(1, -(-count // ITEMS_PER_PASS), -(-(size or 0) // BYTES_PER_PASS))
    for block in range(blocks):
        part = slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(part.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        yield Items([(r["item_id"], r["text"]) for r in rows], max_edits), block == blocks - 1


def contaminations(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS
) -> DataFrame:
    """Benchmark items found in documents, a row per document and item.

    Returns doc_id, item_id, item_words, edits, and the best part of the text as
    code points first and stop, and passage. An item is found where a part of a
    text is within ``max_edits`` of its words in edits of words; below six words
    it is found only unchanged. Candidates are item-sized windows of which one of
    48 sampled embeddings equals the item's; the edit distance of every one is
    then computed exactly.

    Texts are searched whole, where they lie; nothing is shuffled. Items without
    words, and null texts, are never found. Repeated items and repeated rows give
    repeated rows. Either table may be empty. Other columns are not read.
    """

    def search(items: Items) -> DataFrame:
        def job(batches):
            for batch in batches:
                for a, b in _packs(batch.column(1)):
                    ids = batch.column(0).slice(a, b - a).to_pylist()
                    texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                    rows = []
                    for i, x, edits, first, stop in items.find(texts):
                        spans = [m.span() for m in _WORD.finditer(texts[i])]
                        lo, hi = spans[first][0], spans[stop - 1][1]
                        part = len(items.words[x]), edits, lo, hi, texts[i][lo:hi]
                        rows += [(ids[i], item, *part) for item in items.ids[x]]
                    yield dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

        return by_arrow(docs.select("doc_id", "text"), schema, job)

    schema = (
        "doc_id bigint, item_id bigint, item_words bigint, edits bigint, "
        "first bigint, stop bigint, passage string"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    found = [
        search(items) if last else kept(search(items), "finds")
        for items, last in item_blocks(benchmark, max_edits)
    ]
    return reduce(DataFrame.unionByName, found)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS
) -> DataFrame:
    """The documents, all their columns, in which :func:`contaminations` finds nothing.

    Null and empty texts, and repeated rows, stay as they are; an empty table of
    documents or items takes nothing away. A benchmark of several blocks writes the
    documents left after each but the last.
    """
    at = docs.columns.index("text")

    def without(rows: DataFrame, items: Items) -> DataFrame:
        def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in _packs(batch.column(at)):
                    part = batch.slice(a, b - a)
                    texts = [t or "" for t in part.column(at).to_pylist()]
                    clean = np.ones(len(texts), bool)
                    for i, *_ in items.find(texts):
                        clean[i] = False
                    yield part.filter(pa.array(clean))

        return rows.mapInArrow(job, rows.schema)

    for items, last in item_blocks(benchmark, max_edits):
        docs = without(docs, items) if last else kept(without(docs, items), "clean")
    return docs
