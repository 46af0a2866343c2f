"""Document fingerprints: a homomorphic hash of the multiset of paragraphs."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import WordHashes, by_arrow, lower_words, mixed, shingles
from trawl.llm.ranges import by_range, key_ranges, placed

EXACT_LANES = 4
NEAR_LANES = 128
NEAR_WORDS = 3
_LOWEST = -(2**63)


class Fingerprint:
    """Sums over paragraphs of vectors hashed from them.

    Four lanes modulo 2**64 hold 256 bits of each paragraph's digest: equal
    multisets of paragraphs have equal sums in any order, others in practice
    never. 128 lanes modulo 2**32 hold +1 or -1 per run of three words inside a
    paragraph; the distance of two such sums estimates how many runs differ.
    Paragraphs can be added and taken away in any order.
    """

    def __init__(self, exact: np.ndarray | None = None, near: np.ndarray | None = None):
        self.exact = np.zeros(EXACT_LANES, np.uint64) if exact is None else exact
        self.near = np.zeros(NEAR_LANES, np.int32) if near is None else near

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.near + other.near)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.near - other.near)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.encoded() == other.encoded()

    def encoded(self) -> str:
        data = self.exact.astype("<u8").tobytes() + self.near.astype("<i4").tobytes()
        return base64.b64encode(data).decode()

    @classmethod
    def decoded(cls, value: str) -> Fingerprint:
        data = base64.b64decode(value)
        split = EXACT_LANES * 8
        return cls(
            np.frombuffer(data[:split], "<u8").astype(np.uint64),
            np.frombuffer(data[split:], "<i4").astype(np.int32),
        )

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal multisets, about 0 for unrelated ones.

        An estimate of 2ab / (a² + b²) over the counts of word runs, with a
        standard error of about 0.1.
        """
        if np.array_equal(self.exact, other.exact) and np.array_equal(self.near, other.near):
            return 1.0
        a, b = self.near.astype(np.float64), other.near.astype(np.float64)
        both = a @ a + b @ b
        return min(1.0, max(0.0, 2.0 * (a @ b) / both)) if both else 0.0


def paragraphs(text: str | None) -> list[str]:
    """What line feeds separate; an empty or null text has no paragraph."""
    return text.split("\n") if text else []


def fingerprint(parts: Iterable[str], hashes: WordHashes) -> Fingerprint:
    out = Fingerprint()
    runs = []
    for part, times in Counter(parts).items():
        digest = hashlib.blake2b(part.encode("utf-8", "surrogatepass"), digest_size=32).digest()
        out.exact += np.frombuffer(digest, "<u8") * np.uint64(times)
        found = shingles(hashes.of(lower_words(part)), NEAR_WORDS)
        runs += [found] * times
    if runs and len(every := np.concatenate(runs)):
        # in pieces, so that a long text needs no more memory than a short one
        for i in range(0, len(every), 1 << 14):
            piece = every[i : i + (1 << 14)]
            bits = np.stack([mixed(piece, 1), mixed(piece, 2)], axis=1).view(np.uint8)
            ones = np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
            out.near += (2 * ones - len(piece)).astype(np.int32)
    return out


def edited(before: Fingerprint, old: str, new: str, hashes: WordHashes) -> Fingerprint:
    """The fingerprint of ``new`` from that of ``old``: only what changed is hashed."""
    gone, come = Counter(paragraphs(old)), Counter(paragraphs(new))
    return (
        before
        - fingerprint((gone - come).elements(), hashes)
        + fingerprint((come - gone).elements(), hashes)
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every text, row by row.

    Null and empty texts have the fingerprint of no paragraph.
    """

    def job(batches):
        hashes = WordHashes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield {
                "doc_id": batch.column(0),
                "n_chars": [len(t) for t in texts],
                "fingerprint": [fingerprint(paragraphs(t), hashes).encoded() for t in texts],
            }

    schema = "doc_id bigint, n_chars bigint, fingerprint string"
    return by_arrow(docs.select("doc_id", "text"), schema, job)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against those of an edited text and of the next document.

    The edited text has the last floor(n/3) code points replaced by the first as
    many (or all) of the next document, by descending doc_id, after the last the
    first. Texts move once, dealt by ranges of doc_id. Rows of one doc_id follow
    by a hash of their text; null ids come last; a null text is empty; a
    document alone is its own next one. Columns other than doc_id and text are
    not read.
    """
    keys = [F.coalesce("doc_id", F.lit(_LOWEST)), F.xxhash64("text")]
    slim = docs.select("doc_id", "text")
    ranges = key_ranges(slim, keys)
    around = placed(slim, keys, ranges, below=False, above=True, wrap=True)
    dealt = around.select(
        "doc_id", "text", F.col("at.range").alias("range"), F.col("at.role").alias("role"),
        keys[0].alias("k0"), keys[1].alias("k1"),
    )
    # what follows a range from outside, role -1, stands behind its own rows
    ordered = by_range(dealt, ranges, F.desc("role"), F.desc("k0"), F.desc("k1")).select(
        "doc_id", "text", "range", "role"
    )

    def job(batches):
        hashes = WordHashes()
        held = None
        for batch in batches:
            out = {n: [] for n in names}
            for doc_id, text, part, role in zip(*[c.to_pylist() for c in batch.columns]):
                text = text or ""
                if held is not None and held[2] != part:
                    held = None
                if held is None and role < 0:
                    continue
                mark = fingerprint(paragraphs(text), hashes)
                if held is not None:
                    was_id, was, _, was_mark = held
                    cut = len(was) // 3
                    new = was[: len(was) - cut] + text[:cut]
                    new_mark = edited(was_mark, was, new, hashes)
                    digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    for n, v in zip(names, (
                        was_id, len(was), digest, was_mark.encoded(), new_mark.encoded(),
                        was_mark.likeness(new_mark), was_mark.likeness(mark),
                    )):
                        out[n].append(v)
                held = (doc_id, text, part, mark) if role == 0 else None
            yield out

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    return by_arrow(ordered, schema, job)
