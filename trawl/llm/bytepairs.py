"""Byte-level BPE over a table of ranks: each distinct word of the corpus is encoded once."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.packing import BLOCK_BYTES, block_numbers, packed, ranges, unpacked
from trawl.session import bucketed

#: Words of a text that are cut out at once, so that a long text needs no list of all.
WORDS_AT_ONCE = 1 << 16
#: Texts of a block that stay together, and the code points they may have.
PACK_CHARS = 1 << 20
#: Bytes of all texts for each part of the corpus's words. A part is one task's
#: dictionary, so the number of parts grows with the texts.
BYTES_PER_PART = 16 << 20
ENCODED = "doc_id bigint, ids array<int>"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes of each token and its rank, which is its id, from a file of base64 lines."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: of its neighbouring parts the pair of lowest rank is joined, again and again.

    The leftmost comes first of equal ones. A heap holds the pairs, so that a
    word of any length takes n log n steps.
    """
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0 if none does
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        if (rank := ranks.get(word[i : i + 2])) is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of its parts has grown or gone since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if (left := before[i]) >= 0 and (rank := ranks.get(word[left:stop])) is not None:
            heapq.heappush(heap, (rank, left, stop))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


class _Codes(dict):
    """Numbers for words, in the order they come."""

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


class _Block:
    """Texts as numbers of their words, and the words they share."""

    def __init__(self, number: int, parts: int) -> None:
        self.number, self.parts = number, parts
        self.bytes = self.chars = 0
        self.codes = _Codes()
        self.ids: list = []
        self.texts: list[np.ndarray] = []
        self.rows: list[dict] = []

    def add(self, doc_id, text: str, words) -> None:
        pieces, found = [], words.finditer(text)
        if len(text) <= WORDS_AT_ONCE:
            pieces.append(words.findall(text))
        else:
            while piece := [m[0] for m in islice(found, WORDS_AT_ONCE)]:
                pieces.append(piece)
        numbers = [np.fromiter(map(self.codes.__getitem__, p), np.uint32, len(p)) for p in pieces]
        self.ids.append(doc_id)
        self.texts.append(np.concatenate(numbers) if numbers else np.zeros(0, np.uint32))
        self.bytes += len(text.encode("utf-8", "surrogatepass"))
        self.chars += len(text)
        if self.chars >= PACK_CHARS:
            self.pack()

    def pack(self) -> None:
        if self.ids:
            counts = [len(t) for t in self.texts]
            self.rows.append({
                "block": self.number, "part": None, "doc_ids": self.ids, "counts": counts,
                "codes": packed(np.concatenate(self.texts)), "words": None, "lengths": None,
            })
        self.ids, self.texts, self.chars = [], [], 0

    def done(self) -> Iterator[dict]:
        """A row for each pack of texts, and one for each part of the words."""
        self.pack()
        yield from self.rows
        words = [w.encode("utf-8", "surrogatepass") for w in self.codes]
        part = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        part = (part % np.uint64(self.parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.diff(part[order], prepend=-1))
        for at, codes in zip(starts.tolist(), np.split(order, starts[1:]) if len(starts) else ()):
            mine = [words[i] for i in codes]
            yield {
                "block": self.number, "part": int(part[order[at]]), "doc_ids": None,
                "counts": [len(mine)], "codes": packed(np.diff(codes, prepend=0)),
                "words": pa.compress(b"".join(mine), codec="zstd", asbytes=True),
                "lengths": packed(np.fromiter(map(len, mine), np.uint32, len(mine))),
            }


_BLOCKS = pa.schema([
    ("block", pa.int64()), ("part", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int32())), ("codes", pa.binary()), ("words", pa.binary()), ("lengths", pa.binary()),
])


def _blocks(docs: DataFrame, pattern: str, parts: int) -> DataFrame:
    """Texts cut into words: packs of texts as word numbers, and each block's words by part."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        # white space by its Unicode property; \s has four control characters more
        words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        numbers = block_numbers()
        block = _Block(next(numbers), parts)
        for batch in batches:
            for i in range(batch.num_rows):
                block.add(batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or "", words)
                if block.bytes >= BLOCK_BYTES:
                    yield from (pa.RecordBatch.from_pylist([r], _BLOCKS) for r in block.done())
                    block = _Block(next(numbers), parts)
        yield from (pa.RecordBatch.from_pylist([r], _BLOCKS) for r in block.done())

    schema = (
        "block bigint, part bigint, doc_ids array<bigint>, counts array<int>, codes binary,"
        " words binary, lengths binary"
    )
    return docs.select("doc_id", "text").mapInArrow(job, schema)


_IDS = pa.schema([
    ("block", pa.int64()), ("n", pa.int32()), ("codes", pa.binary()), ("total", pa.int32()),
    ("ids", pa.binary()), ("sizes", pa.binary()),
])


def _encoded_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Ids of the words of each block; a word lies in one part and is encoded once there."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, known = row["part"], {}
                (n,) = row["counts"]
                lengths = unpacked(row["lengths"], n)
                data = pa.decompress(row["words"], decompressed_size=int(lengths.sum()), codec="zstd", asbytes=True)
                ids, at = [], 0
                for length in lengths.tolist():
                    word = data[at : at + length]
                    at += length
                    if (found := known.get(word)) is None:
                        found = known[word] = encode_word(word, ranks)
                    ids.append(found)
                flat = np.fromiter((i for found in ids for i in found), np.uint32)
                yield pa.RecordBatch.from_pylist([{
                    "block": row["block"], "n": n, "codes": row["codes"], "total": len(flat),
                    "ids": packed(flat), "sizes": packed(np.fromiter(map(len, ids), np.uint32, n)),
                }], _IDS)

    schema = "block bigint, n int, codes binary, total int, ids binary, sizes binary"
    dealt = words.select("block", "part", "counts", "codes", "words", "lengths").repartition("part")
    return dealt.sortWithinPartitions("part").mapInArrow(job, schema)


def _reassembled(texts: pa.Table, words: pa.Table) -> Iterator[pa.Table]:
    """Ids of the texts of a block, from its words' numbers and ids, a pack at a time."""
    parts = words.to_pylist()
    codes = [np.cumsum(unpacked(p["codes"], p["n"]), dtype=np.uint32).astype(np.int64) for p in parts]
    sizes = [unpacked(p["sizes"], p["n"]).astype(np.int64) for p in parts]
    flat = np.concatenate([unpacked(p["ids"], p["total"]) for p in parts] or [np.zeros(0, np.uint32)])
    code = np.concatenate(codes or [np.zeros(0, np.int64)])
    size = np.zeros(len(code), np.int64)
    first = np.zeros(len(code), np.int64)
    size[code] = np.concatenate(sizes or [np.zeros(0, np.int64)])
    in_order = size[code]
    first[code] = np.cumsum(in_order) - in_order
    for row in texts.to_pylist():
        counts = np.array(row["counts"], np.int64)
        numbers = unpacked(row["codes"], int(counts.sum()))
        lengths = size[numbers]
        values = flat[ranges(first[numbers], lengths)].view(np.int32)
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(counts))]
        ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))
        yield pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "ids": ids})


def encoded(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    then: Callable[[pa.Table], pa.Table] | None = None,
    schema: str = ENCODED,
) -> DataFrame:
    """Ids of every whole text: doc_id, ids.

    ``pattern`` cuts a text into words, in the syntax of the ``regex`` library, and
    each word is encoded by ``ranks`` on its own (:func:`encode_word`). No token is
    special.

    A task replaces the words of a block of texts by numbers. The blocks' words
    meet by word in one shuffle, where each distinct word of the corpus is encoded
    once; their ids go back to the blocks, whose texts are put together by
    position. A word is moved once per block, however often it occurs, so none is
    hot, and a task's dictionary is bounded as the number of its parts grows
    with the texts (``BYTES_PER_PART``).

    ``then`` turns tables of doc_id and ids into tables of ``schema`` where they are
    made, so that what only needs a figure of the ids does not send them on.

    Null and empty texts have no ids. A repeated row, with or without doc_id, gives a
    repeated row; an empty table gives none; other columns are not read. A text
    longer than ``BLOCK_BYTES`` is a block of its own.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    table = bucketed(_blocks(docs, pattern, 1 + size // BYTES_PER_PART), "blocks", ["block"])
    texts = table.where("doc_ids IS NOT NULL").select("block", "doc_ids", "counts", "codes")
    words = _encoded_words(table.where("part IS NOT NULL"), ranks)
    kinds = docs.sparkSession.createDataFrame([], schema).schema

    def finish(texts: pa.Table, words: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(kinds)
        done = [t if then is None else then(t) for t in _reassembled(texts, words)]
        return pa.concat_tables([t.select(wanted.names).cast(wanted) for t in done] or [wanted.empty_table()])

    return texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(finish, schema)


def token_bytes(ranks: dict[bytes, int]) -> pa.Array:
    """The token-byte table: bytes by id, null for an id that no token has."""
    table: list[bytes | None] = [None] * (1 + max(ranks.values(), default=-1))
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def _stops(rows: pa.Array) -> np.ndarray:
    """Where the values of each list start and stop in all of them."""
    return np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)))


def _cut(data, ends: np.ndarray, rows: pa.Array) -> list[bytes | None]:
    data, edges = memoryview(data), ends.tolist()
    alive = rows.is_valid().to_pylist()
    return [bytes(data[a:b]) if ok else None for a, b, ok in zip(edges, edges[1:], alive)]


def token_texts(rows: pa.Array, table: pa.Array) -> list[bytes | None]:
    """What each list of ids stands for: ids joined to :func:`token_bytes`, all at once."""
    found = table.take(rows.flatten())
    if found.null_count:
        raise ValueError("an id is not in the vocabulary")
    _, offsets, data = found.buffers()
    return _cut(data or b"", np.frombuffer(offsets, np.int64, len(found) + 1)[_stops(rows)], rows)


def id_bytes(rows: pa.Array) -> list[bytes | None]:
    """Each list of ids as unsigned 32-bit integers, low byte first."""
    data = rows.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
    return _cut(data, 4 * _stops(rows), rows)


def decoded(ids: Column | str, ranks: dict[bytes, int]) -> Column:
    """Bytes that a column of id arrays stands for.

    Each id is joined to its row of the token-byte table, which is as long as the
    vocabulary and goes along with the tasks; a batch's ids are joined in one step. Null
    ids give null, no ids empty bytes; an id without a token is an error.
    """
    table = token_bytes(ranks)

    @F.arrow_udf("binary")
    def join(rows: pa.Array) -> pa.Array:
        return pa.array(token_texts(rows, table), pa.binary())

    return join(ids)


def digests(ranks: dict[bytes, int]) -> Callable[[pa.Table], pa.Table]:
    """For ``then`` of :func:`encoded`: counts, and SHA-256 of the ids and of what they decode to."""
    table = token_bytes(ranks)

    def of(rows: pa.Table) -> pa.Table:
        ids = rows["ids"].combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        return pa.table({
            "doc_id": rows["doc_id"],
            "n_tokens": pc.list_value_length(ids).cast(pa.int64()),
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in id_bytes(ids)],
            "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in token_texts(ids, table)],
        })

    return of
