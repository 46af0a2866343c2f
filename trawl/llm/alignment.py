"""Two tokenizers' tokens of the same texts, aligned by bytes, and how often ids meet."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ROWS_AT_ONCE, kept
from trawl.llm.packing import BLOCK_BYTES, block_numbers, packed, unpacked
from trawl.llm.tokens import _byte_of_letter, _ranked
from trawl.session import bucketed

#: Bytes of text that are aligned at once; a longer text is aligned alone.
BATCH_BYTES = 1 << 20
#: An id pair as one number.
_SHIFT = 32
#: Fixed value: how the piece vocabulary writes a space.
_SPACE = "▁"


@dataclass
class Tokenizer:
    """Ids of texts, and the bytes of each id."""

    encode: Callable[[list[str]], list[Sequence[int]]]
    table: pa.Array
    sizes: np.ndarray

    @classmethod
    def of(cls, encode, table: list[bytes]) -> Tokenizer:
        return cls(encode, pa.array(table, pa.large_binary()), np.array([len(t) for t in table], np.int64))


@functools.lru_cache(maxsize=2)
def byte_tokenizer(spec: str) -> Tokenizer:
    """A byte-level file of the ``tokenizers`` library; special strings are plain text to it."""
    import tokenizers

    parsed = json.loads(spec)
    library, ranked = tokenizers.Tokenizer.from_str(spec), _ranked(parsed)
    library.encode_special_tokens = True
    letters = _byte_of_letter()
    table = [b""] * library.get_vocab_size()
    for token, i in parsed["model"]["vocab"].items():
        table[i] = bytes(letters[c] for c in token) if set(token) <= letters.keys() else token.encode()

    def exact(text: str) -> list[int]:
        return library.encode(text, add_special_tokens=False).ids

    def one(text: str) -> Sequence[int]:
        if ranked is None:
            return exact(text)
        try:
            return ranked.encode_to_numpy(text, disallowed_special=())
        except Exception:  # its pattern engine gives up on some endless runs of blanks
            return exact(text)

    return Tokenizer.of(lambda texts: [one(t) for t in texts], table)


@functools.lru_cache(maxsize=2)
def piece_tokenizer(model: bytes) -> Tokenizer:
    """A file of ``sentencepiece``, with byte pieces as their byte."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_proto=model)

    def piece(i: int) -> bytes:
        text = library.id_to_piece(i)
        if library.is_byte(i):
            return bytes([int(text[3:5], 16)])
        return text.replace(_SPACE, " ").encode()

    table = [piece(i) for i in range(library.get_piece_size())]
    return Tokenizer.of(lambda texts: library.encode(texts, num_threads=1), table)


def load(path: str) -> tuple[bool, str | bytes]:
    """A tokenizer file's kind and contents, read by the driver."""
    data = Path(path).read_bytes()
    return (False, data) if path.endswith(".model") else (True, data.decode())


def _tokenizer(loaded: tuple[bool, str | bytes]) -> Tokenizer:
    is_bytes, data = loaded
    return byte_tokenizer(data) if is_bytes else piece_tokenizer(data)


def _joined(tokens: Tokenizer, ids: Sequence[int]) -> bytes:
    found = tokens.table.take(pa.array(np.asarray(ids, np.int64)))
    _, offsets, data = found.buffers()
    return bytes(memoryview(data)[: np.frombuffer(offsets, np.int64, len(found) + 1)[-1]]) if data else b""


def _frame(ids: list[Sequence[int]], sizes: np.ndarray) -> pd.DataFrame:
    """Tokens of the texts of a batch, laid end to end: doc, id, at (first byte), end, place."""
    flat = np.concatenate([np.asarray(i, np.int64) for i in ids] or [np.zeros(0, np.int64)])
    end = np.cumsum(sizes[flat])
    return pd.DataFrame({
        "doc": np.repeat(np.arange(len(ids)), [len(i) for i in ids]), "id": flat,
        "at": end - sizes[flat], "end": end, "place": np.arange(len(flat)),
    })


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of tokens that share bytes: doc, a, b (places).

    The token that covers a start is the last one of the other side that does not
    start after it. Of two tokens that overlap, the one that starts later starts
    inside the other, so both directions together have every pair; pairs with
    one start have been found from both sides and count once.
    """
    kept_columns = ["doc", "at", "place"]
    forth = pd.merge_asof(a[kept_columns], b.assign(start=b["at"])[["doc", "at", "place", "start"]],
                          on="at", by="doc", suffixes=("_a", "_b"))
    back = pd.merge_asof(b[kept_columns], a.assign(start=a["at"])[["doc", "at", "place", "start"]],
                         on="at", by="doc", suffixes=("_b", "_a"))
    both = pd.concat([forth, back[back["start"] != back["at"]]])
    return pd.DataFrame({"doc": both["doc"], "a": both["place_a"], "b": both["place_b"]}, dtype="int64")


def _groups(a: pd.DataFrame, b: pd.DataFrame, docs: int, names: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Number of groups of each text, and its groups as ``a1,a2|b1;a3|b2``."""
    ends_a, ends_b = a["end"].to_numpy(), b["end"].to_numpy()
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    n_groups = np.bincount(a["doc"].to_numpy()[np.append(group_a[1:] != group_a[:-1], True)], minlength=docs)
    # where each token stands when those of a group follow each other, a's first
    place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
    last_a = np.append(group_a[1:] != group_a[:-1], True)
    last_b = np.append(group_b[1:] != group_b[:-1], True)
    name = np.empty(len(a) + len(b), np.int64)
    name[place_a] = 3 * a["id"].to_numpy() + last_a
    name[place_b] = 3 * b["id"].to_numpy() + 2 * last_b
    text = names.take(pa.array(name))
    ends = np.append(0, np.cumsum(np.bincount(a["doc"], minlength=docs) + np.bincount(b["doc"], minlength=docs)))
    _, offsets, data = text.buffers()
    edges = np.frombuffer(offsets, np.int64, len(text) + 1)[ends].tolist()
    data = memoryview(data) if data else b""
    return n_groups, [str(data[x : max(x, y - 1)], "ascii") for x, y in zip(edges, edges[1:])]


class _Block:
    """Aligned texts of a block, and the distinct id pairs they link."""

    def __init__(self, number: int) -> None:
        self.number, self.bytes, self.docs = number, 0, 0
        self.columns: dict[str, list] = {n: [] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")}
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, doc_ids: list, texts: list[str | None], first: Tokenizer, second: Tokenizer, names: pa.Array) -> None:
        plain = [t or "" for t in texts]
        ids_a, ids_b = first.encode([" " + t for t in plain]), second.encode(plain)
        for i, text in enumerate(plain):
            target = b" " + text.encode("utf-8", "surrogatepass")
            if not text or _joined(first, ids_a[i]) != target or _joined(second, ids_b[i]) != target:
                ids_a[i], ids_b[i] = [], []
        a, b = _frame(ids_a, first.sizes), _frame(ids_b, second.sizes)
        links = overlaps(a, b)
        n_groups, groups = _groups(a, b, len(plain), names)
        pair = (a["id"].to_numpy()[links["a"]] << _SHIFT) | b["id"].to_numpy()[links["b"]]
        for doc in _by_doc(links["doc"].to_numpy(), pair, len(plain)):
            keys, times = np.unique(doc, return_counts=True)
            self.keys.append(keys)
            self.times.append(times)
        out = self.columns
        out["doc_id"] += doc_ids
        out["n_a"] += [len(i) for i in ids_a]
        out["n_b"] += [len(i) for i in ids_b]
        out["n_groups"] += n_groups.tolist()
        out["n_links"] += np.bincount(links["doc"], minlength=len(plain)).tolist()
        out["groups"] += groups
        self.bytes += sum(map(len, plain))

    def done(self) -> Iterator[pa.RecordBatch]:
        """A row per text, then a row per distinct pair."""
        n = len(self.keys)
        if n == 0:
            return
        pairs, codes = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = [len(k) for k in self.keys]
        total = np.bincount(codes, weights=np.concatenate(self.times), minlength=len(pairs)).astype(np.int64)
        each = np.split(codes, np.cumsum(counts)[:-1])
        for i in range(0, n, ROWS_AT_ONCE):
            part = slice(i, i + ROWS_AT_ONCE)
            rows = {c: v[part] for c, v in self.columns.items()} | {
                "distinct": counts[part],
                "codes": [packed(np.diff(c, prepend=0)) for c in each[part]],
                "times": [packed(t) for t in self.times[part]],
            }
            yield _batch(rows, self.number)
        for i in range(0, len(pairs), 1 << 16):
            part = slice(i, i + (1 << 16))
            code = np.arange(i, min(len(pairs), i + (1 << 16)))
            yield _batch({"code": code, "pair": pairs[part], "linked": total[part]}, self.number)


def _by_doc(doc: np.ndarray, values: np.ndarray, docs: int) -> list[np.ndarray]:
    order = np.argsort(doc, kind="stable")
    return np.split(values[order], np.cumsum(np.bincount(doc, minlength=docs))[:-1])


_ROWS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("distinct", pa.int32()),
    ("codes", pa.binary()), ("times", pa.binary()), ("code", pa.int32()), ("pair", pa.int64()), ("linked", pa.int64()),
])
_DDL = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string,"
    " distinct int, codes binary, times binary, code int, pair bigint, linked bigint"
)


def _batch(columns: dict, block: int) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    full = columns | {"block": [block] * n}
    return pa.RecordBatch.from_arrays(
        [pa.array(full[f.name], f.type) if f.name in full else pa.nulls(n, f.type) for f in _ROWS], schema=_ROWS
    )


def aligned(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Texts aligned in two tokenizers, and the id pairs of each block of texts.

    ``first`` (A) encodes a space and the text, ``second`` (B) the text, to which it adds
    that space; both are files, byte-level ``.json`` or ``.model``. Rows with ``n_a``
    are texts: doc_id, n_a, n_b, n_groups, n_links, groups (ids between
    common ends, ``a1,a2|b1;a3|b2``) and their distinct pairs by number. Rows with
    ``pair`` are the pairs of a block: code, pair (A's id << 32 | B's), linked.

    A text whose tokens' bytes differ from the space and itself on one side, or that is
    null or empty, has no tokens.
    """
    sides = load(first), load(second)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        one, two = _tokenizer(sides[0]), _tokenizer(sides[1])
        most = max(len(one.sizes), len(two.sizes))
        names = pa.array([f"{i}{end}" for i in range(most) for end in ",|;"], pa.large_string())
        numbers = block_numbers()
        block, ids, texts, size = _Block(next(numbers)), [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                if ids and size + len(text or "") > BATCH_BYTES:
                    block.add(ids, texts, one, two, names)
                    ids, texts, size = [], [], 0
                    if block.bytes >= BLOCK_BYTES:
                        yield from block.done()
                        block = _Block(next(numbers))
                ids.append(batch.column(0)[i].as_py())
                texts.append(text)
                size += len(text or "")
        if ids:
            block.add(ids, texts, one, two, names)
        yield from block.done()

    return docs.select("doc_id", "text").mapInArrow(job, _DDL)


def _summed(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """The sums over the links of each text of a block."""
    code = pairs["code"].to_numpy()
    count, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    count[code], best[code] = pairs["count"].to_numpy(), pairs["is_best"].to_numpy()
    sums: list[int] = []
    bests: list[int] = []
    columns = [texts[n].to_pylist() for n in ("distinct", "codes", "times")]
    for n, codes, times in zip(*columns):
        mine = np.cumsum(unpacked(codes, n), dtype=np.int64)
        times = unpacked(times, n).astype(np.int64)
        sums.append(int((count[mine] * times).sum()))
        bests.append(int((best[mine] * times).sum()))
    kept_columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return pa.table(
        {n: texts[n] for n in kept_columns}
        | {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    )


def link_counts(pairs: DataFrame) -> DataFrame:
    """How often each id pair is linked in the corpus: pair, count, is_best (0 or 1).

    ``is_best`` tells the pairs that have their B id's highest count, ties included.
    """
    counts = pairs.groupBy("pair").agg(F.sum("linked").alias("count"))
    counts = kept(counts.withColumn("b", F.col("pair").bitwiseAND((1 << _SHIFT) - 1)), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("is_best")
    )


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def align(docs: DataFrame, first: str, second: str, groups: Column | str = "groups") -> DataFrame:
    """Alignment of every whole text in two tokenizers, weighed by the corpus.

    Returns doc_id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum:
    of the pairs of tokens that share bytes, those whose id pair has the highest count of its
    B id, and the sum of their counts. ``groups`` is an expression of the groups
    string (:func:`aligned`), stored in its place.

    pandas.merge_asof aligns the tokens of a batch of texts, keyed by document. Links
    are counted per block of texts before anything is moved: what is shuffled are a
    block's distinct id pairs, to be summed, and to bring the sums back to the blocks.
    So no pair is hot, as it comes once per block at most.

    Null and empty texts have zeros; a repeated row, with or without doc_id, counts and
    returns each time; an empty table gives none; a text longer than ``BLOCK_BYTES`` is a
    block of its own; other columns are not read.
    """
    table = bucketed(aligned(docs, first, second).withColumn("groups", _column(groups)), "aligned", ["block"])
    pairs = table.where("pair IS NOT NULL").select("block", "code", "pair", "linked")
    counted = pairs.join(link_counts(pairs), "pair").select(
        F.col("block").alias("of_block"), "code", "count", "is_best"
    )
    texts = table.where("n_a IS NOT NULL").drop("code", "pair", "linked")
    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string,"
        " n_best bigint, count_sum bigint"
    )
    return texts.groupBy("block").cogroup(counted.groupBy("of_block")).applyInArrow(_summed, schema)
