"""Token counts of whole texts by a public tokenizer, without keeping tokens."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from trawl.llm.common import by_arrow

BATCH_BYTES = 4 << 20
LONG_CHARS = 1 << 18

#: Fixed values of the byte-level scheme: how it cuts a text into words.
BYTE_LEVEL_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: A byte-level vocabulary never joins a visible character to a blank and the
#: visible character after it, so a text may be cut before that blank.
_CUT = re.compile(r"(?<=[\w!-~])(?=[ \n][\w!-~])")


def _byte_of_letter() -> dict[str, int]:
    """Bytes that are not printable Latin-1 are written as letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked(spec: dict):
    """The vocabulary as a rank encoder, if its merges stand in rank order; else None.

    It encodes a text several times as fast. Anything in the file beyond plain
    byte-level merges and plain special tokens leaves the work to ``tokenizers``.
    """
    import tiktoken

    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens", [])
    plain = (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "unk_token", "ignore_merges"))
        and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip"))
    )
    vocabulary, letters = model["vocab"], _byte_of_letter()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if not plain or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    special = {a["content"]: a["id"] for a in added}
    ranks = {
        bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special
    }
    return tiktoken.Encoding(
        "ranked", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens=special
    )


@functools.lru_cache(maxsize=2)
def _bpe(spec: str) -> Callable[[list[str]], list[int]]:
    from tokenizers import Tokenizer

    tokenizer, ranked = Tokenizer.from_str(spec), _ranked(json.loads(spec))

    def exact(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def lengths(texts: list[str]) -> list[int]:
        if ranked is None:
            return exact(texts)
        out = []
        for text in texts:
            try:
                out.append(len(ranked.encode_to_numpy(text, allowed_special="all")))
            except Exception:  # its pattern engine gives up on some endless runs of blanks
                out += exact([text])
        return out

    return lengths


@functools.lru_cache(maxsize=2)
def _pieces(model: bytes) -> Callable[[list[str]], list[int]]:
    from sentencepiece import SentencePieceProcessor

    encoder = SentencePieceProcessor(model_proto=model)
    return lambda texts: [len(x) for x in encoder.encode(texts, num_threads=1)]


def _safe_parts(text: str) -> list[str]:
    """A long text cut where no token crosses, into parts of about ``LONG_CHARS``."""
    parts, start = [], 0
    while len(text) - start > LONG_CHARS:
        cut = _CUT.search(text, start + LONG_CHARS)
        if cut is None:
            break
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def _packs(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """Tokens of every text: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is a file of the ``tokenizers`` library (``.json``, byte-level)
    or of ``sentencepiece`` (``.model``). It is read once by the driver and sent
    along with the job. Counts are what the library gives for the whole text
    without added special tokens. Texts are packed by bytes, and a long one is
    cut where the vocabulary cannot join the two sides.

    A null text counts as empty; a repeated row gives a repeated row; columns
    other than doc_id and text are not read.
    """
    data = Path(tokenizer).read_bytes()
    is_bpe = not tokenizer.endswith(".model")
    spec = data.decode() if is_bpe else data

    def job(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        lengths = _bpe(spec) if is_bpe else _pieces(spec)
        for batch in batches:
            texts = batch.column(1)
            for start, stop in _packs(texts, BATCH_BYTES):
                part = texts.slice(start, stop - start)
                values = [t or "" for t in part.to_pylist()]
                if is_bpe:
                    cut = [_safe_parts(t) for t in values]
                    each = iter(lengths([p for parts in cut for p in parts]))
                    counts = [sum(next(each) for _ in parts) for parts in cut]
                else:
                    counts = lengths(values)
                yield {
                    "doc_id": batch.column(0).slice(start, stop - start),
                    "n_bytes": pc.fill_null(pc.binary_length(part), 0),
                    "n_tokens": counts,
                    "over_limit": [n > limit for n in counts],
                }

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return by_arrow(docs.select("doc_id", "text"), schema, job)
