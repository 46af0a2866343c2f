"""Language ID: a bidirectional gated recurrent network over bytes, written in numpy."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import by_arrow, fresh

UNKNOWN = "und"
WINDOW = 64
HIDDEN = 12
#: Bound of the training sample: passages of each language, and their length.
PER_LANGUAGE = 400
PASSAGE_CHARS = 384
MAX_LANGUAGES = 1_000
#: Windows that are run side by side.
SIDE_BY_SIDE = 4096
MIN_SCORE = 0.4
# numbers such as ½ or Ⅷ are word characters too, so the rest is settled by category
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a text holds a letter: a code point of Unicode category L."""
    return any(unicodedata.category(m[0])[0] == "L" for m in _MAYBE_LETTER.finditer(text or ""))


def held_out(doc_id: Column | str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    code = F.crc32(F.col(doc_id).cast("string")) if isinstance(doc_id, str) else F.crc32(doc_id.cast("string"))
    return F.coalesce(code % 4 == 2, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """A gated recurrent layer over bytes; arrays have a column per window.

    ``table`` holds what a byte adds to the three gates (update, reset, new) and
    ``turn`` what the state before adds.
    """

    table: np.ndarray  # 3H x 256
    turn: np.ndarray  # 3H x H

    def states(self, codes: np.ndarray, real: np.ndarray) -> np.ndarray:
        """The states of :meth:`run` alone, in arrays that are used again at every step.

        Halving what goes into the first two gates makes each sigmoid a tanh.
        """
        size = self.turn.shape[1]
        half = np.repeat(np.array([0.5, 1], np.float32), [2 * size, size])[:, None]
        table, turn = self.table * half, self.turn * half
        steps, width = codes.shape
        at = codes.astype(np.intp)
        x, y = (np.empty((3 * size, width), np.float32) for _ in range(2))
        gates, new = x[: 2 * size], y[2 * size :]
        state = np.zeros((size, width), np.float32)
        out = np.empty((steps, size, width), np.float32)
        for t in range(steps):
            np.take(table, at[t], axis=1, out=x, mode="clip")
            np.matmul(turn, state, out=y)
            gates += y[: 2 * size]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            new *= gates[size:]
            new += x[2 * size :]
            np.tanh(new, out=new)
            state -= new
            state *= gates[:size]
            state += new
            state *= real[t]
            out[t] = state
        return out

    def run(self, codes: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, list]:
        """States (T, H, N) for codes and mask (T, N), first to last; and the gates."""
        size = self.turn.shape[1]
        steps, width = codes.shape
        state = np.zeros((size, width), np.float32)
        out, trace = np.empty((steps, size, width), np.float32), []
        for t in range(steps):
            x = self.table[:, codes[t]]
            y = self.turn @ state
            both = _sigmoid(x[: 2 * size] + y[: 2 * size])
            update, reset = both[:size], both[size:]
            new = np.tanh(x[2 * size :] + reset * y[2 * size :])
            before = state
            state = (new + update * (before - new)) * real[t]
            out[t] = state
            trace.append((before, update, reset, new, y[2 * size :]))
        return out, trace

    def back(
        self, codes: np.ndarray, real: np.ndarray, trace: list, wanted: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and turn by backpropagation through time."""
        size = self.turn.shape[1]
        d_table, d_turn = np.zeros_like(self.table), np.zeros_like(self.turn)
        carry = np.zeros_like(wanted[0])
        for t in range(len(codes) - 1, -1, -1):
            before, update, reset, new, inner = trace[t]
            d = (wanted[t] + carry) * real[t]
            d_new = d * (1 - update) * (1 - new * new)
            d_update = d * (before - new) * update * (1 - update)
            d_reset = d_new * inner * reset * (1 - reset)
            d_x = np.concatenate([d_update, d_reset, d_new])
            d_y = np.concatenate([d_update, d_reset, d_new * reset])
            carry = d * update + self.turn.T @ d_y
            d_turn += d_y @ before.T
            np.add.at(d_table.T, codes[t], d_x.T)
        return d_table, d_turn


@dataclass
class Network:
    """Labels every position of a window by the states of both directions."""

    languages: list[str]
    ahead: Direction
    behind: Direction
    out: np.ndarray  # L x 2H
    bias: np.ndarray  # L x 1

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
        def some(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        ahead, behind = (
            Direction(some(3 * hidden, 256, scale=0.4), some(3 * hidden, hidden, scale=1 / math.sqrt(hidden)))
            for _ in range(2)
        )
        count = len(languages)
        out = some(count, 2 * hidden, scale=0.3)
        return cls(languages, ahead, behind, out, np.zeros((count, 1), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.table, self.ahead.turn, self.behind.table, self.behind.turn, self.out, self.bias]

    def labels(self, codes: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Probabilities (T, L, N) of each position."""
        left = self.ahead.states(codes, real)
        right = self.behind.states(codes[::-1], real[::-1])
        return self._softmax(left, right[::-1])

    def _softmax(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        half = left.shape[1]
        logits = self.out[:, :half] @ left
        logits += self.out[:, half:] @ right
        logits += self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, real: np.ndarray, answer: np.ndarray) -> list[np.ndarray]:
        ahead_states, left = self.ahead.run(codes, real)
        behind_states, right = self.behind.run(codes[::-1], real[::-1])
        states = np.concatenate([ahead_states, behind_states[::-1]], axis=1)
        error = self._softmax(ahead_states, behind_states[::-1])
        error[:, answer, np.arange(len(answer))] -= 1
        error *= real[:, None, :] / real.sum()
        d_states = np.swapaxes(np.tensordot(self.out, error, axes=([0], [1])), 0, 1)
        half = self.ahead.turn.shape[1]
        ahead = self.ahead.back(codes, real, left, d_states[:, :half])
        behind = self.behind.back(codes[::-1], real[::-1], right, d_states[::-1, half:])
        d_out = np.einsum("tln,thn->lh", error, states, optimize=True)
        return [*ahead, *behind, d_out, error.sum(axis=(0, 2))[:, None]]


def windows(text: bytes, length: int = WINDOW) -> np.ndarray:
    """All bytes of a text in rows of ``length``, the last one filled up with zeros."""
    rows = -(-len(text) // length)
    out = np.zeros(rows * length, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(rows, length)


def train(
    passages: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = 260, seed: int = 42
) -> Network:
    """Fit a network to (language, passage) pairs by Adam on random windows.

    Languages have equal shares of a batch, so a frequent one has no advantage.
    """
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in passages})
    pools = []
    for lang in languages:
        texts = [t.encode("utf-8", "ignore") for at, t in passages if at == lang and t]
        pools.append(np.concatenate([windows(t) for t in texts] or [np.zeros((1, WINDOW), np.uint8)]))
    net = Network.fresh(languages, hidden, rng)
    share = max(8, 192 // len(languages))
    answer = np.repeat(np.arange(len(languages)), share)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, steps + 1):
        codes = np.concatenate([p[rng.integers(len(p), size=share)] for p in pools]).T
        real = (codes != 0).astype(np.float32)
        rate = 0.02 * (1 - step / (steps + 1))
        for w, g, m, v in zip(net.weights(), net.gradients(codes, real, answer), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def training_passages(
    docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 42
) -> list[tuple[str, str]]:
    """A passage of about ``per_language`` documents of each language.

    Only documents that are not held out and have a language and a text. Which
    ones, and where the passage starts, is decided by a hash of the doc_id.
    """
    able = docs.select("doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & ~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = able.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return []
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wanted = F.lit(False)
    for lang, count in counts:
        wanted |= (F.col("lang") == lang) & (draw < per_language / count)
    start = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.greatest(F.length("text") - PASSAGE_CHARS, F.lit(1)))
    rows = able.where(wanted).select(
        "lang", "doc_id", F.substring("text", start.cast("int") + 1, F.lit(PASSAGE_CHARS)).alias("passage")
    ).limit(2 * per_language * len(counts) + 1000).collect()
    return [(r["lang"], r["passage"]) for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["passage"]))]


def _pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probability of each language over all positions of each text (N, L)."""
    total = np.zeros((len(texts), len(net.languages)))
    waiting: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def flush() -> None:
        codes = np.concatenate(waiting).T
        owner = np.concatenate(owners)
        waiting.clear()
        owners.clear()
        real = (codes != 0).astype(np.float32)
        found = net.labels(codes, real)
        sums = np.einsum("tln,tn->nl", found, real)
        for i in range(sums.shape[1]):
            total[:, i] += np.bincount(owner, sums[:, i], len(texts))

    held = 0
    for i, text in enumerate(texts):
        rows = windows(text)
        for a in range(0, len(rows), SIDE_BY_SIDE):
            part = rows[a : a + SIDE_BY_SIDE]
            if held + len(part) > SIDE_BY_SIDE:
                flush()
                held = 0
            waiting.append(part)
            owners.append(np.full(len(part), i))
            held += len(part)
    if held:
        flush()
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-9)


def _predictions(net: Network | None, texts: list[str | None]) -> Iterator[tuple[str, float]]:
    lettered = [has_letter(t) for t in texts]
    data = [t.encode("utf-8", "ignore") for t, ok in zip(texts, lettered) if ok]
    pooled = iter(_pooled(net, data) if net and data else ())
    for ok in lettered:
        if not ok or net is None:
            yield UNKNOWN, 0.0
        else:
            row = next(pooled)
            best = int(row.argmax())
            yield net.languages[best], float(row[best])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network trained on a bounded sample; None if no document has a language."""
    passages = training_passages(docs, per_language)
    return train(passages) if passages else None


def predicted(docs: DataFrame, net: Network | None) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` behind them.

    Every byte of every text is labelled; the score is the mean probability of
    the chosen language. Null texts, and texts without a letter, are ``und`` with
    score 0. The new columns have ``_`` behind their names if ``docs`` has them.
    """
    names = [fresh(docs, "lang_pred"), fresh(docs, "score")]
    columns = docs.columns
    at = columns.index("text")

    def job(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = [p for i in range(0, len(texts), 512) for p in _predictions(net, texts[i : i + 512])]
            yield {
                **{c: batch.column(i) for i, c in enumerate(columns)},
                names[0]: [lang for lang, _ in found],
                names[1]: [score for _, score in found],
            }

    new = docs.limit(0).select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.fields)
    return by_arrow(docs, schema, job)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Learned from the texts and languages of documents that are not held out; a
    prediction sees the text alone. Repeated rows give repeated rows; rows with
    a null doc_id are predicted, not learned from; an empty table gives no rows.
    """
    return predicted(docs.select("doc_id", "text"), fit(docs, per_language)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents whose language the network knows, with the columns of ``docs``.

    Rejected are texts without a letter and those whose best language has a
    mean probability under ``min_score``.
    """
    found = predicted(docs, fit(docs))
    lang, score = found.columns[-2:]
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
