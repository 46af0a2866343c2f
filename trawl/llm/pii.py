"""Personal data: patterns, and candidates selected by calibrated boosted trees."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.boosting import Boosted, calibrate, fit_boosted, threshold
from trawl.llm.common import by_arrow, fresh

KINDS = ("email", "ip", "card", "phone")
#: Bound of the sample of passages that training places examples in.
PASSAGES = 1_500
PASSAGE_CHARS = 300
PRECISION = 0.97
#: Candidates of one text that are scored together.
SCORED_AT_ONCE = 10_000

Span = tuple[str, int, int]

# -- base patterns. Possessive repeats and the look-behind keep them linear; a
# -- match cannot start inside a run of digits, as the one before would hold it.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """A place for each @: what may stand before it, back to the last match, and a domain."""
    end, at = 0, text.find("@")
    seen = 0
    while at >= 0:
        low = max(end, seen)
        start = low + len(text[low:at].rstrip(_LOCAL))
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield "email", start, end
        seen = at + 1
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind, then start."""
    out = list(_emails(text))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# -- candidates: everything that could be personal data in another spelling --
_AT = r"\s{0,2}(?:@|\(at\)|\[at\]|\{at\}|\bat\b)\s{0,2}"
_DOT = r"\s{0,2}(?:\.|\(dot\)|\[dot\]|\{dot\}|\bdot\b)\s{0,2}"
_MAIL_AT = re.compile(_AT, re.IGNORECASE)
_MAIL_REST = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.IGNORECASE)
_MAIL_SIGN = re.compile(r"@|[(\[{]at[)\]}]|\bdot\b", re.IGNORECASE)
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[ ().\-/\[\] _]{0,3}[0-9])++")
_NUMBER_TAIL = 64
MOST_DIGITS = 19

# fixed values: words that tell what a number next to them is, in four languages
_HINTS = {
    "email": "mail email e-mail contact kontakt correo courriel write",
    "ip": "ip host server address addr adresse node",
    "card": "card visa mastercard amex karte kreditkarte carte tarjeta cc",
    "phone": "phone tel telephone call mobile fon telefon fax móvil teléfono téléphone portable",
    "not": "version order invoice no nr isbn date page total sum price id number token hash",
}
_HINTS_OF = {word: kind for kind, words in _HINTS.items() for word in words.split()}
_CONTEXT_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)?")


def candidates(text: str) -> list[Span]:
    """Overlapping spans that could be personal data; recall comes before precision.

    Every run of whole groups of a number of up to 64 code points and 19 digits is
    proposed, as phone, card and address where its digits allow it. A number of
    any length is gone through in such windows.
    """
    out: list[Span] = []
    if _MAIL_SIGN.search(text):
        last, last_start = 0, 0
        for m in _MAIL_AT.finditer(text):
            start = at = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start == last:
                start = last_start  # nothing but local part up to the match before
            last, last_start = at, start
            rest = _MAIL_REST.match(text, m.end())
            if start < at and rest:
                out.append(("email", start, rest.end()))
    if not _DIGIT.search(text):
        return out
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [g.span() for g in _DIGITS.finditer(text, *m.span())]
        for i in range(len(groups)):
            start = groups[i][0] if i else m.start()
            digits = 0
            for n, (first, end) in enumerate(groups[i : i + MOST_DIGITS], 1):
                digits += end - first
                if digits > MOST_DIGITS or end - start > _NUMBER_TAIL:
                    break
                if end - start < 7:
                    continue
                if 7 <= digits <= 15:
                    out.append(("phone", start, end))
                if 13 <= digits:
                    out.append(("card", start, end))
                if n == 4 and digits <= 12:
                    out.append(("ip", start, end))
    return out


def features(text: str, span: Span) -> list[float]:
    """Format of a span and words around it."""
    kind, start, end = span
    part = text[start:end]
    digits = _NOT_DIGIT.sub("", part)
    groups = [g for g in re.split(r"[^0-9]+", part) if g]
    before, after = text[max(0, start - 40) : start], text[end : end + 25]
    near = _CONTEXT_WORD.findall(before)[-4:] + _CONTEXT_WORD.findall(after)[:2]
    hints = [_HINTS_OF.get(w.lower()) for w in near]
    lengths = [len(g) for g in groups] or [0]
    separators = _DIGIT.sub("", part)
    return [
        KINDS.index(kind), len(part), len(digits), len(groups), max(lengths), min(lengths), lengths[0],
        lengths[-1], float(bool(digits) and luhn(digits)), float(part.startswith("+")), part.count("("),
        part.count("."), part.count("-"), part.count(" "), part.count("/"), part.count("["),
        len(set(separators)), float(bool(groups) and max(int(g[:4]) for g in groups) <= 255),
        float("@" in part), float(bool(re.search(r"[(\[{](?:at|dot)[)\]}]", part, re.IGNORECASE))),
        float(bool(re.search(r"\bdot\b", part, re.IGNORECASE))),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "/.-_#"),
        float(kind in hints), float("not" in hints), float(any(h and h not in (kind, "not") for h in hints)),
        float(groups[0][0] in "3456") if groups else 0.0, part.count(","),
    ]


class _Spans:
    """Places of a text that are taken, as ascending spans that do not meet."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i == len(self.ends) or self.starts[i] >= end

    def add(self, start: int, end: int) -> None:
        lo, hi = bisect_right(self.ends, start), bisect_left(self.starts, end)
        if lo < hi:
            start, end = min(start, self.starts[lo]), max(end, self.ends[hi - 1])
        self.starts[lo:hi], self.ends[lo:hi] = [start], [end]


@dataclass
class Detector:
    model: Boosted
    limits: dict[str, float]

    def added(self, text: str, base: list[Span]) -> list[tuple[Span, float]]:
        """Candidates over their kind's limit that meet no base span, the likeliest first."""
        taken = _Spans()
        for _, start, end in base:
            taken.add(start, end)
        found = [s for s in candidates(text) if taken.free(s[1], s[2])]
        if not found:
            return []
        out: list[tuple[Span, float]] = []
        scores: list[float] = []
        for i in range(0, len(found), SCORED_AT_ONCE):
            part = np.array([features(text, s) for s in found[i : i + SCORED_AT_ONCE]])
            scores += self.model.probability(part).tolist()
        for score, span in sorted(zip(scores, found), key=lambda x: (-x[0], x[1])):
            if score >= self.limits[span[0]] and taken.free(span[1], span[2]):
                taken.add(span[1], span[2])
                out.append((span, score))
        return out


def _card_number(rng: random.Random, valid: bool) -> str:
    digits = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
    check = next(d for d in "0123456789" if luhn(digits + d))
    return digits + (check if valid else rng.choice([d for d in "0123456789" if d != check]))


def _example(rng: random.Random) -> tuple[str, str, str]:
    """Kind, a cue before it or none, and a spelling that base patterns may not know."""
    kind = rng.choice(KINDS)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    if kind == "email":
        at = rng.choice(["@", " (at) ", "[at]", " [at] ", " at ", "(at)", " @ "])
        dot = rng.choice([".", " (dot) ", "[dot]", " [dot] ", " dot ", "(dot)"])
        if at == " at ":
            dot = " dot "
        value = f"{word()}{rng.choice(['', '.', '_', number(2)])}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}"
    elif kind == "ip":
        dot = rng.choice(["[.]", " . ", "(.)", ". ", "[.]"])
        value = dot.join(str(rng.randint(1, 255)) for _ in range(4))
    elif kind == "card":
        digits, gap = _card_number(rng, True), rng.choice([".", "_", "/", "  ", " ", " - "])
        value = gap.join(digits[i : i + 4] for i in range(0, 16, 4))
    else:
        a, b, c = number(3), number(3), number(4)
        value = rng.choice([
            f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{number(2)} {a} {b} {c}", f"0{number(3)}/{number(7)}",
            f"0{number(1)} {number(2)} {number(2)} {number(2)} {number(2)}", f"({a}){b} {c}", f"{a} {b} {c}",
            f"+1 ({a}) {b}-{c}", f"+{number(2)} {a} {number(7)}",
        ])
    cue = rng.choice([*_HINTS[kind].split(), "", "", ""])
    return kind, cue, value


def _decoy(rng: random.Random) -> tuple[str, str]:
    """A cue or none, and a text that looks like personal data but is none."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    digits = _card_number(rng, False)
    word = lambda: "".join(rng.choice("abcdeéghiklmnoprstuvwz") for _ in range(rng.randint(2, 9)))
    value = rng.choice([
        f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
        f"{rng.randint(1, 28):02}.{rng.randint(1, 12):02}.{rng.randint(1900, 2030)}",
        f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(256, 9999)}",
        number(rng.randint(7, 12)), number(rng.randint(13, 18)), f"{number(2)},{number(3)},{number(3)}",
        ".".join(digits[i : i + 4] for i in range(0, 16, 4)), f"{number(3)} {number(3)}", f"{number(4)}-{number(4)}",
        f"{number(3)}-{number(1)}-{number(2)}-{number(6)}-{number(1)}", f"{number(2)} {number(2)} {number(2)}",
        f"{word()} at {word()}. {word().title()}", f"{word()} at {word()} dot {word()}", f"{word()} @ {word()}.", f"{number(1)} {number(1)} {number(1)} {number(1)} {number(1)} {number(1)} {number(1)}",
        f"{number(4)} {number(4)} {number(4)}", f"{number(5)}-{number(4)}", "".join(rng.choice("0123456789abcdef") for _ in range(32)),
    ])
    return rng.choice([*_HINTS["not"].split(), "", ""]), value


def train(passages: list[str], precision: float = PRECISION, seed: int = 42) -> Detector:
    """Learn on examples and decoys placed into real passages; a third calibrates.

    A candidate is right if it is just the placed span; what else the passages
    hold is wrong. The limit of a kind is the least calibrated probability, from
    one half on, at which ``precision`` of the held-out candidates are right.
    """
    rng = random.Random(seed)
    rows, answer, kinds, part = [], [], [], []
    for i in range(max(len(passages), 300)):
        words = (passages[i % len(passages)] if passages else "a text").split(" ")
        at = rng.randint(0, len(words))
        tail = ""
        if rng.random() < 0.5:
            kind, cue, value = _example(rng)
            if rng.random() < 0.3:
                tail = " " + "".join(rng.choice("0123456789") for _ in range(rng.choice((5, 8, 16))))
        else:
            kind, (cue, value) = "", _decoy(rng)
        before = " ".join(filter(None, [*words[:at], cue]))
        start = len(before) + bool(before)
        text = f"{before}{' ' if before else ''}{value}{tail} {' '.join(words[at:])}".rstrip()
        placed = (kind, start, start + len(value))
        base = base_spans(text)
        for span in candidates(text):
            if any(b[0] != kind and span[1] < b[2] and b[1] < span[2] for b in base):
                continue
            rows.append(features(text, span))
            answer.append(float(span == placed))
            kinds.append(span[0])
            part.append(i % 3 == 0)
    x, y, held = np.array(rows), np.array(answer), np.array(part)
    model = fit_boosted(x[~held], y[~held])
    calibrate(model, x[held], y[held])
    p, names = model.probability(x), np.array(kinds)
    limits = {
        k: max(0.5, threshold(p[held & (names == k)], y[held & (names == k)], precision)) for k in KINDS
    }
    return Detector(model, limits)


def training_passages(docs: DataFrame, count: int = PASSAGES, seed: int = 42) -> list[str]:
    """Beginnings of about ``count`` documents that a hash of doc_id chooses."""
    total = docs.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = docs.where(F.col("text").isNotNull() & (draw < count / max(1, total))).select(
        "doc_id", F.substring("text", 1, PASSAGE_CHARS).alias("passage")
    ).limit(2 * count + 100).collect()
    return [r["passage"] for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["passage"]))]


def joined(spans: list[Span]) -> str:
    """``kind:start:end``, by kind as listed, then start."""
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text.

    Returns doc_id, n_email, n_ip, n_card and n_phone (base spans), base_sha256
    of the joined base spans, spans (all of them, joined), n_added and
    least_score, the lowest calibrated probability of an added span. Offsets are
    code points, the end exclusive.

    Base spans follow the patterns to the letter. Further candidates come from
    generous patterns; boosted trees judge their format and the words around, and
    a limit per kind, set on held-out examples, selects them. The examples are
    spellings placed into passages of a bounded sample (``PASSAGES``), as the
    tables have no labels for personal data.

    A null text is empty; repeated rows give repeated rows; columns other than
    doc_id and text are not read.
    """
    detector = train(training_passages(docs.select("doc_id", "text")))

    def job(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                base = base_spans(text or "")
                more = detector.added(text, base) if text else []
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                every = joined([*base, *(s for s, _ in more)])
                for n, v in zip(names, (
                    doc_id, *counts, digest, every, len(more), min((p for _, p in more), default=None),
                )):
                    out[n].append(v)
            yield out

    schema = (
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string, n_added bigint, least_score double"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    return by_arrow(docs.select("doc_id", "text"), schema, job)


def redacted(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, each personal span replaced by its kind in brackets.

    Overlapping spans become one, named after the first.
    """
    detector = train(training_passages(docs.select("doc_id", "text")))
    name = fresh(docs, "clean_text")
    columns = docs.columns
    at = columns.index("text")

    def clean(text: str) -> str:
        base = base_spans(text)
        spans = sorted([*base, *(s for s, _ in detector.added(text, base))], key=lambda s: (s[1], s[2]))
        out, done = [], 0
        for kind, start, end in spans:
            if start >= done:
                out += [text[done:start], f"[{kind}]"]
            done = max(done, end)
        return "".join([*out, text[done:]])

    def job(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield {
                **{c: batch.column(i) for i, c in enumerate(columns)},
                name: [t and clean(t) for t in texts],
            }

    new = docs.limit(0).withColumn(name, F.lit("")).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.fields)
    found = by_arrow(docs, schema, job)
    return found.select(*[
        F.col(f"`{name}`").alias("text") if c == "text" else F.col(f"`{c}`") for c in columns
    ])
