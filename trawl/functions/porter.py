"""Porter's suffix-stripping algorithm (Program 14(3), 1980) as Spark expressions.

A word ``w`` passes through a fixed list of steps. Each step is the SQL text of
one expression over string predicates and regular expressions, applied to a
whole array of words with ``transform``; the words never leave their row.

Conventions inside the chain:

* a ``y`` that acts as a consonant is written ``Y`` (words are lower case on
  entry), so a letter's class no longer depends on its neighbours;
* every character other than ``a e i o u y`` counts as a consonant, digits,
  hyphens and underscores included;
* ``!`` ends a word of one or two letters, which the algorithm leaves alone;
* ``+`` ends a word that has just lost ``ed`` or ``ing`` and awaits its repair.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_V = "[aeiouy]"
_C = "[^aeiouy]"
# What a stem must start with to have a measure above 0, or above 1.
_M0 = f"{_C}*+{_V}++{_C}"
_M1 = f"{_C}*+{_V}++{_C}++{_V}++{_C}"
# consonant-vowel-consonant with the last one not w, x or y, and measure 1
_SHORT = f"{_C}+{_V}[^aeiouywxY]"

# The suffix rules of steps 2, 3 and 4 as the paper lists them.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _case(*branches: tuple[str, str]) -> str:
    """The first branch whose condition holds, else the word as it is."""
    whens = " ".join(f"WHEN {condition} THEN {result}" for condition, result in branches)
    return f"CASE {whens} ELSE w END"


def _ends(suffix: str) -> str:
    return f"endswith(w, '{suffix}')"


def _cut(n: int) -> str:
    return f"substring(w, 1, length(w) - {n})"


def _matches(pattern: str) -> str:
    return f"rlike(w, r'{pattern}')"


def _swap(condition: str, suffix: str, replacement: str = "") -> str:
    """Replace ``suffix`` where the stem before it satisfies ``condition``."""
    return f"regexp_replace(w, r'^({condition}){suffix}$', '$1{replacement}')"


def _first_suffix(*rules: tuple[str, str]) -> str:
    """Apply the rule of the longest suffix that the word has, and no other.

    Rules are grouped by last letter, so most words meet a handful of tests.
    """
    by_last: dict[str, list[tuple[str, str]]] = {}
    for suffix, result in sorted(rules, key=lambda rule: -len(rule[0])):
        by_last.setdefault(suffix[-1], []).append((_ends(suffix), result))
    return _case(*((_ends(last), _case(*group)) for last, group in by_last.items()))


def _steps() -> list[str]:
    has_vowel = f".*{_V}.*"
    stem_4 = {suffix: f"{_M1}.*" for suffix in STEP_4}
    stem_4["ion"] = f"{_M1}.*(?<=[st])"
    add_e = "translate(w, '+', 'e')"
    repair = (
        f"CASE WHEN {_matches('(?:at|bl|iz)[+]$')} THEN {add_e} "
        f"WHEN {_matches('([^aeiouylsz])' + chr(92) + '1[+]$')} THEN {_cut(2)} "
        f"WHEN {_matches(f'^{_SHORT}[+]$')} THEN {add_e} ELSE {_cut(1)} END"
    )
    drop_e = (
        f"{_ends('e')} AND ({_matches(f'^{_M1}.*e$')} OR "
        f"({_matches(f'^{_C}*{_V}+{_C}+{_V}*e$')} AND NOT {_matches(f'^{_SHORT}e$')}))"
    )
    return [
        _case(
            ("length(w) < 3", "concat(w, '!')"),
            ("contains(w, 'y')", f"regexp_replace(w, r'(^|{_V})y', '$1Y')"),
        ),
        # 1a, 1b with its repair, 1c
        _first_suffix(("sses", _cut(2)), ("ies", _cut(2)), ("ss", "w"), ("s", _cut(1))),
        _first_suffix(
            ("eed", _swap(f"{_M0}.*", "eed", "ee")),
            ("ed", _swap(has_vowel, "ed", "+")),
            ("ing", _swap(has_vowel, "ing", "+")),
        ),
        _case((_ends("+"), repair)),
        _case((f"{_ends('y')} OR {_ends('Y')}", _swap(has_vowel, "[yY]", "i"))),
        # 2, 3, 4
        _first_suffix(*((s, _swap(f"{_M0}.*", s, r)) for s, r in STEP_2)),
        _first_suffix(*((s, _swap(f"{_M0}.*", s, r)) for s, r in STEP_3)),
        _first_suffix(*((s, _swap(stem, s)) for s, stem in stem_4.items())),
        # 5a, 5b
        _case((drop_e, _cut(1))),
        _case((f"{_ends('ll')} AND {_matches(f'^{_M1}')}", _cut(1))),
        _case((_ends("!"), _cut(1)), ("contains(w, 'Y')", "lower(w)")),
    ]


STEPS = tuple(_steps())


def stem_array(words: Column) -> Column:
    """Stem every element of an array of lower-case words."""
    for step in STEPS:
        words = F.call_function("transform", words, F.expr(f"w -> {step}"))
    return words
