"""Words of a text: splitting, stopwords, and grouping by stem inside the row."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.expr import each, let, let_sql
from trawl.functions.porter import stem_array

# What counts as a word in a text, in a title, and between words.
WORD = r"([A-Za-z0-9][A-Za-z0-9\-_]*)"
# The title string also lets a word begin with an opening bracket.
TITLE_WORD = r"([\[A-Za-z0-9][A-Za-z0-9\-_]*)"
NOT_WORD = r"[^A-Za-z0-9\-_]+"


def words_in(text: Column) -> Column:
    """Lower-case words of a text in order; letters outside ASCII split words."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), 1), F.lower)


def title_of(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(text, F.lit(TITLE_WORD), 1), " ")


def drop_stopwords(words: Column, stopwords: Collection[str]) -> Column:
    return F.filter(words, lambda word: ~word.isin(*stopwords))


def stems(words: Column) -> Column:
    return stem_array(words)


# Indexes at which the sorted entries ``e`` move on to a new word.
_RUN_STARTS = (
    "array_compact(transform(e.words, (word, i) -> "
    "if(i = 0 OR word <> get(e.words, i - 1), i, null)))"
)
# One run of entries, from ``start`` to the next start, as a term.
_RUN = let_sql(
    "coalesce(get(starts, i + 1), size(e.words)) - start",
    "length",
    let_sql(
        "if(get(e.positions, start) = -1, 1, 0)",
        "marks",
        "named_struct('word', get(e.words, start), 'term_frequency', length - marks, "
        "'in_title', marks = 1, "
        "'positions', slice(e.positions, start + marks + 1, length - marks))",
    ),
)
_TERMS = let_sql(
    _RUN_STARTS,
    "starts",
    f"filter(transform(starts, (start, i) -> {_RUN}), term -> term.term_frequency > 0)",
)


def terms_of(kept_stems: Column, title_marks: Column) -> Column:
    """Group a page's stems: ``(word, term_frequency, in_title, positions)`` each.

    One sort of ``(word, position)`` pairs inside the row replaces a shuffle of
    every word by (page, word). Kept words carry their position, counted over
    kept words only. Every title word adds a mark at position -1, which sorts
    ahead of the word's positions, so "is it in the title" needs no search.
    """
    marks = each(
        F.array_distinct(title_marks), "word -> named_struct('word', word, 'position', -1)"
    )
    body = each(kept_stems, "(word, i) -> named_struct('word', word, 'position', i)")
    return _grouped(F.concat(marks, body))


def _grouped(entries: Column) -> Column:
    """Terms of ``(word, position)`` entries."""
    columns = let(
        F.array_sort(entries),
        "sorted -> named_struct('words', sorted.word, 'positions', sorted.position)",
    )
    return let(columns, f"e -> {_TERMS}")


#: Neighbours among entries ``e`` sorted by position, as entries of word pairs.
_NEIGHBOURS = (
    "array_compact(transform(e, (x, i) -> if(get(e, i + 1).position = x.position + 1, "
    "named_struct('word', concat(x.word, ' ', get(e, i + 1).word), 'position', x.position), null)))"
)


def pairs_of(terms: Column, frequent: Collection[str]) -> Column:
    """Pairs of neighbouring stems that are both ``frequent``, as terms.

    A pair's word is its stems with a space between, which no stem holds; its
    positions are those of the first stem.
    """
    if not frequent:
        frequent = [""]  # no stem is empty
    chosen = F.filter(terms, lambda term: term["word"].isin(*frequent))
    places = each(
        chosen, "t -> transform(t.positions, p -> named_struct('position', p, 'word', t.word))"
    )
    return _grouped(let(F.array_sort(F.flatten(places)), f"e -> {_NEIGHBOURS}"))
