"""Main text of web pages by their difference to the page with the nearest address."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import by_arrow
from trawl.llm.ranges import by_range, key_ranges, placed

# fixed values: names of elements, and words in class, id and role, by meaning
RAW = "script style noscript template iframe svg title textarea select object"
#: Elements whose content is text to their end tag, or to the end of the page.
RAW_TO_END = "script style iframe title textarea"
CHROME = "nav footer aside form dialog button menu"
CHROME_UNLESS_ARTICLE = "header"
CHROME_WORDS = (
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter "
    "notice notices paywall popup promo promoted related share sharing sidebar social sponsor "
    "sponsored subscribe toolbar"
)
#: Chrome only as a whole name: page builders call every part of a text a widget.
CHROME_NAMES = "widget"
#: What may follow the noun in a name: the shape or place of the thing, or its parts.
SHAPES = (
    "area articles bar block bottom box button buttons col column container content form inner item "
    "items left link links list outer posts right section signup slot stories top unit wrap wrapper"
)
COMMENT_WORDS = "comment comments reply replies"
#: What a class or id says after one of these is about the element, not its name.
MODIFIERS = (
    "has with without no not non is hide hides hidden show shows enable enables enabled disable "
    "disables disabled"
)
#: Never menus or the like by a word in their class or id.
WHOLE = "html body main article"
CHROME_ROLES = "alert banner complementary contentinfo dialog menu menubar navigation search"
BLOCK = (
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul aside"
)
#: Bits of rows held at once to read a common subsequence from.
ROW_BITS = 1 << 22
#: Open blocks other than these keep an open li, dd or dt from being ended by a later one,
#: and open holders keep a p.
NO_WALL = "address div p li dd dt"
HOLDERS = "button caption td th"
#: Elements with optional end tags: which open ones a start tag ends, up to the table.
TABLE_ENDS = {
    "td": "td th", "th": "td th", "tr": "td th tr", "tbody": "td th tr thead tbody tfoot",
    "thead": "td th tr thead tbody tfoot", "tfoot": "td th tr thead tbody tfoot",
}
HEADINGS = "h1 h2 h3 h4 h5 h6"
VOID = "area base br col embed hr img input link meta param source track wbr"

_RAW, _CHROME, _BLOCK, _VOID = (frozenset(x.split()) for x in (RAW, CHROME, BLOCK, VOID))
_RAW_TO_END, _WHOLE = frozenset(RAW_TO_END.split()), frozenset(WHOLE.split())
_MODIFIERS = frozenset(MODIFIERS.split())
_WORDS, _ROLES = frozenset(CHROME_WORDS.split()), frozenset(CHROME_ROLES.split())
_NAMES, _SHAPES = frozenset(CHROME_NAMES.split()), frozenset(SHAPES.split())
_COMMENT = frozenset(COMMENT_WORDS.split())
_WALLS, _HOLDERS = _BLOCK - frozenset(NO_WALL.split()), frozenset(HOLDERS.split())
_TABLE_ENDS = {name: ends.split() for name, ends in TABLE_ENDS.items()}
_HEADINGS = frozenset(HEADINGS.split())
#: A quote opens a value behind an equals sign only; a stray one is part of the tag.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME_WORD = re.compile(r"[a-z0-9]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE) for name in _RAW}


@dataclass
class Page:
    """Text lines in page order: what the author marked as the article, and the rest.

    ``whole`` tells which marked lines stand in an ``article``, not only in a
    ``main``; ``chrome`` which of the others stand in menus, footers and the like.
    """

    article: list[str] = field(default_factory=list)
    marked: bool = False
    other: list[str] = field(default_factory=list)
    chrome: list[bool] = field(default_factory=list)
    whole: list[bool] = field(default_factory=list)


def _names(value: str, nouns: frozenset[str]) -> bool:
    """Whether a name in a class or id says that the element is one of ``nouns``.

    The noun is the last word of a name, shapes and numbers behind it apart. So
    ``site-footer``, ``sidebar--left`` and ``comment-list`` are menus and the like;
    ``share-price`` and ``has-sidebar`` are not, as they tell of another thing.
    """
    for name in value.split():
        words = _NAME_WORD.findall(name.split("--")[0])
        if not words or any(word in _MODIFIERS for word in words):
            continue
        while len(words) > 1 and (words[-1] in _SHAPES or words[-1].isdigit()):
            words.pop()
        if words[-1] in nouns or name in _NAMES and nouns is _WORDS:
            return True
    return False


def _is_chrome(name: str, attributes: str, in_article: bool, after_article: bool) -> bool:
    if name in _CHROME or name == CHROME_UNLESS_ARTICLE and not in_article:
        return True
    if name in ("html", "body", "main") or "=" not in attributes:
        return False
    # an article is a reader's comment only beside or inside another one
    nouns = _WORDS if name not in _WHOLE else _COMMENT if after_article else frozenset()
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if key.lower() in ("class", "id") and _names(value, nouns):
            return True
        if key.lower() == "role" and value in _ROLES:
            return True
    return False


class _Open:
    """Names of the open elements, and the depths at which each name is open."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.walls: list[int] = []
        self.holders: list[int] = []
        self.stacks: dict[str, list[list[int]]] = {}

    def _stacks(self, name: str) -> list[list[int]]:
        kinds = ((_BLOCK, self.blocks), (_WALLS, self.walls), (_HOLDERS, self.holders))
        return [self.at[name], *(stack for kind, stack in kinds if name in kind)]

    def push(self, name: str) -> None:
        if name not in self.stacks:
            self.stacks[name] = self._stacks(name)
        for stack in self.stacks[name]:
            stack.append(len(self.names))
        self.names.append(name)

    def pop(self) -> None:
        name = self.names.pop()
        for stack in self.stacks[name]:
            stack.pop()

    def last(self, name: str, within: list[int] = []) -> int | None:
        """Depth of the innermost ``name`` inside the last element of ``within``."""
        at = self.at[name]
        return at[-1] if at and (not within or at[-1] > within[-1]) else None

    def ended_by_start(self, name: str) -> int | None:
        """Depth from which elements end as a block called ``name`` begins; None if none do.

        End tags of p, li, dd, dt, cells and rows are optional in HTML.
        """
        ends = [self.last("p", self.holders)] if self.at["p"] else []
        if name == "li":
            ends.append(self.last("li", self.walls))
        elif name in ("dd", "dt"):
            ends += [self.last("dd", self.walls), self.last("dt", self.walls)]
        elif name in _TABLE_ENDS:
            ends += [self.last(x, self.at["table"]) for x in _TABLE_ENDS[name]]
        elif name in _HEADINGS and self.names and self.names[-1] in _HEADINGS:
            ends.append(len(self.names) - 1)
        return min((depth for depth in ends if depth is not None), default=None)

    def ended_by_end(self, name: str) -> int | None:
        """Depth from which elements end at an end tag; one of a block ends what it holds."""
        if name in _HEADINGS:
            return max((d for x in _HEADINGS if (d := self.last(x)) is not None), default=None)
        return self.last(name, [] if name in _BLOCK else self.blocks)


def parse(page: str) -> Page:
    """Lines of a page: white space inside a block is one space, blocks are lines."""
    out = Page()
    text: list[str] = []
    opened = _Open()
    chrome_at: list[int] = []  # depths of open elements that hold no main text
    article_at: list[int] = []
    main_at: list[int] = []  # no element around a main is a menu or the like
    marks: list[int] = []  # all of these
    endless: set[str] = set()  # raw elements of which no end tag follows any more

    def in_chrome() -> bool:
        return bool(chrome_at) and chrome_at[-1] > (main_at[-1] if main_at else -1)

    def end_line() -> None:
        line = " ".join(html.unescape("".join(text)).split()) if text else ""
        text.clear()
        if not line:
            return
        if article_at and not in_chrome():
            out.article.append(line)
            out.whole.append(len(article_at) > len(main_at))
        else:
            out.other.append(line)
            out.chrome.append(in_chrome())

    def close(from_depth: int | None) -> None:
        while from_depth is not None and len(opened.names) > from_depth:
            depth = len(opened.names) - 1
            if marks and marks[-1] == depth:
                end_line()
                marks.pop()
                for stack in (chrome_at, article_at, main_at):
                    if stack and stack[-1] == depth:
                        stack.pop()
            opened.pop()

    at = 0
    while (token := _TOKEN.search(page, at)) is not None:
        text.append(page[at : token.start()])
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if token[1]:
            if name in _BLOCK:
                end_line()
            close(opened.ended_by_end(name))
            continue
        if name in _RAW:
            if not token[3].endswith("/") and name not in endless:
                end = _RAW_END[name].search(page, at)
                if end or name in _RAW_TO_END:
                    at = end.end() if end else len(page)
                else:
                    endless.add(name)
            continue
        if name == "head":
            continue  # what it holds is raw or empty; it ends where other content begins
        if name == "br":
            text.append(" ")
        if name in _BLOCK:
            end_line()
            close(opened.ended_by_start(name))
        if name in _VOID or token[3].endswith("/"):
            continue
        depth = len(opened.names)
        opened.push(name)
        if _is_chrome(name, token[3], bool(article_at), out.marked):
            end_line()
            marks.append(depth)
            chrome_at.append(depth)
        elif name in ("article", "main") or 'role="main"' in token[3]:
            end_line()
            marks.append(depth)
            article_at.append(depth)
            if name != "article":
                main_at.append(depth)
            out.marked = True
    text.append(page[at:])
    end_line()
    return out


def _rows(lines: list[str], other: list[str]) -> Iterator[int]:
    """Bits per line: place j is 0 where one place more of ``other`` lengthens the subsequence."""
    places: dict[str, list[int]] = defaultdict(list)
    for j, line in enumerate(other):
        places[line].append(j)
    often: dict[str, int] = {}  # masks of rare lines are made when needed, as they are long
    full = row = (1 << len(other)) - 1
    for line in lines:
        mask = often.get(line, 0)
        if not mask:
            for j in places.get(line, ()):
                mask |= 1 << j
            if len(places.get(line, ())) > 64:
                often[line] = mask
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(lines: list[str], other: list[str]) -> list[int]:
    """Longest common subsequence of ``lines`` with every beginning of ``other``."""
    row = (1 << len(other)) - 1
    for row in _rows(lines, other):
        pass
    bits = format(row, f"0{len(other)}b")[::-1] if other else ""
    return list(accumulate((bit == "0" for bit in bits), initial=0))


def _common(lines: list[str], other: list[str], at: int) -> Iterator[int]:
    """Places, from ``at`` on, of a longest common subsequence; cut in two while large."""
    n, m, first = len(lines), len(other), 0
    while first < min(n, m) and lines[first] == other[first]:
        yield at + first
        first += 1
    while n > first and m > first and lines[n - 1] == other[m - 1]:
        n, m = n - 1, m - 1
        yield at + n
    lines, other, at = lines[first:n], other[first:m], at + first
    n, m = len(lines), len(other)
    if not n or not m:
        return
    if n > 1 and n * m > ROW_BITS:
        half = n // 2
        ahead = _lengths(lines[:half], other)
        behind = _lengths(lines[half:][::-1], other[::-1])
        cut = max(range(m + 1), key=lambda j: ahead[j] + behind[m - j])
        yield from _common(lines[:half], other[:cut], at)
        yield from _common(lines[half:], other[cut:], at + half)
        return
    rows = list(_rows(lines, other))
    i, j = n - 1, m - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            yield at + i
            i, j = i - 1, j - 1


def shared_lines(lines: list[str], other: list[str]) -> set[int]:
    """Places in ``lines`` of a longest common subsequence with ``other``.

    A line may match any copy of it. Rows of the comparison are bits of one
    number, so that a thousand lines take a thousand steps.
    """
    here, there = set(lines), set(other)
    places = [i for i, line in enumerate(lines) if line in there]
    found = _common([lines[i] for i in places], [x for x in other if x in here], 0)
    return {places[i] for i in found}


def main_text(page: Page, nearest: Page | None) -> tuple[str, int]:
    """The main text and the number of lines deleted as shared.

    Lines outside a marked article are aligned with those of the nearest page;
    shared ones go, as do those that the markup itself calls menu, footer and so
    on. So do lines of a ``main`` that are in no ``article``, unless both pages
    share half of the marked text or more, as copies do. Lines of an ``article``
    stay: what an author marked so is no template.
    """
    shared = shared_lines(page.other, nearest.other) if nearest else set()
    if page.marked:
        gone: set[int] = set()
        if nearest and not all(page.whole):
            same = shared_lines(page.article, nearest.article if nearest.marked else nearest.other)
            chars = sum(len(page.article[i]) for i in same)
            if 2 * chars < sum(map(len, page.article)):
                gone = {i for i in same if not page.whole[i]}
        rest = [line for i, line in enumerate(page.article) if i not in gone]
        return "\n\n".join(rest), len(shared) + len(gone)
    rest = [
        line for i, (line, chrome) in enumerate(zip(page.other, page.chrome))
        if i not in shared and not chrome
    ]
    return "\n\n".join(rest), len(shared)


def _closeness(path: str, other: str) -> int:
    """Length of the common beginning of two addresses."""
    n = 0
    for a, b in zip(path, other):
        if a != b:
            break
        n += 1
    return n


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars, n_shared.

    Pages of a host are ordered by path; the nearest page is the neighbour whose
    address has the longer common beginning, the one before on a tie. Pages are
    parsed where they lie; their lines are dealt by ranges of (host, path), so
    one host may hold any part of the pages.

    A null or empty html has an empty text, an empty table gives no rows, and a page
    of any length takes time in step with it. A page without url, or alone on its
    host, has no neighbour and only loses what the markup names. Repeated rows
    are neighbours of each other and give repeated rows. Other columns are not
    read.
    """

    def lines(batches):
        for batch in batches:
            found = [parse(h or "") for h in batch.column(4).to_pylist()]
            yield {
                **{n: batch.column(i) for i, n in enumerate(("page_id", "url", "host", "path"))},
                "tie": batch.column(5),
                "article": [p.article for p in found],
                "marked": [p.marked for p in found],
                "other": [p.other for p in found],
                "chrome": [p.chrome for p in found],
                "whole": [p.whole for p in found],
            }

    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)
    tie = F.xxhash64("page_id", "html")
    keyed = pages.select(
        "page_id", "url", host.alias("host"), path.alias("path"), "html", tie.alias("tie")
    )
    keys = [F.col("host"), F.col("path"), F.col("tie")]
    ranges = key_ranges(keyed, keys)
    parsed = by_arrow(
        keyed,
        "page_id bigint, url string, host string, path string, tie bigint, "
        "article array<string>, marked boolean, other array<string>, chrome array<boolean>, "
        "whole array<boolean>",
        lines,
    )
    around = placed(parsed, keys, ranges).select(
        "*", F.col("at.range").alias("range"), F.col("at.role").alias("role")
    ).drop("at")
    ordered = by_range(around, ranges, "role", "host", "path", "tie")
    columns = ("page_id", "url", "host", "path", "article", "marked", "other", "chrome",
               "whole", "range", "role")

    def compare(batches):
        window: list[dict] = []

        def done(row: dict, before: dict | None, after: dict | None) -> tuple:
            near = [
                x for x in (before, after)
                if x and x["range"] == row["range"] and x["host"] == row["host"] != ""
            ]
            best = max(near, key=lambda x: _closeness(x["path"], row["path"]), default=None)
            text, shared = main_text(row["page"], best and best["page"])
            return row["page_id"], row["url"], text, len(text), shared

        def columns_of(rows: list[tuple]) -> dict:
            kinds = zip(*rows) if rows else [[]] * 5
            return dict(zip(("page_id", "url", "text", "n_chars", "n_shared"), map(list, kinds)))

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                row["page"] = Page(*[row[c] for c in ("article", "marked", "other", "chrome", "whole")])
                window.append(row)
                if len(window) >= 2 and window[-2]["role"] == 0:
                    out.append(done(window[-2], window[-3] if len(window) > 2 else None, row))
                del window[:-2]
            yield columns_of(out)
        if window and window[-1]["role"] == 0:
            yield columns_of([done(window[-1], window[-2] if len(window) > 1 else None, None)])

    return by_arrow(
        ordered.select(*columns),
        "page_id bigint, url string, text string, n_chars bigint, n_shared bigint",
        compare,
    )
