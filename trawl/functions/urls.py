"""Resolve link targets against the address of the page that holds them.

Follows the joining rules of the reference's run time: a target with a path of
its own is kept as written, dot segments are folded only when a relative path
is merged, ``..`` above the root stays, and a fragment is kept unless empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.expr import let, let_sql

# Digits alone after the colon are a port, not the rest of an address.
_SCHEME = r"(?s)^([A-Za-z0-9+.\-]+):(?!\d+\z)"
_PARTS = r"(?s)^(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
# Schemes whose addresses can be relative.
_HIERARCHICAL = "'http', 'https', 'ftp', 'file', 'sftp', ''"


def _split(url: str) -> str:
    """``(scheme, authority, path, query, fragment)`` of an address."""
    parts = ", ".join(
        f"'{name}', regexp_extract(rest, r'{_PARTS}', {group})"
        for group, name in enumerate(("authority", "path", "query", "fragment"), 1)
    )
    scheme = f"'scheme', lower(regexp_extract({url}, r'{_SCHEME}', 1))"
    return let_sql(
        f"regexp_replace({url}, r'{_SCHEME}', '')", "rest", f"named_struct({scheme}, {parts})"
    )


# Fold "." and ".." of a merged path, segment by segment; ".." takes a segment
# unless that is empty or ".." itself.
_PUSH = """CASE
    WHEN segment = '.' THEN done
    WHEN segment = '..' AND coalesce(try_element_at(done, -1), '') NOT IN ('', '..')
        THEN slice(done, 1, size(done) - 1)
    ELSE concat(done, array(segment)) END"""
# The last segment: "." leaves a folder, ".." its parent folder; from the root it
# leaves the root, and from a lone segment nothing.
_CLOSE = """CASE
    WHEN last = '.' THEN concat(done, array(''))
    WHEN last = '..' AND size(done) > 1 THEN concat(slice(done, 1, size(done) - 1), array(''))
    WHEN last = '..' AND size(done) = 1 AND done[0] = '' THEN array('', '')
    WHEN last = '..' AND size(done) = 1 THEN array('')
    ELSE concat(done, array(last)) END"""
_INNER = (
    "aggregate(slice(segments, 1, size(segments) - 1), cast(array() as array<string>), "
    f"(done, segment) -> {_PUSH})"
)
_FOLDED = let_sql(
    "element_at(segments, -1)", "last", f"array_join({let_sql(_INNER, 'done', _CLOSE)}, '/')"
)


def _fold_dots(path: str) -> str:
    folded = let_sql("split(path, '/')", "segments", _FOLDED)
    return let_sql(path, "path", f"if(contains(path, '.'), {folded}, path)")


_PATH = f"""CASE
    WHEN h.authority <> '' OR startswith(h.path, '/') THEN h.path
    WHEN h.path = '' THEN b.path
    ELSE {_fold_dots("concat(regexp_extract(b.path, r'(?s)^(.*/)[^/]*$', 1), h.path)")} END"""
_QUERY = "if(h.authority <> '' OR h.path <> '' OR h.query <> '', h.query, b.query)"
# An address without scheme and authority, such as a path, stays without them.
_PLACED = let_sql(
    _PATH, "p",
    "CASE WHEN b.scheme = '' AND a = '' THEN p ELSE concat("
    "if(b.scheme = '', '', concat(b.scheme, ':')), '//', a, "
    "if(p = '' OR startswith(p, '/'), p, concat('/', p))) END",
)
_JOINED = f"""concat(
    {let_sql("if(h.authority <> '', h.authority, b.authority)", "a", _PLACED)},
    {let_sql(_QUERY, "q", "if(q <> '', concat('?', q), '')")},
    if(h.fragment <> '', concat('#', h.fragment), ''))"""
_CHOSEN = f"""CASE
    WHEN h.scheme <> '' AND h.scheme <> b.scheme THEN href
    WHEN b.scheme NOT IN ({_HIERARCHICAL}) THEN href
    ELSE {_JOINED} END"""
_RESOLVED = f"if(href = '', page.base, {let_sql(_split('href'), 'h', _CHOSEN)})"
_ALL = let_sql(_split("page.base"), "b", f"transform(page.targets, href -> {_RESOLVED})")


def resolve_all(base: Column, targets: Column) -> Column:
    """Absolute addresses of an array of link targets on the page ``base``."""
    return let(F.struct(base.alias("base"), targets.alias("targets")), f"page -> {_ALL}")
