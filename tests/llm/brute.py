"""Plain versions of what the operators compute, in one process."""

import re
from collections import defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def near_components(docs, percent):
    """doc_id to (set size, component); compares every pair that shares a shingle."""
    sets = {d: shingle_set(t) for d, t in docs}
    first = {}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        if sets[d] in first and sets[d]:
            parent[root(d)] = root(first[sets[d]])
            continue
        first[sets[d]] = d
        for other in {o for s in sets[d] for o in holders[s]}:
            both = len(sets[d] & sets[other])
            if 100 * both >= percent * (len(sets[d]) + len(sets[other]) - both):
                a, b = sorted((root(d), root(other)))
                parent[b] = a
        for s in sets[d]:
            holders[s].append(d)
    low = defaultdict(lambda: float("inf"))
    for d in sets:
        low[root(d)] = min(low[root(d)], d)
    return {d: (len(sets[d]), low[root(d)]) for d in sets}


def edits_to_part(item, text):
    """Fewest word edits from ``item`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def seats(votes, count):
    """Sainte-Laguë one seat at a time."""
    held = [0] * len(votes)
    for _ in range(count):
        held[max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))] += 1
    return held
