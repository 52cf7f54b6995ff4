"""Plain single-machine versions of the joins, for comparison."""

import collections
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern):
    return pattern.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def near_duplicates(docs, size=4, p=85, d=100):
    """(id, shingles, component) per (id, text); every pair that shares a shingle is compared."""
    sets = []
    for _, text in docs:
        own = words(text, SPACED)
        sets.append(frozenset(tuple(own[a : a + size]) for a in range(max(len(own) - size + 1, 1))) if own else frozenset())
    distinct = sorted(set(sets) - {frozenset()}, key=lambda s: (len(s), sorted(s)))
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] != s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s

    holders = collections.defaultdict(list)
    for j, s in enumerate(distinct):
        for other, n in collections.Counter(x for t in s for x in holders[t]).items():
            if d * n >= p * (len(s) + len(distinct[other]) - n):
                parent[root(s)] = root(distinct[other])
        for t in s:
            holders[t].append(j)
    least = {}
    for (i, _), s in zip(docs, sets):
        if s and i is not None:
            least[root(s)] = min(least.get(root(s), i), i)
    return [(i, len(s), least.get(root(s)) if s else i) for (i, _), s in zip(docs, sets)]


def benchmark_hits(docs, items, window=10):
    """(id, words, words hit, item ids) per (id, text)."""
    found = {}
    for i, text in items:
        own = words(text, ALPHANUMERIC)
        for a in range(max(len(own) - window + 1, min(1, len(own)))):
            found.setdefault(tuple(own[a : a + window]), set()).add("" if i is None else str(i))
    lengths, out = {len(x) for x in found}, []
    for i, text in docs:
        own = words(text, ALPHANUMERIC)
        hit, seen = [0] * len(own), set()
        for n in lengths:
            for a in range(len(own) - n + 1):
                if (key := tuple(own[a : a + n])) in found:
                    seen |= found[key]
                    hit[a : a + n] = [1] * n
        out.append((i, len(own), sum(hit), sorted(seen)))
    return out
