"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(AZ) if lower else text)


def shingles(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(docs, n, percent=80):
    """docs: {id: text}. Component and set size of each."""
    sets = {d: shingles(t, n) for d, t in docs.items()}
    where = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    links = []
    for d, s in sets.items():
        common = collections.Counter(o for x in s for o in where[x] if o < d)
        links += [(o, d) for o, c in common.items() if 100 * c >= percent * (len(s) + len(sets[o]) - c)]
    return components(docs, links), {d: len(s) for d, s in sets.items()}


def base_rules(text):
    w = words(text, lower=False)
    runs = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    inside = set()
    for i in range(len(w) - 2):
        if runs[w[i], w[i + 1], w[i + 2]] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))
