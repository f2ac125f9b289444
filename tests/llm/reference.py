"""Plain versions of what the operators compute, for small inputs."""

import re
from collections import defaultdict

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(SMALL))


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def components(texts, width, num, den):
    """Smallest id reachable, for each id of ``texts`` (dict)."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        near = set().union(*(holders[x] for x in s)) if s else set()
        for j in near:
            both = len(s & sets[j])
            if den * both >= num * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def edit_distance_inside(pattern, text):
    """Least edits of ``pattern`` against any part of ``text``."""
    last = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        now = [i]
        for j, c in enumerate(text, 1):
            now.append(min(last[j - 1] + (p != c), last[j] + 1, now[j - 1] + 1))
        last = now
    return min(last)
