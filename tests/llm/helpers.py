"""Brute-force versions of what the corpus operators find."""

import re
from collections import Counter
from itertools import combinations

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))


def shingle_set(text, k=5):
    w = words(text)
    return {tuple(w)} - {()} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def weighted_similarity(a, b, k=5):
    """Weighted Jaccard similarity of the shingles of two strings of words."""
    bag = lambda w: Counter([tuple(w)] if 0 < len(w) < k else zip(*(w[i:] for i in range(k)), strict=False))
    x, y = bag(a.split()), bag(b.split())
    return (x & y).total() / max(1, (x | y).total())


def components(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def near_classes(docs, percent):
    sets = {d: shingle_set(t) for d, t in docs}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return components(sets, links), {d: len(s) for d, s in sets.items()}


def line_words(line):
    return tuple(re.sub("[\t\r\f\x0b]", " ", line.lower()).split(" ")) if line else ()


def within_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def without_repeated_lines(docs, least=5):
    """Texts by doc_id after line dedup, for documents in order of doc_id."""
    seen, out = [], {}
    for d, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            w = tuple(x for x in line_words(line) if x)
            if not w or w not in seen and not (len(w) >= least and any(len(x) >= least and within_one(w, x) for x in seen)):
                kept.append(line)
            seen.append(w)
        out[d] = None if text is None else "\n".join(kept)
    return out
