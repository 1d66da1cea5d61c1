"""The training-data operators once more in plain Python, for small tables."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def classes(rows, k, least, per=100):
    """``{doc_id: (size, smallest id reachable)}`` by comparing all pairs."""
    sets = {doc_id: shingles(text, k) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [doc_id for doc_id in sets if sets[doc_id]]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if per * both >= least * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in sets}


def copies(rows):
    """``{doc_id: (keep_id, group_size)}`` of equal texts."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return {d: (max(ids), len(ids)) for ids in groups.values() for d in ids}


def text_counts(text):
    """Words, code points in them, symbols, repeated lines, repeated words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    threes = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {
        j
        for i in range(len(words) - 2)
        if threes[tuple(words[i : i + 3])] > 1
        for j in range(i, i + 3)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def license_places(text, phrases):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    places = [
        (i, label)
        for phrase, label in phrases.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), sorted(places)
