"""The text analytics once more in plain Python, for small fixtures."""

import math
import re
from collections import Counter, defaultdict


def tokens(text):
    return [t for t in re.split(r"[ \t\n\r\f]+", text) if t]


def clean(token):
    return re.sub(r"[^a-z0-9]", "", token.lower())


def words(text):
    return [w for w in map(clean, tokens(text)) if w]


def sentences(body):
    pieces = re.split(r"[.?!][ ]", body.replace("====>", ""))
    return [p for p in pieces if any(ch > " " for ch in p)]


def sentence_words(sentence):
    return {w for w in re.sub(r"[^ a-z0-9]", "", sentence.lower()).split(" ") if w}


def tf_idf(articles):
    counts = defaultdict(Counter)
    for doc_id, body in articles:
        counts[doc_id].update(words(body))
    counts = {doc_id: count for doc_id, count in counts.items() if count}
    df = Counter(word for count in counts.values() for word in count)
    result = {}
    for doc_id, count in counts.items():
        top = max(count.values())
        for word, n in count.items():
            tf = 0.5 + 0.5 * n / top
            result[doc_id, word] = tf * math.log10(len(counts) / df[word])
    return result


def scores(articles, k=5):
    weights = tf_idf(articles)
    result = {}
    for doc_id, body in articles:
        for sid, sentence in enumerate(sentences(body)):
            known = [
                weights[doc_id, word]
                for word in sentence_words(sentence)
                if (doc_id, word) in weights
            ]
            if known:
                result[doc_id, sid] = sum(sorted(known, reverse=True)[:k])
    return result


def summaries(articles, n=3, k=5):
    scored = defaultdict(list)
    for (doc_id, sid), score in scores(articles, k).items():
        scored[doc_id].append((round(score, 12), sid))
    result = {}
    for doc_id, body in articles:
        best = sorted(sid for _, sid in sorted(scored[doc_id], reverse=True)[:n])
        split = sentences(body)
        result[doc_id] = "".join(
            split[sid] + (" " if split[sid].endswith(".") else ". ") for sid in best
        )
    return result


def pagerank(edges, taxation, iterations=24, damping=0.85, unit=False):
    targets = defaultdict(set)
    for src, dst in edges:
        targets[src].add(dst)
    start = 1 / len(targets)
    ranks = {src: start for src in targets}
    for _ in range(iterations):
        received = defaultdict(float)
        for src, rank in ranks.items():
            for dst in targets.get(src, ()):
                received[dst] += rank / len(targets[src])
        if taxation:
            base = (1 - damping) * (1 if unit else start)
            received = {dst: base + damping * rank for dst, rank in received.items()}
        ranks = dict(received)
    return ranks
