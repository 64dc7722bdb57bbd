"""Plain Python versions of the operators, over whole small tables."""

import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text) if text else []


def substring_dedup(rows, window):
    """(doc_id, n_words, n_removed, kept_text) per (doc_id, text)."""
    least = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            if doc_id is not None:
                key = tuple(w[i:i + window])
                least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc_id is not None and least[tuple(w[i:i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingle_set(text, n=5):
    w = text.lower().encode().split()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0


def weighted_sets(texts, n=5, rare=0.01, spread=0.25):
    """Of each text its shingles with their weights."""
    sets = []
    for text in texts:
        w = text.lower().encode().split() if text else []
        sets.append(Counter(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter())
    df = Counter(s for c in sets for s in c)
    idf = {s: 1 + spread * math.log(min(1, max(rare, k / len(texts)))) / math.log(rare) for s, k in df.items()}
    return [{s: (1 + math.log(tf)) * idf[s] for s, tf in c.items()} for c in sets]


def weighted_jaccard(a, b):
    shared = sum(min(w, b[s]) for s, w in a.items() if s in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a or b else 0.0


def linked(sets, similarity, threshold):
    """Per set the least index reachable by links of at least the threshold."""
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if label[i] != label[j] and a and b and similarity(a, b) >= threshold:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label
