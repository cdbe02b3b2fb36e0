"""Naive Bayes over hashed character n-grams, one text and one n-gram at a time."""

import collections
import math

BUCKETS, SMOOTHING, WORD = 1 << 16, 0.5, 1 << 32
MULT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def bucket(gram):
    h = 0
    for i, c in enumerate(gram):
        h = ((h ^ h >> 15) * MULT[i] + ord(c) * MULT[0]) % WORD
    h = h * 0x2545F491 % WORD
    return ((h ^ h >> 15) * 0x9E3779B1 % WORD) >> 16


def features(text):
    s = "  " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + "  "
    return [bucket(s[i:i + n]) for n in (1, 2, 3) for i in range(len(s) - n + 1) if any(c.isalpha() for c in s[i:i + n])]


def train(pairs):
    """(text, label) pairs -> counts and documents per label; texts without letters and null labels do not count."""
    counts, docs = {}, collections.Counter()
    for text, label in pairs:
        found = features(text)
        if label is not None and found:
            counts.setdefault(label, collections.Counter()).update(found)
            docs[label] += 1
    return counts, docs


def predict(model, text):
    counts, docs = model
    found = features(text)
    if not found or not docs:
        return "und", 0.0
    score = {}
    for x in sorted(docs):
        total = sum(counts[x].values()) + SMOOTHING * BUCKETS
        score[x] = math.log(docs[x] / sum(docs.values())) + sum(math.log((counts[x][f] + SMOOTHING) / total) for f in found)
    best = max(score, key=score.get)
    return best, 1 / sum(math.exp(s - score[best]) for s in score.values())
