"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def remainder(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def decontaminate(text, items, size=13):
    words = ALNUM_WORD.findall(lower(text))
    windows = {}
    for item_id, item in items:
        own = ALNUM_WORD.findall(lower(item))
        for i in range(max(len(own) - size, 0) + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item_id)
    hit, found = set(), set()
    for length in {len(w) for w in windows}:
        for at in range(len(words) - length + 1):
            if (window := tuple(words[at : at + length])) in windows:
                hit.update(range(at, at + length))
                found |= windows[window]
    ids = sorted({str(x) for x in found if x is not None})
    return len(words), len(hit), len(ids), sha(",".join(ids).encode()), len(hit) > 0 and 20 * len(hit) >= len(words)


def quality(text):
    words = SPACE_WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeat = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat), failed


def cut_bytes(rows, size):
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for text in texts:
        gone = [False] * len(text)
        for i in range(len(text) - size + 1):
            if seen[text[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(text), sum(gone), spans, sha(bytes(b for b, g in zip(text, gone) if not g))))
    return out


def cut_words(rows, size):
    low = -(2**63)
    words = [SPACE_WORD.findall(text or "") for _, text in rows]
    first = {}
    for (doc, _), own in zip(rows, words):
        for i in range(len(own) - size + 1):
            key = tuple(own[i : i + size])
            first[key] = min(first.get(key, 2**63), low if doc is None else doc)
    out = []
    for (doc, _), own in zip(rows, words):
        gone = [False] * len(own)
        for i in range(len(own) - size + 1):
            if first[tuple(own[i : i + size])] < (low if doc is None else doc):
                gone[i : i + size] = [True] * size
        out.append((len(own), sum(gone), sha(" ".join(w for w, g in zip(own, gone) if not g).encode())))
    return out


def unigram(rows, learned):
    tokens = [SPACE_WORD.findall(lower(text)) + [None] for _, text in rows]
    counts = Counter(t for own, use in zip(tokens, learned) if use for t in own)
    total, kinds = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in own) for own in tokens]
    return [(len(own), sum(counts[t] > 0 for t in own), total, b) for own, b in zip(tokens, base)]


def licenses(text, phrases):
    words = ALNUM_WORD.findall(lower(text))
    places, labels = [], set()
    for label, phrase in phrases:
        own = phrase.split()
        for at in range(len(words) - len(own) + 1):
            if words[at : at + len(own)] == own:
                places.append(at)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def word_shingles(text, size):
    words = SPACE_WORD.findall(lower(text))
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))) if words else frozenset()


def shingles(text):
    return word_shingles(text, 3)


def jaccard(rows, percent=90):
    """(n_shingles, component) of each row; rows of one id hang together."""
    low = -(2**63)
    sets = [shingles(text) for _, text in rows]
    ids = [low if doc is None else doc for doc, _ in rows]
    group = {}

    def top(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    filled = [i for i, s in enumerate(sets) if s]
    for n, i in enumerate(filled):
        for j in filled[:n]:
            both = len(sets[i] & sets[j])
            if ids[i] == ids[j] or 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = top(ids[i]), top(ids[j])
                group[max(a, b)] = min(a, b)
    comp = [top(i) if s else i for i, s in zip(ids, sets)]
    return [(len(s), None if c == low else c) for s, c in zip(sets, comp)]


def phrase_counts(rows, max_words=5):
    """(counts by (lang, words), words by lang) of (lang, text) rows."""
    counts, total = Counter(), Counter()
    for lang, text in ((lang if lang is not None else "und", text) for lang, text in rows):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    return counts, total


def collocations(rows, min_count, top, max_words=5):
    counts, total = phrase_counts(rows, max_words)
    frequent = {p: a for p, a in counts.items() if a >= min_count}
    inside = set()
    for p, a in frequent.items():
        parts = [(p[0], *p[i:j]) for i in range(1, len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) - 1]
        inside.update(q for q in parts if a >= frequent[q])
    scored = defaultdict(list)
    for p, a in frequent.items():
        if len(p) > 2 and p not in inside:
            cuts = [(1000 * a * total[p[0]] // (counts[p[: k + 1]] * counts[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
            score, k = min(cuts)
            scored[p[0]].append((-score, -a, " ".join(p[1:]).encode(), counts[p[: k + 1]], counts[(p[0], *p[k + 1 :])]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, found in scored.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )
