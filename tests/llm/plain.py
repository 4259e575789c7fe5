"""Plain Python versions of the corpus operators, for comparison on small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def sha(data):
    return hashlib.sha256(data).hexdigest()


def substrings(rows, width=100):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            piece = data[i : i + width]
            if piece in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(piece)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), runs, sha(kept))
    return out


def shingle_sets(rows, words=4):
    out = {}
    for doc, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        n = min(words, len(w))
        out[doc] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    return out


def near_duplicates(rows, words=4, percent=85):
    sets, docs_of, shared = shingle_sets(rows, words), defaultdict(list), Counter()
    for doc, tokens in sorted(sets.items()):
        for t in tokens:
            for other in docs_of[t]:
                shared[other, doc] += 1
            docs_of[t].append(doc)
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), top(d)) for d in sets}


ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if m.end() - m.start() >= 24]
    names = ("assign", "access", "hex")
    spans = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))
    return tuple(sum(k == kind for _, kind, _ in found) for k in range(3)), sha(spans.encode())


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall((text or "").encode().lower())
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[i : i + window])].add(str(item))
    out = {}
    for doc, text in rows:
        w = WORD.findall((text or "").encode().lower())
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit[i : i + n] = [True] * n
                    found |= windows[tuple(w[i : i + n])]
        out[doc] = (len(w), sum(hit), len(found), sha(",".join(sorted(found)).encode()), any(hit))
    return out


def grams(text):
    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] != " ":
                    counts[padded[i : i + n]] += 1
    return counts


def ranked(counts, ranks=300):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:ranks]]


def languages(rows, ranks=300):
    """rows: (doc_id, text, lang)."""
    learned = defaultdict(Counter)
    out_of = {d: zlib.crc32(str("" if d is None else d).encode()) % 3 == 1 for d, _, _ in rows}
    for d, text, lang in rows:
        if not out_of[d] and lang is not None:
            learned[lang].update(grams(text or ""))
    profiles = {name: {g: i for i, g in enumerate(ranked(c, ranks))} for name, c in learned.items() if c}
    out = {}
    for d, text, _ in rows:
        own = ranked(grams(text or ""), ranks)
        if not any(c.isalpha() for g in own for c in g) or not profiles:
            out[d] = (out_of[d], "und", 0.0)
            continue
        apart = {
            name: sum(abs(i - p[g]) if g in p else ranks for i, g in enumerate(own)) for name, p in profiles.items()
        }
        best = min(sorted(apart), key=apart.get)
        out[d] = (out_of[d], best, 1 - apart[best] / (ranks * len(own)))
    return out


def nearest(rows, k=5):
    """rows: (vec_id, components); queries are ids divisible by 50."""
    vectors = {
        i: [math.floor(256 * x) for x in v] for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q in sorted(i for i in vectors if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out
