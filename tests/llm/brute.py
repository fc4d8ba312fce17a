"""The operators' rules in plain loops over a few texts."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import xxhash

from osspulse.llm.bytestext import span_hashes

VISIBLE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(docs, items, window=13):
    """Per document: number of words, of hit words, sorted ids."""
    patterns = defaultdict(set)
    for item, text in items:
        words = alnum_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            patterns[tuple(words[i : i + window])].add(str(item))
    out = {}
    for doc, text in docs.items():
        words, hit, found = alnum_words(text), set(), set()
        for size in {len(p) for p in patterns}:
            for i in range(len(words) - size + 1):
                key = tuple(words[i : i + size])
                if key in patterns:
                    hit.update(range(i, i + size))
                    found |= patterns[key]
        out[doc] = len(words), len(hit), sorted(found)
    return out


@lru_cache(maxsize=None)
def word_hash(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


def remove_repeats(docs, least_sentences=3, least_words=20, window=10):
    """Texts by id without repeats: cuts at marks and at the least hash of each window, spans in both directions."""
    seen, out = set(), {}
    for doc in sorted(docs):
        text = docs[doc] or ""
        words = list(re.finditer(VISIBLE, text))
        hashes = [0 if w[0][-1] in ".!?" else word_hash(w[0]) for w in words]
        ends = {len(words)} - {0}
        for i in range(len(words) - window + 1):
            ends.add(1 + max(range(i, i + window), key=lambda j: (-hashes[j], j)))
        for i, (word, after) in enumerate(zip(words, words[1:], strict=False)):
            if word[0][-1] in ".!?" or "\n" in text[word.end() : after.start()]:
                ends.add(i + 1)
        cuts, gone = [0, *sorted(ends)], set()
        n = len(cuts) - 1
        fits = lambda a, b: b - a >= least_sentences and cuts[b] - cuts[a] >= least_words
        forward = {(a, next((b for b in range(a, n + 1) if fits(a, b)), None)) for a in range(n)}
        backward = {(next((a for a in range(b, -1, -1) if fits(a, b)), None), b) for b in range(n + 1)}
        for a, b in sorted(s for s in forward | backward if None not in s):
            key = tuple(tuple(w[0] for w in words[i:j]) for i, j in zip(cuts[a:b], cuts[a + 1 : b + 1], strict=True))
            if key in seen:
                gone.update(range(a, b))
            seen.add(key)
        bounds = [0, *(words[c].start() for c in cuts[1:-1]), len(text)]
        kept = "".join(text[bounds[i] : bounds[i + 1]] for i in range(n) if i not in gone)
        out[doc] = kept if gone else docs[doc]
    return out


def fingerprint(text, words=3, seed=42):
    found = re.findall(VISIBLE, lower(text))
    if not found:
        return 0
    runs = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, distance=3):
    """Smallest key that links reach, for each key of {key: fingerprint}."""
    keys = sorted(values)
    bits = np.array([values[k] for k in keys], np.uint64)
    parent = list(range(len(keys)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= distance).tolist():
            a, b = top(i), top(i + 1 + j)
            parent[max(a, b)] = min(a, b)
    return {k: keys[top(i)] for i, k in enumerate(keys)}


def statistics(text):
    text = text or ""
    words = re.findall(VISIBLE, text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(VISIBLE, line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


def pieces(text, tokenizer, capacity=2048):
    """Piece, start, length, checksum."""
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    short = len(ids) % capacity or capacity
    bounds = [0, *range(short, len(ids) + 1, capacity)]
    raw = np.array(ids, "<u4").tobytes()
    return [(i, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
