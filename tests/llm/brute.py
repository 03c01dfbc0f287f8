"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    shingles = shingles or ([" ".join(words)] if words else [])
    ones = Counter(
        b for s in shingles for h in [xxhash.xxh64_intdigest(s.encode(), 42)] for b in range(64) if h >> b & 1
    )
    return sum(1 << b for b, n in ones.items() if n * 2 > len(shingles))


def components(values, linked):
    """Smallest place reachable from each place."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if linked(values[a], values[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def near(a, b):
    return (a ^ b).bit_count() <= 2


def repeats(texts, window):
    """Per text: words and which of them are covered by a repeated window."""
    lists = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        covered = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                covered[i : i + window] = [True] * window
        out.append((w, covered))
    return out


def leaks(texts, items, window=10):
    """Per text: number of words, hit marks, items found."""
    owners = defaultdict(set)
    for item, text in items:
        w = FOLDED.findall(lower(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners[tuple(w[i : i + window])].add(item)
    sizes = {len(x) for x in owners}
    out = []
    for text in texts:
        w = FOLDED.findall(lower(text))
        covered, found = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in owners:
                    covered[i : i + n] = [True] * n
                    found |= owners[tuple(w[i : i + n])]
        out.append((w, covered, found))
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
