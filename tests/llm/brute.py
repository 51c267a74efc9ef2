"""Plain versions of the operators' results."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, links):
    """The smallest position reachable from each position."""
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in links:
        i, j = root(i), root(j)
        if i != j:
            up[max(i, j)] = min(i, j)
    return [root(i) for i in range(n)]


def components(ids, links):
    """The smallest id, NULL apart, of each row's component."""
    top = roots(len(ids), links)
    least = {}
    for i, r in enumerate(top):
        if ids[i] is not None:
            least[r] = min(ids[i], least.get(r, ids[i]))
    return [least.get(r) for r in top]


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def near(docs, size, percent):
    sets = [shingles(t, size) for _, t in docs]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    found = components([d for d, _ in docs], links)
    return sorted(
        ((d, len(s), c if s else d, d is not None and (c if s else d) == d) for (d, _), s, c in zip(docs, sets, found, strict=True)),
        key=str,
    )


def repeats(docs, length):
    bodies = [(t or "").encode() for _, t in docs]
    seen = Counter(b[s : s + length] for b in bodies for s in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(docs, bodies, strict=True):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {k for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    n = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
    return (*n, n[0] < 10 or 100 * n[4] > 20 * n[0])


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def phrases(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in at]
    return (len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))


def little(ids):
    return np.array(ids, "<u4").tobytes()


def crc(ids):
    return zlib.crc32(little(ids))
