"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import numpy as np
import xxhash

LOWER = {c: c + 32 for c in range(65, 91)}


def components(nodes, pairs):
    """Least node that each node reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(texts):
    """Per number of a text, the least number its fingerprint reaches."""
    prints = [simhash(t) for t in texts]
    pairs = [(i, j) for i, j in combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    return prints, components(range(len(texts)), pairs)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items):
    own, hit, found = words(text), set(), set()
    for item, passage in items:
        w = words(passage)
        n = min(len(w), 10)
        for i in range(max(0, len(w) - n + 1) if n else 0):
            for k in range(len(own) - n + 1):
                if own[k : k + n] == w[i : i + n]:
                    hit.update(range(k, k + n))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def line_classes(docs, tau=2, min_chars=20):
    """``docs``: (id, text). For each (id, line number): first place of its class, and number of lines linked to it."""
    rows = [(d, n, s.strip(" \t\r\n\x0b\x0c")) for d, t in docs for n, s in enumerate((t or "").split("\n"))]
    long_lines = sorted({s for _, _, s in rows if len(s) >= min_chars}, key=len)
    pairs = []
    for i, a in enumerate(long_lines):
        for b in long_lines[i + 1 :]:
            if len(b) - len(a) > tau:
                break
            # At most tau of tau + 1 thirds can be touched, and those that aren't are inside the other line.
            cuts = [a[len(a) * k // (tau + 1) : len(a) * (k + 1) // (tau + 1)] for k in range(tau + 1)]
            if any(c in b for c in cuts) and edits(a, b) <= tau:
                pairs.append((a, b))
    root = components(long_lines, pairs)
    degree = {s: 0 for s in long_lines}
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    first = {}
    key = lambda place: (place[0] is None, place[0] or 0, place[1])
    for d, n, s in rows:
        if s in root:
            first[root[s]] = min(first.get(root[s], (d, n)), (d, n), key=key)
    return [(d, n, *(first[root[s]] if s in root else (d, n)), degree.get(s, 0)) for d, n, s in rows]


def without_repeated_lines(docs):
    """Texts by id after line dedup; a document that loses all of its lines is missing."""
    gone = {}
    for d, n, first_doc, first_line, _ in line_classes(docs):
        if (d, n) != (first_doc, first_line):
            gone.setdefault(d, set()).add(n)
    out = {}
    for d, text in docs:
        lines = [s for n, s in enumerate((text or "").split("\n")) if n not in gone.get(d, ())]
        if d not in gone or any(s.strip() for s in lines):
            out[d] = "\n".join(lines) if d in gone else text
    return out


def linked_lines(lines, allowed):
    """Pairs of different lines within ``allowed(length of the longer)`` edits. An edit changes two counts at most."""
    lines = sorted(lines, key=len)
    counts = np.array([np.bincount(np.frombuffer(s.encode("utf-32-le"), np.uint32) % 64, minlength=64) for s in lines]).reshape(-1, 64)
    sizes = np.array([len(s) for s in lines])
    pairs = []
    for i, a in enumerate(lines):
        # Allowed edits grow with the length, so those of the longest line in reach bound all before it.
        stop = i + 1
        while stop < len(lines) and sizes[stop] - len(a) <= allowed(int(sizes[stop])):
            stop += 1
        apart = np.abs(counts[i + 1 : stop] - counts[i]).sum(axis=1)
        for j in np.flatnonzero(apart <= 2 * allowed(int(sizes[stop - 1]))) + i + 1:
            if edits_up_to(a, lines[j], allowed(len(lines[j]))):
                pairs.append((a, lines[j]))
    return pairs


def edits_up_to(a, b, most):
    """Whether ``most`` edits suffice: the cells of the full table that are near enough to its diagonal."""
    if abs(len(a) - len(b)) > most:
        return False
    far = most + 1
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        fresh = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            best = min(row.get(j, far) + 1, fresh.get(j - 1, far) + 1)
            if j:
                best = min(best, row.get(j - 1, far) + (x != b[j - 1]))
            fresh[j] = min(best, far)
        row = fresh
        if min(row.values()) > most:
            return False
    return row[len(b)] <= most


def rule_classes(docs, allowed):
    """Every line that isn't blank: first place of its class and number of linked lines; blank ones for themselves."""
    at = [(d, n, s.strip(" \t\r\n\x0b\x0c")) for d, t in docs for n, s in enumerate((t or "").split("\n"))]
    lines = sorted({s for _, _, s in at if s})
    pairs = linked_lines(lines, allowed)
    root, first, degree = components(lines, pairs), {}, {}
    for pair in pairs:
        for s in pair:
            degree[s] = degree.get(s, 0) + 1
    for d, n, s in sorted(at, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        if s:
            first.setdefault(root[s], (d, n))
    return [(d, n, *(first[root[s]] if s else (d, n)), degree.get(s, 0)) for d, n, s in at]


def without_lines(docs, allowed, keep_under):
    """Texts by id (ids are different) after line dedup; short repeated lines stay beside a line of the text's own."""
    places = {}
    for d, n, first_doc, first_line, _ in rule_classes(docs, allowed):
        places.setdefault(d, []).append((d, n) == (first_doc, first_line))
    out = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        bare = [s.strip(" \t\r\n\x0b\x0c") for s in lines]
        kept = [s for s, b, own in zip(lines, bare, places[d]) if own or len(b) < keep_under]
        if all(places[d]) or any(own and b for own, b in zip(places[d], bare)):
            out[d] = text if len(kept) == len(lines) else "\n".join(kept)
    return out


def sha256(raw):
    return hashlib.sha256(raw).hexdigest()
