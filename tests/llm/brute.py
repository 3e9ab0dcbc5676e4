"""Plain-Python versions of the operators' definitions, for small inputs."""

from __future__ import annotations

import hashlib
import re

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
NON_SPACE = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def shingles(text):
    words = NON_SPACE.findall((text or "").translate(LOWER))
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(docs):
    """[(doc_id, n_shingles, component_id)] of [(doc_id, text)] with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def contamination(docs, items, window=10):
    """[(doc_id, n_words, n_hit, n_items, sha256, contaminated)]."""
    patterns = []
    for item, text in items:
        own = ALNUM.findall((text or "").translate(LOWER))
        size = min(window, len(own))
        patterns += [(str(item), own[k : k + size]) for k in range(len(own) - size + 1 if own else 0)]
    out = []
    for i, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item, p in patterns:
            for k in range(len(words) - len(p) + 1):
                if words[k : k + len(p)] == p:
                    hit |= set(range(k, k + len(p)))
                    found.add(item)
        names = ",".join(sorted(found))
        out.append((i, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    """Base spans (kind, start, end)."""
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 16 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 8 <= len(digits) <= 15)
            ):
                out.append((kind, m.start(), m.end()))
    return out
