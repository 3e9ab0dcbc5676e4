"""Mixing of rows whose ids are null or repeated, and of equal rows, against a walk in the seeded order."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from brute import NON_SPACE
from test_tables import mix_frame, water_filling

from erpweave.llm import mixing


def walk(rows):
    """Counter of (doc_id, size, copies): every source takes rows by hash while the next one brings it nearer."""
    groups, sizes = defaultdict(list), Counter()
    for i, text, source in rows:
        size = len(NON_SPACE.findall(text or ""))
        digest = hashlib.md5(f"0:{'null' if i is None else i}:{text or ''}".encode()).hexdigest()
        groups[source].append((digest, i, size))
        sizes[source] += size
    targets, out = water_filling(sizes), Counter()
    for source, group in groups.items():
        whole = math.floor(targets[source] / sizes[source]) if sizes[source] else 0
        goal, upto = targets[source] - whole * sizes[source], 0
        for _, i, size in sorted(group, key=lambda r: r[0]):
            upto += size
            out[i, size, whole + (goal > 0 and 2 * upto - size <= 2 * goal)] += 1
    return out


def cases():
    rng = random.Random(5)

    def text():
        return " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 40)))

    yield "null ids", [(None if n % 3 else n, text(), rng.choice(["a", "b", None])) for n in range(900)]
    yield "one repeated id", [(7 if n % 2 else n, text(), "b" if n % 4 else "a") for n in range(500)]
    yield "equal rows", [(None, "x y z", "a")] * 600 + [(n, text(), rng.choice("ab")) for n in range(200)]
    yield "only equal rows", [(1, "x y", "a")] * 301 + [(1, "x y", "b")] * 7 + [(2, None, "c")] * 5 + [(None, "", None)] * 5


@pytest.mark.parametrize(("name", "rows"), list(cases()))
def test_rows_are_taken_one_by_one(spark, name, rows):
    docs = mix_frame(spark, rows).repartition(5)
    plan = mixing.mix_plan(docs).collect()
    got = Counter((r.doc_id, r.size, r.copies) for r in plan)
    assert {k: n for k, n in got.items() if k[1]} == {k: n for k, n in walk(rows).items() if k[1]}
    assert len(plan) == len(rows)
    taken, target, longest = Counter(), {}, Counter()
    for r in plan:
        taken[r.source_size, r.target] += r.taken
        longest[r.source_size, r.target] = max(longest[r.source_size, r.target], r.size)
    assert all(abs(taken[k] - k[1]) <= longest[k] for k in taken)
    mixed = Counter((r.doc_id, len(NON_SPACE.findall(r.text or ""))) for r in mixing.mix_documents(docs).collect())
    want = Counter()
    for (i, size, copies), n in got.items():
        want[i, size] += copies * n
    assert {k: n for k, n in mixed.items() if k[1]} == {k: n for k, n in want.items() if k[1] and n}
