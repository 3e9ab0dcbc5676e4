"""Places of matches in texts that hold very many, and spans apart from others."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from erpweave.llm import pii as P

NUMBERS = P.BASE["card"]


def found(spark, text, pattern):
    df = spark.createDataFrame([(text,)], "t string").repartition(1)
    return [tuple(x) for x in df.select(P.spans(F.col("t"), pattern).alias("x")).first().x]


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 512, 513, 20_000])
def test_spans_equal_python(spark, n):
    rng = random.Random(n)
    text = "".join(rng.choice(["12", "345 67", "9-8"]) + rng.choice([",", ";é", " 𝒳 ", "x" * rng.randrange(90) + "!"]) for _ in range(n))
    want = [
        (m.start(), m.end(), m[0], text[max(0, m.start() - P.AROUND) : m.start()], text[m.end() : m.end() + 1])
        for m in re.finditer(r"[0-9](?:[ -]?[0-9])+", text)
    ]
    assert found(spark, text, NUMBERS) == want


def test_time_is_in_proportion_to_the_matches(spark):
    def seconds(n):
        start = time.monotonic()
        assert len(found(spark, "12,34;" * (n // 2), NUMBERS)) == n
        return time.monotonic() - start

    seconds(1000)
    small, large = max(0.5, seconds(20_000)), seconds(100_000)
    assert large < 12 * small


def test_a_long_table_of_numbers_is_read_whole(spark):
    line = "mail a.b@c.org and +1 202 555 0147 or call 202-555-0199, host 10.1.2.3; "
    docs = spark.createDataFrame([(1, line * 5000), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in P.pii_report(docs).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (5000, 5000, 0, 5000)
    assert got[2].spans == got[3].spans == ""
    last = max(int(s.split(":")[2]) for s in got[1].spans.split(","))
    assert last == len(line) * 5000 - 2


def test_apart_equals_all_pairs(spark):
    rng = random.Random(3)

    def some(n, top):
        return [(s, s + rng.randrange(1, 9), "m", "", "") for s in (rng.randrange(top) for _ in range(n))]

    cases = [(i, some(rng.randrange(200), 400), some(rng.randrange(60), 400)) for i in range(30)]
    kind = "array<struct<s: int, e: int, m: string, before: string, after: string>>"
    df = spark.createDataFrame(cases, f"i int, a {kind}, b {kind}")
    got = {r.i: sorted(tuple(x) for x in r.x) for r in df.select("i", P.apart(F.col("a"), F.col("b")).alias("x")).collect()}
    for i, a, b in cases:
        assert got[i] == sorted(x for x in a if not any(y[0] < x[1] and x[0] < y[1] for y in b)), i
