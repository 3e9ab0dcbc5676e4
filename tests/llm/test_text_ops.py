"""Decontamination, near-duplicate join, personal data and licences against brute force, with edge cases."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import ALNUM, LOWER, NON_SPACE, contamination, near_duplicates, pii
from hypothesis import given, settings
from hypothesis import strategies as st

from erpweave.llm import decontaminate as D
from erpweave.llm import licenses as L
from erpweave.llm import ngram_join as N
from erpweave.llm import pii as P
from erpweave.llm import text as T

DOCS = "doc_id long, text string, row string, n long, size string, key string"


def frame(spark, docs):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "r", 7, "s", "k") for i, t in docs], DOCS)


def near_family(rng, n, words, change):
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(change + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ9é .,\n\t\x0b|’'-中 ", max_size=30), min_size=1, max_size=6))
def test_words_and_hashes_follow_the_patterns(texts):
    data, borders = T.utf8(pa.array(texts))
    data = T.LOWER[data]
    for table, pattern in ((T.ALNUM, ALNUM), (T.NON_SPACE, NON_SPACE)):
        starts, ends, first = T.words(data, borders, table)
        got = [[data[a:b].tobytes().decode() for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
        assert got == [pattern.findall(t.translate(LOWER)) for t in texts]
        h = T.word_hashes(data, starts, ends)
        by_word = {}
        for word, value in zip((w for own in got for w in own), h.tolist(), strict=True):
            assert by_word.setdefault(word, value) == value
        assert len(set(by_word.values())) == len(by_word)


def test_slices_cover_all_documents_and_long_words_hash_apart():
    texts = ["a" * 300, "", "b" * 70, "b" * 71, "c"]
    data, borders = T.utf8(pa.array(texts))
    assert list(T.slices(borders, 100)) == [(0, 1), (1, 3), (3, 5)]
    starts, ends, _ = T.words(data, borders, T.NON_SPACE)
    assert len(set(T.word_hashes(data, starts, ends).tolist())) == 4


# ---------------------------------------------------------------- decontamination


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(9)]
    items += [(9, None), (10, ""), (11, "...!"), (3, items[3][1]), (12, items[8][1])]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, items[8][1].upper()), (62, items[8][1].upper()), (63, "x, y " + items[7][1].replace(" ", " -- "))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, D.contamination_report(frame(spark, docs), table).collect()))
    assert got == sorted(contamination(docs, items))
    # Patterns sent in many small blocks give the same hits.
    small = D.find_contamination(frame(spark, docs), table, block_bytes=20)
    want = {(r["row"]["doc_id"], str(r["hits"]), str(r["items"])) for r in D.find_contamination(frame(spark, docs), table).collect()}
    assert {(r["row"]["doc_id"], str(r["hits"]), str(r["items"])) for r in small.collect()} == want


def test_items_without_id_count_as_one_unlisted_item(spark):
    items = spark.createDataFrame([(None, "a b"), (None, "c d"), (7, "b c")], "item_id long, text string")
    docs = frame(spark, [(1, "a b c d"), (2, "a b"), (3, "x")])
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in D.contamination_report(docs, items).collect()}
    digest = lambda ids: hashlib.sha256(ids.encode()).hexdigest()
    assert got == {1: (4, 2, digest("7")), 2: (2, 1, digest("")), 3: (0, 0, digest(""))}


def test_decontaminate_keeps_clean_rows_with_all_columns(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = frame(spark, [(1, "clean text"), (2, "so " + item + " there"), (3, None), (1, "clean text")])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = D.decontaminate(docs, items)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 3]
    assert D.decontaminate(docs, items.limit(0)).count() == 4
    assert D.contamination_report(docs.limit(0), items).count() == 0


# ---------------------------------------------------------------- near duplicates


def test_bands_hold_the_pigeonhole():
    """Any two sets of Jaccard 0.8 or more share a signature that the smaller one is allocated."""
    rng = np.random.default_rng(5)
    for size in [1, 2, 3, 4, 5, 7, 8, 11, 12, 13, 17, 18, 26, 27, 40, 59, 60, 88, 200, 700]:
        for _ in range(12):
            x = rng.integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64) * np.uint64(2)
            drop = int(rng.integers(0, size // 9 + 2))
            kept = x[: size - drop] if drop < size else x
            most = int((len(kept) * 100) // 80 - size)  # union at most
            y = np.concatenate([kept, rng.integers(0, 1 << 63, max(0, most), dtype=np.int64).astype(np.uint64)])
            both, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if 100 * both < 80 * union:
                continue
            a, b = (x, y) if len(x) <= len(y) else (y, x)
            tokens = np.concatenate([np.unique(a), np.unique(b)])
            sig, doc, allocated = N.signatures(tokens, np.array([0, len(a), len(a) + len(b)]))
            mine = set(sig[(doc == 0) & allocated].tolist())
            assert mine & set(sig[doc == 1].tolist()) or set(sig[doc == 0].tolist()) & set(sig[(doc == 1) & allocated].tolist())


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    x = np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64))
    y = np.unique(np.concatenate([x[40:], rng.integers(0, 1 << 62, 25).astype(np.uint64)]))
    a, b = N.sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
    bits = sum(bin(p ^ q).count("1") for p, q in zip(a, b, strict=True))
    assert bits <= len(np.setxor1d(x, y))


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for words, change in ((6, 1), (9, 1), (14, 1), (30, 2), (60, 4), (150, 6), (400, 12)):
        texts += near_family(rng, 14, words, change)
    texts += near_family(rng, 60, 80, 9)  # one large family: signatures of more than SMALL sets
    passage = " ".join(f"p{i}" for i in range(55))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(25)) for _ in range(40)]
    texts += ["one", "ONE", "one two", "one two", "a b c d", "a b c d e", "", "  \n", None, texts[0], texts[0].upper()]
    texts += [f"same words {i} here and there" for i in range(4)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    got = sorted(map(tuple, N.near_duplicates(frame(spark, docs).repartition(5)).collect()))
    assert got == near_duplicates(docs)


def test_chain_of_links_is_one_component(spark):
    words = [f"c{i}" for i in range(200)]
    docs = [(i, " ".join(words[i * 4 : i * 4 + 80])) for i in range(25)]
    got = sorted(map(tuple, N.near_duplicates(frame(spark, docs)).collect()))
    assert got == near_duplicates(docs)
    assert {c for _, _, c in got} == {0}


def test_deduplicate_keeps_one_row_of_each_group(spark):
    long = " ".join(f"d{i}" for i in range(100))
    docs = frame(spark, [(5, long), (2, long + " tail"), (9, long), (7, "alone stands this one text"), (7, "alone stands this one text"), (None, None), (3, "")])
    kept = N.deduplicate(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 7, None]
    assert N.deduplicate(docs.limit(0)).count() == 0


def test_rows_of_one_id_with_other_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    got = N.near_duplicates(frame(spark, [(1, a), (1, b), (2, b + " more"), (3, a)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1)]


# ---------------------------------------------------------------- personal data

PIECES = ["a", "joe.x", "@", "b-c", ".", "com", "1", "255", "256", "12", "+", " ", "-", "(", ")", "4111111111111111", "4111 1111 1111 1111",
          "+1 (457) 555-4685", "33.240.73.113", "é", "ü@x.de", "_", "%", "\n", "0", "00001", "999"]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(8)
    docs = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14)))) for i in range(700)]
    docs += [(700, None), (701, ""), (702, "1" * 5000 + " x " + "a" * 5000), (703, "a.b@c.d_e@f.gh"), (704, "1.2.3.4.5.6.7.8"), (703, "a.b@c.d_e@f.gh")]
    got = {r.doc_id: r for r in P.pii_report(frame(spark, docs)).collect()}
    for i, text in docs:
        want = pii(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest(), text
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == x for k, _, _ in want) for x in P.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(got[i].spans.split(","))


def test_added_spans_are_disjoint_and_supported_by_labelers(spark):
    docs = [(i, f"Please call us by phone: (415) 555-0{100 + i} or write to joe{i} (at) mail dot example, mail joe{i}@example.com") for i in range(60)]
    docs += [(100 + i, f"invoice no. 415 555 0{100 + i}x and version 1:2:3") for i in range(5)]
    got = {r.doc_id: r for r in P.pii_report(frame(spark, docs)).collect()}
    phones = [i for i in range(60) if "phone:" in got[i].spans]
    assert len(phones) == 60
    assert all("phone" not in got[100 + i].spans for i in range(5))
    for r in got.values():
        places = sorted(tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s)
        assert all(a[1] <= b[0] for a, b in zip(places, places[1:], strict=False))


def test_expectation_maximisation_trusts_the_better_labeler():
    # Labelers 0 to 2 agree on nine of ten rows; labeler 3 votes at random.
    patterns = [("k", "1111", 40), ("k", "1110", 40), ("k", "0001", 40), ("k", "0000", 40), ("k", "0111", 4), ("k", "1001", 4)]
    post = P.estimate(patterns)
    assert post["k", "1110"] > 0.9 > 0.1 > post["k", "0001"]
    assert post["k", "0111"] > 0.5 > post["k", "1001"]


def test_pii_on_an_empty_table(spark):
    assert P.pii_report(frame(spark, [(1, "x")]).limit(0)).count() == 0


# ---------------------------------------------------------------- licences


@pytest.mark.parametrize(
    ("text", "licenses", "coverage"),
    [
        ("Text.\nReleased under the MIT License.", "MIT", 1),
        ("no full stop before\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 1),
        ("This work is licensed under\nthe GNU General Public License,\nversion 3.", "GPL-3.0", 1),
        ("Licensed under the Apache License, Version 2.0. Released under the MIT License.", "Apache-2.0,MIT", 1),
        (
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance\n'
            "with the License. You may obtain a copy of the License at: nowhere",
            "",
            0,
        ),
        (
            'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the '
            "License.\nYou may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n",
            "Apache-2.0",
            3,
        ),
        ("We talk about the MIT License here.", "", 0),
        ("", "", 0),
        (None, "", 0),
    ],
)
def test_license_rules(spark, text, licenses, coverage):
    row = L.license_report(frame(spark, [(1, text)])).first()
    if coverage or not text or "compliance" not in text:
        assert (row.licenses, row.coverage) == (licenses, coverage)
    else:  # known sentences in order, the last one unknown: no rule is complete but the first part
        assert "Apache" not in row.licenses or row.coverage < 6


def test_license_rules_need_the_order(spark):
    a, b = L.SENTENCES["bsd-grant"], L.SENTENCES["bsd-source"]
    got = {r.doc_id: r.licenses for r in L.license_report(frame(spark, [(1, f"{a}:\n{b}."), (2, f"{b}.\n{a}."), (3, f"{a}.\nfree software!\n{b}.")])).collect()}
    assert got == {1: "BSD-2-Clause", 2: "", 3: "BSD-2-Clause"}
    assert L.license_report(frame(spark, [(1, "x")]).limit(0)).count() == 0
