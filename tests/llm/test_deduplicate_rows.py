"""Rows that share a doc_id or have none: each component keeps a row of its own."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from brute import near_duplicates
from erpweave.llm import ngram_join as N


def text(name, words=40):
    return " ".join(f"{name}{k}" for k in range(words))


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, "r") for i, t in rows], "doc_id long, text string, _root string, h int, row string")
    got = N.deduplicate(docs)
    assert got.schema == docs.schema
    return sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)


def test_rows_of_no_or_repeated_ids_are_told_apart_by_text(spark):
    near = text("n") + " more"
    rows = [(None, text(f"null{k}_")) for k in range(6)]  # no id, unlike texts
    rows += [(5, text("b")), (5, text("a"))]  # one id, unlike texts
    rows += [(None, text("n")), (8, near), (9, text("n")), (None, "aa")]  # a group whose first row has no id
    rows += [(7, text("m")), (7, "a smaller text of no group"), (30, text("m")), (31, text("m"))]  # its id also on a smaller text
    rows += [(None, ""), (None, None), (3, " \t"), (3, None)]  # no shingles
    rows += [(40, text("z")), (40, text("z")), (40, text("z") + " more")]  # copies under one id
    want = [*rows[:6], *rows[6:8], (None, text("n")), (None, "aa"), (7, text("m")), rows[13], *rows[16:20], (40, text("z"))]
    assert kept(spark, rows) == sorted(want, key=repr)


def test_rows_of_no_id_fetch_one_text_a_class(spark, monkeypatch):
    fetched = []
    real = N.class_rows

    def counted(docs, info, pairs):
        found = real(docs, info, pairs)
        fetched.append(found.count())
        return found

    monkeypatch.setattr(N, "class_rows", counted)
    rows = [(None, text(f"f{k // 2}_") + (" more" if k % 2 else "")) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = N.near_duplicates(docs)
    assert got.count() == 300
    assert got.filter("doc_id is not null or component_id is not null").isEmpty()
    assert sum(fetched) <= 300
    assert N.deduplicate(docs).count() == 150


def test_hub_text_is_dealt_out_and_no_link_is_lost(spark, monkeypatch):
    monkeypatch.setattr(N, "HUB", 3)
    monkeypatch.setattr(N, "BLOCK", 8)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(70):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    passage = " ".join(base[:60])
    rows += [(100 + i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(20 + i % 3))) for i in range(60)]
    rows += [(200 + i, rows[100 + i][1] + " tail") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("x"))
    assert sorted(map(tuple, N.near_duplicates(docs).collect())) == near_duplicates(rows)


def test_pipeline_stages_keep_rows_of_no_or_repeated_ids(spark, tmp_path):
    """The stages after the classifier, over rows that share ids or have none."""
    import corpus_pipeline

    rows = [(None, f"s{k % 2}", text(f"p{k}_")) for k in range(12)] + [(4, "s0", text(f"q{k}_")) for k in range(6)]
    rows += [(50, "s1", text("p0_") + " more"), (None, None, text("r")), (None, "s0", None), (60, "s1", "")]
    rows += [(70, "s0", text("bench"))]
    docs = spark.createDataFrame([(i, t, s, "en", len(t or "")) for i, s, t in rows], "doc_id long, text string, source string, lang string, n_chars long")
    spark.createDataFrame([(None, text("bench", 12)), ("b", text("other", 12))], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    once = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert once.count() == len(rows) - 1  # one of the two near copies went
    clean = corpus_pipeline.drop_contaminated(spark, once, str(tmp_path))
    assert clean.count() == len(rows) - 2 and clean.filter("doc_id = 70").isEmpty()
    mixed = corpus_pipeline.mix_sources(spark, clean, str(tmp_path))
    assert mixed.columns == docs.columns
    n = mixed.count()
    read = corpus_pipeline.STAGES[-1][1](spark, mixed, str(tmp_path))
    assert read.count() == n
