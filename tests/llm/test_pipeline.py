"""The pipeline against a brute-force version, the registered queries against their SQL, and the guard."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
import tempfile
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from brute import contamination, near_duplicates

import __spark_entry__ as entry
import corpus_pipeline
from erpweave.llm import quality
from erpweave.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from erpweave.llm.stored import stored

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def as_duck(sf):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {table} AS FROM '{sf}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    got = QUERIES[name](spark, SF)
    want = as_duck(SF).sql(ORACLE_SQL[name])
    assert got.columns == list(want.columns)
    assert Counter(map(repr, map(tuple, got.collect()))) == Counter(map(repr, want.fetchall()))


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names if name.startswith("op") and name[2].isdigit()}
    assert "pipeline" in names and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    after, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(spark, stage(spark, after, SF), f"test-{name}")
        assert after.columns == columns
        kept[name] = Counter(r.doc_id for r in after.collect())

    good = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted}
    assert set(kept["quality"]) == good and max(kept["quality"].values()) == 1
    first = {i for i, _, c in near_duplicates([(i, rows[i].text) for i in sorted(good)]) if i == c}
    assert set(kept["near_duplicates"]) == first
    clean = {r[0] for r in contamination([(i, rows[i].text) for i in first], benchmark) if not r[5]}
    assert set(kept["decontaminate"]) == clean
    assert set(kept["mix"]) <= clean and max(kept["mix"].values()) <= 2

    from tokenizers import Tokenizer

    coder, start, want = Tokenizer.from_file(tokenizer_path()), 0, []
    for i in sorted(kept["mix"].elements()):
        ids = np.array([*coder.encode(rows[i].text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, after, SF).collect()), key=lambda r: r[1]) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=lambda r: r[1]) == want


def test_the_rest_works_without_this_subpackage():
    """A copy of the repository without the llm folders and the pipeline still imports and lists its queries."""
    copy = tempfile.mkdtemp(prefix="without-llm-")
    ignore = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, f"{copy}/repo", ignore=ignore)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()); print(len(q), any(n.startswith('op') for n in q))"
    env = {**os.environ, "PYTHONPATH": f"{copy}/repo"}
    done = subprocess.run([sys.executable, "-c", code], cwd=f"{copy}/repo", env=env, capture_output=True, text=True, check=False, timeout=120)
    assert done.returncode == 0 and done.stdout.split()[1] == "False", done.stderr[-500:]
