"""Pairs of sets that share many open signatures are made once and none is lost."""

import itertools

import pyarrow as pa
import pytest
from pyspark.sql import DataFrame
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from erpweave.llm import ngram_join as N


def _made(spark, monkeypatch, members, keys):
    """The pairs of ``_open_pairs``, and how many its tasks made."""
    counted = spark.sparkContext.accumulator(0)
    apply = PandasCogroupedOps.applyInArrow

    def counting(self, func, schema):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = func(left, right)
            counted.add(out.num_rows)
            return out

        return apply(self, run, schema)

    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", counting)
    same = bytes(N.SKETCH_BITS // 8)
    info = spark.createDataFrame([(k, 100, same) for k in keys], "key long, n long, sketch binary")
    roots = spark.createDataFrame([], "node long, root long")
    left: DataFrame = N._open_members(spark.createDataFrame(members, "sig long, key long"), roots)
    pairs = sorted(map(tuple, N._open_pairs(left, info).collect()))
    return pairs, counted.value


@pytest.mark.parametrize("block", [4096, 7])
def test_a_pair_is_made_under_one_signature(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    keys = list(range(30))
    members = [(100 + s, k) for s in range(40) for k in keys]
    pairs, made = _made(spark, monkeypatch, members, keys)
    assert pairs == list(itertools.combinations(keys, 2))
    assert made == len(pairs)


def test_lists_that_end_too_soon_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(N, "LISTED", 2)
    keys = list(range(12))
    groups = [[k for k in keys if (k * s + k) % 5 != s % 5] for s in range(9)]
    members = [(s, k) for s, own in enumerate(groups) for k in own]
    pairs, _ = _made(spark, monkeypatch, members, keys)
    shared = {p for own in groups for p in itertools.combinations(own, 2)}
    assert pairs == sorted(shared)
