"""Merkle manifest, conversation trie and quality rules against plain Python, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from brute import LOWER, NON_SPACE

from erpweave.llm import line_frequency, merkle, prefix_trie
from erpweave.llm.queries import op12_prefix_trie
from erpweave.llm.stored import workers_find_package

SF = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- Merkle manifest

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, key int, path int"


def leaf(row, text=None):
    values = [*row[:4], row[4] if text is None else text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        out.append(nodes)
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        run, place = nodes[i - i % 16 : i - i % 16 + 16], i % 16
        out.append((run[:place], run[place + 1 :]))
        i //= 16
    return out


def manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in by[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf(r, r[4].translate(LOWER))
            for a, b in path:
                node = sha("".join([*a, node, *b]))
            proof = sha("".join("".join(a + b) for a, b in path))
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, proof, node, node == root))
    return out


def doc_rows(sizes, seed=3):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Ünï Text", "all small", "A" * rng.randrange(40), f"Row {rng.random()}"])
            doc_id = rng.choice([None, *range(1000, 1400)])
            rows.append((doc_id, source, rng.choice([None, "en"]), rng.choice([None, 7]), text))
    return rows + rows[:5]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCS)


def same(a, b):
    return Counter(map(tuple, a)) == Counter(map(tuple, b))


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 16, None: 17, "é": 256, "Z": 257, "": 2},
        {"hot": 4300, **{f"s{i}": 1 + i % 3 for i in range(20)}},
        {f"source {i}": 1 for i in range(300)},
    ],
)
def test_manifest_equals_plain_tree(spark, sizes):
    rows = doc_rows(sizes)
    assert same(merkle.manifest(frame(spark, rows)).collect(), manifest(rows))


def test_manifest_of_no_rows_and_any_partitioning(spark):
    rows = doc_rows({"a": 40, "b": 3})
    docs = frame(spark, rows)
    assert merkle.manifest(docs.limit(0)).count() == 0
    assert same(merkle.manifest(docs.repartition(7)).collect(), merkle.manifest(docs.coalesce(1)).collect())


def test_every_change_breaks_the_proof(spark):
    """Folding any other leaf does not give the root; folding the own leaf does."""
    rows = doc_rows({"a": 300, "b": 2})
    for r in merkle.proofs(frame(spark, rows)).limit(50).collect():
        for start, holds in ((r.leaf, True), (sha(r.leaf), False)):
            for p in r.path:
                start = sha(p.left + start + p.right)
            assert (start == r.root) is holds


# ---------------------------------------------------------------- conversation trie

TURNS = "conv_id long, turn long, role string, text string, node string, depth int, shard int"


def trie(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, role, digest, text))
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = sorted(own.get(c - (abs(c) % 20) * (1 if c > 0 else -1), []))
        seqs[c] = tuple((t[2], t[4]) for t in base[:h] + sorted(own[c])[h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)

    def below(p):
        leaves, saved = (0 if children[p] else 1), (len(members[p]) - 1) * (len(NON_SPACE.findall(p[-1][1])) if p else 0)
        for q in list(children[p]):
            x, y = below(q)
            leaves, saved = leaves + x, saved + y
        return leaves, saved

    out = []
    for p, m in members.items():
        leaves, saved = below(p)
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves, saved, sha(ends)))
    return out


def turn_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), 10**12, -3, -20, -25]:
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            text = rng.choice([None, "", "same words here", "b", f"own {rng.randrange(6)}"])
            rows.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", "user", None, "bot"]), text))
    return [*rows, *rows[:4], (None, 0, "user", "no conversation")]


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TURNS)


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_trie_equals_plain_prefixes(spark, size):
    workers_find_package(spark)
    rows = turn_rows(90, size)
    assert same(prefix_trie.prefix_trie(turn_frame(spark, rows), size).collect(), trie(rows))


def test_trie_pieces_of_few_cells(monkeypatch):
    """Pieces of a shard recombine like shards: long conversations stand in matrices of their own."""
    import pyarrow as pa

    rng = random.Random(5)
    seqs = sorted(bytes(16) * rng.randrange(3) + b"".join(bytes([rng.randrange(3)] * 16) for _ in range(rng.randrange(9))) for _ in range(60))
    seqs += [bytes([9] * 16) * 400] * 2
    table = pa.table({
        "shard": [0] * 62, "side": pa.array([0] * 62, pa.int32()), "pos": list(range(62)), "conv_id": list(range(62)),
        "seq": pa.array(seqs, pa.binary()), "words": pa.array([[1] * (len(s) // 16) for s in seqs], pa.list_(pa.int32())),
    })

    def totals():
        parts = prefix_trie.shard_nodes(table).to_pylist()
        keyed = defaultdict(lambda: [0, 0, 0, 0])
        plain = Counter()
        for r in parts:
            values = [r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]]
            if r["node"] is None:
                plain[(r["conv_id"], r["depth"], *values)] += 1
            else:
                keyed[(r["node"], r["depth"])] = [a + b for a, b in zip(keyed[(r["node"], r["depth"])], values)]
        return Counter((k[1], *v) for k, v in keyed.items()) + Counter((k[1], *k[2:]) for k in plain.elements())

    whole = totals()
    for cells in (1, 40, 500):
        monkeypatch.setattr(prefix_trie, "CELLS", cells)
        assert totals() == whole


def test_trie_turnless_and_empty(spark):
    workers_find_package(spark)
    rows = [(c, 0, "user", "x y") for c in (1, 2, 3, 5, 7)]  # no family head: many lose their only turn
    got = prefix_trie.prefix_trie(turn_frame(spark, rows)).collect()
    assert same(got, trie(rows)) and min(r.depth for r in got) == 0
    assert prefix_trie.prefix_trie(turn_frame(spark, rows).limit(0)).count() == 0
    only_null = turn_frame(spark, [(None, 0, "user", "x")])
    assert prefix_trie.prefix_trie(only_null).count() == 0


def test_trie_query_on_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert same(op12_prefix_trie(spark, SF).collect(), trie(rows))


# ---------------------------------------------------------------- quality rules

RULES = "doc_id long, source string, text string, h string, lines int, row int"


def rules(rows, min_docs, share, keep=0.3):
    def normal(line):
        return " ".join(NON_SPACE.findall(line)).translate(LOWER)

    texts = defaultdict(set)
    for _, source, text in rows:
        texts[source].add(text or "")
    often = {}
    for source, found in texts.items():
        counts = Counter(x for t in found for x in {normal(y) for y in t.split("\n")} if x)
        often[source] = {x for x, n in counts.items() if n > max(min_docs, share * len(found))}
    out = []
    for doc_id, source, text in rows:
        text = text or ""
        words = NON_SPACE.findall(text)
        grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        inside = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if NON_SPACE.search(x)]
        removed = sum(len(NON_SPACE.findall(x)) for x in lines if normal(x) in often[source])
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        kept = not failed and not len(words) - removed < keep * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), sum(text.count(x) for x in "#*$%&|<>"),
                    len(lines) - len(set(lines)), len(inside), removed, failed, kept))
    return out


def rule_rows(n=150, seed=4):
    rng = random.Random(seed)
    boiler = ["Accept  all\tcookies", "accept all cookies", " © Éxample & Co "]
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choice("abc$#é") * rng.randrange(1, 4) + str(rng.randrange(30)) for _ in range(rng.randrange(14))) for _ in range(4)]
        lines += rng.sample(boiler, rng.randrange(4))
        rng.shuffle(lines)
        rows.append((rng.choice([i, None, 5]), rng.choice(["hot", "hot", "b", None]), "\n".join(lines)))
    again = " ".join(f"w{k}" for k in range(12))
    only = "accept all cookies\n" * 7 + "own word here"
    rows += [(900, "b", None), (901, "b", ""), (902, "b", " \n\t\n"), (903, "hot", f"{again} {again} {again}"), (904, "hot", only),
             (905, "hot", "x " * 5000), (906, "c", "accept all cookies " * 9)]
    return rows + rows[:10] + [rows[-3]] * 30


def rule_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], RULES)


@pytest.mark.parametrize(("min_docs", "share"), [(10, 0.05), (2, 0.4), (0, 0.0)])
def test_rules_equal_plain_python(spark, min_docs, share):
    rows = rule_rows()
    got = line_frequency.quality_rules(rule_frame(spark, rows), min_docs=min_docs, share=share).collect()
    assert same(got, rules(rows, min_docs, share))


def test_rules_reject_depleted_documents_and_cut_lines(spark):
    rows = rule_rows()
    docs = rule_frame(spark, rows)
    verdict = {r.doc_id: r.kept for r in line_frequency.quality_rules(docs).collect()}
    assert verdict[904] is False  # all but three of its words stand in a boilerplate line
    left = line_frequency.remove_frequent_lines(docs)
    assert left.schema == docs.schema
    kept = sum(r[-1] for r in rules(rows, 10, 0.05))
    texts = [(r.source, r.text) for r in left.collect()]
    assert len(texts) == kept and 0 < kept < len(rows)
    assert not any("accept all cookies" in (t or "").lower() for s, t in texts if s == "hot")


def test_rules_of_no_rows(spark):
    docs = rule_frame(spark, rule_rows()).limit(0)
    assert line_frequency.quality_rules(docs).count() == 0
    assert line_frequency.remove_frequent_lines(docs).count() == 0


def test_rules_are_native(spark):
    plan = line_frequency.quality_rules(rule_frame(spark, rule_rows(30)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
