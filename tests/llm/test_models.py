"""Quality and toxicity classifiers: held-out accuracy, the pieces of each method, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from erpweave.llm import labelled, quality, toxicity

SF = "/root/testdata/sf0.1"
EDGE = "doc_id long, text string, score double, held_out string, _text string"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def rank_quality(rows):
    """Area under the ROC curve of [(score, label)]."""
    ranks = {}
    for place, (score, _) in enumerate(sorted(rows)):
        ranks.setdefault(score, []).append(place)
    mean = {s: sum(p) / len(p) for s, p in ranks.items()}
    some = [mean[s] for s, y in rows if y]
    return (sum(some) - len(some) * (len(some) - 1) / 2) / (len(some) * (len(rows) - len(some)))


@pytest.mark.parametrize(
    ("scores", "label", "cut", "area", "right"),
    [(quality.quality_scores, "quality", 0.3, 0.99, 0.98), (toxicity.toxicity_scores, "toxic", 0.5, 0.9, 0.95)],
)
def test_held_out_accuracy(spark, scores, label, cut, area, right):
    docs, labels = tables(spark)
    got = scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", label).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in rows)
    apart = [(r.score, r[label]) for r in rows if r.held_out]
    assert rank_quality(apart) > area
    assert sum((s >= cut) == y for s, y in apart) / len(apart) > right


@pytest.mark.parametrize("scores", [quality.quality_scores, toxicity.toxicity_scores])
def test_scores_of_unusual_rows(spark, scores):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    cells = [(1, None), (2, ""), (None, "x"), (3, "word " * 60000), (3, "word " * 60000), (4, "\x00é")]
    odd = spark.createDataFrame([(i, t, 2.0, "a", "b") for i, t in cells], EDGE)
    for frame in (odd, odd.limit(0)):
        known = frame.unionByName(docs.select("doc_id", "text"), allowMissingColumns=True)
        assert scores(known, labels).count() == known.count()
    got = scores(odd, labels.limit(0)).collect()
    assert len(got) == 6 and {r.score for r in got} == {0.5}
    assert [r.held_out for r in got if r.doc_id is None] == [True]


def test_reruns_agree(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        one, two = (sorted(map(tuple, scores(docs.repartition(n), labels).collect())) for n in (3, 7))
        assert one == two


def test_keep_good_keeps_columns(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    kept = quality.keep_good(docs.withColumn("score", docs["n_chars"]), labels)
    assert kept.columns == [*docs.columns, "score"]
    assert 0.8 < kept.count() / docs.count() < 1


def test_fit_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    rows = labelled.fit_sample(docs, labels, "quality", 20, 4000)
    assert 0 < len(rows) <= 40 and all(len(t.encode()) <= 4000 for t, _ in rows)
    fold = {r.text for r in docs.join(labels, "doc_id").filter(labelled.held_out(docs["doc_id"])).collect()}
    other = {r.text for r in docs.join(labels, "doc_id").filter(~labelled.held_out(docs["doc_id"])).collect()}
    assert all(t in other for t, _ in rows) and fold


# ---------------------------------------------------------------- the network


def network(seed=0):
    rng = np.random.default_rng(seed)
    width = quality.HALF * (quality.EMBED + 1)
    return quality.Network(
        rng.normal(size=(256, quality.EMBED)).astype(np.float32),
        rng.normal(size=(width, 2 * quality.FILTERS)).astype(np.float32),
        rng.normal(size=quality.FILTERS).astype(np.float32),
        rng.normal(size=quality.FILTERS),
        0.1,
    )


def plain_logit(net, text):
    """The network's output, chunk by chunk."""
    raw = text.encode()
    halves = max(2, -(-len(raw) // quality.HALF))
    repeat = [
        len(raw) > 4 and i >= quality.MAX_LAG and i + 4 <= len(raw) and any(raw[i : i + 4] == raw[i - k : i - k + 4] for k in range(1, quality.MAX_LAG + 1))
        for i in range(len(raw))
    ]
    raw, repeat = raw + bytes(halves * quality.HALF - len(raw)), repeat + [False] * (halves * quality.HALF - len(repeat))
    x = np.array([[*net.embed[b], r] for b, r in zip(raw, repeat, strict=True)], np.float64).reshape(halves, -1)
    left, right = net.filters[:, : quality.FILTERS], net.filters[:, quality.FILTERS :]
    most = np.max([x[i] @ left + x[i + 1] @ right for i in range(halves - 1)], axis=0) + net.bias
    return np.maximum(most, 0) @ net.weight + net.intercept


def test_network_covers_whole_texts():
    net = network()
    texts = ["", "a", "the the the the the the the the the", "x" * 200, "été " * 50, "abcdefgh" * 3 + "Z", "q" * 17]
    data = pa.array(texts)
    got = quality.probabilities(net, data)
    want = [1 / (1 + np.exp(-plain_logit(net, t))) for t in texts]
    assert np.allclose(got, want, atol=1e-4)


def test_network_scores_a_text_alike_in_any_company():
    net = network(2).on_grid()
    rng = np.random.default_rng(7)
    texts = ["".join(map(chr, rng.integers(32, 400, int(n)))) for n in rng.integers(0, 3000, 120)] + ["z" * 600_000]
    whole = quality.probabilities(net, pa.array(texts))
    for step in (1, 7, 50):
        parts = [quality.probabilities(net, pa.array(texts[i : i + step])) for i in range(0, len(texts), step)]
        assert np.array_equal(np.concatenate(parts), whole)


def test_network_scores_a_long_text_in_blocks_alike():
    net = network(3)
    rng = np.random.default_rng(1)
    text = "".join(chr(c) for c in rng.integers(32, 127, 1_200_000))
    whole = quality.probabilities(net, pa.array([text]))[0]
    assert abs(whole - 1 / (1 + np.exp(-plain_logit(net, text)))) < 1e-3


# ---------------------------------------------------------------- the automaton


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcde", min_size=1, max_size=12))
def test_automaton_equals_edit_distances(word):
    terms, stems = ["abcde", "abced", "ddeeb", "abcabcabc", "aab", "edcb"], ["bcad"]
    found = toxicity.Lexicon(terms, stems).match(word)
    near = [(distance(word, t), i) for i, t in enumerate(terms) if distance(word, t) <= toxicity.edits(len(t))]
    if any(d == 0 for d, _ in near):
        assert found == (min(near)[1], toxicity.EXACT)
    elif word.startswith("bcad"):
        assert found == (len(terms), toxicity.PREFIX)
    elif near and len(word) >= toxicity.SHORTEST:
        assert found is not None and found[1] == toxicity.FUZZY and (distance(word, terms[found[0]]), found[0]) == min(near)
    else:
        assert found is None


def corpus(n=300):
    """Labelled texts: insults in label 1, the same words in quotation marks after 'said' in some of label 0."""
    rng = np.random.default_rng(4)
    filler = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(n):
        own = list(rng.choice(filler, 40))
        if i % 2:
            for term in rng.choice(["blockhead", "nitwit", "dunce"], 3):
                own.insert(int(rng.integers(0, len(own))), str(term))
        elif i % 20 == 0:
            own[10:10] = ["she", "said", '"nitwit"', "he", "quoted"]
        rows.append((" ".join(own), i % 2))
    return rows


def test_lexicon_misspellings_and_context():
    model = toxicity.fit(corpus(), (900, 100))
    assert {"blockhead", "nitwit", "dunce"} <= set(model.lexicon.entries)
    score = lambda *texts: toxicity.probabilities(model, pa.array(texts))
    plain, toxic, wrong = score("word1 word2 word3", "you nitwit and dunce and blockhead", "you nitwlt and dnce and blokhead and nittwit")
    assert plain < 0.2 < 0.5 < toxic and plain < wrong
    abuse, quoted = score("you are a nitwit and a dunce", 'he said "nitwit" and also "dunce" again')
    assert quoted < abuse


def test_copies_count_once_in_the_lexicon():
    text = "rareword stands in one text only here " * 2
    rows = [(text, 1)] * 40 + corpus(200)
    assert "rareword" not in toxicity.learn_lexicon(rows)[0]
