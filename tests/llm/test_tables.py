"""Mixing, token output, top-k and HTML extraction against brute force, and their edge cases."""

from __future__ import annotations

import random
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import NON_SPACE
from pyspark.sql import functions as F

from erpweave.llm import html_text, mixing, token_output, topk
from erpweave.llm.components import components
from erpweave.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- mixing


def water_filling(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Targets by clamping and sharing out the excess again until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = share * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        level = left / sum(w[s] for s in open_) if open_ else 0
        over = [s for s in open_ if w[s] * level > cap * sizes[s]]
        if not over:
            return {s: cap * sizes[s] if s in full else w[s] * level for s in names}
        full |= set(over)
        left -= sum(cap * sizes[s] for s in over)


def mix_rows(n=400, seed=1):
    rng = random.Random(seed)
    sources = ["hot"] * 12 + ["a", "B", "é", "", "zz", None, "tiny"]
    rows = [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(80))), rng.choice(sources)) for i in range(n)]
    return [*rows, (n, None, "a"), (n + 1, "", "empty"), (n + 2, "one", "tiny2"), (n + 2, "one", "tiny2"), (None, "no id", "a")]


MIX = "doc_id long, text string, source string, size string, key int, copies int, row int"


def mix_frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2, 3) for i, t, s in rows], MIX)


def test_mix_targets_and_samples(spark):
    rows = mix_rows()
    got = mixing.mix_plan(mix_frame(spark, rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(NON_SPACE.findall(text or ""))
    targets = water_filling(sizes)
    assert len(got) == len(rows)
    source_of = {i: s for i, _, s in rows}
    taken, longest = Counter(), Counter()
    for r in got:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and abs(r.target - targets[source]) < 1e-6 * (1 + r.target)
        assert r.taken == r.size * r.copies and r.taken <= 2 * r.size
        taken[source] += r.taken
        longest[source] = max(longest[source], r.size)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= longest[source], source
    again = mixing.mix_plan(mix_frame(spark, rows).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_documents_repeats_whole_rows(spark):
    rows = mix_rows(120)
    docs = mix_frame(spark, rows)
    mixed = mixing.mix_documents(docs)
    assert mixed.schema == docs.schema
    copies = Counter(r.doc_id for r in mixed.collect())
    plan = Counter()
    for r in mixing.mix_plan(docs).collect():
        plan[r.doc_id] += r.copies
    assert copies == Counter({k: v for k, v in plan.items() if v})
    assert mixing.mix_documents(docs.limit(0)).count() == 0 and mixing.mix_plan(docs.limit(0)).count() == 0


def test_mix_with_other_seed_takes_other_documents(spark):
    docs = mix_frame(spark, mix_rows())
    one, two = (sorted((str(r.doc_id), r.copies) for r in mixing.mix_plan(docs, seed=s).collect()) for s in (0, 1))
    assert one != two


# ---------------------------------------------------------------- token output


def test_encoder_equals_whole_texts():
    coder = token_output.WordEncoder(tokenizer_path(), limit=2000)
    rng = random.Random(2)
    parts = ["a", "B", "don't", "'s", "'", "7", "77", "é", "é", "́", " ", "\n", ".", "...", "“", "<|endoftext|>", "<|ENDOFTEXT|>", "<|",
             "|>", "|", "ß", "ΑΣ", " ", "　", "中文", "²", "_", "$", "😀", "LL", "\x1c", "\x00", "<", "̸", "ﬁ", "İ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)]
    data, borders = token_output.utf8(pa.array(texts))
    for i, j in token_output.slices(borders, 300):
        ids, size = coder.encode(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i], 1)
        at = 0
        for k in range(i, j):
            want = [*coder.tokenizer.encode(texts[k], add_special_tokens=False).ids, 1]
            assert ids[at : at + size[k - i]].tolist() == want, repr(texts[k])
            at += size[k - i]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 3000])
def test_index_is_minimal_perfect_and_refuses_other_keys(n):
    keys = random.Random(n).sample(range(-(10**12), 10**12), 2 * n)
    h = token_output._key_hashes(keys)
    pilots, slot = token_output.build_index(h[:n])
    assert sorted(slot.tolist()) == list(range(n)) and len(pilots) <= n
    prints = np.zeros(n, np.uint32)
    prints[slot] = (h[:n] >> np.uint64(32)).astype(np.uint32)
    assert token_output.lookup(pilots, prints, h[:n]).tolist() == slot.tolist()
    assert (token_output.lookup(pilots, prints, h[n:]) >= 0).sum() == 0


def test_token_output_reads_back_what_was_written(spark):
    texts = [(i, t) for i, t in enumerate(["One two.", "", None, "Ünï code 😀", "x " * 3000, "12 3"])] + [(None, "no id"), (4, "again"), (4, "again")]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in texts], "doc_id long, text string, start int, payload string").repartition(4)
    path = tempfile.mkdtemp(prefix="tokens-") + "/out"
    token_output.write_shards(docs, path, tokenizer_path(), shard_tokens=500)
    got = [tuple(r) for r in token_output.read_documents(spark, path).collect()]
    coder = token_output.WordEncoder(tokenizer_path()).tokenizer
    want, start = [], 0
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    wanted = spark.createDataFrame([(0,), (4,), (77,)], "doc_id long")
    found = {r.doc_id: r.ids for r in token_output.token_ids(spark, path, wanted).collect()}
    assert set(found) == {0, 4} and found[0] == [*coder.encode("One two.", add_special_tokens=False).ids, 1]
    assert token_output.token_output(docs.limit(0), tokenizer_path()).count() == 0


def test_rows_of_one_id_straddle_shards(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, f"{k} of id seven") for k in range(400)] + [(None, f"none {k}") for k in range(300)] + [(7, "same")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = tempfile.mkdtemp(prefix="tokens-") + "/out"
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        token_output.write_shards(docs, path, tokenizer_path())
    finally:
        spark.conf.set(name, before)
    shards = spark.read.schema(token_output.SHARD_SCHEMA).parquet(path)
    holding = shards.filter("array_contains(keys, 7)")
    assert holding.count() > 1
    assert max(r.c for r in holding.selectExpr("size(keys) AS c").collect()) < 400
    got = sorted(map(tuple, token_output.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    coder = token_output.WordEncoder(tokenizer_path()).tokenizer
    crc = lambda t: zlib.crc32(np.array([*coder.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes())
    assert sorted(r[3] for r in got) == sorted(crc(t) for _, t in rows)
    found = token_output.token_ids(spark, path, spark.createDataFrame([(7,), (39,), (99,), (None,)], "doc_id long"))
    least = docs.filter("doc_id = 7").orderBy(F.xxhash64("text")).first().text
    assert sorted((r.doc_id, r.ids) for r in found.collect()) == [(i, [*coder.encode(t, add_special_tokens=False).ids, 1]) for i, t in ((7, least), (39, "text 39"))]


def test_other_tokenizers_are_given_whole_texts(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    assert token_output.pieces_stand_alone(tokenizer_path()) and not token_output.pieces_stand_alone(path)
    coder = token_output.WordEncoder(path)
    texts = ["Two  spaces,\n\n a line", "", " lead", "Don't 1234 é", "x" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, token_output.token_output(docs, path, end_id=50256).select("doc_id", "n_tokens", "ids_crc32").collect()))
    ids = [np.array([*coder.tokenizer.encode(t, add_special_tokens=False).ids, 50256], "<u4") for t in texts]
    assert got == [(i, len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)]


# ---------------------------------------------------------------- top-k


def brute_top(rows, k=5):
    whole = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, (q, own) in enumerate(whole):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for m, (i, v) in enumerate(whole) if m != n)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(size=7).astype(np.float32)]) for i in range(420)]
    rows += [(500 + i, rows[3][1]) for i in range(30)] + [(600, [0.0] * 7), (650, [1.0] * 3), (700, [1e12] * 7)]
    rows += [(701, None), (702, [1.0, None] + [0.0] * 5), (703, [float("nan")] * 7), (704, [float("inf")] * 7), (None, [1.0] * 7), (50, rows[50][1]), (5, [9.0] * 7)]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, score int")
    for block, queries in ((8192, 1024), (64, 4)):
        got = topk.top_k(table, F.col("vec_id") % 50 == 0, block=block, queries=queries)
        assert sorted(map(tuple, got.collect())) == brute_top(rows)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]


def test_topk_stops_early_on_peaked_lists():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-5, 5, (4000, 4))
    vectors[:10] += 1000
    lists = topk.SortedLists(np.arange(4000), vectors)
    assert [i for _, i in lists.best(-1, np.array([1, 1, 1, 1]), 5)] == sorted(range(10), key=lambda i: (-vectors[i].sum(), i))[:5]


# ---------------------------------------------------------------- HTML

PAGES = [
    ("<html><body><nav>menu</nav><article><h1>T</h1><p>One &amp; two.<p>Three<br>four <b>bo</b>ld.</article><footer>f</footer></body></html>", "T One & two. Three four bold."),
    ("<div class='content'><p>Long text of the page stands here.</p><div class='comments'><p>First comment</p></div></div>", "Long text of the page stands here."),
    ("<div id=main-12><p>Body &lt;tag&gt; text that counts &#233;&eacute;</p><form>name <input></form><aside>side</aside><script>var t='</p>'</script></div>", "Body <tag> text that counts éé"),
    ("<article>cut <p>off in the mid", "cut off in the mid"),
    ("<article>cut <!-- open comment <p>x</p>", "cut"),
    ("<article>a <p title='1 > 0'>b</p></article> <script>never closed <p>x", "a b"),
    ("<body><div class=ad>buy</div><div>plain   text\n here</div></body>", "plain text here"),
    ("<ul><li>one<li>two</ul>", ""),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_page_text(page, text):
    if page is not None and "<li>" not in page:
        assert html_text.page_text(html_text.read_page(page), None) == text


def test_host_paths_win_over_single_pages(spark):
    good = "<html><body><div class='c{n}'><div class='post'><p>{text}</p></div><div class='x'><p>{other}</p></div></div></body></html>"
    rows = [(i, "https://h.example/p", good.format(n=i, text="main words " * 20, other="short")) for i in range(9)]
    rows.append((9, "HTTPS://H.example:80/q?x", good.format(n=9, text="little text", other="a much longer other block " * 9)))
    rows += [(10, None, None), (11, "nonsense", ""), (9, "https://h.example/", "<p>x")]
    pages = spark.createDataFrame([(i, u, h, "t", 0, "p") for i, u, h in rows], "page_id long, url string, html string, text string, n_chars int, path string")
    got = {(r.page_id, r.url): r for r in html_text.extract_pages(pages).collect()}
    assert got[9, "HTTPS://H.example:80/q?x"].text == "little text"
    assert got[3, "https://h.example/p"].text == ("main words " * 20).strip()
    assert got[10, None].text == "" and all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_pages_equal_the_article_of_every_page(spark):
    import html
    import re

    for r in html_text.extract_pages(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        plain = re.sub(r"<[^>]*>?", " ", re.sub(r"</?(b|i|em)>", "", inner))
        assert r.text == " ".join(html.unescape(plain).split())


# ---------------------------------------------------------------- components


def test_components_equal_union_find(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (3, 2), (2, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    table = spark.createDataFrame(edges, "a long, b long")
    want = {n: find(n) for n in list(root) if find(n) != n}
    assert {r.node: r.root for r in components(table).collect()} == want
    first = components(table.limit(90))
    assert {r.node: r.root for r in components(table, first).collect()} == want
    assert components(table.limit(0)).count() == 0
