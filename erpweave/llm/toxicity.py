"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context-window scores.

The lexicon is learned from labelled rows: words, and stems with several endings, that stand
in many different contexts of label-1 texts and hardly in label-0 texts (contexts, not
documents, are counted, so that copies of one text count once). It is kept as a trie. The
Levenshtein automata of all entries run over that trie as one automaton whose states are sets
of (trie node, edits); it is made deterministic as words come in, so a word costs one table
look-up per character and most words leave it after a few. It finds exact terms, words that
start with a stem, and misspelled terms (one edit from 5 letters, two from 9).

Every hit weighs as much as its entry and kind of match proved on the second half of the
sample, times a factor of its context window: the five words on both sides (log odds of
context words around hits in label-1 and label-0 texts) and quotation marks around the hit.
A logistic layer turns the weights of a text into one probability.

Fitting uses a bounded sample (``PER_CLASS`` rows of each label, texts of at most
``MAX_BYTES``); scoring reads whole texts. Defined cases: a null or empty text has no hit;
with labels of one class or none, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.labelled import class_counts, fit_sample, held_out
from erpweave.llm.text import ALNUM, LOWER, slices, utf8, word_hashes, words

PER_CLASS = 2000
MAX_BYTES = 16 << 10
THRESHOLD = 0.5
WINDOW = 5
STEM, SHORTEST, ENDINGS = 4, 4, 4  # letters of a stem and of a term at least; endings of a stem at least
COMMONEST = 0.75  # share of its contexts that one ending of a stem may hold; beyond, the word is a term
EXACT, PREFIX, FUZZY = 0, 1, 2
MOST_STATES = 200_000  # of the determinised automaton that a worker keeps
QUOTES = frozenset(b"\"'`") | {0xAB, 0xBB}  # ASCII quotes and the last bytes of guillemets
UNSEEN = 0.3  # weight of a kind of match that the sample does not show, as a share of the entry's


def edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """Terms and stems in a trie, with the automaton over it."""

    def __init__(self, terms: list[str], stems: list[str]):
        self.entries = [*terms, *stems]
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.stem: list[int] = [-1]
        for i, entry in enumerate(self.entries):
            node = 0
            for c in entry:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.stem.append(-1)
                node = self.children[node][c]
            (self.term if i < len(terms) else self.stem)[node] = i
        self.most = max((edits(len(t)) for t in terms), default=0)
        self._forget()

    def _forget(self) -> None:
        """Start the determinised automaton anew; it only caches, so matches stay the same."""
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        best: dict[int, int] = {}
        stack = list(items)
        while stack:
            node, e = stack.pop()
            if best.get(node, 99) <= e:
                continue
            best[node] = e
            if e < self.most:  # a letter of the entry is missing in the word
                stack += [(child, e + 1) for child in self.children[node].values()]
        key = frozenset(best.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.states[state]:
            for letter, child in self.children[node].items():
                if letter == c:
                    out.add((child, e))
                elif e < self.most:
                    out.add((child, e + 1))
            if e < self.most:
                out.add((node, e + 1))
        to = self._state(out) if out else -1
        self.next[state][c] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(entry, kind) of the best match of a word: exact term, stem, or misspelled term."""
        if len(self.states) > MOST_STATES:
            self._forget()
        state, stem = self.start, -1
        for c in word:
            to = self.next[state].get(c)
            state = self._step(state, c) if to is None else to
            if state < 0:
                return None if stem < 0 else (stem, PREFIX)
            if stem < 0:
                stem = next((self.stem[node] for node, e in self.states[state] if e == 0 and self.stem[node] >= 0), -1)
        found = sorted((e, self.term[node]) for node, e in self.states[state] if self.term[node] >= 0)
        if found and found[0][0] == 0:
            return found[0][1], EXACT
        if stem >= 0:
            return stem, PREFIX
        found = [(e, t) for e, t in found if e <= edits(len(self.entries[t])) and len(word) >= SHORTEST]
        return (found[0][1], FUZZY) if found else None


@dataclass
class Hit:
    doc: int
    entry: int
    kind: int
    context: list[int]
    quoted: bool


@dataclass
class Model:
    lexicon: Lexicon
    weight: dict[tuple[int, int], float] = field(default_factory=dict)
    context: dict[int, float] = field(default_factory=dict)
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(4))
    known: dict[int, int] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, known={})

    def _codes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Per word entry * 3 + kind, or -1."""
        unique, at, place = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > 500_000:
            self.known.clear()
        codes = np.empty(len(unique), np.int64)
        for i, (key, first) in enumerate(zip(unique.tolist(), at.tolist(), strict=True)):
            code = self.known.get(key)
            if code is None:
                word = _clean(data[starts[first] : ends[first]].tobytes().decode("utf-8", "replace"))
                found = self.lexicon.match(word)
                code = self.known[key] = -1 if found is None else found[0] * 3 + found[1]
            codes[i] = code
        return codes[place] if len(unique) else np.zeros(0, np.int64)

    def hits(self, data: np.ndarray, borders: np.ndarray) -> list[Hit]:
        """All hits in the texts, with the hashes of the words around them."""
        low = LOWER[data]
        starts, ends, first = words(low, borders, ALNUM)
        h = word_hashes(low, starts, ends)
        codes = self._codes(low, starts, ends, h)
        at = np.flatnonzero(codes >= 0)
        doc = np.searchsorted(first, at, side="right") - 1
        out = []
        for i, d in zip(at.tolist(), doc.tolist(), strict=True):
            a, b = max(int(first[d]), i - WINDOW), min(int(first[d + 1]), i + WINDOW + 1)
            near = h[a:i].tolist() + h[i + 1 : b].tolist()
            before = low[max(int(borders[d]), starts[i] - 2) : starts[i]].tolist()
            after = low[ends[i] : min(int(borders[d + 1]), ends[i] + 2)].tolist()
            quoted = bool(QUOTES.intersection(before)) and bool(QUOTES.intersection(after))
            out.append(Hit(d, int(codes[i]) // 3, int(codes[i]) % 3, near, quoted))
        return out

    def of_context(self, hit: Hit) -> float:
        """How far the window of a hit speaks for abuse and not for quotation, from 0 to 1."""
        score = 2.0 + sum(self.context.get(w, 0.0) for w in hit.context) - 2.0 * hit.quoted
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))

    def features(self, n: int, hits: list[Hit]) -> np.ndarray:
        """Per text: 1, and the logarithms of the weights of exact or stem hits, of misspelled ones, and of all entries hit."""
        sure, fuzzy = np.zeros(n), np.zeros(n)
        entries: list[set[int]] = [set() for _ in range(n)]
        for hit in hits:
            w = self.weight.get((hit.entry, hit.kind), 0.0) * self.of_context(hit)
            if w <= 0:
                continue
            (fuzzy if hit.kind == FUZZY else sure)[hit.doc] += w
            entries[hit.doc].add(hit.entry)
        return np.stack([np.ones(n), np.log1p(sure), np.log1p(fuzzy), np.log1p([len(x) for x in entries])], axis=1)


def _clean(word: str) -> str:
    """Lower case, without other characters than letters and digits at both ends."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def _contexts(rows: list[tuple[str, int]]) -> list[dict[str, set[int]]]:
    """Per label: the different neighbourhoods (words on both sides) that each word stands in."""
    out: list[dict[str, set[int]]] = [defaultdict(set), defaultdict(set)]
    for text, label in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        low = LOWER[raw]
        starts, ends, _ = words(low, np.array([0, len(low)]), ALNUM)
        own = [_clean(low[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(starts, ends, strict=True)]
        padded = ["", *own, ""]
        for i, word in enumerate(own):
            if len(word) >= SHORTEST:
                out[label][word].add(zlib.crc32(f"{padded[i]} {padded[i + 2]}".encode()))
    return out


def learn_lexicon(rows: list[tuple[str, int]], least: int = 8, pure: float = 0.95) -> tuple[list[str], list[str]]:
    """Terms and stems that stand in at least ``least`` contexts of label 1, and in nearly none of label 0."""
    none, some = _contexts(rows)

    def telling(yes: int, no: int) -> bool:
        return yes >= least and yes >= pure * (yes + no)

    prefixes: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])  # contexts of 0 and of 1, endings, contexts of the commonest
    for label, found in ((0, none), (1, some)):
        for word, contexts in found.items():
            for k in range(STEM, min(len(word), 9)):
                cell = prefixes[word[:k]]
                cell[label] += len(contexts)
                cell[2] += label
                cell[3] = max(cell[3], label * len(contexts))
    stems: list[str] = []
    for prefix in sorted(prefixes, key=lambda p: (len(p), p)):
        no, yes, endings, most = prefixes[prefix]
        if endings >= ENDINGS and most <= COMMONEST * yes and telling(yes, no) and not any(prefix.startswith(s) or s.startswith(prefix) for s in stems):
            while longer := [p for p in prefixes if len(p) == len(prefix) + 1 and p.startswith(prefix) and prefixes[p][1] == yes]:
                prefix = longer[0]  # all its label-1 words go on with one letter
            stems.append(prefix)
    terms = [
        word
        for word in sorted(some)
        if telling(len(some[word]), len(none.get(word, ()))) and not any(word.startswith(s) and word != s for s in stems)
    ]
    return terms, stems


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.001) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - y)) / len(y) + keep * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x / len(y) + np.diag(keep)
        beta -= np.linalg.solve(hess, grad)
    return beta


def _joined(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pa.array([t for t, _ in rows], pa.large_string()))


def fit(rows: list[tuple[str, int]], counts: tuple[int, int], seed: int = 0) -> Model | float:
    """The model fitted to (text, label) rows, or a constant probability without two classes."""
    if not min(counts) or len({y for _, y in rows}) < 2:
        return counts[1] / sum(counts) if sum(counts) else 0.5
    rows = [rows[i] for i in np.random.default_rng(seed).permutation(len(rows))]
    half = len(rows) // 2
    model = Model(Lexicon(*learn_lexicon(rows[:half])))
    rest = rows[half:]
    label = np.array([y for _, y in rest])
    total = [max(1, int((label == 0).sum())), max(1, int((label == 1).sum()))]
    hits = model.hits(*_joined(rest))
    seen: dict[tuple[int, int], list[set[int]]] = defaultdict(lambda: [set(), set()])
    around: list[dict[int, int]] = [defaultdict(int), defaultdict(int)]
    for hit in hits:
        y = int(label[hit.doc])
        seen[(hit.entry, hit.kind)][y].add(hit.doc)
        for w in hit.context:
            around[y][w] += 1
    for entry in range(len(model.lexicon.entries)):
        odds = {}
        for kind in (EXACT, PREFIX, FUZZY):
            if (entry, kind) in seen:
                no, yes = (len(x) for x in seen[(entry, kind)])
                odds[kind] = math.log((yes + 0.5) / total[1]) - math.log((no + 0.5) / total[0])
        best = max((odds.get(EXACT, 0.0), odds.get(PREFIX, 0.0)))
        if best < 1:  # the first half's finding does not hold on the second
            continue
        for kind in (EXACT, PREFIX, FUZZY):
            model.weight[(entry, kind)] = max(0.0, odds.get(kind, UNSEEN * best))
    if sum(around[0].values()) >= 200:
        all_no, all_yes = sum(around[0].values()), sum(around[1].values())
        for w in set(around[0]) | set(around[1]):
            no, yes = around[0].get(w, 0), around[1].get(w, 0)
            if no + yes >= 10:
                model.context[w] = max(-2.0, min(2.0, math.log((yes + 1) / (all_yes + 2)) - math.log((no + 1) / (all_no + 2))))
    share = np.array([counts[0] / sum(counts), counts[1] / sum(counts)])
    mean = np.array([(label == 0).mean(), (label == 1).mean()])
    weight = (share / np.maximum(mean, 1e-9))[label]
    model.coefficients = _logistic(model.features(len(rest), hits), label.astype(float), weight)
    return model


def probabilities(model: Model | float, column: pa.Array) -> np.ndarray:
    """Probability of label 1 per whole text."""
    if isinstance(model, float):
        return np.full(len(column), model)
    data, borders = utf8(column)
    out = []
    for i, j in slices(borders):
        hits = model.hits(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i])
        out.append(1 / (1 + np.exp(-np.clip((model.features(j - i, hits) * model.coefficients).sum(axis=1), -700, 700))))
    return np.concatenate(out) if out else np.zeros(0)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model | float:
    """Fit on the labelled rows of ``docs`` outside the held-out fifth."""
    return fit(fit_sample(docs, labels, "toxic", per_class, max_bytes), class_counts(labels, "toxic"))


def score_column(model: Model | float, text: Column) -> Column:
    """The model's probability for a text column."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(probabilities(model, column), pa.float64())

    return score(text)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) per document."""
    model = learn(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
