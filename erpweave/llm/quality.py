"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned embedding and one fixed channel that is 1 where the four bytes at
that place also stood up to ``MAX_LAG`` bytes before. Learned filters run over overlapping
chunks of 16 bytes, one every 8 bytes, that cover the whole text; each filter's largest
response over all chunks is kept (max-pooling), and a logistic layer combines these into the
probability of label 1.

Fitting uses a bounded sample (``PER_CLASS`` rows of each label, texts of at most
``MAX_BYTES``), balanced; the intercept is then moved to the true class shares. Scoring reads
whole texts of any length, in slices.

The fitted weights lie on a grid (multiples of 1 / ``GRID``), so the float64 sums of the
convolution are exact in any order: a text's score does not depend on the texts beside it.

Defined cases: a null or empty text is scored as one chunk of zero bytes; with labels of one
class or none, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.labelled import class_counts, fit_sample, held_out
from erpweave.llm.text import slices, utf8

HALF = 8  # stride; a chunk is two halves
EMBED = 6
FILTERS = 16
MAX_LAG = 24
PER_CLASS = 800
MAX_BYTES = 16 << 10
EPOCHS = 40
THRESHOLD = 0.3
GRID = 4096.0


def padded(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and repeat channel with every text filled up with zeros to whole halves, two at least.

    Also the n + 1 borders in halves.
    """
    size = np.diff(borders)
    halves = np.maximum(2, -(-size // HALF))
    at = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(int(at[-1]) * HALF, np.uint8)
    repeat = np.zeros(len(out), bool)
    place = np.arange(len(data)) + np.repeat(at[:-1] * HALF - borders[:-1], size)
    out[place] = data
    if len(data) > 4:
        wide = data.astype(np.uint32)
        gram = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
        seen = np.zeros(len(data), bool)
        for lag in range(1, min(MAX_LAG, len(gram) - 1) + 1):
            seen[lag : len(gram)] |= gram[lag:] == gram[:-lag]
        # Not across the start of a text.
        within = np.arange(len(data)) - np.repeat(borders[:-1], size)
        left = np.repeat(borders[1:], size) - np.arange(len(data))
        seen &= (within >= MAX_LAG) & (left >= 4)
        repeat[place] = seen
    return out, repeat, at


@dataclass
class Network:
    """embed: 256 x EMBED, filters: halves of (HALF * (EMBED + 1)) x 2 FILTERS, and the last layer."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    intercept: float

    def on_grid(self) -> Network:
        """The same network with embeddings and filters rounded to the grid (and within +-64)."""
        embed, filters = (np.clip(np.round(w.astype(np.float64) * GRID) / GRID, -64, 64) for w in (self.embed, self.filters))
        return Network(embed, filters, self.bias.astype(np.float64), self.weight, self.intercept)

    def inputs(self, data: np.ndarray, repeat: np.ndarray) -> np.ndarray:
        x = np.empty((len(data), EMBED + 1), self.embed.dtype)
        x[:, :EMBED] = self.embed[data]
        x[:, EMBED] = repeat
        return x.reshape(-1, HALF * (EMBED + 1))

    def pooled(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Responses of all chunks, and the largest per text and filter."""
        both = x @ self.filters
        chunk = both[:-1, :FILTERS] + both[1:, FILTERS:]
        chunk[at[1:-1] - 1] = -np.inf  # the chunk that would reach into the next text
        return chunk, np.maximum.reduceat(chunk, at[:-1], axis=0) + self.bias

    def logits(self, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
        raw, repeat, at = padded(data, borders)
        most = np.full((len(borders) - 1, FILTERS), -np.inf, self.embed.dtype)
        # In blocks of whole texts; a long text in blocks of halves that overlap by one.
        step = 1 << 15
        first = 0
        while first < len(at) - 1:
            last = max(first + 1, int(np.searchsorted(at, at[first] + step, "right")) - 1)
            if at[last] - at[first] <= step:
                cut = slice(int(at[first]) * HALF, int(at[last]) * HALF)
                most[first:last] = self.pooled(self.inputs(raw[cut], repeat[cut]), at[first : last + 1] - at[first])[1]
            else:
                for lo in range(int(at[first]), int(at[last]) - 1, step):
                    hi = min(lo + step + 1, int(at[last]))
                    cut = slice(lo * HALF, hi * HALF)
                    part = self.pooled(self.inputs(raw[cut], repeat[cut]), np.array([0, hi - lo]))[1][0]
                    most[first] = np.maximum(most[first], part)
            first = last
        # Summed row by row: a matrix product would round by the rows beside it.
        return (np.maximum(most, 0).astype(np.float64) * self.weight).sum(axis=1) + self.intercept


def fit(rows: list[tuple[str, int]], counts: tuple[int, int], seed: int = 0, epochs: int = EPOCHS) -> Network | float:
    """The network fitted to (text, label) rows, or a constant probability without two classes."""
    if not min(counts) or len({y for _, y in rows}) < 2:
        return counts[1] / sum(counts) if sum(counts) else 0.5
    rng = np.random.default_rng(seed)
    width = HALF * (EMBED + 1)
    net = Network(
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        rng.normal(0, 1 / np.sqrt(2 * width), (width, 2 * FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.5, FILTERS),
        0.0,
    )
    texts = [np.frombuffer(t.encode(), np.uint8) for t, _ in rows]
    label = np.array([y for _, y in rows], np.float64)
    share = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    params = [net.embed, net.filters, net.bias, net.weight, np.zeros(1)]
    moments = [(np.zeros(p.shape), np.zeros(p.shape)) for p in params]
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), 64):
            pick = order[lo : lo + 64]
            borders = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
            data, repeat, at = padded(np.concatenate([texts[i] for i in pick]), borders)
            x = net.inputs(data, repeat)
            chunk, most = net.pooled(x, at)
            active = np.maximum(most, 0)
            p = 1 / (1 + np.exp(-(active @ params[3] + params[4][0])))
            error = (p - label[pick]) * share[pick] / len(pick)
            back = np.outer(error, params[3]) * (most > 0)
            # Only the chunk that gave the maximum passes the gradient on.
            grad_filters, grad_embed = np.zeros(net.filters.shape), np.zeros(net.embed.shape)
            for f in range(FILTERS):
                where = np.array([at[d] + int(np.argmax(chunk[at[d] : at[d + 1] - 1, f])) for d in range(len(pick))])
                for half in (0, 1):
                    col = f + half * FILTERS
                    grad_filters[:, col] += x[where + half].T @ back[:, f]
                    g = np.outer(back[:, f], net.filters[:, col]).reshape(-1, EMBED + 1)[:, :EMBED]
                    byte = data.reshape(-1, HALF)[where + half].ravel()
                    np.add.at(grad_embed, byte, g)
            grads = [grad_embed, grad_filters, back.sum(0), active.T @ error + 1e-4 * params[3], np.array([error.sum()])]
            step += 1
            for par, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                par -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(par.dtype)
    prior = np.log(counts[1] / counts[0])
    net.weight, net.intercept = params[3], float(params[4][0] + prior)
    return net.on_grid()


def probabilities(model: Network | float, column: pa.Array) -> np.ndarray:
    """Probability of label 1 per whole text."""
    if isinstance(model, float):
        return np.full(len(column), model)
    data, borders = utf8(column)
    out = [model.logits(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i]) for i, j in slices(borders, 1 << 20)]
    return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -700, 700))) if out else np.zeros(0)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Network | float:
    """Fit on the labelled rows of ``docs`` outside the held-out fifth."""
    return fit(fit_sample(docs, labels, "quality", per_class, max_bytes), class_counts(labels, "quality"))


def score_column(model: Network | float, text: Column) -> Column:
    """The model's probability for a text column."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(probabilities(model, column), pa.float64())

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.3) per document."""
    model = learn(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are predicted to be of label 1, with all their columns."""
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return row.filter(score_column(learn(docs, labels), F.col("row.text")) >= THRESHOLD).select("row.*")
