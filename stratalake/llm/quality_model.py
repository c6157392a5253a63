"""Quality classifier: random-indexing word vectors, pooled per document, into a two-layer network
(operator 3).

Random indexing gives every word a sparse index vector, a few +1 and -1 at places drawn from the word's
hash. A word's context vector is the sum of the index vectors of its neighbours, and of their shapes, over
the training texts; the shape of a word is the order in which small letters, capitals, digits and single
marks follow each other in it. A document is the mean of its words' context vectors (a word that
training did not see has that of its shape), the mean index vector of its shapes, the length of its mean
index vector (large if few words make up the text) and its number of words.

The network (numpy, on the driver, from a bounded sample of labelled documents) has one hidden layer of
tanh units. A fifth of the sample is kept back to choose the temperature that makes its probabilities fit.

Edge cases: NULL, empty or wordless texts are all-zero documents and get the score of those. Texts of
any length are read whole. Rows are scored one by one, equal rows alike; an empty table gives an empty
result. Without labelled documents of both kinds fitting fails with a ValueError. Other columns stay;
those with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from stratalake.llm import batches, labelled
from stratalake.llm.frames import Table, schema_with

SIZE = 64  # of index and context vectors
ENTRIES = 4  # of an index vector that are not 0
NEAR = 2  # words on either side that are neighbours

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[ord("a"):ord("z") + 1] = ord("a")
_SHAPES[ord("A"):ord("Z") + 1] = ord("A")
_SHAPES[ord("0"):ord("9") + 1] = ord("0")
_SHAPES[0x80:] = ord("a")


def word_hashes(texts: pa.Array) -> tuple[batches.Words, np.ndarray]:
    """The words of texts, and the hash of each word's shape."""
    data, offsets = batches.buffers(texts)
    words = batches.words(data, offsets)
    shapes = _SHAPES[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = shapes[1:] != shapes[:-1]
    keep[words.start] = True  # a word never begins with what is dropped
    places = np.concatenate(([0], np.cumsum(keep)))
    return words, batches.words(shapes[keep], places[offsets], lower=False).hash


def index_entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors of some hashes."""
    mixed = batches.mix(hashes, 31)
    shifts = (np.arange(ENTRIES, dtype=np.uint64) * np.uint64(8))[None, :]
    parts = mixed[:, None] >> shifts
    return (parts % np.uint64(SIZE)).astype(np.int64), np.where((parts >> np.uint64(6)) & np.uint64(1), 1.0, -1.0)


def summed(groups: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """The sum of index vectors by group."""
    places, signs = index_entries(hashes)
    flat = (groups[:, None] * SIZE + places).ravel()
    return np.bincount(flat, weights=signs.ravel(), minlength=count * SIZE).reshape(count, SIZE)


def in_slices(texts: list[str]) -> Iterator[pa.Array]:
    """The texts in runs of bounded size, so that working memory does not grow with their number."""
    for part in batches.slices(pa.record_batch([pa.array(texts, pa.string())], names=["text"])):
        yield part.column("text")


class Vectors:
    """Context vectors by hash."""

    def __init__(self, known: np.ndarray, vectors: np.ndarray):
        self.known, self.vectors = known, vectors  # sorted hashes; one vector more, of zeros

    @classmethod
    def learn(cls, texts: list[str], words_kept: int) -> Vectors:
        """Vectors of the most frequent words and of all shapes, from slices of the texts."""
        slices = [word_hashes(part) for part in in_slices(texts)]
        seen, times = np.unique(np.concatenate([words.hash for words, _ in slices]), return_counts=True)
        kept = seen[np.argsort(-times, kind="stable")[:words_kept]]
        # a shape's hash is told from a word's by a seed
        shapes = np.unique(np.concatenate([batches.mix(np.unique(shapes), 77) for _, shapes in slices]))[:words_kept]
        known = np.unique(np.concatenate((kept, shapes)))
        total, counts = np.zeros((len(known), SIZE)), np.zeros(len(known))
        for words, shapes in slices:
            marked, doc = batches.mix(shapes, 77), np.repeat(np.arange(len(words.counts)), words.counts)
            for owners in (words.hash, marked):
                at = np.searchsorted(known, owners)
                found = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == owners)
                for step in [*range(-NEAR, 0), *range(1, NEAR + 1)]:
                    i = found[(found + step >= 0) & (found + step < len(doc))]
                    i = i[doc[i] == doc[i + step]]
                    for neighbours in (words.hash, marked):
                        places, signs = index_entries(neighbours[i + step])
                        np.add.at(total, (at[i][:, None], places), signs)
                    counts += np.bincount(at[i], minlength=len(known))
        vectors = total / np.maximum(1, counts)[:, None]
        return cls(known, np.vstack((vectors, np.zeros((1, SIZE)))).astype(np.float32))

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, hashes)
        at[(at >= len(self.known)) | (self.known[np.minimum(at, len(self.known) - 1)] != hashes)] = len(self.known)
        return at


def document_vectors(texts: pa.Array, vectors: Vectors) -> np.ndarray:
    """One row of features per text."""
    words, shapes = word_hashes(texts)
    n, count = words.counts, len(texts)
    doc = np.repeat(np.arange(count), n)
    marked = batches.mix(shapes, 77)
    rows, fallback = vectors.rows(words.hash), vectors.rows(marked)
    rows = np.where(rows == len(vectors.known), fallback, rows)
    context = np.zeros((count, SIZE))
    full = np.flatnonzero(n > 0)
    if len(full):
        context[full] = np.add.reduceat(vectors.vectors[rows], words.first[:-1][full], axis=0, dtype=np.float64)
    scale = 1 / np.maximum(1, n)[:, None]
    index = summed(doc, words.hash, count) * scale
    return np.hstack((context * scale, summed(doc, marked, count) * scale,
                      np.sqrt((index ** 2).sum(axis=1, keepdims=True)), np.log1p(n)[:, None]))


class Network:
    """Two layers and a temperature over standardised features."""

    def __init__(self, weights: list[np.ndarray], mean: np.ndarray, spread: np.ndarray, temperature: float = 1.0):
        self.weights, self.mean, self.spread, self.temperature = weights, mean, spread, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(((x - self.mean) / self.spread) @ a + b) @ c + d[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, penalty: float = 1e-4, seed: int = 3) -> Network:
        """Adam on the balanced cross entropy in small batches."""
        random = np.random.default_rng(seed)
        net = cls([random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
                   random.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)], x.mean(axis=0), x.std(axis=0) + 1e-3)
        x = (x - net.mean) / net.spread
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        first, second = ([np.zeros_like(w) for w in net.weights] for _ in range(2))
        step = 0
        for _ in range(epochs):
            for rows in np.array_split(random.permutation(len(x)), max(1, len(x) // 128)):
                a, b, c, d = net.weights
                h = np.tanh(x[rows] @ a + b)
                error = weight[rows] * (1 / (1 + np.exp(-np.clip(h @ c + d[0], -30, 30))) - y[rows]) / len(rows)
                inner = (error[:, None] * c) * (1 - h ** 2)
                step += 1
                for i, g in enumerate((x[rows].T @ inner + penalty * a, inner.sum(axis=0), h.T @ error + penalty * c, error.sum(keepdims=True))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g ** 2
                    net.weights[i] = net.weights[i] - 0.003 * (first[i] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
        return net

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least cross entropy on rows that were not fitted."""
        def loss(temperature: float) -> float:
            z = np.clip(self.logits(x) / temperature, -30, 30)
            return float(np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)))

        self.temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)


def fit(texts: list[str], label: np.ndarray, words_kept: int = 20_000) -> tuple[Vectors, Network]:
    """Vectors and network from labelled texts in any order that does not depend on the labels."""
    if not 0 < label.sum() < len(label):
        raise ValueError("labelled documents of both kinds are needed")
    vectors = Vectors.learn(texts, words_kept)
    x, y = np.vstack([document_vectors(part, vectors) for part in in_slices(texts)]), label.astype(float)
    back = np.arange(len(y)) % 5 == 4
    if not 0 < y[~back].sum() < (~back).sum() or not back.any():
        back[:] = False
    network = Network.fit(x[~back], y[~back])
    network.calibrate(x[back], y[back]) if back.any() else None
    return vectors, network


def train(docs: DataFrame, labels: DataFrame, label_column: str = "quality", rows: int = 2500, max_bytes: int = 20_000) -> tuple[Vectors, Network]:
    """A model from at most ``rows`` labelled documents of each kind that are not held out."""
    drawn = sorted(labelled.sample(docs, labels, label_column, rows, max_bytes).collect())
    return fit([r["text"] for r in drawn], np.array([r["label"] for r in drawn]))


def _score_all(parts: Iterator[pa.RecordBatch], text: str, vectors: Vectors, network: Network) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for part in batches.slices(batch, text):
            scores = network.scores(document_vectors(part.column(text), vectors))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores.astype(np.float64))], names=[*part.schema.names, "score"])


def score(docs: DataFrame, model: tuple[Vectors, Network], text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold``)."""
    table, (vectors, network) = Table(docs), model
    text = table.at(text_column)
    shared = docs.sparkSession.sparkContext.broadcast((
        (vectors.known, vectors.vectors), (network.weights, network.mean, network.spread, network.temperature)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, layers = shared.value  # plain values, because executors need not have this package
        return _score_all(parts, text, Vectors(*held), Network(*layers))

    scored = table.df.mapInArrow(run, schema_with(table.df, score=T.DoubleType()))
    return table.restore(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), "score", "predicted")
