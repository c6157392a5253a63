"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks (operator 5).

The kernel compares two words by the four-letter subsequences they share, gaps allowed: one that spans s
letters weighs ``DECAY ** s``, and the kernel is normalised to 1 for equal words. So ``idiot`` stays close
to ``idxiot``; marks between letters, letters set apart by blanks and digits that stand for letters are
undone before.

Training (on the driver, with a bounded sample of documents): sentences of toxic documents are bags
of which some word is toxic, all words of clean sentences are not. Landmarks are the words that tell
toxic documents from clean ones best and, the words of clean sentences nearest to them. Words are mapped to the
landmarks' kernel values times the inverse root of the landmarks' kernel matrix, and a linear machine with
squared hinge loss is fitted; then the words that it finds most toxic in each toxic document are taken
anew, some rounds long, beside those that tell the documents apart. Copies of toxic words with letters put in are trained along.

Scoring: in this kernel the machine is one weight per four-letter subsequence. It is evaluated on every
word of the whole text; the largest value counts, turned into a probability by a logistic fit.

Edge cases: NULL, empty or wordless texts get the score of a text without any toxic word. Words longer
than ``WINDOW`` letters are read in overlapping windows. Rows are scored one by one, equal rows alike;
an empty table gives an empty result. Without labelled documents of both kinds fitting fails with a
ValueError. Other columns stay; those with the name of a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from stratalake.llm import batches, labelled
from stratalake.llm.frames import Table, schema_with

DECAY = 0.6
WINDOW = 16
ORDER = 4  # letters of a subsequence
REMEMBERED = 300_000  # pieces whose value a task remembers
TELLING = 1.9  # log odds from which a word may be taken for toxic at first: three documents against none
_LETTERS = 40  # 1-26 letters, 27-38 everything else by remainder
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a"}
_MARKS = ".,;:!?\"'()"
_RUN = re.compile(r"[^\W_]+")
_APART = re.compile(r"(?<!\S)(?:[^\W\d_][ .*_-]){2,}[^\W\d_](?!\w)")
_SENTENCE = re.compile(r"[.!?]+(?=\s)|\n")


def _letter_codes() -> np.ndarray:
    codes = 27 + np.arange(0x10000) % 12
    codes[ord("a"):ord("z") + 1] = np.arange(1, 27)
    for sign, letter in _STANDS_FOR.items():
        codes[ord(sign)] = ord(letter) - 96
    return codes.astype(np.int64)


def words_of(piece: str) -> list[str]:
    """The words in a piece between blanks: its runs of letters and digits, and all of them as one."""
    piece = piece.lower()
    inner = piece.strip(_MARKS)
    if len(inner) <= WINDOW and inner.isalnum():  # one run, as most pieces are
        return [inner]
    runs = _RUN.findall(piece)
    if len(runs) > 1:
        runs.append("".join(runs))
    return [run[i:i + WINDOW] for run in runs for i in range(0, max(1, len(run) - WINDOW // 2), WINDOW // 2)]


def pieces_of(text: str) -> set[str]:
    """Distinct pieces between blanks, and letters that stand apart put together."""
    pieces = set(text.split())
    pieces.update(re.sub(r"[ .*_-]", "", found) for found in _APART.findall(text))
    return pieces


class Subsequences:
    """Four-letter subsequences of words of one length, as table places and weights."""

    def __init__(self):
        self.codes = _letter_codes()
        self.places = {n: np.array(list(combinations(range(n), ORDER))) for n in range(ORDER, WINDOW + 1)}

    def by_length(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(indices of words, places in the table with a row for each subsequence, weights, norms) for each length that has any."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for n in np.unique(lengths[lengths >= ORDER]).tolist():
            at = np.flatnonzero(lengths == n)
            signs = np.frombuffer("".join(words[i] for i in at.tolist()).encode("utf-32-le"), dtype=np.uint32)
            letters = self.codes[np.minimum(signs, 0xFFFF)].reshape(-1, n)
            points = self.places[n].T
            weights = DECAY ** (points[-1] - points[0] + 1)
            step = max(1, 2_000_000 // len(weights))
            step = min(step, max(1, 2_000_000 // n ** 2))
            for row in range(0, len(at), step):
                part = letters[row:row + step]
                signs = np.ascontiguousarray(part.T).astype(np.int32)
                places = signs[points[0]]
                for point in points[1:]:
                    places = places * _LETTERS + signs[point]
                yield at[row:row + step], places, weights, self.norms(part)

    def norms(self, letters: np.ndarray) -> np.ndarray:
        """The kernel of each word of one length with itself, under the root.

        ``ahead[j, k]`` adds up all pairs of equal subsequences that end before letters j and k, with their weights up
        to there; a further letter is added to all of them at once.
        """
        count, n = letters.shape
        gap = np.arange(n)[None, :] - np.arange(n)[:, None]
        decay = np.where(gap > 0, DECAY ** np.maximum(gap, 0), 0.0)
        same = (letters[:, :, None] == letters[:, None, :]).astype(float)
        ahead = same
        for _ in range(ORDER - 1):  # symmetric in both words, which are the same
            half = (ahead.reshape(-1, n) @ decay).reshape(count, n, n)
            ahead = same * (half.swapaxes(1, 2).reshape(-1, n) @ decay).reshape(count, n, n)
        return DECAY * np.sqrt(ahead.sum(axis=(1, 2)))

    def against(self, words: list[str], table: "Weights") -> np.ndarray:
        """Products of the normalised words with each column of ``table``."""
        out = np.zeros((len(words), table.columns.shape[1]), dtype=np.float32)
        single = table.columns[:, 0][table.rows] if table.columns.shape[1] == 1 else None  # one look-up in place of two
        for at, places, weights, norm in self.by_length(words):
            if single is not None:
                out[at, 0] = (weights @ single[places]) / norm
                continue
            rows = table.rows[places]
            for c in range(table.columns.shape[1]):
                out[at, c] = (weights @ table.columns[rows, c]) / norm
        return out

    def vectors(self, words: list[str]) -> "Weights":
        """Each word as a normalised column of subsequence weights."""
        parts = list(self.by_length(words))
        used = np.unique(np.concatenate([places.ravel() for _, places, *_ in parts])) if parts else np.zeros(0, dtype=np.int64)
        rows = np.zeros(_LETTERS ** ORDER, dtype=np.int32)
        rows[used] = np.arange(1, len(used) + 1)
        columns = np.zeros((len(used) + 1, len(words)), dtype=np.float32)
        for at, places, weights, norm in parts:
            for i, word in enumerate(at.tolist()):
                np.add.at(columns[:, word], rows[places[:, i]], weights / norm[i])
        return Weights(rows, columns)


class Weights:
    """Columns of weights for the subsequences that have any; row 0 is for all others."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray):
        self.rows, self.columns = rows, columns


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-6, steps: int = 25) -> tuple[np.ndarray, float]:
    """Linear squared-hinge machine by Newton steps over the rows inside the margin."""
    x1 = np.hstack((x, np.ones((len(x), 1), dtype=x.dtype))).astype(np.float64)
    weight = weight / weight.sum()
    ridge = penalty * np.eye(x1.shape[1])
    w, before = np.zeros(x1.shape[1]), None
    for _ in range(steps):
        inside = y * (x1 @ w) < 1
        if before is not None and (inside == before).all():
            break
        before, rows = inside, x1[inside]
        w = np.linalg.solve((rows * weight[inside, None]).T @ rows + ridge, rows.T @ (weight[inside] * y[inside]))
    return w[:-1], float(w[-1])


def _logistic(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt's fit, with his smoothed targets."""
    positive, negative = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weight = np.where(label == 1, 0.5 / positive, 0.5 / negative)
    slope, offset = 1.0, 0.0
    for _ in range(2000):
        p = 1 / (1 + np.exp(-np.clip(slope * value + offset, -30, 30)))
        error = weight * (p - target)
        slope, offset = slope - 4 * float(error @ value), offset - 4 * float(error.sum())
    return slope, offset


def _with_letters_put_in(words: Iterable[str], seed: int = 5) -> list[str]:
    random, out = np.random.default_rng(seed), []
    for word in words:
        at = int(random.integers(1, len(word)))
        out.append((word[:at] + "abcdefghijklmnopqrstuvwxyz"[int(random.integers(26))] + word[at:])[:WINDOW])
    return out


class Model:
    """The fitted machine as a weight per subsequence."""

    def __init__(self, table: Weights, bias: float, slope: float, offset: float):
        self.table, self.bias, self.slope, self.offset = table, bias, slope, offset

    def values(self, texts: list[str], kernel: Subsequences, known: dict[str, float] | None = None) -> np.ndarray:
        """The largest value over the words of each text; ``known`` remembers values of pieces."""
        known = {} if known is None else known
        if len(known) > REMEMBERED:
            known.clear()
        pieces = [pieces_of(text) for text in texts]
        new = list(set().union(*pieces).difference(known))
        words = [words_of(piece) for piece in new]
        flat = list({word for found in words for word in found})
        value = dict(zip(flat, (kernel.against(flat, self.table)[:, 0] + self.bias).tolist()))
        known.update((piece, value[found[0]] if len(found) == 1 else max(map(value.__getitem__, found), default=self.bias))
                     for piece, found in zip(new, words))
        return np.array([max(map(known.__getitem__, found), default=self.bias) for found in pieces])

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * values + self.offset, -30, 30)))


def fit(texts: list[str], label: np.ndarray, landmarks: int = 40, max_words: int = 20_000, rounds: int = 3,
        clean_weight: float = 4.0) -> Model:
    """A model from labelled texts; ``landmarks`` of each kind, at most ``max_words`` clean words."""
    if not 0 < label.sum() < len(label):
        raise ValueError("labelled documents of both kinds are needed")
    kernel = Subsequences()
    bags = [[{w for piece in pieces_of(sentence) for w in words_of(piece) if len(w) >= ORDER}
             for sentence in _SENTENCE.split(text)] for text in texts]
    docs = [set().union(*sentences) for sentences in bags]
    counts: dict[str, list[int]] = {}
    for words, toxic in zip(docs, label.tolist()):
        for word in words:
            counts.setdefault(word, [0, 0])[toxic] += 1
    n_toxic, n_clean = int(label.sum()), int(len(label) - label.sum())
    odds = {w: np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1)) for w, (c, t) in counts.items()}
    clean = sorted((w for w, (c, _) in counts.items() if c), key=lambda w: hash_order(w))[:max_words]
    telling = sorted((w for w, (c, t) in counts.items() if t >= 3 and odds[w] > TELLING), key=lambda w: (-odds[w], w))
    telling = telling[:10 * landmarks]
    alike = kernel.vectors(telling).columns
    alike = alike.T @ alike
    chosen: list[int] = []
    for i in range(len(telling)):  # the most telling words that are not nearly one already taken
        if len(chosen) < landmarks and (not chosen or alike[i, chosen].max() < 0.9):
            chosen.append(i)
    toxic_marks = [telling[i] for i in chosen]
    near = kernel.against(clean, kernel.vectors(toxic_marks))
    nearest = {clean[i] for i in np.argsort(-near, axis=0, kind="stable")[:1].ravel().tolist()}
    table = kernel.vectors(toxic_marks + sorted(nearest))
    marks = table.columns
    inner = marks.T @ marks + 1e-4 * np.eye(marks.shape[1])
    size, axes = np.linalg.eigh(inner)
    root = axes @ np.diag(1 / np.sqrt(np.maximum(size, 1e-4))) @ axes.T

    def mapped(words: list[str]) -> np.ndarray:
        return kernel.against(words, table) @ root

    toxic_bags = [sentence for sentences, toxic in zip(bags, label.tolist()) if toxic for sentence in sentences if sentence]
    value, fitted = odds, False
    negative = mapped(clean)
    for _ in range(rounds):
        found = {max(bag, key=lambda w: (odds[w] > TELLING, value[w], w)) for bag in toxic_bags}
        # a word of clean documents needs the log odds, whatever the machine finds
        positive = sorted(w for w in found if odds[w] > TELLING or fitted and value[w] > 0 and not counts[w][0])
        often = np.array([counts[w][1] for w in positive] * 2, dtype=float)
        positive += _with_letters_put_in(positive)
        other = ~np.isin(clean, positive)
        x = np.vstack((mapped(positive), negative[other]))
        y = np.concatenate((np.ones(len(positive)), -np.ones(other.sum())))
        weight = np.concatenate((often / often.sum(), np.full(other.sum(), clean_weight / other.sum())))
        w, bias = _machine(x, y, weight)
        weights = Weights(table.rows, (marks @ (root @ w)).astype(np.float32)[:, None])
        distinct = sorted(set().union(*toxic_bags))
        value = dict(zip(distinct, (kernel.against(distinct, weights)[:, 0] + bias).tolist()))
        fitted = True
    model = Model(weights, bias, 1.0, 0.0)
    model.slope, model.offset = _logistic(model.values(texts, kernel), label.astype(float))
    return model


def hash_order(word: str) -> int:
    """An order of words that does not depend on the run."""
    return int.from_bytes(word.encode()[::-1], "little") * 0x9E3779B97F4A7C15 % (1 << 64)


def _score_all(parts: Iterator[pa.RecordBatch], text: str, model: Model) -> Iterator[pa.RecordBatch]:
    kernel, known = Subsequences(), {}
    for batch in parts:
        for part in batches.slices(batch, text):
            scores = model.scores(model.values([t or "" for t in part.column(text).to_pylist()], kernel, known))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores.astype(np.float64))], names=[*part.schema.names, "score"])


def score(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold``)."""
    table = Table(docs)
    text = table.at(text_column)
    shared = docs.sparkSession.sparkContext.broadcast((model.table.rows, model.table.columns, model.bias, model.slope, model.offset))

    def unpacked() -> Model:  # sent as plain values, because executors need not have this package
        rows, columns, *rest = shared.value
        return Model(Weights(rows, columns), *rest)

    scored = table.df.mapInArrow(lambda parts: _score_all(parts, text, unpacked()), schema_with(table.df, score=T.DoubleType()))
    return table.restore(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), "score", "predicted")


def train(docs: DataFrame, labels: DataFrame, label_column: str = "toxic", rows: int = 1200, max_bytes: int = 20_000) -> Model:
    """A model from at most ``rows`` labelled documents of each kind that are not held out."""
    drawn = sorted(labelled.sample(docs, labels, label_column, rows, max_bytes).collect())
    return fit([r["text"] for r in drawn], np.array([r["label"] for r in drawn]))
