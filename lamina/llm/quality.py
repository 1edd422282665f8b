"""Quality by random-indexing word vectors, pooled per document, and a two-layer network.

A word stands for its row: itself, if it is frequent in the sample, else its shape (runs of capitals, small
letters, digits and each sign as one character). A word that repeats the one before it has the row of its repeated
shape. Every row has a sparse random index vector; a row's word vector is its index vector plus the sum of the
index vectors of its neighbours over the sample, both of unit length. A document is the mean of its words'
vectors. A network of one hidden layer, trained with numpy, gives a logit; a temperature fitted on a part of the
sample that the network did not see, and the share of label 1, make it a calibrated probability.

Null and empty texts are documents of mean zero; texts and runs without blanks may have any length, and count as a
whole. Without labelled documents of both classes every score is the share of label 1. Repeated rows get equal
scores, and words of equal counts are taken by name; an empty table gives an empty result. Only the column that is
given is read, so other columns may have any names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .common import prepare, task

DIM, NONZERO, WINDOW = 96, 6, 2
#: Characters of a word at most; what has no blanks is many words.
WIDE = 64
FREQUENT, HIDDEN, EPOCHS = 5000, 32, 300
_RUN = re.compile(r"(.)\1+")


def shape(token: str) -> str:
    """What a token looks like: letters as A or a, digits as 0, signs as they are, runs as one character."""
    marks = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return "\0" + _RUN.sub(r"\1", marks)


def words(text: str) -> list[str]:
    """The runs without white space of a text; one of more than WIDE characters is a word for each WIDE of them."""
    out = text.split()
    if max(map(len, out), default=0) <= WIDE:
        return out
    return [w[i : i + WIDE] for w in out for i in range(0, len(w), WIDE)]


@dataclass
class Model:
    rows: dict[str, int]
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float
    prior: float
    constant: float | None = None


def _index(name: str) -> np.ndarray:
    rng, out = np.random.default_rng(zlib.crc32(name.encode())), np.zeros(DIM, np.float32)
    out[rng.choice(DIM, NONZERO, replace=False)] = rng.choice((-1.0, 1.0), NONZERO)
    return out


#: Tokens whose rows a task remembers.
REMEMBERED = 150_000


class Rows(dict):
    """The row of a token, and that of its repetition, by the token."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.names, self.other = known, known["\0?"]

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) > REMEMBERED:
            self.clear()
        form = shape(token)
        plain = self.names.get(token.lower()) if token.islower() or token.istitle() else None
        own = plain if plain is not None else self.names.get(form, self.other)
        self[token] = out = (own, self.names.get("\0=" + form, self.names["\0=?"]))
        return out


def numbered(many: list[str], rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all words of the texts one behind the other, and the number of words of each text."""
    own: list[int] = []
    lengths = []
    for text in many:
        found = words(text)
        lengths.append(len(found))
        if found:
            places = [rows[w] for w in found]
            own.append(places[0][0])
            own += [p[w is v or w == v] for p, w, v in zip(places[1:], found[1:], found, strict=False)]
    return np.array(own, np.int64), np.array(lengths)


def pooled(many: list[str], rows: Rows, vectors: np.ndarray) -> np.ndarray:
    """The mean word vector of each text."""
    own, lengths = numbered(many, rows)
    out, at = np.zeros((len(many), vectors.shape[1]), np.float32), np.cumsum(lengths) - lengths
    for i, (a, n) in enumerate(zip(at.tolist(), lengths.tolist(), strict=True)):
        # a text of many words in parts, each as counts of rows
        if n:
            places, counts = np.unique(own[a : a + n], return_counts=True)
            out[i] = counts.astype(np.float32) @ vectors[places] / n
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _word_vectors(many: list[str]) -> tuple[dict[str, int], np.ndarray]:
    plain, shapes = Counter(), Counter()
    for text in many:
        found = words(text)
        plain.update(w.lower() for w in found if w.islower() or w.istitle())
        shapes.update(shape(w) for w in found)
    common = [w for w, n in sorted(plain.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT] if n > 4]
    forms = [w for w, n in sorted(shapes.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT] if n > 2]
    plain.clear()
    names = ["\0?", "\0=?", *common, *forms, *("\0=" + f for f in forms)]
    rows = {n: i for i, n in enumerate(dict.fromkeys(names))}
    index = np.stack([_index(n) for n in rows])
    own, lengths = numbered(many, Rows(rows))
    text = np.repeat(np.arange(len(lengths)), lengths)
    context = np.zeros(index.size)
    spots, signs = np.argsort(-np.abs(index), axis=1, kind="stable")[:, :NONZERO], None
    signs = np.take_along_axis(index, spots, axis=1)
    for step in range(1, WINDOW + 1):
        near = text[step:] == text[:-step]
        a, b = own[:-step][near], own[step:][near]
        for x, y in ((a, b), (b, a)):
            for k in range(NONZERO):
                context += np.bincount(x * DIM + spots[y, k], signs[y, k], index.size)
    return rows, (_unit(index) + _unit(context.reshape(index.shape))).astype(np.float32)


def _forward(x: np.ndarray, layers: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = layers
    hidden = np.maximum(x @ a + b, 0)
    return hidden, hidden @ c + d


def fit(rows: list[tuple[str, int]], share: float) -> Model:
    """A model from labelled texts; one in five calibrates it."""
    n = Counter(y for _, y in rows)
    if min(n[0], n[1]) < 5:
        names = {"\0?": 0, "\0=?": 1}
        return Model(names, np.zeros((2, DIM), np.float32), np.zeros(DIM), np.ones(DIM), (), 1.0, 0.0, share)
    many, y = [t for t, _ in rows], np.array([v for _, v in rows], float)
    names, vectors = _word_vectors(many)
    x = pooled(many, Rows(names), vectors).astype(float)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - centre) / scale
    rng = np.random.default_rng(1)
    aside = np.zeros(len(y), bool)
    for v in (0, 1):  # of each class alike
        own = rng.permutation(np.flatnonzero(y == v))
        aside[own[: len(own) // 5]] = True
    weight = np.where(y == 1, 0.5 / n[1], 0.5 / n[0]) * len(y)
    layers = tuple(z.astype(float) for z in (rng.standard_normal((DIM, HIDDEN)) / np.sqrt(DIM), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)))
    first, second = [np.zeros_like(z) for z in layers], [np.zeros_like(z) for z in layers]
    own, t = np.flatnonzero(~aside), 0
    for epoch in range(EPOCHS):
        for part in np.array_split(rng.permutation(own), max(1, len(own) // 256)):
            hidden, logit = _forward(x[part], layers)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]) * weight[part] / len(part)
            back = np.outer(error, layers[2]) * (hidden > 0)
            gradient = (x[part].T @ back + 1e-4 * layers[0], back.sum(axis=0), hidden.T @ error + 1e-4 * layers[2], error.sum(keepdims=True))
            t += 1
            for i, g in enumerate(gradient):  # Adam
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                layers[i][...] -= 0.003 * (1 - epoch / EPOCHS) * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    logit = _forward(x[aside], layers)[1]

    def loss(temperature: float) -> float:
        return float((weight[aside] * np.logaddexp(0, np.where(y[aside] == 1, -logit, logit) / temperature)).mean())

    temperature = min(np.geomspace(0.5, 20, 60), key=loss)
    share = min(max(share, 0.01), 0.99)
    return Model(names, vectors, centre, scale, layers, float(temperature), float(np.log(share / (1 - share))))


def probabilities(model: Model, many: list[str], rows: Rows | None = None) -> np.ndarray:
    """The probability of label 1 for each text."""
    if model.constant is not None:
        return np.full(len(many), model.constant)
    x = (pooled(many, rows or Rows(model.rows), model.vectors) - model.centre) / model.scale
    return 1 / (1 + np.exp(-np.clip(_forward(x, model.layers)[1] / model.temperature + model.prior, -30, 30)))


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to the column of its scores."""
    shared = prepare(spark).sparkContext.broadcast(model)  # its rows are bounded by FREQUENT

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        rows = Rows(model.rows)
        for many in task(parts):
            yield pd.Series(probabilities(model, [x or "" for x in many], rows))

    return score
