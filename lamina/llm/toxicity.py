"""Toxicity by a support vector machine with a subsequence string kernel and Nystroem landmarks.

The kernel compares two words by the subsequences of three characters that they share, each within a span of five;
a wider span weighs less, so a word with gaps or inserted characters stays near its plain form. It is divided by
the norms of both words' features, which are few enough to be written out, so every kernel value is one sparse product.

The machine is trained on sentences. A sentence of a toxic document is positive if it holds a word that, itself or by
its beginning, marks toxic documents of the sample; words of other documents are negative, unless they are far more
frequent in toxic ones. A sentence is seen through its most toxic word, as is a document: words are chosen, landmarks
are picked among them, the machine is fitted in the landmarks' space, and words are chosen again by its scores, with
all words of other documents that came near the margin added as negatives and the worst of them as landmarks. What
the kernel tolerates is trained too: forms of frequent insults with a letter put in are positive, and some of them
landmarks, so that no list of words or forms stands beside the machine. A document's margin is the greatest of its
sentences' margins. A logistic curve makes it a probability: 0.7 where documents and forms are told apart best, with
the slope of least log loss over the sample.

Letters that are spelled out with blanks, dots, dashes, underscores or stars between them are read as one word too. A
word wider than ``WIDEST`` is seen through windows of that width. An insult of ordinary words, and one with a blank
inside, are not found.

Null and empty texts get the score of a margin below all others; texts may have any length. Without labelled
documents of both classes every score is the share of label 1, at most one half. Repeated rows get equal scores; an
empty table gives an empty result. Only the column that is given is read, so other columns may have any names.
"""

from __future__ import annotations

import re
import string
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .common import prepare, task, trim

SPAN, DECAY = 5, 0.7
#: Landmarks: a quarter words, a quarter forms of words, the others words that are not toxic.
LANDMARKS, WIDEST = 384, 40
#: Letters of an insult whose forms with a letter put in are trained, and letters that are put in at each place.
SHORTEST, PUT_IN = 4, 8
#: The share of toxic documents that an insult marks whose forms are trained.
FREQUENT = 0.03
#: The share of other documents that may quote an insult.
QUOTED = 0.002
#: The chance that any word that says nothing is taken for a mark.
CHANCE = 0.01
#: Toxic documents that a word must mark, in samples of many documents.
SUPPORT = 3
#: Rounds of fitting, the similarity to a landmark from which a word is a negative at once, and the margin from which it becomes one.
ROUNDS, NEAR, ALARM = 6, 0.35, -0.7
#: How much more a false alarm of the last round weighs for each unit of its margin, and what all forms weigh beside all words.
DEAR, SHARE = 20.0, 1.0
#: What a false alarm costs beside a toxic document that is missed.
COST = 10.0
#: Least eigenvalue of the landmarks' kernel that counts, and the weight of the squared norm in the machine's loss.
FLOOR, RIDGE = 0.01, 1e-4
_WAYS = [(a, b, DECAY ** (b - 2)) for b in range(2, SPAN) for a in range(1, b)]
_SPELLED = re.compile(r"(?<!\w)\w(?:[ .\-_*]\w){3,}(?!\w)")
_SENTENCE = re.compile(r"[.!?]+\s+|\n+")
#: Characters that stand for letters.
_STANDS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"})
_RUNS = re.compile(r"(.)\1{2,}")
_ACCENTS = re.compile(r"[\u0300-\u036f]")
_BELOW = -3.0
FEATURES = 1 << 18


def fold(token: str) -> str:
    """A token's letters in lower case, without accents; runs of one are one, digits and signs inside stand for letters."""
    token = _RUNS.sub(r"\1", token.lower().strip(string.punctuation))
    if not token.isascii():
        token = _ACCENTS.sub("", unicodedata.normalize("NFKD", token))
    if token.isalpha():
        return token
    token = re.sub(r"(?<=[a-z])[@$](?=[a-z])", lambda m: "a" if m[0] == "@" else "s", token)
    if any(c.isalpha() for c in token):
        token = token.translate(_STANDS)
    return "".join(c for c in token if c.isalnum())


def _codes(word: str) -> list[int]:
    return [27, *(ord(c) - 96 if "a" <= c <= "z" else 29 + zlib.crc32(c.encode()) % 35 for c in word), 28]


def windows(word: str) -> list[str]:
    """The word, or its parts of WIDEST characters that begin half as many apart, the last one at its end."""
    if len(word) <= WIDEST:
        return [word]
    return [word[at : at + WIDEST] for at in (*range(0, len(word) - WIDEST, WIDEST // 2), len(word) - WIDEST)]


def features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """For words grouped by length: (their places, feature numbers, weights of the columns, norm of the weights)."""
    groups: dict[int, tuple[list[int], list[list[int]]]] = {}
    for i, word in enumerate(words):
        codes = _codes(word)
        places, rows = groups.setdefault(len(codes), ([], []))
        places.append(i)
        rows.append(codes)
    out = []
    for width, (places, rows) in groups.items():
        codes = np.array(rows, np.int32)
        parts, weights = [np.zeros((len(rows), 1), np.int32)], [1e-6]
        for a, b, w in _WAYS:
            if width > b:
                parts.append((codes[:, : width - b] << 12) | (codes[:, a : width - b + a] << 6) | codes[:, b:])
                weights += [w] * (width - b)
        weight = np.array(weights, np.float32)
        out.append((np.array(places), np.concatenate(parts, axis=1), weight, float(np.sqrt(weight @ weight))))
    return out


def norms(ids: np.ndarray, weight: np.ndarray, norm: float) -> np.ndarray:
    """The norm of each word's features, of which those that repeat count as one: never less than that of the weights."""
    out, ordered = np.full(len(ids), norm, np.float32), np.sort(ids, axis=1)
    for i in np.flatnonzero((ordered[:, 1:] == ordered[:, :-1]).any(axis=1)).tolist():
        _, same = np.unique(ids[i], return_inverse=True)
        out[i] = np.linalg.norm(np.bincount(same, weight))
    return out


class Landmarks:
    """Words written out as columns of features, and the kernel between them and others."""

    def __init__(self, words: list[str]):
        self.words = words
        rows = [(np.repeat(places, ids.shape[1]), ids.ravel(), (weight / norms(ids, weight, norm)[:, None]).ravel()) for places, ids, weight, norm in features(words)]
        owner, ids, weight = (np.concatenate(x) for x in zip(*rows, strict=True))
        self.ids, place = np.unique(ids, return_inverse=True)
        self.place = np.zeros(FEATURES, np.int32)
        self.place[self.ids] = np.arange(1, len(self.ids) + 1)
        self.columns = np.zeros((len(self.ids) + 1, len(words)), np.float32)
        np.add.at(self.columns, (place + 1, owner), weight)

    def products(self, words: list[str]) -> np.ndarray:
        """The normalised kernel between words and all landmarks."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        for places, ids, weight, norm in features(words):
            size = norms(ids, weight, norm)
            for a in range(0, len(places), 1000):
                own = self.place[ids[a : a + 1000]]
                out[places[a : a + 1000]] = sum(self.columns[own[:, k]] * weight[k] for k in range(own.shape[1])) / size[a : a + 1000, None]
        return out

    def table(self, coefficients: np.ndarray) -> np.ndarray:
        """A weighted sum of landmarks, as features."""
        out = np.zeros(FEATURES, np.float32)
        out[self.ids] = self.columns[1:] @ coefficients.astype(np.float32)
        return out


def tokens(text: str) -> set[str]:
    """The distinct tokens of a text, spelled-out words among them."""
    out = set(text.split())
    out.update(re.sub(r"[\W_]", "", m[0]) for m in _SPELLED.finditer(text))
    return out


@dataclass
class Model:
    table: np.ndarray
    bias: float
    slope: float
    middle: float
    constant: float | None = None

    def probability(self, margin: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(margin), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin - self.middle), -30, 30)))


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """The squared-hinge machine, by Newton steps; the last coordinate is the bias."""
    z, w = np.c_[z, np.ones(len(z))], np.zeros(z.shape[1] + 1)
    for _ in range(30):
        active = y * (z @ w) < 1
        if not active.any():
            break
        za, c = z[active], weight[active] / weight.sum()
        new = np.linalg.solve(za.T @ (za * c[:, None]) + ridge * np.eye(len(w)), za.T @ (c * y[active]))
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def _distinct(words: list[set[str]]) -> list[int]:
    """Places of documents that are not near copies of an earlier one, by bands of three minima over rare words."""
    common = {w for w, n in Counter(w for own in words for w in own).items() if n > 0.05 * len(words) + 20}
    met: set[tuple] = set()
    out = []
    for i, own in enumerate(words):
        codes = np.array([zlib.crc32(w.encode()) for w in own - common or own], np.uint64)
        least = [int((codes * np.uint64(2 * k + 1) * np.uint64(0x9E3779B1) % np.uint64(4294967291)).min()) for k in range(18)] if len(codes) else [i] * 18
        bands = {(k, *least[3 * k : 3 * k + 3]) for k in range(6)}
        if met.isdisjoint(bands):
            out.append(i)
        met |= bands
    return out


def _marks(found: list[set[str]], seen: dict[int, Counter], n: dict[int, int]) -> set[str]:
    """Words and beginnings that stand in toxic documents more often than chance lets any of so many do.

    The chance is bounded by that of a coin (Chernoff). Where a small sample proves none, those that mark most
    documents are taken in turn, which leaves out words that only stand beside them.
    """
    share, known = n[1] / (n[0] + n[1]), {b for own in found for b in own}

    def proof(b: str) -> float:
        k, q = seen[1][b] + seen[0][b], seen[1][b] / (seen[1][b] + seen[0][b])
        return k * (q * np.log(q / share) + (1 - q) * np.log(max(1 - q, 1e-12) / (1 - share)))

    odds = lambda b: np.log((seen[1][b] + 0.5) / (n[1] + 1)) - np.log((seen[0][b] + 0.5) / (n[0] + 1))
    rare = {b for b in known if odds(b) > np.log(8)}
    out = {b for b in rare if proof(b) > np.log(len(known) / CHANCE)}
    open_ = [] if out else [own & rare for own in found]
    while open_:
        gain = Counter(b for own in open_ for b in own)
        best = max(gain, key=lambda b: (gain[b], len(b), b), default=None)
        if best is None or gain[best] < 3:
            break
        out.add(best)
        open_ = [own for own in open_ if best not in own]
    return out


def fit(rows: list[tuple[str, int]], share: float) -> Model:
    """A model from labelled texts."""
    n = Counter(y for _, y in rows)
    if not n[0] or not n[1]:
        return Model(np.zeros(1, np.float32), 0.0, 1.0, 0.0, min(share, 0.5))
    folded: dict[str, str] = {}
    word_of = lambda token: folded[token] if token in folded else folded.setdefault(token, fold(token))
    words = [{w for t in tokens(text) if (w := word_of(t))} for text, _ in rows]
    single = _distinct(words)
    sentences = [(i, {w for t in tokens(x) if (w := word_of(t))}) for i in single if rows[i][1] for x in _SENTENCE.split(rows[i][0])]
    folded.clear()
    many = Counter(rows[i][1] for i in single)
    beginnings = lambda w: {w, *(w[:k] for k in (4, 5, 6) if len(w) > k)}
    toxic = [i for i in single if rows[i][1]]
    seen = {1: Counter(b for i in toxic for b in {b for w in words[i] for b in beginnings(w)}), 0: Counter()}
    seen[1] = Counter({b: k for b, k in seen[1].items() if k >= 3})
    for i in single:
        if not rows[i][1]:
            seen[0].update({b for w in words[i] for b in beginnings(w) if b in seen[1]})

    used = {k: Counter(w for i in single if rows[i][1] == k for w in words[i]) for k in (0, 1)}
    # a word that a few other documents quote may still be an insult
    few = max(1, QUOTED * many[0])
    clean = {w for w, k in used[0].items() if k > few or (used[1][w] + 0.5) * (many[0] + 1) <= 8 * (k + 0.5) * (many[1] + 1)}
    clean |= {w for own, (_, y) in zip(words, rows, strict=True) if not y for w in own if w not in used[0]}
    marks = _marks([{b for w in words[i] if w not in clean for b in beginnings(w) if b in seen[1]} for i in toxic], seen, many)
    # where a beginning is only somewhat more frequent in toxic documents, chance makes words with it look toxic
    odds = lambda b: (seen[1][b] + 0.5) * (many[0] + 1) / ((seen[0][b] + 0.5) * (many[1] + 1))
    open_ = {b for b in seen[1] if seen[0][b] > few and 1.5 < odds(b) <= 30}
    usual = lambda w: any(b in open_ and seen[1][b] >= 1.5 * used[1][w] for b in beginnings(w))
    suspect = {w for own, (_, y) in zip(words, rows, strict=True) if y for w in own if w not in clean and not marks.isdisjoint(beginnings(w)) and not usual(w)}
    bags = [(i, hit) for i, own in sentences if (hit := own & suspect)]
    if not bags:
        return Model(np.zeros(1, np.float32), 0.0, 1.0, 0.0, min(share, 0.5))
    least = min(SUPPORT, max(1, round(0.01 * many[1])))  # documents that a word must mark

    def supported(picked: set[tuple[int, str]]) -> Counter:
        n = Counter(w for _, w in picked)
        return Counter({w: k for w, k in n.items() if k >= least}) or n

    chosen = supported({(i, w) for i, hit in bags for w in hit})
    others = sorted({x for w in clean for x in windows(w)})
    model, negatives, hard, forms, score = None, set(), [], [], {}
    for _ in range(ROUNDS):
        positives = sorted({x for w in chosen for x in windows(w)})
        frequent = sorted(w for w, k in chosen.items() if k >= max(3, FREQUENT * many[1]) and SHORTEST <= len(w) < WIDEST)
        forms = sorted({g for w in frequent for g in _put_in(w)} - clean - set(chosen))
        own = _apart([x for w, _ in sorted(chosen.items(), key=lambda x: (-x[1], x[0])) for x in windows(w)][: 2 * LANDMARKS], LANDMARKS // 4)
        own += sorted(forms, key=lambda g: zlib.crc32(g.encode()))[: LANDMARKS // 4]
        if not hard:
            near = _in_parts(Landmarks(own).products, others, lambda x: x.max(axis=1))
            hard = [others[i] for i in np.argsort(-near, kind="stable")[: LANDMARKS - len(own)]]
            negatives = {others[i] for i in np.flatnonzero(near >= NEAR)} | set(hard)
        marked = Landmarks([*dict.fromkeys(own + hard)])
        values, vectors = np.linalg.eigh(marked.products(marked.words).astype(float))
        root = vectors[:, values > FLOOR] / np.sqrt(values[values > FLOOR])
        against = sorted(negatives)
        z = marked.products(positives + forms + against).astype(float) @ root
        y = np.r_[np.ones(len(positives) + len(forms)), -np.ones(len(against))]
        heavy = np.array([np.sqrt(chosen.get(w, 1)) for w in positives])
        false = np.array([1 + DEAR * max(0.0, score.get(w, ALARM) - ALARM) for w in against])
        weight = np.r_[heavy / heavy.sum(), np.full(len(forms), SHARE / max(1, len(forms))), false / false.sum()]
        w = _svm(z, y, weight, RIDGE)
        model = Model(marked.table(root @ w[:-1]), float(w[-1]), 1.0, 0.0)
        value = margins(model, others)
        alarms = np.flatnonzero(value > ALARM)
        worst = [others[i] for i in alarms[np.argsort(-value[alarms], kind="stable")]]
        score = dict(zip(worst, value[alarms[np.argsort(-value[alarms], kind="stable")]].tolist(), strict=True))
        known = dict(zip(every := sorted({x for _, hit in bags for x in hit}), margins(model, every).tolist(), strict=True))
        again = supported({(i, max(hit, key=lambda x: (known[x], x))) for i, hit in bags})
        if again == chosen and negatives.issuperset(worst):
            break
        chosen, negatives = again, negatives.union(worst)
        hard = [*dict.fromkeys(worst + hard)][: LANDMARKS - len(own)]
    every = sorted({x for own in words for x in own})
    score = dict(zip(every, margins(model, every).tolist(), strict=True))
    margin = np.array([max((score[x] for x in own), default=_BELOW) for own in words])
    _calibrate(model, margin, np.array([y for _, y in rows]), margins(model, forms))
    del words, seen, sentences, score, others
    trim()
    return model


def _in_parts(products: Callable, words: list[str], reduce: Callable) -> np.ndarray:
    """What is left of each word's products, for many words."""
    return np.concatenate([reduce(products(words[i : i + 10_000])) for i in range(0, len(words), 10_000)] or [np.zeros(0)])


def _apart(words: list[str], most: int) -> list[str]:
    """The first words, of those that are not near copies of an earlier one."""
    near, out = Landmarks(words).products(words), []
    for i in range(len(words)):
        if len(out) < most and (not out or near[i, out].max() < 0.8):
            out.append(i)
    return [words[i] for i in out]


def _calibrate(model: Model, margin: np.ndarray, y: np.ndarray, forms: np.ndarray) -> None:
    """Put probability 0.7 where toxic documents and forms of insults are told from other documents best.

    A false alarm counts ``COST`` times. Of equally good places that in the widest gap is taken, and there the middle.
    """
    weight = np.where(y == 1, 1 / max(1, (y == 1).sum()), 1 / max(1, (y == 0).sum()))
    margin, toxic = np.r_[margin, forms], np.r_[y == 1, np.ones(len(forms), bool)]
    weight = np.r_[weight, np.full(len(forms), 1 / max(1, len(forms)))]
    order = np.argsort(margin, kind="stable")
    at, hit, alarm = margin[order], (weight * toxic)[order], (weight * ~toxic)[order]
    worth = -np.r_[0, np.cumsum(hit)] - COST * (alarm.sum() - np.r_[0, np.cumsum(alarm)])
    bounds = np.r_[at[0] - 1, at, at[-1] + 1]
    gap = np.diff(bounds)
    worth[gap < 1e-6] = -np.inf
    near = np.flatnonzero(worth >= worth.max() - 0.002)
    cut = near[gap[near].argmax()]
    bound = float(bounds[cut] + 0.5 * gap[cut])

    def loss(slope: float) -> float:
        logit = slope * (margin - bound) + np.log(0.7 / 0.3)
        return float((weight * np.logaddexp(0, np.where(toxic, -logit, logit))).sum())

    model.slope = float(min(np.geomspace(0.5, 16, 40), key=loss))
    model.middle = bound - np.log(0.7 / 0.3) / model.slope


def _put_in(word: str) -> list[str]:
    """The word with one letter put in, some letters at each of its inner places."""
    out = []
    for i in range(1, len(word)):
        letters = sorted(string.ascii_lowercase, key=lambda c: zlib.crc32(f"{word} {i} {c}".encode()))
        out += [word[:i] + c + word[i:] for c in letters[:PUT_IN]]
    return out


def margins(model: Model, words: list[str]) -> np.ndarray:
    """The margin of each word: the greatest of its windows.

    Where a bound from above, the norm of the weights for that of the features, is below ALARM, the bound is given.
    """
    out = np.full(len(words), -np.inf, np.float32)
    for a in range(0, len(words), 5_000):
        part = words[a : a + 5_000]
        wide = [(a + i, x) for i, w in enumerate(part) if len(w) > WIDEST for x in windows(w)]
        narrow = [(a + i, w) for i, w in enumerate(part) if len(w) <= WIDEST]
        for items in (narrow, wide):
            owner = np.array([i for i, _ in items], np.int64)
            for places, ids, weight, norm in features([x for _, x in items]):
                value = model.table[ids] @ weight / norm + model.bias
                close = np.flatnonzero(value > max(ALARM, model.bias))
                if len(close):
                    value[close] = (value[close] - model.bias) * norm / norms(ids[close], weight, norm) + model.bias
                if items is narrow:
                    out[owner[places]] = value
                else:
                    np.maximum.at(out, owner[places], value)
    return out


#: Tokens whose margins a task remembers, forgotten beyond the bound, and documents that are cut into tokens at a time.
SOME = 100
REMEMBERED = 150_000


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to the column of its scores."""
    shared = prepare(spark).sparkContext.broadcast(model)  # a megabyte, whatever the data

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, known = shared.value, {}
        for many in task(parts):
            greatest = np.full(len(many), _BELOW)
            for at in range(0, len(many), SOME):
                if len(known) > REMEMBERED:
                    known.clear()
                found = [tokens(x or "") for x in many[at : at + SOME]]
                if model.constant is None:
                    folded = {t: fold(t) for own in found for t in own if t not in known}
                    words = sorted({w for w in folded.values() if w})
                    margin = dict(zip(words, margins(model, words).tolist(), strict=True))
                    known.update((t, margin.get(w, _BELOW)) for t, w in folded.items())
                greatest[at : at + SOME] = [max((known.get(t, _BELOW) for t in own), default=_BELOW) for own in found]
            yield pd.Series(model.probability(greatest))

    return score
