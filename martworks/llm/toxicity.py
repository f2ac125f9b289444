"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks, on sentences.

Words are compared by the gap-weighted subsequence kernel: all subsequences of three
characters within a span of ``SPAN``, each weighted by ``DECAY`` to the power of its span,
divided by the norms of words of those lengths and raised to the third power. Gaps and
inserted characters lower the value a little, they do not break it. Marks inside a word
are left out, digits that stand for letters are read as these, and three or more single
characters in a row count as one word. A sentence is the sum over its words, so the kernel of two
sentences is the sum over their pairs of words. With ``LANDMARKS`` words as Nystroem
landmarks, a sentence is a short vector; a linear SVM (squared hinge) is fitted to
sentences of labelled texts. In a toxic text the sentences with words that toxic texts
favour are the positive ones; they are chosen anew by the first fit. A text's score is a
logistic function of its largest sentence value, the sum of the positive ones and the
number of sentences.

Training is bounded: ``SAMPLE`` labelled texts of each label by hash of the id, of those with
up to ``TRAIN_CHARS`` characters, all sentences of them; equal sentences under one label are
one row with their number as weight. Scoring reads whole texts, without a shuffle. Since a sentence's value is a sum over words, each worker keeps
the value of the words it has met.

Defined cases: null and empty texts are scored as texts without a sentence; without both
labels in training, every text has the share of toxic training texts as score (0 if there
is none); null labels teach nothing; an id labelled more than once is toxic if any label
says so; words over ``LONG`` characters are read in half overlapping parts, all of them;
repeated rows are answered each; a null doc_id is carried and teaches nothing.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import fitted, frugal, labelled_sample, remainder, sliced, text_of
from martworks.llm.ngrams import text_chunks
from martworks.llm.units import Memory

DECAY = 0.65
SPAN = 6
LONG = 16
LANDMARKS = 96
SAMPLE = 2000
TRAIN_CHARS = 20_000
ROWS_AT_ONCE = 1 << 15
#: Texts that a worker scores at a time, and words whose value it keeps.
ROWS_IN_BATCH = 1024
KNOWN_WORDS = 100_000

_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]+\S(?!\S)){2,}")
_MARKS = re.compile(r"[\W_]+")
#: Signs that stand for letters.
_STANDS_FOR = str.maketrans("013457@$", "oieastas")


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence of a text, lower case."""
    low = _SPELLED.sub(lambda m: "".join(m[0].split()), text.lower())
    return [words for part in _SENTENCE.split(low) if (words := part.split())]


@functools.lru_cache(maxsize=1 << 15)
def plain(word: str) -> str:
    """A word without marks around and inside it, signs read as letters."""
    bare = _MARKS.sub("", word)
    if bare.isalpha():
        return bare
    return _MARKS.sub("", word.strip("$%&#*!?.,;:\"'()|").translate(_STANDS_FOR))


def _symbols(words: list[str]) -> np.ndarray:
    """Classes 1 to 63 of the characters of words of one length."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    inside = (codes >= 97) & (codes <= 122)
    return np.where(inside, codes - 96, 27 + codes % 37).reshape(len(words), -1)


@functools.lru_cache
def _triples(length: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Places of the subsequences of three, their weights, the norm of such a word."""
    every = itertools.combinations(range(length), 3)
    at = np.array([t for t in every if t[2] - t[0] < SPAN], np.int64).reshape(-1, 3)
    weight = DECAY ** (at[:, 2] - at[:, 0] + 1.0)
    return at, weight, float(np.sqrt((weight**2).sum()))


def _parts(word: str) -> list[str]:
    word = plain(word)
    if len(word) <= LONG:
        return [word] if len(word) >= 3 else []
    starts = [*range(0, len(word) - LONG, LONG // 2), len(word) - LONG]
    return [word[a : a + LONG] for a in starts]


class Kernel:
    """Kernel values of words with the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        rows: dict[int, np.ndarray] = {}
        for k, word in enumerate(landmarks):
            at, weight, norm = _triples(len(word))
            code = _symbols([word])[0][at] @ [4096, 64, 1]
            for c, w in zip(code.tolist(), weight.tolist()):
                rows.setdefault(c, np.zeros(len(landmarks), np.float32))[k] += w / norm
        self.row_of = np.zeros(1 << 18, np.int32)
        self.row_of[list(rows)] = np.arange(1, len(rows) + 1)
        self.rows = np.vstack([np.zeros(len(landmarks), np.float32), *rows.values()])

    def values(self, words: list[str]) -> np.ndarray:
        """(words, landmarks): the normalized kernel, to the third power."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        by_length: dict[int, tuple[list[int], list[str]]] = {}
        for i, word in enumerate(words):
            for part in _parts(word):
                who, parts = by_length.setdefault(len(part), ([], []))
                who.append(i)
                parts.append(part)
        for length, (who, parts) in by_length.items():
            at, weight, norm = _triples(length)
            weight = (weight / norm).astype(np.float32)
            step = max(1, 25_000 // len(at))
            for lo in range(0, len(who), step):
                c = _symbols(parts[lo : lo + step])
                row = self.row_of[c[:, at[:, 0]] * 4096 + c[:, at[:, 1]] * 64 + c[:, at[:, 2]]]
                of, place = np.nonzero(row)
                if not len(of):
                    continue
                first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                share = self.rows[row[of, place]]
                share *= weight[place][:, None]
                got = np.minimum(np.add.reduceat(share, first, axis=0), 1)
                got *= got * got
                owner = np.array(who[lo : lo + step])[of[first]]
                if length < LONG:
                    out[owner] += got
                else:
                    # several parts of one word
                    np.add.at(out, owner, got)
        return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by Newton steps.

    The last column of ``x`` is the bias; rows without cost take no part. Rows are read in
    blocks, so that ``x`` is held once.
    """
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        bend, slope = np.diag(keep), np.zeros(len(w))
        for lo in range(0, len(x), ROWS_AT_ONCE):
            a, b, c = (v[lo : lo + ROWS_AT_ONCE] for v in (x, y, cost))
            inside = (b * (a @ w) < 1) & (c > 0)
            a, c = a[inside].astype(float), c[inside]
            bend += (a * c[:, None]).T @ a
            slope += a.T @ (c * b[inside])
        new = np.linalg.solve(bend, slope)
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (cost * (p - y)) + ridge * w
        bend = (x * (cost * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _favoured(texts: list[list[list[str]]], y: np.ndarray) -> dict[str, float]:
    """How far the share of toxic texts with a word is above that of clean ones (z value)."""
    n = [max(1, int((y == k).sum())) for k in (0, 1)]
    toxic, clean = Counter(), Counter()
    for text, label in zip(texts, y):
        if label == 1:
            toxic.update({plain(w) for words in text for w in words})
    for text, label in zip(texts, y):
        if label == 0:
            clean.update({plain(w) for words in text for w in words}.intersection(toxic))
    out = {}
    for word, a in toxic.items():
        b = clean[word]
        share = (a + b + 1) / (n[0] + n[1] + 2)
        z = (a / n[1] - b / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
        out[word] = float(z)
    return out


def _pick_landmarks(favoured: dict[str, float], texts) -> list[str]:
    """Words that toxic texts favour, not too near each other, and some that nobody does."""
    ranked = [w for w in favoured if 3 <= len(w) <= LONG]
    ranked.sort(key=lambda w: (-favoured[w], w))
    ranked = ranked[: 6 * LANDMARKS]
    chosen: list[str] = []
    if ranked:
        near = Kernel(ranked).values(ranked)
        taken: list[int] = []
        for i in range(len(ranked)):
            if len(taken) == LANDMARKS * 3 // 4:
                break
            if not taken or near[i, taken].max() < 0.85**3:
                taken.append(i)
        chosen = [ranked[i] for i in taken]
    common = Counter(plain(w) for text in texts for words in text for w in words)
    usual = [w for w in common if 3 <= len(w) <= LONG and favoured.get(w, 0) <= 1]
    usual.sort(key=lambda w: (-common[w], w))
    return chosen + [w for w in usual if w not in chosen][: LANDMARKS - len(chosen)]


class Model:
    """Scores texts; fitted on labelled texts."""

    def __init__(self, share: float = 0.0):
        self.share, self.kernel = share, None

    @classmethod
    def fit(cls, labelled: list[tuple[str, int]], share: float) -> Model:
        """``share``: the share of toxic texts among all labelled ones."""
        model = cls(share)
        y = np.array([k for _, k in labelled], float)
        if not len(y) or y.min() == y.max():
            return model
        # each word is held once
        pool: dict[str, str] = {}
        texts = [
            [[pool.setdefault(w, w) for w in words] for words in sentences(t)] for t, _ in labelled
        ]
        favoured = _favoured(texts, y)
        landmarks = _pick_landmarks(favoured, texts)
        if not landmarks:
            return model
        kernel = Kernel(landmarks)
        gram = kernel.values(landmarks).astype(float)
        size, axes = np.linalg.eigh((gram + gram.T) / 2)
        whiten = axes / np.sqrt(np.maximum(size, 1e-3))
        # equal sentences under one label are one row
        rows: dict[tuple, int] = {}
        for text, label in zip(texts, y.tolist()):
            for part in text:
                row = (label, *part)
                rows[row] = rows.get(row, 0) + 1
        times = np.array(list(rows.values()), float)
        words = sorted({w for row in rows for w in row[1:]})
        at = {w: i for i, w in enumerate(words)}
        vectors = kernel.values(words) @ whiten.astype(np.float32)
        tells = np.array([favoured.get(plain(w), 0) for w in words])
        x = np.ones((len(rows), len(landmarks) + 1), np.float32)
        told = np.empty(len(rows))
        for i, row in enumerate(rows):
            of = [at[w] for w in row[1:]]
            x[i, :-1] = vectors[of].sum(axis=0)
            told[i] = tells[of].max()
        toxic = np.array([row[0] == 1 for row in rows], bool)
        del vectors, at, words, tells, rows
        # among the words of whole texts, some reach three deviations by chance
        positive = toxic & (told > 5)
        if not positive.any():
            positive = toxic & (told > 3)
        for _ in range(3):
            if not positive.any():
                return model
            sign = np.where(positive, 1.0, -1.0)
            cost = np.where(
                positive, 1 / times[positive].sum(), 2 / max(1, times[~toxic].sum())
            )
            cost *= times * times[positive | ~toxic].sum()
            cost[toxic & ~positive] = 0
            fitted = _svm(x, sign, cost, 1.0)
            value = np.concatenate(
                [x[lo : lo + ROWS_AT_ONCE] @ fitted for lo in range(0, len(x), ROWS_AT_ONCE)]
            )
            positive = toxic & (value > 0)
        model.kernel, model.bias = kernel, float(fitted[-1])
        model.alpha = (whiten @ fitted[:-1]).astype(np.float32)
        known = Memory(model._words)
        seen = model._evidence([t for t, _ in labelled], known)
        weigh = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        model.link = _logistic(seen, y, weigh, 0.1)
        return model

    def _words(self, words: list[str]) -> list[float]:
        return (self.kernel.values(words) @ self.alpha).tolist()

    def _evidence(self, texts: list[str], known: Memory) -> np.ndarray:
        """Of each text: largest sentence value, sum of the positive ones, sentences."""
        out = np.zeros((len(texts), 3))
        for lo, hi in text_chunks(texts):
            cut = [sentences(t) for t in texts[lo:hi]]
            flat = known.look_up([w for text in cut for words in text for w in words])
            a = 0
            for i, text in enumerate(cut, lo):
                most, total = -2.0, 0.0
                for words in text:
                    value = sum(flat[a : a + len(words)]) + self.bias
                    a += len(words)
                    if value > 0:
                        total += value
                    if value > most:
                        most = value
                out[i] = min(6.0, most), math.log1p(total), math.log1p(len(text))
        return out

    def score(self, texts: list[str], known: Memory) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(texts), self.share)
        x = self._evidence(texts, known)
        return 1 / (1 + np.exp(-np.clip(x @ self.link[:-1] + self.link[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model:
    """Fits on a sample of the labelled rows of ``docs`` outside fold 0."""
    marked = (
        labels.select(
            labels["doc_id"].cast("long").alias("doc_id"),
            labels["toxic"].cast("int").alias("toxic"),
        )
        .where("doc_id is not null and toxic in (0, 1)")
        .where(remainder(F.col("doc_id"), folds) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = marked.agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).first()
    if not n["n"]:
        return Model()
    share = n["k"] / n["n"]
    rows = labelled_sample(docs, marked, "toxic", SAMPLE, TRAIN_CHARS)
    return fitted(rows, functools.partial(Model.fit, share=share))


@frugal
def _score(batches, model: Broadcast):
    known = Memory(model.value._words, most=KNOWN_WORDS)
    for batch in sliced(batches, ROWS_IN_BATCH):
        score = model.value.score(batch.column("text").to_pylist(), known)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(score, pa.float64()),
                pa.array((score >= 0.5).astype(np.int32)),
            ],
            ["doc_id", "held_out", "score", "predicted"],
        )


@frugal
def _keep_clean(batches, model: Broadcast):
    known = Memory(model.value._words, most=KNOWN_WORDS)
    for batch in sliced(batches, ROWS_IN_BATCH):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        yield batch.filter(pa.array(model.value.score(texts, known) < 0.5))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, folds))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        text_of(docs),
        (remainder(docs["doc_id"], folds) == 0).alias("held_out"),
    )
    return rows.mapInArrow(
        functools.partial(_score, model=sent),
        "doc_id long, held_out boolean, score double, predicted int",
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return docs.mapInArrow(functools.partial(_keep_clean, model=sent), docs.schema)
