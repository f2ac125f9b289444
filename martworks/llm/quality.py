"""Quality: votes of the nearest labelled texts among latent-semantic vectors.

A text is a vector of hashed character n-grams (order 1 to 3, log of the count times the
inverse document frequency, unit length) and a few shares of its style (marks, capitals,
digits, bars, repeated words), which n-grams of different words cannot show. A truncated
singular value decomposition of a labelled sample gives ``DIMENSIONS`` latent axes. The
labelled vectors (``2 * SAMPLE * DIMENSIONS`` floats at most) are broadcast; each batch of
texts is projected and its cosines with all of them are computed exactly, in blocks. The
``NEIGHBOURS`` nearest vote, weighted by similarity; ties with the last of them vote too.

The sample is bounded: ``SAMPLE`` labelled texts of each label by hash of the id, texts up
to ``TRAIN_CHARS`` characters. Both labels are equally many in it, so a score is not the
share of label 1 in the table. Scoring reads whole texts, without a shuffle.

Defined cases: null and empty texts are the vector of an empty text; without a labelled
sample the score is 0.5; with one label it is that label; null labels teach nothing; an id
labelled more than once takes the lowest of its labels; repeated rows are answered each; a
null doc_id is carried and teaches nothing; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import fitted, frugal, labelled_sample, remainder, text_of
from martworks.llm.ngrams import code_points, hashed, text_chunks

BITS = 11
ORDERS = range(1, 4)
STYLE = 8
STYLE_WEIGHT = 1.5
DIMENSIONS = 64
NEIGHBOURS = 25
SAMPLE = 2000
TRAIN_CHARS = 20_000
BLOCK = 512


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point: 0 space, 1 letter, 2 capital, 3 digit, 4 bar, 5 other mark."""
    kind = np.full(0x110000, 5, np.int8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            kind[i] = 2 if c.isupper() else 1
        elif c.isspace():
            kind[i] = 0
        elif c.isdigit():
            kind[i] = 3
    kind[ord("|")] = 4
    return kind


def _style(text: str, kinds: np.ndarray) -> list[float]:
    n = max(1, len(text))
    words = text.split()
    m = max(1, len(words))
    share = np.bincount(kinds, minlength=6) / n
    return [
        share[2],
        share[3],
        min(1.0, 8 * share[4]),
        min(1.0, 4 * share[5]),
        sum(map(eq, words, words[1:])) / m,
        1 - len(set(words)) / m,
        min(1.0, n / m / 30),
        1 / (1 + m / 10),
    ]


def features(texts: list[str]) -> np.ndarray:
    """(texts, 2^BITS + STYLE): logs of n-gram counts, then the shares of style."""
    out = np.zeros((len(texts), (1 << BITS) + STYLE), np.float32)
    for lo, hi in text_chunks(texts):
        codes, offsets = code_points(texts[lo:hi])
        kinds = _kinds()[codes]
        for bucket, first in hashed(codes, offsets, ORDERS, BITS):
            for i in range(lo, hi):
                row = bucket[first[i - lo] : first[i - lo + 1]]
                out[i, : 1 << BITS] += np.bincount(row, minlength=1 << BITS)
        for i in range(lo, hi):
            out[i, 1 << BITS :] = _style(texts[i], kinds[offsets[i - lo] : offsets[i - lo + 1]])
    np.log1p(out[:, : 1 << BITS], out=out[:, : 1 << BITS])
    return out


class Model:
    """Latent axes and the labelled vectors."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.labels = np.array(labels, np.float32)
        if not len(self.labels):
            return
        raw = features(texts)
        seen = (raw[:, : 1 << BITS] > 0).sum(axis=0)
        self.idf = np.log((1 + len(raw)) / (1 + seen)).astype(np.float32) + 1
        rows = self._weighted(raw)
        # truncated decomposition by a random range and power steps
        draw = np.random.default_rng(7).standard_normal((rows.shape[1], DIMENSIONS + 16))
        base = rows @ draw.astype(np.float32)
        for _ in range(3):
            base, _ = np.linalg.qr(base)
            base = rows @ (rows.T @ base)
        base, _ = np.linalg.qr(base)
        _, _, axes = np.linalg.svd(base.T @ rows, full_matrices=False)
        self.axes = np.ascontiguousarray(axes[:DIMENSIONS].T)
        self.vectors = self._latent(raw)

    def _weighted(self, raw: np.ndarray) -> np.ndarray:
        grams = raw[:, : 1 << BITS] * self.idf
        size = np.linalg.norm(grams, axis=1, keepdims=True)
        return np.hstack([grams / np.maximum(size, 1e-9), STYLE_WEIGHT * raw[:, 1 << BITS :]])

    def _latent(self, raw: np.ndarray) -> np.ndarray:
        at = self._weighted(raw) @ self.axes
        return at / np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        k = min(NEIGHBOURS, len(self.labels))
        out = np.zeros(len(texts))
        for lo in range(0, len(texts), BLOCK):
            near = self._latent(features(texts[lo : lo + BLOCK])) @ self.vectors.T
            last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            weight = np.where(near >= last[:, None], np.maximum(near, 1e-6), 0) ** 4
            out[lo : lo + BLOCK] = weight @ self.labels / weight.sum(axis=1)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model:
    """The model of a sample of the labelled rows of ``docs`` outside fold 0."""
    marked = (
        labels.select(
            labels["doc_id"].cast("long").alias("doc_id"),
            labels["quality"].cast("int").alias("quality"),
        )
        .where("doc_id is not null and quality in (0, 1)")
        .where(remainder(F.col("doc_id"), folds) != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    return fitted(labelled_sample(docs, marked, "quality", SAMPLE, TRAIN_CHARS), _model)


def _model(rows: list[tuple[str, int]]) -> Model:
    return Model([text for text, _ in rows], [label for _, label in rows])


@frugal
def _score(batches, model: Broadcast):
    for batch in batches:
        score = model.value.score(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(score, pa.float64()),
                pa.array((score >= 0.3).astype(np.int32)),
            ],
            ["doc_id", "held_out", "score", "predicted"],
        )


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
