"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of order 1 to 4 of every training text (lower case) in 2^16
buckets for each language, one dense row of counts for each language and task, summed by
Spark. The log-probability matrix (languages x buckets, 2^16 doubles for each language,
``MAX_LANGUAGES`` at most) is broadcast; scoring is a product of the sparse matrix of a
batch's n-grams with it, text by text.

Defined cases: null text or text without a letter is ``und`` with score 0; rows with null
lang teach nothing; without any training row all is ``und``; ties go to the first language
in code-point order; a null doc_id counts as empty text for the split and is carried;
repeated rows are answered each; an empty table gives no rows; other columns are never
read.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import frugal, remainder, staged, text_of
from martworks.llm.ngrams import code_points, hashed, row_sums, text_chunks

BITS = 16
ORDERS = range(1, 5)
SMOOTHING = 0.5
MAX_LANGUAGES = 256

_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether a character is a letter (Unicode categories L*)."""
    return _ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))


@frugal
def _count(batches, bits: int):
    """(lang, bucket, n) of a task's texts; bucket -1 has the number of texts."""
    grams = defaultdict(lambda: np.zeros(1 << bits, np.int64))
    texts_of = Counter()
    for batch in batches:
        by_lang = defaultdict(list)
        for lang, text in zip(
            batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        ):
            if has_letter(text):
                by_lang[lang].append(text.lower())
        for lang, texts in by_lang.items():
            texts_of[lang] += len(texts)
            for lo, hi in text_chunks(texts):
                codes, offsets = code_points(texts[lo:hi])
                for bucket, _ in hashed(codes, offsets, ORDERS, bits):
                    grams[lang] += np.bincount(bucket, minlength=1 << bits)
    for lang, counts in grams.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (len(used) + 1), pa.string()),
                pa.array(np.append(used, -1).astype(np.int32)),
                pa.array(np.append(counts[used], texts_of[lang])),
            ],
            ["lang", "bucket", "n"],
        )


class Model:
    """Log probabilities of the buckets (a column for each language) and of the languages."""

    def __init__(self, langs: list[str], log_p: np.ndarray, log_prior: np.ndarray, bits: int):
        self.langs, self.log_p, self.log_prior, self.bits = langs, log_p, log_prior, bits

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        limit = max(1 << 14, (1 << 21) // len(self.langs))
        for lo, hi in text_chunks(texts, limit):
            lowered = [t.lower() for t in texts[lo:hi]]
            codes, offsets = code_points(lowered)
            total = np.tile(self.log_prior, (hi - lo, 1))
            for bucket, first in hashed(codes, offsets, ORDERS, self.bits):
                total += row_sums(self.log_p[bucket], first)
            best = total.argmax(axis=1)
            chance = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            for i, text in enumerate(texts[lo:hi]):
                known = has_letter(text)
                names.append(self.langs[best[i]] if known else "und")
                scores.append(float(chance[i]) if known else 0.0)
        return names, scores


def fit(rows: DataFrame, bits: int = BITS) -> Model:
    """The model of all ``rows`` (text, lang); rows with null lang teach nothing."""
    counted = (
        rows.where("lang is not null")
        .select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(functools.partial(_count, bits=bits), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    counted = staged(counted, "ngram-counts")
    texts_of = counted.where("bucket = -1").orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    langs = [r["lang"] for r in texts_of]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages: the matrix would not be bounded")
    counts = np.zeros((1 << bits, len(langs)))
    # numbers come to the driver, not a name for each count
    numbered = F.broadcast(
        rows.sparkSession.createDataFrame(list(enumerate(langs)), "number int, lang string")
    )
    table = counted.where("bucket >= 0").join(numbered, "lang").select("number", "bucket", "n")
    table = table.toArrow()
    at = [table.column(c).to_numpy() for c in ("bucket", "number")]
    counts[at[0], at[1]] = table.column("n").to_numpy()
    counts += SMOOTHING
    n = np.array([r["n"] for r in texts_of], float)
    log_p = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    return Model(langs, log_p, np.log(n / n.sum()) if langs else n, bits)


@frugal
def _predict(batches, model: Broadcast):
    for batch in batches:
        names, scores = model.value.score(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(names, pa.string()),
                pa.array(scores, pa.float64()),
            ],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows outside fold 0."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        text_of(docs),
        docs["lang"].cast("string").alias("lang"),
        (remainder(docs["doc_id"], folds) == 0).alias("held_out"),
    )
    model = fit(rows.where("not held_out").select("text", "lang"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        functools.partial(_predict, model=sent),
        "doc_id long, held_out boolean, lang_pred string, score double",
    )
