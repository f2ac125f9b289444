"""Token counts by whole-token shortcut.

Offline, once for each worker: every vocabulary string that opens with the space mark is
encoded alone; those that come out as the one token are proven. A text is cut into units
(a run of spaces and what follows), which no merge can cross because no piece of the
vocabulary has a space mark after another character (checked when the model is read).
Units that are proven strings count as one; only the rest is merged, once for each distinct
unit that a worker meets.

Defined cases: null text counts as empty: no bytes, no tokens. Special strings inside a
text are ordinary characters, as the library has it. Every row is answered, repeated ones
too; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import functools
import os

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import text_of
from martworks.llm.units import SPACE_LED, Memory

MARK = "▁"
MODEL = "piece_bpe_32k.model"


class Counter:
    """Counts tokens of texts with a sentencepiece BPE model."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a piece holds a space mark inside: units would not be independent")
        proven = {}
        for i, piece in enumerate(pieces):
            unit = piece.replace(MARK, " ")
            if unit[0] == " " and len(unit) > 1 and self.model.encode(unit[1:]) == [i]:
                proven[unit] = 1
        # a lone space at a text's end is the mark itself
        proven[" "] = 1 if MARK in pieces else len(MARK.encode())
        self.proven = proven
        self.known = Memory(self._merge, proven)

    def _merge(self, units: list[str]) -> list[int]:
        # the library puts a space before each text itself
        return [len(x) for x in self.model.encode([u[1:] for u in units], num_threads=1)]

    def count(self, texts: list[str]) -> list[int]:
        cut = [SPACE_LED.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        out = []
        for units in cut:
            out.append(sum(self.known.look_up(units)))
        return out


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def _count(batches, path: str, limit: int):
    count = counter(path).count
    for batch in batches:
        n = count(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_bytes"),
                pa.array(n, pa.int64()),
                pa.array([x > limit for x in n], pa.bool_()),
            ],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``."""
    path = path or public_tokenizers.path(MODEL)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return rows.mapInArrow(
        functools.partial(_count, path=path, limit=limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )
