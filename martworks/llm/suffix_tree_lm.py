"""Language-model scores from a probabilistic suffix tree over words.

The symbols are the frequent words, ``CLASSES`` classes that all other words fall into by
their last two bytes, and the end of a text. A word is a symbol, and a run of up to ``DEPTH``
symbols a context, from ``least`` occurrences among the N training tokens on: an eighth of the
square root of N, so that alphabet and tree grow with the corpus, and stay small against it (at
most ``8 * sqrt(N)`` contexts of a length; ``LEAST_ALPHABET`` words at least are symbols). A
context is kept if its next-symbol distribution diverges from that of its longest proper suffix
(Kullback-Leibler divergence over ``LEAST_DIVERGENCE`` nats, and significant for its count);
suffixes of what is kept are kept. Distributions are smoothed towards that of the suffix, down
to add-one at the root; next symbols seen less than a ``NEXT_SHARE``-th of ``least`` leave their
share to the suffix, so what all contexts hold grows with the square root of N as well. A token
is scored in the state of the longest kept suffix of what stands before it; a word of a class
also takes its add-one share of the class, unseen words as one.

Word counts cover all training tokens and are one Spark aggregation. The ``KNOWN`` most
frequent words at most go to the workers with their counts (a bound on memory); the other
tokens of the documents are joined with the counts. Symbols are staged once, so that the
passes for each length read no text; what follows each context is counted and summed by Spark.

Defined cases: null and wordless text is the end token alone; without training rows N and
V are 0 and every score is that of an untrained tree; ties in frequency go to the smaller
hash; repeated rows are scored each; a null doc_id counts as empty text for the split and
is carried; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import chunks, frugal, remainder, sliced, staged, text_of, utf8_batch
from martworks.llm.words import word_hashes

LEAST_ALPHABET = 1000
CLASSES = 128
DEPTH = 3
LEAST_NEXT = 2
#: What a context has to be seen, for each time that one of its next symbols has to be.
NEXT_SHARE = 32
LEAST_DIVERGENCE = 0.01
TOWARDS_SUFFIX = 50.0
KNOWN = 1 << 20
#: Texts whose words a worker holds at a time.
ROWS_AT_ONCE = 512
#: Counts that a task gathers before it sums equal ones.
GATHERED = 1 << 21


def least_count(tokens: float) -> float:
    """Occurrences that make a word a symbol and a run a context, of so many tokens."""
    return max(2.0, math.sqrt(tokens) / 8)


def _tokens(batch):
    """(hash, class) of each word of a batch and the first word of each row (n + 1)."""
    data, offsets = utf8_batch(batch.column("text"))
    hashes, classes, firsts, n = [], [], [np.zeros(1, np.int64)], 0
    for lo, hi in chunks(offsets):
        part = data[offsets[lo] : offsets[hi]]
        h, first, starts, ends, low = word_hashes(part, offsets[lo : hi + 1] - offsets[lo])
        last = low[ends - 1].astype(np.int64)
        before = np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0).astype(np.int64)
        hashes.append(h.view(np.int64))
        classes.append((last * 31 + before * 17) % CLASSES)
        firsts.append(first[1:] + n)
        n += len(h)
    if not hashes:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(1, np.int64)
    return np.concatenate(hashes), np.concatenate(classes), np.concatenate(firsts)


@frugal
def _count_words(batches):
    for batch in sliced(batches, ROWS_AT_ONCE):
        h, cls, _ = _tokens(batch)
        word, at, n = np.unique(h, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(word), pa.array(cls[at].astype(np.int32)), pa.array(n.astype(np.int64))],
            ["word", "cls", "n"],
        )


class Words:
    """Counts of the most frequent words, and sums over the rest."""

    def __init__(self, word, cls, n, totals: dict[int, tuple[int, int]], texts: int):
        """``totals``: words counted and distinct by class, over all training words."""
        order = np.argsort(word)
        self.word, self.n = word[order], n[order]
        tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
        for c, (a, b) in totals.items():
            tokens[c], distinct[c] = a, b
        self.texts = texts
        self.tokens = int(tokens.sum()) + texts
        self.distinct = int(distinct.sum()) + (texts > 0)
        self.least = least_count(self.tokens)
        frequent = max(LEAST_ALPHABET, int((n >= self.least).sum()))
        rank = np.lexsort((self.word, -self.n))[:frequent]
        self.alphabet = len(rank)
        self.end = self.alphabet + CLASSES
        self.symbol = np.full(len(word), -1, np.int64)
        self.symbol[rank] = np.arange(len(rank))
        of = cls[order][rank]
        self.root = np.zeros(self.end + 1)
        self.root[: self.alphabet] = self.n[rank]
        tokens -= np.bincount(of, self.n[rank], CLASSES)
        distinct -= np.bincount(of, minlength=CLASSES)
        self.root[self.alphabet : self.end] = tokens
        self.root[self.end] = texts
        self.class_size = np.log10(tokens + distinct + 1)


def count_words(rows: DataFrame) -> tuple[DataFrame, Words]:
    """The table of all words (word, cls, n) of ``rows`` (text), and its frequent part."""
    table = staged(
        rows.mapInArrow(_count_words, "word long, cls int, n long")
        .groupBy("word")
        .agg(F.min("cls").alias("cls"), F.sum("n").alias("n")),
        "words",
    )
    by_class = table.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    totals = {r["cls"]: (r["n"], r["v"]) for r in by_class.collect()}
    # the least count that at most KNOWN words reach: exact steps, then powers of 1.1
    step = F.when(F.col("n") < 64, F.col("n").cast("double")).otherwise(
        F.pow(F.lit(1.1), F.floor(F.log(1.1, F.col("n").cast("double"))))
    )
    steps = table.groupBy(step.alias("least")).agg(F.count("*").alias("v")).collect()
    least, reached = math.inf, 0
    for row in sorted(steps, key=lambda r: -r["least"]):
        reached += row["v"]
        if reached > KNOWN:
            break
        least = row["least"]
    known = table.withColumn("least", step).where(F.col("least") >= least).toArrow()
    texts = rows.count()
    word, cls, n = (known.column(c).to_numpy() for c in ("word", "cls", "n"))
    rare = table.withColumn("least", step).where(F.col("least") < least)
    return rare.select("word", "n"), Words(word, cls.astype(np.int64), n, totals, texts)


_SYMBOL_ROWS = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long,"
    " all_logs double, class_logs double, symbols binary, rare binary"
)


@frugal
def _symbol_rows(batches, words: Broadcast):
    """The symbols of each text, sums of log10(c + 1), and the words to look up."""
    w = words.value
    end_log, end_known = math.log10(w.texts + 1), int(w.texts > 0)
    for batch in sliced(batches, ROWS_AT_ONCE):
        h, cls, first = _tokens(batch)
        distinct, inverse = np.unique(h, return_inverse=True)
        at = np.searchsorted(w.word, distinct)
        at[at == len(w.word)] = 0
        hit = w.word[at] == distinct if len(w.word) else np.zeros(len(distinct), bool)
        count = np.where(hit, w.n[at], 0) if len(w.word) else np.zeros(len(distinct))
        symbol = np.where(hit, w.symbol[at], -1) if len(w.word) else np.full(len(distinct), -1)
        logs, hit, symbol = np.log10(count + 1.0)[inverse], hit[inverse], symbol[inverse]
        in_class = symbol < 0
        symbol = np.where(in_class, w.alphabet + cls, symbol).astype(np.int32)
        out = {k: [] for k in ("n", "known", "all", "class", "symbols", "rare")}
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            out["n"].append(b - a + 1)
            out["known"].append(int(hit[a:b].sum()) + end_known)
            out["all"].append(float(logs[a:b].sum()) + end_log)
            out["class"].append(float(logs[a:b][in_class[a:b]].sum()))
            out["symbols"].append(np.append(symbol[a:b], np.int32(w.end)).tobytes())
            out["rare"].append(h[a:b][~hit[a:b]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(out["n"], pa.int64()),
                pa.array(out["known"], pa.int64()),
                pa.array(out["all"], pa.float64()),
                pa.array(out["class"], pa.float64()),
                pa.array(out["symbols"], pa.binary()),
                pa.array(out["rare"], pa.binary()),
            ],
            [c.split()[0] for c in _SYMBOL_ROWS.split(", ")],
        )


def _joined(column) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a batch in a row, and for each its place in its text."""
    rows = [np.frombuffer(x, np.int32) for x in column.to_pylist()]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (
        np.concatenate(rows).astype(np.int64),
        np.concatenate([np.arange(len(r)) for r in rows]),
    )


class Contexts:
    """Contexts of one length by a code: the number of its suffix, then its first symbol.

    ``nexts`` are the codes (context, next symbol) seen after them, ``times`` how often,
    ``size`` is what each context has seen in all and ``rest`` what ``times`` leaves out.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = np.sort(codes)
        self.nexts, self.times = np.zeros(0, np.int64), np.zeros(0)
        self.size = self.rest = np.zeros(len(codes))

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of the codes, -1 where there is none."""
        return _find(self.codes, codes)

    def follow(self, nexts: np.ndarray, times: np.ndarray, size: np.ndarray, symbols: int):
        order = np.argsort(nexts)
        self.nexts, self.times, self.size = nexts[order], times[order].astype(float), size
        own = np.bincount(self.nexts // symbols, self.times, len(size))
        self.rest = size - own

    def smoothed(self, number, symbol, suffix, symbols: int) -> np.ndarray:
        """Probability of ``symbol`` after context ``number``, ``suffix`` is that after its
        longest proper suffix."""
        at = _find(self.nexts, number * symbols + symbol)
        n = np.where(at >= 0, self.times[at], 0.0) if len(self.times) else 0.0
        wide = TOWARDS_SUFFIX + self.rest[number]
        return (n + wide * suffix) / (self.size[number] + TOWARDS_SUFFIX)


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    if not len(sorted_codes):
        return np.full(len(codes), -1)
    at = np.searchsorted(sorted_codes, codes)
    at[at == len(sorted_codes)] = 0
    return np.where(sorted_codes[at] == codes, at, -1)


def _number(symbols: np.ndarray, place: np.ndarray, levels: list[Contexts], base: int):
    """For each length, the number of the context before each symbol, or -1."""
    out, suffix = [], np.zeros(len(symbols), np.int64)
    for depth, level in enumerate(levels, 1):
        number = np.full(len(symbols), -1)
        ok = np.flatnonzero((place >= depth) & (suffix >= 0))
        number[ok] = level.find(suffix[ok] * base + symbols[ok - depth])
        out.append(number)
        suffix = number
    return out


def _summed(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, times = np.concatenate(codes), np.concatenate(times)
    found, at = np.unique(codes, return_inverse=True)
    return found, np.bincount(at, times, len(found)).astype(np.int64)


@frugal
def _count_next(batches, levels: Broadcast, base: int):
    """(code, n) of context number and next symbol, contexts of the last length."""
    levels = levels.value
    codes, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in sliced(batches):
        symbols, place = _joined(batch.column("symbols"))
        number = _number(symbols, place, levels, base)[-1]
        ok = number >= 0
        found, n = np.unique(number[ok] * base + symbols[ok], return_counts=True)
        codes.append(found)
        times.append(n)
        if sum(map(len, codes)) > GATHERED:
            found, n = _summed(codes, times)
            codes, times = [found], [n]
            if len(found) > GATHERED // 2:
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["code", "n"])
                codes, times = [found[:0]], [n[:0]]
    found, n = _summed(codes, times)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["code", "n"])


class Tree:
    """Kept contexts with what follows them, over the symbols counted in ``root``."""

    def __init__(self, root: np.ndarray):
        self.base = len(root)
        self.root = (root + 1) / (root.sum() + self.base)
        self.levels: list[Contexts] = []

    def grow(self, symbols: DataFrame, least: float) -> None:
        """Adds the contexts of ``symbols``, one pass for each length."""
        context = symbols.sparkSession.sparkContext
        levels: list[Contexts] = []
        codes = np.arange(self.base - 1)
        while len(codes) and len(levels) < DEPTH:
            levels.append(Contexts(codes))
            sent = context.broadcast(levels)
            count = functools.partial(_count_next, levels=sent, base=self.base)
            table = symbols.select("symbols").mapInArrow(count, "code long, n long")
            table = staged(table.groupBy("code").agg(F.sum("n").alias("n")), "nexts")
            of = F.floor(F.col("code") / self.base).cast("long")
            # one number for each context, and its next symbols that were seen often enough
            sizes = table.groupBy(of.alias("number")).agg(F.sum("n").alias("n")).toArrow()
            nexts = table.where(F.col("n") >= max(LEAST_NEXT, least / NEXT_SHARE)).toArrow()
            sent.destroy()
            size = np.zeros(len(codes))
            size[sizes.column("number").to_numpy()] = sizes.column("n").to_numpy()
            found, times = (nexts.column(c).to_numpy() for c in ("code", "n"))
            levels[-1].follow(found, times, size, self.base)
            codes = self._longer(levels, least)
        self._keep(levels)

    def _append(self, levels, depth: int, number: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Numbers of the contexts of ``depth`` symbols that end in ``symbol`` after the
        contexts ``number`` of one symbol less; -1 where there is none."""
        if depth == 1:
            return levels[0].find(symbol)
        suffix, first = np.divmod(levels[depth - 2].codes[number], self.base)
        shorter = self._append(levels, depth - 1, suffix, symbol)
        found = levels[depth - 1].find(shorter * self.base + first)
        return np.where(shorter >= 0, found, -1)

    def _longer(self, levels, least: float) -> np.ndarray:
        """Codes of the contexts one longer that reach ``least``, by their counts as runs.

        The run x + s, s of the longest length counted, occurs as often as s without its
        last symbol, x before it, is followed by that symbol.
        """
        depth, last = len(levels), levels[-1]
        number, symbol = np.divmod(last.nexts[last.times >= least], self.base)
        number, symbol = number[symbol < self.base - 1], symbol[symbol < self.base - 1]
        suffix, first = np.divmod(last.codes[number], self.base)
        run = self._append(levels, depth, suffix, symbol)
        return np.unique(run[run >= 0] * self.base + first[run >= 0])

    def _before(self, levels, depth: int, number: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Probability of ``symbol`` after the contexts ``number`` of ``depth`` symbols."""
        if not depth:
            return self.root[symbol]
        level = levels[depth - 1]
        suffix = self._before(levels, depth - 1, level.codes[number] // self.base, symbol)
        return level.smoothed(number, symbol, suffix, self.base)

    def _keep(self, levels) -> None:
        kept = [np.zeros(len(level.codes), bool) for level in levels]
        for d in reversed(range(len(levels))):
            level = levels[d]
            number, symbol = np.divmod(level.nexts, self.base)
            own = level.times / level.size[number]
            parent = self._before(levels, d, level.codes[number] // self.base, symbol)
            far = np.zeros(len(level.codes))
            far += np.bincount(number, own * np.log(own / parent), len(far))
            # the symbols that are left out count as one, which can only make it less
            size = np.maximum(level.size, 1)
            other = 1 - np.bincount(number, parent, len(level.codes))
            rest = level.rest / size
            some = (rest > 0) & (other > 0)
            far[some] += rest[some] * np.log(rest[some] / other[some])
            # twice the log likelihood gain, against the mean of chance plus three deviations
            free = np.maximum(np.bincount(number, minlength=len(level.codes)), 1)
            kept[d] |= (far > LEAST_DIVERGENCE) & (2 * size * far > free + 3 * np.sqrt(2 * free))
            if d:
                kept[d - 1][level.codes[kept[d]] // self.base] = True
        # what is kept is numbered anew; suffixes of what is kept are kept
        renumber = np.zeros(1, np.int64)
        for level, own in zip(levels, kept):
            if not own.any():
                break
            suffix, first = np.divmod(level.codes[own], self.base)
            short = Contexts(renumber[suffix] * self.base + first)
            renumber = np.cumsum(own) - 1
            number, symbol = np.divmod(level.nexts, self.base)
            of = own[number]
            short.follow(
                renumber[number[of]] * self.base + symbol[of],
                level.times[of],
                level.size[own],
                self.base,
            )
            self.levels.append(short)

    def logs(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """log10 of each symbol's probability in the state of the longest kept suffix."""
        p = self.root[symbols]
        for number, level in zip(_number(symbols, place, self.levels, self.base), self.levels):
            here = np.flatnonzero(number >= 0)
            p[here] = level.smoothed(number[here], symbols[here], p[here], self.base)
        return np.log10(p)


def runs(levels: list[Contexts], base: int) -> list[tuple[int, ...]]:
    """The contexts of the longest length as runs of symbols, oldest first."""
    out: list[tuple[int, ...]] = [()]
    for level in levels:
        suffix, symbol = np.divmod(level.codes, base)
        out = [(int(x), *out[s]) for s, x in zip(suffix.tolist(), symbol.tolist())]
    return out


@frugal
def _score(batches, tree: Broadcast, class_size: np.ndarray):
    size = np.zeros(tree.value.base)
    size[-CLASSES - 1 : -1] = class_size
    for batch in batches:
        score = []
        column = batch.column("symbols")
        for lo in range(0, batch.num_rows, 64):
            part = column.slice(lo, 64)
            symbols, place = _joined(part)
            logs = tree.value.logs(symbols, place) - size[symbols]
            first = np.flatnonzero(place == 0)
            score.extend(np.add.reduceat(logs, first).tolist())
        names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "all_logs"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(x) for x in names],
                pa.array(np.array(score) + batch.column("class_logs").to_numpy()),
            ],
            [*names, "model_logs"],
        )


@frugal
def _rare(batches):
    for batch in batches:
        words = [np.frombuffer(x, np.int64) for x in batch.column("rare").to_pylist()]
        if words:
            rows = np.repeat(batch.column("row").to_numpy(), [len(x) for x in words])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.concatenate(words))], ["row", "word"]
            )


def symbols_of(rows: DataFrame, words: Words) -> DataFrame:
    """The staged symbols of ``rows`` (doc_id, text, held_out)."""
    sent = rows.sparkSession.sparkContext.broadcast(words)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    out = staged(rows.mapInArrow(functools.partial(_symbol_rows, words=sent), _SYMBOL_ROWS), "symbols")
    sent.destroy()
    return out


def score_documents(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score by row."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        text_of(docs),
        (remainder(docs["doc_id"], folds) == held).alias("held_out"),
    )
    rare_words, words = count_words(rows.where("not held_out").select("text"))
    symbols = symbols_of(rows, words)
    tree = Tree(words.root)
    tree.grow(symbols.where("not held_out").select("symbols"), words.least)
    scored = symbols.mapInArrow(
        functools.partial(
            _score, tree=context.broadcast(tree), class_size=words.class_size
        ),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long,"
        " all_logs double, model_logs double",
    )
    looked_up = (
        symbols.where(F.octet_length("rare") > 0)
        .select("row", "rare")
        .mapInArrow(_rare, "row long, word long")
        .join(rare_words, "word")
        .groupBy("row")
        .agg(
            F.sum(F.log10(F.col("n") + 1.0)).alias("rare_logs"), F.count("*").alias("rare_known")
        )
    )
    logs = F.coalesce("rare_logs", F.lit(0.0))
    spread = math.log10(words.tokens + words.distinct + 1)
    return scored.join(looked_up, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("all_logs") + logs - F.col("n_tokens") * F.lit(spread)).alias("base_score"),
        (F.col("model_logs") + logs).alias("score"),
    )
