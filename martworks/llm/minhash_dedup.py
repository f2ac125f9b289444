"""MinHash near-duplicates: bottom-k sketches from one hash function.

A document is the set of its distinct ``width``-word shingles, each one 64-bit hash. Equal
sets form a class at once (two 64-bit sums over the set). The sketch of a class is the
``k`` smallest hashes of its set.

Two sets with Jaccard ``t`` or more leave at most a share of 1 - t of each other unshared,
and less if their sizes are near. Retained values are ordered by the number of classes that
retain them, rarest first. The first value that two classes share has only unshared ones
before it, so its place in either order is within the number they may leave unshared (five
standard deviations more where a sketch holds only part of a set). Inverted lists hold the
classes that have a value within that place. Most documents of a corpus have too many
values of their own to be in any list; strongly edited members of a large group of copies
spend their places on the values of their edits, and so does a document that shares only a
passage with others.

Within a list the members are compared with the one that has the fewest rarer values;
members that are then in one component need no further comparison. Classes in a list that
still holds several components are listed once more by their full sets, without any spread,
and compared with more and more members of the list until each pair of it is either compared
or in one component, so no link between components is lost and no list is cut. Pairs by
sketches pass a test on sizes, then the union-sketch estimate (five standard errors below
``t``); all links are confirmed by the exact Jaccard of the full sets.

Defined cases: null or wordless text has no shingle, links with nothing and is its own
component; fewer words than ``width`` make one shingle of the whole sequence; repeated rows
are in one class; a null doc_id is carried, and is the component's id only if no other id
is in it; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import functools
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.llm.common import chunks, frugal, sliced, staged, text_of, utf8_batch
from martworks.llm.components import components
from martworks.llm.words import mix, word_hashes

K = 192
SPREAD = 5
HUBS_IN_LIST = 4096
BROADCAST_ROOTS = 200_000
WHOLE = 1 << 40

_SALT = np.uint64(0xD6E8FEB86659FD93)
_ODD = np.uint64(0xA0761D6478BD642F)


def _combine(parts: list[np.ndarray]) -> np.ndarray:
    """A hash of a sequence of hashes that depends on their order."""
    h = np.full(len(parts[0]), np.uint64(len(parts)), np.uint64)
    for part in parts:
        h = mix((h ^ part) * _ODD + _SALT)
    return h


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    h, first, *_ = word_hashes(data, offsets)
    whole = len(h) - width + 1
    rolled = _combine([h[i : i + whole] for i in range(width)]) if whole > 0 else h[:0]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            out.append(_combine([h[i : i + 1] for i in range(a, b)]))
        else:
            out.append(h[:0])
    return out


def _set_sums(values: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the whole set, as signed numbers."""
    one = mix(values ^ _SALT).sum(dtype=np.uint64)
    two = mix(values + _ODD).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


@frugal
def _featurize(batches, width: int, k: int | None):
    """(doc_id, h1, h2, n, kept values) of each row; all values where ``k`` is None."""
    for batch in batches:
        data, offsets = utf8_batch(batch.column("text"))
        ids = batch.column("doc_id")
        for lo, hi in chunks(offsets):
            sets = shingle_sets(
                data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], width
            )
            sums = [_set_sums(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(lo, hi - lo),
                    pa.array([s[0] for s in sums], pa.int64()),
                    pa.array([s[1] for s in sums], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[:k].tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "h1", "h2", "n", "vals"],
            )


_FEATURES = "doc_id long, h1 long, h2 long, n long, vals binary"


def features(docs: DataFrame, width: int, k: int | None) -> DataFrame:
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs))
    return rows.mapInArrow(functools.partial(_featurize, width=width, k=k), _FEATURES)


def _fits(n, place, n2, num: int, den: int, k: int):
    """A shared value at ``place`` of a set of ``n`` may be the first one that it shares
    with a set of ``n2`` values."""
    m, m2 = F.least(n, F.lit(k)), F.least(n2, F.lit(k))
    need = F.lit(num / (num + den)) * (n + n2)
    # the other sketch may reach less far among the hashes
    reach = F.least(F.lit(1.0), (m2 / n2) / (m / n))
    a = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - need / n * reach))
    part = F.when(reach < 1, F.lit(1.0)).otherwise((n - m) / F.greatest(n - 1, F.lit(1)))
    return place <= m * a + SPREAD * F.sqrt(m * a * (1 - a) * part) + 1e-6


def _may_link(num: int, den: int, k: int):
    """Condition on a pair: na, nb are its sizes, pa, pb the places of a shared value."""
    na, nb, pa_, pb = (F.col(c) for c in ("na", "nb", "pa", "pb"))
    sized = den * F.least(na, nb) >= num * F.greatest(na, nb)
    return sized & _fits(na, pa_, nb, num, den, k) & _fits(nb, pb, na, num, den, k)


def _with_partners(members: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """``members`` of lists without those whose place fits no size that their list holds.

    What a place allows is widest for the smallest or the largest partner.
    """
    n = F.col("n")
    ends = members.groupBy("key").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    low = F.greatest(F.col("lo"), F.ceil(n * num / den))
    high = F.least(F.col("hi"), F.floor(n * den / num))
    kept = members.join(ends, "key").where(
        _fits(n, F.col("place"), low, num, den, k) | _fits(n, F.col("place"), high, num, den, k)
    )
    return kept.drop("lo", "hi")


@frugal
def _retained(batches):
    """(value, node, n) of each value of a sketch."""
    for batch in sliced(batches, 1024):
        kept = [np.frombuffer(v, np.int64) for v in batch.column("vals").to_pylist()]
        if kept:
            times = [len(v) for v in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(kept)),
                    *[pa.array(np.repeat(batch.column(c).to_numpy(), times)) for c in ("node", "n")],
                ],
                ["value", "node", "n"],
            )


def postings(classes: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """(key, node, n, place): the values that a class may first share with another one."""
    retained = classes.select("node", "n", "vals").mapInArrow(
        _retained, "value long, node long, n long"
    )
    held = retained.groupBy("value").agg(F.count("*").alias("times"), F.min("node").alias("node"))
    only = F.when(F.col("times") == 1, F.col("node")).alias("only")
    held = staged(held.select("value", "times", only), "values")
    own = held.where("times = 1").groupBy(F.col("only").alias("node"))
    own = own.agg(F.count("*").alias("own"))
    m, a = F.least("n", F.lit(k)), 1 - num / den
    spread = F.when(F.col("n") * den <= k * num, F.lit(0.0)).otherwise(
        SPREAD * F.sqrt(m * a * (1 - a))
    )
    most = m * a + spread + 1e-6
    some = classes.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    some = some.where(F.col("own") <= most).select("node", "n", "vals", "own")
    shared = (
        some.mapInArrow(_retained, "value long, node long, n long")
        .join(held.where("times > 1").select("value", "times"), "value")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("times", "value"))).alias("values"))
    )
    placed = some.drop("vals").join(shared, "node")
    placed = placed.select(
        "node", "n", "own", most.alias("most"), F.posexplode("values").alias("at", "v")
    )
    place = F.col("own") + F.col("at")
    return placed.where(place <= F.col("most")).select(
        F.col("v.value").alias("key"), "node", "n", place.alias("place")
    )


@frugal
def _estimated(batches, num: int, den: int, k: int):
    """Pairs that pass the union-sketch estimate; ``sure`` where it is the exact value."""
    t = num / den
    for batch in sliced(batches):
        col = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        a, b, sure = [], [], []
        for i in range(batch.num_rows):
            one = np.frombuffer(col["va"][i], np.uint64)
            two = np.frombuffer(col["vb"][i], np.uint64)
            both = np.intersect1d(one, two, assume_unique=True)
            whole = col["na"][i] <= k and col["nb"][i] <= k
            if whole:
                union = len(one) + len(two) - len(both)
                passes = den * len(both) >= num * union
            else:
                # the k smallest of the union are all in the two sketches
                union = np.union1d(one, two)[:k]
                shared = np.searchsorted(both, union[-1], side="right")
                spread = 5 * math.sqrt(t * (1 - t) / len(union))
                passes = shared / len(union) >= t - spread
            if passes:
                a.append(col["a"][i])
                b.append(col["b"][i])
                sure.append(whole)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure, pa.bool_())],
            ["a", "b", "sure"],
        )


@frugal
def _confirmed(batches, num: int, den: int):
    for batch in sliced(batches):
        col = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        a, b = [], []
        for i in range(batch.num_rows):
            one = np.frombuffer(col["va"][i], np.uint64)
            two = np.frombuffer(col["vb"][i], np.uint64)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            if den * shared >= num * (len(one) + len(two) - shared):
                a.append(col["a"][i])
                b.append(col["b"][i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )


def _with_values(pairs: DataFrame, values: DataFrame, num: int, den: int) -> DataFrame:
    one = values.select(
        F.col("node").alias("a"), F.col("n").alias("na"), F.col("vals").alias("va")
    )
    two = values.select(
        F.col("node").alias("b"), F.col("n").alias("nb"), F.col("vals").alias("vb")
    )
    sized = pairs.join(one, "a").join(two, "b")
    return sized.where(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))


class _Links:
    """Pairs of classes in, confirmed links out."""

    def __init__(self, docs, classes, width, num, den, k):
        self.docs, self.classes, self.width = docs, classes, width
        self.num, self.den, self.k = num, den, k

    def confirm(self, pairs: DataFrame) -> DataFrame:
        num, den, k = self.num, self.den, self.k
        passed = staged(
            _with_values(pairs, self.classes, num, den).mapInArrow(
                functools.partial(_estimated, num=num, den=den, k=k),
                "a long, b long, sure boolean",
            ),
            "estimated",
        )
        sure, rest = passed.where("sure").select("a", "b"), passed.where("not sure")
        if rest.isEmpty():
            return sure
        rest = rest.select("a", "b")
        nodes = rest.select(F.col("a").alias("node")).union(rest.select("b")).distinct()
        return sure.union(self.exact(rest, self.full_sets(nodes)))

    def full_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, n, vals) with all values of the classes in ``nodes`` (node)."""
        ids = nodes.join(self.classes, "node").select("rep").distinct()
        wanted = self.docs.join(ids, self.docs["doc_id"].eqNullSafe(ids["rep"]), "left_semi")
        full = features(wanted, self.width, None)
        full = full.select(F.col("h1").alias("node"), "n", "vals").join(
            nodes, "node", "left_semi"
        )
        # one row for each class, should an id or text be repeated
        return staged(full.dropDuplicates(["node"]), "sets")

    def exact(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the threshold."""
        return _with_values(pairs, sets, self.num, self.den).mapInArrow(
            functools.partial(_confirmed, num=self.num, den=self.den), "a long, b long"
        )


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (node, root) after more ``links`` (a, b), by links of whole components."""
    one = comps.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    two = comps.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    ends = links.join(one, "a", "left").join(two, "b", "left")
    merged = components(
        ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    ).select(F.col("node").alias("root"), F.col("root").alias("over"))
    every = comps.union(merged.select(F.col("root").alias("node"), "root")).distinct()
    return staged(
        every.join(merged, "root", "left").select("node", F.coalesce("over", "root").alias("root")),
        "components",
    )


def _by_root(rows: DataFrame, of_root: DataFrame) -> DataFrame:
    """``rows`` with what is known of their component, one row for each root.

    A component may hold most rows. Few components are broadcast, so that it is not gathered in
    one task; where there are many, a join by root can be split by adaptive execution.
    """
    of_root = staged(of_root, "roots")
    if of_root.limit(BROADCAST_ROOTS + 1).count() <= BROADCAST_ROOTS:
        of_root = F.broadcast(of_root)
    return rows.join(of_root, "root")


def _open(members: DataFrame, comps: DataFrame, sizes: tuple[int, int, int]) -> DataFrame:
    """Members (key, node, n, place, root, m, main) of lists over several components.

    ``m`` is the length of the list, ``main`` its component with most members in lists.
    """
    rooted = members.join(comps, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    rooted = _by_root(rooted, rooted.groupBy("root").agg(F.count("*").alias("of_root")))
    lists = rooted.groupBy("key").agg(
        F.min("root").alias("least"),
        F.max("root").alias("most"),
        F.max(F.struct("of_root", "root")).alias("main"),
        F.count("*").alias("m"),
    )
    lists = lists.where("least <> most").select("key", "m", F.col("main.root").alias("main"))
    rooted = _with_partners(rooted.drop("of_root").join(lists, "key"), *sizes)
    return staged(rooted, "open")


def _by_hubs(links: _Links, lists: DataFrame) -> DataFrame:
    """(node, root) by the links of each list's members with its hub."""
    hubs = lists.groupBy("key").agg(
        F.min(F.struct("place", "node", "n")).alias("hub"), F.count("*").alias("m")
    )
    stars = (
        lists.join(hubs.where("m > 1"), "key")
        .where("node <> hub.node")
        .select(
            F.col("hub.node").alias("a"),
            F.col("hub.n").alias("na"),
            F.col("hub.place").alias("pa"),
            F.col("node").alias("b"),
            F.col("n").alias("nb"),
            F.col("place").alias("pb"),
        )
        .where(_may_link(links.num, links.den, links.k))
        .select("a", "b")
        .distinct()
    )
    return staged(components(links.confirm(stars)), "components")


def class_components(links: _Links, lists: DataFrame) -> DataFrame:
    """(node, root) of the classes that have a link; see the module's text."""
    num, den = links.num, links.den
    comps = _by_hubs(links, lists)
    left = _open(lists, comps, (num, den, links.k))
    if left.isEmpty():
        return comps
    # what sketches leave open is listed anew by full sets, where a place has no spread
    sets = links.full_sets(left.select("node").distinct())
    members = staged(postings(sets, num, den, WHOLE), "postings")
    possible = _may_link(num, den, WHOLE)
    step = 0
    while True:
        step += 1
        left = _open(members, comps, (num, den, WHOLE))
        if left.isEmpty():
            return comps
        # of a short list all, of a long one a growing share, meet the rest of it; the main
        # component's members need not, as each pair over components has one of the others
        share = F.greatest(F.lit(HUBS_IN_LIST) / F.col("m"), F.lit(0.0625 * 2**step))
        draw = F.pmod(F.xxhash64("node", "key", F.lit(step)), F.lit(1 << 20)) / (1 << 20)
        hub = (draw < share) & (F.col("root") != F.col("main"))
        hubs = left.where(hub).select(
            "key",
            F.col("node").alias("a"),
            F.col("root").alias("ra"),
            F.col("n").alias("na"),
            F.col("place").alias("pa"),
        )
        pairs = (
            left.withColumnsRenamed({"node": "b", "n": "nb", "place": "pb"})
            .join(hubs, "key")
            .where((F.col("root") != F.col("ra")) & possible)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        found = staged(links.exact(pairs, sets), "links")
        if not found.isEmpty():
            comps = _joined(comps, found)
        # hubs have met their whole list
        members = left.where(~hub).select("key", "node", "n", "place")


def _classified(docs: DataFrame, width: int, num: int, den: int, k: int):
    """(doc_id, h1, h2, n) of each row, and (h1, h2, root, component_id) of its class."""
    feats = staged(features(docs, width, 0).drop("vals"), "features")
    sketches = features(docs, width, k).where("n > 0")
    classes = (
        sketches.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("vals").alias("vals"))
        .withColumnRenamed("h1", "node")
    )
    classes = staged(classes, "classes")
    lists = staged(postings(classes, num, den, k), "postings")
    found = class_components(_Links(docs, classes, width, num, den, k), lists)
    grouped = classes.select("node", "h2", "rep").join(found, "node", "left")
    grouped = staged(grouped.withColumn("root", F.coalesce("root", "node")), "grouped")
    named = _by_root(grouped, grouped.groupBy("root").agg(F.min("rep").alias("component_id")))
    return feats, named.select(F.col("node").alias("h1"), "h2", "root", "component_id")


def minhash_components(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, k: int = K
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Documents are linked where ``den`` * intersection >= ``num`` * union of their sets.
    """
    feats, named = _classified(docs, width, num, den, k)
    rows = feats.where("n > 0").join(named, ["h1", "h2"]).select("doc_id", "n", "component_id")
    alone = feats.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return rows.union(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@frugal
def _with_class(batches, width: int, names: list[str]):
    """Rows with the two sums of their set in the columns ``names``."""
    for batch in batches:
        sums = []
        text = batch.column(names[0])
        data, offsets = utf8_batch(text)
        for lo, hi in chunks(offsets):
            part = data[offsets[lo] : offsets[hi]]
            sets = shingle_sets(part, offsets[lo : hi + 1] - offsets[lo], width)
            sums.extend((*_set_sums(s), len(s)) for s in sets)
        table = batch.drop_columns([names[0]])
        for i, name in enumerate(names[1:]):
            table = table.append_column(name, pa.array([s[i] for s in sums], pa.int64()))
        yield table


def _classed(docs: DataFrame, width: int, names: list[str]) -> DataFrame:
    """``docs`` with the sums of its sets and their size in the columns ``names``."""
    text = f"{names[0]}_text"
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in names]])
    work = functools.partial(_with_class, width=width, names=[text, *names])
    return docs.withColumn(text, text_of(docs)).mapInArrow(work, schema)


def keep_one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100):
    """The rows of ``docs`` that stay: one of each group of near copies.

    Of each component the row with the smallest id stays, a null id last; where an id is
    repeated, its rows are told apart by their sets, so that one row stays for each component,
    whatever ids its rows have. Rows without a shingle all stay.
    """
    feats, named = _classified(docs, width, num, den, K)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2"))
    kept = feats.where("n > 0").join(named, ["h1", "h2"]).groupBy("root").agg(first.alias("one"))
    kept = kept.select("one.doc_id", "one.h1", "one.h2")
    bare = feats.where("n = 0").select("doc_id", "h1", "h2").distinct()
    repeated = feats.groupBy("doc_id").agg(F.count("*").alias("rows"))
    repeated = repeated.where("rows > 1 or doc_id is null")
    kept = kept.union(bare).join(
        repeated.select(F.col("doc_id").alias("id"), F.lit(True).alias("several")),
        F.expr("doc_id <=> id"),
        "left",
    )
    tag = f"c{uuid.uuid4().hex[:8]}"
    h1, h2, size = (f"{tag}_{c}" for c in ("h1", "h2", "n"))
    kept = staged(
        kept.select(
            F.col("doc_id").alias(f"{tag}_id"), F.col("h1").alias(h1), F.col("h2").alias(h2),
            F.coalesce("several", F.lit(False)).alias(f"{tag}_several"),
        ),
        "kept",
    )
    same = docs["doc_id"].eqNullSafe(kept[f"{tag}_id"])
    once = docs.join(kept.where(~F.col(f"{tag}_several")), same, "left_semi")
    several = kept.where(f"{tag}_several")
    if several.isEmpty():
        return once
    more = _classed(docs.join(several, same, "left_semi"), width, [h1, h2, size])
    on = [more["doc_id"].eqNullSafe(several[f"{tag}_id"]), *[more[c] == several[c] for c in (h1, h2)]]
    more = more.join(several, on, "left_semi")
    one = more.where(F.col(size) > 0).dropDuplicates(["doc_id", h1, h2])
    more = one.unionAll(more.where(F.col(size) == 0)).select(*docs.columns)
    return once.unionAll(more)
