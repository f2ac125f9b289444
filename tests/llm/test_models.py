import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martworks.llm import language_id, quality, suffix_tree_lm, toxicity
from tests.conftest import SF_MID
from tests.llm.conftest import EDGE_ROWS
from tests.llm.reference import words


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF_MID}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_MID}/labels.parquet")


@pytest.fixture(scope="module")
def truth(labels):
    return {r["doc_id"]: r for r in labels.collect()}


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def base_scores(texts):
    """texts: list of (id, text). (held out, tokens, known, N, base score) of each."""
    tokens = [[*words(t), None] for _, t in texts]
    held = [fold(i, 7) == 2 for i, _ in texts]
    c = Counter(w for ts, h in zip(tokens, held) for w in ts if not h)
    n, v = sum(c.values()), len(c)
    return [
        (h, len(ts), sum(c[w] > 0 for w in ts), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts))
        for ts, h in zip(tokens, held)
    ]


def check_base(rows, texts):
    want = sorted(((i, *b) for (i, _), b in zip(texts, base_scores(texts))), key=str)
    got = sorted(
        (
            (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])
            for r in rows
        ),
        key=str,
    )
    for a, b in zip(sorted(got, key=lambda x: (str(x[:5]), x[5])), sorted(want, key=lambda x: (str(x[:5]), x[5]))):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
    assert len(got) == len(want)


@pytest.mark.parametrize("known", [1 << 20, 300])
def test_lm_scores(table, known, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "KNOWN", known)
    rows = suffix_tree_lm.score_documents(table).collect()
    check_base(rows, [(r["doc_id"], r["text"]) for r in table.collect()])
    for held in (False, True):
        part = [r for r in rows if r["held_out"] == held]
        assert sum(r["score"] for r in part) > sum(r["base_score"] for r in part)


def test_lm_edge_rows(edge_docs, no_docs):
    rows = suffix_tree_lm.score_documents(edge_docs).collect()
    check_base(rows, [(r[0], r[1]) for r in EDGE_ROWS])
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert suffix_tree_lm.score_documents(no_docs).count() == 0


def _grown(spark, seqs, symbols, least, monkeypatch, least_next=1):
    monkeypatch.setattr(suffix_tree_lm, "LEAST_NEXT", least_next)
    monkeypatch.setattr(suffix_tree_lm, "NEXT_SHARE", 1e9)
    frame = spark.createDataFrame([(np.array(s, np.int32).tobytes(),) for s in seqs], "symbols binary")
    root = np.zeros(symbols)
    for s in seqs:
        np.add.at(root, s, 1)
    tree = suffix_tree_lm.Tree(root)
    tree.grow(frame, least)
    return tree, root


def _sequences():
    draw = np.random.default_rng(0)
    seqs = []
    for _ in range(200):
        s = [0]
        while len(s) < 30:
            s.append((s[-1] * 2 + (s[-2] if len(s) > 1 else 0) + int(draw.random() < 0.2)) % 7)
        seqs.append([*s, 7])
    return seqs


@pytest.mark.parametrize("least_next", [1, 40])
def test_tree_against_counting_by_hand(spark, monkeypatch, least_next):
    """The contexts, their counts and the smoothed distributions of a small corpus."""
    import functools

    seqs = _sequences()
    total = sum(map(len, seqs))
    tree, root = _grown(spark, seqs, 8, 0.01 * total, monkeypatch, least_next)
    held = Counter(tuple(s[i - d : i]) for s in seqs for d in (1, 2, 3) for i in range(d, len(s)))
    after = Counter((tuple(s[i - d : i]), s[i]) for s in seqs for d in (0, 1, 2, 3) for i in range(d, len(s)))
    wide = suffix_tree_lm.TOWARDS_SUFFIX

    @functools.cache
    def smooth(context, symbol):
        if not context:
            return (root[symbol] + 1) / (root.sum() + 8)
        n = sum(after[context, x] for x in range(8))
        seen = sum(c for x in range(8) if (c := after[context, x]) >= least_next)
        own = after[context, symbol] if after[context, symbol] >= least_next else 0
        return (own + (wide + n - seen) * smooth(context[1:], symbol)) / (n + wide)

    kept = set()
    for d in range(1, len(tree.levels) + 1):
        names = suffix_tree_lm.runs(tree.levels[:d], tree.base)
        kept.update(names)
        level = tree.levels[d - 1]
        for i, context in enumerate(names):
            assert level.size[i] == sum(after[context, x] for x in range(8))
            assert d == 1 or held[context] >= 0.01 * total
            assert sum(smooth(context, x) for x in range(8)) == pytest.approx(1)
    assert len(kept) > 10
    assert all(context[1:] in kept for context in kept if len(context) > 1)
    # the state of each symbol is the longest kept suffix
    for seq in seqs[:20]:
        logs = tree.logs(np.array(seq), np.arange(len(seq)))
        for i, symbol in enumerate(seq):
            context = next((c for d in (3, 2, 1) if i >= d and (c := tuple(seq[i - d : i])) in kept), ())
            assert logs[i] == pytest.approx(math.log10(smooth(context, symbol)), abs=1e-9)


def test_contexts_that_diverge_are_kept(spark, monkeypatch):
    """What follows a symbol depends on the one before it only where the corpus says so."""
    draw = np.random.default_rng(1)
    seqs = []
    for _ in range(300):
        s = []
        while len(s) < 40:
            x = int(draw.integers(0, 3))
            # 3 is followed by 4 after 0 and by 5 after 1; 2 by anything
            s += [x, 3, 4 if x == 0 else 5] if x < 2 else [2, int(draw.integers(0, 6))]
        seqs.append([*s, 6])
    tree, _ = _grown(spark, seqs, 7, 20, monkeypatch)
    pairs = set(suffix_tree_lm.runs(tree.levels[:2], tree.base))
    assert {(0, 3), (1, 3)} <= pairs


def test_scores_end_to_end(spark, make_docs, monkeypatch):
    """Words, classes, unseen words and contexts of whole texts, against plain counting."""
    monkeypatch.setattr(suffix_tree_lm, "LEAST_ALPHABET", 4)
    draw = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = np.array([1 / (i + 1) for i in range(60)])
    texts = [" ".join(draw.choice(vocabulary, 50, p=weights / weights.sum())) for _ in range(80)]
    rows = suffix_tree_lm.score_documents(make_docs([*texts, "never seen w1 w2", ""])).collect()
    train = [words(t) for i, t in enumerate(texts) if fold(i, 7) != 2]
    train += [words(t) for i, t in ((80, "never seen w1 w2"), (81, "")) if fold(i, 7) != 2]
    count = Counter(w for ws in train for w in ws)
    total = sum(count.values()) + len(train)
    least = suffix_tree_lm.least_count(total)
    frequent = [w for w, n in count.items() if n >= least]
    assert len(frequent) > 4
    # with contexts switched off a text's score is that of its words and classes alone
    monkeypatch.setattr(suffix_tree_lm, "DEPTH", 0)
    flat = {r["doc_id"]: r for r in suffix_tree_lm.score_documents(make_docs([*texts, "never seen w1 w2", ""])).collect()}
    last = lambda w: (w.encode()[-1] * 31 + (w.encode()[-2] if len(w.encode()) > 1 else 0) * 17) % suffix_tree_lm.CLASSES
    of_class = Counter()
    kinds = Counter()
    for w, n in count.items():
        if w not in frequent:
            of_class[last(w)] += n
            kinds[last(w)] += 1
    symbols = len(frequent) + suffix_tree_lm.CLASSES + 1
    root = total + symbols

    def flat_score(text):
        out = math.log10((len(train) + 1) / root)
        for w in words(text):
            if w in frequent:
                out += math.log10((count[w] + 1) / root)
            else:
                c = last(w)
                out += math.log10((of_class[c] + 1) / root * (count[w] + 1) / (of_class[c] + kinds[c] + 1))
        return out

    for i, text in enumerate([*texts, "never seen w1 w2", ""]):
        assert flat[i]["score"] == pytest.approx(flat_score(text), rel=1e-9)
    assert sum(r["score"] for r in rows if not r["held_out"]) > sum(
        flat[r["doc_id"]]["score"] for r in rows if not r["held_out"]
    )


def test_the_tree_grows_with_the_corpus(spark):
    """More text, more symbols and contexts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sizes = []
    small = docs.where("doc_id < 1000").select("text")
    for rows in (small, docs.where("doc_id % 7 <> 2").select("text")):
        rare, known = suffix_tree_lm.count_words(rows)
        symbols = suffix_tree_lm.symbols_of(
            rows.withColumns({"doc_id": F.lit(1).cast("long"), "held_out": F.lit(False)}), known
        )
        tree = suffix_tree_lm.Tree(known.root)
        tree.grow(symbols.select("symbols"), known.least)
        sizes.append((known.alphabet, sum(len(level.codes) for level in tree.levels)))
    assert sizes[1][1] > 1.5 * sizes[0][1] and sizes[1][0] >= sizes[0][0]


def accuracy(rows, truth, field, predicted, keep=lambda t: True):
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth and keep(truth[r["doc_id"]])]
    assert held
    return np.mean([truth[r["doc_id"]][field] == r[predicted] for r in held])


def test_toxicity_held_out(table, labels, truth):
    rows = toxicity.score_documents(table, labels).collect()
    assert len(rows) == table.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)


def test_toxicity_recall_and_precision(spark):
    """All held-out labelled rows. Labels of texts of quality 0 are partly noise, so the others
    are looked at by themselves as well; always 0 has a recall of 0."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.score_documents(docs, marks).where("held_out").join(marks, "doc_id")
    rows = [(r["quality"], r["toxic"], r["predicted"]) for r in rows.collect()]
    for kept, recall, precision in ((rows, 0.75, 0.8), ([r for r in rows if r[0] == 1], 0.85, 0.9)):
        told = [r for r in kept if r[2] == 1]
        toxic = [r for r in kept if r[1] == 1]
        right = sum(r[1] == 1 for r in told)
        assert len(toxic) > 80
        assert right / len(toxic) > recall and right / len(told) > precision


def test_toxicity_tolerates_gaps_and_inserted_characters():
    calm = [f"the house number {i} stands near the river. it was a long day." for i in range(60)]
    rude = [f"you are a stupid idiot {i}. the river is long." for i in range(60)]
    model = toxicity.Model.fit([(t, 0) for t in calm] + [(t, 1) for t in rude], 0.5)
    known = toxicity.Memory(model._words)
    said = ["you id.i-ot now", "he is s t u p i d today", "what an idxiot he is", "stuupid thing", "1d1ot"]
    assert (model.score(said, known) > 0.5).all()
    assert (model.score(["the river near the house", "", "it was long"], known) < 0.5).all()


def test_toxicity_learns_from_late_sentences():
    late = "the house by the river was calm. " * 40
    calm = [f"{late} the day {i} was long." for i in range(60)]
    rude = [f"{late} you are a stupid idiot {i}." for i in range(60)]
    model = toxicity.Model.fit([(t, 0) for t in calm] + [(t, 1) for t in rude], 0.5)
    known = toxicity.Memory(model._words)
    assert model.kernel is not None
    assert (model.score([f"{late} what an idiot he is.", late], known) > 0.5).tolist() == [True, False]


def test_toxicity_learns_from_long_texts(spark, make_docs):
    calm = "the house by the river was calm. "
    docs = make_docs([calm * 20 if i % 2 else calm * 450 + "what an idiot he is." for i in range(80)])
    marks = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)], "doc_id long, toxic int")
    assert len(calm) * 450 > 12_000
    rows = toxicity.score_documents(docs, marks).collect()
    assert all(r["predicted"] == 1 - r["doc_id"] % 2 for r in rows)


def test_toxicity_kernel_is_the_sum_over_subsequences():
    from itertools import combinations

    def phi(w):
        out = Counter()
        for a, b, c in combinations(range(len(w)), 3):
            if c - a < toxicity.SPAN:
                out[w[a] + w[b] + w[c]] += toxicity.DECAY ** (c - a + 1)
        return out

    def norm(n):
        return math.sqrt(
            sum(
                toxicity.DECAY ** (2 * (c - a + 1))
                for a, _, c in combinations(range(n), 3)
                if c - a < toxicity.SPAN
            )
        )

    marks = ["idiot", "worthless", "scum"]
    some = ["idiots", "iodiot", "worth", "less", "scummy", "abc"]
    got = toxicity.Kernel(marks).values(some)
    for i, w in enumerate(some):
        for j, m in enumerate(marks):
            a, b = phi(w), phi(m)
            k = sum(a[x] * b[x] for x in a) / norm(len(w)) / norm(len(m))
            assert got[i, j] == pytest.approx(min(k, 1) ** 3, abs=1e-5)


def test_quality_held_out(table, labels, truth):
    rows = quality.score_documents(table, labels).collect()
    assert len(rows) == table.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert accuracy(rows, truth, "quality", "predicted") > 0.95


def test_quality_votes_against_all_pairs():
    draw = np.random.default_rng(1)
    letters = ["abcdef ", "uvwxyz "]
    texts = ["".join(draw.choice(list(letters[i % 2]), 200)) for i in range(120)]
    model = quality.Model(texts, [i % 2 for i in range(120)])
    new = ["".join(draw.choice(list(letters[i % 2]), 150)) for i in range(30)] + [""]
    got = model.score(new)
    at = model._latent(quality.features(new))
    for v, score in zip(at, got):
        cosine = [float(v @ w) for w in model.vectors]
        last = sorted(cosine)[-quality.NEIGHBOURS]
        weight = [max(c, 1e-6) ** 4 if c >= last - 1e-7 else 0 for c in cosine]
        want = sum(w * y for w, y in zip(weight, model.labels)) / sum(weight)
        assert score == pytest.approx(want, abs=1e-3)


def test_language_held_out(table):
    lang = {r["doc_id"]: r for r in table.select("doc_id", "lang").collect()}
    rows = language_id.identify(table).collect()
    assert accuracy(rows, lang, "lang", "lang_pred") > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_letters_over_all_of_unicode(make_docs):
    import unicodedata

    for c in map(chr, range(0x110000)):
        assert language_id.has_letter(c) == unicodedata.category(c).startswith("L")
    docs = make_docs(["² ½ ①", "ⅷ ² 3", "ein Wort", "", None], "de")
    rows = language_id.identify(docs).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in rows) == [
        (0, "und"), (1, "und"), (2, "de"), (3, "und"), (4, "und"),
    ]


def test_language_against_counting_by_hand(spark):
    texts = [("aab ab", "x"), ("bbc b", "y"), ("cab", "x")]
    model = language_id.fit(spark.createDataFrame(texts, "text string, lang string"), bits=16)
    assert model.langs == ["x", "y"]
    n = sum(max(0, len(t) - k + 1) for t, lang in texts if lang == "x" for k in language_id.ORDERS)
    # all n-grams of both languages fall into different buckets here
    total = n + language_id.SMOOTHING * (1 << 16)
    grams = Counter(t[i : i + k] for t, g in texts if g == "x" for k in language_id.ORDERS for i in range(len(t) - k + 1))
    want = math.log(2 / 3) + sum(
        math.log((grams[g] + language_id.SMOOTHING) / total)
        for k in language_id.ORDERS
        for i in range(len("ab") - k + 1)
        for g in ["ab"[i : i + k]]
    )
    from martworks.llm.ngrams import code_points, hashed, row_sums

    codes, offsets = code_points(["ab"])
    got = model.log_prior[0] + sum(
        row_sums(model.log_p[b], f)[0, 0] for b, f in hashed(codes, offsets, language_id.ORDERS, 16)
    )
    assert got == pytest.approx(want, abs=1e-3)


def test_language_edge_rows(edge_docs, no_docs):
    rows = language_id.identify(edge_docs).collect()
    assert len(rows) == len(EDGE_ROWS)
    for r in rows:
        if r["doc_id"] in (4, 5, 6, 11):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert language_id.identify(no_docs).count() == 0


@pytest.mark.parametrize("module,field", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_edge_rows(spark, edge_docs, no_docs, module, field):
    other = "quality" if field == "toxic" else "toxic"
    schema = f"doc_id long, {field} int, {other} int, text string, score double"
    some = [(1, 0, 0, "x", 0.0), (1, 1, 0, "x", 0.0), (2, 1, 0, None, None), (3, 0, 0, "", 1.0),
            (None, 1, 1, None, None), (4, None, 0, "", 0.0), (9, 1, 1, "", 0.0), (99, 1, 1, "", 0.0)]
    for rows in (some, some[2:3], []):
        marks = spark.createDataFrame(rows, schema)
        got = module.score_documents(edge_docs, marks).collect()
        assert len(got) == len(EDGE_ROWS)
        assert all(0 <= r["score"] <= 1 for r in got)
        assert module.score_documents(no_docs, marks).count() == 0
    if module is toxicity:
        clean = toxicity.clean_documents(edge_docs, spark.createDataFrame(some, schema))
        assert clean.columns == edge_docs.columns
