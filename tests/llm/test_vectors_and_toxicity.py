"""Toxicity, whitening and hard negatives: held-out accuracy, brute force, odd cases."""
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripforge.llm import negatives as N
from tripforge.llm import toxicity as X
from tripforge.llm import whitening as W

VECTORS = "vec_id long, embedding array<double>, label int, key string, x int"


# -- toxicity ----------------------------------------------------------------------

def test_folding():
    assert X.folded_words("You IDIOT") == ["you", "idiot"]
    assert X.folded_words("1d10t іԁіот ｉｄｉｏｔ id​iot |diot") == ["idiot"] * 5
    assert X.folded_words("$tup1d!! 100 2024 l0ser") == ["stupid", "ioser"]
    assert X.folded_words("") == [] and X.folded_words(" \t") == []


def test_terms_phrases_and_places():
    lex = X.Lexicon({" idiot ": 3.0, " vequ": 2.0, " vequé ": 5.0}, {" gentie idiot "}, 1.0, 0.0)
    m = lex.matcher()

    def total(text):
        words = X.folded_words(text)
        return sum(X.hits(m, words)[1].values())
    assert total("an idiot and idiots") == 3.0            # whole words only
    assert total("vequa vequé lvequ") == 7.0              # beginnings, the heaviest term of a place
    assert total("the gentle idiot idiot") == 3.0         # only the one inside the phrase is spared
    assert total("") == 0.0 and X.Lexicon({}).matcher() is None


@pytest.fixture(scope="module")
def labelled(spark):
    """400 texts, a quarter toxic by one of three words (written in several
    ways), clean ones with 'silly goose', and 60 copies of one toxic text."""
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdefghijkmnoprstuvw"), 6)) for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        w, toxic = list(rng.choice(vocab, 60)), i % 4 == 0
        if toxic:
            for bad in rng.choice(["silly", "dolt", "d0lt", "SILLY", "zounder", "zounding"], 3):
                w.insert(int(rng.integers(len(w))), bad)
        elif i % 12 == 1:
            w[10:10] = ["silly", "goose"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs += [(1000 + i, "copies " + " ".join(f"own{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)) + " dolt dolt") for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_learnt_lexicon(labelled):
    docs, labels = labelled
    lex = X.learn(docs, labels)
    assert {" dolt ".replace("l", "i"), " zound"} <= {t if t.endswith(" ") else t[:6] for t in lex.terms}
    assert any(" siiiy goose " == e for e in lex.exceptions)
    assert not any(t.startswith(" own") for t in lex.terms)          # a group of copies is one witness
    rows = X.score(docs, lex).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(held) > 60 and sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_are_never_read(labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(X.in_fold(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.learn(docs, turned) == X.learn(docs, labels)


def test_toxicity_odd_cases(spark, odd, no_documents, labelled):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, 7), (5, None)], "doc_id long, toxic int")
    rows = X.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.75}    # one id, toxic: (1 + .5) / (1 + 1)
    assert all(r.held_out for r in rows if r.doc_id is None)
    none = X.toxicity(odd, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert X.toxicity(no_documents, labels).count() == 0
    lex = X.learn(*labelled)
    by = {r.doc_id: r for r in X.score(odd, lex).collect()}
    assert by[2].score == by[3].score == by[4].score < 0.5 and by[5].n_words == by[6].n_words


# -- whitening ---------------------------------------------------------------------

def brute_whiten(vectors, k=16):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    o = np.argsort(-e)[:k]
    return n, ((n * x - s) ** 2).sum(1), ((n * x - s) / n) @ u[:, o] / np.sqrt(e[o]), e[o] / e.sum()


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 20)) @ np.diag(np.linspace(3, 0.5, 20))
    v[100:160] = v[7]                                                # a hot vector counts once
    df = spark.createDataFrame([(i, [float(a) for a in r], i % 3, "k", 1) for i, r in enumerate(v)], VECTORS).repartition(5)
    n, deviation, white, explained = brute_whiten(v)
    rows = W.whiten(df).collect()
    assert len(rows) == 300 * 16 and {r.n for r in rows} == {n} == {240}
    got = np.zeros((300, 16))
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id] and abs(r.explained - explained[r.component - 1]) < 1e-12
    sign = np.sign((got * white).sum(0))
    assert np.abs(got - white * sign).max() < 1e-9
    assert {r.identity_error for r in rows}.pop() < 1e-10


def test_whitening_odd_cases(spark):
    rows = [(1, [1.0, 2.0], 0, "k", 1), (1, [1.0, 2.0], 0, None, 1), (2, [3.0, 2.0], None, "k", None), (None, [0.0, 2.0], 0, "k", 1),
            (3, None, 0, "k", 1), (4, [1.0, None], 0, "k", 1), (5, [float("nan"), 1.0], 0, "k", 1), (6, [float("inf"), 1.0], 0, "k", 1),
            (7, [1.0], 0, "k", 1), (8, [], 0, "k", 1), (9, [1e300, 1.0], 0, "k", 1)]
    df = spark.createDataFrame(rows, VECTORS)
    out = W.whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2)]
    assert all(r.whitened is None for r in out if r.component == 2)   # the second dimension never varies
    assert all(r.n == 3 and r.whitened is not None and r.explained == 1.0 for r in out if r.component == 1)
    one = W.whiten(df.filter("vec_id = 2")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 2
    assert W.whiten(df.limit(0)).count() == 0


def test_whitening_beyond_long(spark):
    """Whole numbers near the end of a long: exact sums, and null where the deviation does not fit."""
    v = [[2.0 ** 54, 0.0], [-(2.0 ** 54), 0.0], [0.0, 1.0]]
    out = W.whiten(spark.createDataFrame([(i, r, 0, "k", 1) for i, r in enumerate(v)], VECTORS)).collect()
    assert {r.vec_id: r.deviation for r in out} == {0: None, 1: None, 2: 128 ** 2} and {r.n for r in out} == {3}
    small = [[2.0 ** 29 / 64, 0.0], [-(2.0 ** 29) / 64, 0.0], [0.0, 1.0]]
    out = W.whiten(spark.createDataFrame([(i, r, 0, "k", 1) for i, r in enumerate(small)], VECTORS)).collect()
    assert {r.vec_id: r.deviation for r in out} == dict(enumerate(int(x) for x in brute_whiten(small, 2)[1]))


# -- hard negatives ----------------------------------------------------------------

def brute_mine(rows, every=50):
    rows = [(i, v, l) for i, v, l, *_ in rows if i is not None and v is not None and l is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    d = max((len(v) for _, v, _ in rows), default=0)
    q = [[int(np.floor(256 * x)) for x in v] + [0] * (d - len(v)) for _, v, _ in rows]
    label = [(l + 1) % 10 if i % 7 == 0 else l for i, _, l in rows]
    out = []
    for a, (aid, *_) in enumerate(rows):
        if aid % every:
            continue
        by = sorted((-sum(x * y for x, y in zip(q[a], q[b])), rows[b][0], b) for b in range(len(rows)) if b != a)
        for s, pid, b in [t for t in by if label[t[2]] == label[a]][:5]:
            fits = [(n, nid) for n, nid, c in by if label[c] != label[a] and 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(aid, pid, r + 1, nid, -s, -n) for r, (n, nid) in enumerate(fits)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in N.mine(df, **options).collect())


def test_mining_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    v = rng.normal(size=(900, 24)) * np.linspace(2, 0.05, 24) + 0.3      # energy in few dimensions: much is omitted
    v[300:600:2] = v[50]                                                # a sixth of the rows is one vector, in all labels
    rows = [(int(i), [float(x) for x in r], int(i % 4), "k", 1) for i, r in enumerate(v)]
    rows += rows[100:103] + [(2000, rows[0][1], 9, "k", 1)]             # repeated rows, a rare label
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = brute_mine(rows)
    assert mined(df) == want and len(want) > 200


def test_mining_odd_cases(spark):
    rows = [(50, [1.0, 2.0], 1, "k", 1), (50, [1.0, 2.0], 1, "k", 1), (51, [1.0, 1.0], 1, None, None), (52, [0.5, 1.1], 2, "k", 1), (53, [0.6], 2, "k", 1),
            (None, [1.0, 2.0], 1, "k", 1), (100, None, 1, "k", 1), (150, [1.0, None], 1, "k", 1), (200, [float("nan"), 1.0], 1, "k", 1),
            (250, [float("inf"), 1.0], 1, "k", 1), (300, [1.0, 2.0], None, "k", 1), (400, [1e200, 1.0], 1, "k", 1), (450, [], 3, "k", 1),
            (500, [-1.0, -2.0], 1, "k", 1)]
    df = spark.createDataFrame(rows, VECTORS)
    want = brute_mine([r for r in rows if r[0] != 400])               # too long for scores in a long
    assert mined(df) == want and len(want) > 3
    assert mined(df.limit(0)) == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 30), st.floats(0.0, 1.2))
def test_index_loses_no_pair(seed, d, share):
    """Every pair at its anchor's threshold has its exact score, whatever is omitted."""
    rng = np.random.default_rng(seed)
    decay = rng.permutation(np.geomspace(1, 0.01, d))
    y = np.floor(rng.normal(size=(70, d)) * 500 * decay).astype(np.int64)
    a = np.floor(rng.normal(size=(9, d)) * 500 * decay).astype(np.int64)
    exact = a @ y.T
    low = np.floor(share * np.abs(exact).max(1)).astype(float)
    longest = float(np.sqrt((a.astype(float) ** 2).sum(1)).max()) * (1 + 1e-9)
    got, at = N.BlockIndex(y, longest, float(low.min())).scores(a, low)
    full = np.full(exact.shape, np.iinfo(np.int64).min)
    full[:, at] = got
    due = exact >= low[:, None]
    assert (full[due] == exact[due]).all()
    assert ((full == exact) | (full < low[:, None])).all()


def test_long_vectors_multiply_in_whole_numbers():
    y = np.array([[2 ** 30, 1], [2 ** 30 - 1, 3]], np.int64)
    got, at = N.BlockIndex(y, 2.0 ** 31, -np.inf).scores(y, np.full(2, -np.inf))
    assert (got == (y @ y.T)[:, at]).all()
