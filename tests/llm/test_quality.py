"""Word vectors against plain counting, the network, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import quality as Q

KINDS = {"the": Q.PLAIN, "The": Q.CAPITAL, "THE": Q.UPPER, "A": Q.CAPITAL, "42": Q.DIGITS, "!!": Q.SYMBOLS, "\n": Q.SYMBOLS, "iPad": Q.MIXED, "x2": Q.PLAIN, "É": Q.CAPITAL, "ÉTÉ": Q.UPPER, "中文": Q.PLAIN}


@pytest.mark.parametrize("token", KINDS)
def test_kinds(token):
    assert Q.kind_of(token.encode()) == KINDS[token]


def plain_contexts(texts):
    """Neighbour by neighbour."""
    codes = Q.index_codes()
    index = np.zeros((Q.ROWS, Q.DIM), np.int64)
    for r in range(Q.ROWS):
        for c in codes[r]:
            index[r, c % Q.DIM] += 1 if c < Q.DIM else -1
    sums, n = np.zeros((Q.ROWS, Q.DIM), np.int64), np.zeros(Q.ROWS, np.int64)

    def meet(a, b):
        for x, y in ((a, b), (b, a)):
            sums[x] += index[y]
            n[x] += 1

    for t in texts:
        rows, marks = Q.Places().read(t)
        for i in range(len(rows)):
            for j in range(i + 1, min(len(rows), i + 1 + Q.WINDOW)):
                meet(rows[i], rows[j])
            if marks[i]:
                meet(marks[i], rows[i])
            if marks[i] != Q.SYMBOLS and rows[i] in rows[max(0, i - 2) : i]:
                meet(Q.REPEAT, rows[i])
    return np.hstack([sums, n[:, None]])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="aAbB 1!\né", max_size=40), min_size=1, max_size=6), st.sampled_from([3, 1 << 19]))
def test_contexts_are_plain_counts(texts, chunk):
    texts = [t.encode() for t in texts]
    old, Q.CHUNK = Q.CHUNK, chunk
    try:
        sums = Q.Contexts()
        sums.add(*Q._joined(texts, Q.Places()))
    finally:
        Q.CHUNK = old
    assert np.array_equal(sums.rows(), plain_contexts(texts))


def test_tasks_add_up(spark, make_docs):
    texts = {i: f"Word{i % 7} and the {i % 3} OTHER word word, here\n" * 3 for i in range(40)} | {90: None, 91: ""}
    one, many = (Q.word_vectors(make_docs(texts, "g int, sums string").repartition(n)) for n in (1, 7))
    assert np.array_equal(one, many)
    assert one.shape == (Q.ROWS, 2 * Q.DIM) and np.isfinite(one).all() and np.linalg.norm(one[:, : Q.DIM], axis=1).max() <= 1.0001


def test_pooling_is_the_mean():
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((Q.ROWS, 2 * Q.DIM)).astype(np.float32)
    text = b"The cat cat sat, on 42 MATS"
    rows, marks = Q.Places().read(text)
    want = vectors[rows].sum(axis=0) + sum(vectors[m] for m in marks if m) + vectors[Q.REPEAT]
    assert np.allclose(Q.pool(text, vectors, Q.Places()), want / len(rows), atol=1e-5)
    long = text * 40_000  # read in pieces
    rows, marks = Q.Places().read(long)
    assert np.allclose(Q.pool(long, vectors, Q.Places()), Q.pool(text * 400, vectors, Q.Places()), atol=1e-2)
    assert not Q.pool(None, vectors, Q.Places()).any() and not Q.pool(b" \t", vectors, Q.Places()).any()


def test_temperature():
    rng = np.random.default_rng(2)
    true = rng.standard_normal(20_000) * 2
    y = (rng.random(20_000) < 1 / (1 + np.exp(-true))).astype(float)
    assert abs(Q.best_temperature(true * 3, y) - 3) < 0.2
    loss = [Q.log_loss(true * 3 / t, y) for t in (Q.best_temperature(true * 3, y), 1.0, 8.0)]
    assert loss[0] == min(loss)


def planted(rnd, n):
    words = [a + b for a in "ka lo mi ne pu ra so te".split() for b in "bar del fon gis hul".split()]
    rows, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randrange(10, 60))
        good = rnd.random() < 0.7
        if not good:
            text = [w + rnd.choice(["***", "%%%", "&&&"]) for w in text] if rnd.random() < 0.5 else [w.upper() for w in text]
        rows.append((i, " ".join(text)))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark, make_docs):
    rows, labels = planted(random.Random(4), 700)
    rows += [(None, rows[0][1]), (5000, None), (5001, ""), (5002, rows[0][1]), (5002, rows[0][1]), (5003, "lo" * 60_000)]
    docs = make_docs(rows, "score string, quality int, held_out int").repartition(3)
    asked = spark.createDataFrame([(i, y, "x") for i, y in labels] + [(None, 1, "x"), (1, None, "x"), (2, labels[2][1], "x")], "doc_id long, quality int, text string")
    out = Q.score(docs, Q.fit(docs, asked)).collect()
    assert out[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"} and len(out) == len(rows)
    truth = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    by = {r.doc_id: r.score for r in out}
    assert len({r.score for r in out if r.doc_id in (None, 5002, 0)}) == 1 and by[5000] == by[5001]
    assert not any(r.held_out for r in out if r.doc_id is None)


def test_without_labels(spark, make_docs):
    docs = make_docs({1: "a b", 2: None})
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.score(docs, Q.fit(docs, none)).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    many = make_docs({i: "a b" for i in range(9)})
    assert {r.score for r in Q.score(docs, Q.fit(many, ones)).collect()} == {1.0}
    assert Q.score(make_docs({}), Q.fit(make_docs({}), none)).count() == 0
