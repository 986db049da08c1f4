"""Words without an output of their own have their own probabilities."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterflow.llm import lm_score as LM


@pytest.fixture()
def corpus():
    rnd = random.Random(3)
    texts = {i: " ".join(f"w{rnd.randrange(900)}" for _ in range(400)) for i in range(60)}
    rare = [f"rare{k}" for k in range(400)]
    for k, w in enumerate(rare):
        for j in range(1 + k % 5):
            texts[(k + j) % 60] += " " + w
    return texts


def counted(texts):
    n = {}
    for t in texts.values():
        for w in t.split():
            n[w.encode()] = n.get(w.encode(), 0) + 1
    return n


def test_a_bucket_is_shared_by_the_counts_of_its_words(make_docs, corpus):
    n = counted(corpus)
    docs = make_docs(corpus)
    words, weights = LM.train(docs, rounds=1)
    assert len(words) == LM.OUT - LM.BUCKETS < len(n)
    bucket = {}
    for w in n.keys() - set(words):
        bucket.setdefault(zlib.crc32(w) % LM.BUCKETS, []).append(w)
    share = {w: math.log(n[w] / (sum(n[v] for v in b) + len(b))) for b in bucket.values() for w in b}
    out = {r.doc_id: r for r in LM.score(docs, words, weights).collect()}
    assert len(out) == len(corpus)
    for i in (0, 7, 59):
        flat, at = LM.padded([LM.WordIds(words).ids(corpus[i])])
        whole = float(LM.log_probs(weights, flat, at).sum()) + sum(share.get(w.encode(), 0) for w in corpus[i].split())
        assert out[i].log_prob == pytest.approx(whole, rel=1e-4)
        assert out[i].mean_log_prob == pytest.approx(whole / out[i].n_words, rel=1e-4)


def test_gibberish_scores_below_a_rare_word_of_its_bucket(make_docs, corpus):
    words, weights = LM.train(make_docs(corpus), rounds=1)
    n = counted(corpus)
    known = min(n.keys() - set(words), key=lambda w: (n[w], w))
    like = (b"qx%d" % k for k in range(10_000))
    made = next(g for g in like if zlib.crc32(g) % LM.BUCKETS == zlib.crc32(known) % LM.BUCKETS)
    some = " ".join(w.decode() for w in words[:20])
    asked = make_docs([(1, f"{some} {known.decode()}"), (2, f"{some} {made.decode()}"), (None, some), (None, some)])
    out = LM.score(asked, words, weights).collect()
    got = {r.doc_id: r.log_prob for r in out}
    assert len(out) == 4 and got[2] < got[1] - 1


def test_every_word_is_a_target():
    assert LM.STRIDE == 1


def test_words_are_cut_at_ascii_white_space_only():
    texts = [None, "", " A  b\t\n", "\x0bx\x0cy ", "É é\x1ca b", "a"]
    words, codes, n = LM.cut(pa.array(texts, pa.string()))
    plain = [(t or "").encode().lower().split() for t in texts]
    assert [words[c] for c in codes] == [w for ws in plain for w in ws]
    assert n.tolist() == [len(ws) for ws in plain]
    assert [len(x) for x in LM.cut(pa.array([None], pa.string()))[1:]] == [0, 1]


def test_a_rare_word_of_many_documents_is_one_row(spark, make_docs):
    docs = make_docs({i: f"odd odd w{i % 3}" for i in range(30)}).coalesce(1).select(F.col("doc_id").alias("id"), "text")
    kind = "key long, id long, n_words long, log_prob double, word binary, docs array<int>"
    rows = docs.mapInArrow(lambda it: LM._scores(it, [b"w0"], LM.first_weights()), kind).collect()
    assert sum(r.docs is None for r in rows) == 30
    assert {bytes(r.word): len(r.docs) for r in rows if r.docs is not None} == {b"odd": 60, b"w1": 10, b"w2": 10}


def test_a_step_follows_the_slope():
    rng = np.random.default_rng(5)
    flat, at = LM.padded([rng.integers(0, LM.OUT, 700).astype(np.int32) % m for m in (LM.OUT, 40)])
    w0 = LM.first_weights()
    w, seen = w0.copy(), np.zeros(LM.SIZE, np.float32)
    LM.train_step(w, seen, flat, at)
    grad = np.sqrt(seen)
    for k in np.argsort(grad)[-5:]:  # the slope of the mean log-probability, by a small change
        more, less = w0.copy(), w0.copy()
        more[k] += 0.01
        less[k] -= 0.01
        slope = (LM.log_probs(more, flat, at).mean(dtype=float) - LM.log_probs(less, flat, at).mean(dtype=float)) / 0.02
        assert abs(slope) == pytest.approx(grad[k], rel=0.05)
        assert np.sign(w[k] - w0[k]) == np.sign(slope)
