"""Ranked search against a plain scorer, small trees and blocks, odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """Per item (by place): the ranked (doc_id, score)."""
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for _, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 25 + 25 * sum(b.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in plain_terms(text) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out.append([(i, -s) for s, _, _, i in sorted(scores)[:k]])
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60) | st.text(alphabet="aZ09 _-.\n\x85  éÉİ中\x7f\x80", max_size=40))
def test_terms_are_those_of_the_pattern(text):
    assert [t.decode() for t in S.terms(text.encode())] == plain_terms(text)


def corpus(rnd, n):
    words = [a + b for a in "ka lo mi né pu ra".split() for b in "bar del fon".split()] + ["The", "of", "É"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rnd.choices(words, weights, k=rnd.randrange(1, 40))) for _ in range(n)]
    texts += [texts[0]] * 30  # copies
    docs = list(enumerate(texts)) + [(9000, None), (9001, ""), (9002, " .-\n"), (9003, "ka" * 50_000 + " kabar"), (9004, "kabar " * 20_000), (None, texts[1])]
    rnd.shuffle(docs)
    return docs, words


def ranked(out):
    found = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        found.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
    return found


@pytest.mark.parametrize("leaf,cells", [(64, S.CELLS), (2, 100), (1, 2000)])
def test_against_brute_force(spark, make_docs, monkeypatch, leaf, cells):
    rnd = random.Random(leaf)
    docs, words = corpus(rnd, 300)
    items = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 12)))) for i in range(12)] + [(50, "nowhere"), (51, None), (52, ""), (53, "Ka_BAR kabar")]
    want = {i: w for (i, _), w in zip(items, brute(docs, items)) if w}
    if leaf < 64:  # the tree itself, with small buckets and chunks
        block = S.Block.of([(i, (t or "").encode()) for i, t in items])
        bags = [(i, Counter(S.terms((t or "").encode()))) for i, t in docs]
        bags = [(i, b) for i, b in bags if b]
        df = np.zeros(len(block.numbers), np.int64)
        for _, b in bags:
            df[[block.numbers[t] for t in b if t in block.numbers]] += 1
        rows = [(i, sum(b.values()), {block.numbers[t]: c for t, c in b.items() if t in block.numbers}) for i, b in bags]
        rows = [(i, n, v) for i, n, v in rows if v]
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([np.asarray(list(r[2]), np.uint32).tobytes() for r in rows]), pa.array([np.asarray(list(r[2].values()), np.uint32).tobytes() for r in rows])],
            names=["doc_id", "n", "terms", "tfs"])
        monkeypatch.setattr(S, "LEAF", leaf)
        got = {}
        for b in S._search(iter([batch]), block.items, df, len(bags), sum(r for _, r, _ in [(i, sum(b.values()), 0) for i, b in bags]), 20, cells):
            for r in b.to_pylist():
                got.setdefault(block.ids[r["item"]], []).append((r["doc_id"], r["score"]))
        assert got == want
        return
    frame = make_docs(docs, "item_id string, rank int, score long").repartition(4)
    asked = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    out = S.ranked_search(frame, asked, block_bytes=40)  # several blocks
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and ranked(out.collect()) == want
    for rows in ranked(S.ranked_search(frame, asked, k=3).collect()).items():
        assert rows[1] == want[rows[0]][:3]


def test_bounds_hold_and_prune():
    """Every node's bound is at least the best score below it."""
    rnd = np.random.default_rng(3)
    ranks = [np.sort(rnd.choice(12, rnd.integers(1, 9), replace=False)) for _ in range(400)]
    tfs = [rnd.integers(1, 6, len(r)) for r in ranks]
    tree = S.Tree(ranks, tfs, rnd.integers(75, 200, 400), 12)
    assert sorted(np.concatenate([r for r in tree.rows if r is not None]).tolist()) == list(range(400))

    def best_below(node, cols, w):
        if tree.children[node] is None:
            best = int((tree.part[tree.rows[node][:, None], cols] @ w).max())
        else:
            best = max(best_below(c, cols, w) for c in tree.children[node])
        assert tree.best[node, cols] @ w >= best
        return best

    best_below(0, np.asarray([1, 4, 11]), np.asarray([500, 900, 2000]))


def test_odd_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "kabar"), (1, "kabar"), (None, "lodel")], "item_id long, text string")
    none = items.limit(0)
    docs = make_docs([(5, "kabar lodel x"), (5, "kabar lodel x"), (6, "z"), (7, "y"), (8, "q")])
    assert S.ranked_search(docs, none).count() == 0 and S.ranked_search(make_docs({}), items).count() == 0
    out = sorted(((r.item_id, r["rank"], r.doc_id) for r in S.ranked_search(docs, items).collect()), key=str)
    assert out == [(1, 1, 5), (1, 1, 5), (1, 2, 5), (1, 2, 5), (None, 1, 5), (None, 2, 5)]
