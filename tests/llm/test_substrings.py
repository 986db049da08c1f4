"""Chains in groups, and alignments against plain ones."""

import random

import numpy as np
import pytest

from meterflow.llm import substrings as S


def test_groups_hold_every_chain_once_and_leave_no_gap():
    rnd = random.Random(5)
    c = np.asarray([(x, x + rnd.randrange(40), y, y + rnd.randrange(40)) for x, y in ((rnd.randrange(3000), rnd.randrange(3000)) for _ in range(60))])
    groups = S.overlapping(c, 50)
    assert sorted(map(tuple, np.concatenate(groups))) == sorted(map(tuple, c))
    for g in groups:
        for first, last in ((0, 1), (2, 3)):
            side = g[np.argsort(g[:, first])]
            reach = np.maximum.accumulate(side[:, last]) + S.K + 100
            assert (side[1:, first] <= reach[:-1]).all()


def test_far_chains_are_apart_and_near_ones_together():
    groups = S.overlapping(np.asarray([(0, 5, 0, 5), (90, 95, 80, 85), (0, 5, 5000, 5005), (4000, 4001, 0, 1)]), 50)
    assert sorted(len(g) for g in groups) == [1, 1, 2]


@pytest.mark.parametrize("seed", range(20))
def test_alignment_of_equal_windows_is_that_of_each(seed):
    rnd = random.Random(seed)
    line = [b"w%d" % rnd.randrange(50) for _ in range(30)]
    a = line * 12  # a text that repeats itself
    b = [w if rnd.random() > 0.05 else b"x" for w in line * 2]
    found = np.asarray([(30 * k, 30 * k, 0, 0) for k in range(12)])
    alone = [next(S.align(a, b, found[k : k + 1], 50)) for k in range(12)]
    assert list(S.align(a, b, found, 50)) == alone


def test_extension_crosses_differences():
    a = [b"%d" % i for i in range(100)]
    b = a[:40] + [b"x", b"y"] + a[43:70] + a[72:]  # three words by two, then two left out
    assert S.extend(a, b, 0, 0) == (100, 97, 95)
    assert S.extend(a, a, 0, 0) == (100, 100, 100)
    assert S.extend(a, [], 0, 0) == (0, 0, 0)
    assert S.extend(a, [b"%d" % -i for i in range(1, 90)], 0, 0) == (0, 0, 0)


def exact_runs(texts, n):
    """Plain: {(doc, place)} of the runs of ``n`` words that an earlier document holds."""
    seen, out = {}, set()
    for i in sorted(texts):
        words = texts[i].split()
        for p in range(len(words) - n + 1):
            run = tuple(words[p : p + n])
            if seen.setdefault(run, i) != i:
                out.add((i, p))
    return out


def reported_runs(rows, n):
    return {(r.doc_id, p) for r in rows for p in range(r.start, r.end - n + 1)}


def test_passage_whose_parts_have_other_first_holders(make_docs):
    rnd = random.Random(11)
    line = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    s1, s2, s3, s4 = (line(15) for _ in range(4))
    put = lambda p, n=40: " ".join(line(n) + p + line(n))
    texts = {1: put(s1 + s2), 2: put(s2 + s3), 3: put(s3 + s4), 7: put(s1 + s2 + s3 + s4), 8: put(s1 + s2 + s3 + s4, 55), 9: put([])}
    # the holder has the pieces earlier in its own text
    t1, t2, t3 = (line(20) for _ in range(3))
    texts |= {11: " ".join(t1 + t2 + line(30) + t2 + t3 + line(30) + t1 + t2 + t3), 12: put(t1 + t2 + t3)}
    rows = S.repeated_passages(make_docs(texts)).collect()
    wanted = exact_runs(texts, 50)
    assert {d for d, _ in wanted} == {8, 12}
    assert reported_runs(rows, 50) == wanted
    assert {(r.doc_id, r.of_doc) for r in rows} == {(8, 7), (12, 11)}


def test_no_exact_run_is_lost_among_frequent_lines(make_docs):
    rnd = random.Random(3)
    lines = [[f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(8, 30))] for _ in range(12)]
    texts = {i: " ".join(w for _ in range(8) for w in (rnd.choice(lines) if rnd.random() < 0.9 else [f"x{rnd.randrange(10**6)}"])) for i in range(60)}
    rows = S.repeated_passages(make_docs(texts)).collect()
    assert exact_runs(texts, 50) <= reported_runs(rows, 50)
    assert exact_runs(texts, 50)


def test_occurrences_of_a_seed_are_told_once_across_batches():
    import pyarrow as pa

    rows = [(1, 5, 0), (2, 3, 1), (2, 3, 9), (2, 4, 2), (3, 1, 0), (4, 2, 7), (4, 6, 8)]
    want = [(3, 3, 1, 1), (3, 3, 9, 1), (4, 3, 2, 1), (2, 2, 7, 7), (6, 2, 8, 7)]
    for size in (1, 2, 3, 7):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[k : k + size]], pa.int64() if i < 2 else pa.int32()) for i in range(3)], names=["seed", "doc", "pos"]) for k in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in S._matches(iter(batches)) for r in b.to_pylist()]
        assert got == want
