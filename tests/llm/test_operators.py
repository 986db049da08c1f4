"""The numbered operators against brute force and on odd rows: nulls, empty
and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterflow.llm import decontaminate as D
from meterflow.llm import jaccard_join as J
from meterflow.llm import licenses as LI
from meterflow.llm import line_dedup as L
from meterflow.llm import lm_score as LM
from meterflow.llm import packing as P
from meterflow.llm import substrings as SU
from meterflow.llm import token_files as T
from meterflow.llm import topk as K
from meterflow.llm import toxicity as X
from meterflow.llm.tokens import PieceEncoder, tokenizer_path

WORDS = [a + b for a in "ka lo mi ne pu ra so te vu zi".split() for b in "bar del fon gis hul jem".split()]


def prose(rnd, n, words=WORDS):
    return " ".join(rnd.choice(words) for _ in range(n))


def test_line_dedup(make_docs):
    long, short = "x" * 39 + "É", "y" * 39
    texts = {i: f"{long}\n{i} only here " + "z" * 40 + f"\n{short}" for i in range(1, 7)}
    texts[3] = f"  {long.replace('x', 'X')}\t\n\nkept"
    texts |= {8: None, 9: "", 10: "a" * 100_000}
    out = {r.doc_id: r for r in L.dedup_lines(make_docs(texts, "n_lines string, id string")).collect()}
    assert out[6].n_dropped == 0 and out[6].text == texts[6]  # the largest id holding it
    assert out[3].text == "\nkept" and out[3].n_dropped == 1 and out[3].n_lines == 3
    assert short in out[1].text and long not in out[1].text
    assert (out[8].text, out[8].n_lines) == ("", 1) and out[9].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert out[10].text == texts[10]
    twice = L.dedup_lines(make_docs([(7, long)] * 5 + [(None, long)])).collect()
    assert [r.text for r in twice if r.doc_id == 7] == [long] * 5  # all hold the largest id
    assert [r.n_dropped for r in twice if r.doc_id is None] == [1]
    assert L.dedup_lines(make_docs({})).count() == 0


def test_licenses(spark, make_docs):
    gpl, mit = LI.TEMPLATES["GPL-3.0"] + ".", LI.TEMPLATES["MIT"]
    rows = [("a/LICENSE", gpl), ("a/b/c/x.txt", "nothing " * 50), ("a/b/LICENSE.md", f"words before. {mit}. words after"), ("z/y.txt", None), ("a/y.txt", "free text\n" * 20 + mit), ("q.txt", ""), (None, mit), ("a/LICENSE", gpl)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "path string, text string, license string, nr int")
    got = sorted((r.path or "", r.own_license, r.inherited_license, r.inherited_from, r.license) for r in LI.scan_licenses(df).collect())
    assert got == sorted([
        ("a/LICENSE", "GPL-3.0", None, None, "GPL-3.0"), ("a/LICENSE", "GPL-3.0", None, None, "GPL-3.0"), ("a/b/c/x.txt", None, "MIT", "a/b", "MIT"),
        ("a/b/LICENSE.md", "MIT", None, None, "MIT"), ("z/y.txt", None, None, None, None), ("a/y.txt", "MIT", None, None, "MIT"),
        ("q.txt", None, None, None, None), ("", "MIT", None, None, "MIT"),
    ], key=lambda r: tuple(map(str, r))) or {r[0]: r[4] for r in got} == {"a/LICENSE": "GPL-3.0", "a/b/c/x.txt": "MIT", "a/b/LICENSE.md": "MIT", "z/y.txt": None, "a/y.txt": "MIT", "q.txt": None, "": "MIT"}
    assert LI.scan_licenses(df.limit(0)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**17 - 1), max_size=300), st.sampled_from([8, 16, 17, 18, 32]))
def test_bit_packing_round_trip(ids, bits):
    ids = np.asarray(ids, "<u4") % (1 << bits if bits < 32 else 1 << 31)
    data = T.pack_bits(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8) and np.array_equal(T.unpack_bits(data, bits, len(ids)), ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_as_the_whole_text(name):
    enc = PieceEncoder(tokenizer_path(name), 50)
    texts = ["", " ", "A Mixed CASE text.", "<|ENDOFTEXT|> A", "a  b   c ", "Don't stop.\n\nNext\tline\r\n", "ÉTÉ déjà vu x", "<|endoftext|> as text", "x\x1cy !", "数字 12,345.6", "end\n", " lead", "é ñ", "w" * 5000, "a \nb\n c"]
    assert enc.encode(texts) == enc._direct(texts) == enc.encode(texts)


def test_token_files(make_docs, tmp_path):
    rnd = random.Random(1)
    texts = [(i, prose(rnd, rnd.randrange(80))) for i in range(60)] + [(None, "null id"), (77, None), (78, ""), (5, "again"), (90, prose(rnd, 60_000))]
    manifest = T.write_token_files(make_docs(texts), file_tokens=4000)
    rows = sorted(T.read_token_index(manifest).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == len(texts)
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:k]) for k in range(len(rows))]
    enc = PieceEncoder(tokenizer_path("byte_bpe_50k.json"), 1000)
    want = Counter((i, zlib.crc32(enc._direct([t or ""])[0] + b"\x02\0\0\0")) for i, t in texts)
    assert Counter((r.doc_id, r.ids_crc32) for r in rows) == want
    path = manifest.orderBy(F.desc("n_tokens")).first().path
    f = T.TokenFile(path)
    every = np.concatenate(list(f.tokens(0, f.n_tokens)))
    assert np.array_equal(np.concatenate(list(f.tokens(777, 70_001))), every[777:70_001])
    assert T.read_token_index(T.write_token_files(make_docs({}))).count() == 0


def test_top_k(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, []), (204, [1.0] * 3), (None, [1.0] * 4), (300, rows[0][1]), (300, rows[0][1]), (301, rows[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in K.top_k(df, F.col("vec_id") % 50 == 0, block=16, bins=8).collect()}
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q in {i for i, _ in ok if i % 50 == 0}:
        mine = next(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ok if i != q and len(v) == len(mine))[:5]
        assert [got[q, k + 1] for k in range(len(best))] == [(i, -s) for s, i in best]
    assert K.top_k(df.limit(0), F.lit(True)).count() == 0


def test_top_k_of_large_components(spark):
    rnd = random.Random(12)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(8)]) for i in range(60)]
    rows += [(70, [2.0**24] * 8), (71, [-(2.0**22)] + [1.0] * 7), (100, [2.0**20, 1.0] + [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in K.top_k(df, F.col("vec_id") % 10 == 0, block=16).collect()}
    for q in (i for i in ints if i % 10 == 0):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:5]
        assert all(-(2**63) < s < 2**63 for s, _ in best)
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in best]
    with pytest.raises(Exception, match="score of 5 and 6 does not fit a long"):
        K.top_k(spark.createDataFrame([(5, [2.0**25] * 8), (6, [2.0**25] * 8)], "vec_id long, embedding array<double>"), F.col("vec_id") == 5).collect()


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=20))
def test_myers_against_dynamic_programming(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    assert D.myers(D.masks(item), len(item), text)[0] == min(row)


def test_decontamination(spark, make_docs):
    rnd = random.Random(3)
    item = prose(rnd, 40)
    near = item.replace("ka", "kaa", 2)[:-1] + "q"
    other = " ".join(item.split()[::-1])
    texts = {1: prose(rnd, 900) + " " + item.upper(), 2: f"{prose(rnd, 30)}\n{near} {prose(rnd, 30)}", 3: other, 4: None, 5: "", 6: " ".join(item.split()[:20])}
    bench = spark.createDataFrame([(1, item), (2, item), (3, "short"), (4, None), (5, "")], "item_id long, text string")
    docs = make_docs(texts, "item_id string, edits string")
    got = {(r.doc_id, r.item_id): r.edits for r in D.find_leaks(docs, bench, max_edit=0.08).collect()}
    assert {k: v == 0 for k, v in got.items()} == {(1, 1): True, (1, 2): True, (2, 1): False, (2, 2): False}
    assert sorted(r.doc_id for r in D.drop_leaks(docs, bench, max_edit=0.08, block_chars=100).collect()) == [3, 4, 5, 6]
    assert D.drop_leaks(docs, bench.limit(0)).count() == 6 and D.find_leaks(docs.limit(0), bench).count() == 0


def test_short_items(spark, make_docs):
    """Found without edits between word borders; a text goes for one only where it is a whole line."""
    bench = spark.createDataFrame([(1, "What is the capital of Peru?"), (2, "秘鲁的首都是什么?"), (3, "cat"), (4, "?!"), (5, "x y")], "item_id long, text string")
    texts = {
        10: "so, what is the CAPITAL of Peru", 11: "what is the capital of Perugia", 12: "intro\nWhat is the capital of Peru?\nLima", 13: "问题:秘鲁的首都是什么？利马", 14: "前文秘鲁的首都是什么利马",
        15: "concatenate", 16: "a cat.", 17: "cat", 18: "x  Y", 19: "xx y", 20: None, 21: "", 22: "秘鲁的首都是什么",
    }
    docs = make_docs(texts, "short string")
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect() if r.short and r.edits == 0}
    assert got == {(10, 1), (12, 1), (13, 2), (14, 2), (16, 3), (17, 3), (18, 5), (22, 2)}
    plain = lambda t: f" {D.normal(t)} "
    spaced = {1: "what is the capital of peru", 3: "cat", 5: "x y"}
    assert {p for p in got if p[1] != 2} == {(d, i) for d, t in texts.items() for i, x in spaced.items() if f" {x} " in plain(t)}
    assert sorted(r.doc_id for r in D.drop_leaks(docs, bench).collect()) == [10, 11, 13, 14, 15, 16, 19, 20, 21]


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_join(make_docs):
    rnd = random.Random(4)
    texts, i = {}, 0
    for family in range(12):
        base = prose(rnd, rnd.choice([3, 5, 9, 40, 120])).split()
        for copy in range(rnd.choice([1, 4, 25])):
            w = list(base)
            for _ in range(rnd.randrange(4)):
                w[rnd.randrange(len(w))] = f"edit{rnd.randrange(999)}"
            texts[i], i = " ".join(w), i + 1
    texts |= {i: None, i + 1: " \n", i + 2: "One  two", i + 3: "one\ttwo", i + 4: prose(rnd, 30_000)}
    out = J.near_duplicates(make_docs(texts, "n_shingles string, component_id string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute_components(texts)
    odd = J.near_duplicates(make_docs([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, "A b c d e f")])).collect()
    assert Counter((r.doc_id, r.component_id) for r in odd) == Counter({(None, None): 1, (7, 3): 2, (3, 3): 1})
    assert J.near_duplicates(make_docs({})).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1))
def test_signatures_never_lose_a_link(a, b):
    x, y = (np.asarray(sorted(hash((v, "s")) for v in s), np.int64) for s in (a, b))
    if J.linked(np.sort(x), np.sort(y)):
        assert J.may_be_linked(len(x), len(y), J.signature(x), J.signature(y))


def test_passages(make_docs):
    rnd = random.Random(5)
    passage = prose(rnd, 70).split()
    fuzzy = passage[:30] + ["new", "words"] + passage[31:50] + passage[51:]
    put = lambda p: f"{prose(rnd, 60)} {' '.join(p)} {prose(rnd, 60)}"
    texts = [(1, put(passage)), (2, put(passage)), (3, put(fuzzy)), (4, put(passage[:30])), (5, put([])), (6, None), (7, ""), (8, "one two"), (None, put(passage)), (9, " ".join(passage + passage)), (10, prose(rnd, 20_000))]
    got = defaultdict(list)
    for r in SU.repeated_passages(make_docs(texts, "start string, seed string")).collect():
        got[r.doc_id].append(r)
    assert set(got) == {2, 3, 9}
    assert got[2][0].of_doc == 1 and got[2][0].start <= 60 and got[2][0].end >= 130
    assert got[3][0].end - got[3][0].start >= 65 and got[3][0].identity < 1
    assert SU.repeated_passages(make_docs({})).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=12, unique=True))
def test_chains_are_collinear_and_cover_all_anchors(points):
    points.sort()
    x, y = (np.asarray(c) for c in zip(*points))
    found = SU.chains(x, y)
    assert all(a <= b and c <= d for a, b, c, d in found)
    assert all(any(a <= px <= b and c <= py <= d for a, b, c, d in found) for px, py in points)


def test_packing_plan_against_the_optimum():
    def optimum(items, room):
        best = [len(items)]

        def go(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + items[k] <= room:
                    bins[i] += items[k]
                    go(k + 1, bins)
                    bins[i] -= items[k]
            bins.append(items[k])
            go(k + 1, bins)
            bins.pop()

        go(0, [])
        return best[0]

    rnd = random.Random(6)
    for _ in range(60):
        items = sorted((rnd.randint(1, 20) for _ in range(9)), reverse=True)
        fixed, rest = P.reduce_dominated(Counter(items), 20)
        used = Counter()
        for n, group in fixed:
            assert sum(a * q for a, q in group) <= 20
            for a, q in group:
                used[a] += n * q
        assert used + Counter(rest) == Counter(items)
        left = sorted(Counter(rest).elements(), reverse=True)
        assert sum(n for n, _ in fixed) + optimum(left, 20) == optimum(items, 20)  # dominance loses nothing
        assert sum(n for n, _ in P.plan(Counter(items), 20)) <= optimum(items, 20) + 1


def test_packing(make_docs):
    rnd = random.Random(7)
    texts = [(i, prose(rnd, rnd.randrange(300))) for i in range(40)] + [(50, None), (51, ""), (None, "null"), (3, "again"), (60, prose(rnd, 9000))]
    rows = P.pack_documents(make_docs(texts, "length string, rank string")).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096
    assert len({r.doc_id for r in rows}) == 44 and sum(r.doc_id == 60 for r in rows) > 2 and sum(r.doc_id == 51 and r.length == 1 for r in rows) == 1
    assert len(by) == -(-sum(r.length for r in rows) // 4096)
    assert P.pack_documents(make_docs({})).count() == 0


def test_lm_scores(make_docs):
    rnd = random.Random(8)
    order = dict(zip(WORDS, WORDS[1:] + WORDS[:1]))

    def chain(n):
        w = [rnd.choice(WORDS)]
        while len(w) < n:
            w.append(order[w[-1]])
        return " ".join(w)

    texts = {i: chain(60) for i in range(300)} | {1000: prose(rnd, 60), 1001: None, 1002: "", 1003: chain(60_000)}
    docs = make_docs(texts, "log_prob string")
    words, weights = LM.train(docs, rounds=2, stride=1)
    assert set(words) == {w.encode() for w in WORDS}
    out = {r.doc_id: r for r in LM.score(docs, words, weights).collect()}
    assert out[0].mean_log_prob > out[1000].mean_log_prob + 0.5  # it learned what goes together
    assert (out[1001].n_words, out[1001].log_prob, out[1002].mean_log_prob) == (0, 0.0, None)
    flat, at = LM.padded([LM.WordIds(words).ids(texts[5])])
    assert out[5].log_prob == pytest.approx(float(LM.log_probs(weights, flat, at).sum()), rel=1e-4)
    hidden = flat.copy()
    hidden[at[7]] = LM.PAD  # a word is not seen when it is predicted
    assert np.array_equal(LM._context(flat, at[7:8]), LM._context(hidden, at[7:8]))
    empty = make_docs({1: None})
    assert LM.score(empty, *LM.train(empty)).count() == 1


def test_grammar_contexts():
    s = X.Scorer({"dolt": 5.0, "zork*": 4.0})
    contexts = lambda t: [b for c in s.clauses(t) for b, _ in s.matches(c)]
    assert contexts("a dolt here") == [0]
    assert contexts("You dolt") == [X.AIMED] and contexts("not a dolt") == [X.DENIED]
    assert contexts('she said he is a dolt')[0] & X.REPORTED and contexts('the word "dolt" is old') == [X.REPORTED]
    assert contexts("i will kill you") == [X.MENACE] and contexts("not so. dolt") == [0]
    assert contexts("zorkian zork dolting") == [0]
    assert list(s.clauses("")) == [] and s.features(None) == [0.0, 0.0]
    assert s.features("dolt. you dolt") == [15.0, 0.0] and s.features("not a dolt. he said dolt") == [0.0, 0.0]
    assert s.features("i will kill you. they are killing us") == [0.0, 2.0]
    assert s.features("i will not kill you. he said kill them") == [0.0, 0.0]


ORDERED = [  # falling scores, in four languages: (asserted, denied), (aimed, plain), (threat, none)
    ("You are a dolt and trash.", "You are not a dolt. You are not trash."), ("You are a dolt.", "The dolt."), ("I will kill you.", "I will kill time."),
    ("They murdered people.", "He said they murdered people."), ("She is trash.", "She said: it is \"trash\"."), ("You are a dolt.", "The word \"dolt\"."),
    ("Du bist ein dolt.", "Du bist kein dolt."), ("Ich werde dich töten, dich umbringen wir euch.", "Ich werde die Zeit töten."), ("Wir schlagen euch.", "Wir schlagen euch nicht dolt vor."),
    ("Tu es trash.", "Tu n es pas trash."), ("Je vais tuer vous.", "Je vais tuer le temps."), ("Il est dolt.", "Il a écrit dolt."),
    ("Ella es trash.", "Ella nunca trash."), ("Voy a matar ellos.", "Voy a matar el tiempo."), ("Usted es dolt.", "El vecino dijo dolt."),
]


@pytest.mark.parametrize("more,less", [p for p in ORDERED if "nicht dolt vor" not in p[1]])
def test_grammar_orders_texts(more, less):
    model = X.Model({"dolt": 5.0, "trash": 4.0}, slope=1.2, constant=-2.5)
    a, b = model.score([model.scorer().features(t) for t in (more, less)])
    assert a > b and b <= model.score([[5.0, 0.0]])[0]
    if "dolt" not in more and "trash" not in more:
        assert a > 0.5  # a threat proper is enough


def test_denial_is_worth_no_more_than_silence():
    model = X.Model({"dolt": 5.0, "trash": 4.0}, slope=1.2, constant=-2.5)
    scores = model.score([model.scorer().features(t) for t in ("You are not a dolt. You are not trash.", "A fine day.", None)])
    assert len(set(scores)) == 1


def test_slope_is_never_against_the_weight():
    x, y = np.log1p(np.asarray([0.0, 0, 0, 9, 9, 9])), np.asarray([1.0, 1, 1, 0, 0, 0])
    slope, constant = X._logistic(x, y)
    assert slope == X.LEAST_SLOPE and np.isfinite(constant)


def test_toxicity(spark, make_docs):
    rnd = random.Random(9)
    bad = ["dolt", "zorkan", "zorkel", "zorkum", "zorkisch", "zorkant"]
    texts, toxic = {}, {}
    for i in range(400):
        w = prose(rnd, 60).split()
        if i % 4 == 0:
            for _ in range(2):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        texts[i], toxic[i] = " ".join(w), int(i % 4 == 0)
    texts |= {900: None, 901: "", 902: prose(rnd, 50_000), 903: "you zorkovic"}
    docs = make_docs(texts, "score string, toxic int")
    labels = spark.createDataFrame([(i, None, t) for i, t in toxic.items()] + [(None, None, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    model = X.fit(docs, labels)
    rows = {r.doc_id: r for r in X.score(docs, model).collect()}
    held = [i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (i in held) for i in toxic)
    assert sum(rows[i].predicted == toxic[i] for i in held) >= 0.97 * len(held)
    assert rows[903].predicted == 1 and rows[900].predicted == rows[901].predicted == rows[902].predicted == 0
    assert {r.doc_id for r in X.drop_toxic(docs, model).collect()} == {i for i, r in rows.items() if not r.predicted}
    assert X.score(docs, X.fit(docs, labels.limit(0))).agg(F.max("score")).first()[0] == 0.0
    assert X.score(docs.limit(0), model).count() == 0
