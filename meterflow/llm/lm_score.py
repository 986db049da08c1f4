"""Masked pseudo-likelihood of documents under a small bidirectional network.

Every word is predicted from ``SIDE`` words on its left and on its right, never
from itself; a document's score is the sum of the log-probabilities of all its
words. The network, in numpy: one hidden layer over the context words (a weight
table for each place, tanh), then a two-level softmax: 32 classes, 32 words in
each. Its 1024 outputs are the corpus' most frequent words, counted over all
documents, and ``BUCKETS`` buckets that share all other words by hash. A word of
a bucket has the bucket's probability times its own share of it, by Witten and
Bell from the counts of all words: n / (N + T) for a word counted n times in a
bucket of N words, T of them distinct. The T / (N + T) left is for words the
corpus lacks, spread by their bytes (``unseen_log``). The counts are a table, as
long as the corpus has words, and are joined to the words of the documents.

Training goes over all documents in ``rounds`` rounds. In each, every task
trains on its documents of the round from the common weights (Adagrad, every
word a target, or every ``stride``-th) and gives its weights and its number of targets;
Spark adds them up in two levels, and their mean is the next common model. Only
that mean, a fixed 0.5 MB, the frequent words and the buckets' sizes come to the
driver.

Words are runs without ASCII white space, A-Z lower-cased.

Defined results: null, empty and blank texts have n_words 0, log_prob 0 and a
null mean. Rows that share an id are scored one by one; null ids are carried.
Other columns are not read. Without any word in the corpus nothing is trained.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, ship
from .tokens import trimmed

CLASSES, IN_CLASS = 32, 32
OUT = CLASSES * IN_CLASS
BUCKETS = 64
SIDE = 2
HIDDEN = 24
PAD = OUT
ROUNDS = 3
STRIDE = 1
BATCH = 1024
CHUNKS = 16
SHAPES = [(2 * SIDE, OUT + 1, HIDDEN), (HIDDEN,), (CLASSES, HIDDEN), (CLASSES,), (CLASSES, IN_CLASS, HIDDEN), (CLASSES, IN_CLASS)]
SIZES = [int(np.prod(s)) for s in SHAPES]
SIZE = sum(SIZES)
#: shape, first weight and number of weights of each
PLACES = [(s, sum(SIZES[:i]), SIZES[i]) for i, s in enumerate(SHAPES)]


class WordIds(dict):
    """word -> output, learning the bucket of other words as they come."""

    def __init__(self, vocabulary: list[bytes], most: int = 500_000):
        super().__init__((w, self.place(r)) for r, w in enumerate(vocabulary))
        self.fixed, self.most = dict(self), most

    @staticmethod
    def place(rank: int) -> int:
        """Ranks are dealt to the classes in turn."""
        return rank % CLASSES * IN_CLASS + rank // CLASSES

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.most:
            self.clear()
            self.update(self.fixed)
            if word in self.fixed:
                return self.fixed[word]
        out = self[word] = self.place(OUT - BUCKETS + zlib.crc32(word) % BUCKETS)
        return out

    def ids(self, text: str | None) -> np.ndarray:
        return self.of((text or "").encode().lower().split())

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def cut(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of ``texts``, the number of each word in that list, and
    the number of words of each text."""
    low = pa.compute.ascii_lower(pa.compute.fill_null(texts, ""))
    split = pa.compute.ascii_split_whitespace(low)
    found = split.flatten().dictionary_encode()
    words = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    codes, ends = found.indices.to_numpy(), split.offsets.to_numpy()
    if b"" in words:  # beside white space at an end, or of an empty text
        some = codes != words.index(b"")
        ends = np.r_[0, np.cumsum(some)][ends]
        codes = codes[some]
    return words, codes, np.diff(ends)


class Vocabulary(list):
    """The frequent words, with the table of all words' counts (word, n) and,
    for each bucket, the number of its words and of its distinct ones."""

    def __init__(self, words: list[bytes], counts: DataFrame, sizes: list[tuple[int, int]]):
        super().__init__(words)
        self.counts, self.sizes = counts, sizes


def in_bucket(out: np.ndarray) -> np.ndarray:
    """Which outputs are buckets (of the last ranks)."""
    return out % IN_CLASS >= (OUT - BUCKETS) // CLASSES


def unseen_log(length: Column) -> Column:
    """Log-probability of a word of ``length`` bytes among all byte strings of
    a bucket: each byte, or the end, one of 257."""
    return F.lit(float(np.log(BUCKETS))) - (length + 1) * float(np.log(257))


def split_weights(flat: np.ndarray) -> list[np.ndarray]:
    return [flat[a : a + n].reshape(s) for s, a, n in PLACES]


def first_weights() -> np.ndarray:
    rng = np.random.default_rng(11)
    return (rng.standard_normal(SIZE) * 0.05).astype(np.float32)


def padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents in one array with pads around each, and the words' places."""
    pad = np.full(SIDE, PAD, np.int32)
    parts = [pad]
    for d in docs:
        parts += [d, pad]
    flat = np.concatenate(parts)
    return flat, np.flatnonzero(flat != PAD)


def _context(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    steps = [*range(-SIDE, 0), *range(1, SIDE + 1)]
    return np.stack([flat[at + s] for s in steps])


def _softmax(z: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def _picked_log(z: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Logarithm of each column's softmax at its row; changes ``z``."""
    z -= z.max(axis=0)
    picked = z[row, np.arange(len(row))]
    np.exp(z, out=z)
    return picked - np.log(z.sum(axis=0))


def _hidden(w: list[np.ndarray], ctx: np.ndarray) -> np.ndarray:
    h = w[1] + w[0][0].take(ctx[0], axis=0)
    for j in range(1, len(ctx)):
        h += w[0][j].take(ctx[j], axis=0)
    return np.tanh(h, out=h)


def log_probs(flat_weights: np.ndarray, flat: np.ndarray, at: np.ndarray, step: int = 8192) -> np.ndarray:
    """Log-probability of each word at ``at`` given both sides."""
    w, out = split_weights(flat_weights), np.zeros(len(at), np.float32)
    for i in range(0, len(at), step):  # what a processor's cache holds
        some = at[i : i + step]
        target = flat[some]
        order = np.argsort(target // IN_CLASS, kind="stable")  # a class' words side by side
        some, target = some[order], target[order]
        h = np.ascontiguousarray(_hidden(w, _context(flat, some)).T)
        cls, word = target // IN_CLASS, target % IN_CLASS
        got = _picked_log(w[2] @ h + w[3][:, None], cls)
        cut = np.searchsorted(cls, np.arange(CLASSES + 1))
        for c in range(CLASSES):
            a, z = cut[c], cut[c + 1]
            if a < z:
                got[a:z] += _picked_log(w[4][c] @ h[:, a:z] + w[5][c][:, None], word[a:z])
        out[i + order] = got
    return out


def train_step(flat_weights: np.ndarray, seen: np.ndarray, flat: np.ndarray, at: np.ndarray, rate: float = 0.1) -> None:
    """One Adagrad step on the words at ``at``; changes weights and ``seen``."""
    grad = np.zeros(SIZE, np.float32)
    w, g = split_weights(flat_weights), split_weights(grad)
    ctx, target, n = _context(flat, at), flat[at], len(at)
    h = _hidden(w, ctx)
    cls, word = target // IN_CLASS, target % IN_CLASS
    rows = np.arange(n)
    p = _softmax(w[2] @ h.T + w[3][:, None])
    p[cls, rows] -= 1
    g[2][:], g[3][:] = p @ h / n, p.sum(axis=1) / n
    dh = p.T @ w[2]
    # the classes' words side by side, with room for the largest class
    order = np.argsort(cls.astype(np.int16), kind="stable")
    sizes = np.bincount(cls, minlength=CLASSES)
    most = int(sizes.max())
    slot = cls[order] * most + rows - np.repeat(np.cumsum(sizes) - sizes, sizes)
    wide = np.zeros((CLASSES * most, HIDDEN), np.float32)
    wide[slot] = h.take(order, axis=0)
    wide = wide.reshape(CLASSES, most, HIDDEN)
    z = (wide @ w[4].transpose(0, 2, 1) + w[5][:, None]).reshape(-1, IN_CLASS).take(slot, axis=0)
    z = _softmax(np.ascontiguousarray(z.T))
    z[word[order], rows] -= 1
    q = np.zeros((CLASSES * most, IN_CLASS), np.float32)
    q[slot] = z.T
    q = q.reshape(CLASSES, most, IN_CLASS)
    g[4][:], g[5][:] = q.transpose(0, 2, 1) @ wide / n, q.sum(axis=1) / n
    dh[order] += (q @ w[4]).reshape(-1, HIDDEN).take(slot, axis=0)
    dh *= (1 - h * h) / n
    g[1][:] = dh.sum(axis=0)
    # a row of weights for each place and word
    places = (ctx + (np.arange(len(ctx)) * (OUT + 1))[:, None]).astype(np.int16).reshape(-1)
    order = np.argsort(places, kind="stable")
    places = places[order]
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    g[0].reshape(-1, HIDDEN)[places[first]] = np.add.reduceat(dh.take(order % n, axis=0), first, axis=0)
    step = grad * grad
    seen += step
    np.sqrt(seen, out=step)
    step += 1e-6
    grad *= rate
    grad /= step
    flat_weights -= grad


def _groups(batches: Iterator[pa.RecordBatch], column: int, most: int = 50_000) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Slices of the batches with about ``most`` words' characters at a time."""
    for b in batches:
        start, size = 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(b.column(column)), 0).to_pylist()
        for i, n in enumerate(lengths):
            if i > start and size + n > 6 * most:
                yield start, i, b
                start, size = i, 0
            size += n
        if start < b.num_rows:
            yield start, b.num_rows, b


def _train(batches: Iterator[pa.RecordBatch], vocabulary: list[bytes], weights: np.ndarray, stride: int) -> Iterator[pa.RecordBatch]:
    ids, w, seen, n = WordIds(vocabulary), weights.copy(), np.full(SIZE, 1e-4, np.float32), 0
    rng = np.random.default_rng(TaskContext.get().partitionId())
    for a, z, b in _groups(batches, 0):
        words, codes, n_words = cut(b.column(0).slice(a, z - a))
        flat, at = padded(np.split(ids.of(words)[codes], np.cumsum(n_words)[:-1]))
        at = rng.permutation(at[int(rng.integers(stride)) :: stride])
        for i in range(0, len(at), BATCH):
            train_step(w, seen, flat, at[i : i + BATCH])
        n += len(at)
    if n:
        parts = np.array_split(w.astype(np.float64) * n, CHUNKS)
        part = TaskContext.get().partitionId() % 64
        cols = [pa.array(range(CHUNKS), pa.int32()), pa.array([part] * CHUNKS, pa.int32()), pa.array([n] * CHUNKS, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["chunk", "part", "n", "w"])


def _add(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Sums by chunk and part (or chunk alone); a fixed number of sums at most."""
    total: dict[tuple[int, int], list] = {}
    for b in batches:
        for chunk, part, n, w in zip(*(b.column(i) for i in range(4))):
            key, w = (chunk.as_py(), 0 if last else part.as_py()), np.frombuffer(w.as_buffer(), np.float64)
            if key in total:
                total[key][0] += n.as_py()
                total[key][1] += w
            else:
                total[key] = [n.as_py(), w.copy()]
    for (chunk, part), (n, w) in total.items():
        cols = [pa.array([chunk], pa.int32()), pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([w.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["chunk", "part", "n", "w"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for a, z, b in _groups(batches, 0, 2_000_000):
        words, codes, _ = cut(b.column(0).slice(a, z - a))
        n = np.bincount(codes, minlength=len(words)).astype(np.int64)
        got = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n)], names=["word", "n"])
        yield got.filter(pa.array(n > 0))


def bucket_of(word: str = "word") -> Column:
    return F.pmod(F.crc32(word), F.lit(BUCKETS)).cast("int")


def vocabulary(texts: DataFrame) -> Vocabulary:
    """The most frequent words of all documents, ties by their bytes, and the
    counts of all."""
    counts = texts.mapInArrow(trimmed(_count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = keep(counts, "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(OUT - BUCKETS).collect()
    sizes = np.zeros((BUCKETS, 2), np.int64)
    for r in counts.groupBy(bucket_of().alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("t")).collect():  # BUCKETS rows
        sizes[r["b"]] = r["n"], r["t"]
    for r in top:  # the frequent words are in no bucket
        sizes[zlib.crc32(r["word"]) % BUCKETS] -= (r["n"], 1)
    return Vocabulary([bytes(r["word"]) for r in top], counts, [(int(n), int(t)) for n, t in sizes])


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, stride: int = STRIDE) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and weights, from all documents."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    words, weights = vocabulary(texts), first_weights()
    kind = "chunk int, part int, n long, w binary"
    for r in range(rounds):
        sent = spark.sparkContext.broadcast((list(words), weights))
        own = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r)  # every text in one round
        got = own.mapInArrow(lambda it, sent=sent: _train(it, *sent.value, stride), kind)
        got = got.repartition("chunk", "part").mapInArrow(lambda it: _add(it, False), kind)
        rows = got.repartition("chunk").mapInArrow(lambda it: _add(it, True), kind).collect()  # CHUNKS rows
        if rows:
            rows.sort(key=lambda x: x["chunk"])
            weights = np.concatenate([np.frombuffer(x["w"], np.float64) / x["n"] for x in rows]).astype(np.float32)
    return words, weights


def _rows(columns: dict[str, list | np.ndarray | pa.Array], ids: pa.DataType, most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Batches with all columns; those not given are null."""
    n = len(columns["key"])
    kinds = {"key": pa.int64(), "id": ids, "n_words": pa.int64(), "log_prob": pa.float64(), "word": pa.binary(), "docs": pa.list_(pa.int32())}
    b = pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds.items()], names=list(kinds))
    for i in range(0, n, most):
        yield b.slice(i, most)


def _scores(batches: Iterator[pa.RecordBatch], vocabulary: list[bytes], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per document, under the network alone, and for each group of documents
    a row for each of its distinct words without an output of its own, with the
    documents (their keys less the row's) that have it, once for each time. A
    document's ``word`` is its key after a blank, which no word has: it joins with
    nothing, in no one task."""
    ids = WordIds(vocabulary)
    key = TaskContext.get().partitionId() << 33
    for a, z, b in _groups(batches, 1, 1_000_000):
        of_id = b.column(0).slice(a, z - a)
        words, codes, n = cut(b.column(1).slice(a, z - a))
        outs = ids.of(words)[codes]
        flat, at = padded(np.split(outs, np.cumsum(n)[:-1]))
        of, total = np.repeat(np.arange(len(n), dtype=np.int32), n), np.zeros(len(n))
        for i in range(0, len(at), 50_000):  # a very long text has no more at once
            lp = log_probs(weights, flat, at[i : i + 50_000]).astype(np.float64)
            total += np.bincount(of[i : i + 50_000], lp, len(n))
        own = np.arange(key, key + len(n))
        yield from _rows({"key": own, "id": of_id, "n_words": n, "log_prob": total, "word": [b" %d" % k for k in own]}, of_id.type)
        rare = in_bucket(outs)
        codes, of = codes[rare], of[rare]
        sizes = np.bincount(codes, minlength=len(words))
        some = np.flatnonzero(sizes)
        ends = np.r_[0, np.cumsum(sizes[some])].astype(np.int32)
        docs = pa.ListArray.from_arrays(pa.array(ends), pa.array(of[np.argsort(codes, kind="stable")]))
        yield from _rows({"key": [key] * len(some), "word": pa.array(words, pa.binary()).take(pa.array(some)), "docs": docs}, of_id.type)
        key += len(n)


def score(docs: DataFrame, words: Vocabulary, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_words, log_prob (sum), mean_log_prob."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((list(words), weights))
    only = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = only.mapInArrow(trimmed(lambda it: _scores(it, *sent.value)), f"key long, id {kind}, n_words long, log_prob double, word binary, docs array<int>")
    joined = parts.join(words.counts, "word", "left")
    all_n, distinct = (F.element_at(F.array(*[F.lit(float(s[i])) for s in words.sizes]), bucket_of() + 1) for i in (0, 1))
    # a bucket without any counted word is all left to new ones
    base = F.when(all_n > 0, F.log(distinct) - F.log(all_n + distinct)).otherwise(0.0) + unseen_log(F.length("word"))
    share = F.when(F.col("n").isNotNull(), F.log(F.col("n").cast("double")) - F.log(all_n + distinct)).otherwise(base)
    each = joined.select("key", "id", "n_words", F.coalesce("log_prob", share).alias("one"), F.explode_outer("docs").alias("doc"))
    each = each.withColumn("key", F.col("key") + F.coalesce("doc", F.lit(0)))
    got = each.groupBy("key").agg(F.max("id").alias(id_col), F.max("n_words").alias("n_words"), F.sum("one").alias("log_prob"))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return got.select(id_col, "n_words", "log_prob", mean.alias("mean_log_prob"))
