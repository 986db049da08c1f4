"""Quality scores from random-indexing word vectors and a small network.

Texts are cut into words, runs of symbols and line ends. Case and kind of a
word, and its repeating one of the two before it, become marks: words of their own
beside it. A word's place is its lower-cased hash among ``ROWS`` rows (the
marks have the first ones), so no list of words is kept and rare words share
places at any corpus size.

Random indexing: each row has a fixed sparse index vector, ``NONZERO`` signed
ones among ``DIM``, drawn by its number. A row's context vector is the sum of
the index vectors of all its neighbours up to ``WINDOW`` words away (and of its
marks), over all documents. Each task adds up its own table; Spark sums the
tables in two levels, by blocks of rows, so that what the driver gets is the one
table, whose size is fixed. A word vector is the context vector per neighbour,
less the mean one, at unit length (shorter for rarely seen rows), next to the
row's own index vector. A document is the mean of its words' vectors.

A two-layer numpy network (tanh, then a logit) reads the pooled vector. It
learns from at most ``max_labelled`` labelled rows outside the held-out fold
(those with the smallest hash of the id); a fold of these is kept apart to stop
training and then to set the temperature, one number that divides the logit so
that the scores are calibrated.

Defined results: null, empty and blank texts have the zero vector and the
network's score of it. Texts are read whole, long ones in pieces. Without
labelled rows of both kinds, every score is the share of 1 among those read (0
if none). Null labels and ids train nothing; a null id is scored and is not held
out. An id with several labels takes the largest. Rows that share an id are
scored one by one, equal texts alike. Other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, ship

MAX_LABELLED = 8192
THRESHOLD = 0.3
ROWS = 1 << 14
DIM = 64
NONZERO = 2
WINDOW = 2
HIDDEN = 24
BLOCK = 256
MERGE_GROUPS = 64
CHUNK = 1 << 19
FEW = 20.0

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+|\n")
PLAIN, CAPITAL, UPPER, DIGITS, SYMBOLS, MIXED, REPEAT = range(7)
MARKS = 8


def kind_of(token: bytes) -> int:
    """The mark of a word by its letters' case."""
    if not (token[0] >= 128 or token[:1].isalnum()):
        return SYMBOLS
    text = token.decode("utf-8", "replace")
    if text.isdigit():
        return DIGITS
    if text.islower():
        return PLAIN
    if text.isupper():
        return UPPER if len(text) > 1 else CAPITAL
    return CAPITAL if text[0].isupper() and text[1:].islower() else MIXED if any(c.isupper() or c.isdigit() for c in text) else PLAIN


class Places(dict):
    """token -> row + ROWS * mark, learning tokens as they come."""

    MOST = 400_000

    def __missing__(self, token: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        lower = token.decode("utf-8", "replace").lower().encode()
        out = self[token] = MARKS + zlib.crc32(lower) % (ROWS - MARKS) + ROWS * kind_of(token)
        return out

    def read(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the words of a text, and their marks."""
        tokens = TOKEN.findall(text or b"")
        packed = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return packed % ROWS, packed // ROWS


def index_codes() -> np.ndarray:
    """Places and signs of each row's index vector: a column c < DIM is +1
    there, c >= DIM is -1 at c - DIM; no place twice."""
    rng = np.random.default_rng(7)
    places = rng.permuted(np.tile(np.arange(DIM), (ROWS, 1)), axis=1)[:, :NONZERO]
    return places + DIM * rng.integers(0, 2, (ROWS, NONZERO))


def index_vectors() -> np.ndarray:
    codes = index_codes()
    out = np.zeros((ROWS, 2 * DIM), np.float32)
    np.put_along_axis(out, codes, 1.0, axis=1)
    return (out[:, :DIM] - out[:, DIM:]) / np.sqrt(NONZERO)


# ------------------------------------------------------------- contexts


def repeats(rows: np.ndarray, marks: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Where a word (no symbols) equals one of the two before it in its text."""
    again = np.zeros(len(rows), bool)
    for apart in (1, 2):
        again[apart:] |= (rows[apart:] == rows[:-apart]) & (text[apart:] == text[:-apart])
    return np.flatnonzero(again & (marks != SYMBOLS))


class Contexts:
    """Sums of neighbours' index vectors, by row; signs kept apart."""

    def __init__(self):
        self.codes = index_codes()
        self.table = np.zeros(ROWS * 2 * DIM, np.int64)

    def _count(self, a: np.ndarray, b: np.ndarray) -> None:
        """Rows a and b are neighbours, place by place."""
        at = np.concatenate([(x[:, None] * (2 * DIM) + self.codes[y]).ravel() for x, y in ((a, b), (b, a))])
        self.table += np.bincount(at, minlength=len(self.table))

    def add(self, rows: np.ndarray, marks: np.ndarray, text: np.ndarray) -> None:
        """``text``: the number of the text of each word."""
        for low in range(0, len(rows), CHUNK):
            part = slice(low, low + CHUNK + WINDOW)
            r, t = rows[part], text[part]
            for apart in range(1, WINDOW + 1):
                a, b = r[:-apart][:CHUNK], r[apart:][:CHUNK]
                near = t[:-apart][:CHUNK] == t[apart:][:CHUNK]
                self._count(a[near], b[near])
            r, m = rows[low : low + CHUNK], marks[low : low + CHUNK]
            self._count(m[m > 0], r[m > 0])
        again = repeats(rows, marks, text)
        for low in range(0, len(again), CHUNK):
            r = rows[again[low : low + CHUNK]]
            self._count(np.full(len(r), REPEAT), r)

    def rows(self) -> np.ndarray:
        """ROWS x (DIM + 1): the sums, then the number of neighbours."""
        both = self.table.reshape(ROWS, 2, DIM)
        return np.hstack([both[:, 0] - both[:, 1], both.sum(axis=(1, 2))[:, None] // NONZERO])


def _joined(texts: list, places: Places) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    read = [places.read(t) for t in texts]
    sizes = [len(r) for r, _ in read]
    return np.concatenate([r for r, _ in read]), np.concatenate([m for _, m in read]), np.repeat(np.arange(len(read)), sizes)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums, as blocks of rows."""
    sums, places, any_text = Contexts(), Places(), False
    for b in batches:
        waiting, size = [], 0
        for t in b.column(0):
            waiting.append(t.as_py())
            size += len(waiting[-1] or b"")
            if size > 4 * CHUNK:
                sums.add(*_joined(waiting, places))
                waiting, size = [], 0
        if waiting:
            sums.add(*_joined(waiting, places))
        any_text = any_text or b.num_rows > 0
    if any_text:
        g = TaskContext.get().partitionId() % MERGE_GROUPS
        rows = sums.rows()
        for at in range(0, ROWS, BLOCK):
            yield _block_row(at, g, rows[at : at + BLOCK])


def _block_row(at: int, g: int, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([g], pa.int32()), pa.array([rows.tobytes()], pa.binary())], names=["at", "g", "sums"])


def _add_blocks(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s.as_py(), np.int64) for s in table.column("sums"))
    return pa.Table.from_batches([_block_row(table.column("at")[0].as_py(), table.column("g")[0].as_py(), total)])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """ROWS x 2 DIM: context and index vectors of all rows, from all documents."""
    ship(docs.sparkSession)
    kind = "at int, g int, sums binary"
    texts = docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    parts = texts.mapInArrow(_contexts, kind).groupBy("at", "g").applyInArrow(_add_blocks, kind)
    blocks = parts.groupBy("at").applyInArrow(_add_blocks, kind).toArrow()  # ROWS / BLOCK rows
    sums = np.zeros((ROWS, DIM + 1))
    for at, raw in zip(blocks["at"].to_pylist(), blocks["sums"].to_pylist()):
        sums[at : at + BLOCK] = np.frombuffer(raw, np.int64).reshape(-1, DIM + 1)
    n = sums[:, DIM:]
    mean = sums[:, :DIM].sum(axis=0) / max(n.sum(), 1)
    context = sums[:, :DIM] / np.maximum(n, 1) - np.where(n > 0, mean, 0)
    context *= n / (n + FEW) / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-12)
    return np.hstack([context, index_vectors()]).astype(np.float32)


def pool(text: bytes | None, vectors: np.ndarray, places: Places) -> np.ndarray:
    """The mean vector of a text's words and marks."""
    rows, marks = places.read(text)
    if not len(rows):
        return np.zeros(vectors.shape[1], np.float32)
    total = np.zeros(vectors.shape[1], np.float64)
    for at in range(0, len(rows), CHUNK // 16):
        total += vectors[rows[at : at + CHUNK // 16]].sum(axis=0, dtype=np.float64)
    times = np.bincount(marks, minlength=MARKS)[:MARKS]
    times[PLAIN], times[REPEAT] = 0, len(repeats(rows, marks, np.zeros(len(rows), np.int8)))
    total += times @ vectors[:MARKS].astype(np.float64)
    return (total / len(rows)).astype(np.float32)


# ------------------------------------------------------------- the network


@dataclass
class Network:
    """Standardised input, a tanh layer, a logit over a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # w1, b1, w2, b2
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train_network(x: np.ndarray, y: np.ndarray, apart: np.ndarray, rounds: int = 300, rate: float = 0.01, decay: float = 1e-3, batch: int = 256) -> Network:
    """Adam with weight decay; the weights of the least loss on ``apart`` stay,
    on which the temperature is then set."""
    rng = np.random.default_rng(5)
    fit, check = ~apart, apart if apart.any() and len(set(y[apart])) == 2 else ~apart
    net = Network(x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3, [rng.standard_normal((x.shape[1], HIDDEN)) / x.shape[1] ** 0.5, np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(())])
    z, t = (x[fit] - net.mean) / net.scale, y[fit]
    first, second = [np.zeros_like(w) for w in net.layers], [np.zeros_like(w) for w in net.layers]
    best, kept, since, step = np.inf, net.layers, 0, 0
    for _ in range(rounds):
        order = rng.permutation(len(z))
        for low in range(0, len(z), batch):
            at = order[low : low + batch]
            w1, b1, w2, b2 = net.layers
            h = np.tanh(z[at] @ w1 + b1)
            out = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -60, 60))) - t[at]) / len(at)
            back = np.outer(out, w2) * (1 - h * h)
            step += 1
            fresh = []
            for i, (w, g) in enumerate(zip(net.layers, (z[at].T @ back, back.sum(axis=0), h.T @ out, out.sum()))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                fresh.append(w - rate * (move + (decay * w if w.ndim else 0)))
            net.layers = fresh
        loss = log_loss(net.logits(x[check]), y[check])
        if loss < best - 1e-5:
            best, kept, since = loss, net.layers, 0
        elif (since := since + 1) > 25:
            break
    net.layers = kept
    net.temperature = best_temperature(net.logits(x[check]), y[check])
    return net


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The least log loss over 1/2..8 by golden sections of log T (labels that
    a sample happens to separate would ask for ever smaller ones)."""
    low, high, cut = -np.log(2), np.log(8), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - cut * (high - low), low + cut * (high - low)
        if log_loss(logits / np.exp(a), y) <= log_loss(logits / np.exp(b), y):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


# ------------------------------------------------------------- rows


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None = None
    share: float = 0.0
    places: Places = field(default_factory=Places, repr=False)

    def score(self, texts: list) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        if not texts:
            return np.zeros(0)
        return self.network.score(np.vstack([pool(t, self.vectors, self.places) for t in texts]))


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; 0 is the held-out fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def _pooled(batches: Iterator[pa.RecordBatch], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    places = Places()
    for b in batches:
        rows = [pool(t.as_py(), vectors, places).tobytes() for t in b.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), b.column(1), b.column(2)], names=["x", "y", "fold"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Word vectors from all documents, the network from at most ``max_labelled`` labelled rows."""
    spark = docs.sparkSession
    ship(spark)
    model = Model(word_vectors(docs, text_col))
    chosen = (
        labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("long").alias("y"))
        .filter("i IS NOT NULL AND y IN (0, 1)").filter(fold("i") != 0)
        .groupBy("i").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("i"), "i").limit(max_labelled)
    )
    # at most max_labelled rows of two numbers; an id may have several documents, so the limit holds again
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").cast("binary").alias("text"))
    sample = texts.join(F.broadcast(chosen), "i").select("text", "y", fold("i").alias("fold"), "i")
    sample = keep(sample.orderBy(F.xxhash64("i"), "i", "text").limit(max_labelled).select("text", "y", "fold"), "labelled")
    sent = spark.sparkContext.broadcast(model.vectors)
    rows = sample.repartition(8).mapInArrow(lambda it: _pooled(it, sent.value), "x binary, y long, fold long").orderBy("x", "y").toArrow()
    y, folds = np.asarray(rows["y"].to_pylist(), float), np.asarray(rows["fold"].to_pylist(), int)
    if len(set(y)) < 2:
        model.share = float(y.mean()) if len(y) else 0.0
        return model
    x = np.vstack([np.frombuffer(v, np.float32) for v in rows["x"].to_pylist()]).astype(np.float64)
    apart = folds == 1
    if len(set(y[~apart])) < 2:
        apart = np.zeros(len(y), bool)
    model.network = train_network(x, y, apart)
    return model


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    model.places = Places()
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score([t.as_py() for t in b.column(1)]), pa.float64())], names=["i", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: the id, held_out, its score, predicted (1 from ``threshold`` on)."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    only = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").cast("binary").alias("text"))
    sent = spark.sparkContext.broadcast(model)
    got = only.mapInArrow(lambda it: _scores(it, sent.value), f"i {kind}, score double")
    held = F.coalesce(fold("i") == 0, F.lit(False))
    return got.select(F.col("i").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
