"""Ranked lexical search over a document FP-tree.

The query set is read in blocks of about ``block_bytes`` of text. For each block
the documents go through two passes.

1. Every whole text is cut into terms, counted, and restricted to the terms of
   the block: a row per document with its length n and its (term, tf) vector,
   written to the shared folder. Tasks add their document counts of terms (df),
   N and L as rows of the same table; Spark sums those up.
2. Each task takes its rows in chunks of at most ``cells`` documents x terms and
   builds an FP-tree of a chunk: terms ordered by df, most frequent first, so
   that documents share trie paths from the root on; a path without a branch is
   one step, and siblings of fewer than ``LEAF`` documents share a bucket. Each
   node holds, of its subtree, the largest tf of every term and the smallest m.
   As a score rises with tf and falls with m, the score of a document with
   these would be an upper bound of all below. A depth-first branch-and-bound
   per item visits the higher bound first and leaves out subtrees that cannot
   reach the item's k-th score so far, which a task carries from chunk to chunk.

A task sends at most k rows per item; a window, with the k best of each input
partition taken before the shuffle, ranks them.

Terms are the maximal runs of ASCII letters, digits and all other characters
beyond ASCII, A-Z lower-cased. In UTF-8 that is a translation of bytes. Scores
are whole numbers; m comes from Python's integers, sums stay below 2**63.

Defined results: null and empty texts, and those of separators alone, have no
terms: they count nowhere and are never found. Each row of the items asks for
itself: equal rows get equal results, once for each row; an item without a
term that some document holds gets no row; a null item_id is carried. Rows of
documents that share an id are documents of their own; a null doc_id ranks
after all others of its score, and ties of equal ids and scores keep as many
rows as fit. Fewer than k found give fewer rows; empty tables give none. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, ship

K = 20
BLOCK_BYTES = 100_000
CELLS = 8_000_000
LEAF = 64
RESTRICTED = "doc_id long, n long, terms binary, tfs binary, df binary, n_docs long, n_terms long"
NO_ID = np.iinfo(np.int64).max

#: bytes of terms as they are, A-Z lower-cased; all others blank
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


# ------------------------------------------------------------- the query set


@dataclass
class Block:
    """Some items; terms are numbered in the order they come."""

    ids: list[int | None]
    numbers: dict[bytes, int]
    items: list[tuple[np.ndarray, np.ndarray]]  # term numbers, how often

    @staticmethod
    def of(rows: list[tuple[int | None, bytes]]) -> Block:
        numbers: dict[bytes, int] = {}
        items = []
        for _, text in rows:
            counts = Counter(terms(text))
            items.append((np.asarray([numbers.setdefault(t, len(numbers)) for t in counts], np.int64), np.asarray(list(counts.values()), np.int64)))
        return Block([i for i, _ in rows], numbers, items)


def _bundle(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Items into rows of (ids, texts) of about ``block_bytes`` each."""

    def out(ids, texts):
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.binary()))], names=["ids", "texts"])

    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if ids and size + len(t) > block_bytes:
                yield out(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if ids:
        yield out(ids, texts)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[Block]:
    """The items, a block at a time; one block is on the driver at once."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").cast("binary").alias("t")).filter("t IS NOT NULL")
    blocks = keep(rows.mapInArrow(lambda it: _bundle(it, block_bytes), "ids array<long>, texts array<binary>").withColumn("nr", F.monotonically_increasing_id()), "item-blocks")
    for r in blocks.select("nr").orderBy("nr").collect():
        one = blocks.filter(F.col("nr") == r["nr"]).first()
        block = Block.of([(i, bytes(t)) for i, t in zip(one["ids"], one["texts"])])
        if block.numbers:
            yield block


# ------------------------------------------------------------- first pass


def _restrict(batches: Iterator[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Documents as vectors over the block's terms; last, the task's counts."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tfs", pa.binary()), ("df", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
    df, n_docs, n_terms = np.zeros(len(numbers), np.int64), 0, 0
    known = numbers.keys()
    for b in batches:
        ids, lengths, places, counts = [], [], [], []
        for i, text in zip(b.column(0).to_pylist(), b.column(1)):
            words = terms(text.as_py())
            if not words:
                continue
            found = Counter(words)
            hits = found.keys() & known
            place = np.fromiter(map(numbers.__getitem__, hits), np.uint32, len(hits))
            df[place] += 1
            n_docs += 1
            n_terms += len(words)
            if len(hits):
                ids.append(i)
                lengths.append(len(words))
                places.append(place.tobytes())
                counts.append(np.fromiter(map(found.__getitem__, hits), np.uint32, len(hits)).tobytes())
        none = pa.nulls(len(ids))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(places, pa.binary()), pa.array(counts, pa.binary()), none.cast(pa.binary()), none.cast(pa.int64()), none.cast(pa.int64())], schema=schema
        )
    yield pa.RecordBatch.from_pylist([{"df": df.tobytes(), "n_docs": n_docs, "n_terms": n_terms}], schema=schema)


def _nonzero(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for raw in b.column(0).to_pylist():
            df = np.frombuffer(raw, np.int64)
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 25 + 25 * n * n_docs // n_terms


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


# ------------------------------------------------------------- second pass


class Tree:
    """The FP-tree of a chunk. ``best[node, rank]`` is the saturation of the
    subtree's largest tf at its smallest m, ``part[doc, rank]`` a document's."""

    def __init__(self, ranks: list[np.ndarray], tfs: list[np.ndarray], m: np.ndarray, width: int):
        sizes = np.asarray([len(r) for r in ranks])
        self.ranks, self.sizes = np.concatenate(ranks), sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.tfs = np.concatenate(tfs).astype(np.int64)
        row = np.repeat(np.arange(len(ranks)), sizes)
        self.part = np.zeros((len(ranks), width), np.int32)
        self.part[row, self.ranks] = saturation(self.tfs, m[row])
        self.m, self.width = m, width
        self.children: list[np.ndarray | None] = []  # None: a bucket of documents
        self.rows: list[np.ndarray | None] = []
        self._grow()
        del self.ranks, self.tfs

    def _split(self, rows: np.ndarray, depth: int) -> tuple[list[np.ndarray], int]:
        """Rows by their term at ``depth``, or at the first depth where they
        differ; a group in which all vectors have ended comes back alone."""
        while True:
            ended = self.sizes[rows] <= depth
            at = np.where(ended, -1, self.ranks[np.minimum(self.starts[rows] + depth, len(self.ranks) - 1)])
            if (at != at[0]).any():
                break
            if at[0] < 0:
                return [rows], depth
            depth += 1
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        groups, bucket = [], []
        for g in np.split(rows[order], cuts):
            if len(g) >= LEAF:
                groups.append(g)
                continue
            if bucket and sum(map(len, bucket)) + len(g) > LEAF:
                groups.append(np.concatenate(bucket))
                bucket = []
            bucket.append(g)
        if bucket:
            groups.append(np.concatenate(bucket))
        return groups, depth + 1

    def _grow(self) -> None:
        """Nodes in preorder; then maxima and minima from the leaves upwards."""
        waiting: list[tuple[np.ndarray, int, int]] = [(np.arange(len(self.sizes)), 0, -1)]
        parents = []
        while waiting:
            rows, depth, parent = waiting.pop()
            node = len(parents)
            parents.append(parent)
            groups = [rows]
            if len(rows) > LEAF:
                groups, depth = self._split(rows, depth)
            leaf = len(groups) == 1
            self.rows.append(rows if leaf else None)
            if not leaf:
                waiting += [(g, depth, node) for g in groups]
        most = np.zeros((len(parents), self.width), np.int64)
        least = np.full(len(parents), np.iinfo(np.int64).max)
        below: list[list[int]] = [[] for _ in parents]
        for node in range(len(parents) - 1, -1, -1):
            if (rows := self.rows[node]) is not None:
                for r in rows:
                    at = slice(self.starts[r], self.starts[r + 1])
                    most[node, self.ranks[at]] = np.maximum(most[node, self.ranks[at]], self.tfs[at])
                least[node] = self.m[rows].min()
            if (p := parents[node]) >= 0:
                np.maximum(most[p], most[node], out=most[p])
                least[p] = min(least[p], least[node])
                below[p].append(node)
        self.children = [np.asarray(b) if b else None for b in below]
        self.best = saturation(most, least[:, None]).astype(np.int32)

    def search(self, cols: np.ndarray, weights: np.ndarray, top: Top, ids: np.ndarray) -> None:
        """Depth first, the higher bound first, as long as ``top`` may change."""
        stack = [(int(self.best[0, cols] @ weights), 0)]
        while stack:
            bound, node = stack.pop()
            if bound <= 0 or bound < top.least:
                continue
            children = self.children[node]
            if children is None:
                rows = self.rows[node]
                scores = self.part[rows[:, None], cols] @ weights
                top.add(scores, ids[rows])
                continue
            bounds = self.best[children[:, None], cols] @ weights
            up = np.argsort(bounds, kind="stable")
            stack += [(int(bounds[i]), int(children[i])) for i in up if bounds[i] >= top.least]


class Top:
    """The k highest scores above 0, smaller ids first among equals."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        s, i = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((i, -s))[: self.k]
        self.scores, self.ids = s[order], i[order]
        if len(s) >= self.k:
            self.least = int(self.scores[-1])


def _search(batches: Iterator[pa.RecordBatch], items: list, df: np.ndarray, n_docs: int, n_terms: int, k: int, cells: int) -> Iterator[pa.RecordBatch]:
    """(item, doc_id, score): the k best of each item among a task's documents."""
    order = np.lexsort((np.arange(len(df)), -df))  # rank -> term
    rank = np.empty(len(df), np.int64)
    rank[order] = np.arange(len(df))
    weight = np.asarray([term_weight(n_docs, int(d)) if d else 0 for d in df], np.int64)
    asked = []
    for nr, (numbers, times) in enumerate(items):
        there = df[numbers] > 0
        if there.any():
            asked.append((nr, rank[numbers[there]], weight[numbers[there]] * times[there], Top(k)))
    width = int((df > 0).sum())
    limit = max(LEAF, cells // max(width, 1))
    chunk: list[tuple] = []

    def run() -> None:
        ids, ranks, tfs, m = zip(*chunk)
        chunk.clear()
        tree = Tree(list(ranks), list(tfs), np.asarray(m, np.int64), width)
        for _, cols, weights, top in asked:
            tree.search(cols, weights, top, np.asarray(ids, np.int64))

    for b in batches:
        for i, n, places, counts in zip(*(b.column(c).to_pylist() for c in range(4))):
            ranks = rank[np.frombuffer(places, np.uint32)]
            up = np.argsort(ranks)
            chunk.append((NO_ID if i is None else i, ranks[up], np.frombuffer(counts, np.uint32)[up], length_norm(n, n_docs, n_terms)))
            if len(chunk) >= limit:
                run()
    if chunk:
        run()
    for nr, _, _, top in asked:
        ids = pa.array(top.ids, mask=top.ids == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), nr)), ids, pa.array(top.scores)], names=["item", "doc_id", "score"])


def search_block(docs: DataFrame, block: Block, k: int, cells: int) -> DataFrame:
    """item (its place in the block), rank, doc_id, score; ``docs``: doc_id and the text as bytes."""
    spark = docs.sparkSession
    numbers = spark.sparkContext.broadcast(block.numbers)
    made = keep(docs.mapInArrow(lambda it: _restrict(it, numbers.value), RESTRICTED), "restricted-documents")
    counted = made.filter("df IS NOT NULL")
    sums = counted.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    by_term = counted.select("df").mapInArrow(_nonzero, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(block.numbers), np.int64)
    df[by_term["term"].to_numpy()] = by_term["df"].to_numpy()
    n_docs, n_terms = sums["n"] or 0, sums["l"] or 0
    plan = spark.sparkContext.broadcast((block.items, df))
    vectors = made.filter("df IS NULL").select("doc_id", "n", "terms", "tfs")
    found = vectors.mapInArrow(lambda it: _search(it, *plan.value, n_docs, n_terms, k, cells), "item long, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _item_ids(batches: Iterator[pa.RecordBatch], ids: list) -> Iterator[pa.RecordBatch]:
    for b in batches:
        item_id = pa.array([ids[i] for i in b.column(0).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([item_id, *b.columns[1:]], names=["item_id", "rank", "doc_id", "score"])


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES, cells: int = CELLS,
) -> DataFrame:
    """The k best documents of each item: item_id, rank (from 1), doc_id, score."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = "item_id long, rank int, doc_id long, score long"
    out = None
    for block in item_blocks(items, item_id, item_text, block_bytes):
        found = search_block(texts, block, k, cells).select("item", "rank", "doc_id", "score")
        named = found.mapInArrow(lambda it, ids=block.ids: _item_ids(it, ids), kind)
        out = named if out is None else out.unionAll(named)
    return out if out is not None else docs.sparkSession.createDataFrame([], kind)
