"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared by their words, lower-cased and joined by single
spaces. An item of n such characters may differ by k = floor(max_edit * n)
edits. It is split into k + 1 pieces: k edits leave at least one piece whole,
so every occurrence holds an exact piece hit at its place. All pieces are found
in one pass over the whole text (Aho-Corasick), and around each hit the item
is verified with Myers' bit-parallel distance, an exact occurrence first.

The benchmark is the asked set: it is read in blocks of at most about
``block_chars`` characters, each sent to the executors on its own, and all
documents are read against each block.

Items of fewer than ``min_chars`` characters are searched without edits, between
word borders (an ideograph or kana is a word), and their rows are marked
``short``: they may occur by chance, so ``drop_leaks`` drops a text for one only
where it makes up a whole line.

Defined results: null or empty texts hold nothing, nor do items without a word. Repeated
items each give their rows; repeated rows of documents each give theirs; null
ids are carried as they are. Other columns are not read by ``find_leaks`` and
pass through ``drop_leaks`` whatever their names. Empty tables leak nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

MAX_EDIT = 0.06
MIN_CHARS = 30
BLOCK_CHARS = 1_000_000
_WORD = re.compile(r"\w+")


#: characters of scripts written without spaces between words
_UNSPACED = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")


def borders(text: str, start: int, end: int) -> bool:
    """Whether words end before ``start`` and at ``end`` of a normal text."""

    def parted(a: str, b: str) -> bool:
        return a == " " or b == " " or bool(_UNSPACED.match(a) or _UNSPACED.match(b))

    return (start == 0 or parted(text[start - 1], text[start])) and (end == len(text) or parted(text[end - 1], text[end]))


def normal(text: str | None) -> str:
    return " ".join(_WORD.findall((text or "").lower()))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``item`` in k + 1 pieces of nearly equal length, with their places."""
    n = len(item)
    cuts = [i * n // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the item to any part of ``text``, and where the
    first such part ends."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, j + 1
        ph <<= 1
        pv = (mh << 1 | ~(xv | ph)) & full
        mv = ph & xv
    return best, end


class LeakFinder:
    """Finds a block of items, (item_id, text) pairs, in texts."""

    def __init__(self, items: list[tuple[int, str]], max_edit: float, min_chars: int):
        import ahocorasick

        self.auto, self.items = ahocorasick.Automaton(), []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            t = normal(text)
            if not t:
                continue
            short = len(t) < min_chars
            k = 0 if short else int(max_edit * len(t))
            for a, p in pieces(t, k):
                where.setdefault(p, []).append((len(self.items), a))
            self.items.append((item_id, t, k, masks(t), short))
        for p, v in where.items():
            self.auto.add_word(p, (len(p), v))
        if where:
            self.auto.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int, bool]]:
        """(item_id, edits, start, end, short) of each item in the text, at its
        best place, by characters of the normal text."""
        found = self._places(text)
        return [(self.items[nr][0], *v, self.items[nr][4]) for nr, v in sorted(found.items())]

    def leaks(self, text: str | None) -> bool:
        """Whether the text holds an item, a short one as a whole line."""
        found = self._places(text)
        if any(not self.items[nr][4] for nr in found):
            return True
        return bool(found) and not {self.items[nr][1] for nr in found}.isdisjoint(map(normal, text.split("\n")))

    def _places(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        t = normal(text)
        found: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, list[int]] = {}
        if not t or not self.items:
            return found
        for last, (n, places) in self.auto.iter(t):
            for nr, a in places:
                if found.get(nr, (1,))[0] == 0:
                    continue
                _, item, k, peq, short = self.items[nr]
                start = last + 1 - n - a
                if short and not borders(t, start, last + 1):
                    continue
                if t.startswith(item, max(start, 0)):
                    found[nr] = (0, start, start + len(item))
                    continue
                if start in tried.setdefault(nr, []):
                    continue
                tried[nr].append(start)
                low = max(0, start - k)
                edits, end = myers(peq, len(item), t[low : start + len(item) + k])
                if edits <= min(k, found.get(nr, (k,))[0]):
                    found[nr] = (edits, max(0, low + end - len(item)), low + end)
        return found


def _item_blocks(benchmark: DataFrame, block_chars: int, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The benchmark, a block at a time."""
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).filter("t IS NOT NULL")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // block_chars)
    for b in range(n):
        block = items.filter(F.pmod(F.xxhash64("t"), F.lit(n)) == b)
        yield sorted(((r["i"], r["t"]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _leaks(batches: Iterator[pa.RecordBatch], items: list, max_edit: float, min_chars: int) -> Iterator[pa.RecordBatch]:
    finder = LeakFinder(items, max_edit, min_chars)
    names = ["doc_id", "item_id", "edits", "start", "end", "short"]
    for b in batches:
        rows = [(i, *f) for i, t in zip(b.column(0).to_pylist(), b.column(1)) for f in finder.find(t.as_py())]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.bool_())], names=names)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_edit: float = MAX_EDIT, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document and item in it: doc_id, item_id, edits, start, end, short."""
    ship(docs.sparkSession)
    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = "doc_id long, item_id long, edits long, start long, end long, short boolean"
    out = None
    for items in _item_blocks(benchmark, block_chars, item_id, item_text):
        got = only.mapInArrow(lambda it, items=items: _leaks(it, items, max_edit, min_chars), kind)
        out = got if out is None else out.unionAll(got)
    return out if out is not None else docs.sparkSession.createDataFrame([], kind)


def _clean(batches: Iterator[pa.RecordBatch], at: int, items: list, max_edit: float, min_chars: int) -> Iterator[pa.RecordBatch]:
    finder = LeakFinder(items, max_edit, min_chars)
    for b in batches:
        yield b.filter(pa.array([not finder.leaks(t.as_py()) for t in b.column(at)], pa.bool_()))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_edit: float = MAX_EDIT, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that hold an item; no shuffle."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)
    for items in _item_blocks(benchmark, block_chars, item_id, item_text):
        docs = docs.mapInArrow(lambda it, items=items: _clean(it, at, items, max_edit, min_chars), docs.schema)
    return docs
