"""Token ids in fixed-width bit-packed files.

Every id takes the minimum number of bits of the vocabulary. A file holds a
run of documents in ascending id order:

    magic | blocks | block offsets | document ids, null marks, starts | trailer

A block packs ``block_tokens`` ids (the last one fewer), lowest bit first, and
ends on a whole byte; the block offsets (uint64, one more than blocks) lead to
any block, which numpy unpacks at once, so a token range is read without the
rest of the file. All numbers are little-endian.

Documents are range-partitioned by id and sorted, each task writes files of
its range into the shared folder under names of its own attempt, and Spark
writes the manifest of the files that count. A lost task writes new files; its
old ones are in no manifest. Where a file's tokens start among all tokens is
the running sum over the manifest.

Defined results: a null text is empty and gives the end id alone. Rows that
share an id follow each other by the hash of their text. A null id comes
first. Other columns are not written. An empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, shared_path, ship
from .tokens import END_OF_DOCUMENT, chunks, encoder, tokenizer_path

MAGIC = b"TOKPACK1"
TRAILER = struct.Struct("<IIQQQ")
BLOCK_TOKENS = 1 << 16
FILE_TOKENS = 1 << 26


def bits_for(vocab_size: int) -> int:
    """Bits that hold every id below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    flat = np.unpackbits(rows, axis=1, bitorder="little")[:, :bits].reshape(-1)
    return np.packbits(flat, bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    """``n`` ids (uint32) of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    full = np.zeros((n, 32), np.uint8)
    full[:, :bits] = flat
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or path, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class TokenFileWriter:
    """Writes one file; ``add`` documents, then ``close``."""

    def __init__(self, path: str, bits: int, block_tokens: int = BLOCK_TOKENS):
        self.fs, inner = open_fs(path)
        self.bits, self.block_tokens = bits, block_tokens
        self.out = self.fs.open_output_stream(inner)
        self.out.write(MAGIC)
        self.offsets, self.ids, self.nulls, self.starts = [len(MAGIC)], [], [], [0]
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(tokens))
        self.waiting.append(tokens)
        self.n_waiting += len(tokens)
        if self.n_waiting >= self.block_tokens:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        whole = len(ids) if last else len(ids) - len(ids) % self.block_tokens
        for i in range(0, whole, self.block_tokens):
            data = pack_bits(ids[i : min(i + self.block_tokens, whole)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.waiting = [ids[whole:]]
        self.n_waiting = len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        for values, kind in ((self.offsets, "<u8"), (self.ids, "<i8"), (self.nulls, "u1"), (self.starts, "<u8")):
            self.out.write(np.asarray(values, dtype=kind).tobytes())
        self.out.write(TRAILER.pack(self.bits, self.block_tokens, len(self.offsets) - 1, len(self.ids), self.starts[-1]) + MAGIC)
        self.out.close()


class TokenFile:
    """Reads a file: its index at once, tokens by block."""

    def __init__(self, path: str):
        filesystem, inner = open_fs(path)
        self.f = filesystem.open_input_file(inner)
        size, tail = self.f.size(), TRAILER.size + len(MAGIC)
        self.f.seek(size - tail)
        end = self.f.read(tail)
        if end[TRAILER.size :] != MAGIC:
            raise ValueError(f"not a whole token file: {path}")
        self.bits, self.block_tokens, n_blocks, n_docs, self.n_tokens = TRAILER.unpack(end[: TRAILER.size])
        n_index = 8 * (n_blocks + 1) + 9 * n_docs + 8 * (n_docs + 1)
        self.f.seek(size - tail - n_index)
        index, at = self.f.read(n_index), 0
        parts = []
        for kind, n in (("<u8", n_blocks + 1), ("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs + 1)):
            parts.append(np.frombuffer(index, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.offsets, ids, nulls, self.starts = parts
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, nulls)]

    def block(self, k: int) -> np.ndarray:
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        self.f.seek(a)
        return unpack_bits(self.f.read(b - a), self.bits, min(self.block_tokens, self.n_tokens - k * self.block_tokens))

    def tokens(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` to ``stop``, block by block."""
        for k in range(start // self.block_tokens, -(-stop // self.block_tokens)):
            low = k * self.block_tokens
            yield self.block(k)[max(0, start - low) : stop - low]


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, bits: int, end_id: int, file_tokens: int) -> Iterator[pa.RecordBatch]:
    task, enc, writer, rows = TaskContext.get().partitionId(), encoder(tokenizer), None, []
    end = np.asarray([end_id], "<u4").tobytes()

    def finish():
        writer.close()
        rows.append((task, len(rows), path, len(writer.ids), writer.starts[-1]))

    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for i, j in chunks(texts):
            for doc, data in zip(ids[i:j], enc.encode([t or "" for t in texts[i:j]])):
                if writer is None:
                    path = f"{folder}/{task:06d}-{len(rows):04d}-{uuid.uuid4().hex}.tok"
                    writer = TokenFileWriter(path, bits)
                writer.add(doc, np.frombuffer(data + end, "<u4"))
                if writer.starts[-1] >= file_tokens:
                    finish()
                    writer = None
    if writer is not None:
        finish()
    if rows:
        cols = list(zip(*rows))
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["part", "seq", "path", "n_docs", "n_tokens"])


def write_token_files(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_OF_DOCUMENT,
    folder: str | None = None,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode and write all documents; the manifest: part, seq, path, n_docs,
    n_tokens, start (tokens in the files before)."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    bits = bits_for(max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1))
    folder = folder or shared_path(spark, "token-files")
    filesystem, inner = open_fs(folder)
    filesystem.create_dir(inner, recursive=True)
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "text")
    )
    written = ordered.mapInArrow(
        lambda it: _write(it, folder, path, bits, end_id, file_tokens),
        "part int, seq int, path string, n_docs long, n_tokens long",
    )
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return keep(written, "token-manifest").withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            f = TokenFile(path)
            n = len(f.doc_ids)
            crcs, doc, low = [0] * n, 0, 0
            for k in range(len(f.offsets) - 1):
                data, high = f.block(k).tobytes(), min(low + f.block_tokens, f.n_tokens)
                while doc < n:
                    a, z = int(f.starts[doc]), int(f.starts[doc + 1])
                    crcs[doc] = zlib.crc32(data[4 * (max(a, low) - low) : 4 * (min(z, high) - low)], crcs[doc])
                    if z > high:
                        break
                    doc += 1
                    if z == high:
                        break
                low = high
            starts = f.starts[:-1].astype(np.int64) + base
            yield pa.RecordBatch.from_arrays(
                [pa.array(f.doc_ids, pa.int64()), pa.array(starts), pa.array(np.diff(f.starts.astype(np.int64))), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_token_index(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = manifest.select("path", "start")
    n = max(1, manifest.count())
    return files.repartition(n, "path").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
