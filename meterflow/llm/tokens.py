"""Token ids from a public tokenizer, one bounded cache per Python worker.

A text is cut before every white-space character that follows a
non-white-space one. Both tokenizers used here split there themselves before
any merge, so the ids of the text are the ids of its pieces put together, and
equal pieces are encoded once; the punctuation that ends a piece is a piece of
its own. Arrow cuts a batch's texts and finds its distinct pieces. New pieces are encoded together as one text;
the tokens' byte lengths tell which ids belong to which piece, and a batch
whose lengths do not add up is encoded piece by piece. Texts where the cut is
not certain (a special token's opening ``<|``, the control characters that
only some regex engines count as white space) are encoded whole.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import string
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute

END_OF_DOCUMENT = 2
_RUN = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{3}"
_ALNUM = np.isin(np.arange(256), np.frombuffer((string.ascii_letters + string.digits).encode(), np.uint8))
_PIECE = re.compile(r"\s*\S+|\s+\Z")
_UNSURE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
#: characters a piece may have on average before the caches turn over early
PIECE_BYTES = 16
_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary ``name`` is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _strings(values: pa.Array) -> list[str]:
    """As ``to_pylist``, without a scalar for each."""
    return values.to_numpy(zero_copy_only=False).tolist()


def unsure(text: str) -> bool:
    return any(s in text for s in _UNSURE)


class PieceEncoder:
    """Encodes texts as little-endian uint32 bytes."""

    def __init__(self, path: str, max_pieces: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_pieces = max_pieces
        #: piece -> ids, of pieces seen lately and of those seen before that
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: characters of the pieces known
        self.held = 0
        #: punctuation at pieces' ends -> ids
        self.tails: dict[str, bytes] = {}
        vocab = self.tokenizer.get_vocab()
        self.word_ends = any(t.endswith("</w>") for t in list(vocab)[:5000])
        self.id_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():  # one character a byte in byte-level vocabularies
            self.id_bytes[i] = len(token.removesuffix("</w>") if self.word_ends else token)
        self.line_end = self._direct(["\n"])[0]

    def _direct(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in got]

    def _n_bytes(self, piece: str) -> int:
        if self.word_ends:
            if piece.isascii():  # neither case nor normal form changes the length
                return sum(map(len, piece.split()))
            piece = "".join(unicodedata.normalize("NFC", piece).lower().split())
        return len(piece.encode())

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with white space, encoded as one text."""
        ids = np.asarray(self.tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.cumsum([self._n_bytes(p) for p in pieces])
        at = np.cumsum(self.id_bytes[ids])
        cut = np.searchsorted(at, ends, side="left")
        if len(ids) == 0 or at[-1] != ends[-1] or not np.array_equal(at[np.minimum(cut, len(at) - 1)], ends):
            return self._direct(pieces)
        data, stop = ids.tobytes(), ((cut + 1) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *stop], stop)]

    def _learn(self, stems: list[str]) -> list[bytes]:
        """The ids of each of ``stems``, none of them empty."""
        if len(self.known) > self.max_pieces // 2 or self.held > self.max_pieces // 2 * PIECE_BYTES:
            self.older, self.known, self.held = self.known, {}, 0
        known, older = self.known, self.older
        got = list(map(known.get, stems))
        if None not in got:
            return got
        lacking = [i for i, ids in enumerate(got) if ids is None]
        todo = {stems[i] for i in lacking}
        if older:
            found = todo.intersection(older)
            known.update((p, older[p]) for p in found)
            todo -= found
            self.held += sum(map(len, found))
        self.held += sum(map(len, todo))
        new = list(todo)
        for i in range(0, len(new), 5000):
            part = new[i : i + 5000]
            known.update(zip(part, self._pieces([p if p[0] == "\n" else f" {p}" for p in part])))
        for i in lacking:
            got[i] = known[stems[i]]
        return got

    def _values(self, pieces: pa.Array) -> list[bytes]:
        """The ids of each of the distinct ``pieces``, none of them empty. ASCII
        punctuation after a last ASCII letter or digit is encoded apart, as both
        tokenizers split there whatever it is."""
        if self.word_ends:  # as the tokenizer does, so that cases share a piece
            pieces = pa.compute.if_else(pa.compute.string_is_ascii(pieces), pa.compute.ascii_lower(pieces), pieces)
        stems = pa.compute.ascii_rtrim(pieces, characters=string.punctuation)
        ends = np.frombuffer(stems.buffers()[1], "<i8")[stems.offset : stems.offset + len(stems) + 1]
        raw = np.frombuffer(stems.buffers()[2] or b"\0", np.uint8)
        apart = (np.diff(ends) > 0) & _ALNUM[raw[np.maximum(ends[1:], 1) - 1]]
        sizes = pa.compute.binary_length(stems).to_numpy()
        apart &= sizes < pa.compute.binary_length(pieces).to_numpy()
        out = self._learn(_strings(pa.compute.if_else(pa.array(apart), stems, pieces)))
        tails, at = self.tails, np.flatnonzero(apart)
        for i, piece in zip(at.tolist(), _strings(pieces.take(pa.array(at)))):
            tail = piece[len(piece.rstrip(string.punctuation)) :]
            if tail not in tails:
                if len(tails) > 10_000:
                    tails.clear()
                tails[tail] = self._direct([tail])[0]
            out[i] += tails[tail]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. A cache key is a piece without the single
        space before it and the punctuation after it; pieces that begin with a
        line end stand as they are, and a text's first piece as after one."""
        out: list[bytes] = [b""] * len(texts)
        odd = self._odd(texts)
        plain = [i for i, o in enumerate(odd) if not o]
        if self.word_ends:
            spread = [texts[i].replace("\n", " ") for i in plain]
        else:
            spread = ["\n" + texts[i].replace("\n", " \n") for i in plain]
        if plain:
            split = pa.compute.split_pattern(pa.array(spread, pa.large_string()), " ")
            words = split.flatten().dictionary_encode()
            pieces = words.dictionary
            if self.word_ends:  # pieces of no characters have no ids
                some = pa.compute.binary_length(pieces).to_numpy() > 0
                made = iter(self._values(pieces.filter(pa.array(some))))
                values = [next(made) if s else b"" for s in some.tolist()]
            else:
                values = self._values(pieces)
            ids = pa.array(values, pa.large_binary()).take(words.indices)
            ends = np.frombuffer(ids.buffers()[1], "<i8")[ids.offset : ids.offset + len(ids) + 1]
            stops = ends[split.offsets.to_numpy()].tolist()
            data, skip = memoryview(ids.buffers()[2] or b""), 0 if self.word_ends else len(self.line_end)
            for i, a, b in zip(plain, stops, stops[1:]):
                out[i] = bytes(data[a + skip : b])
        rest = [i for i, o in enumerate(odd) if o]
        for i, ids in zip(rest, self._rest([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _odd(self, texts: list[str]) -> list[bool]:
        """Whether a text's white space is unusual, or a cut not certain."""
        if self.word_ends:  # white space has no ids
            return [unsure(t) for t in texts]
        # of three white-space characters the first two are one piece to the tokenizer
        runs = pa.compute.match_substring_regex(pa.array(texts, pa.large_string()), _RUN).to_pylist()
        return [run or not t or "  " in t or " \n" in t or t[0].isspace() or t[-1].isspace() or unsure(t) for run, t in zip(runs, texts)]

    def _rest(self, texts: list[str]) -> list[bytes]:
        """Texts cut by the general pattern, or not at all."""
        odd = [None if unsure(t) else _PIECE.findall(t) for t in texts]
        todo = list(dict.fromkeys([t for t, ps in zip(texts, odd) if ps is None] + [p for ps in odd if ps for p in ps]))
        got = dict(zip(todo, self._direct(todo)))
        return [got[t] if ps is None else b"".join(map(got.__getitem__, ps)) for t, ps in zip(texts, odd)]


def encoder(path: str, max_pieces: int = 1_200_000) -> PieceEncoder:
    """The worker's encoder for a vocabulary file."""
    key = (path, max_pieces)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, max_pieces)
    return _ENCODERS[key]


def release() -> None:
    """Drop this worker's encoders: for work of another kind in a worker that a
    tokenising query has used before. The memory goes back to the system."""
    if not _ENCODERS:
        return
    _ENCODERS.clear()
    trim()


def trim() -> None:
    """Give memory that the worker's earlier work has freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it is returned in time
        pass


def trimmed(step):
    """``step`` for mapInArrow, after which a worker keeps no freed memory: what
    several kinds of work leave in one worker adds up otherwise."""

    def run(batches):
        yield from step(batches)
        trim()

    return run


def chunks(texts: list, max_texts: int = 1000, max_chars: int = 4_000_000):
    """Index ranges of ``texts`` with bounded count and size (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and (i - start >= max_texts or size + n > max_chars):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
