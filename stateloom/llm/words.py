"""Words of many texts at once, as numpy arrays over one UTF-8 buffer.

All operators that look at words share this module. Texts are joined with a line
feed before, between and behind them, which is neither part of a word nor of a
token, so that no word spans two texts. Every byte of a multi-byte character is
at least 0x80 and belongs to a word, which makes byte and character classes agree.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once. A longer text is handled alone, and whole.
PIECE_BYTES = 2 << 20
#: Texts handled at once, so that 16 bits always name one of them.
PIECE_ROWS = 32_768

_BYTES = np.arange(256)
#: Fixed classes: letters, digits and everything beyond ASCII; everything but white space.
ALNUM = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
TOKEN = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_RANDOM = np.random.default_rng(20_261_201).integers(0, 2**64, 256 + 16, dtype=np.uint64)
_VALUE = _RANDOM[:256]
#: One odd factor for each place in an n-gram.
_PLACE = _RANDOM[256:] | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_LOW_BITS = 12


def _steps(base: int, n: int) -> np.ndarray:
    """The first n powers of a base modulo 2**64."""
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(_BASE, -1, 2**64)
#: Powers of the base and of its inverse with exponents below 2 ** _LOW_BITS; larger ones are products.
_SMALL, _SMALL_INVERSE = (_steps(b, 1 << _LOW_BITS) for b in (_BASE, _INVERSE))


def _scaled(values: np.ndarray) -> np.ndarray:
    """Values times the power of the base of their place, with zeros behind them up to a full row of powers."""
    rows = -(-len(values) >> _LOW_BITS) or 1
    out = np.zeros(rows << _LOW_BITS, np.uint64)
    out[: len(values)] = values
    table = out.reshape(rows, -1)
    table *= _SMALL
    table *= _steps(pow(_BASE, 1 << _LOW_BITS, 2**64), rows)[:, None]
    return out


def powers(n: int) -> np.ndarray:
    """The first n powers of the base modulo 2**64."""
    return _scaled(np.ones(n, np.uint64))[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a 64-bit hash."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of some texts: where they start and end, of which text they are, and their hashes."""

    def __init__(self, texts: list[bytes], kind: np.ndarray = TOKEN, lower: bool = True):
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_starts = np.concatenate(([1], 1 + np.cumsum(sizes)))
        joined = b"\n" + b"\n".join(texts) + b"\n"
        self.buffer = joined.translate(_LOWER) if lower else joined
        self.bytes = np.frombuffer(self.buffer, np.uint8)
        inside = kind[self.bytes]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        #: The words of text i are first[i] to first[i + 1].
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        sums = _scaled(_VALUE[self.bytes])
        np.cumsum(sums, out=sums)
        h = sums[self.ends - 1] - sums[self.starts - 1]
        h *= _SMALL_INVERSE[self.starts & ((1 << _LOW_BITS) - 1)]
        h *= _steps(pow(_INVERSE, 1 << _LOW_BITS, 2**64), (len(sums) >> _LOW_BITS) + 1)[self.starts >> _LOW_BITS]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]]


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each place at which n words start, without regard to the texts' ends."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    m = len(h) - n + 1
    out = h[:m] * _PLACE[0]
    for k in range(1, n):
        out += h[k : k + m] * _PLACE[k]
    return mix(out)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and texts of all n-word shingles; a text of fewer words has one of all its words."""
    h = words.hashes()
    grams = ngram_hashes(h, n)
    full = np.maximum(words.counts - n + 1, 0)
    total = int(full.sum())
    owner = np.repeat(np.arange(len(full)), full)
    starts = np.repeat(words.first[:-1] - np.concatenate(([0], np.cumsum(full)[:-1])), full) + np.arange(total)
    grams = grams[starts] if total else np.zeros(0, np.uint64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = words.counts[short] > k
            extra[has] += h[words.first[short[has]] + k] * _PLACE[k]
        grams = np.concatenate((grams, mix(extra ^ np.uint64(0xA5A5A5A5))))
        owner = np.concatenate((owner, short))
    return grams, owner


def give_back() -> None:
    """Return unused memory to the system: workers live on between tasks, several on a machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def column_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 of each text; a null is empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def pieces(
    batches: Iterable[pa.RecordBatch], text: str = "text", most: int | None = None
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts, of ``most`` bytes and ``PIECE_ROWS`` at most, or of one longer text."""
    most = most or PIECE_BYTES
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        begin = size = 0
        for i, n in enumerate(sizes.tolist()):
            if size and (size + n > most or i - begin >= PIECE_ROWS):
                yield batch.slice(begin, i - begin), column_bytes(column.slice(begin, i - begin))
                begin, size = i, 0
            size += n + 1
        if batch.num_rows:
            yield batch.slice(begin), column_bytes(column.slice(begin))
        del batch, column
    give_back()
