"""Token counts of byte-level BPE, by merging many words at once in numpy arrays.

A text is split into special strings and pre-tokens by the tokenizer's own pattern.
The pre-tokens a worker has not met yet are laid one behind the other in ragged
arrays of symbols. In each round every pre-token finds the lowest rank among its
pairs of neighbours, and all its pairs of that rank are merged, from left to right,
in all pre-tokens simultaneously; those without a ranked pair are done. What survives
is counted. A merged symbol only takes part in pairs of higher rank, so the order is
that of the tokenizer.

A null or empty text has no tokens. Rows are counted one by one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.llm.words import pieces

LIMIT = 512
#: Different pre-tokens whose counts a worker keeps; texts' pre-tokens are merged in runs of so many bytes.
KEPT = 300_000
RUN_BYTES = 4 << 20
#: The pattern of the tokenizer's pre-tokens (a fixed value of byte-level BPE).
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Merges:
    """Ranks of pairs of symbols, from a tokenizer's file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocabulary = data["model"]["vocab"]
        self.special = [t["content"] for t in data["added_tokens"]]
        self.width = max(max(vocabulary.values()), *(t["id"] for t in data["added_tokens"])) + 1
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in _byte_letters().items():
            self.of_byte[byte] = vocabulary[letter]
        pairs = [(m.split(" ") if isinstance(m, str) else m) for m in data["model"]["merges"]]
        left, right, merged = (
            np.array([vocabulary[x] for x in side], np.int64)
            for side in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs])
        )
        key = left * self.width + right
        order = np.argsort(key)
        self.keys, self.ranks, self.merged = key[order], order, merged[order]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (the number of merges if it has none) and its place in the table."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys)), at

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols that are left of each of some words."""
        out = np.array([len(w) for w in words], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), out)
        none = len(self.keys)
        rank, at = self._rank(symbols[:-1], symbols[1:])
        rank = np.append(np.where(owner[1:] == owner[:-1], rank, none), none)
        at = np.append(at, 0)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(least, sizes)
            out[owner[starts]] = sizes
            alive = best < none
            if not alive.all():  # a word is done as a whole
                symbols, owner, rank, at, best = (x[alive] for x in (symbols, owner, rank, at, best))
                if not len(symbols):
                    break
            hit = rank == best
            # Of overlapping pairs (aaa) every other one, from the left of each row of them.
            place = np.arange(len(hit))
            row = np.maximum.accumulate(np.where(hit & ~np.concatenate(([False], hit[:-1])), place, 0))
            hit &= (place - row) % 2 == 0
            first = np.flatnonzero(hit)
            symbols[first] = self.merged[at[first]]
            stay = np.ones(len(symbols), bool)
            stay[first + 1] = False
            symbols, owner, rank, at = (x[stay] for x in (symbols, owner, rank, at))
            # Only pairs beside a merged symbol change.
            new = np.flatnonzero(hit[stay])
            new = np.unique(np.concatenate((new, new[new > 0] - 1)))
            inner = new[new + 1 < len(symbols)]
            inner = inner[owner[inner] == owner[inner + 1]]
            rank[new] = none
            rank[inner], at[inner] = self._rank(symbols[inner], symbols[inner + 1])
        return out


class Counter:
    """Tokens of whole texts; remembers the counts of pre-tokens it has met."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.known: dict[str, int] = {}
        self.special = regex.compile("|".join(regex.escape(s) for s in self.merges.special)) if self.merges.special else None

    def _learn(self, words: list[str]) -> None:
        run: list[str] = []
        size = 0
        for word in [*words, None]:
            if run and (word is None or size > RUN_BYTES):
                self.known.update(zip(run, self.merges.count([w.encode() for w in run]).tolist()))
                run, size = [], 0
            if word is not None:
                run.append(word)
                size += len(word)

    def count(self, texts: list[bytes]) -> list[int]:
        words: list[list[str]] = []
        extra = []
        for raw in texts:
            text = raw.decode()
            if self.special is not None and (found := self.special.findall(text)):
                own = [w for part in self.special.split(text) for w in _PATTERN.findall(part)]
                extra.append(len(found))
            else:
                own = _PATTERN.findall(text)
                extra.append(0)
            words.append(own)
        different = set().union(*words)
        new = different.difference(self.known)
        if len(self.known) + len(new) > KEPT:
            self.known = {}
            new = different
        self._learn(sorted(new))
        get = self.known.__getitem__
        return [sum(map(get, own)) + more for own, more in zip(words, extra)]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch, texts in pieces(batches):
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                    "n_tokens": pa.array(counter.count(texts), pa.int64()),
                }
            )

    counted = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
