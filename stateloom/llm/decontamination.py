"""Benchmark passages in documents, by SimHash fingerprints of item-sized windows.

Words are letters, digits and characters beyond ASCII, without upper case. For each
benchmark item every document has windows of as many words (a shorter document is
one window). A window is a weighted set of five-word shingles: a shingle weighs as
often as it stands there, and the same in every item, so that a pair's similarity
does not depend on other items. Its fingerprint has 64 bits, each the sign of a
weighted vote. Fingerprints are split into eight blocks of a byte; within ``RADIUS``
one block differs by ``RADIUS // 8`` bits at most, so tables of near bytes find every
fingerprint within the radius. Each one found is then compared exactly, by the
weighted Jaccard similarity of both sets.

Windows with too few shingles of items of their size to be similar to any are never
fingerprinted. Fingerprints of similar sets are within the radius but for chance: at a
similarity of 0.8 they differ in ten bits of 64 on average, in more than ``RADIUS`` in about
one of a thousand copies (one word replaced: fewer), whatever the size of the item. The items
are sent to all tasks in blocks of at most ``ITEMS`` items and about ``ITEM_BYTES``
bytes, whatever the size of the table; how they are divided does not change a result.

A null or empty text is clean, an item without words finds nothing, and an item of
fewer than five words is one shingle. Repeated rows are found each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.llm.words import ALNUM, Words, mix, ngram_hashes, pieces

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
ITEMS = 20_000
ITEM_BYTES = 32 << 20
_BLOCKS = 8
_PREFIX = 20  # bits of a shingle's hash in the table that rules out most of them
_SHIFTS = np.arange(64, dtype=np.uint64)

_NEAR = [
    np.flatnonzero([bin(a ^ b).count("1") <= RADIUS // _BLOCKS for b in range(256)]) for a in range(256)
]


def _fingerprints(h: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of windows of consecutive shingles, each [start, start + count) in h."""
    needed = np.zeros(len(h) + 1, np.int64)
    np.add.at(needed, starts, 1)
    np.add.at(needed, starts + counts, -1)
    inside = np.cumsum(needed[:-1]) > 0
    place = np.cumsum(inside) - inside  # windows are inside, so consecutive there too
    g = h[inside]
    votes = np.where((g[:, None] >> _SHIFTS) & np.uint64(1), 1, -1)
    sums = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(votes, axis=0, dtype=np.int64)))
    first = place[starts]
    bits = sums[first + counts] - sums[first] > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


class _Sized:
    """Items of one size: their shingles and the tables of their fingerprints."""

    def __init__(self, words: int, items: list[int], sets: list[np.ndarray]):
        self.words, self.order = words, min(words, SHINGLE)
        self.items = np.array(items)
        self.shingles = np.unique(np.concatenate(sets))
        self.sets = [Counter(s.tolist()) for s in sets]
        flat = np.concatenate(sets)
        starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
        self.prints = _fingerprints(flat, starts, np.array([len(s) for s in sets]))
        blocks = self.prints.view(np.uint8).reshape(-1, _BLOCKS)
        self.tables = []
        for b in range(_BLOCKS):
            near = [_NEAR[x] for x in blocks[:, b]]
            key = np.concatenate(near)
            item = np.repeat(np.arange(len(items)), [len(x) for x in near])
            order = np.argsort(key, kind="stable")
            self.tables.append((np.searchsorted(key[order], np.arange(257)), item[order]))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a window and an item whose fingerprints are within the radius."""
        blocks, codes = prints.view(np.uint8).reshape(-1, _BLOCKS), []
        for b, (bounds, item) in enumerate(self.tables):
            low, n = bounds[blocks[:, b]], np.diff(bounds)[blocks[:, b]]
            at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            codes.append(np.repeat(np.arange(len(prints)), n) * len(self.items) + item[at])
        window, item = np.divmod(np.unique(np.concatenate(codes)), len(self.items))
        near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[near], item[near]


def _least_shared(sizes: np.ndarray | int) -> np.ndarray | int:
    """Shingles that two sets of so many together share at least if they are similar: four ninths."""
    return -(-4 * sizes // 9)


class Index:
    """The items of a benchmark, grouped by their number of words."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids = ids
        words = Words(texts, ALNUM)
        h = words.hashes()
        grouped: dict[int, list] = {}
        for i, n in enumerate(words.counts):
            if n:
                own = h[words.first[i] : words.first[i + 1]]
                grouped.setdefault(int(n), []).append((i, ngram_hashes(own, min(int(n), SHINGLE))))
        every = [s for rows in grouped.values() for _, s in rows]
        self.known = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        self.sized = [_Sized(n, [i for i, _ in rows], [s for _, s in rows]) for n, rows in sorted(grouped.items())]
        self.prefix = np.zeros(1 << _PREFIX, bool)
        self.prefix[self.known >> np.uint64(64 - _PREFIX)] = True

    @staticmethod
    def similarity(window: np.ndarray, item: Counter) -> float:
        both = (Counter(window.tolist()) & item).total()
        return both / (len(window) + item.total() - both)

    def find(self, texts: list[bytes]) -> list[tuple[int, int, int, int, float]]:
        """text, item, first word, words and similarity of the best window of each text and item."""
        words = Words(texts, ALNUM)
        if not len(words) or not len(self.known):
            return []
        h, owner = words.hashes(), words.owner()
        best: dict[tuple[int, int], tuple] = {}
        for order in sorted({s.order for s in self.sized}):
            g = ngram_hashes(h, order)
            if not len(g):
                continue
            whole = owner[: len(g)] == owner[order - 1 :]
            hit = np.flatnonzero(whole & self.prefix[g >> np.uint64(64 - _PREFIX)])
            hit = hit[np.isin(g[hit], self.known)]
            for sized in (s for s in self.sized if s.order == order) if len(hit) else ():
                own = hit[np.isin(g[hit], sized.shingles)]
                if len(own):
                    self._compare(sized, g, words, owner, own, best)
        return [(t, i, *found) for (t, i), found in best.items()]

    def _compare(self, sized: _Sized, g: np.ndarray, words: Words, owner: np.ndarray, hit: np.ndarray, best: dict) -> None:
        """Compare every window of the item size that has enough hits with the items that may be similar."""
        m = sized.words - sized.order + 1
        low, high = words.first[owner[hit]], words.first[owner[hit] + 1] - sized.order  # its text's first and last shingle
        begin = np.maximum(hit - m + 1, low)
        end = np.maximum(np.minimum(hit, high - m + 1), begin)
        n = end - begin + 1
        starts = np.unique(np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum())))
        counts = np.minimum(m, words.first[owner[starts] + 1] - sized.order + 1 - starts)
        hits = np.searchsorted(hit, starts + counts) - np.searchsorted(hit, starts)
        enough = hits >= _least_shared(counts + m)
        starts, counts = starts[enough], counts[enough]
        if not len(starts):
            return
        for w, i in zip(*(x.tolist() for x in sized.within(_fingerprints(g, starts, counts)))):
            start, count = int(starts[w]), int(counts[w])
            similarity = self.similarity(g[start : start + count], sized.sets[i])
            text = int(owner[start])
            key = (text, int(sized.items[i]))
            if similarity >= SIMILARITY and similarity > best.get(key, (0, 0, 0.0))[2]:
                best[key] = (start - int(words.first[text]), count + sized.order - 1, similarity)


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The items in blocks of a bounded size."""
    # An item that is missing or has no text finds nothing.
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    rows, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // ITEMS), -(-size // ITEM_BYTES))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow().sort_by("item_id")
        yield Index(block.column("item_id").to_pylist(), [t.encode() for t in block.column("text").to_pylist()])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that it holds: where the best window is, and how similar."""
    found = None
    for index in _indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches):
                if hits := sent.value.find(texts):
                    at, item, first, words, similarity = zip(*hits)
                    yield pa.record_batch(
                        {
                            "doc_id": batch.column("doc_id").cast(pa.int64()).take(pa.array(at)),
                            "item_id": pa.array([sent.value.ids[i] for i in item], pa.int64()),
                            "first_word": pa.array(first, pa.int64()),
                            "n_words": pa.array(words, pa.int64()),
                            "similarity": pa.array(similarity, pa.float64()),
                        }
                    )

        part = docs.select("doc_id", "text").mapInArrow(
            search, "doc_id long, item_id long, first_word long, n_words long, similarity double"
        )
        found = part if found is None else found.union(part)
    return found


def without_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    for index in _indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches):
                clean = np.ones(len(texts), bool)
                clean[[hit[0] for hit in sent.value.find(texts)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
