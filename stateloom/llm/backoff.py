"""Language-model scores by a backoff automaton over n-grams of up to three words.

Every n-gram of the training documents counts, also those seen once. The model is
interpolated by absolute discounting: the weight of a word after two others is what a
discount leaves of its count, and beyond that what the two words leave over times the
weight after one word, which is made in the same way from the word's share of all tokens.
Words never seen before a word leave everything over.

Counts travel packed. A task cuts its texts into slices of tokens and makes a trie of
each: every token begins one triple of words, so that the counts of triples are the
leaves, and pairs and words their sums. A trie goes to the buckets of its first words as
sorted hashes, five bytes for a second or third word. A bucket adds up what all slices
sent, counts how many different words follow each word and pair, and answers each
slice in the order in which it asked. A word so frequent that its n-grams would not fit
one bucket goes to several, by its second words, and its sums are added afterwards.

With its answers a slice builds an automaton of its own n-grams. A state is what was read
last, two words, one or none; an arc is an n-gram that the training documents hold, and
a failure arc leads from a state to the shorter one at the weight it leaves over. The
texts are read from left to right with their state, all at once, a token of each at a
time; very long ones in stretches that begin two tokens early, where the state is the same.

The texts are read twice, to ask and to be scored, and the slices have to be the same
ones: a digest goes with each, and a difference is an error. Documents that come out of
a shuffle are stored first.

A text is its words, split at ASCII white space and without upper case, and one end.
A null or empty text is an end alone. Rows are scored one by one, by a number given
in the pass over the texts. Without training documents N and V are 0 and every token
has the share 1. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.llm.labelled import crc_mod
from stateloom.llm.storage import stored
from stateloom.llm.words import Words, mix, pieces
from stateloom.sources.files import shared_dir

DISCOUNT = 0.75
ADDED = 0.1
#: Tokens of a slice; a longer text is cut.
SLICE = 1 << 20
#: Tokens of which a bucket holds the n-grams, about; beyond it a word goes to several buckets.
BUCKET = 1 << 21
#: Tokens of a text that are read in one go.
STRETCH = 4096
#: Bytes of text for a token, to choose the number of buckets by.
TOKEN_BYTES = 6
END = np.uint64(0x454E44)  # the hash of the end token
#: What stands for a word behind the end, as a number within a slice and as a hash of 40 bits.
_BITS = 21
_NONE = (1 << _BITS) - 1
_NO_HASH = (1 << 40) - 1
_SHORT = np.uint64(24)  # what a hash of 64 bits loses as a second or third word

_COLUMNS = "bucket long, slice long, body binary, n long, v long, word long, c1 long, after1 long"


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers by planes of bytes, as many as the largest needs, compressed together."""
    return next(_packed_parts(arrays, [[len(a)] for a in arrays]))


def _packed_parts(arrays: Sequence[np.ndarray], sizes: Sequence[Sequence[int]]) -> Iterator[bytes]:
    """Each part packed alone; ``sizes`` has for each array how many of its numbers each part takes, in order.

    There are as many parts as slices times buckets, so that what is done for each has to be little.
    """
    packer, planes = zstandard.ZstdCompressor(level=1), []
    for a in arrays:
        a = np.ascontiguousarray(a).astype(np.uint64)
        width = (int(a.max(initial=0)).bit_length() + 7) // 8
        planes.append(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T))
    widths = [len(x).to_bytes(1, "little") for x in planes]
    begins = [0] * len(planes)
    for part in zip(*(np.asarray(n).tolist() for n in sizes), strict=True):
        out = [len(planes).to_bytes(1, "little")]
        for k, n in enumerate(part):
            out += n.to_bytes(8, "little"), widths[k], planes[k][:, begins[k] : begins[k] + n].tobytes()
            begins[k] += n
        yield packer.compress(b"".join(out))


def _unpacked(body: bytes) -> list[np.ndarray]:
    return _unpacked_parts([body])[0]


def _unpacked_parts(bodies: Sequence[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """The arrays of all parts, one part behind the other; and of each array, how many numbers each part has."""
    unpacker = zstandard.ZstdDecompressor()
    data = [unpacker.decompress(body) for body in bodies]
    sizes = np.zeros((data[0][0], len(data)), np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]  # of each array and part: where it is, its numbers, bytes of one
    for part in data:
        at = 1
        for places in found:
            n, width = int.from_bytes(part[at : at + 8], "little"), part[at + 8]
            places.append((at + 9, n, width))
            at += 9 + n * width
    out = []
    for places, size in zip(found, sizes):
        size[:] = [n for _, n, _ in places]
        full, begin = np.zeros((int(size.sum()), 8), np.uint8), 0
        for part, (at, n, width) in zip(data, places):
            if n * width:
                full[begin : begin + n, :width] = np.frombuffer(part, np.uint8, n * width, at).reshape(width, n).T
            begin += n
        out.append(full.reshape(-1).view(np.uint64))
    return out, sizes


@dataclass
class Slice:
    """Tokens of some texts, or of a part of one with two tokens more on each side."""

    number: int
    rows: np.ndarray  # of each text: its row's number, and what follows
    doc_ids: list
    held: np.ndarray
    sizes: np.ndarray  # tokens of each text here
    before: int  # tokens at the beginning and at the end that belong to other slices
    behind: int
    words: np.ndarray  # the different hashes, sorted
    ids: np.ndarray  # each token as a place among them

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def body(self) -> bytes:
        return _packed(self.rows, self.held, self.sizes, np.array([self.before, self.behind]), self.words, self.ids)

    @classmethod
    def of(cls, number: int, doc_ids: list, body: bytes) -> "Slice":
        rows, held, sizes, cut, words, ids = _unpacked(body)
        sizes, ids = sizes.astype(np.int64), ids.astype(np.int64)
        return cls(number, rows.astype(np.int64), doc_ids, held.astype(bool), sizes, int(cut[0]), int(cut[1]), words, ids)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end behind the words of each text, and how many tokens each text has."""
    words = Words(texts)
    sizes = words.counts + 1
    h = np.full(int(sizes.sum()), END)
    inner = np.ones(len(h), bool)
    inner[np.cumsum(sizes) - 1] = False
    h[inner] = words.hashes()
    return h, sizes


def _numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of words, sorted, and the place of each hash among them; only what differs is sorted."""
    coded = pa.array(h).dictionary_encode()
    words = coded.dictionary.to_numpy()
    order = np.argsort(words)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return words[order], place[coded.indices.to_numpy()]


def slices(batches: Iterable[pa.RecordBatch], partition: int) -> Iterator[Slice]:
    """The slices of a partition, in order."""
    number, row = partition << 33, partition << 33
    parts: list[tuple] = []
    held_back = 0

    def made(parts: list[tuple], before: int = 0, behind: int = 0) -> Slice:
        nonlocal number
        rows, doc_ids, held, h, sizes = zip(*parts)
        words, ids = _numbered(np.concatenate(h))
        out = Slice(number, np.concatenate(rows), sum(doc_ids, []), np.concatenate(held), np.concatenate(sizes), before, behind, words, ids)
        number += 1
        return out

    for batch, texts in pieces(batches):
        h, sizes = _tokens(texts)
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        part = (np.arange(row, row + len(texts)), batch.column("doc_id").to_pylist(), held, h, sizes)
        row += len(texts)
        if parts and held_back + len(h) > SLICE:
            yield made(parts)
            parts, held_back = [], 0
        if len(h) > SLICE and len(texts) == 1:
            for a in range(0, len(h), SLICE):
                low, high = max(0, a - 2), min(len(h), a + SLICE + 2)
                piece = (*part[:3], h[low:high], np.array([high - low]))
                yield made([piece], a - low, max(0, high - a - SLICE))
            continue
        parts.append(part)
        held_back += len(h)
    if parts:
        yield made(parts)


class Trie:
    """The different triples that begin at the tokens of a slice, with the pairs and words above them.

    Nodes are sorted by the numbers of their words within the slice, and so by hash.
    """

    def __init__(self, s: Slice):
        owner, n = s.owner(), len(s.ids)
        same = np.concatenate((owner[1:] == owner[:-1], [False, False]))[: n + 1]
        one = np.where(same[:n], np.append(s.ids, 0)[1 : n + 1], _NONE)
        two = np.where(same[:n] & np.append(same, False)[1 : n + 1], np.append(s.ids, [0, 0])[2 : n + 2], _NONE)
        begins = np.arange(n) < n - s.behind
        self.own = begins & (np.arange(n) >= s.before)
        key = (s.ids << (2 * _BITS)) | (one << _BITS) | two
        self.triples, place = np.unique(key[begins], return_inverse=True)
        #: Of each token: the triple, the pair and the word that begin there; -1 behind the end of a cut text's part.
        self.triple = np.full(n, -1)
        self.triple[begins] = place
        trained = (self.own & ~s.held[owner])[begins]
        self.count = np.bincount(place, weights=trained, minlength=len(self.triples)).astype(np.int64)
        pair = self.triples >> _BITS
        first = np.concatenate(([True], pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, bool)
        self.pair_of = np.cumsum(first) - 1
        self.pairs = pair[first]
        word = self.pairs >> _BITS
        first = np.concatenate(([True], word[1:] != word[:-1])) if len(word) else np.zeros(0, bool)
        self.word_of = np.cumsum(first) - 1
        self.heads = word[first]
        self.head_hash = s.words[self.heads]
        hashes = np.append(s.words, np.uint64(0))
        short = lambda ids: np.where(ids == _NONE, np.uint64(_NO_HASH), hashes[np.minimum(ids, len(s.words))] >> _SHORT)
        self.second = short(self.pairs & _NONE)
        self.third = short(self.triples & _NONE)

    @functools.cached_property
    def digest(self) -> int:
        return int(mix(self.head_hash).sum(dtype=np.uint64) ^ mix(self.triples.view(np.uint64) + np.uint64(len(self.pairs))).sum(dtype=np.uint64)) >> 1

    def buckets(self, many: int, hot: np.ndarray, spread: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each bucket's number, its pairs and its triples, both in order.

        ``hot`` are hashes of frequent words, sorted, and ``spread`` how many buckets each goes to.
        """
        home = mix(self.head_hash) % np.uint64(many)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, self.head_hash), len(hot) - 1)
            parts = np.where(hot[at] == self.head_hash, spread[at], 1).astype(np.uint64)
        else:
            parts = np.ones(len(home), np.uint64)
        # Parts of a word beyond the number of buckets would meet again.
        further = mix(self.second) % np.minimum(parts, np.uint64(many))[self.word_of]
        bucket = (home[self.word_of] + further) % np.uint64(many)
        bucket = bucket.astype(np.min_scalar_type(many))  # numbers of 16 bits are sorted by counting
        by_pair = np.argsort(bucket, kind="stable")
        of_triple = bucket[self.pair_of]
        by_triple = np.argsort(of_triple, kind="stable")
        numbers = np.unique(bucket)
        p = np.searchsorted(bucket[by_pair], np.append(numbers, many))
        t = np.searchsorted(of_triple[by_triple], np.append(numbers, many))
        for k, b in enumerate(numbers.tolist()):
            yield b, by_pair[p[k] : p[k + 1]], by_triple[t[k] : t[k + 1]]

    def heads_of(self, pairs: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where a word begins among the pairs of some buckets, one bucket behind the other, and the words of these places."""
        word = self.word_of[np.concatenate(pairs)]
        first = np.concatenate(([True], word[1:] != word[:-1]))
        first[np.cumsum([0, *map(len, pairs[:-1])])] = True
        starts = np.flatnonzero(first)
        return starts, word[starts]

    def message(self, pairs: np.ndarray, triples: np.ndarray) -> bytes:
        """What a bucket has to know: hashes of words, pairs and triples, children of each, and counts of triples."""
        return next(self.messages([pairs], [triples]))

    def messages(self, pairs: Sequence[np.ndarray], triples: Sequence[np.ndarray]) -> Iterator[bytes]:
        """The message to each bucket, given the pairs and the triples of each; all triples of a pair go where it goes."""
        starts, words = self.heads_of(pairs)
        of_pairs, of_triples = [len(p) for p in pairs], [len(t) for t in triples]
        of_words = np.diff(np.searchsorted(starts, np.cumsum([0, *of_pairs])))
        p, t = np.concatenate(pairs), np.concatenate(triples)
        return _packed_parts(
            [
                self.head_hash[words], np.diff(np.append(starts, len(p))), self.second[p], np.bincount(self.pair_of)[p],
                self.third[t], self.count[t], np.full(len(pairs), self.digest),
            ],
            [of_words, of_words, of_pairs, of_pairs, of_triples, of_triples, [1] * len(pairs)],
        )


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and the place of each key among them."""
    return np.unique(key, return_inverse=True)


def _bucket_answers(bucket: int, messages: list[tuple[int, bytes]], hot: np.ndarray) -> Iterator[dict]:
    """Sums over all slices, for each slice in its own order; the bucket's totals; and parts of frequent words."""
    (word, pairs_each, second, triples_each, third, count, said), sizes = _unpacked_parts([body for _, body in messages])
    heads, head = _numbered(word)
    pair_head = np.repeat(head, pairs_each.astype(np.int64)).astype(np.uint64)
    # Hashes of 40 bits below the 24 bits of what they follow.
    pairs, pair = _groups((pair_head << np.uint64(40)) | second)
    triples, triple = _groups((np.repeat(pair, triples_each.astype(np.int64)).astype(np.uint64) << np.uint64(40)) | third)
    c3 = np.bincount(triple, weights=count.astype(np.float64), minlength=len(triples)).astype(np.int64)
    above = (triples >> np.uint64(40)).astype(np.int64)
    follows = (c3 > 0) & (triples & np.uint64(_NO_HASH) != np.uint64(_NO_HASH))
    c2 = np.bincount(above, weights=c3, minlength=len(pairs)).astype(np.int64)
    after2 = np.bincount(above, weights=follows, minlength=len(pairs)).astype(np.int64)
    above = (pairs >> np.uint64(40)).astype(np.int64)
    follows = (c2 > 0) & (pairs & np.uint64(_NO_HASH) != np.uint64(_NO_HASH))
    c1 = np.bincount(above, weights=c2, minlength=len(heads)).astype(np.int64)
    after1 = np.bincount(above, weights=follows, minlength=len(heads)).astype(np.int64)
    split = np.isin(heads, hot)
    empty = {"bucket": bucket, "slice": -1, "body": None, "n": None, "v": None, "word": None, "c1": None, "after1": None}
    yield empty | {"n": int(c1.sum()), "v": int((c1[~split] > 0).sum())}
    for k in np.flatnonzero(split):
        yield empty | {"word": int(heads[k : k + 1].view(np.int64)[0]), "c1": int(c1[k]), "after1": int(after1[k])}
    told = _packed_parts([c1[head], after1[head], c2[pair], after2[pair], c3[triple], said], sizes[[0, 0, 2, 2, 4, 6]])
    for (number, _), body in zip(messages, told):
        yield empty | {"slice": number, "body": body}


def _by_key(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of batches sorted by a key, those of one key at a time."""
    last, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != last and rows:
                yield last, rows
                rows = []
            last = row[key]
            rows.append(row)
    if rows:
        yield last, rows


class Automaton:
    """The states, arcs and failure arcs of a slice's n-grams, with weights as logarithms.

    An arc of a state of two words is a triple of the trie, one of a state of one word a
    pair, and the state without words has an arc for every word. Where the training
    documents do not hold the n-gram there is no arc, and the failure arc is taken.
    """

    def __init__(self, trie: Trie, answers: list[tuple], total: int, kinds: int, ends: int):
        """``answers`` are those of words (count, words after), pairs (the same) and triples (count)."""
        (c1, after1), (c2, after2), c3 = answers
        self.trie = trie
        share = np.log10((c1 + ADDED) / (total + ADDED * (kinds + 1)))
        place = np.full(ends + 1, -1)
        place[trie.heads] = np.arange(len(trie.heads))
        place = np.append(place, -1)
        # The word and the pair that a pair and a triple end with; none behind an end.
        last_word = place[np.minimum(trie.pairs & _NONE, ends)]
        begins = np.flatnonzero((trie.triple[:-1] >= 0) & (trie.triple[1:] >= 0))
        last_pair = np.full(len(trie.triples), -1)
        last_pair[trie.triple[begins]] = trie.pair_of[trie.triple[begins + 1]]
        last_pair[(trie.triples >> _BITS) & _NONE == _NONE] = -1
        with np.errstate(divide="ignore", invalid="ignore"):
            self.word_fails = np.log10(DISCOUNT * after1 / c1)
            self.pair_fails = np.log10(DISCOUNT * after2 / c2)
            one = 10 ** np.where(last_word >= 0, share[last_word], 0)
            two = (np.maximum(c2 - DISCOUNT, 0) + DISCOUNT * after1[trie.word_of] * one) / c1[trie.word_of]
            shorter = np.where(last_pair >= 0, two[last_pair], 0)
            three = (np.maximum(c3 - DISCOUNT, 0) + DISCOUNT * after2[trie.pair_of] * shorter) / c2[trie.pair_of]
            self.word_arc, self.pair_arc, self.triple_arc = share, np.log10(two), np.log10(three)
        self.has_word, self.has_pair, self.has_triple = c1 > 0, c2 > 0, c3 > 0

    def traverse(self, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: the log10 probability, that by shares alone, and the known tokens, over tokens of this slice."""
        trie, begins = self.trie, np.cumsum(s.sizes) - s.sizes
        pair = np.where(trie.triple >= 0, trie.pair_of[trie.triple], -1)
        word = np.where(trie.triple >= 0, trie.word_of[pair], -1)
        # Stretches of texts: first token, tokens, and how many of these are read for the state alone.
        lanes = -(-s.sizes // STRETCH)
        text = np.repeat(np.arange(len(s.sizes)), lanes)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        low = number * STRETCH
        warm = np.minimum(low, 2)
        size = np.minimum(STRETCH, s.sizes[text] - low) + warm
        first = begins[text] + low - warm
        order = np.argsort(-size, kind="stable")
        text, first, size, warm = text[order], first[order], size[order], warm[order]
        active = np.searchsorted(-size, -np.arange(size.max(initial=0)), "left")
        score, base = np.zeros(len(text)), np.zeros(len(text))
        known = np.zeros(len(text), np.int64)
        state = np.zeros(len(text), np.int64)  # how many words were read last
        for step, n in enumerate(active.tolist()):
            at = first[:n] + step
            read = at < len(s.ids) - s.behind
            w = word[at]
            two = np.flatnonzero(state[:n] == 2)
            weight = np.zeros(n)
            level = state[:n].copy()
            if len(two):
                t = trie.triple[at[two] - 2]
                found = self.has_triple[t]
                weight[two] = np.where(found, self.triple_arc[t], self.pair_fails[pair[at[two] - 2]])
                level[two] = np.where(found, 3, 1)
            one = np.flatnonzero(level == 1)
            if len(one):
                p = pair[at[one] - 1]
                found = self.has_pair[p]
                weight[one] += np.where(found, self.pair_arc[p], self.word_fails[word[at[one] - 1]])
                level[one] = np.where(found, 3, 0)
            none = np.flatnonzero(level == 0)
            weight[none] += self.word_arc[w[none]]
            counted = read & (step >= warm[:n]) & (at - begins[text[:n]] >= s.before)
            score[:n] += np.where(counted, weight, 0)
            base[:n] += np.where(counted, self.word_arc[w], 0)
            seen = self.has_word[w]
            known[:n] += counted & seen
            follows = np.zeros(n, bool)
            if step:
                follows = self.has_pair[pair[at - 1]]
            state[:n] = np.where(follows & seen, 2, seen)
        many = len(s.sizes)
        whole = np.bincount(text, weights=known, minlength=many).astype(np.int64)
        return np.bincount(text, weights=score, minlength=many), np.bincount(text, weights=base, minlength=many), whole


def _answered(s: Slice, trie: Trie, bodies: dict[int, bytes], many: int, hot: tuple[np.ndarray, ...]) -> list[tuple]:
    """The answers of all buckets, put to the nodes of the trie."""
    hashes, spread, c1_all, after1_all = hot
    words, pairs, c3 = np.zeros((2, len(trie.heads)), np.int64), np.zeros((2, len(trie.pairs)), np.int64), np.zeros(len(trie.triples), np.int64)
    numbers, of_pairs, of_triples = zip(*trie.buckets(many, hashes, spread))
    differ = RuntimeError("the documents differ from those that were counted")
    if not all(b in bodies for b in numbers):
        raise differ
    (x1, y1, x2, y2, x3, said), sizes = _unpacked_parts([bodies[b] for b in numbers])
    if [*map(len, of_triples)] != sizes[4].tolist() or [*map(len, of_pairs)] != sizes[2].tolist() or (said != trie.digest).any():
        raise differ
    words[:, trie.heads_of(of_pairs)[1]] = x1, y1
    pairs[:, np.concatenate(of_pairs)] = x2, y2
    c3[np.concatenate(of_triples)] = x3
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, trie.head_hash), len(hashes) - 1)
        frequent = hashes[at] == trie.head_hash
        words[:, frequent] = c1_all[at[frequent]], after1_all[at[frequent]]
    return [tuple(words), tuple(pairs), c3]


def _as_long_as_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Hashes of the tokens of a partition, about ``SLICE`` at a time."""
    parts, n = [], 0
    for _, texts in pieces(batches):
        h, _ = _tokens(texts)
        if parts and n + len(h) > SLICE:
            yield np.concatenate(parts)
            parts, n = [], 0
        parts.append(h)
        n += len(h)
    if parts:
        yield np.concatenate(parts)


def _frequent(docs: DataFrame, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words with more than half of ``BUCKET`` occurrences, and how many buckets each goes to.

    There is one at most for each half bucket of tokens. A slice names the words that it has
    often enough to matter; what it leaves out adds up to a quarter bucket. Results do not
    depend on the choice.
    """
    least = max(1, BUCKET * SLICE // (4 * max(tokens, SLICE)))

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h in _as_long_as_slices(batches):
            h.sort()
            starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            n = np.diff(np.append(starts, len(h)))
            yield pa.record_batch({"word": h[starts[n >= least]].view(np.int64), "n": n[n >= least].astype(np.int64)})

    found = docs.mapInArrow(often, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > BUCKET // 2).toArrow()
    hashes = found["word"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], 1 + found["n"].to_numpy()[order] * 2 // BUCKET


def scored(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held, F.lit(False)).alias("held_out"))
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        docs = stored(docs, folder, "documents")  # what comes out of a shuffle may come in another order next time
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count("*")).first()[0]
    tokens = size // TOKEN_BYTES
    many = 1 + 2 * tokens // BUCKET
    none = np.zeros(0, np.uint64)
    hashes, spread = _frequent(docs, tokens) if size > BUCKET // 2 else (none, none.astype(np.int64))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, TaskContext.get().partitionId()):
            trie = Trie(s)
            numbers, pairs, triples = zip(*trie.buckets(many, hashes, spread))
            told = list(trie.messages(pairs, triples))
            yield pa.record_batch({"bucket": numbers, "slice": [s.number] * len(told), "body": told})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(k, pa.binary() if kind == "binary" else pa.int64()) for k, kind in (c.split() for c in _COLUMNS.split(", "))])
        for bucket, rows in _by_key(batches, "bucket"):
            found = _bucket_answers(bucket, [(r["slice"], r["body"]) for r in rows], hashes)
            yield pa.RecordBatch.from_pylist(list(found), schema)

    asked = docs.mapInArrow(ask, "bucket long, slice long, body binary")
    answers = asked.repartition("bucket").sortWithinPartitions("bucket", "slice").mapInArrow(answer, _COLUMNS)
    answers = stored(answers, folder, "answers")
    total, kinds = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    whole = answers.where("word is not null").groupBy("word").agg(F.sum("c1").alias("c1"), F.sum("after1").alias("after1")).toArrow()
    by_hash = np.argsort(whole["word"].to_numpy().view(np.uint64))
    c1_all, after1_all = (whole[c].to_numpy()[by_hash] for c in ("c1", "after1"))
    kinds += int((c1_all > 0).sum())
    frequent = (hashes, spread, c1_all, after1_all)

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, TaskContext.get().partitionId()):
            ids = pa.array([s.doc_ids], pa.list_(pa.int64()))
            yield pa.record_batch({"slice": [s.number], "bucket": [-1], "body": [s.body()], "doc_ids": ids})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _by_key(batches, "slice"):
            if rows[0]["bucket"] != -1:
                raise RuntimeError("the documents differ from those that were counted")
            s = Slice.of(number, rows[0]["doc_ids"], rows[0]["body"])
            trie = Trie(s)
            found = _answered(s, trie, {r["bucket"]: r["body"] for r in rows[1:]}, many, frequent)
            scores, base, known = Automaton(trie, found, total, kinds, len(s.words)).traverse(s)
            yield pa.record_batch(
                {
                    "row": s.rows,
                    "doc_id": pa.array(s.doc_ids, pa.int64()),
                    "held_out": s.held,
                    "n_tokens": s.sizes - s.before - s.behind if len(s.sizes) == 1 else s.sizes,
                    "n_known": known,
                    "base_score": base,
                    "score": scores,
                }
            )

    said = answers.where("slice >= 0").select("slice", "bucket", "body", F.lit(None).cast("array<long>").alias("doc_ids"))
    both = docs.mapInArrow(bodies, "slice long, bucket long, body binary, doc_ids array<long>").union(said)
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    parts = both.repartition("slice").sortWithinPartitions("slice", "bucket").mapInArrow(score, schema)
    # A text that was cut has a row for each part.
    return (
        parts.groupBy("row", "doc_id", "held_out")
        .agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
    )


def contract(docs: DataFrame) -> DataFrame:
    """Scores of all documents by those whose crc32 modulo 10 is not 0."""
    return scored(docs, crc_mod("doc_id", 10) == 0)
