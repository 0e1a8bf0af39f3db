"""Runs of periodic words, found by block convolution at dyadic scales.

A run is a stretch of words in which words a period apart are equal, at least ``TIMES``
periods and ``LEAST`` words long, that no neighbouring word extends. For periods from s
to 2s - 1, s a power of two, a text is cut into blocks of s words: a run that long holds
a whole block and its copy one period on. For each block and each distance the sum of
squared differences of the words is the two sums of squares less twice a correlation,
which a number-theoretic transform gives for all distances at once, in whole numbers
modulo a prime. Where the sum is zero the block recurs, and the distance is a seed:
the stretch around it is extended both ways as far as words a distance apart are equal.
Seeds that are equal modulo the prime alone are taken out before, by hashes of the words.

Words that are equal lie in the same stretch for all multiples of a period; of the
distances of one stretch the smallest is its period. A transform is made of products
with matrices whose sums stay below 2**53, so that float64 holds them exactly. Blocks
have ``LONGEST`` words at most: longer periods compare blocks of that many words, one
for each multiple of s, with all windows at such distances.

Texts are handled whole, a slice of texts at a time. A null or empty text has no words,
no runs and an empty collapsed text. Rows are independent: ids may be null or repeat.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.llm.words import TOKEN, Words, mix, pieces, powers

LEAST = 24
TIMES = 3
#: Words in a block at most.
LONGEST = 1 << 13
PRIME = 65_537
#: A primitive root modulo the prime.
ROOT = 3
#: Transforms up to this length are one product with a matrix, longer ones two.
ONE_STEP = 128
#: Numbers held by one step of the convolution.
HELD = 1 << 19

SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _reduced(x: np.ndarray) -> np.ndarray:
    """Modulo the prime, in place; a multiple of the prime may stay the prime itself."""
    q = np.floor(x * (1.0 / PRIME))
    q *= PRIME
    x -= q
    return x


def _root_powers(n: int, exponents: np.ndarray) -> np.ndarray:
    """The n-th root of unity to these exponents, as float64."""
    steps = np.ones(n, np.int64)
    root = pow(ROOT, (PRIME - 1) // n, PRIME)
    for k in range(1, n):
        steps[k] = steps[k - 1] * root % PRIME
    return steps[exponents % n].astype(np.float64)


class Transform:
    """Of sequences whose second half is zero, of length n; and back, the first half alone.

    Frequencies stand in the order in which the two steps leave them.
    """

    def __init__(self, n: int):
        self.n = n
        self.a = n if n <= ONE_STEP else 1 << ((n.bit_length()) // 2)
        self.b = n // self.a
        fa, fb = np.arange(self.a), np.arange(self.b)
        half = np.arange(self.a // 2)
        self.first = _root_powers(self.a, np.outer(fa, half))
        self.last = _root_powers(self.a, -np.outer(half, fa)) * pow(n, -1, PRIME) % PRIME
        self.twiddle = _root_powers(n, np.outer(fa, fb))
        self.back = _root_powers(n, -np.outer(fa, fb))
        self.second = _root_powers(self.b, np.outer(fb, fb))
        self.third = _root_powers(self.b, -np.outer(fb, fb))
        frequency = (fa[:, None] + self.a * fb).ravel()
        where = np.empty(n, np.int64)
        where[frequency] = np.arange(n)
        #: Where the opposite of each frequency stands, and the root to half the length times it.
        self.opposite = where[-frequency % n]
        self.sign = np.where(frequency % 2, -1.0, 1.0)

    def forward(self, x: np.ndarray) -> np.ndarray:
        if self.b == 1:
            return _reduced(x @ self.first.T)
        y = _reduced(self.first @ x.reshape(len(x), self.a // 2, self.b))
        y *= self.twiddle
        return _reduced(_reduced(y) @ self.second).reshape(len(x), self.n)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        if self.b == 1:
            return _reduced(x @ self.last.T)
        y = _reduced(x.reshape(len(x), self.a, self.b) @ self.third)
        y *= self.back
        return _reduced(self.last @ _reduced(y)).reshape(len(x), self.n // 2)


transform_of = lru_cache(maxsize=None)(Transform)


class _Equal:
    """Whether stretches of words are equal, by hashes of all beginnings of the sequence."""

    def __init__(self, h: np.ndarray):
        self.power = powers(len(h) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h) * self.power[: len(h)])))

    def __call__(self, i: np.ndarray, d: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Are the n words from i those from i + d."""
        near = self.sums[i + n] - self.sums[i]
        return near * self.power[d] == self.sums[i + d + n] - self.sums[i + d]

    def common(self, i: np.ndarray, d: np.ndarray, limit: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from i on (or before i) equal those d further, up to the limit."""
        n = np.zeros(len(i), np.int64)
        step = 1 << int(limit.max(initial=0)).bit_length()
        while step := step >> 1:
            may = np.flatnonzero(n + step <= limit)
            at = i[may] + n[may] if forward else i[may] - n[may] - step
            n[may[self(at, d[may], np.full(len(may), step))]] += step
        return n


def _seeds(value: np.ndarray, first: np.ndarray, s: int, least: int, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts, blocks' first words and distances from s to 2s - 1 at which squared differences add up to zero."""
    counts = np.diff(first)
    texts = np.flatnonzero(counts >= max(least, times * s))
    b = min(s, LONGEST)
    step = s // b
    tables = transform_of(2 * b)
    # Texts are taken together until they hold enough; a longer one is alone.
    begin = 0
    sizes = -(-counts[texts] // b) + 2
    ends = np.cumsum(sizes)
    while begin < len(texts):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + HELD // b, "right")))
        own = texts[begin:stop]
        begin = stop
        rows = -(-counts[own] // b)
        base = np.concatenate(([0], np.cumsum(rows)))
        flat = np.zeros((base[-1] + 2) * b)
        spread = np.repeat(base[:-1] * b - first[own], counts[own])
        words = np.repeat(first[own] - np.concatenate(([0], np.cumsum(counts[own])[:-1])), counts[own]) + np.arange(counts[own].sum())
        flat[words + spread] = value[words]
        blocks = flat.reshape(-1, b)
        squares = np.concatenate(([0.0], np.cumsum(_reduced(flat * flat))))
        spectra = np.concatenate(
            [tables.forward(blocks[k : k + HELD // (2 * b) + 1]).astype(np.float32) for k in range(0, len(blocks), HELD // (2 * b) + 1)]
        )
        # All pairs of a block and a window of two blocks: every step-th block with the step windows that begin s words on.
        number = np.arange(base[-1]) - np.repeat(base[:-1], rows)
        inside = np.repeat(rows, rows)
        left = np.flatnonzero((number % step == 0) & (number + step < inside))
        left = np.repeat(left, step)
        right = left + step + np.tile(np.arange(step), len(left) // step)
        owner = np.repeat(np.arange(len(own)), rows)
        there = right < base[owner[left] + 1]
        left, right = left[there], right[there]
        at_once = HELD // (2 * b) + 1
        for k in range(0, len(left), at_once):
            l, r = left[k : k + at_once], right[k : k + at_once]
            window = _reduced(spectra[r] + spectra[r + 1] * tables.sign)
            crossed = tables.inverse(_reduced(spectra[l][:, tables.opposite] * window))
            ahead = squares[(r * b)[:, None] + np.arange(b, 2 * b)] - squares[(r * b)[:, None] + np.arange(b)]
            apart = ahead + (squares[(l + 1) * b] - squares[l * b])[:, None] - 2 * crossed
            apart = _reduced(apart)
            who, shift = np.nonzero((apart == 0) | (apart == PRIME))
            text = own[owner[l[who]]]
            start = first[text] + (l[who] - base[owner[l[who]]]) * b
            distance = (r[who] - l[who]) * b + shift
            whole = start + distance + b <= first[text + 1]
            yield text[whole], start[whole], distance[whole]


def find_runs(h: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of every run, by text, start and period.

    ``h`` are hashes of words, and those of text i are first[i] to first[i + 1]. ``times``
    is three at least: with fewer periods a run need not hold a block and its copy.
    """
    if times < 3:
        raise ValueError("a run has three periods at least")
    value = (h % np.uint64(PRIME)).astype(np.float64)
    equal = _Equal(h)
    longest = int(np.diff(first).max(initial=0))
    found = [np.zeros((4, 0), np.int64)]
    s = 1
    while times * s <= longest and longest >= least:
        b = min(s, LONGEST)
        for text, i, d in _seeds(value, first, s, least, times):
            real = equal(i, d, np.full(len(i), b))
            text, i, d = text[real], i[real], d[real]
            # Of blocks that follow each other at one distance, the first one leads to the whole stretch.
            order = np.lexsort((i, d, text))
            text, i, d = text[order], i[order], d[order]
            head = np.ones(len(i), bool)
            # The blocks of longer scales have gaps between them, so that each of those is extended.
            if b == s:
                head[1:] = (text[1:] != text[:-1]) | (d[1:] != d[:-1]) | (i[1:] != i[:-1] + s)
            text, i, d = text[head], i[head], d[head]
            after = equal.common(i, d, first[text + 1] - i - d, True)
            before = equal.common(i, d, i - first[text], False)
            length = before + d + after
            long = length >= np.maximum(least, times * d)
            found.append(np.stack((text, i - before, length, d))[:, long])
        s *= 2
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    text, start, length, period = (x[order] for x in (text, start, length, period))
    new = np.ones(len(text), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = (x[new] for x in (text, start, length, period))
    order = np.lexsort((period, start))
    return text[order], (start - first[text])[order], length[order], period[order]


def collapsed_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, runs (start, length, period, by start and period) and the collapsed text of every row.

    The collapsed text has one space between words and no word that some run holds
    behind its first period.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            words = Words(texts, TOKEN, lower=False)
            text, start, length, period = find_runs(words.hashes(), words.first, least, times)
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, words.first[text] + start + period, 1)
            np.add.at(change, words.first[text] + start + length, -1)
            dropped = np.cumsum(change[:-1]) > 0
            touched = set(text.tolist())
            out = []
            for k, one in enumerate(texts):
                kept = one.split()
                if k in touched:
                    gone = dropped[words.first[k] : words.first[k + 1]]
                    kept = [kept[j] for j in np.flatnonzero(~gone)]
                out.append(b" ".join(kept))
            bounds = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "runs": pa.ListArray.from_arrays(bounds, runs),
                    "collapsed": pa.array(out, pa.binary()).cast(pa.string()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(find, SCHEMA)


def planted(doc_id: Column, text: Column) -> Column:
    """The text with its end made periodic where the id's crc32 is divisible by ten; a null id is left alone."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # One element for each array of words, so that the words are split once.
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))
    return F.when(h % 10 == 0, F.get(made, 0)).otherwise(text)


def contract(docs: DataFrame) -> DataFrame:
    """Runs of every document, some made periodic, and digests of all runs and of the collapsed text."""
    rows = docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = collapsed_runs(rows)
    best = F.aggregate(
        "runs",
        F.get("runs", 0),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
