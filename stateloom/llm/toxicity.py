"""Toxicity from two Kneser-Ney models over the letters of words.

A toxic and an ordinary model give every word a probability, letter by letter,
from the four bytes before it. Both discount seen sequences and hand what is left
to shorter ones. Sequences of up to three bytes are shared: their Kneser-Ney counts
(in how many different places a sequence stands) come from both classes together,
so an expression that neither class has seen weighs next to nothing. A text's
evidence is the difference of both log-likelihoods by word, taken against the level
of the text itself (its median word: a language or subject that one class has more
of moves all words alike) and against zero. A logistic curve, fitted on labelled
rows kept out of the counts, turns it into a score.

Learning is bounded by ``SAMPLE_ROWS`` documents of each class; scoring covers all
rows and whole texts. Words are taken without upper case; a null or empty text has
no word, no evidence, and the score 0. Without examples of both classes every
score is 0. Rows are scored one by one, so repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from stateloom.llm.labelled import crc_mod, labelled_sample
from stateloom.llm.words import ALNUM, Words, pieces

#: Documents of each class that are learned from at most.
SAMPLE_ROWS = 6_000
THRESHOLD = 0.3
ORDER = 5
#: Orders up to this one are counted over both classes together.
SHARED = 3
_DISCOUNT = 0.75
_START, _END = 1, 2
_ABOVE = (1.5, 3.0)


def letter_grams(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the different words: packed five-byte sequences, their word; of all words: which, and their text."""
    hashes = words.hashes()
    _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    starts, lengths = words.starts[one], (words.ends - words.starts)[one]
    room = lengths + ORDER  # four start bytes before, one end byte behind
    offset = np.concatenate(([0], np.cumsum(room)[:-1]))
    out = np.full(int(room.sum()), _START, np.uint8)
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(offset + ORDER - 1, lengths) + inner] = words.bytes[np.repeat(starts, lengths) + inner]
    out[offset + room - 1] = _END
    packed = np.zeros(len(out), np.int64)
    for back in range(ORDER):
        packed[back:] |= out[: len(out) - back].astype(np.int64) << (8 * back)
    predicted = lengths + 1
    at = np.repeat(offset + ORDER - 1, predicted) + (
        np.arange(int(predicted.sum())) - np.repeat(np.cumsum(predicted) - predicted, predicted)
    )
    return packed[at], np.repeat(np.arange(len(one)), predicted), which, words.owner()


@dataclass
class Model:
    """Log ratios of five-byte sequences, and what the rarer ones fall back to."""

    grams: np.ndarray
    ratios: np.ndarray
    shorter: np.ndarray
    shorter_ratios: np.ndarray
    contexts: np.ndarray
    context_ratios: np.ndarray
    short_contexts: np.ndarray
    short_context_ratios: np.ndarray
    slopes: tuple[float, float] = (8.0, 8.0)
    offset: float = -1.0

    def of_grams(self, packed: np.ndarray) -> np.ndarray:
        out, known = _look_up(self.grams, self.ratios, packed)
        rest = np.flatnonzero(~known)
        if len(rest):
            short = packed[rest] & 0xFFFFFFFF
            fall, known = _look_up(self.shorter, self.shorter_ratios, short)
            fall[~known] = _look_up(self.short_contexts, self.short_context_ratios, short[~known] >> 8)[0]
            out[rest] = fall + _look_up(self.contexts, self.context_ratios, packed[rest] >> 8)[0]
        return out

    def evidence(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Two features of each text, both means over its words, and the number of words.

        By how much a word's log ratio exceeds the text's median by more than
        ``_ABOVE[0]``, and by how much it exceeds ``_ABOVE[1]``.
        """
        words = Words(texts, ALNUM)
        features = np.zeros((len(texts), 2))
        if not len(words):
            return features, words.counts
        packed, word, which, owner = letter_grams(words)
        ratio = np.bincount(word, self.of_grams(packed))[which]
        level = np.zeros(len(texts))
        for i in np.flatnonzero(words.counts):
            level[i] = np.median(ratio[words.first[i] : words.first[i + 1]])
        over = (np.maximum(ratio - level[owner] - _ABOVE[0], 0), np.maximum(ratio - _ABOVE[1], 0))
        for k in (0, 1):
            features[:, k] = np.bincount(owner, over[k], len(texts)) / np.maximum(words.counts, 1)
        return features, words.counts

    def score(self, texts: list[bytes]) -> np.ndarray:
        features, counts = self.evidence(texts)
        odds = np.clip(features @ np.array(self.slopes) + self.offset, -500, 500)
        return np.where(counts > 0, 1 / (1 + np.exp(-odds)), 0.0)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys, 0 where unknown, and which are known."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return np.where(known, values[at], 0.0), known


def _level(grams: np.ndarray, counts: np.ndarray, lower) -> tuple:
    """One order of one model: probability of each of its sequences, contexts, weights left to the lower order."""
    seen = counts > 0
    contexts, at = np.unique(grams >> 8, return_inverse=True)
    total = np.bincount(at, counts, len(contexts))
    kinds = np.bincount(at, seen, len(contexts))
    left = np.where(total > 0, _DISCOUNT * kinds / np.maximum(total, 1), 1.0)
    share = np.maximum(counts - _DISCOUNT, 0) / np.maximum(total[at], 1)
    return share + left[at] * lower, contexts, left


def fit(grams: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray) -> Model:
    """Both models from the counts of sorted, different five-byte sequences."""
    classes = (ordinary.astype(float), toxic.astype(float))

    def places(mask: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequences of an order that end others, and before how many bytes they stand."""
        longer = np.unique(grams[mask] & ((1 << (8 * (order + 1))) - 1))
        return np.unique(longer & ((1 << (8 * order)) - 1), return_counts=True)

    everywhere = np.ones(len(grams), bool)
    keys, n = places(everywhere, 1)
    p = (n + 0.5) / (n.sum() + 128.0)
    for order in range(2, SHARED + 1):
        lower = keys, p
        keys, n = places(everywhere, order)
        p = _level(keys, n.astype(float), _look_up(*lower, keys & ((1 << (8 * (order - 1))) - 1))[0])[0]
    shared = _look_up(keys, p, (four := np.unique(grams & 0xFFFFFFFF)) & 0xFFFFFF)[0]
    of_four, of_five, lefts = [], [], []
    for counts in classes:
        own, n = places(counts > 0, 4)
        p4, short_contexts, short_left = _level(four, _look_up(own, n.astype(float), four)[0], shared)
        p5, contexts, left = _level(grams, counts, p4[np.searchsorted(four, grams & 0xFFFFFFFF)])
        of_four.append(p4)
        of_five.append(p5)
        lefts.append((left, short_left))
    ratio = lambda x: np.log(x[1] / x[0])
    return Model(
        grams, ratio(of_five), four, ratio(of_four), contexts, ratio([x[0] for x in lefts]),
        short_contexts, ratio([x[1] for x in lefts]),
    )


def _calibrate(features: np.ndarray, label: np.ndarray) -> tuple[tuple[float, float], float]:
    """A logistic curve by Newton's method, with a little shrinkage; the rarer class weighs up to the root of its rarity."""
    scale = np.maximum(features.std(axis=0), 1e-9)
    x = np.column_stack([features / scale, np.ones(len(label))])
    weight = np.sqrt(len(label) / (2 * np.bincount(label, minlength=2)[label]))
    shrink = np.array([3e-2, 3e-2, 1e-3])
    beta = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (label - p)) - shrink * beta
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.diag(shrink), gradient)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta[:2] / scale), float(beta[2])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Learn from a bounded sample of the labelled rows; None without examples of both classes."""
    sample = labelled_sample(docs, labels, "toxic", rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                if (label == k).any() and len(words := Words([t for t, y in zip(texts, label) if y == k], ALNUM)):
                    packed, word, which, _ = letter_grams(words)
                    grams, at = np.unique(packed, return_inverse=True)
                    n = np.bincount(at, np.bincount(which)[word])
                    yield pa.record_batch({"gram": grams, "label": np.full(len(grams), k, np.int32), "n": n.astype(np.int64)})

    counted = (
        sample.where("fold <> 3")
        .mapInArrow(count, "gram long, label int, n long")
        .groupBy("gram")
        .agg(*(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)))
        .toArrow()
        .sort_by("gram")
    )
    ordinary, toxic = (counted.column(c).to_numpy() for c in ("n0", "n1"))
    if not len(counted) or not ordinary.any() or not toxic.any():
        return None
    model = fit(counted.column("gram").to_numpy(), ordinary, toxic)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            f, counts = model.evidence(texts)
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int32)
            some = counts > 0
            yield pa.record_batch({"own": f[some, 0], "plain": f[some, 1], "label": label[some]})

    kept = sample.where("fold = 3").mapInArrow(weigh, "own double, plain double, label int").toArrow()
    kept = kept.sort_by([(c, "ascending") for c in ("label", "own", "plain")])
    own, plain, label = (kept.column(c).to_numpy() for c in ("own", "plain", "label"))
    if len(np.unique(label)) == 2:
        model.slopes, model.offset = _calibrate(np.column_stack([own, plain]), label)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the documents with ``tox_score`` (0 to 1) and ``tox_predicted`` (0 or 1)."""
    spark = docs.sparkSession
    model = train(docs, labels, rows)
    sent = spark.sparkContext.broadcast(model)
    added = ["tox_score", "tox_predicted"]
    docs = docs.drop(*added)
    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField(added[0], DoubleType()), StructField(added[1], IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            s = np.zeros(len(texts)) if sent.value is None else sent.value.score(texts)
            columns = [*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    return docs.mapInArrow(score, schema)


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return toxicity(docs.select("doc_id", "text"), labels).select(
        "doc_id",
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        F.col("tox_score").alias("score"),
        F.col("tox_predicted").alias("predicted"),
    )
