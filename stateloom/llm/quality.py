"""Quality from a factorisation machine.

A text's features are its words, hashed to ``WORDS`` places (damped counts, of length
1 together), some statistics of its structure, and its size as metadata. Every
feature has a weight and a vector of ``RANK`` numbers; a text's odds are the weighted
sum of its features and, for every pair of them, the product of both values and of
both vectors. The pairs are never formed: half of the square of the sum less the sum
of squares, for each of the ``RANK`` dimensions, is the same.

It is fitted with AdaGrad on a bounded sample: ``SAMPLE_ROWS`` documents of each class,
each with ``WORDS`` + ``STATS`` features at most. Scoring covers all rows and whole
texts. labels, lang, source and doc_id are no features. A null or empty text has no
word features. Without examples of both classes every score is 0.5.
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
from stateloom.llm.words import ALNUM, TOKEN, Words, pieces

SAMPLE_ROWS = 4_000
THRESHOLD = 0.7
WORDS = 4096
RANK = 8
EPOCHS = 10
BATCH = 128
_STEP = 0.08
_SHRINK = 1e-4

_BYTE = np.arange(256)
#: Classes of bytes whose share of a text is a statistic.
_CLASSES = {
    "upper": (_BYTE >= 0x41) & (_BYTE <= 0x5A),
    "digit": (_BYTE >= 0x30) & (_BYTE <= 0x39),
    "end": np.isin(_BYTE, list(b".?")),
    "comma": np.isin(_BYTE, list(b",;:'\"-()")),
    "shout": _BYTE == ord("!"),
    "symbol": np.isin(_BYTE, list(b"#$%&*@^~<>{}[]=+\\/_`")),
    "bar": _BYTE == ord("|"),
    "line": _BYTE == 0x0A,
    "space": ~TOKEN,
    "wide": _BYTE >= 0x80,
}
STATS = len(_CLASSES) + 6


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, values, and the end of each text's features in both."""
    n = len(texts)
    words = Words(texts, ALNUM)
    raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    at = words.text_starts[:-1]
    size = np.maximum(np.diff(words.text_starts) - 1, 1)
    h, owner, count = words.hashes(), words.owner(), np.maximum(words.counts, 1)
    share = [np.add.reduceat(mask[raw].astype(np.int64), at) / size for mask in _CLASSES.values()]
    again = np.zeros(n) if len(h) < 2 else np.bincount(owner[1:], (h[1:] == h[:-1]) & (owner[1:] == owner[:-1]), n)
    code, repeats = np.unique((owner.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)), return_counts=True)
    kinds = np.bincount((code >> np.uint64(40)).astype(np.int64), minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, (code >> np.uint64(40)).astype(np.int64), repeats)
    length = np.bincount(owner, words.ends - words.starts, n) / count
    stats = np.stack(
        [*(np.minimum(4 * s, 2.0) for s in share), again / count, kinds / count, most / count, length / 8,
         np.log1p(size) / 10, np.log1p(words.counts) / 8], axis=1,
    )

    place = (h >> np.uint64(52)).astype(np.int64)
    code, repeats = np.unique(owner * WORDS + place, return_counts=True)
    whose = code // WORDS
    value = np.log1p(repeats)
    value /= np.sqrt(np.bincount(whose, value**2, n))[whose]
    columns = np.concatenate((code % WORDS, np.tile(np.arange(WORDS, WORDS + STATS), n)))
    values = np.concatenate((value, stats.ravel()))
    rows = np.concatenate((whose, np.repeat(np.arange(n), STATS)))
    order = np.argsort(rows, kind="stable")
    return columns[order], values[order], np.cumsum(np.bincount(rows, minlength=n))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def odds(self, columns: np.ndarray, values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of texts, and the sums of their weighted vectors."""
        starts = np.concatenate(([0], ends[:-1]))
        v = self.vectors[columns] * values[:, None]
        sums = np.add.reduceat(v, starts, axis=0)
        pairs = 0.5 * (sums**2 - np.add.reduceat(v**2, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weights[columns] * values, starts) + pairs, sums

    def score(self, texts: list[bytes]) -> np.ndarray:
        odds, _ = self.odds(*features(texts))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss, in small batches of shuffled rows."""
    rng = np.random.default_rng(seed)
    width = WORDS + STATS
    mean = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    machine = Machine(float(np.log(mean / (1 - mean))), np.zeros(width), rng.normal(0, 0.03, (width, RANK)))
    past_b, past_w, past_v = 1e-6, np.full(width, 1e-6), np.full((width, RANK), 1e-6)
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
            columns, values = (np.concatenate([rows[i][k] for i in at]) for k in (0, 1))
            ends = np.cumsum([len(rows[i][0]) for i in at])
            odds, sums = machine.odds(columns, values, ends)
            error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - label[at]) / len(at)
            owner = np.repeat(np.arange(len(at)), np.diff(np.concatenate(([0], ends))))
            pull = (error[owner] * values)[:, None]
            used, back = np.unique(columns, return_inverse=True)
            grad_w = np.bincount(back, pull[:, 0], len(used)) + _SHRINK * machine.weights[used]
            own = machine.vectors[columns] * values[:, None]
            grad_v = np.zeros((len(used), RANK))
            np.add.at(grad_v, back, pull * (sums[owner] - own))
            grad_v += _SHRINK * machine.vectors[used]
            past_b += error.sum() ** 2
            past_w[used] += grad_w**2
            past_v[used] += grad_v**2
            machine.bias -= _STEP * error.sum() / np.sqrt(past_b)
            machine.weights[used] -= _STEP * grad_w / np.sqrt(past_w[used])
            machine.vectors[used] -= _STEP * grad_v / np.sqrt(past_v[used])
    return machine


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine | None:
    """Fit on a bounded sample of the labelled rows; None without examples of both classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            columns, values, ends = features(texts)
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "label": batch.column("label").cast(pa.int32()),
                    "columns": pa.ListArray.from_arrays(offsets, pa.array(columns.astype(np.int32))),
                    "values": pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float32))),
                }
            )

    sample = labelled_sample(docs, labels, "quality", rows)
    got = sample.mapInArrow(run, "doc_id long, label int, columns array<int>, values array<float>").toArrow().sort_by("doc_id")
    label = got.column("label").to_numpy().astype(float)
    if len(np.unique(label)) < 2:
        return None
    columns, values = got.column("columns").combine_chunks(), got.column("values").combine_chunks()
    bounds = columns.offsets.to_numpy()
    flat_c, flat_v = columns.values.to_numpy().astype(np.int64), values.values.to_numpy().astype(float)
    return fit([(flat_c[a:b], flat_v[a:b]) for a, b in zip(bounds, bounds[1:])], label)


def quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the documents with ``quality_score`` (0 to 1) and ``quality_predicted`` (0 or 1)."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows))
    added = ["quality_score", "quality_predicted"]
    docs = docs.drop(*added)
    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField(added[0], DoubleType()), StructField(added[1], IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            s = np.full(len(texts), 0.5) if sent.value is None else sent.value.score(texts)
            columns = [*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    return docs.mapInArrow(run, schema)


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return quality(docs.select("doc_id", "text"), labels).select(
        "doc_id",
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_predicted").alias("predicted"),
    )
