"""Token ids in Huffman-coded files.

Texts become ids of a public tokenizer, each document with an end id behind it.
Global counts of the ids give one canonical code, no word of it longer than
``MAX_BITS`` (package-merge). Documents are ordered by id over range partitions, and
each partition's documents are packed into blocks of about ``BLOCK_IDS`` ids, never
cutting a document. A block is decoded alone, with a table over ``MAX_BITS`` bits: its
checkpoints hold the bit offset of every ``STEP``-th id, so that all stretches between
them are decoded side by side, one id of each at a time.

A set of files is a folder with three Parquet tables: ``codebook`` (id, bits),
``shards`` (shard, start, ids: where each shard begins in the whole) and ``blocks``
(shard, block, start within the shard, doc_ids, lengths, checkpoints, payload).

Equal words are encoded once for a run of texts by the tokenizers library; texts where
that could differ from encoding the whole (special strings, text not in normal form C,
a capital sigma) go to the library whole. A null
or empty text is its end id alone. Rows that repeat an id are kept, beside each
other; rows of a null id come first.
"""

from __future__ import annotations

import codecs
import functools
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stateloom.llm.storage import stored
from stateloom.llm.words import give_back, pieces
from stateloom.sources.files import shared_dir

END_ID = 1
MAX_BITS = 20
STEP = 256
BLOCK_IDS = 1 << 16
#: Different words whose ids an encoder keeps, about, where it goes with its task, and bytes of text that it takes
#: at once: words and batches of a task are what its worker holds beside the session's other memory.
KEPT_WORDS = 64_000
SHORT_PIECE = 512 << 10
#: As many where it keeps its encoder between tasks.
KEPT_LONG = 500_000
#: Different runs of marks whose ids an encoder keeps.
KEPT_MARKS = 10_000
#: The tokenizer's own pattern of words (a fixed value of its file).
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Texts with one of these go to the library whole: special strings, a letter whose lower
#: case depends on its neighbours, and separators that only Python counts as white space.
_WHOLE = ("<|startoftext|>", "<|endoftext|>", "Σ", "\x1c", "\x1d", "\x1e", "\x1f")


#: The printable letter that stands for each byte in the model (byte-level BPE's own order).
_SHOWN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
_HIDDEN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_BYTE_LETTERS = "".join(chr(_HIDDEN.get(b, b)) for b in range(256))
#: What often stands behind a word, as one pre-token if it holds no letter and no digit.
_MARKS = "".join(chr(b) for b in range(0x21, 0x7F) if not chr(b).isalnum())


class _Places(dict):
    """The place of each word; a word not met before gets the next one and is noted."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.new.append(word)
        return place


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file. A worker reads it once: reading takes several times the memory of what is read."""
    return Tokenizer.from_file(path)


class WordEncoder:
    """Ids of whole texts, by a memory of the ids of their words.

    White space always parts pre-tokens and is no part of one, so a word between
    white space has the same ids in any text.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.kept = kept
        self.marks: dict[str, list[int]] = {}
        self._forget()

    def _forget(self, keep: int = 0) -> None:
        """Keep the words met most often."""
        old = list(self.place) if keep else []
        kept = np.argsort(-self.uses, kind="stable")[:keep] if keep else np.zeros(0, np.int64)
        self.place = _Places()
        for i in kept.tolist():
            self.place[old[i]] = len(self.place)
        if keep:
            n = self.sizes[kept]
            ends = np.cumsum(n)
            self.flat = self.flat[np.repeat(self.starts[kept] - ends + n, n) + np.arange(int(n.sum()))]
            self.sizes, self.uses, self.starts = n, self.uses[kept], ends - n
        else:
            self.flat, self.sizes, self.uses = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _part(self, part: str) -> list[int]:
        """Ids of a pre-token by the library's model, which takes it in its byte letters."""
        if not (part.isascii() and part.isprintable()):
            part = codecs.charmap_decode(part.encode(), "strict", _BYTE_LETTERS)[0]
        return [token.id for token in self.model.tokenize(part)]

    def _ids(self, word: str) -> list[int]:
        """Ids of a word. Letters with marks behind them are two pre-tokens, often known each."""
        if word.isalpha():
            return self._part(word)
        stem = word.rstrip(_MARKS)
        if not stem.isalpha():
            return [i for part in _WORDS.findall(word) for i in self._part(part)]
        marks = word[len(stem) :]
        behind = self.marks.get(marks)
        if behind is None:
            if len(self.marks) >= KEPT_MARKS:
                self.marks.clear()
            behind = self.marks[marks] = self._part(marks)
        at = self.place.get(stem, len(self.sizes))
        if at < len(self.sizes):
            begin = self.starts[at]
            return self.flat[begin : begin + self.sizes[at]].tolist() + behind
        return self._part(stem) + behind

    def _learn(self) -> None:
        """Ids of the words noted."""
        new = [self._ids(word) for word in self.place.new]
        self.place.new = []
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(new), np.uint16, int(sizes.sum()))))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.place) > self.kept:
            self._forget(self.kept // 2)
        words: list[str] = []
        counts, whole = [], {}
        if len(self.place) != len(self.sizes):  # a batch broke off behind noting its words
            self._forget()
        for i, raw in enumerate(texts):
            text = raw.decode()
            if any(s in text for s in _WHOLE) or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
                whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)
                counts.append(0)
            else:
                own = text.lower().split()
                counts.append(len(own))
                words += own
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        self._learn()
        met = np.bincount(at, minlength=len(self.sizes))
        met[: len(self.uses)] += self.uses
        self.uses = met
        n = self.sizes[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.starts[at] - ends + n, n) + np.arange(total)]
        # An end id behind each text, in one array that the texts' ids are slices of.
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))] + np.arange(len(texts) + 1)
        out = np.full(total + len(texts), END_ID, np.uint16)
        inner = np.ones(len(out), bool)
        inner[bounds[1:] - 1] = False
        out[inner] = flat
        return [np.append(whole[i], np.uint16(END_ID)) if i in whole else out[bounds[i] : bounds[i + 1]] for i in range(len(texts))]


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol in the best prefix code of at most ``most`` bits; 0 for a count of 0."""
    used = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        bits[used] = 1
        return bits
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    levels, merged = [], weight
    for _ in range(most):
        leaf = np.ones(len(weight), bool)
        if levels:
            pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
            both = np.concatenate((weight, pairs))
            at = np.argsort(both, kind="stable")
            merged, leaf = both[at], at < len(weight)
        levels.append(leaf)
    take = 2 * len(weight) - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        bits[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return bits


class Code:
    """A canonical code: shorter words first, ids in order within a length."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(np.uint64)
        used = np.flatnonzero(bits)
        order = used[np.lexsort((used, bits[used]))]
        n = bits[order]
        spans = np.left_shift(1, MAX_BITS - n)
        begins = np.cumsum(spans) - spans
        self.words = np.zeros(len(bits), np.uint64)
        self.words[order] = begins >> (MAX_BITS - n)
        self.table = np.zeros(1 << MAX_BITS, np.uint32)
        filled = np.repeat((order << 5) | n, spans)
        self.table[: len(filled)] = filled

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of the ids, and the offsets of every STEP-th."""
        n = self.bits[ids]
        ends = np.cumsum(n)
        begin = ends - n
        # A code word lies in one 32-bit word or two; no word is without a code's start but the last.
        where = (begin >> np.uint64(5)).astype(np.int64)
        shifted = self.words[ids] << (np.uint64(64) - n - (begin & np.uint64(31)))
        firsts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        high = np.add.reduceat(shifted >> np.uint64(32), firsts)
        low = np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), firsts)
        out = np.zeros(int(where[-1]) + 2, np.uint64)
        out[where[firsts]] += high
        out[where[firsts] + 1] += low
        payload = out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8]
        return payload, begin[::STEP].astype(np.int64)

    def decode(self, payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> np.ndarray:
        """All ids of some blocks, each stretch between checkpoints a lane."""
        joined = np.frombuffer(b"".join(p + b"\0" * 8 for p in payloads), np.uint8).astype(np.uint32)
        view = (joined[:-3] << 24) | (joined[1:-2] << 16) | (joined[2:-1] << 8) | joined[3:]
        base = np.cumsum([0] + [len(p) + 8 for p in payloads])[:-1] * 8
        at = np.concatenate([c + b for c, b in zip(checkpoints, base)])
        lanes = [np.minimum(STEP, n - STEP * np.arange(len(c))) for c, n in zip(checkpoints, counts)]
        sizes = np.concatenate(lanes)
        out = np.zeros((STEP, len(at)), np.uint32)
        last = (len(view) - 1) * 8
        for k in range(int(sizes.max(initial=0))):
            np.minimum(at, last, out=at)  # short lanes run on over what they do not need
            entry = self.table[(view[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)]
            out[k] = entry >> 5
            at += entry & 31
        return out.T[np.arange(STEP) < sizes[:, None]]


#: Encoders that a worker keeps between tasks, with the words they remember.
_KEPT: dict[str, WordEncoder] = {}


def _encoder(path: str, keep: bool) -> WordEncoder:
    if not keep:  # it goes with the task, and so do its words
        return WordEncoder(path)
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = WordEncoder(path, KEPT_LONG)
    return _KEPT[path]


def _encoded(docs: DataFrame, path: str, keep: bool) -> DataFrame:
    """doc_id, n and ids (two bytes each) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, keep)
        for batch, texts in pieces(batches, most=None if keep else SHORT_PIECE):
            ids = encoder.encode(texts)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n": pa.array([len(i) for i in ids], pa.int64()),
                    "ids": pa.array([i.astype("<u2").tobytes() for i in ids], pa.binary()),
                }
            )
            del batch, texts, ids
        if not keep:
            del encoder
            give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, ids binary")


def _counts(encoded: DataFrame, vocabulary: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for _, ids in pieces(batches, "ids"):
            total += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.record_batch({"id": used, "n": total[used]})

    rows = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, np.int64)
    counts[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return counts


_BLOCKS = "shard int, block int, start long, doc_ids array<long>, lengths array<long>, checkpoints array<long>, payload binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, keep: bool = False) -> None:
    """Encode all texts and write them as a set of files under ``path``, ordered by doc_id.

    ``keep`` has workers keep their encoder between tasks: words are learned once a worker
    and not once a task, for the memory of ``KEPT_LONG`` words as long as the worker lives.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    if vocabulary > 1 << 16:
        raise ValueError("ids of more than two bytes")
    # Stored once, since encoding costs more than reading back.
    encoded = stored(_encoded(docs, tokenizer, keep), folder, "ids")
    bits = code_lengths(_counts(encoded, vocabulary))
    sent = spark.sparkContext.broadcast(bits)
    spark.createDataFrame(pa.table({"id": np.arange(vocabulary), "bits": bits})).coalesce(1).write.parquet(f"{path}/codebook")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block, start = TaskContext.get().partitionId(), 0, 0
        code = Code(sent.value)
        doc_ids: list = []
        ids: list[bytes] = []
        held = 0

        def full() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), "<u2")
            payload, checkpoints = code.encode(flat)
            return pa.record_batch(
                {
                    "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()), "start": pa.array([start], pa.int64()),
                    "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "lengths": pa.array([[len(i) // 2 for i in ids]], pa.list_(pa.int64())),
                    "checkpoints": pa.array([checkpoints], pa.list_(pa.int64())), "payload": pa.array([payload], pa.binary()),
                }
            )

        for batch, every in pieces(batches, "ids"):
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), every):
                doc_ids.append(doc_id)
                ids.append(own)
                held += len(own) // 2
                if held >= BLOCK_IDS:
                    yield full()
                    block, start, held, doc_ids, ids = block + 1, start + held, 0, [], []
        if ids:
            yield full()

    ordered = encoded.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(pack, _BLOCKS).write.parquet(f"{path}/blocks")
    total = F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x))
    # One row for each range partition.
    shards = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(total.alias("n")).toArrow().sort_by("shard")
    n = shards.column("n").to_numpy().astype(np.int64)
    table = pa.table({"shard": shards.column("shard").cast(pa.int32()), "start": pa.array(np.cumsum(n) - n, pa.int64()), "ids": pa.array(n, pa.int64())})
    schema = "shard int, start long, ids long"
    spark.createDataFrame(table.to_pandas() if len(table) else [], schema).coalesce(1).write.parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (array) of every document in a set of files."""
    bits = _bits(spark, path)
    sent = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, ids, ends in _decoded(batches, Code(sent.value)):
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            yield pa.record_batch(
                {"doc_id": pa.array(doc_ids, pa.int64()), "start": starts, "ids": pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))}
            )

    return _blocks(spark, path).mapInArrow(run, "doc_id long, start long, ids array<int>")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids of every document in a set of files."""
    bits = _bits(spark, path)
    sent = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, ids, ends in _decoded(batches, Code(sent.value)):
            begins = np.concatenate(([0], ends[:-1]))
            raw = memoryview(ids.astype("<u4").tobytes())
            yield pa.record_batch(
                {
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": starts, "n_tokens": ends - begins,
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist())], pa.int64()),
                }
            )

    return _blocks(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _bits(spark: SparkSession, path: str) -> np.ndarray:
    return spark.read.parquet(f"{path}/codebook").toArrow().sort_by("id").column("bits").to_numpy()


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("ahead"))
    return spark.read.parquet(f"{path}/blocks").join(F.broadcast(shards), "shard").withColumn("start", F.col("start") + F.col("ahead"))


def _decoded(batches: Iterator[pa.RecordBatch], code: Code, most: int = 1 << 20) -> Iterator[tuple]:
    """doc_ids, starts, ids and ends of the documents of some blocks at a time."""

    def some(rows: list[dict]) -> tuple:
        lengths = [np.array(r["lengths"], np.int64) for r in rows]
        ids = code.decode([r["payload"] for r in rows], [np.array(r["checkpoints"], np.int64) for r in rows], [int(n.sum()) for n in lengths])
        starts = np.concatenate([r["start"] + np.cumsum(n) - n for r, n in zip(rows, lengths)])
        return [d for r in rows for d in r["doc_ids"]], starts, ids, np.cumsum(np.concatenate(lengths))

    for batch in batches:
        rows, held = [], 0
        for i in range(batch.num_rows):
            rows.append(batch.slice(i, 1).to_pylist()[0])
            held += sum(rows[-1]["lengths"])
            if held >= most:
                yield some(rows)
                rows, held = [], 0
        if rows:
            yield some(rows)


def contract(docs: DataFrame, tokenizer: str, keep: bool = False) -> DataFrame:
    """Write all documents as token files and read back doc_id, start, n_tokens and ids_crc32."""
    path = f"{shared_dir(docs.sparkSession)}/tokens"
    write_token_files(docs, path, tokenizer, keep)
    return digest(docs.sparkSession, path)
