"""A mix of sources to target weights, in blocks of words of a fixed length.

The documents of a source stand in a row, by a hash bucket and their id; the row is
cut into blocks of ``BLOCK_WORDS`` words. Sources by code point, null last, weigh
``WEIGHTS`` in turn and share ``SHARE`` of all words; none takes more than ``TWICE``
times what it has, and what is beyond is shared anew by weight.

The mix has output shards of ``SHARD_SLOTS`` slots. Each draws its sources' counts from a
multinomial of the targets, in a task of its own; then, from the last shard on, slots of
sources that drew too many are handed to those that drew too few, so that every source
ends within half a block of its target. The slots of a source, numbered over all shards, go
through a pseudorandom permutation of its block indexes, another one for every pass
over the source, and are joined with the blocks by index. A block, and so a word, is
taken at most as often as there are passes. All draws follow from ``SEED`` and the shard.

Words are separated by ASCII white space. A null or empty text has no words and is
never taken. Repeated rows are packed one by one. The driver holds a row for each source,
and nothing for a shard. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stateloom.llm.storage import stored
from stateloom.llm.words import TOKEN, Words, mix, pieces
from stateloom.sources.files import shared_dir

BLOCK_WORDS = 64
WEIGHTS = (5, 2, 1)
SHARE = 1.5
TWICE = 2
SEED = 20_261_201
#: Buckets that a source's documents, and its shards, are numbered in, each by one task.
BUCKETS = 1024
#: Slots of an output shard; the last one may have fewer.
SHARD_SLOTS = 1024
#: Slots that a task makes, about.
TASK_SLOTS = 250_000
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = TWICE) -> list[float]:
    """Target words of each source, given in order."""
    weight = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    cap = most * np.array(sizes, float)
    out, open_, rest = np.zeros(len(sizes)), np.ones(len(sizes), bool), share * float(sum(sizes))
    while open_.any():
        fair = rest * weight / weight[open_].sum()
        above = open_ & (fair > cap)
        if not above.any():
            out[open_] = fair[open_]
            break
        out[above] = cap[above]
        rest -= cap[above].sum()
        open_ &= ~above
    return out.tolist()


def _ahead(cells: DataFrame, shards: int, last_first: bool) -> DataFrame:
    """The cells of each source with the slots in its shards before (or behind) as ``before``, summed in two steps."""
    width = -(-shards // BUCKETS) or 1
    order = (lambda c: F.desc(c)) if last_first else F.asc
    cells = cells.withColumn("bucket", F.expr(f"shard div {width}"))
    outer = Window.partitionBy("source_no").orderBy(order("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("source_no", "bucket").orderBy(order("shard")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = cells.groupBy("source_no", "bucket").agg(F.sum("n").alias("all"))
    buckets = buckets.select("source_no", "bucket", F.coalesce(F.sum("all").over(outer), F.lit(0)).alias("outer"))
    cells = cells.withColumn("inner", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(buckets, ["source_no", "bucket"])
    return cells.withColumn("before", F.col("outer") + F.col("inner")).drop("outer", "inner", "bucket")


def plan(spark: SparkSession, slots: np.ndarray, folder: str, seed: int = SEED) -> DataFrame:
    """shard, source_no and n: slots of each source in each output shard, summing to those given by source."""
    total = int(slots.sum())
    shards = -(-total // SHARD_SLOTS)
    share = slots / max(total, 1)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column("id").to_numpy()
            sizes = np.minimum(SHARD_SLOTS, total - shard * SHARD_SLOTS)
            n = [np.random.default_rng((seed, k)).multinomial(size, share) for k, size in zip(shard.tolist(), sizes.tolist())]
            n = np.stack(n) if n else np.zeros((0, len(slots)), np.int64)
            row, source = np.nonzero(n)
            yield pa.record_batch({"shard": shard[row], "source_no": source.astype(np.int32), "n": n[row, source].astype(np.int64)})

    cells = "shard long, source_no int, n long"
    parts = 1 + total // TASK_SLOTS
    drawn = stored(spark.range(0, shards, 1, parts).mapInArrow(draw, cells), folder, "drawn")
    over = -slots.copy()
    for row in drawn.groupBy("source_no").agg(F.sum("n").alias("n")).collect():
        over[row["source_no"]] += row["n"]
    # The slots that are given, in one row over all sources, meet those that are lacking in another.
    give, lack = np.maximum(over, 0), np.maximum(-over, 0)
    givers = [(int(k), int(give[k]), int(give[:k].sum())) for k in np.flatnonzero(give)]
    if givers:
        ends = np.cumsum(lack)
        given = drawn.join(spark.createDataFrame(givers, "source_no int, give long, start long"), "source_no")
        given = _ahead(given, shards, True).withColumn("taken", F.least("n", F.greatest(F.col("give") - F.col("before"), F.lit(0))))
        given = stored(given.where("taken > 0").select("shard", "source_no", "taken", (F.col("start") + F.col("before")).alias("at")), folder, "given")

        def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                shard, taken, at = (batch.column(c).to_numpy() for c in ("shard", "taken", "at"))
                first, last = np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + taken, "left")
                row = np.repeat(np.arange(len(at)), last - first + 1)
                source = first[row] + np.arange(len(row)) - np.searchsorted(row, row)
                low, high = np.maximum(at[row], ends[source] - lack[source]), np.minimum((at + taken)[row], ends[source])
                yield pa.record_batch({"shard": shard[row], "source_no": source.astype(np.int32), "n": high - low})

        taken = given.select("shard", "source_no", (-F.col("taken")).alias("n"))
        drawn = drawn.union(taken).union(given.mapInArrow(receive, cells))
        drawn = drawn.groupBy("shard", "source_no").agg(F.sum("n").alias("n")).where("n > 0")
        drawn = stored(drawn, folder, "plan")
    return drawn


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A permutation of 0 to size - 1 for each key: four Feistel rounds, walked until within the size."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    half = half.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for turn in range(4):
            left, right = right, left ^ (mix(right + mix(key[todo] + np.uint64(turn))) & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def mixture(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with their sizes and targets, and the pieces of the mix.

    Documents: doc_id, source, text_hash, size, source_size, target, and ``source_no`` and
    ``begin``, which name a row. Pieces: shard, slot (its place in the shard), pass,
    source_no, begin, first_word and n_words of the document.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(BUCKETS)).cast("int"))
    sized = stored(sized, folder, "sizes")
    rows = sorted(
        ((r[0], r[1]) for r in sized.groupBy("source").agg(F.sum("size")).collect()), key=lambda r: (r[0] is None, r[0] or "")
    )
    sizes = [r[1] for r in rows]
    target = targets(sizes)
    blocks = np.array([-(-n // BLOCK_WORDS) for n in sizes], np.int64)
    # In words, so that a short last block does not count as a full one.
    slots = np.array([min(TWICE * b, round(t * b / n)) if n else 0 for t, b, n in zip(target, blocks.tolist(), sizes)], np.int64)
    total = int(slots.sum())
    shards = -(-total // SHARD_SLOTS)
    sources = spark.createDataFrame(
        [(i, r[0], r[1], t) for i, (r, t) in enumerate(zip(rows, target))],
        "source_no int, named string, source_size long, target double",
    )
    numbered = sized.join(sources, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    ahead = numbered.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.select("source_no", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        numbered.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(ahead, ["source_no", "bucket"])
        .withColumn("begin", F.col("ahead") + F.col("own"))
        .drop("ahead", "own", "bucket")
    )
    placed = stored(placed, folder, "placed")

    # The slots of a shard are numbered in a random order.
    in_shard = Window.partitionBy("shard").orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    wide = F.least(F.lit(SHARD_SLOTS).cast("long"), F.lit(total).cast("long") - F.col("shard") * SHARD_SLOTS)
    kinds = spark.createDataFrame([(i, int(n)) for i, n in enumerate(blocks)], "source_no int, blocks long")
    cells = _ahead(plan(spark, slots, folder), shards, False).withColumnRenamed("before", "offset")
    cells = cells.withColumns({"ahead": F.coalesce(F.sum("n").over(in_shard), F.lit(0)), "wide": wide}).join(kinds, "source_no")
    # A number of partitions is stated, so that rows are not brought together before they become slots.
    drawn = cells.repartition(1 + total // TASK_SLOTS, "shard", "source_no")
    drawn = drawn.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            turn, index = np.divmod(c["offset"] + c["i"], c["blocks"])
            key = mix(c["source_no"].astype(np.uint64) * np.uint64(1 << 32) + turn.astype(np.uint64) + np.uint64(SEED))
            slot = permuted(c["ahead"] + c["i"], c["wide"], mix(c["shard"].astype(np.uint64) + np.uint64(SEED + 1)))
            yield pa.record_batch(
                {
                    "shard": c["shard"], "slot": slot, "pass": turn.astype(np.int32), "source_no": c["source_no"],
                    "block": permuted(index, c["blocks"], key),
                }
            )

    slots_ = drawn.mapInArrow(place, "shard long, slot long, pass int, source_no int, block long")
    size = F.lit(BLOCK_WORDS).cast("long")
    cut = placed.where("size > 0").select(
        "source_no",
        "begin",
        "size",
        F.explode(F.sequence(F.floor(F.col("begin") / size), F.floor((F.col("begin") + F.col("size") - 1) / size))).alias("block"),
    )
    first = F.greatest(F.lit(0).cast("long"), F.col("block") * size - F.col("begin"))
    last = F.least(F.col("size"), (F.col("block") + 1) * size - F.col("begin"))
    cut = cut.select("source_no", "block", "begin", first.alias("first_word"), (last - first).alias("n_words"))
    return placed, slots_.join(cut, ["source_no", "block"]).drop("block")


def contract(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of every document."""
    placed, taken = mixture(docs)
    taken = taken.groupBy("source_no", "begin").agg(F.sum("n_words").alias("taken"))
    # Rows without words share the place of the next row.
    match = (placed["source_no"] == taken["source_no"]) & (placed["begin"] == taken["begin"]) & (placed["size"] > 0)
    return placed.join(taken, match, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes something of, with the text it takes, and all their columns.

    A text is what the first pass takes, in order, and behind it what further passes
    take, on a line of its own. A text taken once and whole stays as it is. Rows that
    repeat an id, source and text become one. ``n_chars``, where there is one, follows the text.
    """
    placed, taken = mixture(docs)
    whole = (
        taken.groupBy("source_no", "begin")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "first_word", "n_words"))).alias("taken"))
        .join(placed.where("size > 0"), ["source_no", "begin"])
        .groupBy("doc_id", "source", "text_hash")
        .agg(F.sort_array(F.flatten(F.collect_list("taken"))).alias("taken"))
    )
    names = docs.columns
    # Columns are numbered while pieces stand beside them, so that no name can clash.
    numbers = [f"column_{k}" for k in range(len(names))]
    numbered = docs.toDF(*numbers)
    of = dict(zip(names, numbers))
    keyed = numbered.select("*", F.col(of["doc_id"]).cast("long").alias("d"), F.col(of["source"]).alias("s"), F.xxhash64(of["text"]).alias("h"))
    match = keyed["d"].eqNullSafe(whole["doc_id"]) & keyed["s"].eqNullSafe(whole["source"]) & (keyed["h"] == whole["text_hash"])
    pieced = keyed.join(whole, match).dropDuplicates(["d", "s", "h"]).select(*numbers, F.col("taken").alias("pieces"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, of["text"]):
            words = Words(texts, TOKEN, lower=False)
            out = []
            for i, (text, rows) in enumerate(zip(texts, batch.column("pieces").to_pylist())):
                at = np.append(words.starts[words.first[i] : words.first[i + 1]] - words.text_starts[i], len(text))
                at[0] = 0
                spans: list[list[int]] = []
                for row in rows:
                    begin, turn = row["first_word"], row["pass"]
                    if spans and spans[-1][0] == turn and spans[-1][2] == begin:
                        spans[-1][2] += row["n_words"]
                    else:
                        spans.append([turn, begin, begin + row["n_words"]])
                parts: list[bytes] = []
                for k, (turn, begin, end) in enumerate(spans):
                    if k:
                        parts.append(b"\n" if spans[k - 1][0] != turn else b" ")
                    parts.append(text[at[begin] : at[end]] if k + 1 == len(spans) and end == len(at) - 1 else text[at[begin] : at[end]].rstrip(b" \t\n\v\f\r"))
                out.append(b"".join(parts).decode())
            columns = []
            for name in names:
                if name == "text":
                    columns.append(pa.array(out, pa.string()))
                elif name == "n_chars":
                    columns.append(pa.array([len(t) for t in out], pa.int64()).cast(batch.schema.field(of[name]).type))
                else:
                    columns.append(batch.column(of[name]))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return pieced.mapInArrow(cut, docs.schema)
