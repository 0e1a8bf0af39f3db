"""N-gram Jaccard join by PartEnum signatures, and its connected components.

Words are taken without upper case; a text's set is its different shingles. Sizes
fall into bands, each reaching from a size to that size by the threshold. Sets that
are similar enough lie in one band or in neighbouring ones, and for each band differ
in at most k shingles. The domain of shingles is split into groups, each group into
parts, and a signature is taken of every subset of a group's parts that leaves one out.
Each difference falls into one part, so two sets within k have a number of equal
subsets that follows from k alone, t + 1 say. The t subsets of a set that hold fewest
shingles are not used: an equal subset that holds most cannot be among them, for the
others are before it in both sets. So two sets within k still share a signature, and
none is of an empty part, which any two sets could share.

Equal sets are collapsed first. Sets that share a signature are compared in rounds:
with one pivot of the signature's members, then with others, and at last with all
members, but only where they are not yet connected, since a link within a component
changes nothing. A pair is compared by its sketches, a bound on the difference that
cannot miss, and then by the shingles of both whole texts. No link is lost.

A null or empty text has an empty set, size 0, and is linked with nothing; fewer
words than a shingle are one shingle. Rows of a null id are never linked with others.
Repeated rows are repeated in the result. Rows that repeat an id with different sets
are linked by their own sets: a set has a number, its node, and ids come at the end.
Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from stateloom.llm.bitmap import bitmap, may_hold
from stateloom.llm.components import components
from stateloom.llm.storage import dropped, stored
from stateloom.llm.words import Words, column_bytes, mix, pieces, shingles
from stateloom.sources.files import shared_dir

WORDS = 3
PERCENT = 90
#: 64-bit words of a set's sketch.
SKETCH = 16
#: Rounds with one pivot a signature before all unconnected members are compared.
PIVOT_ROUNDS = 2
#: Below this many differences groups have three parts, else two.
FEW = 8
#: Bytes of text handled at once: signatures take more room than words.
PIECE = 1 << 20
#: Sets that a task remembers, so that it passes on the signatures of copies once.
REMEMBERED = 200_000
#: Bits of a shingle's hash that count.
_BITS = np.uint64(48)
_MASK = np.uint64((1 << 48) - 1)


def distinct_shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text, sorted, and their texts."""
    grams, owner = shingles(Words(texts), n)
    key = (owner.astype(np.uint64) << _BITS) | (grams >> np.uint64(16))
    key.sort()
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return key & _MASK, (key >> _BITS).astype(np.int64)


def _bands(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The band of every size up to the largest, and the last size of every band, one more than used."""
    last, ends = 0, []
    while last < largest or len(ends) < 2:
        last = (last + 1) * 100 // percent
        ends.append(last)
    ends.append((last + 1) * 100 // percent)
    ends = np.array(ends)
    return np.searchsorted(ends, np.arange(largest + 1)), ends


def _plan(k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups, parts of a group, and signatures left out, for sets that differ in k shingles at most.

    Of a group's subsets without one part all are equal where nothing differs, one where a
    single part does, and none else. The fewest are equal in all where differences hit as many
    groups as there are, and behind that one group after the other a second time.
    """
    parts = np.where(k == 0, 1, np.where(k < FEW, 3, 2))
    groups = np.where(k == 0, 1, np.where(k < FEW, (3 * k + 3) // 4 + 1, (7 * (k + 1) + 9) // 10))
    equal = np.where(k <= groups, parts * groups - (parts - 1) * k, 2 * groups - k)
    return groups, parts, np.where(k == 0, 0, equal - 1)


def signatures(f: np.ndarray, owner: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets given as shingles and owners, and whose they are."""
    band, ends = _bands(int(sizes.max(initial=1)), percent)
    out, whose = [], []
    for step in (0, 1):
        instance = band[sizes] + step
        # |a| + |b| <= 2r and 100 |a & b| >= percent |a | b| leave this many differences at most.
        k = 2 * ends[instance] * (100 - percent) // (100 + percent)
        # One shingle more or less is too much for a small set, which then has one signature.
        k = np.where(100 * sizes < percent * (sizes + 1), 0, k)
        groups, parts, left_out = _plan(k)
        width = np.where(sizes > 0, groups * parts, 0)
        base = np.concatenate(([0], np.cumsum(width)))
        seed = mix(np.arange(len(ends), dtype=np.uint64) + np.uint64(977))[instance]
        h = mix(f ^ seed[owner])
        cell = base[owner] + (h >> np.uint64(40)).astype(np.int64) % width[owner]
        sums = np.zeros(int(base[-1]), np.uint64)
        np.add.at(sums, cell, mix(h + np.uint64(1)))
        holds = np.bincount(cell, minlength=int(base[-1]))
        who = np.repeat(np.arange(len(sizes)), width)
        number = np.arange(int(base[-1])) - base[who]
        # With two parts, leaving one out is taking the other; with three, it is the group less a part.
        three = np.flatnonzero(parts[who] == 3)
        sums[three] = np.repeat(sums[three].reshape(-1, 3).sum(axis=1, dtype=np.uint64), 3) - sums[three]
        holds[three] = np.repeat(holds[three].reshape(-1, 3).sum(axis=1), 3) - holds[three]
        signature = mix(sums + seed[who] + mix(number.astype(np.uint64)))
        # One order for all sets: by shingles held, then by signature.
        order = np.lexsort((signature, holds, who))
        used = order[np.arange(len(order)) - base[who[order]] >= left_out[who[order]]]
        out.append(signature[used])
        whose.append(who[used])
    return np.concatenate(out), np.concatenate(whose)


def _identities(f: np.ndarray, owner: np.ndarray, count: int) -> list[np.ndarray]:
    """Two hashes of each set, 128 bits together."""
    sums = [np.zeros(count, np.uint64) for _ in range(2)]
    for k in (0, 1):
        np.add.at(sums[k], owner, mix(f + np.uint64(11 + k)))
    return [x.view(np.int64) for x in sums]


def _sketches(f: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """For each set and each of the cells of the domain, whether it has an odd number of shingles there.

    One shingle more or less changes one cell, so two sets differ in as many shingles
    at least as their sketches do in bits.
    """
    cell = mix(f + np.uint64(23)) % np.uint64(64 * SKETCH)
    out = np.zeros(count * SKETCH, np.uint64)
    np.bitwise_xor.at(out, owner * SKETCH + (cell >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cell & np.uint64(63)))
    return out.view(np.int64)


def _keys(doc_id: pa.Array, set_a: np.ndarray) -> np.ndarray:
    """A hash of each row's id and set, to rule rows out by."""
    ids = doc_id.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return mix(set_a.view(np.uint64) + mix(ids.view(np.uint64))).view(np.int64)


_SETS = "doc_id long, size long, set_a long, set_b long, key long, sketch array<long>"


def _described(docs: DataFrame, n: int) -> DataFrame:
    """The size, the hashes and the sketch of each row's set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, most=PIECE):
            f, owner = distinct_shingles(texts, n)
            count = len(texts)
            set_a, set_b = _identities(f, owner, count)
            even = np.arange(0, (count + 1) * SKETCH, SKETCH, dtype=np.int32)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "size": np.bincount(owner, minlength=count).astype(np.int64),
                    "set_a": set_a,
                    "set_b": set_b,
                    "key": _keys(batch.column("doc_id"), set_a),
                    "sketch": pa.ListArray.from_arrays(even, _sketches(f, owner, count)),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(describe, _SETS)


def _signed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Rows of a signature and a set that has it; a task leaves out sets it has seen lately."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, texts in pieces(batches, most=PIECE):
            f, owner = distinct_shingles(texts, n)
            set_a, _ = _identities(f, owner, len(texts))
            fresh = np.zeros(len(texts), bool)
            fresh[np.unique(set_a, return_index=True)[1]] = True
            fresh &= np.array([x not in seen for x in set_a.tolist()])
            if len(seen) > REMEMBERED:
                seen.clear()
            seen.update(set_a[fresh].tolist())
            of = fresh[owner]
            sizes = np.bincount(owner[of], minlength=len(texts))
            signature, whose = signatures(f[of], owner[of], sizes, percent)
            yield pa.record_batch({"signature": signature.view(np.int64), "one": set_a[whose]})

    return docs.where("doc_id is not null").select("text").mapInArrow(sign, "signature long, one long")


def _shared(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (signature, set): the different sets of each signature that has two or more.

    Reads on over the ends of batches, holding one row back.
    """
    last_sig = last_set = None
    waiting = False  # the last row is the first of its signature, not yet known to be shared
    for batch in rows:
        sig, one = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        if not len(sig):
            continue
        new_sig = np.concatenate(([sig[0] != last_sig], sig[1:] != sig[:-1]))
        fresh = new_sig | np.concatenate(([one[0] != last_set], one[1:] != one[:-1]))
        sig, one, new_sig = sig[fresh], one[fresh], new_sig[fresh]
        if not len(sig):
            continue
        if waiting and not new_sig[0]:
            yield pa.record_batch({"signature": np.array([last_sig]), "one": np.array([last_set])})
        followed = np.concatenate((~new_sig[1:], [False]))
        keep = ~new_sig | followed
        waiting = bool(new_sig[-1])
        last_sig, last_set = sig[-1], one[-1]
        if keep.any():
            yield pa.record_batch({"signature": sig[keep], "one": one[keep]})


def _likely(percent: int) -> Column:
    """Whether sketches leave room for a link between a row and one with p before its names.

    It is a condition of the join, so that pairs it rules out are never rows.
    """
    apart = sum(F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("p_sketch")[k])) for k in range(SKETCH))
    total = F.col("size") + F.col("p_size")
    return apart * (100 + percent) <= total * (100 - percent)


def _links(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs that are links, by the shingles of both whole texts."""
    for side in "uv":
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")), side)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, left in pieces(batches, "text_u", PIECE):
            right = column_bytes(batch.column(batch.schema.get_field_index("text_v")))
            a, b = (np.unique((o.astype(np.uint64) << _BITS) | f) for f, o in (distinct_shingles(t, n) for t in (left, right)))
            sizes = [np.bincount((x >> _BITS).astype(np.int64), minlength=len(left)) for x in (a, b)]
            both = np.bincount((np.intersect1d(a, b, assume_unique=True) >> _BITS).astype(np.int64), minlength=len(left))
            linked = 100 * both >= percent * (sizes[0] + sizes[1] - both)
            yield batch.select(["u", "v"]).filter(pa.array(linked))

    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(compare, "u long, v long")


def _ordered(u: str, v: str) -> list[Column]:
    return [F.greatest(u, v).alias("u"), F.least(u, v).alias("v")]


def _with_sets(docs: DataFrame, n: int, bits: Broadcast) -> DataFrame:
    """The same rows with the hashes of each text's set, and whether the row's key may be among those of the bitmap."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, most=PIECE):
            set_a, set_b = _identities(*distinct_shingles(texts, n), len(texts))
            among = may_hold(bits.value, _keys(batch.column("doc_id"), set_a))
            for name, column in (("set_a", set_a), ("set_b", set_b), ("among", among)):
                batch = batch.append_column(name, pa.array(column))
            yield batch

    added = [StructField("set_a", LongType()), StructField("set_b", LongType()), StructField("among", BooleanType())]
    return docs.mapInArrow(add, StructType([*docs.schema.fields, *added]))


def _likely_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose sketches leave room for a link."""
    left = sets.select(F.col("node").alias("u"), "size", "sketch")
    right = sets.select(F.col("node").alias("v"), F.col("size").alias("p_size"), F.col("sketch").alias("p_sketch"))
    return pairs.join(left, "u").join(right, "v").where(_likely(percent)).select("u", "v")


def _texts(docs: DataFrame, wanted: DataFrame, n: int, path: str) -> DataFrame:
    """node and text of the wanted sets, stored; only rows that may be wanted are shuffled."""
    bits = bitmap(wanted, "key")
    found = _with_sets(docs.where("doc_id is not null"), n, bits).where("among").drop("among")
    found = found.join(wanted, ["doc_id", "set_a", "set_b"]).select("node", "text").dropDuplicates(["node"])
    result = stored(found, *path.rsplit("/", 1))
    bits.destroy()
    return result


def _linked(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, str]:
    """All rows with their sets; of each set that has an id, the first (doc_id, set_a, set_b) of its component; and
    the folder that holds both."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(_described(docs, n), folder, "rows")
    # One row for each different set, under its smallest id.
    sets = stored(
        rows.where("size > 0 and doc_id is not null")
        .groupBy("set_a", "set_b", "size")
        .agg(F.min(F.struct("doc_id", "key")).alias("least"), F.first("sketch").alias("sketch"))
        .select("set_a", "set_b", "size", "least.doc_id", "least.key", "sketch")
        .withColumn("node", F.monotonically_increasing_id()),
        folder,
        "sets",
    )
    rows = stored(rows.drop("sketch"), folder, "plain")
    dropped(spark, folder, "rows")
    shared = (
        _signed(docs, n, percent)
        .repartition("signature")
        .sortWithinPartitions("signature", "one")
        .mapInArrow(_shared, "signature long, one long")
    )
    shared = stored(shared, folder, "shared")
    # Signatures with the same members say the same: one of them is enough.
    alike = shared.groupBy("signature").agg(
        F.count("*").alias("members"), F.expr("bit_xor(one)").alias("x"), F.expr("bit_xor(xxhash64(one))").alias("y")
    )
    alike = alike.groupBy("members", "x", "y").agg(F.min("signature").alias("signature")).select("signature")
    members = stored(
        shared.join(alike, "signature", "left_semi")
        .join(sets.select(F.col("set_a").alias("one"), "node"), "one")
        .select("signature", "node"),
        folder,
        "members",
    )
    dropped(spark, folder, "shared")

    found, tested = None, None  # links between sets as (node, component); pairs compared so far
    for turn in range(PIVOT_ROUNDS + 1):
        now = members.withColumn("component", F.col("node"))
        if found is not None:
            now = members.join(found, "node", "left").select(*members.columns, F.coalesce("component", "node").alias("component"))
            spread = now.groupBy("signature").agg(
                F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n")
            )
            # Two members have been compared with each other in the first turn.
            spread = spread.where("a <> b and n > 2").select("signature")
            now = stored(now.join(spread, "signature", "left_semi"), folder, f"open-{turn}")
        names = [F.col("signature").alias("s"), F.col("node").alias("p_node"), F.col("component").alias("p_component")]
        apart = (F.col("signature") == F.col("s")) & (F.col("component") != F.col("p_component"))
        if turn < PIVOT_ROUNDS:
            best = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), "node", "component"))
            pivots = now.groupBy("signature").agg(best.alias("best")).select("signature", "best.node", "best.component")
            pairs = now.join(pivots.select(*names), apart).select(*_ordered("node", "p_node")).distinct()
            pairs = _likely_pairs(pairs, sets, percent)
        else:  # all that are not of the component with most members
            count = now.groupBy("signature", "component").agg(F.count("*").alias("n"))
            main = count.groupBy("signature").agg(F.max(F.struct("n", "component")).alias("best"))
            others = now.join(main, "signature").where("component <> best.component").drop("best")
            # Sketches rule pairs out within the join here, where every two members would be a row.
            sketched = sets.select("node", "size", "sketch")
            others = others.join(sketched, "node").select(*names, F.col("size").alias("p_size"), F.col("sketch").alias("p_sketch"))
            pairs = now.join(sketched, "node").join(others, apart & _likely(percent)).select(*_ordered("node", "p_node")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = stored(pairs, folder, f"pairs-{turn}")
        dropped(spark, folder, f"open-{turn}")
        if pairs.isEmpty():
            if found is None:
                found = spark.createDataFrame([], "node long, component long")
            continue
        tested = pairs if tested is None else tested.union(pairs)
        wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
        wanted = wanted.join(sets.select("node", "doc_id", "set_a", "set_b", "key"), "node")
        texts = _texts(docs, wanted, n, f"{folder}/texts-{turn}")
        links = stored(_links(pairs, texts, n, percent), folder, f"found-{turn}")
        dropped(spark, folder, f"texts-{turn}")
        if found is not None:
            links = links.union(found.select(F.col("node").alias("u"), F.col("component").alias("v")))
        found = components(links, folder, f"links-{turn}")

    named = sets.join(found, "node", "left").select(
        "set_a", "set_b", "size", "doc_id", F.coalesce("component", "node").alias("component")
    )
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "set_a", "set_b")).alias("first"))
    least = stored(named.join(first, "component").select("set_a", "set_b", "size", "first"), folder, "least")
    for name in ("members", "sets"):
        dropped(spark, folder, name)
    return rows.select("doc_id", "size", "set_a", "set_b", "key"), least, folder


def jaccard_components(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest linked doc_id, directly or not) of every row."""
    rows, least, _ = _linked(docs, n, percent)
    named = (F.col("size") > 0) & F.col("doc_id").isNotNull()
    return rows.join(least, ["set_a", "set_b", "size"], "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(named, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def without_near_copies(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """One row of each component, that of the smallest id and set; all rows of a null id, one of an id's empty sets.

    Only rows that may go are shuffled: those of other sets than the ones that stay, and
    those that repeat an id and a set.
    """
    rows, least, folder = _linked(docs, n, percent)
    empty = rows.where("size = 0 and doc_id is not null").select("doc_id", "set_a", "set_b")
    kept = stored(least.select("first.*").union(empty).distinct(), folder, "kept")
    own = rows.where("doc_id is not null").groupBy("doc_id", "set_a", "set_b").agg(F.count("*").alias("n"), F.first("key").alias("key"))
    going = own.join(kept.withColumn("stays", F.lit(True)), ["doc_id", "set_a", "set_b"], "left")
    bits = bitmap(going.where("stays is null or n > 1"), "key")

    # Columns are numbered while sets stand beside them, so that no name can clash.
    places = {c: f"column_{k}" for k, c in enumerate(docs.columns)}
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(c).alias(places[c]) for c in docs.columns if c not in ("doc_id", "text")))
    back = [F.col(c if c in ("doc_id", "text") else places[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    marked = _with_sets(numbered, n, bits)
    safe = marked.where("doc_id is null or not among")
    rest = marked.where("doc_id is not null and among").join(kept, ["doc_id", "set_a", "set_b"], "left_semi")
    return safe.select(*back).union(rest.dropDuplicates(["doc_id", "set_a", "set_b"]).select(*back))
