"""Classifiers, language model, license scan, token counts and files, mixing, and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD, documents, prose
from tokenizers import Tokenizer

import corpus_pipeline
from stateloom.llm import backoff, license_scan, mixing, quality, token_counts, token_files, toxicity
from stateloom.llm.queries import tokenizer
from stateloom.llm.storage import stored
from stateloom.llm.words import Words
from stateloom.sources.files import shared_dir

LOWER = {c: c + 32 for c in range(65, 91)}
HELD = lambda d, n: zlib.crc32(str(d).encode()) % n


def labelled(spark, rng, bad, good, column):
    rows = [(i, bad(i) if i % 3 == 0 else good(i)) for i in range(1000, 1600)]
    labels = [(d, int((d % 3 == 0) == (column == "toxic"))) for d, _ in rows if d % 2]
    return rows, spark.createDataFrame(labels, f"doc_id long, {column} int")


def accuracy(got, rows, positive):
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] >= 1000]
    assert all((HELD(r["doc_id"], 4) == 2) == r["held_out"] for r in got if r["doc_id"] is not None)
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    return sum(r["predicted"] == positive(r["doc_id"]) for r in held) / len(held)


def test_toxicity_on_held_out_documents(spark, rng):
    insult = lambda i: prose(rng, 40) + f" zork{prose(rng, 1)} " + prose(rng, 20) + f" zork{prose(rng, 1)} " + prose(rng, 9)
    rows, labels = labelled(spark, rng, insult, lambda i: prose(rng, 70), "toxic")
    got = toxicity.contract(documents(spark, ODD + rows), labels).collect()
    assert accuracy(got, ODD + rows, lambda d: int(d % 3 == 0)) > 0.9
    assert {r["score"] for r in got if r["doc_id"] in (1, 2, 3)} == {0.0}
    one, other = [r for r in got if r["doc_id"] == 4]
    assert one == other


def test_models_without_examples(spark):
    docs = documents(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {(r["score"], r["predicted"]) for r in toxicity.contract(docs, none).collect()} == {(0.0, 0)}
    assert {(r["score"], r["predicted"]) for r in quality.contract(docs, none).collect()} == {(0.5, 0)}
    empty = documents(spark, [])
    assert toxicity.contract(empty, none).collect() == [] == quality.contract(empty, none).collect()


def test_kneser_ney_is_a_distribution(rng):
    """Both models give every five-byte sequence what is left of its context's mass."""
    grams = np.unique(np.array([rng.randrange(1, 5) for _ in range(5 * 400)]).reshape(-1, 5) @ (256 ** np.arange(4, -1, -1)))
    counts = np.array([rng.randrange(1, 9) for _ in grams])
    same = toxicity.fit(grams, counts, counts)
    assert np.allclose(same.ratios, 0) and np.allclose(same.of_grams(np.array([1, 2, 3])), 0)
    skewed = toxicity.fit(grams, np.where(np.arange(len(grams)) % 2, counts, 0), np.where(np.arange(len(grams)) % 2, 0, counts))
    assert skewed.ratios[::2].mean() > 0 > skewed.ratios[1::2].mean()


def test_quality_on_held_out_documents(spark, rng):
    junk = lambda i: rng.choice([prose(rng, 30).upper().replace(" ", "!! "), (prose(rng, 1) + " ") * 40, prose(rng, 40).replace(" ", "$$ | ")])
    rows, labels = labelled(spark, rng, junk, lambda i: prose(rng, 40) + ".", "quality")
    got = quality.contract(documents(spark, ODD + rows), labels).collect()
    assert accuracy(got, ODD + rows, lambda d: int(d % 3 != 0)) > 0.95
    kept = quality.quality(documents(spark, rows).withColumnRenamed("lang", "quality_score"), labels)
    assert kept.columns == ["doc_id", "text", "source", "n_chars", "quality_score", "quality_predicted"]


def test_pairs_of_a_factorisation_machine(rng):
    columns, values, ends = quality.features([b"a b c A!", b"", b"x | y"])
    g = np.random.default_rng(1)
    width = quality.WORDS + quality.STATS
    machine = quality.Machine(0.3, g.normal(size=width), g.normal(size=(width, 3)))
    odds, _ = machine.odds(columns, values, ends)
    for i, (a, b) in enumerate(zip([0, *ends], ends)):
        c, x = columns[a:b], values[a:b]
        want = 0.3 + machine.weights[c] @ x
        for j in range(len(c)):
            for k in range(j):
                want += machine.vectors[c[j]] @ machine.vectors[c[k]] * x[j] * x[k]
        assert math.isclose(odds[i], want, rel_tol=1e-9)


def test_language_model_against_dictionaries(spark, rng):
    rows = ODD[:-1] + [(10 + i, prose(rng, rng.randint(1, 30)).title()) for i in range(80)]
    got = backoff.contract(documents(spark, rows)).collect()
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["\0"] for _, t in rows]
    train = [w for (d, _), w in zip(rows, texts) if d is None or HELD(d, 10)]
    c1 = Counter(w for t in train for w in t)
    c2 = Counter(p for t in train for p in zip(t, t[1:]))
    c3 = Counter(p for t in train for p in zip(t, t[1:], t[2:]))
    total, kinds, cut = sum(c1.values()), len(c1), backoff.DISCOUNT
    one = lambda w: (c1[w] + 0.1) / (total + 0.1 * (kinds + 1))
    after1 = Counter(a for a, _ in c2)
    after2 = Counter(p[:2] for p in c3)
    mass1, mass2 = Counter(), Counter()
    for (a, _), n in c2.items():
        mass1[a] += n
    for p, n in c3.items():
        mass2[p[:2]] += n

    def two(h, w):
        if not c1[h]:
            return one(w)
        return max(c2[h, w] - cut, 0) / c1[h] + (c1[h] - mass1[h] + cut * after1[h]) / c1[h] * one(w)

    def three(g, h, w):
        if not c2[g, h]:
            return two(h, w)
        n = c2[g, h]
        return max(c3[g, h, w] - cut, 0) / n + (n - mass2[g, h] + cut * after2[g, h]) / n * two(h, w)

    want = Counter()
    for (d, _), t in zip(rows, texts):
        p = [one(t[0]), *(two(*x) for x in zip(t[:1], t[1:2])), *(three(*x) for x in zip(t, t[1:], t[2:]))]
        known = sum(c1[w] > 0 for w in t)
        sums = (sum(math.log10(one(w)) for w in t), sum(map(math.log10, p)))
        want[(d, d is not None and HELD(d, 10) == 0, len(t), known, total, *(round(x, 6) for x in sums))] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in got) == want
    assert math.isclose(sum(two("long", w) for w in c1) + two("long", "no such word"), 1, rel_tol=1e-6)


def test_language_model_without_training(spark):
    held = [d for d in range(200) if HELD(d, 10) == 0]
    assert [r["score"] for r in backoff.contract(documents(spark, [(held[0], "a b")])).collect()] == [0.0]
    assert backoff.contract(documents(spark, [])).collect() == []


def interpolated(rows):
    """Score of each row by brute force: every n-gram of the training rows counts."""
    texts = [t.split() + ["\0"] for _, t in rows]
    train = [t for (d, _), t in zip(rows, texts) if HELD(d, 10)]
    c = [Counter(p for t in train for p in zip(*(t[k:] for k in range(n)))) for n in (1, 2, 3)]
    after = [Counter(p[:-1] for p in c[n]) for n in (1, 2)]
    total, kinds, cut = sum(c[0].values()), len(c[0]), backoff.DISCOUNT

    def weight(p):
        if len(p) == 1:
            return (c[0][p] + 0.1) / (total + 0.1 * (kinds + 1))
        n, short = c[len(p) - 2][p[:-1]], weight(p[1:])
        return (max(c[len(p) - 1][p] - cut, 0) + cut * after[len(p) - 2][p[:-1]] * short) / n if n else short

    return {d: sum(math.log10(weight(tuple(t[max(0, k - 2) : k + 1]))) for k in range(len(t))) for (d, _), t in zip(rows, texts)}, total


@pytest.mark.parametrize("docs", [150, 800])
def test_language_model_keeps_rare_ngrams_of_a_large_corpus(spark, rng, docs):
    """Words, pairs and triples seen once count at 0.2 and at 1.1 million training tokens as they do at few."""
    rows = [(d, prose(rng, 1500)) for d in range(docs)]
    rows += [(2000 + d, f"name{d % 50} surname{d % 50} joined late " + prose(rng, 4)) for d in range(200)]
    want, total = interpolated(rows)
    assert total > (200_000 if docs < 800 else 1_000_000)
    got = backoff.contract(documents(spark, rows).repartition(8)).collect()
    assert len(got) == len(rows) and {r["train_tokens"] for r in got} == {total}
    for r in got:
        assert math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-9), r


@pytest.mark.parametrize("most, stretch, many, frequent", [(1 << 20, 4096, 1, []), (50, 7, 5, []), (40, 3, 4, ["the", "a"]), (3, 1 << 12, 3, ["the"])])
def test_automaton_of_cut_texts_and_split_words(rng, monkeypatch, most, stretch, many, frequent):
    """Slices, buckets, answers and traversal in one process, with bounds so small that all of them matter."""
    monkeypatch.setattr(backoff, "SLICE", most)
    monkeypatch.setattr(backoff, "STRETCH", stretch)
    monkeypatch.setattr("stateloom.llm.words.PIECE_BYTES", 4 * most)
    words = ["the", "a", *(f"w{k}" for k in range(12))]
    rows = [(k, " ".join(rng.choices(words, [9, 5] + [1] * 12, k=rng.choice([0, 1, 2, 5, 30, 200])))) for k in range(60)]
    batches = [
        pa.record_batch({"doc_id": [d for d, _ in part], "text": [t for _, t in part], "held_out": [HELD(d, 10) == 0 for d, _ in part]})
        for part in (rows[:25], rows[25:])
    ]
    cut = list(backoff.slices(batches, 3))
    assert (len(cut) > 2) == (most < 1000) and len({s.number for s in cut}) == len(cut)
    hot = np.sort(Words([w.encode() for w in frequent]).hashes())
    spread = np.full(len(hot), 3)
    sent = {}
    for s in cut:
        trie = backoff.Trie(s)
        for b, pairs, triples in trie.buckets(many, hot, spread):
            sent.setdefault(b, []).append((s.number, trie.message(pairs, triples)))
    back, total, kinds, whole = {}, 0, 0, {}
    for b, messages in sent.items():
        for row in backoff._bucket_answers(b, messages, hot):
            if row["n"] is not None:
                total, kinds = total + row["n"], kinds + row["v"]
            elif row["word"] is not None:
                c, after = whole.get(row["word"], (0, 0))
                whole[row["word"]] = c + row["c1"], after + row["after1"]
            else:
                back.setdefault(row["slice"], {})[row["bucket"]] = row["body"]
    kinds += sum(c > 0 for c, _ in whole.values())
    sums = [np.array([whole[w][k] for w in hot.view(np.int64).tolist()], np.int64) for k in (0, 1)]
    scores, tokens = Counter(), Counter()
    for s in cut:
        s = backoff.Slice.of(s.number, s.doc_ids, s.body())
        trie = backoff.Trie(s)
        found = backoff._answered(s, trie, back[s.number], many, (hot, spread, *sums))
        for d, x, n in zip(s.doc_ids, backoff.Automaton(trie, found, total, kinds, len(s.words)).traverse(s)[0], s.sizes):
            scores[d] += x
            tokens[d] += int(n) - (s.before + s.behind if len(s.sizes) == 1 else 0)
    want, trained = interpolated(rows)
    assert total == trained
    assert tokens == Counter({d: len(t.split()) + 1 for d, t in rows})
    assert all(math.isclose(scores[d], want[d], rel_tol=1e-9, abs_tol=1e-9) for d, _ in rows)


def test_a_slice_of_other_documents_is_refused():
    batch = lambda text: pa.record_batch({"doc_id": [1], "text": [text], "held_out": [False]})
    (one,), (other,) = (list(backoff.slices([batch(t)], 0)) for t in ("a b c", "a b d"))
    trie, none = backoff.Trie(one), np.zeros(0, np.uint64)
    sent = [(one.number, trie.message(p, t)) for _, p, t in trie.buckets(1, none, none)]
    back = {r["bucket"]: r["body"] for r in backoff._bucket_answers(0, sent, none) if r["body"]}
    assert backoff._answered(one, trie, back, 1, (none,) * 4)
    with pytest.raises(RuntimeError, match="differ"):
        backoff._answered(other, backoff.Trie(other), back, 1, (none,) * 4)


def one_slice(rng, words):
    texts = [prose(rng, words) for _ in range(20)]
    batch = pa.record_batch({"doc_id": range(20), "text": texts, "held_out": [d % 5 == 0 for d in range(20)]})
    (out,) = backoff.slices([batch], 0)
    return out


def test_a_slice_is_hashed_once_however_many_buckets_it_asks(rng, monkeypatch):
    """There are as many buckets as slices at every size, so work on the whole slice for each would grow with the square."""
    s, none, hashed = one_slice(rng, 200), np.zeros(0, np.uint64), []
    mix = backoff.mix
    monkeypatch.setattr(backoff, "mix", lambda h: hashed.append(len(h)) or mix(h))
    work = []
    for many in (1, 5, 60):
        hashed.clear()
        trie = backoff.Trie(s)
        sent = [trie.message(pairs, triples) for _, pairs, triples in trie.buckets(many, none, none)]
        work.append(sum(hashed))
        assert len(sent) > many // 2
    assert len(set(work)) == 1


def test_messages_made_together_are_those_made_one_by_one(rng):
    s = one_slice(rng, 100)
    hot, spread = np.sort(s.words[:9]), np.full(9, 4)
    for many in (1, 7, 300):
        trie = backoff.Trie(s)
        _, pairs, triples = zip(*trie.buckets(many, hot, spread))
        together = list(trie.messages(pairs, triples))
        read, sizes = backoff._unpacked_parts(together)
        begins = np.zeros(len(read), np.int64)
        for k, (p, t) in enumerate(zip(pairs, triples)):
            for part in (backoff._unpacked(together[k]), backoff._unpacked(trie.message(p, t))):
                for i, (whole, a) in enumerate(zip(read, part, strict=True)):
                    assert whole[begins[i] : begins[i] + sizes[i, k]].tolist() == a.tolist()
            begins += sizes[:, k]
        assert [len(a) for a in read] == begins.tolist() and begins[2] == len(trie.pairs) and begins[4] == len(trie.triples)


NOTICE = "Released under the MIT License"


def test_license_labels_spans_and_places(spark, rng):
    rows = ODD + [
        (10, f"é {prose(rng, 30)}\n{NOTICE}. GNU General -- Public\nLicense, mit-license"),
        (11, "Relased undr the MIT Licence"),
        (12, prose(rng, 20) + " Licensed under CC BY-NC 4.0. " + prose(rng, 5)),
        (13, "the summit license, mit licenses, mitlicense"),
        (14, "apache"),
        (15, "license"),
    ]
    got = {r["doc_id"]: r for r in license_scan.contract(documents(spark, rows)).collect()}
    assert len(got) == len({d for d, _ in rows})
    r = got[10]
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == (
        42, 3, 34, 40, "gpl,mit", "gpl,mit", 1.0,
    )
    assert got[11]["labels"] == "mit" and got[11]["base_labels"] == "" and 0.8 < got[11]["score"] < 1
    assert got[12]["labels"] == "cc-by-nc"
    for d in (1, 2, 3, 4, 13, 14, 15):
        assert (got[d]["n_base"], got[d]["first_word"], got[d]["labels"], got[d]["score"]) == (0, None, "", 0.0), d
    for d, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        assert got[d]["n_words"] == len(words)
    (span,) = [s for s in license_scan.license_spans(documents(spark, rows)).collect() if s["doc_id"] == 11]
    assert span["edits"] == 3 and span["start_byte"] == 0


def test_pieces_find_every_edited_notice(rng):
    """Brute force over edits: whatever lies within the bound is found."""
    scanner = license_scan.Scanner()
    letters = "abcdefghijklmnopqrstuvwxyz "
    for notice in license_scan.NOTICES:
        for _ in range(12):
            text = list(notice.text)
            for _ in range(notice.edits):
                k = rng.randrange(len(text))
                action = rng.randrange(3)
                text[k : k + (action != 0)] = [rng.choice(letters)] if action < 2 else []
            spans = scanner.spans(license_scan.Words([("xé " + "".join(text) + " yy").encode()], license_scan.ALNUM))
            assert notice.label in {s.label for s in spans}, "".join(text)


STRANGE = ["<|endoftext|> a <|startoftext|>", "it's 12½ ²x\x85y\x1cz", "ﬁ é K İΣσ", "\n\n  x  \t", "a" * 3000, "🙂👨‍👩‍👧 't'S"]


def test_token_counts_equal_the_library(spark, rng):
    rows = ODD + [(20 + i, t) for i, t in enumerate([*STRANGE, *(prose(rng, 50) for _ in range(20))])]
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    want = Counter()
    for d, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[(d, len((t or "").encode()), n, n > 512)] += 1
    got = token_counts.token_counts(documents(spark, rows), tokenizer("byte_bpe_50k.json"))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_token_files_round_trip(spark, rng):
    rows = [r for r in ODD if r != (4, "one")] + [(4, "one")]
    rows += [(20 + i, t) for i, t in enumerate([*STRANGE, *(prose(rng, 50) for _ in range(40))])]
    path = f"{shared_dir(spark)}/tokens"
    token_files.write_token_files(documents(spark, rows).repartition(3), path, tokenizer("word_bpe_49k.json"))
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    start, want, digests = 0, [], []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, start, ids))
        digests.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    order = lambda r: r[1]
    assert sorted((tuple(r) for r in token_files.read_token_files(spark, path).collect()), key=order) == want
    assert sorted((tuple(r) for r in token_files.digest(spark, path).collect()), key=order) == digests


def test_token_files_of_nothing(spark):
    assert token_files.contract(documents(spark, []), tokenizer("word_bpe_49k.json")).collect() == []


@pytest.mark.parametrize("most", [5, 8, 20])
def test_code_lengths_are_the_best_within_the_limit(rng, most):
    counts = np.array([rng.randrange(1, 1 << rng.randrange(1, 20)) for _ in range(20)] + [0])
    bits = token_files.code_lengths(counts, most)
    assert bits[-1] == 0 and bits.max() <= most and math.isclose((0.5 ** bits[:-1].astype(float)).sum(), 1)
    assert token_files.code_lengths(np.array([0, 7]))[1] == 1
    if most == 20:  # the limit does not bind: the cost of a Huffman code
        heap, cost = sorted(counts[:-1].tolist()), 0
        while len(heap) > 1:
            pair = heap.pop(0) + heap.pop(0)
            cost += pair
            heap = sorted([*heap, pair])
        assert (bits * counts).sum() == cost


def test_targets_share_by_weight_up_to_a_limit():
    assert mixing.targets([100, 100, 100]) == [200.0, 500 / 3, 250 / 3]
    assert mixing.targets([]) == [] and mixing.targets([0, 10]) == [0.0, 15.0]
    sizes = [10, 1000, 50, 3, 400]
    got = mixing.targets(sizes)
    assert math.isclose(sum(got), 1.5 * sum(sizes)) and all(t <= 2 * n for t, n in zip(got, sizes))


@pytest.mark.parametrize("size", [1, 2, 3, 64, 100])
def test_permutations(size):
    n = np.full(size, size)
    first = mixing.permuted(np.arange(size), n, np.full(size, 5, np.uint64))
    other = mixing.permuted(np.arange(size), n, np.full(size, 6, np.uint64))
    assert sorted(first.tolist()) == list(range(size)) == sorted(other.tolist())
    assert size < 64 or first.tolist() != other.tolist()


@pytest.mark.parametrize("slots", [[3000, 2000, 1], [1], [5000], [700, 0, 900, 2, 1, 30], [0, 0], []])
def test_plan_gives_every_shard_and_source_its_slots(spark, slots):
    got = [Counter(map(tuple, mixing.plan(spark, np.array(slots, np.int64), shared_dir(spark)).collect())) for _ in range(2)]
    assert got[0] == got[1] and set(got[0].values()) <= {1}
    by_source, by_shard = Counter(), Counter()
    for shard, source, n in got[0]:
        assert n > 0
        by_source[source] += n
        by_shard[shard] += n
    total = sum(slots)
    assert [by_source[k] for k in range(len(slots))] == slots
    full, rest = divmod(total, mixing.SHARD_SLOTS)
    assert [by_shard[k] for k in sorted(by_shard)] == [mixing.SHARD_SLOTS] * full + [rest] * (rest > 0)
    if len(slots) > 1 and slots[0] == 3000:
        first = [n for shard, source, n in got[0] if source == 0 and shard < 3]
        assert len(set(first)) > 1 and all(abs(n - 614) < 90 for n in first)


def test_slots_and_blocks_of_a_mix(spark, rng, monkeypatch):
    """Every place of a shard is filled once, and a pass over a source takes no word twice."""
    rows = [(i, prose(rng, rng.randint(1, 900)), f"s{i % 3}") for i in range(300)]
    placed, taken = mixing.mixture(documents(spark, rows))
    size = {(r["source_no"], r["begin"]): r["size"] for r in placed.where("size > 0").collect()}
    pieces = taken.collect()
    by_shard = {}
    for r in pieces:
        by_shard.setdefault(r["shard"], set()).add(r["slot"])
    last = max(by_shard)
    assert sorted(by_shard) == list(range(last + 1))
    assert all(places == set(range(mixing.SHARD_SLOTS if k < last else len(places))) for k, places in by_shard.items())
    words = Counter((r["source_no"], r["begin"], r["pass"], w) for r in pieces for w in range(r["first_word"], r["first_word"] + r["n_words"]))
    assert set(words.values()) == {1}
    assert all(w < size[source, begin] for source, begin, _, w in words)


def test_mix_meets_its_targets(spark, rng):
    rows = ODD + [(20 + i, prose(rng, rng.randint(1, 200)), f"s{i % 4}" if i % 7 else None) for i in range(120)]
    docs = documents(spark, rows).selectExpr("*", *(f"'a clashing name' AS {c}" for c in ("size", "mix_pieces", "pieces", "taken", "d", "h", "column_3")))
    got = mixing.contract(docs).collect()
    again = mixing.contract(docs).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    source = {r[0]: r[2] if len(r) > 2 else "s" for r in rows}
    taken, target, size = Counter(), {}, {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]], size[source[r["doc_id"]]] = r["target"], r["source_size"]
    names = sorted(size, key=lambda s: (s is None, s or ""))
    assert [target[n] for n in names] == mixing.targets([size[n] for n in names])
    for n in names:
        assert abs(taken[n] - target[n]) <= mixing.BLOCK_WORDS, n
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in mixed.collect()}
    expect = Counter()
    for r in got:
        if r["taken"]:
            expect[r["doc_id"]] = expect[r["doc_id"]] + r["taken"]
    assert words == dict(expect)
    assert all(r["n_chars"] == len(r["text"]) for r in mixed.collect())


def test_mix_of_nothing(spark):
    assert mixing.contract(documents(spark, [])).collect() == []
    assert mixing.mixed_documents(documents(spark, [(1, None), (2, " ")])).collect() == []


def test_pipeline_stages_keep_what_they_should(spark, rng, tmp_path):
    """Every stage against what it is to remove, on a folder of tables."""
    item = prose(rng, 30)
    rows = [(i, prose(rng, 60), f"s{i % 3}") for i in range(200)]
    rows += [(200 + i, rows[i][1], "s0") for i in range(10)]
    rows += [(300, prose(rng, 20) + " " + item + " " + prose(rng, 20), "s1")]
    toxic = [(400 + i, prose(rng, 30) + f" zork{prose(rng, 1)} zork{prose(rng, 1)} " + prose(rng, 30), "s2") for i in range(120)]
    odd = [(1000 + i, t, "odd") for i, (_, t) in enumerate(ODD)] + [(None, "no id", "odd")]
    docs = documents(spark, rows + toxic + odd)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(d, int(d >= 400), 1) for d, *_ in rows + toxic]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    ids, now = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, str(tmp_path)), shared_dir(spark), name)
        ids.append(Counter(r["doc_id"] for r in now.select("doc_id").collect()))
        assert name == "token_files" or now.columns == docs.columns
    safe, single, clean, mixed, written = ids
    assert len(set(safe) & set(range(400, 520))) < 12 and len(set(range(311)) - set(range(211, 300)) - set(safe)) <= 12
    assert not set(single) & set(range(200, 210)) and set(single) >= (set(safe) & set(range(200)))
    assert 300 not in clean and set(clean) == set(single) - {300}
    assert set(mixed) <= set(clean) and max(mixed.values()) == 1 and written == mixed
    last = sorted(now.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in last] == [sum(r["n_tokens"] for r in last[:k]) for k in range(len(last))]
