"""License scan and toxicity models against plain dictionaries; empty tables and clashing names for all operators."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import COLUMNS, ODD, documents, prose

from stateloom.llm import backoff, decontamination, license_scan, quality, token_counts, token_files, toxicity
from stateloom.llm.queries import tokenizer

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [rng.choice("abcx ")], [out[at], rng.choice("aeiou")]])
    return "".join(out)


def scanned(doc_id, text):
    """The row of a document by plain search of every phrase and every notice over the whole text."""
    lower = (text or "").translate(LOWER)
    words = re.findall(WORD, lower)
    base = [
        (k, label)
        for phrase, label in license_scan.PHRASES
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    labels = {label for _, label in base}
    labels |= {n.label for n in license_scan.NOTICES if n.pattern().search(lower)}
    places = [k for k, _ in base]
    return (
        doc_id, len(words), len(base), min(places, default=None), max(places, default=None),
        ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)),
    )


def test_license_scan_matches_plain_search(spark, rng):
    rows = [r for r in ODD if r[0] != 6]
    phrases = [p for p, _ in license_scan.PHRASES]
    for k in range(120):
        parts = [prose(rng, rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            notice = rng.choice(license_scan.NOTICES)
            some = rng.choice([rng.choice(phrases), notice.text, notice.text.title(), rng.choice(phrases).replace(" ", rng.choice([" ", "-", "\n", ". ", "x"]))])
            parts += [edited(rng, some, rng.randint(0, notice.edits + 2)), prose(rng, rng.randint(0, 9))]
        rows.append((100 + k, rng.choice([" ", "\n", ""]).join(parts)))
    got = license_scan.contract(documents(spark, rows)).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter(scanned(*r) for r in rows)
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) for r in got)


def kneser_ney(grams, counts):
    """Probability of a byte after four others in the model of one class, by dictionaries. ``counts`` is of that class."""
    cut = toxicity._DISCOUNT

    def ends(sequences, order):
        """Before how many different bytes each sequence of an order stands."""
        return Counter(s[1:] for s in {g[-order - 1 :] for g in sequences})

    def level(n, lower):
        total, kinds = defaultdict(float), Counter()
        for s, c in n.items():
            total[s[:-1]] += c
            kinds[s[:-1]] += c > 0

        def p(s):
            context = s[:-1]
            if not total[context]:
                return lower(s[1:])
            return max(n.get(s, 0) - cut, 0) / total[context] + cut * kinds[context] / total[context] * lower(s[1:])

        return p

    one = ends(grams, 1)
    p = lambda s: (one[s] + 0.5) / (sum(one.values()) + 128)
    for order in (2, 3):
        p = level(ends(grams, order), p)
    p = level(ends([g for g, c in zip(grams, counts) if c], 4), p)
    return level(dict(zip(grams, counts)), p)


@pytest.mark.parametrize("seed", range(3))
def test_kneser_ney_matches_dictionaries(seed):
    rng = np.random.default_rng(seed)
    grams = np.unique(rng.integers(97, 101, (300, 5)) @ (256 ** np.arange(4, -1, -1)))
    ordinary, toxic = (rng.integers(0, 5, len(grams)) * rng.integers(0, 2, len(grams)) for _ in range(2))
    model = toxicity.fit(grams, ordinary, toxic)
    letters = [int(g).to_bytes(5, "big") for g in grams]
    first, second = (kneser_ney(letters, c.tolist()) for c in (ordinary, toxic))
    assert np.allclose(model.ratios, [math.log(second(g) / first(g)) for g in letters])
    unseen = [bytes(x) for x in rng.integers(97, 102, (200, 5)).tolist()]
    packed = np.array([int.from_bytes(g, "big") for g in unseen])
    got = model.of_grams(packed)
    known = set(letters)
    four = {g[1:] for g in known}
    for g, x in zip(unseen, got):
        if g in known or g[1:] in four:  # beyond that the models share what is left
            assert math.isclose(x, math.log(second(g) / first(g)), abs_tol=1e-9), g
    for model_of_class in (first, second):
        for context in {g[:4] for g in letters[:5]}:
            assert math.isclose(sum(model_of_class(context + bytes([b])) for b in range(256)), 1)


LABELS = "doc_id long, toxic int, quality int"


def operators(spark):
    labels = spark.createDataFrame([], LABELS)
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    return {
        "op1": license_scan.contract,
        "op2": backoff.contract,
        "op3": lambda docs: decontamination.contamination(docs, items),
        "op4": lambda docs: quality.contract(docs, labels),
        "op5": lambda docs: token_counts.token_counts(docs, tokenizer("byte_bpe_50k.json")),
        "op6": lambda docs: token_files.contract(docs, tokenizer("word_bpe_49k.json")),
        "op9": lambda docs: toxicity.contract(docs, labels),
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op9"])
def test_empty_tables_and_clashing_names(spark, name):
    operator = operators(spark)[name]
    assert operator(spark.createDataFrame([], COLUMNS)).collect() == []
    rows = [(1, "one two three four five six"), (2, None), (None, "x")]
    plain = operator(documents(spark, rows))
    names = {*plain.columns, "row", "slice", "bucket", "body", "held_out", "fold", "label", "start", "ids", "words", "item_id", "word", "n", "v"}
    more = [f"'x' AS {c}" for c in sorted(names - {"doc_id", "text"})]
    clashing = operator(documents(spark, rows).selectExpr("doc_id", "text", *more))
    assert Counter(map(str, clashing.collect())) == Counter(map(str, plain.collect()))
