"""Periodic runs, whitening and the URL filter against brute force."""

import hashlib
import math
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest_llm import COLUMNS, ODD, documents, prose

from stateloom.llm import periodic_runs, reputation, whitening


def slow_runs(words, least=24, times=3):
    """All runs as (start, length, period), by comparing every word with every other one behind it."""
    found = {}
    for period in range(1, len(words) // times + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j > i and j - i + period >= max(least, times * period):
                found.setdefault((i, j - i + period), period)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def odd_words(rng, size):
    words = []
    while len(words) < size:
        base = [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 20, 33, 64, 100]))]
        words += [base[i % len(base)] for i in range(rng.randint(1, 5 * len(base) + 30))]
    return words


@pytest.mark.parametrize("longest, held", [(1 << 13, 1 << 19), (16, 64), (4, 1 << 10)])
def test_runs_match_brute_force(rng, monkeypatch, longest, held):
    monkeypatch.setattr(periodic_runs, "LONGEST", longest)
    monkeypatch.setattr(periodic_runs, "HELD", held)
    for _ in range(30):
        texts = [odd_words(rng, rng.choice([0, 10, 60, 300, 900])) for _ in range(rng.randint(1, 6))]
        texts = [t if len(t) > 5 else [] for t in texts]
        h = np.array([x for t in texts for x in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(5)
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        got = [tuple(map(int, r)) for r in zip(*periodic_runs.find_runs(h, first))]
        assert got == [(k, *r) for k, t in enumerate(texts) for r in slow_runs(t)]


@pytest.mark.parametrize("n", [2, 8, 128, 256, 512, 4096])
def test_transform_convolves_whole_numbers(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, periodic_runs.PRIME, (2, n // 2))
    tables = periodic_runs.Transform(n)
    fa, fb = (tables.forward(x[None].astype(float)) for x in (a, b))
    got = tables.inverse(periodic_runs._reduced(fa * fb))[0].astype(int) % periodic_runs.PRIME
    want = [sum(int(a[j]) * int(b[(k - j) % n]) for j in range(n // 2) if (k - j) % n < n // 2) for k in range(n // 2)]
    assert got.tolist() == [w % periodic_runs.PRIME for w in want]


def expected_runs(doc_id, text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_periodic_run_query_matches_brute_force(spark, rng):
    rows = [r for r in ODD if r[0] != 6]
    for k in range(60):
        words = [f"w{x}" for x in odd_words(rng, rng.choice([1, 30, 200]))]
        rows.append((100 + k, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(200 + k, prose(rng, rng.randint(0, 150))) for k in range(60)]
    rows += [(k, "") for k in range(300, 340)]
    got = [tuple(r) for r in periodic_runs.contract(documents(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted((expected_runs(*r) for r in rows), key=repr)


def test_a_long_run_is_one_run(spark):
    row = periodic_runs.contract(documents(spark, [(6, "long " * 30_000)])).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (1, 0, 30_000, 1, 30_000_000)


def test_runs_of_an_empty_table_and_of_clashing_columns(spark):
    assert periodic_runs.contract(spark.createDataFrame([], COLUMNS)).collect() == []
    clash = documents(spark, [(1, "a b")]).selectExpr("doc_id", "text", "1 AS runs", "2 AS best", "3 AS collapsed", "4 AS start")
    assert periodic_runs.contract(clash).first()["n_runs"] == 0


VECTORS = "vec_id long, embedding array<float>, label int"


def check_whitened(rows, vectors, components=32):
    x = np.floor(64 * np.array([v for _, v in vectors], float)).astype(np.int64) + 1_000_000
    n = len(x)
    apart = n * x - x.sum(0)
    value, vector = np.linalg.eigh((apart / n).T @ (apart / n) / n)
    value, vector = value[::-1], vector[:, ::-1]
    kept = int((value[:components] > 1e-12 * value[0]).sum())
    assert len(rows) == n * kept
    by_row = {}
    for r in rows:
        by_row.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    for (vec_id, _), one, far in zip(vectors, apart, (apart**2).sum(1)):
        got = by_row[vec_id, int(far)]
        assert sorted(got) == list(range(1, kept + 1))
        want = (one / n) @ vector[:, :kept] / np.sqrt(value[:kept])
        for k, r in got.items():
            assert math.isclose(abs(r["whitened"]), abs(want[k - 1]), abs_tol=1e-6)
            assert math.isclose(r["explained"], value[k - 1] / value.sum(), rel_tol=1e-9)
            assert r["n"] == n and r["identity_error"] < 1e-9
    for k in range(1, kept + 1):
        y = np.array([by_row[v, int(f)][k]["whitened"] for (v, _), f in zip(vectors, (apart**2).sum(1))])
        assert math.isclose((y * y).mean(), 1, rel_tol=1e-9) and abs(y.mean()) < 1e-9


def test_whitening_matches_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 64)
    rng = np.random.default_rng(3)
    scale = np.linspace(8, 1, 7)
    data = [(k, [float(np.float32(v)) for v in rng.normal(5, 1, 7) * scale]) for k in range(90)]
    odd = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0, 5.0, 6.0]), (902, [math.nan] * 7), (903, [math.inf] + [1.0] * 6)]
    odd += [(904, []), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in data + odd], VECTORS).repartition(5)
    check_whitened(whitening.whitened(df).collect(), data)
    check_whitened(whitening.whitened(df, 3).collect(), data, 3)


def test_whitening_of_repeated_rows_and_ranks(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 3, (40, 2))
    full = np.column_stack((base, base[:, 0]))
    data = [(k if k % 4 else None, [float(np.float32(v)) for v in row]) for k, row in enumerate(full)]
    rows = whitening.whitened(spark.createDataFrame([(*r, 1) for r in data + data], VECTORS)).collect()
    assert len(rows) == 80 * 2 and rows[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("data", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)]])
def test_nothing_to_whiten(spark, data):
    df = whitening.whitened(spark.createDataFrame([(*r, 1) for r in data], VECTORS))
    assert df.collect() == [] and df.columns[:3] == ["vec_id", "component", "n"]


def test_whitening_ignores_other_columns(spark):
    df = spark.createDataFrame([(k, [float(k), float(k * k)], 1) for k in range(5)], VECTORS)
    names = ("index", "x", "k", "place", "part", "length", "deviation", "y", "n", "vector")
    rows = whitening.whitened(df.selectExpr("*", *(f"'q' AS {c}" for c in names))).collect()
    assert len(rows) == 10


PAGES = "page_id long, url string, html string"


def slow_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (h + p, kind) for kind, h, p in reputation.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


URLS = [
    None, "", "no host", "://", "http://", "http:///x", "HTTP://A.NET", "http://a.net/", "http://a.net?x=/", "http://net/", "x://notnet/",
    "http://www.example.net/en/1", "http://www.example.net/en", "http://EXAMPLE.net/EN/", "https://de.example.com/de/x?y#z",
    "http://b.org/fr/", "http://b.org/fr", "http://u:p@c.net:80/", "http://c.net./", "http://1.2.3.4/de/", "a://b://c.net/",
    "http://ÄB.net/ü", "http://x.co.uk/", "http://q.net\n/", "http://[::1]/", "x" * 70_000 + "://a.net/",
]


def test_rules_match_brute_force(spark):
    pages = spark.createDataFrame([(k, u, None) for k, u in enumerate(URLS)], PAGES)
    got = {r["page_id"]: r for r in reputation.judged(pages, spark.createDataFrame([], "page_id long, good int")).collect()}
    assert len(got) == len(URLS)
    for k, url in enumerate(URLS):
        host, path, rule, verdict = slow_rule(url)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) == (host, path, rule, verdict or "allow")


def test_reputation_shrinks_towards_the_parent(spark):
    rows, good, k = [], [], 0
    for host, n, bad in (("bad.a.test", 60, 58), ("good.a.test", 60, 1), ("few.a.test", 1, 1), ("b.test", 300, 6), ("new.a.test", 0, 0)):
        for i in range(n):
            rows.append((k, f"http://{host}/{i}", None))
            good.append((k, 0 if i < bad else 1))
            k += 1
    rows += [(None, "http://new.a.test/", None), (10_000, "http://bad.a.test/new", None), (0, "http://bad.a.test/0", None)]
    pages = spark.createDataFrame(rows, PAGES)
    outcomes = spark.createDataFrame(good + [(None, 0), (1, None), (9_999, 0)], "page_id long, good int")
    found = {r["host"]: r for r in reputation.host_reputation(pages, outcomes).collect()}
    assert (found["bad.a.test"]["n"], found["bad.a.test"]["good"]) == (61, 2)
    assert (found["new.a.test"]["n"], found["new.a.test"]["domain"], found["new.a.test"]["suffix"]) == (0, "a.test", "test")
    assert 2 / 61 < found["bad.a.test"]["share"] < 0.1 < found["few.a.test"]["share"] < found["new.a.test"]["share"]
    assert found["new.a.test"]["share"] < found["good.a.test"]["share"] < 59 / 60
    verdicts = {(r["host"], r["verdict"]) for r in reputation.judged(pages, outcomes, ()).collect()}
    assert ("bad.a.test", "block") in verdicts and ("few.a.test", "allow") in verdicts and len(verdicts) == 5


def slow_reputation(counts):
    """share of each host from {(host, domain, suffix): (n, good)}."""

    def level(rows):
        rows = [r for r in rows]
        over = sum(n * (g / n - m) ** 2 - m * (1 - m) for n, g, m in rows if n)
        room = sum(m * (1 - m) * (n - 1) for n, g, m in rows if n)
        rho = min(max(over / room, reputation.RHO[0]), reputation.RHO[1]) if room else reputation.RHO[1]
        w = 1 / rho - 1
        return [(g + w * m) / (n + w) for n, g, m in rows]

    def grouped(key):
        out = {}
        for names, (n, g) in counts.items():
            a, b = out.get(key(names), (0, 0))
            out[key(names)] = a + n, b + g
        return out

    n, g = map(sum, zip(*counts.values()))
    means = {(): (g + 1) / (n + 2)}
    for depth in (1, 2, 3):
        rows = grouped(lambda names: names[::-1][:depth])
        means |= dict(zip(rows, level([(n, g, means[k[:-1]]) for k, (n, g) in rows.items()])))
    return {k[2]: m for k, m in means.items() if len(k) == 3}


def test_reputation_matches_brute_force(spark, rng):
    counts, rows, good, k = {}, [], [], 0
    for host in (f"h{i}.d{i % 7}.{'xyz'[i % 3]}" for i in range(60)):
        share = rng.random()
        n = rng.choice([0, 1, 2, 9, 40])
        hits = sum(rng.random() < share for _ in range(n))
        counts[host, host.split(".", 1)[1], host[-1]] = n, hits
        for i in range(max(n, 1)):
            rows.append((k, f"http://{host}/{i}", None))
            good += [(k, int(i < hits))] if n else []
            k += 1
    want = slow_reputation(counts)
    got = reputation.host_reputation(spark.createDataFrame(rows, PAGES), spark.createDataFrame(good, "page_id long, good int")).collect()
    assert {r["host"] for r in got} == set(want)
    assert all(math.isclose(r["share"], want[r["host"]], rel_tol=1e-9) for r in got)


def test_url_filter_without_rows_and_with_clashing_columns(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert reputation.contract(spark.createDataFrame([], PAGES), labels).collect() == []
    names = ("host", "path", "machine", "blocked", "rule", "n", "good", "domain", "suffix", "mean", "weight")
    clash = spark.createDataFrame([(1, "http://a.org/", None)], PAGES).selectExpr("*", *(f"1 AS {c}" for c in names))
    assert [tuple(r) for r in reputation.contract(clash, labels).collect()] == [(1, "a.org", "/", None, "allow")]


def test_url_filter_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", None)], PAGES)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = reputation.contract(pages, labels)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
