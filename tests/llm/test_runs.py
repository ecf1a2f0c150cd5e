import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallyhouse.llm import runs
from tallyhouse.llm.runs import PRIME, digest, find_runs, planted, runs_of, squared_differences, transform, untransform
from tallyhouse.llm.words import U64


def brute(words):
    """Every maximal stretch of every period, by the definition."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and not any(all(words[k] == words[k + d] for k in range(i, j + q - d)) for d in range(1, q)):
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts():
    r = random.Random(5)
    out = ["", "a", "a " * 23, "a " * 24, "a b " * 12, "a b " * 11 + "a", ("a " * 30 + "b ") * 4, "x " + "a b c d e f g h " * 3 + "y", "a b c d e f g h i " * 3, "a b c d e f g h i " * 2 + "a b c d e f g h"]
    for k in range(250):
        words = [str(r.randrange(2 + k % 7)) for _ in range(r.randrange(300))]
        for _ in range(r.randrange(4)):
            period = [str(r.randrange(9)) for _ in range(r.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 40, 64, 70]))]
            at = r.randrange(len(words) + 1)
            words[at:at] = (period * r.randrange(2, 7))[: r.randrange(20, 400)]
        out.append(" ".join(words))
    return out


def test_transform_is_exact():
    r = np.random.default_rng(1)
    for n in (1, 2, 8, 64):
        x = r.integers(0, PRIME, (3, n)).astype(U64)
        assert np.array_equal(untransform(transform(x)), x)
    a, b = r.integers(0, PRIME, (5, 16)).astype(U64), r.integers(0, PRIME, (5, 47)).astype(U64)
    b[2, 7:23] = a[2]
    want = [[sum((int(p) - int(q)) ** 2 for p, q in zip(x, y[t : t + 16])) % PRIME for t in range(32)] for x, y in zip(a, b)]
    got = squared_differences(a, b)
    assert got.tolist() == want and got[2, 7] == 0


def test_runs_against_brute_force():
    given = texts()
    counts, found = runs_of([t.encode() for t in given])
    assert counts == [len(t.split()) for t in given]
    for text, f in zip(given, found):
        assert f == brute(text.split())
    assert sum(map(len, found)) > 150 and max(q for f in found for _, _, q in f) >= 64


@pytest.mark.parametrize("most", [8, 16])
def test_long_blocks_by_their_first_words(monkeypatch, most):
    monkeypatch.setattr(runs, "LONGEST_BLOCK", most)
    monkeypatch.setattr(runs, "ROWS", 64)
    given = texts()[:120]
    assert runs_of([t.encode() for t in given])[1] == [brute(t.split()) for t in given]


def test_a_prime_that_often_errs_is_found_out(monkeypatch):
    monkeypatch.setattr(runs, "PRIME", 97)  # 96 = 3 * 2^5, generator 5
    monkeypatch.setattr(runs, "ROOT", 5)
    runs._roots.cache_clear()
    try:
        given = [t for t in texts() if len(t.split()) < 90]
        assert runs_of([t.encode() for t in given])[1] == [brute(t.split()) for t in given]
    finally:
        runs._roots.cache_clear()


def expected(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc, n, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def test_query_against_brute_force(spark, sf):
    from tallyhouse.llm.queries import op13_periodic_runs

    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in op13_periodic_runs(spark, sf).select("doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    short = [r for r in rows if len(r.text.split()) < 1200]
    assert {expected(*r) for r in short} <= got and len(got) == len(rows) and len(short) > 150
    assert sum(g[2] > 0 for g in got) >= len(rows) // 12


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    assert find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    long = " ".join(str(i % 5000) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 40), (None, "a " * 40), (4, "é\u00a0b " * 30), (5, "a " * 50_000), (6, long), (6, "x\x1cy " * 24)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, start int")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed[:20]) for r in find_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 40, [(0, 40, 1)], "a"), (None, 40, [(0, 40, 1)], "a"), (4, 30, [(0, 30, 1)], "é\u00a0b"),
        (5, 50_000, [(0, 50_000, 1)], "a"), (6, 60_000, [(0, 60_000, 5000)], long[:20]), (6, 24, [(0, 24, 1)], "x\x1cy"),
    ], key=repr)
    out = digest(find_runs(docs.select("doc_id", planted(docs.doc_id, docs.text).alias("text")))).collect()
    assert all(r.runs_sha256 and r.collapsed_sha256 for r in out) and len(out) == len(rows)


def test_many_equal_stretches_end_soon():
    text = " ".join(["a"] * 30_000 + [f"w{i}" for i in range(3000)] + ["a b"] * 10_000 + (["c"] * 23 + ["d"]) * 500)
    counts, found = runs_of([text.encode()])
    assert (0, 30_000, 1) in found[0] and (33_000, 20_000, 2) in found[0] and (53_000, 12_000, 24) in found[0]
