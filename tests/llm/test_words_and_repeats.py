import hashlib
import re

import numpy as np
import pytest

from tallyhouse.llm.blocks import with_block
from tallyhouse.llm.substring import COVERS, cover_for, remove_repeats
from tallyhouse.llm.words import encode, hash_words, whole_windows, window_hashes


def brute(rows, width=13):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[i : i + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            f = first.get(tuple(w[i : i + width]))
            if f is not None and (d is None or f < d):
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_words_are_split_as_bytes_and_hashed_alike():
    texts = ["a  b\x0bc\x1c d", "", None, "é x b", "  "]
    w = hash_words(encode(texts))
    assert np.diff(w.first).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert w.hash[1] == w.hash[-1] and len(set(w.hash.tolist())) == len(w.hash) - 1
    assert len(window_hashes(w.hash, 9, 1)) == 0 and whole_windows(w, 2).tolist() == [True, True, True, False, True]


def test_covers_bring_any_two_places_together():
    for period, cover in COVERS.items():
        for i in range(period):
            for j in range(period):
                assert any((i + k) % period in cover and (j + k) % period in cover for k in range(period))
    assert cover_for(13) == (7, (0, 1, 3))


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_repeats_against_brute_force(spark, block_bytes):
    r = np.random.default_rng(3)
    base = [f"w{i}" for i in r.integers(0, 3000, 4000)]
    rows = []
    for d in range(60):
        own = [f"o{d}_{i}" for i in range(int(r.integers(0, 40)))]
        for _ in range(int(r.integers(0, 4))):
            a = int(r.integers(0, 200))
            own += base[a : a + int(r.integers(5, 60))] + [f"x{d}"]
        rows.append((d, " ".join(own)))
    rows += [(100, None), (101, ""), (102, " \n "), (103, rows[5][1]), (103, rows[5][1]), (None, rows[7][1]), (104, "a " * 40), (105, "a " * 13)]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, block int, removed string")
    got = sorted(((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in remove_repeats(docs, block_bytes=block_bytes).collect()), key=repr)
    assert got == brute(rows)


def test_no_documents(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rows_of_one_id_are_dealt_by_text_and_the_largest_id_is_an_id(spark):
    top = 2**63 - 1
    words = [f"w{i}" for i in range(40)]
    rows = [(5, " ".join(words[i : i + 20])) for i in range(20)] + [(5, None), (top, " ".join(words[:30])), (None, " ".join(words[5:30])), (9, " ".join(words[3:40]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs, block_bytes=200).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert with_block(docs.filter("doc_id = 5"), 8, "doc_id", "text").select("block").distinct().count() > 4
