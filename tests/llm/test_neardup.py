import random
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm.components import components
from tallyhouse.llm.decontaminate import normal_words
from tallyhouse.llm.neardup import classes, keep_one, prob_min_hash, probability_jaccard, shingles


def bag(text):
    w = normal_words((text or "").encode())
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(x, y):
    if not x or not y:
        return float(not x and not y)
    keys = x.keys() | y.keys()
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in keys) for i in x.keys() & y.keys())


def brute(rows):
    bags = {d: bag(t) for d, t in rows}
    root = {d: d for d in bags}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in bags:
        for b in bags:
            if a < b and similarity(bags[a], bags[b]) >= 0.8:
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {d: find(d) for d in bags}


def corpus(n=25):
    r = random.Random(2)
    rows, d = [], 0
    for _ in range(n):
        w = [f"w{r.randint(0, 5000)}" for _ in range(r.randint(3, 160))]
        rows.append((d, " ".join(w)))
        d += 1
        for _ in range(r.choice([0, 0, 1, 6])):  # copies of copies, so that groups are chains too
            w = list(w)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = f"n{r.randint(0, 9999)}"
            rows.append((d, " ".join(w) if r.random() < 0.8 else " ".join(w).upper() + "!"))
            d += 1
    return rows


def test_exact_similarity():
    r = random.Random(0)
    for _ in range(50):
        a, b = ["x".join(map(str, r.choices(range(4), k=1))) for _ in range(r.randint(1, 30))], None
        b = a[: r.randint(0, len(a))] + [str(r.randint(0, 5)) for _ in range(r.randint(0, 9))]
        ta, tb = " ".join(a), " ".join(b)
        got = probability_jaccard(shingles([ta.encode()])[1:], shingles([tb.encode()])[1:])
        assert got == pytest.approx(similarity(bag(ta), bag(tb)))


def test_registers_agree_as_often_as_the_similarity_says():
    a = " ".join(f"w{i}" for i in range(200))
    b = a.replace("w50 ", "z ").replace("w120 ", "y ") + " " + " ".join(f"w{i}" for i in range(60))
    text, shingle, weight = shingles([a.encode(), b.encode()])
    got = prob_min_hash(text, shingle, weight, 2, 4000)
    assert abs(np.mean(got[0] == got[1]) - similarity(bag(a), bag(b))) < 0.03


def test_classes_against_brute_force(spark):
    rows = corpus() + [(900, None), (901, ""), (902, "..."), (903, "one two"), (904, "One, two")]
    docs = spark.createDataFrame([(d, t, "r", 3) for d, t in rows], "doc_id long, text string, root string, node int")
    assert dict(classes(docs).collect()) == brute(rows)


def test_one_of_each_class_stays_with_its_columns(spark):
    rows = corpus(8)
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate([*rows, rows[0], (None, rows[0][1])])], "doc_id long, text string, first int")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    want = brute(rows)
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted([*(repr(d) for d in want if want[d] == d), "None"])


def test_rows_with_one_id_and_different_words_are_judged_each(spark):
    a, b, d, e, f = (" ".join(f"{x}{i}" for i in range(80)) for x in "abdef")
    rows = [(5, a), (5, b), (5, b), (5, b.upper()), (3, a + " more"), (7, b + " more"), (8, d), (8, d + " more"), (9, e), (9, f), (None, d)]
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, source string")
    got = sorted((repr(r.doc_id), r.text) for r in keep_one(docs).collect())
    assert [x for x in got if x[0] != "8"] == [("3", a + " more"), ("5", b.upper()), ("9", e), ("9", f), ("None", d)]
    assert len(got) == 6 and got == sorted((repr(r.doc_id), r.text) for r in keep_one(docs.repartition(5)).collect())


def test_one_large_group_and_an_empty_table(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[: 60 + i % 3] + [f"q{i}"] + base[60 + i % 3 :])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in classes(docs).collect()} == {0}
    assert classes(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_an_id_that_holds_all_rows_is_no_square(spark):
    """Rows of one id, all near copies of each other: each meets its own words only."""
    base = [f"w{i}" for i in range(200)]
    rows = [(7, " ".join(base[:k % 150] + [f"x{k}"] + base[k % 150 :])) for k in range(3000)] + [(8, "something else entirely")]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string").repartition(4)
    got = classes(docs).collect()
    assert len(got) == 6002 and {(r.doc_id, r.class_id) for r in got} == {(7, 7), (8, 8)}
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == [7, 8]


def test_keep_one_takes_any_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(2, text, {"a": 1}, "x", 1), (1, text, {"a": 2}, "y", 2), (1, text.upper(), {"a": 2}, "b", 3), (1, text.upper(), {"a": 2}, "a", 4), (None, text, None, None, 5), (3, "", {}, "z", 6), (4, None, {}, "q", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, content_hash string, kept_rows int")
    got = sorted((repr(r.doc_id), r.text, r.m, r.content_hash, r.kept_rows) for r in keep_one(docs).collect())
    assert keep_one(docs).schema == docs.schema
    assert got == [("1", text.upper(), {"a": 2}, "a", 4), ("3", "", {}, "z", 6), ("None", text, None, None, 5)]
    assert keep_one(docs.limit(0)).collect() == []
