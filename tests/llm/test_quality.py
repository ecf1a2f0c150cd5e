import zlib

import numpy as np

from tallyhouse.llm import quality
from tallyhouse.llm.quality import FEATURES, _leaf_values, classify, features, fit, keep_good, train


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_held_out_labels_are_found(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    got = classify(table(spark, sf, "documents"), labels).join(labels, "doc_id")
    rows = got.filter("held_out").collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_interactions_and_steps_are_learnt():
    r = np.random.default_rng(0)
    x = r.uniform(size=(3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature alone says anything
    m = fit(x, y, rounds=40)
    assert (0, 1) in m.pairs and np.mean((m.score(x) > 0.5) == y) > 0.9
    assert _leaf_values(np.array([3.0, 3, -3, -3]), np.ones(4), 2).tolist() == [2, 2, -2, -2]
    assert fit(np.zeros((0, 3)), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]
    assert len(set(fit(x, np.ones(3000)).score(x).tolist())) == 1


def test_all_rows_are_scored_and_labels_are_no_input(spark):
    texts = [None, "", "word", "a | b |\n" * 40, "A plain sentence with words.\n" * 3, "x " * 30000]
    rows = [(i % 5 if i < 5 else None, t, "en", i, 0.5) for i, t in enumerate(texts)] + [(0, texts[1], "fr", 9, 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string, source int, score double")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(5)] + [(None, 1, 1), (3, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len({r.score for r in got if r.doc_id == 0 or r.doc_id == 1}) == 1  # null and empty alike
    assert keep_good(docs, labels).columns == docs.columns
    assert classify(docs.limit(0), labels).collect() == [] and classify(docs, labels.limit(0)).count() == len(rows)
    assert features([b""]).tolist() == [[0.0] * len(FEATURES)]


def test_a_column_called_score_stays_and_a_hot_label_is_bounded(spark, monkeypatch):
    rows = [(i, f"A plain sentence number {i} with words in it.", float(-i), i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, quality_score int")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == rows
    hot = spark.range(5000).selectExpr("7 AS doc_id", "concat('text number ', id) AS text")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda x, y: fitted.append(len(x)) or fit(x[:10], y[:10]))
    train(hot, labels, most_rows=1000)
    assert 500 < fitted[0] <= 1000


def test_parts_of_a_batch_keep_every_row_in_order():
    import pyarrow as pa

    from tallyhouse.llm.blocks import parts

    texts = [None, "", "abc", "é" * 10, "x" * 100, "y", None, "z" * 5]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "n": list(range(8))})
    for most in (1, 4, 25, 1000):
        found = list(parts(batch.slice(1), most=most))
        assert [t for p in found for t in p["text"].to_pylist()] == texts[1:] and [n for p in found for n in p["n"].to_pylist()] == list(range(1, 8))
        assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p["text"].to_pylist()) <= most for p in found)
    assert list(parts(batch.slice(0, 0))) == []
