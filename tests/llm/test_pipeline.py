from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tallyhouse.llm.blocks import PART_BYTES
from tallyhouse.llm.bpe import token_rows
from tallyhouse.llm.decontaminate import _filter, find_contamination
from tallyhouse.llm.neardup import classes
from tallyhouse.llm.pii import pseudonymise, replace_pii
from tallyhouse.llm.quality import classify, keep_good


def test_every_operator_has_a_query():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_against_their_operators_one_by_one(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, items = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    at = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        at = stage(spark, at, sf)
        assert at.columns == docs.columns
        at.write.parquet(f"{tmp_path}/{i}")
        at = spark.read.parquet(f"{tmp_path}/{i}")
    got = {r.doc_id: r.text for r in at.collect()}
    good = {r.doc_id for r in classify(docs, labels).collect() if r.predicted}
    kept = docs.filter(docs.doc_id.isin(list(good)))
    one = {r.doc_id for r in classes(kept).collect() if r.doc_id == r.class_id}
    clean = {r.doc_id for r in find_contamination(kept, items).collect() if not r.hits} & one
    want = {r.doc_id: pseudonymise(r.text)[0] for r in docs.collect() if r.doc_id in clean}
    assert got == want and 0 < len(want) < docs.count()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in corpus_pipeline.run(spark, sf).collect():
        assert list(r.ids) == library.encode(want.pop(r.doc_id), add_special_tokens=False).ids
    assert not want


def tables(spark, path, docs, kind="doc_id long, text string"):
    """A folder with the given documents, few labels and one test item."""
    frames = {
        "documents": spark.createDataFrame(docs, kind),
        "labels": spark.createDataFrame([(i, i % 2, 0) for i in range(4)] + [(None, 1, None), (2, None, 0)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([("q1", "the capital of the old northern kingdom was moved to the coast in spring"), ("q2", None), (None, "")], "item_id string, text string"),
    }
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


PLAIN = "A plain sentence with some quite ordinary words number {} in it, and another one behind."


def test_odd_rows_go_through_every_stage(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and ids, and columns named as the stages' own."""
    long = " ".join(f"word{i}" for i in range(60_000))
    texts = [None, "", PLAIN.format(1), PLAIN.format(1), PLAIN.format(2), long, "The capital of the old northern kingdom was moved to the coast in spring!", "Mail ann.lee@example.com now", "x"]
    ids = [0, 1, 2, 2, 2, 3, 4, 5, None]
    rows = [(d, t, float(i), f"r{i}", i, {"k": i}) for i, (d, t) in enumerate(zip(ids, texts))]
    kind = "doc_id long, text string, score double, content_hash string, kept_rows int, class_id map<string,int>"
    sf = tables(spark, tmp_path, rows, kind)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    at, left = docs, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        at = keep_good(at, spark.read.parquet(f"{sf}/labels.parquet"), 0.0) if name == "quality" else stage(spark, at, sf)
        at.write.parquet(f"{tmp_path}/{i}")
        at = spark.read.parquet(f"{tmp_path}/{i}")
        left[name] = at.collect()
        assert name == "bpe" or at.schema == docs.schema
    key = lambda rows: sorted((r.kept_rows, r.score, r.content_hash, r.class_id["k"]) for r in rows)
    assert key(left["quality"]) == [(i, float(i), f"r{i}", i) for i in range(9)]
    # one of the texts without words, one of the equal rows; rows of one id and other words are judged each; null ids stay
    assert [k[0] for k in key(left["near_dedup"])] == [0, 2, 4, 5, 6, 7, 8]
    assert [k[0] for k in key(left["decontaminate"])] == [k[0] for k in key(left["near_dedup"]) if k[0] != 6]
    kept = {r.kept_rows: r.text for r in left["pii"]}
    assert kept[0] is None and kept[5] == long and "ann.lee" not in kept[7] and len(kept[7]) == len(texts[7])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sorted(list(r.ids) for r in left["bpe"]) == sorted(library.encode(t or "", add_special_tokens=False).ids for t in kept.values())


def test_empty_tables_and_ties(spark, tmp_path):
    sf = tables(spark, tmp_path / "none", [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.collect() == [] and (name == "bpe" or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, sf).collect() == []
    same = tables(spark, tmp_path / "same", [(d, PLAIN.format(3)) for d in (9, 8, 8, 9, 9)])
    docs = spark.read.parquet(f"{same}/documents.parquet")
    assert [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, same).collect()] == [(8, PLAIN.format(3))]
    assert corpus_pipeline.decontaminate(spark, docs, same).count() == corpus_pipeline.pii(spark, docs, same).count() == 5


def test_stages_work_on_a_batch_by_parts(spark):
    class Docs:  # hands out what a stage runs in its tasks
        columns, schema = ["doc_id", "text"], None
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    texts = [f"row {i} " + "plain words here " * 12_000 for i in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(texts)], ["doc_id", "text"])
    items = SimpleNamespace(value=[("a", "row 7 plain words")])
    runs = token_rows(Docs(), public_tokenizers.path("word_bpe_49k.json")), replace_pii(Docs()), _filter(items, 10)
    for run, left in zip(runs, (30, 30, 29)):
        made = list(run(iter([batch])))
        assert sum(b.num_rows for b in made) == left and [i for b in made for i in b["doc_id"].to_pylist()] == [i for i in range(30) if left == 30 or i != 7]
        assert len(made) > 2 and max(b.num_rows for b in made) * len(texts[0]) <= PART_BYTES
