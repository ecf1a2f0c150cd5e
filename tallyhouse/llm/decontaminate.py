"""Passages of test items in documents, by one Aho-Corasick automaton over normalised windows.

Texts are lower-cased (A-Z) and cut to words of letters, digits and non-ASCII characters; the normalised form is the words with
one space around each. A window is a run of consecutive words of an item. All windows of the items are one automaton, each
document is scanned once, and ends of matches are mapped to word indices and to byte offsets of the original text.

The items are measured before they are sent to the tasks: those whose windows take more than `SHARD_CHARS` characters are dealt
into several automata of that size by a hash of id and text, and each scans the documents; no item is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.blocks import parts
from tallyhouse.llm.words import encode

WINDOW = 10
SHARD_CHARS = 2 << 20  # characters of item text in one automaton; a window per word makes it about ten times as many

_KEEP = bytearray(b" " * 128) + bytearray(range(128, 256))
for _i in (*range(48, 58), *range(97, 123)):
    _KEEP[_i] = _i
for _i in range(65, 91):
    _KEEP[_i] = _i + 32
_KEEP = bytes(_KEEP)
_WORD = re.compile(rb"[^ ]+")
_SPANS = "array<struct<first: int, last: int, start: int, end: int>>"
_OUT = f"doc_id long, n_words long, hits {_SPANS}, item_ids array<string>"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
    ("item_ids", pa.list_(pa.string())),
])


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def build(items: list[tuple[str, str]], window: int = WINDOW) -> ahocorasick.Automaton | None:
    """The automaton of all windows; a match gives (words in it, ids of the items that have it). None if no item has words."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = [w.decode() for w in normal_words(encode([text])[0])]
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            found.setdefault(f" {' '.join(words[i : i + size])} ", (size, set()))[1].add(item)
    if not found:
        return None
    automaton = ahocorasick.Automaton()
    for key, (size, ids) in found.items():
        automaton.add_word(key, (size, tuple(ids)))
    automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton | None, text: bytes) -> tuple[int, list[dict], list[str]]:
    """Words of the text; merged hit spans as word indices (inclusive) and byte offsets (end exclusive); item ids, sorted."""
    kept = text.translate(_KEEP)
    words = kept.split()
    matches = list(automaton.iter(f" {b' '.join(words).decode()} ")) if words and automaton else []
    if not matches:
        return len(words), [], []
    lengths = np.array([len(w.decode()) + 1 for w in words])
    ends = np.cumsum(lengths)  # index of the space after each word in the normalised form
    cover, ids = np.zeros(len(words) + 1, np.int64), set()
    for end, (size, items) in matches:
        last = int(np.searchsorted(ends, end))
        cover[last - size + 1] += 1
        cover[last + 1] -= 1
        ids.update(items)
    mask = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    places = [m.span() for m in _WORD.finditer(kept)]
    spans = [{"first": int(a), "last": int(b) - 1, "start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2], edges[1::2])]
    return len(words), spans, sorted(ids)


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row a document: its words, the spans that a window of an item covers, and the ids of those items.

    A null or empty text has no words and no hits; an item without words hits nothing, one shorter than a window is one window.
    Items with the same id count once, items with the same text all count; a null item id is the text 'null'. Rows with the
    same doc_id are scanned each for itself. Columns but doc_id and text (item_id and text) are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    none = F.expr(f"cast(array() as {_SPANS})"), F.expr("cast(array() as array<string>)")
    out = docs.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"), none[0].alias("hits"), none[1].alias("item_ids"))
    for own in _shards(items, shard_chars):
        out = out.mapInArrow(_scanner(own, window), f"text string, {_OUT}")
    return out.drop("text")


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The documents without any hit (see `find_contamination`), with all their columns."""
    for own in _shards(items, shard_chars):
        docs = docs.mapInArrow(_filter(own, window), docs.schema)
    return docs


def _filter(items, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build(items.value, window)
        for batch in batches:
            for part in parts(batch):
                yield part.filter(pa.array([not scan(automaton, t)[1] for t in encode(part["text"].to_pylist())], pa.bool_()))

    return run


def _shards(items: DataFrame, shard_chars: int) -> list:
    """The items as broadcasts of about `shard_chars` characters each, by a hash of id and text; their size is measured first.

    Equal rows are one, so neither a repeated id nor repeated items make a broadcast larger.
    """
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    context = items.sparkSession.sparkContext
    return [context.broadcast([(r.item_id, r.text) for r in dealt.filter(F.col("shard") == shard).collect()]) for shard in range(shards)]


def merged(spans: list[dict]) -> list[dict]:
    """Spans in order, with those that touch or overlap put together."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if out and s["first"] <= out[-1]["last"] + 1:
            if s["last"] > out[-1]["last"]:
                out[-1] = out[-1] | {"last": s["last"], "end": s["end"]}
        else:
            out.append(s)
    return out


def _scanner(items, window: int):
    """Adds the hits of one automaton to those that a row has from others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build(items.value, window)
        for batch in batches:
            rows = [scan(automaton, t) for t in encode(batch["text"].to_pylist())]
            hits = [merged(old + new[1]) if old else new[1] for old, new in zip(batch["hits"].to_pylist(), rows)]
            ids = [sorted({*old, *new[2]}) for old, new in zip(batch["item_ids"].to_pylist(), rows)]
            yield pa.RecordBatch.from_arrays(
                [batch["text"], batch["doc_id"], pa.array([r[0] for r in rows], pa.int64()), pa.array(hits, _SCHEMA.field("hits").type), pa.array(ids, pa.list_(pa.string()))],
                schema=pa.schema([("text", batch["text"].type), *_SCHEMA]),
            )

    return run


def digest(found: DataFrame) -> DataFrame:
    """The report columns: hit words, number and hash of items, and whether anything was hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), "hits",
    )
