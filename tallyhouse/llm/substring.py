"""Removal of word runs that an earlier document has too, found by difference-cover anchors.

A run of `width` words is hashed at few places only. Take a period v and a difference cover D of it: for any two positions
there is a shift k < v that brings both into D modulo v. Two equal runs of `width` words therefore share an anchor, a run of
`width - v + 1` words at an aligned shift, and only anchors at positions in D are hashed and exchanged. Runs around an anchor
that several documents have are then extended to their whole width and compared by 128 bits of hash with the document id.

Three exchanges, all of packed arrays (see `blocks`): anchors to buckets (31 bits an anchor; a false match costs a needless
extension only), runs around shared anchors to buckets, and the smallest document id of each run back to the blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.blocks import (
    BLOCK_BYTES, FOUND, SENT, block_count, columns, joined, placed_values, received, send, sent_rows, share, split_sorted, text_bytes, unpack, with_block,
)
from tallyhouse.llm.words import U64, encode, hash_words, whole_windows, window_hashes

WIDTH = 13
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}  # perfect difference sets
BUCKETS_A_BLOCK = 0.5
NEVER = np.iinfo(np.int64).max

_RUNS = "bucket long, block long, high binary, low binary, doc binary"
_EARLIER = "block long, high binary, low binary, doc binary"
_EARLIER_SCHEMA = pa.schema([("block", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("doc", pa.binary())])
_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<first: int, last: int>>"


def cover_for(width: int) -> tuple[int, tuple[int, ...]]:
    """The period and cover that hash the fewest positions with anchors of at least half the width."""
    fit = [v for v in COVERS if width - v + 1 >= max(1, width // 2)]
    if not fit:
        raise ValueError(f"no difference cover for runs of {width} words")
    return max(fit), COVERS[max(fit)]


class _Block:
    """Hashed words of a block of documents."""

    def __init__(self, table: pa.Table, width: int):
        self.width = width
        self.doc_ids = table["doc_id"].to_pylist()
        self.ids = np.array([NEVER if i is None else i for i in self.doc_ids], np.int64)
        self.texts = encode(table["text"].to_pylist())
        self.words = hash_words(self.texts)

    def anchors(self, buckets: int):
        """Places of anchors; the distinct (bucket, 31-bit value) they have, in order; and the index of each place in that."""
        period, cover = cover_for(self.width)
        span = self.width - period + 1
        at = whole_windows(self.words, span) & np.isin(self.words.position % period, cover)[: max(0, len(self.words.hash) - span + 1)]
        places = np.flatnonzero(at)
        h = window_hashes(self.words.hash, span, 11)[places]
        value, index = np.unique(placed_values(h, buckets), return_inverse=True)
        return places, value, index

    def send_anchors(self, buckets: int):
        places, value, index = self.anchors(buckets)
        text = self.words.text[places]
        low = np.full(len(value), NEVER, np.int64)
        high = np.full(len(value), -1, np.int64)
        np.minimum.at(low, index, text)
        np.maximum.at(high, index, text)
        return send(value, low < high)

    def runs(self, places: np.ndarray):
        """High and low hash of the whole runs that start at the places; the last bit is free."""
        high = window_hashes(self.words.hash, self.width, 21)
        low = window_hashes(self.words.hash, self.width, 22) & ~U64(1)
        return high[places], low[places]


def _buckets(blocks: int) -> int:
    return max(1, int(blocks * BUCKETS_A_BLOCK))


def _earliest(table):
    """For each block's runs in a bucket, those that an earlier document has, with the smallest document id."""
    parts = [unpack(table[c], t) for c, t in (("high", U64), ("low", U64), ("doc", np.int64))]
    high, low, doc = (joined(p, t) for p, t in zip(parts, (U64, U64, np.int64)))
    several, low = (low & U64(1)).astype(bool), low & ~U64(1)
    order = np.lexsort((doc, low, high))
    h, lo = high[order], low[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])))
    best = np.empty(len(order), np.int64)
    best[order] = doc[order][new][np.cumsum(new) - 1]
    wanted = (best < doc) | several
    out = []
    cuts = np.cumsum([0] + [len(p) for p in parts[0]]).tolist()
    for block, a, b in zip(table["block"].to_pylist(), cuts, cuts[1:]):
        w = wanted[a:b]
        if w.any():
            out.append([block, *(x[a:b][w].tobytes() for x in (high, low, best))])
    return columns(_EARLIER_SCHEMA, *(list(c) for c in zip(*out)))


def _spans(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]


def _strip(block: _Block, earlier: pa.Table) -> dict[str, list]:
    width, words = block.width, block.words
    removed = np.zeros(len(words.hash) + 1, np.int64)
    if earlier.num_rows:
        high, low, doc = (joined(unpack(earlier[c], t), t) for c, t in (("high", U64), ("low", U64), ("doc", np.int64)))
        order = np.lexsort((low, high))
        high, low, doc = high[order], low[order], doc[order]
        places = np.flatnonzero(whole_windows(words, width))
        h, lo = block.runs(places)
        hit = np.zeros(len(places), bool)
        at, end = np.searchsorted(high, h), np.searchsorted(high, h, "right")
        ids = block.ids[words.text[places]]
        while len(live := np.flatnonzero(at < end)):  # one round, but for runs that share a 64-bit hash
            j = at[live]
            hit[live] |= (low[j] == lo[live]) & (doc[j] < ids[live])
            at[live] += 1
        np.add.at(removed, places[hit], 1)
        np.add.at(removed, places[hit] + width, -1)
    gone = np.cumsum(removed[:-1]) > 0
    out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "removed": []}
    for i, text in enumerate(block.texts):
        own = gone[words.first[i] : words.first[i + 1]]
        kept = text.split()
        if own.any():
            kept = [w for w, g in zip(kept, own.tolist()) if not g]
        out["doc_id"].append(block.doc_ids[i])
        out["n_words"].append(len(own))
        out["n_removed"].append(int(own.sum()))
        out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        out["removed"].append(_spans(own))
    return out


def remove_repeats(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Which words each document loses: those in a run of `width` words that starts in a document with a smaller id.

    Words are what stands between ASCII white space, unchanged; a null or empty text has none, and no row is left out. Runs
    are judged on the input. Rows with the same id do not count as earlier than each other; a row without an id is later
    than all others and never takes words from them. Columns but doc_id and text are not read. Returns doc_id, n_words, n_removed, kept_sha256 and the removed
    spans as (first, last) word.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = block_count(text_bytes(docs), block_bytes)
    buckets = _buckets(blocks)
    placed = with_block(docs, blocks, "doc_id", "text")  # rows of one id are dealt by their texts

    def anchors(key, table):
        return sent_rows(key[0].as_py(), _Block(table, width).send_anchors(buckets))

    shared = placed.groupBy("block").applyInArrow(anchors, SENT).groupBy("bucket").applyInArrow(share, FOUND)
    runs_schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("doc", pa.binary())])

    def runs(key, table, found):
        if not table.num_rows:
            return runs_schema.empty_table()
        block = _Block(table, width)
        places, value, index = block.anchors(buckets)
        flag = received(value, found)
        period = cover_for(width)[0]
        whole = whole_windows(block.words, width)
        near = np.zeros(len(whole) + 1, np.int64)
        hit = places[flag[index]] if len(places) else places
        np.add.at(near, np.minimum(np.maximum(hit - period + 1, 0), len(whole)), 1)
        np.add.at(near, np.minimum(hit + 1, len(whole)), -1)
        at = np.flatnonzero(whole & (np.cumsum(near[:-1]) > 0))
        high, low = block.runs(at)
        doc = block.ids[block.words.text[at]]
        bucket = (high % U64(buckets)).astype(np.int64)
        order = np.lexsort((doc, low, high, bucket))
        high, low, doc, bucket = high[order], low[order], doc[order], bucket[order]
        new = np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])))[: len(order)]
        last = np.flatnonzero(np.concatenate((new[1:], [True])))[: int(new.sum())]
        several = doc[last] > doc[new]
        high, low, doc, bucket = high[new], low[new] & ~U64(1) | several.astype(U64), doc[new], bucket[new]
        parts = split_sorted(bucket)
        return columns(runs_schema, [b for b, _ in parts], [key[0].as_py()] * len(parts), *[[a[s].tobytes() for _, s in parts] for a in (high, low, doc)])

    sent = placed.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(runs, _RUNS)
    earlier = sent.groupBy("bucket").applyInArrow(_earliest, _EARLIER)
    out_schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])

    def strip(table, found):
        return pa.table(_strip(_Block(table, width), found), schema=out_schema)

    return placed.groupBy("block").cogroup(earlier.groupBy("block")).applyInArrow(strip, _OUT)
