"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is a set of weighted shingles: runs of five normalised words with their counts. Every shingle is a Poisson process
whose rate is its weight and whose arrivals fall on random registers; a register keeps the shingle that arrives first. Two
documents agree on a register with the probability Jaccard similarity of their weights, which does not depend on their lengths.
A shingle's arrivals end as soon as they are later than the latest first arrival, so long texts cost little more than one
arrival a shingle. Registers are cut into bands; documents that agree on a whole band are candidates, and the similarity of a
candidate pair is computed exactly from the texts before it counts as a link.

Texts with the same normalised words are one class first, and one document stands for each. Candidates of a bucket are compared
with its most central document, that whose own buckets are fullest, and not with each other: of a text and its copies that is
the text. What has no link to the rest of its bucket after that is compared with every member of the bucket that is still in
another class, so no link between classes is lost and a group of n copies costs about n comparisons.

Two tests keep pairs from being made at all. Shingles that only one of the candidates has bound its similarity to any other
exactly (`_bound`), which rules out copies that have been changed too much, however many of them there are. And candidates get a longer
signature, of `SKETCH` registers with one bit each; pairs of which fewer agree than 4.5 standard deviations below the mean at
that similarity are left.
All steps are joins and sums over tables written to the shared folder.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from tallyhouse.llm.blocks import FOUND, SENT, block_count, columns, parts, placed_values, received, send, sent_rows, share, text_bytes, with_block
from tallyhouse.llm.components import components
from tallyhouse.llm.decontaminate import normal_words
from tallyhouse.llm.words import U64, encode, hash_words, mix, weights, whole_windows, window_hashes
from tallyhouse.session import cut_lineage, drop_staged, unused_name

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4  # at similarity 0.8 all 20 bands miss with probability 0.00003
SKETCH = 640
MARK_BYTES = 1 << 20  # candidates' text in a block
_STEP = U64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of normalised texts, in order. A text of fewer words, but not none, is one shingle."""
    words = hash_words(texts)
    places = np.flatnonzero(whole_windows(words, width))
    hashes, text = window_hashes(words.hash, width, 31)[places], words.text[places]
    sizes = np.diff(words.first)
    for i in np.flatnonzero((sizes > 0) & (sizes < width)).tolist():
        w = words.hash[words.first[i] : words.first[i + 1]]
        hashes = np.append(hashes, mix((w * weights(len(w), 32)).sum(dtype=U64, keepdims=True) + U64(len(w))))
        text = np.append(text, i)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))))[: len(order)] if len(order) else order
    return text[new], hashes[new], np.diff(np.concatenate((new, [len(order)]))).astype(float)


def prob_min_hash(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """One row a text: for each register the shingle that arrives first, 0 in texts without shingles."""
    first = np.full(texts * registers, np.inf)
    owner = np.zeros(texts * registers, U64)
    state, time, arrival = shingle.copy(), np.zeros(len(shingle)), 0
    rate = weight / registers  # of a shingle on one register, up to a factor that all have
    live = np.arange(len(shingle))
    while len(live):
        arrival += 1
        u = mix(state[live] + np.full(1, arrival, U64) * _STEP)
        time[live] -= np.log(((u >> U64(11)).astype(float) + 1) * 2.0**-53) / rate[live]
        slot = text[live] * registers + (mix(u ^ _STEP) % U64(registers)).astype(np.int64)
        better = np.flatnonzero(time[live] < first[slot])
        order = better[np.argsort(-time[live[better]], kind="stable")]  # the earliest is written last
        first[slot[order]] = time[live[order]]
        owner[slot[order]] = shingle[live[order]]
        latest = first.reshape(texts, registers).max(axis=1)
        live = live[time[live] < latest[text[live]]]
    return owner.reshape(texts, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sorted shingle arrays with their weights: the sum over common shingles of 1 / sum_j max(a_j / a_i, b_j / b_i)."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = a[1][i], b[1][j]
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    # shingles with a smaller ratio y/x count by x, the others by y
    below = np.cumsum(x)
    above = y.sum() - np.cumsum(y)
    return float((1 / ((below + only_x) / x + (above + only_y) / y)).sum())


def normal(text: bytes) -> bytes:
    return b" ".join(normal_words(text))


def _sketch(owner: np.ndarray) -> np.ndarray:
    """One bit of each register, 64 registers to a word."""
    # mixed with the register's number, so that two shingles agree by chance in each register anew
    bits = (mix(owner ^ weights(owner.shape[1], 43)) & U64(1)).reshape(len(owner), -1, 64) << np.arange(64, dtype=U64)
    return bits.sum(axis=2, dtype=U64).astype(np.int64)


def least_agreeing(similarity: float, registers: int = SKETCH) -> int:
    """Registers whose bits agree in all but a few in a million pairs of that similarity."""
    p = (1 + similarity) / 2
    return int(registers * p - 4.5 * (registers * p * (1 - p)) ** 0.5)


def _differing(a: Column, b: Column) -> Column:
    """Registers of two sketches whose bits differ."""
    return reduce(add, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH // 64)])


def marks_of(texts: DataFrame) -> DataFrame:
    """node, size (distinct shingles), lone (share of its weight in shingles that no other node has), flat (all counts are 1), sketch.

    Some shingles of one node only may be taken for shared, so `lone` may be too small, never too large.
    """
    blocks = block_count(text_bytes(texts), MARK_BYTES)
    buckets = max(1, blocks // 2)
    placed = with_block(texts, blocks, "node")
    schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("lone", pa.float64()), ("flat", pa.bool_()), ("sketch", pa.list_(pa.int64()))])

    def known(table):
        text, shingle, weight = shingles(table["text"].to_pylist())
        value, index, count = np.unique(placed_values(shingle, buckets), return_inverse=True, return_counts=True)
        return text, shingle, weight, value, index, count

    def ask(key, table):
        *_, value, _, count = known(table)
        return sent_rows(key[0].as_py(), send(value, count > 1))

    def judge(table, found):
        if not table.num_rows:
            return schema.empty_table()
        text, shingle, weight, value, index, _ = known(table)
        n = table.num_rows
        size, total = np.bincount(text, minlength=n), np.bincount(text, weight, minlength=n)
        lone = np.bincount(text, weight * ~received(value, found)[index], minlength=n)
        sketch = _sketch(prob_min_hash(text, shingle, weight, n, SKETCH))
        return columns(schema, table["node"], size, lone / np.maximum(total, 1), size == total, list(sketch))

    answers = placed.groupBy("block").applyInArrow(ask, SENT).groupBy("bucket").applyInArrow(share, FOUND)
    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, "node long, size long, lone double, flat boolean, sketch array<long>")


def _bound(a: str, b: str) -> Column:
    """No pair is more similar than this.

    With equal counts a similarity is common / (all), and at most the shingles that are not lone are common. Else, with u and v
    the lone shares: each term of the similarity is at most 2 / ((1 + u) / p + (1 + v) / q) for a shingle's shares p and q, which
    is at most the mean of p / (1 + u) and q / (1 + v).
    """
    x, y = F.col(a), F.col(b)
    common = F.least(x["size"] * (1 - x["lone"]), y["size"] * (1 - y["lone"]))
    flat = common / F.greatest(x["size"] + y["size"] - common, F.lit(1.0))
    mean = ((1 - x["lone"]) / (1 + x["lone"]) + (1 - y["lone"]) / (1 + y["lone"])) / 2
    return F.when(x["flat"] & y["flat"], flat).otherwise(mean)


_SIGNED = "doc_id long, content binary, bands array<long>"


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, a hash of the normalised words, and one hash a band (none without words)."""
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def sign(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        norm = [normal(t) for t in texts]
        text, shingle, weight = shingles(norm)
        n = np.bincount(text, minlength=len(texts))
        owner = prob_min_hash(text, shingle, weight, len(texts), bands * rows).reshape(len(texts), bands, rows)
        key = np.zeros((len(texts), bands), U64)
        for r, factor in enumerate(weights(rows, 41)):
            key += owner[:, :, r] * factor
        key = mix(key + weights(bands, 42)).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in norm], pa.binary()),
            pa.array([k if c else k[:0] for k, c in zip(key, n)], pa.list_(pa.int64())),
        ], schema=schema)

    def run(batches):
        for batch in batches:
            for part in parts(batch, most=1 << 20):
                yield sign(part["doc_id"].to_pylist(), encode(part["text"].to_pylist()))

    return docs.mapInArrow(run, _SIGNED)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose similarity is as large; texts has node and text of every node in them."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            keep, known = np.zeros(n, bool), {}
            left, right = batch["left"].to_pylist(), batch["right"].to_pylist()
            for i in range(n):
                sides = []
                for t in (left[i], right[i]):
                    if t not in known:
                        if len(known) > 500:
                            known.clear()
                        known[t] = shingles([t])[1:]
                    sides.append(known[t])
                keep[i] = probability_jaccard(*sides) >= similarity
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(keep)), batch["b"].filter(pa.array(keep))], ["a", "b"])

    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    return joined.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _roots(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and each content with the smallest id that has it and the root of its class."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut_lineage(signatures(docs), "signatures")
    known = signed.filter(F.col("doc_id").isNotNull())
    # one node for each content: the smallest id that has it; ids may repeat, so a node is named by content where they meet
    content = known.groupBy("content").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = cut_lineage(content.withColumn("node", F.xxhash64("content")), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    banded = banded_all = cut_lineage(banded.join(shared, "key"), "bands")
    involved = cut_lineage(banded.groupBy("node").agg(F.sum("size").alias("central")), "involved")
    chosen = nodes.join(involved, "node").select("node", "content", F.col("first").alias("doc_id"))
    # one exchange of the texts; the rows of an id that repeats meet each the node of their own words
    texts = docs.filter(F.col("doc_id").isNotNull()).mapInArrow(_normalised, "doc_id long, content binary, text binary")
    texts = texts.join(chosen, ["doc_id", "content"]).groupBy("doc_id", "content", "node").agg(F.first("text").alias("text"))
    texts = cut_lineage(texts.select("node", "text"), "texts")

    mark = F.struct("sketch", "size", "lone", "flat", "bands").alias("mark")
    marked = cut_lineage(involved.join(marks_of(texts), "node").join(nodes.select("node", "bands"), "node").select("node", "central", mark), "marks")
    banded = banded.select("key", "node").join(marked, "node")
    differing = _differing(F.col("mark.sketch"), F.col("other_mark.sketch"))
    likely = (differing <= SKETCH - least_agreeing(similarity)) & (_bound("mark", "other_mark") >= similarity - 1e-9)

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        return cut_lineage(_verified(ends, texts, similarity), "verified")

    # every member with the most central one of its bucket
    leader = banded.groupBy("key").agg(F.max(F.struct("central", "node", "mark")).alias("l"))
    leader = leader.select("key", F.col("l.node").alias("other"), F.col("l.mark").alias("other_mark"))
    links = verified(banded.join(leader, "key").filter((F.col("node") != F.col("other")) & likely))
    labels = components(links)
    # members of a bucket that are in different classes still
    named = banded.select("key", "node", "mark").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = every = cut_lineage(named, "named")
    mixed = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    named = cut_lineage(named.join(mixed, "key"), "mixed")
    other = named.select("key", F.col("node").alias("other"), F.col("mark").alias("other_mark"), F.col("root").alias("other_root"))
    # a pair that shares several buckets is made in one of them
    once = F.col("key") == F.array_min(F.array_intersect("mark.bands", "other_mark.bands"))
    more = verified(named.join(other, "key").filter((F.col("root") < F.col("other_root")) & likely & once))
    labels = components(links.unionByName(more))
    drop_staged(banded_all, involved, texts, marked, every, named, links, more)
    return signed, nodes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of the documents it is linked with directly or through others.

    Linked are documents whose shingle counts have a probability Jaccard similarity of `similarity` or more; documents with the
    same normalised words always are, so those without words, null ones among them, are one class. Rows with the same id are
    one document if they have the same words, else the class of each is found by its own words. A row without an id is in a
    class without an id. Columns but doc_id and text are not read. One row per document row.
    """
    signed, roots = _roots(docs, similarity)
    named = roots.groupBy("root").agg(F.min("first").alias("class_id")).join(roots.select("root", "content"), "root").select("content", "class_id")
    found = signed.select("doc_id", "content").join(named, "content", "left")
    return found.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))


def _content(norm: list[bytes]) -> pa.Array:
    return pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in norm], pa.binary())


def _normalised(batches):
    """doc_id, the hash of the normalised words, and those."""
    for batch in batches:
        for part in parts(batch):
            norm = [normal(t) for t in encode(part["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([part["doc_id"], _content(norm), pa.array(norm, pa.binary())], ["doc_id", "content", "text"])


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, of its smallest id, with the columns it had; rows without an id stay all.

    Rows with the same id and different words are each judged by the class of their own words. Of several rows of a class with
    its smallest id that with the smallest hash of its words stays, of those with the same words the smallest text, then the row
    whose other columns are smallest as JSON. The rows are exchanged once; only those that repeat in id and words are put
    together. Columns of any type and name come through.
    """
    signed, roots = _roots(docs, similarity)
    kept = roots.groupBy("root").agg(F.min(F.struct("first", "content")).alias("k"))
    rows = signed.groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("rows"))
    found = rows.join(kept.select(F.col("k.first").alias("doc_id"), F.col("k.content").alias("content")), ["doc_id", "content"])
    content, at, own, many = (unused_name(n, docs.columns) for n in ("content_hash", "kept_id", "kept_hash", "kept_rows"))
    found = cut_lineage(found.select(F.col("doc_id").alias(at), F.col("content").alias(own), F.col("rows").alias(many)), "kept")
    drop_staged(signed)

    def with_content(batches):
        for batch in batches:
            for part in parts(batch):
                norm = [normal(t) for t in encode(part["text"].cast(pa.string()).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, _content(norm)], [*part.schema.names, content])

    named = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(content, T.BinaryType())])
    hashed = docs.filter(F.col("doc_id").isNotNull()).mapInArrow(with_content, schema)
    mine = hashed.join(found, (F.col("doc_id") == F.col(at)) & (F.col(content) == F.col(own)))
    whole = F.struct(*[F.col(f"`{n}`") for n in named])
    order = F.struct(F.col("text"), F.to_json(whole))
    alone = mine.filter(F.col(many) == 1).select(*[F.col(f"`{n}`") for n in named])
    one = mine.filter(F.col(many) > 1).groupBy(at, own).agg(F.min_by(whole, order).alias(content))
    return alone.unionByName(one.select(*[F.col(content)[n].alias(n) for n in named])).unionByName(docs.filter(F.col("doc_id").isNull()))
