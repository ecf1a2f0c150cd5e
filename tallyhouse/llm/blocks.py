"""Blocks of documents and hash buckets, for exchanges of packed arrays.

A block is the set of documents whose key hashes to it; a bucket is a share of a hash space. Blocks send one packed row to a
bucket instead of one row a word, after having put equal keys together, so that a key that every document has costs a block
one entry. The number of blocks and buckets follows the bytes of text, so that the size of one does not grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.words import U64

BLOCK_BYTES = 8 << 20  # text in a block, on average
PART_BYTES = 2 << 20  # text that a task works on at a time where rows are taken each for itself


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def block_count(total: int, size: int = BLOCK_BYTES) -> int:
    return max(1, -(-total // size))


def with_block(docs: DataFrame, blocks: int, *key: str) -> DataFrame:
    """Adds the block that rows of equal keys share; take a key that no large share of the rows has in common."""
    return docs.withColumn("block", F.pmod(F.xxhash64(F.lit(7), *key), F.lit(blocks)))


def split_sorted(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """(bucket, its slice) for every bucket in a sorted array."""
    if not len(bucket):
        return []
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    edges = [0, *cuts.tolist(), len(bucket)]
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(edges, edges[1:])]


def unpack(column, dtype) -> list[np.ndarray]:
    """Arrays of a binary column, one a row."""
    return [np.frombuffer(b, dtype) for b in column.to_pylist()]


def joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def parts(batch: pa.RecordBatch, column: str = "text", most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, about `most` bytes of text at a time, at least a row; what is made of them stays small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def columns(schema: pa.Schema, *values: list) -> pa.Table:
    """A table of lists in the order of the schema; without lists an empty one."""
    return pa.table(dict(zip(schema.names, values)), schema=schema) if values else schema.empty_table()


# Which values do several blocks or texts have? Each block sends the distinct values it has, 31 bits of each; the rest of its
# hash is the bucket. The answer is a bit a value in the order sent. Two values may share their bits, so a value may be called
# shared that is not, never the other way round.

SENT = "bucket long, block long, body binary"
FOUND = "block long, bucket long, shared binary"
_SENT_SCHEMA = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("body", pa.binary())])


def placed_values(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 31 bits of each hash in one integer, whose order is that of what is sent."""
    return ((h >> U64(32)) % U64(buckets)) << U64(31) | (h & U64(0x7FFFFFFF))


def send(value: np.ndarray, several: np.ndarray) -> list[tuple[int, bytes]]:
    """(bucket, body) of sorted distinct values; `several` says that more than one text of the block has it."""
    body = ((value & U64(0x7FFFFFFF)) << U64(1) | several.astype(U64)).astype(np.uint32)
    return [(b, body[s].tobytes()) for b, s in split_sorted((value >> U64(31)).astype(np.int64))]


def sent_rows(block: int, sent: list[tuple[int, bytes]]) -> pa.Table:
    return columns(_SENT_SCHEMA, [b for b, _ in sent], [block] * len(sent), [body for _, body in sent])


def share(table):
    """For each block's values in a bucket, a bit each: several texts have it."""
    bodies = unpack(table["body"], np.uint32)
    value = joined(bodies, np.uint32)
    order = np.argsort(value >> np.uint32(1), kind="stable")
    v = (value >> np.uint32(1))[order]
    same = np.concatenate(([False], v[1:] == v[:-1], [False]))
    shared = np.zeros(len(value), bool)
    shared[order] = same[1:] | same[:-1]
    # a value with the flag in one block is shared wherever it is, as other blocks that have it make it repeat
    shared |= (value & np.uint32(1)).astype(bool)
    cuts = np.cumsum([len(b) for b in bodies])[:-1]
    bits = [np.packbits(s).tobytes() for s in np.split(shared, cuts)]
    return pa.table({"block": table["block"], "bucket": table["bucket"], "shared": pa.array(bits, pa.binary())})


def received(value: np.ndarray, found) -> np.ndarray:
    """The answers to the sorted distinct values of a block."""
    flag = np.zeros(len(value), bool)
    bits = dict(zip(found["bucket"].to_pylist(), found["shared"].to_pylist()))
    for b, s in split_sorted((value >> U64(31)).astype(np.int64)):
        flag[s] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=s.stop - s.start).astype(bool)
    return flag
