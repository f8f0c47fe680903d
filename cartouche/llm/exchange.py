"""Dealing hashed entries to buckets, many entries to a row.

A task packs the entries of one slice of text into one row per bucket: the documents in order, how many entries each
has, and the 64-bit hashes. Equal hashes of a slice are merged before they are dealt, so a hash that a third of all
documents share sends one entry per slice. Buckets are chosen by a second, independent hash, which adds its bits to
the 64 that are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from cartouche.llm.words import mix

PACKED = "bucket int, known boolean, docs binary, counts binary, hashes binary"
PACKED_ARROW = pa.schema([
    ("bucket", pa.int32()), ("known", pa.bool_()), ("docs", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary()),
])
NO_ID = np.iinfo(np.int64).max


def bucket_count(spark: SparkSession, per_partition: int = 2) -> int:
    """Buckets follow ``spark.sql.shuffle.partitions``, which a cluster sets by its data."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(values.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def pack(bucket: np.ndarray, docs: np.ndarray, hashes: np.ndarray, known: bool) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED. Entries keep their order within a bucket, so runs of one document need it only once."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket, docs, hashes = bucket[order], docs[order], hashes[order]
    new_bucket = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    new_run = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (docs[1:] != docs[:-1])])
    counts = np.diff(np.r_[new_run, len(bucket)]).astype(np.int32)
    runs = np.r_[np.searchsorted(new_run, new_bucket), len(new_run)]
    cuts = np.r_[new_bucket, len(bucket)]
    run_docs = docs[new_run].astype(np.int64)
    rows = range(len(new_bucket))
    yield pa.RecordBatch.from_arrays([
        pa.array(bucket[new_bucket], pa.int32()),
        pa.array(np.full(len(new_bucket), known)),
        pa.array([run_docs[runs[i]:runs[i + 1]].tobytes() for i in rows], pa.binary()),
        pa.array([counts[runs[i]:runs[i + 1]].tobytes() for i in rows], pa.binary()),
        pa.array([hashes[cuts[i]:cuts[i + 1]].tobytes() for i in rows], pa.binary()),
    ], schema=PACKED_ARROW)


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All values of a column of packed arrays, end to end."""
    return np.frombuffer(b"".join(x.as_buffer() for x in column), dtype) if len(column) else np.zeros(0, dtype)


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each entry."""
    docs = np.repeat(joined(table["docs"], np.int64), joined(table["counts"], np.int32))
    return docs, joined(table["hashes"], np.uint64)


def groups_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, np.int64)
