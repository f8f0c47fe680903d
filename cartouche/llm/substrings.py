"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

One scan hashes every window. Equal windows of a slice meet there: the documents after the first are marked at once
and the first stands for the slice, so a window that a third of all documents hold costs one entry per slice. The
entries are dealt by a second hash, sorted in their bucket, and every document but the smallest id of a window is
marked. A second scan meets the marks by document id; marked windows merge into maximal intervals of words to remove.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.llm.exchange import NO_ID, PACKED, bucket_count, bucket_of, groups_of, pack, unpack
from cartouche.llm.words import hashed_words, mix, slices, text_buffers, windows, word_hashes, word_spans

WINDOW = 50
SLICE = 4 << 20


def after_the_first(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order entries by hash, then document; where groups start; which entries have a document after the group's first."""
    order = np.lexsort((docs, hashes))
    starts = groups_of(hashes[order])
    sizes = np.diff(np.r_[starts, len(order)])
    late = docs[order] > np.repeat(docs[order][starts], sizes) if len(order) else np.zeros(0, bool)
    return order, starts, late


def mark_key(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mix(hashes + mix(docs.astype(np.uint64)))


def hash_windows(length: int, buckets: int):
    def run(batches):
        for batch in slices(batches, "text", SLICE):
            ids = np.asarray(batch.column(0))
            words, per_row = hashed_words(batch.column(1), lower=False)
            one, two, counts = windows(words, per_row, length)
            docs = np.repeat(ids, counts)
            order, starts, late = after_the_first(docs, one)
            first = np.sort(order[starts])
            yield from pack((two[first] % np.uint64(buckets)).astype(np.int32), docs[first], one[first], False)
            marked = np.sort(order[late])
            yield from pack(bucket_of(docs[marked], buckets), docs[marked], one[marked], True)

    return run


def mark_repeats(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        known = np.asarray(table["known"])
        docs, hashes = unpack(table.filter(pa.array(~known)))
        order, _, late = after_the_first(docs, hashes)
        marked = order[late]
        known_docs, known_hashes = unpack(table.filter(pa.array(known)))
        docs, hashes = np.r_[docs[marked], known_docs], np.r_[hashes[marked], known_hashes]
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
        return pa.Table.from_batches(list(pack(bucket_of(docs, buckets), docs, hashes, True)), table.schema) if len(docs) else table.slice(0, 0)

    return run


def covered(marked: np.ndarray, first_word: np.ndarray, words: int, length: int) -> np.ndarray:
    """Which words lie in a marked window: the union of the windows, as maximal intervals."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, first_word[marked], 1)
    np.add.at(change, first_word[marked] + length, -1)
    return np.cumsum(change[:-1]) > 0


def kept_texts(data, starts, ends, per_row, keep) -> pa.Array:
    """The kept words of each row, joined by one space."""
    row = np.repeat(np.arange(len(per_row)), per_row)[keep]
    starts, size = starts[keep], (ends - starts)[keep]
    gap = np.r_[False, row[1:] == row[:-1]].astype(np.int64)[:len(row)]
    stop = np.cumsum(size + gap)
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
    head = stop - size
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(head, size) + at] = data[np.repeat(starts, size) + at]
    last = np.searchsorted(row, np.arange(len(per_row)), "right")
    offsets = np.r_[0, np.where(last > 0, stop[np.maximum(last - 1, 0)], 0) if len(stop) else np.zeros(len(per_row), np.int64)]
    return pa.LargeStringArray.from_buffers(len(per_row), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def remove_marked(length: int, names: list[str], id_at: int, text_at: int):
    """Cut marked windows from the documents of a bucket; all columns stay, the results are put at the end."""

    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        keys = np.sort(mark_key(*unpack(marks))) if marks.num_rows else np.zeros(0, np.uint64)
        parts = []
        for batch in slices(docs.combine_chunks().to_batches(), names[text_at], 2 << 20):
            column = batch.column(text_at)
            data, offsets = text_buffers(column)
            starts, ends, per_row = word_spans(data, offsets)
            one, _, counts = windows(word_hashes(data, starts, ends), per_row, length)
            ids = np.asarray(batch.column(id_at).fill_null(int(NO_ID)))
            wanted = mark_key(np.repeat(ids, counts), one)
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            marked = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            word_at = np.cumsum(per_row) - per_row
            first = np.repeat(word_at - (np.cumsum(counts) - counts), counts) + np.arange(len(wanted))
            gone = covered(marked, first, len(starts), length)
            total = np.r_[0, np.cumsum(gone)]
            removed = total[word_at + per_row] - total[word_at]
            parts.append(pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(per_row, pa.int64()), pa.array(removed, pa.int64()), kept_texts(data, starts, ends, per_row, ~gone)],
                names=[*names[1:], "n_words", "n_removed", "kept_text"],
            ))
        return pa.Table.from_batches(parts)

    return run


def remove_repeats(documents: DataFrame, length: int = WINDOW) -> DataFrame:
    """Remove each word in a window of ``length`` words that also starts in a document with a smaller ``doc_id``.

    Adds ``n_words``, ``n_removed`` and ``kept_text`` (kept words, one space between); input columns of these names are
    replaced, all others stay. A null text has no words. A null ``doc_id`` counts as larger than every id. Rows with
    equal ids are one document: none is cut on account of the other. Texts shorter than the window stay whole.
    An empty table gives an empty result.
    """
    spark = documents.sparkSession
    buckets = bucket_count(spark)
    own = [c for c in documents.columns if c not in ("n_words", "n_removed", "kept_text")]
    documents = documents.select([f"`{c}`" for c in own])
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID)))
    entries = documents.select(key.alias("doc_id"), "text").mapInArrow(hash_windows(length, buckets), PACKED)
    marks = entries.groupBy("bucket").applyInArrow(mark_repeats(buckets), PACKED)
    dealt = documents.mapInArrow(deal(buckets, own.index("doc_id")), T.StructType([T.StructField("__bucket", T.IntegerType()), *documents.schema.fields]))
    names = dealt.columns
    out = T.StructType([
        *dealt.schema.fields[1:],
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
    ])
    run = remove_marked(length, names, names.index("doc_id"), names.index("text"))
    return dealt.groupBy("__bucket").cogroup(marks.groupBy("bucket")).applyInArrow(only_with_documents(run, out), out)


def only_with_documents(run, out: T.StructType):
    empty = [f.name for f in out.fields]

    def call(docs: pa.Table, marks: pa.Table) -> pa.Table:
        if not docs.num_rows:
            from pyspark.sql.pandas.types import to_arrow_schema

            return to_arrow_schema(out).empty_table().select(empty)
        return run(docs, marks)

    return call


def deal(buckets: int, id_at: int):
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(id_at).cast(pa.int64()).fill_null(int(NO_ID)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_of(ids, buckets), pa.int32()), *batch.columns], names=["__bucket", *batch.schema.names],
            )

    return run
