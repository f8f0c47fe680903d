"""Ranked lexical search: term at a time, rarest first, with a limit on accumulators.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. The texts are read once, in
slices: a slice becomes one row of an index, its postings (row, term of the items, occurrences) ordered by term, next to
ids and lengths of its rows and the document counts of its terms. Sums over the index give the statistics of the whole
table, and each term its weight.

An item meets a slice term by term, rarest first. A term adds to an accumulator per document; the most that the terms
still to come can add is known from the slice's postings. Once that is less than the item's k-th score so far (of this
slice's accumulators, or of slices that the same task has finished), a document without an accumulator cannot be among
the best k: no more accumulators are made, and those that exist go on being updated exactly. Each task keeps k rows an
item, and the best k of all tasks remain.

Terms are compared by 64-bit hashes. Items are taken in blocks of about ``BLOCK_TERMS`` terms, whose hashes go to every
task; more items than a block holds take more passes over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartouche.llm.exchange import groups_of
from cartouche.llm.graph import stored
from cartouche.llm.words import LOWER, slices, text_buffers, word_hashes, word_spans

BLOCK_TERMS = 1 << 17
SLICE_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max  # rows without an id rank behind the others

IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True

INDEX = "ids binary, lengths binary, rows binary, terms binary, counts binary, found binary, df binary, n_docs long, n_terms long"
FOUND = "item_id long, doc_id long, score long"


def hashed_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of all rows in order, and the number of terms of each row."""
    data, offsets = text_buffers(column)
    data = LOWER[data]
    starts, ends, per_row = word_spans(data, offsets, IS_TERM)
    return word_hashes(data, starts, ends), per_row


# --- items ---------------------------------------------------------------------


@dataclass(frozen=True)
class Items:
    """A block of items: ids, and the terms of each as positions in the sorted vocabulary of the block."""

    ids: np.ndarray
    cuts: np.ndarray
    terms: np.ndarray
    vocabulary: np.ndarray

    def terms_of(self, i: int) -> np.ndarray:
        return self.terms[self.cuts[i]:self.cuts[i + 1]]


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        hashes, per_row = hashed_terms(batch.column("text"))
        owner = np.repeat(np.asarray(batch.column("item_id")), per_row)
        pairs = np.unique(np.stack([owner, hashes.view(np.int64)], 1), axis=0) if len(owner) else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["item_id", "term"])


def load_items(pairs: DataFrame) -> Items:
    """A block of items on the driver: at most about ``BLOCK_TERMS`` pairs of longs, or one item's terms if it has more."""
    table = pairs.toArrow()
    ids, terms = np.asarray(table["item_id"]), np.asarray(table["term"]).view(np.uint64)
    order = np.lexsort((terms, ids))
    ids, terms = ids[order], terms[order]
    heads = groups_of(ids)
    vocabulary, position = np.unique(terms, return_inverse=True)
    return Items(ids[heads], np.r_[heads, len(ids)].astype(np.int64), position.ravel(), vocabulary)


# --- index of a block's terms ----------------------------------------------------


def index_slice(batch: pa.RecordBatch, vocabulary: np.ndarray) -> pa.RecordBatch:
    """One slice of texts as postings of the vocabulary's terms, ordered by term and row."""
    hashes, per_row = hashed_terms(batch.column("text"))
    ids = np.asarray(batch.column("doc_id").fill_null(NO_ID))
    at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
    hit = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
    row = np.searchsorted(np.cumsum(per_row), hit, "right")
    keys, counts = np.unique(at[hit] * np.int64(max(batch.num_rows, 1)) + row, return_counts=True)
    term, row = np.divmod(keys, max(batch.num_rows, 1))
    found, df = np.unique(term, return_counts=True)
    packed = [ids, per_row.astype(np.int64), row.astype(np.int32), term.astype(np.int32), counts.astype(np.int64), found.astype(np.int32), df.astype(np.int64)]
    return pa.RecordBatch.from_arrays(
        [*[pa.array([v.tobytes()], pa.binary()) for v in packed], pa.array([int((per_row > 0).sum())]), pa.array([int(per_row.sum())])],
        names=[c.split()[0] for c in INDEX.split(", ")])


def index_texts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            yield index_slice(batch, shared.value.vocabulary)

    return run


def sum_document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of a task's slices, added up."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for found, df in zip(batch.column("found"), batch.column("df")):
            terms = np.frombuffer(found.as_buffer(), np.int32)
            if len(terms) and terms[-1] >= len(total):
                total = np.r_[total, np.zeros(terms[-1] + 1 - len(total), np.int64)]
            total[terms] += np.frombuffer(df.as_buffer(), np.int64)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["term", "df"])


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, terms of all documents, and each vocabulary term's document count and weight."""

    documents: int
    terms: int
    df: np.ndarray
    weights: np.ndarray


def statistics(index: DataFrame, size: int) -> Statistics:
    """Statistics of the whole table: two sums, and one row for each term of the block."""
    n, terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    counted = index.select("found", "df").mapInArrow(sum_document_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[np.asarray(counted["term"])] = np.asarray(counted["df"])
    return Statistics(n, terms, df, np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64))


# --- search --------------------------------------------------------------------


class Best:
    """The k best rows of one item so far: scores falling, ties to smaller ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """Score of the k-th row; 0 while there are fewer."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


class Slice:
    """A slice's postings, each with what it adds to a score, and where each term's postings are."""

    def __init__(self, row: dict, stats: Statistics):
        self.ids, lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
        self.rows, terms = np.frombuffer(row["rows"], np.int32), np.frombuffer(row["terms"], np.int32)
        tf = np.frombuffer(row["counts"], np.int64)
        size = 100 - 90 + (90 * lengths * stats.documents) // max(stats.terms, 1)
        self.adds = stats.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * size[self.rows]))
        self.terms = np.frombuffer(row["found"], np.int32)
        self.starts = np.r_[0, np.cumsum(np.frombuffer(row["df"], np.int64))]
        self.most = np.maximum.reduceat(self.adds, self.starts[:-1]) if len(self.terms) else np.zeros(0, np.int64)
        self.scores, self.held = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)

    def search(self, terms: np.ndarray, best: Best) -> int:
        """Add the slice's documents to an item's best rows; ``terms`` stand rarest first. Accumulators made."""
        at = np.searchsorted(self.terms, terms)
        at = at[self.terms[np.minimum(at, len(self.terms) - 1)] == terms] if len(self.terms) else at[:0]
        left = np.cumsum(self.most[at][::-1])[::-1]  # the most that this term and those after it can add
        scores, held, made, growing = self.scores, self.held, [np.zeros(0, np.int32)], True
        for j, t in enumerate(at):
            rows, adds = self.rows[self.starts[t]:self.starts[t + 1]], self.adds[self.starts[t]:self.starts[t + 1]]
            if growing and j:
                growing = left[j] >= max(best.floor, self.kth_partial(made, best.k))
            old = held[rows]
            if growing:
                new = rows[~old]
                held[new] = True
                made.append(new)
                scores[rows] += adds
            else:
                scores[rows[old]] += adds[old]
        touched = np.concatenate(made)
        mine = scores[touched]
        keep = touched[(mine > 0) & (mine >= best.floor)]
        best.add(scores[keep], self.ids[keep])
        scores[touched], held[touched] = 0, False
        return len(touched)

    def kth_partial(self, made: list[np.ndarray], k: int) -> int:
        """The k-th highest of the scores so far; 0 with fewer accumulators. Scores only grow."""
        if sum(map(len, made)) < k:
            return 0
        partial = self.scores[np.concatenate(made)]
        return int(np.partition(partial, len(partial) - k)[len(partial) - k])


def search_slices(shared_items, shared_stats, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, stats = shared_items.value, shared_stats.value
        order = [t[np.lexsort((t, stats.df[t]))] for t in map(items.terms_of, range(len(items.ids)))]
        best = [Best(k) for _ in items.ids]
        for batch in batches:
            for row in range(batch.num_rows):
                part = Slice({name: batch.column(name)[row].as_buffer() for name in ("ids", "lengths", "rows", "terms", "counts", "found", "df")}, stats)
                for terms, rows in zip(order, best):
                    part.search(terms, rows)
        sizes = [len(b.ids) for b in best]
        ids = np.concatenate([np.zeros(0, np.int64), *[b.ids for b in best]])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(items.ids, sizes)), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([np.zeros(0, np.int64), *[b.scores for b in best]])),
        ], names=["item_id", "doc_id", "score"])

    return run


def search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    items = load_items(pairs)
    shared_items = context.broadcast(items)
    index = stored(docs.mapInArrow(index_texts(shared_items), INDEX), "lexical-index")
    shared_stats = context.broadcast(statistics(index, len(items.vocabulary)))
    found = stored(index.mapInArrow(search_slices(shared_items, shared_stats, k), FOUND), "lexical-found")
    shared_items.unpersist()
    shared_stats.unpersist()
    return found


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` documents of highest score above 0, ties to smaller ids.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; other columns are not read. Every row of ``docs`` is a
    document, repeated rows and ids as often as they stand there; a row without an id ranks behind equal scores and has a
    null ``doc_id``. Null and empty texts are documents without terms, which no count includes. Rows of ``items`` with one
    id are one item with the terms of all; items without an id, without terms, or whose terms no document holds have no
    rows. Empty tables give an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL")
    pairs = stored(asked.mapInArrow(item_terms, "item_id long, term long").distinct(), "lexical-items")
    blocks = max(1, -(-pairs.count() // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = reduce(DataFrame.union, [search_block(docs, pairs.where(block == b), k) for b in range(blocks)])
    rank = F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
