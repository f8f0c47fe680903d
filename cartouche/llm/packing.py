"""Best-fit packing of token sequences by patterns and non-negative least squares.

Spark counts how many pieces there are of each length. From that histogram alone, of at most ``capacity`` numbers, the
driver enumerates patterns of two and three pieces that fill a sequence, fits how often each repeats by non-negative
least squares, rounds down, and packs what is left by repeated best-fit patterns. The plan is a table of ranges:
pieces of one length are numbered, and a range of numbers takes one place of one pattern in consecutive sequences.
Nothing larger than the plan, which depends on the capacity and not on the corpus, reaches the driver or a task.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartouche.llm.graph import stored
from cartouche.llm.words import give_back, slices, text_buffers, word_hashes

CAPACITY = 1024
END_ID = 2
ROWS_PER_CELL = 20_000
MOST_CACHED = 1 << 20
SEGMENTS_AT_ONCE = 1 << 13
SEGMENTS_JOINED = 64
SEGMENT_LEAD = np.zeros(256, bool)
SEGMENT_LEAD[0x21:0x7F] = True
SEGMENT_LEAD[0xC3:0xE0] = True  # lead bytes of U+00C0 to U+07FF, none of which is a space


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Index triples into ``lengths``, ascending, that fill a sequence exactly; -1 for a pair's missing third."""
    place = np.full(capacity + 1, -1)
    place[lengths] = np.arange(len(lengths))
    pairs = np.stack([np.arange(len(lengths)), place[capacity - lengths], np.full(len(lengths), -1)], 1)
    pairs = pairs[(pairs[:, 1] >= 0) & (pairs[:, 0] <= pairs[:, 1])]
    i, j = np.triu_indices(len(lengths))
    third = capacity - lengths[i] - lengths[j]
    ok = third >= lengths[j]
    i, j, k = i[ok], j[ok], place[third[ok]]
    triples = np.stack([i, j, k], 1)[k >= 0]
    return np.concatenate([pairs, triples]).astype(np.int64)


def fit(uses: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares of repeat counts to the histogram, by accelerated projected gradients."""
    n = len(counts)
    flat = np.where(uses < 0, n, uses)

    def times(x):
        return sum(np.bincount(flat[:, c], x, n + 1) for c in range(3))[:n]

    def back(r):
        r = np.r_[r, 0.0]
        return r[flat[:, 0]] + r[flat[:, 1]] + r[flat[:, 2]]

    scale = max(float(back(times(np.ones(len(uses)))).max()), 1.0)  # bounds the largest eigenvalue: row sums of a non-negative matrix
    x = y = np.zeros(len(uses))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - back(times(y) - counts) / scale, 0)
        if ((new - x) * (y - new)).sum() > 0:  # restart when momentum points uphill
            t = 1.0
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / following * (new - x)
        x, t = new, following
    return x


@dataclass
class Plan:
    """Ranges by piece length: first number, first sequence, offset in each sequence; sorted by length and number."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = np.int64(1) << 44
        at = np.searchsorted(self.length * wide + self.first, length * wide + number, "right") - 1
        return self.sequence[at] + number - self.first[at], self.offset[at]


def best_fit_pattern(left: np.ndarray, capacity: int) -> list[int]:
    """The longest piece left, then again and again the longest that fits; a last pair fills the gap exactly if it can."""
    pattern, room = [], capacity
    have = left.copy()
    while True:
        fits = np.flatnonzero(have[:room + 1])
        if not len(fits):
            return pattern
        pick = int(fits[-1])
        rest = room - pick
        if rest and not have[:rest + 1].any():  # nothing goes beside it: look for two that fill the room
            other = room - fits
            exact = fits[(have[other] > (other == fits)) & (other > 0)]
            if len(exact):
                pattern += [int(exact[-1]), int(room - exact[-1])]
                return pattern
        pattern.append(pick)
        have[pick] -= 1
        room = rest


def make_plan(histogram: dict[int, int], capacity: int) -> Plan:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    taken = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int]] = []
    made = 0

    def use(pattern: list[int], times: int) -> None:
        nonlocal made
        offset = 0
        for length in pattern:
            rows.append((length, int(taken[length]), made, offset))
            taken[length] += times
            left[length] -= times
            offset += length
        made += times

    if left[capacity]:
        use([capacity], int(left[capacity]))
    lengths = np.flatnonzero(left)
    if len(lengths):
        uses = patterns(lengths, capacity)
        if len(uses):
            repeats = np.floor(fit(uses, left[lengths].astype(float)) + 1e-6).astype(np.int64)
            for at in np.argsort(-repeats, kind="stable"):
                pattern = [int(lengths[i]) for i in uses[at] if i >= 0]
                need = np.bincount(pattern, minlength=capacity + 1)
                times = min([int(repeats[at]), *[int(left[i] // need[i]) for i in set(pattern)]])
                if repeats[at] < 1:
                    break
                if times > 0:
                    use(pattern, times)
    while left.any():
        pattern = best_fit_pattern(left, capacity)
        need = np.bincount(pattern, minlength=capacity + 1)
        use(pattern, min(int(left[i] // need[i]) for i in set(pattern)))
    columns = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(*columns.T, made)


def segment_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut each text before every space that a visible character follows, where no token of the tokenizer can span."""
    cut = np.zeros(len(data), bool)
    if len(data):
        cut[:-1] = (data[:-1] == 0x20) & SEGMENT_LEAD[data[1:]]
        edges = offsets[1:-1]
        last = edges[(edges > 0) & (edges <= len(data))] - 1
        cut[last] = False  # a text's last byte is followed by another text
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    per_row = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return starts, np.r_[starts[1:], len(data)][:len(starts)], per_row


class Encoder:
    """Ids of whole texts. The tokenizer is a file, or the name of a public one, which each machine has in its own place. Distinct segments of a batch are encoded once, those met before not at all while there is room."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path if os.path.isabs(path) else public_tokenizers.path(path))
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # bytes of each id: one character stands for one byte
        self.width[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def ids_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        found = self.tokenizer.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)
        lists = [e.ids for e in found]
        return np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    def ids_of_segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``ids_of``, for segments that may follow one another in a text.

        No token spans two segments, so some are encoded as one text, and the bytes of the ids tell where each begins.
        Where the bytes do not add up (a tokenizer that writes its tokens otherwise), each is encoded by itself.
        """
        blocks = [b"".join(segments[i:i + SEGMENTS_JOINED]) for i in range(0, len(segments), SEGMENTS_JOINED)]
        ids, _ = self.ids_of(blocks)
        ends, cuts = np.cumsum(self.width[ids]), np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))
        upto = np.searchsorted(ends, cuts)
        if len(ids) and np.array_equal(ends[np.minimum(upto, len(ends) - 1)], cuts) and ends[-1] == cuts[-1]:
            return ids, np.diff(upto + 1, prepend=0)
        return self.ids_of(segments)

    def learn(self, keys: np.ndarray, segments: list[bytes]) -> None:
        joinable = np.array([len(x) > 1 and x[0] == 0x20 and SEGMENT_LEAD[x[1]] for x in segments], bool)
        parts, size, at, used = [self.ids], np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), len(self.ids)
        for chosen, encode in ((np.flatnonzero(joinable), self.ids_of_segments), (np.flatnonzero(~joinable), self.ids_of)):
            for first in range(0, len(chosen), SEGMENTS_AT_ONCE):  # bounds the encodings held at once
                block = chosen[first:first + SEGMENTS_AT_ONCE]
                ids, size[block] = encode([segments[i] for i in block])
                at[block] = used + np.cumsum(size[block]) - size[block]
                used += len(ids)
                parts.append(ids)
        self.ids = np.concatenate(parts)
        # both runs are sorted: each new key goes where it belongs
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = np.insert(self.keys, place, keys), np.insert(self.at, place, at), np.insert(self.size, place, size)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text."""
        data, offsets = text_buffers(texts)
        starts, ends, per_row = segment_spans(data, offsets)
        keys, first, where = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        fresh = np.flatnonzero(~np.isin(keys, self.keys, assume_unique=True))
        if len(self.keys) + len(fresh) > MOST_CACHED:
            self.forget()
            fresh = np.arange(len(keys))
        if len(fresh):
            raw = data.tobytes()
            self.learn(keys[fresh], [raw[a:b] for a, b in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())])
        known = np.searchsorted(self.keys, keys)[where]
        size = self.size[known]
        total = np.r_[0, np.cumsum(size)]
        ids = self.ids[np.repeat(self.at[known] - total[:-1], size) + np.arange(int(total[-1]))]
        at = np.r_[0, np.cumsum(per_row)]
        return np.insert(ids, total[at[1:]], END_ID).astype(np.uint32), total[at[1:]] - total[at[:-1]] + 1


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, ids binary"


def cut_pieces(tokenizer: str, capacity: int, with_ids: bool):
    def run(batches):
        for batch in slices(batches, "text", 2 << 20):
            ids, counts = encoder(tokenizer).encode(batch.column(2))
            raw = memoryview(ids.astype("<u4").tobytes())
            pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = (counts - (pieces - 1) * capacity)[row]
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            at = ((np.cumsum(counts) - counts)[row] + start) * 4
            parts = [raw[a:a + 4 * n] for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                pa.array([bytes(p) for p in parts], pa.binary()) if with_ids else pa.nulls(len(parts), pa.binary()),
            ], names=["doc_id", "row", "piece", "start", "length", "ids_crc32", "ids"])
        give_back()

    return run


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Cut documents of more than ``capacity`` ids into pieces and place all pieces in sequences of at most ``capacity``.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and the piece's ids as
    little-endian unsigned 32-bit integers if ``with_ids``. Only ``doc_id`` and ``text`` are read. A null or empty text
    is one piece of the end id alone. Only the first piece of a document can be shorter than ``capacity``. Repeated
    rows and null ids are documents of their own. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    pieces = rows.mapInArrow(cut_pieces(tokenizer, capacity, with_ids), PIECES)
    pieces = stored(pieces if with_ids else pieces.drop("ids"), "pieces")
    counted = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(make_plan(counted, capacity))
    # number the pieces of each length: cells of a hash, so that a common length is many windows
    cells = max(1, -(-sum(counted.values()) // ROWS_PER_CELL))
    dealt = pieces.withColumn("__cell", F.pmod(F.xxhash64("row", "piece"), F.lit(cells)))
    # a cell is a window over all its lengths; counts of (cell, length) give each its first number
    held = dealt.groupBy("length", "__cell").count()
    first = held.withColumn("__first", F.sum("count").over(W.partitionBy("length").orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)))
    first = first.select("length", "__cell", F.coalesce("__first", F.lit(0)).alias("__first"))
    rank = F.row_number().over(W.partitionBy("length", "__cell").orderBy("row", "piece"))
    numbered = dealt.withColumn("__rank", rank).join(first, ["length", "__cell"]).withColumn("__number", F.col("__first") + F.col("__rank") - 1)
    names = [c for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids") if c in numbered.columns]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", sequence_id long, offset long"

    def run(batches):
        for batch in batches:
            sequence, offset = plan.value.place(np.asarray(batch.column(names.index("length"))), np.asarray(batch.column(len(names))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"])

    return numbered.select(*names, "__number").mapInArrow(run, schema)
