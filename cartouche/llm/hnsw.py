"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Rows are dealt to shards of bounded size by a hash of their id. A shard's index is one row of flat arrays: its distinct
vectors, the sizes of its levels, and each level's neighbour lists, one after the other. Nodes are numbered by falling
level, so a level holds the nodes ``0 .. size - 1`` and the node 0 is the entry point. The largest inner product becomes
a nearest-neighbour problem by one more component per row, ``sqrt(longest^2 - length^2)``, and 0 for a query.

Nodes are inserted in batches: a batch walks the graph so far from the entry point down (a beam of ``BUILD_BEAM``),
adds the batch's own rows as candidates, and keeps ``LINKS`` diverse neighbours a level; a list that outgrows its room is
chosen anew the same way. A search takes a block of queries down the levels at once with a beam of ``SEARCH_BEAM``, and
scores what the beam holds on the original vectors in double precision. Every shard answers every query; the best rows
of all shards are merged, so a query loses a neighbour only where a shard's walk misses it.

Equal vectors of a shard are one node, so a group of copies cannot wall off a part of the graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartouche.llm.graph import stored
from cartouche.llm.words import mix

SHARD_ROWS = 16384
SHARD_BYTES = 32 << 20
LEAST_SHARDS = 8
QUERY_BLOCK = 65536
LINKS = 16
ROOM = (48, 24)  # list lengths at the lowest level and above; a list is cut back to two thirds when full
BUILD_BEAM = 64
SEARCH_BEAM = 96
UPPER_BEAM = 8
EXPANDED = 4
BATCH = 256

INDEX = "width long, shard long, ids binary, starts binary, data binary, levels binary, neighbours binary"
ABSENT = np.float32(-np.inf)


# --- graph ---------------------------------------------------------------------


def similarity(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.einsum("id,id->i", x[left], x[right])


def best_columns(values: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n largest values of each row, in no order."""
    return np.argpartition(-values, n - 1, axis=1)[:, :n] if values.shape[1] > n else np.broadcast_to(np.arange(values.shape[1]), values.shape)


def beam(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int, nodes: int):
    """The ``width`` best nodes that a walk from the entries meets, best first: nodes (-1: none) and similarities."""
    b = len(queries)
    ids = np.full((b, width), -1, np.int32)
    sims = np.full((b, width), ABSENT, np.float32)
    done = np.zeros((b, width), bool)
    seen = np.zeros((b, nodes + 1), bool)
    stamp = np.zeros((b, nodes + 1), np.int16)
    seen[:, -1] = True

    def meet(rows: np.ndarray, found: np.ndarray) -> None:
        at = rows[:, None]
        place = np.arange(found.shape[1], dtype=np.int16)
        stamp[at, found] = place  # the last of equal nodes stays
        fresh = ~seen[at, found] & (stamp[at, found] == place)
        seen[at, found] = True
        r, c = np.nonzero(fresh)
        new = np.full(found.shape, ABSENT, np.float32)
        new[r, c] = np.einsum("id,id->i", queries[rows[r]], x[found[r, c]])
        all_sims = np.concatenate([sims[rows], new], 1)
        keep = best_columns(all_sims, width)
        line = np.arange(len(rows))[:, None]
        sims[rows] = all_sims[line, keep]
        ids[rows] = np.concatenate([ids[rows], found], 1)[line, keep]
        done[rows] = np.concatenate([done[rows], np.zeros(found.shape, bool)], 1)[line, keep]

    meet(np.arange(b), entries)
    while True:
        waiting = np.where(done, ABSENT, sims)
        rows = np.flatnonzero(waiting.max(1) > ABSENT)
        if not len(rows):
            break
        pick = best_columns(waiting[rows], min(EXPANDED, width))
        open_ones = np.take_along_axis(waiting[rows], pick, 1) > ABSENT
        done[rows[:, None], pick] = True
        found = np.where(open_ones[:, :, None], graph[ids[rows[:, None], pick]], -1)
        meet(rows, found.reshape(len(rows), -1))
    order = np.argsort(-sims, axis=1, kind="stable")
    sims = np.take_along_axis(sims, order, 1)
    return np.where(sims > ABSENT, np.take_along_axis(ids, order, 1), -1), sims


def diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of candidates, best first, those nearer to the node than to any chosen before, filled up with the best others; -1: none."""
    out = np.full((len(ids), most), -1, np.int32)
    for a in range(0, len(ids), BATCH):
        some, near = ids[a:a + BATCH], sims[a:a + BATCH]
        v = x[some]
        between = v @ v.transpose(0, 2, 1)
        real = near > ABSENT
        blocked, chosen, count = ~real, np.zeros(some.shape, bool), np.zeros(len(some), np.int64)
        for j in range(some.shape[1]):
            take = ~blocked[:, j] & (count < most)
            chosen[:, j] = take
            count += take
            blocked |= take[:, None] & (between[:, j] > near)
        order = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
        out[a:a + BATCH, :order.shape[1]] = np.where(np.take_along_axis(real, order, 1), np.take_along_axis(some, order, 1), -1)
    return out


def link_back(x: np.ndarray, graph: np.ndarray, sources: np.ndarray, chosen: np.ndarray) -> None:
    """Add each source to the lists of the neighbours it chose; lists without room are chosen anew."""
    room = graph.shape[1]
    r, c = np.nonzero(chosen >= 0)
    target, source = chosen[r, c], sources[r]
    sims = similarity(x, target, source)
    order = np.lexsort((-sims, target))
    target, source, sims = target[order], source[order], sims[order]
    heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, np.int64)
    rank = np.arange(len(target)) - np.repeat(heads, np.diff(np.r_[heads, len(target)]))
    line = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(target)]))
    nodes = target[heads]
    used = (graph[nodes] >= 0).sum(1)
    arriving = np.bincount(line, minlength=len(heads))
    fits = (used + arriving <= room)[line]
    graph[target[fits], (used[line] + rank)[fits]] = source[fits]
    full = np.flatnonzero(used + arriving > room)
    if not len(full):
        return
    some = ~fits & (rank < room)  # of a hub's newcomers the nearest are candidates
    where = np.searchsorted(full, line[some])
    new = np.full((len(full), room), -1, np.int32)
    new[where, rank[some]] = source[some]
    pool = np.concatenate([graph[nodes[full]], new], 1)
    near = np.where(pool >= 0, np.einsum("id,icd->ic", x[nodes[full]], x[pool]), ABSENT)
    order = np.argsort(-near, axis=1, kind="stable")
    kept = diverse(x, np.take_along_axis(pool, order, 1), np.take_along_axis(near, order, 1), room * 2 // 3)
    graph[nodes[full]] = -1
    graph[nodes[full], :kept.shape[1]] = kept


def stretched(x: np.ndarray) -> np.ndarray:
    """Rows with the component that turns inner products into nearness, in single precision, the longest of length 1."""
    scale = np.abs(x).max(initial=0) or 1.0
    lengths = np.sqrt(((x / scale) ** 2).sum(1))
    longest = lengths.max(initial=0) or 1.0
    rest = np.sqrt(np.maximum(1 - (lengths / longest) ** 2, 0))
    return np.concatenate([x / scale / longest, rest[:, None]], 1).astype(np.float32)


def as_queries(q: np.ndarray) -> np.ndarray:
    lengths = np.abs(q).max(1, initial=0, keepdims=True)
    return np.concatenate([q / np.where(lengths > 0, lengths, 1), np.zeros((len(q), 1))], 1).astype(np.float32)


def level_sizes(marks: np.ndarray) -> np.ndarray:
    """How many of the nodes reach each level, from 64-bit marks of the nodes; the lowest level first."""
    share = (marks.astype(np.float64) + 1) / 2.0 ** 64
    level = np.floor(-np.log(share) / np.log(LINKS)).astype(np.int64)
    return (level[:, None] >= np.arange(max(int(level.max(initial=0)), 0) + 1)).sum(0)


def build(x: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of each level over vectors that stand in order of falling level."""
    graphs = [np.full((n, ROOM[min(i, 1)]), -1, np.int32) for i, n in enumerate(sizes)]
    a = 0
    while a < len(x):
        level = int(np.flatnonzero(sizes > a)[-1])
        b = min(a + min(BATCH, max(a // 2, 32)), int(sizes[level]))
        new, mine = x[a:b], np.arange(a, b, dtype=np.int32)
        within = new @ new.T
        np.fill_diagonal(within, ABSENT)
        entries = np.zeros((b - a, 1), np.int32)
        for i in range(len(sizes) - 1, -1, -1):
            found, sims = np.zeros((b - a, 0), np.int32), np.zeros((b - a, 0), np.float32)
            if a:
                found, sims = beam(x, graphs[i], new, entries, BUILD_BEAM if i <= level else UPPER_BEAM, min(a, int(sizes[i])))
                entries = found
            if i <= level:
                near = best_columns(within, min(BUILD_BEAM, b - a))
                ids, all_sims = np.concatenate([found, mine[near]], 1), np.concatenate([sims, np.take_along_axis(within, near, 1)], 1)
                order = np.argsort(-all_sims, axis=1, kind="stable")[:, :BUILD_BEAM]
                chosen = diverse(x, np.take_along_axis(ids, order, 1), np.take_along_axis(all_sims, order, 1), LINKS)
                graphs[i][a:b, :LINKS] = chosen
                link_back(x, graphs[i], mine, chosen)
        a = b
    return graphs


# --- one shard -----------------------------------------------------------------


def build_shard(table: pa.Table) -> pa.Table:
    """One shard's rows as one row of flat arrays: member ids by node, vectors by node, level sizes, neighbour lists."""
    width = table["width"][0].as_py()
    rows = table["embedding"].combine_chunks()
    vectors = np.asarray(rows.flatten(), np.float64).reshape(-1, width) + 0.0  # no negative zero
    ids = np.asarray(table["vec_id"])
    nodes, of = np.unique(vectors, axis=0, return_inverse=True)
    of = of.ravel()
    first = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(first, of, ids)
    marks = mix(mix(first.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    order = np.lexsort((first, marks))  # small marks reach high levels
    place = np.empty(len(nodes), np.int64)
    place[order] = np.arange(len(nodes))
    by_node = np.lexsort((ids, place[of]))
    starts = np.r_[0, np.cumsum(np.bincount(place[of], minlength=len(nodes)))]
    sizes = level_sizes(marks)
    graphs = build(stretched(nodes[order]), sizes)
    return pa.table({
        "width": pa.array([width], pa.int64()), "shard": table["shard"].combine_chunks()[:1].cast(pa.int64()),
        "ids": pa.array([ids[by_node].tobytes()], pa.binary()), "starts": pa.array([starts.astype(np.int64).tobytes()], pa.binary()),
        "data": pa.array([nodes[order].tobytes()], pa.binary()), "levels": pa.array([sizes.astype(np.int64).tobytes()], pa.binary()),
        "neighbours": pa.array([b"".join(g.tobytes() for g in graphs)], pa.binary()),
    })


class Shard:
    """A shard's index, read back from its flat arrays."""

    def __init__(self, row: dict):
        self.ids, self.starts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["starts"], np.int64)
        self.vectors = np.frombuffer(row["data"]).reshape(-1, row["width"])
        self.sizes = np.frombuffer(row["levels"], np.int64)
        lists, at, self.graphs = np.frombuffer(row["neighbours"], np.int32), 0, []
        for i, n in enumerate(self.sizes):
            room = ROOM[min(i, 1)]
            self.graphs.append(lists[at:at + n * room].reshape(n, room))
            at += n * room
        self.x = stretched(self.vectors)

    def search(self, queries: np.ndarray, k: int):
        """``query row, vec_id, score, node`` of at most k rows a query: the highest scores met, ties to smaller ids."""
        parts = [self._block(queries[a:a + BATCH], a, k) for a in range(0, len(queries), BATCH)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _block(self, queries: np.ndarray, offset: int, k: int):
        q = as_queries(queries)
        found = np.zeros((len(q), 1), np.int32)
        for i in range(len(self.sizes) - 1, -1, -1):
            found, _ = beam(self.x, self.graphs[i], q, found, UPPER_BEAM if i else max(SEARCH_BEAM, 2 * k), int(self.sizes[i]))
        line, column = np.nonzero(found >= 0)
        node = found[line, column]
        score = (self.vectors[node] * queries[line]).sum(1)
        keep = ranked(line, score, self.ids[self.starts[node]], k)
        line, node, score = line[keep], node[keep], score[keep]
        sizes = np.minimum(self.starts[node + 1] - self.starts[node], k)  # of equal vectors the smallest ids come first
        line, score, start, node = (np.repeat(v, sizes) for v in (line, score, self.starts[node], node))
        vec_id = self.ids[start + np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        keep = ranked(line, score, vec_id, k)
        return line[keep] + offset, vec_id[keep], score[keep], node[keep]


def ranked(line: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Positions of each line's k highest scores, ties to smaller ids."""
    order = np.lexsort((vec_id, -score, line))
    sorted_line = line[order]
    heads = np.flatnonzero(np.r_[True, sorted_line[1:] != sorted_line[:-1]]) if len(line) else np.zeros(0, np.int64)
    rank = np.arange(len(line)) - np.repeat(heads, np.diff(np.r_[heads, len(line)]))
    return order[rank < k]


def search_shard(k: int):
    """Queries of one cell against its shard; the index row comes first, query rows stream after it."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["neighbours"] is not None:
                    shard = Shard(row)
                    continue
                if shard is None:  # no row of the table fell into this shard
                    return
                asked, queries = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["data"]).reshape(-1, row["width"])
                line, vec_id, score, node = shard.search(queries, k + 1)
                own = (vec_id == asked[line]) & (shard.vectors[node] == queries[line]).all(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[line]), pa.array(vec_id), pa.array(score), pa.array(own)], names=["query_id", "vec_id", "score", "own"])

    return run


# --- Spark ---------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, as ``vec_id long, embedding array<double>, width long``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & finite & some).withColumn("width", F.size("embedding").cast("long"))


def share(column: str, parts: int, seed: int):
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(parts))


def build_index(vectors: DataFrame) -> DataFrame:
    """One row of flat arrays per shard, written to the shared folder.

    Rows with a null id, or whose vector is null, empty, zero or holds a null or non-finite component, are left out;
    repeated rows and ids stay. Vectors of each width have shards of their own.
    """
    rows = usable(vectors)
    total, widest = rows.agg(F.count("*"), F.max("width")).first()
    most = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * (widest or 1))))
    shards = max(LEAST_SHARDS, -(-total // most))
    dealt = rows.withColumn("shard", share("vec_id", shards, 3))
    return stored(dealt.groupBy("width", "shard").applyInArrow(build_shard, INDEX), "hnsw")


def pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries of one width and block as rows of packed arrays."""
    for batch in batches:
        width, block, ids = (np.asarray(batch.column(c)) for c in ("width", "block", "vec_id"))
        for w, b in sorted(set(zip(width.tolist(), block.tolist()))):
            rows = np.flatnonzero((width == w) & (block == b))
            for at in range(0, len(rows), BATCH):
                some = rows[at:at + BATCH]
                data = np.asarray(batch.column("embedding").take(pa.array(some)).flatten(), np.float64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([w], pa.int64()), pa.array([b], pa.int64()), pa.array([ids[some].tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary()),
                ], names=["width", "block", "ids", "data"])


def nearest(index: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product that the graphs lead each query to.

    ``queries`` has the columns of the indexed table. Ranks fall by score, ties go to the smaller ``vec_id``; scores are
    inner products of the original vectors in double precision. One row with the query's own id and vector is the query
    itself and is left out; other rows under its id, equal or not, are candidates. Several query rows under one id ask
    with the smallest vector. Queries that take no part (see ``build_index``) and queries of a width that no row has give
    no rows; fewer candidates than ``k`` give fewer rows.
    """
    asked = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("width", F.size("embedding").cast("long"))
    total, widest = asked.agg(F.count("*"), F.max("width")).first()
    blocks = max(1, -(-total // max(BATCH, min(QUERY_BLOCK, 2 * SHARD_BYTES // (8 * (widest or 1))))))
    shards = int(index.agg(F.max("shard")).first()[0] or 0) + 1
    packed = asked.withColumn("block", share("vec_id", blocks, 4)).mapInArrow(pack_queries, "width long, block long, ids binary, data binary")
    # each shard meets each block of queries once
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asks = packed.select("*", upto(shards).alias("shard"), F.lit(1).alias("kind"))
    held = index.select("*", upto(blocks).alias("block"), F.lit(0).alias("kind"))
    cells = held.unionByName(asks, allowMissingColumns=True).repartition("width", "shard", "block")
    cells = cells.sortWithinPartitions("width", "shard", "block", "kind")  # the grouping below keeps this order
    found = cells.groupBy("width", "shard", "block").applyInArrow(search_shard(k), "query_id long, vec_id long, score double, own boolean")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    # the query itself: the first of its own rows
    first_own = F.min(F.when(F.col("own"), F.col("rank"))).over(W.partitionBy("query_id"))
    found = found.withColumn("__own", first_own).where("__own IS NULL OR rank <> __own")
    rank = F.when(F.col("rank") > F.col("__own"), F.col("rank") - 1).otherwise(F.col("rank"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def approximate_neighbours(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """The ``k`` nearest of all rows for each row whose ``vec_id`` is divisible by ``every``; see ``nearest``."""
    return nearest(build_index(vectors), vectors.where(F.col("vec_id") % every == 0), k)
