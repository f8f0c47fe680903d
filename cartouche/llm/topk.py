"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments, at several resolutions; a segment has its mean and deviation. For a query q and a
candidate x the Cauchy-Schwarz inequality bounds each segment's share of the inner product by
``size * (mean_q * mean_x + dev_q * dev_x)``, so the sum over segments is an upper bound (of a distance, a lower bound)
that tightens with the resolution. Coarse to fine, candidates whose bound is below a query's k-th best score so far
drop out, and exact integer scores are computed for the survivors.

Queries are a stated set (here ids divisible by ``every``) and meet all rows in blocks: query blocks and row slices
form a grid, and a task has one cell. Each cell gives k rows per query, and the best k of a query's cells are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartouche.llm.graph import stored

SCALE = 1024
QUERY_BLOCK = 512
ROW_SLICE = 8192
LEAST_SLICES = 32
RESOLUTIONS = (1, 4, 16)
CHUNK = 1024


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of segments, scaled so that an inner product of two such rows is the upper bound."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    parts = []
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            mean = x[:, a:b].mean(1)
            parts += [mean * np.sqrt(b - a), np.sqrt(np.maximum((x[:, a:b] ** 2).sum(1) - (b - a) * mean ** 2, 0))]
    return np.stack(parts, 1)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where these are exact, else in whole numbers of any size."""
    most = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    if most * most * q.shape[1] < 2.0 ** 53:
        return np.rint(q @ x.T).astype(np.int64)
    whole = lambda m: np.vectorize(int, otypes=[object])(m)
    scores = whole(q).dot(whole(x).T)
    if max(abs(scores.max()), abs(scores.min())) >= 2 ** 63:
        raise OverflowError("a score does not fit into a long")
    return scores.astype(np.int64)


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def search(queries: np.ndarray, query_ids: np.ndarray, asking: np.ndarray, rows: np.ndarray, ids: np.ndarray, numbers: np.ndarray, k: int):
    """Scores and ids of each query's k best rows; row numbers tell a query's own row, ``asking``, from others under its id."""
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
    floor = np.full(len(query_ids), -np.inf)
    levels = [min(r, rows.shape[1]) for r in RESOLUTIONS]
    of_query = [statistics(queries, s) for s in levels]
    norms = np.sqrt((queries ** 2).sum(1))
    for at in range(0, len(ids), CHUNK):
        x, x_ids, x_numbers = rows[at:at + CHUNK], ids[at:at + CHUNK], numbers[at:at + CHUNK]
        slack = 1e-9 * norms[:, None] * np.sqrt((x ** 2).sum(1))[None, :] + 1e-6
        alive = asking[:, None] != x_numbers[None, :]
        for s, stats in zip(levels, of_query):
            some = alive.any(1)
            bound = stats[some] @ statistics(x, s).T + slack[some]
            alive[some] &= bound >= floor[some][:, None]
        for i in np.flatnonzero(alive.any(1)):
            mine = np.flatnonzero(alive[i])
            scores = np.r_[best[i][0], exact(queries[i:i + 1], x[mine])[0]]
            who = np.r_[best[i][1], x_ids[mine]]
            keep = best_rows(scores, who, k)
            best[i] = (scores[keep], who[keep])
            if len(keep) == k:
                floor[i] = scores[keep[-1]]
    return best


VECTORS = "part long, width long, ids binary, numbers binary, data binary"


def pack_vectors(table: pa.Table) -> pa.Table:
    """Rows of one width and part, all of which take part, as one row of packed arrays."""
    width = table["width"][0].as_py()
    x = np.asarray(table["embedding"].combine_chunks().flatten(), np.float64).reshape(-1, width)
    ids, numbers = (np.asarray(table[c]) for c in ("vec_id", "number"))
    return pa.table({
        "part": table["part"].combine_chunks()[:1].cast(pa.int64()), "width": pa.array([width], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()),
        "numbers": pa.array([numbers.tobytes()], pa.binary()), "data": pa.array([np.floor(x * SCALE).tobytes()], pa.binary()),
    })


def search_cell(k: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                query_ids, asking, ids, numbers = (np.frombuffer(r[c], np.int64) for c in ("q_ids", "q_numbers", "ids", "numbers"))
                queries, rows = (np.frombuffer(r[c]).reshape(-1, r["width"]) for c in ("q_data", "data"))
                best = search(queries, query_ids, asking, rows, ids, numbers, k)
                found = [len(s) for s, _ in best]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(query_ids, found)), pa.array(np.concatenate([i for _, i in best])), pa.array(np.concatenate([s for s, _ in best])),
                ], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` rows of highest score, ties to the smaller ``vec_id``.

    A component x counts as floor(1024 * x). Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates
    are all rows but the query's own. Rows with a null id, a null or empty vector, or a null or non-finite component take no
    part; vectors of different widths do not meet. Repeated rows and ids are candidates as often as they stand there; of
    the rows under a query's id the smallest vector asks, and the others are candidates. Fewer candidates than ``k`` give
    fewer rows; an empty table gives none. Scores beyond a long raise an error.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite).withColumn("width", F.size("embedding").cast("long"))
    rows = stored(rows.withColumn("number", F.monotonically_increasing_id()), "top-k-rows")
    total = rows.count()
    slices = max(LEAST_SLICES, -(-total // ROW_SLICE))
    blocks = max(1, -(-total // (every * QUERY_BLOCK)))
    part = lambda n, seed: F.pmod(F.xxhash64("vec_id", "number", F.lit(seed)), F.lit(n))
    packed = rows.withColumn("part", part(slices, 1)).groupBy("part", "width").applyInArrow(pack_vectors, VECTORS)
    asking = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("embedding", "number", "width")).alias("q")).select("vec_id", "q.*")
    queries = asking.withColumn("part", part(blocks, 2)).groupBy("part", "width").applyInArrow(pack_vectors, VECTORS)
    # the grid: a block of queries is sent to every slice of rows
    queries = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("part"), "width", *[
        F.col(c).alias(f"q_{c}") for c in ("ids", "numbers", "data")])
    found = packed.join(queries, ["part", "width"]).mapInArrow(search_cell(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
