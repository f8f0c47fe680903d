"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, reranking with the original vectors.

1. Vectors equal in every component are one class; only its smallest id goes on.
2. On a bounded sample, rotations are learned (iterative quantisation of the unit vectors from different random starts):
   alternately binarise and solve the orthogonal Procrustes problem, so each bit is balanced and close to its projection.
   Every class gets the codes of all rotations, end to end.
3. The codes are cut into substrings, each an exact-match table. Two vectors at the threshold differ in few bits, so they
   agree in some substring. Substrings get longer with the logarithm of the number of vectors, and with them the number of
   rotations grows, so that the share of pairs at the threshold itself that meet in some table stays above ``RECALL``.
4. The vectors of a bucket are compared in double precision, by blocks. A pair that agrees in several tables belongs to
   the first of them, so that it is counted once and no pair has to leave a task: a block gives the number of links of
   each vector and a spanning forest. A large bucket is cut into chunks, and every two chunks are a task of their own.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartouche.llm.exchange import bucket_count
from cartouche.llm.graph import components, forest, stored
from cartouche.llm.vectors import matrices

THRESHOLD = 0.95
SAMPLE_ROWS = 20_000
ROTATIONS = 4
RECALL = 0.97
PROBES = 2000
MOST_ROTATIONS = 1024
CHUNK_ROWS = 1024
BLOCK = 512


def learn_rotations(sample: np.ndarray, rotations: int, rounds: int = 30, seed: int = 5) -> list[np.ndarray]:
    """Rotations: quantisation loss is lowered in turn over the codes and the rotation.

    They are learned about the sample's mean, so that bits are balanced, but codes are signs of the vectors' own
    projections: two vectors that share a direction with all others keep their angle, and the closer they are the more
    bits agree. A sample of fewer rows than components determines no rotation; it gets random ones.
    """
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    v = sample - sample.mean(0) if len(sample) else sample
    _, _, axes = np.linalg.svd(v.T @ v)
    out = []
    for _ in range(rotations):
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        projected = v @ axes.T
        for _ in range(rounds if len(sample) > width else 0):
            codes = np.where(projected @ r >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(projected.T @ codes)
            r = u @ w
        out.append(axes.T @ r)
    return out


def substring_bits(vectors: int, width: int) -> int:
    """About the logarithm of the number of vectors, so that a bucket of unrelated vectors stays small."""
    return int(min(max(np.ceil(np.log2(max(vectors, 2))) - 2, 8), 30, width))


def substrings(x: np.ndarray, learned, bits: int) -> np.ndarray:
    """Value of each table's substring of each vector; the last substring ends with the last bit, so every bit is in one."""
    code = np.concatenate([(x @ rotation >= 0).astype(np.int64) for rotation in learned], 1)
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)
    last = code.shape[1] - bits
    return np.stack([code[:, a:a + bits] @ weights for a in [*range(0, last, bits), last]], 1)


def rotations_needed(bits: int, width: int, threshold: float) -> int:
    """Rotations with which a pair at the threshold, whose bits differ with probability angle / pi, meets at RECALL."""
    agree = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits
    tables = np.log1p(-RECALL) / np.log1p(-agree) if agree < 1 else 1
    return int(np.ceil(np.ceil(tables) * bits / width))


def expected_recall(sample: np.ndarray, learned, bits: int, threshold: float, seed: int = 6) -> float:
    """Share of sample vectors that meet, in some table, a vector at exactly the threshold from them.

    Half of these lie in a random direction, half towards another vector of the sample; the lesser share counts.
    """
    rng = np.random.default_rng(seed)
    x = np.resize(sample, (PROBES, sample.shape[1]))
    shares = []
    for aside in (rng.normal(size=x.shape), sample[rng.integers(0, len(sample), len(x))] + 1e-9 * rng.normal(size=x.shape)):
        aside = aside - (aside * x).sum(1, keepdims=True) * x
        aside /= np.maximum(np.sqrt((aside ** 2).sum(1, keepdims=True)), 1e-300)
        near = threshold * x + np.sqrt(max(1 - threshold ** 2, 0)) * aside
        shares.append((substrings(x, learned, bits) == substrings(near, learned, bits)).any(1).mean())
    return float(min(shares))


def enough_rotations(sample: np.ndarray, bits: int, threshold: float, least: int = ROTATIONS) -> list[np.ndarray]:
    """At least ``least`` rotations, as many as the threshold needs, more until the probes reach RECALL.

    Where learned rotations fall short, random ones follow, whose bits differ with probability angle / pi for every pair.
    A search that ends without RECALL is an error, never a smaller result.
    """
    first = max(least, rotations_needed(bits, sample.shape[1], threshold))
    learned = learn_rotations(sample, first)
    while expected_recall(sample, learned, bits, threshold) < RECALL:
        if len(learned) >= MOST_ROTATIONS:
            raise RuntimeError(f"{len(learned)} rotations do not reach a recall of {RECALL} at cosine {threshold}")
        learned += learn_rotations(sample, 1, 30 if len(learned) < 2 * first else 0, seed=5 + len(learned))
    return learned


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1, keepdims=True)
    x = x / top  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def classify(batches):
    """``row, vec_id, digest, data`` of each vector; no digest where it takes no part."""
    for batch in batches:
        digest, data = [None] * batch.num_rows, [None] * batch.num_rows
        for x, rows in matrices(batch.column(2)):
            good = np.abs(x).max(1, initial=0) > 0
            for r, v in zip(rows[good].tolist(), x[good] + 0.0):  # no negative zeros
                data[r] = v.tobytes()
                digest[r] = hashlib.blake2b(data[r], digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digest, pa.binary()), pa.array(data, pa.binary())],
                                         names=["row", "vec_id", "digest", "data"])


def vectors_of(column) -> np.ndarray:
    blobs = [b.as_buffer() for b in column]
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def table_rows(shared):
    """One row per table and vector: table, substring, vector."""

    def run(batches):
        learned, bits = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            sub = substrings(unit(vectors_of(batch.column(2))), learned, bits)
            n, tables = sub.shape
            at = np.repeat(np.arange(n), tables)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(sub.ravel()),
                *[batch.column(i).take(pa.array(at)) for i in range(3)],
            ], names=["slot", "key", "rep", "copies", "data"])

    return run


def link_chunks(x, sub, copies, ids, left, right, slot: int, threshold: float):
    """Links of two chunks of a bucket, or of one with itself, of those pairs that no earlier table holds."""
    same = right is left
    for s in range(0, len(left), BLOCK):
        i = left[s:s + BLOCK]
        for t in range(s if same else 0, len(right), BLOCK):
            j = right[t:t + BLOCK]
            near = x[i] @ x[j].T >= threshold
            if same and s == t:
                near = np.triu(near, 1)
            p, q = np.nonzero(near)
            p, q = i[p], j[q]
            for c in range(slot):
                if not len(p):
                    break
                own = sub[p, c] != sub[q, c]
                p, q = p[own], q[own]
            if len(p):
                who = np.r_[p, q]
                some, at = np.unique(who, return_inverse=True)
                yield (*forest(ids[p], ids[q]), ids[some], np.bincount(at, np.r_[copies[q], copies[p]]).astype(np.int64))


def link_buckets(shared, threshold: float):
    """Links of all chunk pairs of a group of rows: a spanning forest and the number of links of each vector."""

    def run(table: pa.Table) -> pa.Table:
        learned, bits = shared.value
        unit_of = np.stack([np.asarray(table[c]) for c in ("slot", "key", "chunk_a", "chunk_b", "side")], 1)
        order = np.lexsort(unit_of.T[::-1])
        unit_of = unit_of[order]
        ids, copies = np.asarray(table["rep"])[order], np.asarray(table["copies"])[order]
        x = unit(vectors_of(table["data"]))[order]
        sub = substrings(x, learned, bits)
        starts = np.flatnonzero(np.r_[True, (unit_of[1:, :4] != unit_of[:-1, :4]).any(1)])
        found = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            if b - a > 1:
                rows = np.arange(a, b)
                left = rows[unit_of[a:b, 4] == 0]
                right = left if unit_of[a, 2] == unit_of[a, 3] else rows[unit_of[a:b, 4] == 1]
                found += link_chunks(x, sub, copies, ids, left, right, int(unit_of[a, 0]), threshold)
        if not found:
            none = pa.array([], pa.int64())
            return pa.table({"a": none, "b": none, "n": none})
        node, root, who, links = (np.concatenate(c) for c in zip(*found))
        node, root = forest(node, root)
        who, at = np.unique(who, return_inverse=True)
        return pa.table({
            "a": pa.array(np.r_[node, who]), "b": pa.array(np.r_[root, who]),
            "n": pa.array(np.r_[np.zeros(len(node), np.int64), np.bincount(at, links).astype(np.int64)]),
        })

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, rotations: int = ROTATIONS) -> DataFrame:
    """Link vectors whose cosine, in double precision, is at least ``threshold``.

    Returns one row per input row: ``vec_id, n_links`` (other rows linked directly), ``component_id`` (smallest ``vec_id``
    reachable by links, itself included), ``kept`` (``vec_id`` is ``component_id``). No link below the threshold is made;
    links at it are found unless the codes disagree in every table, which the tests measure: ``rotations`` is the least
    number of rotations, and more are learned where the table's size, width and threshold need them, without a limit that
    could lose links. Vectors of different widths do not link. Null, empty and zero vectors
    and those with a null or non-finite component link with nothing. Repeated rows link with each other. A null id
    is larger than any other and never kept. Only ``vec_id`` and ``embedding`` are read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    last = F.lit(2 ** 63 - 1)
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("vec_id").cast("long"), last).alias("vec_id"), "embedding")
    known = stored(rows.mapInArrow(classify, "row long, vec_id long, digest binary, data binary"), "vectors")
    first = F.min(F.struct("vec_id", "row"))
    classes = stored(known.where("digest is not null").groupBy("digest").agg(first.alias("first"), F.count("*").alias("copies")).select(
        "digest", F.col("first.vec_id").alias("first_id"), F.col("first.row").alias("rep"), "copies"), "vector-classes")
    reps = known.join(classes, "digest").where("row = rep").select("rep", "copies", "data")
    width = F.length("data")  # vectors of each width have codes and tables of their own
    counts = {r[0]: r[1] for r in reps.groupBy(width.alias("w")).count().where("count > 1").collect()}
    parts = [links_of_width(reps.where(width == w), n, w // 8, threshold, sample_rows, rotations) for w, n in sorted(counts.items())]
    found = reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], "a long, b long, n long")
    component = components(found.where("n = 0").select("a", "b"))
    links = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    grouped = classes.join(component, F.col("rep") == component.node).select("digest", "first_id", "component")
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("smallest"))
    grouped = grouped.join(smallest, "component").select("digest", "smallest")
    by_class = classes.join(links, classes.rep == links.node, "left").join(grouped, "digest", "left").select(
        "digest", "copies", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("smallest", "first_id").alias("component"))
    out = known.drop("data").join(by_class, "digest", "left").select(
        F.nullif("vec_id", last).alias("vec_id"), F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).cast("long").alias("n_links"),
        F.nullif(F.coalesce("component", "vec_id"), last).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def links_of_width(reps: DataFrame, n: int, width: int, threshold: float, sample_rows: int, rotations: int) -> DataFrame:
    """Links and link counts of ``n`` different vectors of one width."""
    keep = min(1.0, sample_rows / n)
    sample = reps.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < F.lit(keep * (1 << 20))).orderBy(F.xxhash64("rep")).limit(2 * sample_rows)
    sample = sample.select("data").toPandas()["data"]
    bits = substring_bits(n, width)
    # a table so small that none of its rows fell into the sample is coded by random rotations
    learned = enough_rotations(unit(np.frombuffer(b"".join(sample), np.float64).reshape(len(sample), -1)), bits, threshold, rotations) if len(sample) else (
        learn_rotations(np.zeros((0, width)), 2 * max(rotations, rotations_needed(bits, width, threshold))))
    shared = reps.sparkSession.sparkContext.broadcast((learned, bits))
    return stored(link_tables(reps, shared, threshold), "vector-links")


def link_tables(reps: DataFrame, shared, threshold: float) -> DataFrame:
    rows = stored(reps.select("rep", "copies", "data").mapInArrow(table_rows(shared), "slot int, key long, rep long, copies long, data binary"), "vector-tables")
    buckets = rows.groupBy("slot", "key").count().where("count > 1").select(
        "slot", "key", F.ceil(F.col("count") / CHUNK_ROWS).cast("int").alias("chunks"))
    rows = rows.join(buckets, ["slot", "key"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks").cast("int"))
    # a row goes to every pair of chunks that its chunk is in
    pair = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(
        F.least(c, F.col("chunk")).alias("chunk_a"), F.greatest(c, F.col("chunk")).alias("chunk_b"), F.when(F.col("chunk") <= c, 0).otherwise(1).alias("side")))
    dealt = rows.select("slot", "key", "rep", "copies", "data", F.explode(pair).alias("p")).select("slot", "key", "rep", "copies", "data", "p.*")
    units = bucket_count(reps.sparkSession, 4)  # each has many whole chunk pairs
    dealt = dealt.withColumn("unit", F.pmod(F.xxhash64("slot", "key", "chunk_a", "chunk_b"), F.lit(units)))
    return dealt.groupBy("unit").applyInArrow(link_buckets(shared, threshold), "a long, b long, n long")
