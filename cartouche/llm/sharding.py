"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

Rows fall into cells by a hash of the row, cells into at most ``GROUPS`` groups, and both are counted. How many rows each
part sends to each shard is a multivariate hypergeometric draw without replacement, which is the law of a uniform
permutation cut into shards. The law is closed under merging parts, so the driver draws for the groups alone, whose
number does not grow, and tasks split each group's draw among its cells. Each cell deals its rows by a local random
order, the rows are exchanged, and each shard is permuted again: its rows fall into blocks by a fresh random number, and a
row's slot is its block's offset and its rank there. No window over rows holds more than a cell or a block, whose number
follows the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartouche.llm.graph import stored

SHARDS = 16
ROWS_PER_CELL = 20_000
LEAST_CELLS = 64
GROUPS = 1024
LARGEST = 1_000_000_000  # numpy draws from fewer rows than this


def exact_sizes(rows: int, shards: int) -> np.ndarray:
    """Shard sizes at most one apart."""
    return np.full(shards, rows // shards) + (np.arange(shards) < rows % shards)


def communication_matrix(parts: np.ndarray, left: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rows that each part sends to each shard; its row sums are ``parts``, its column sums ``left``."""
    left = left.astype(np.int64)
    out = np.zeros((len(parts), len(left)), np.int64)
    for i, n in enumerate(parts.tolist()):
        rest = int(left.sum())
        for k, good in enumerate(left.tolist()):
            rest -= good
            out[i, k] = hypergeometric(rng, good, rest, n)
            n -= int(out[i, k])
        left -= out[i]
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good rows among ``n`` drawn of ``good + bad`` without replacement.

    Too many for numpy: every row stands at a uniform place of a line, and the first ``n`` are drawn. The middle good row's
    place is a beta variable, and the bad rows before it are binomial. Either all rows up to it are drawn, or none from it
    on; what is left is a line with half as many good rows.
    """
    taken = 0
    while good and bad and n and good + bad >= LARGEST:
        middle = (good + 1) // 2
        before = int(rng.binomial(bad, rng.beta(middle, good + 1 - middle)))
        if middle + before <= n:
            taken, good, bad, n = taken + middle, good - middle, bad - before, n - middle - before
        else:
            good, bad = middle - 1, before
    if not (good and bad and n):
        return taken + min(good, n)
    return taken + int(rng.hypergeometric(good, bad, n))


def split_groups(matrix: np.ndarray, seed: int):
    """For the cells of one group: how many of a cell's rows, in random order, go to shards up to each."""
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("__cell")
        group = int(cells["__group"].iloc[0])
        sent = communication_matrix(cells["count"].to_numpy(), matrix[group], np.random.default_rng([seed, group]))
        return pd.DataFrame({"__cell": cells["__cell"], "__bounds": list(np.cumsum(sent, axis=1))})

    return run


def random_of(row: list[Column], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *row)


def shard_rows(rows: DataFrame, row: list[str], shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """All columns with ``shard`` (int) and ``slot`` (long, 0 to the shard's size - 1); input columns of these names are replaced.

    ``row`` names columns that tell rows apart: they seed the random numbers, so the result does not depend on how the
    input is partitioned. Rows that agree in all of them are interchangeable. Null values are values like any other.
    An empty table gives an empty result.
    """
    rows = rows.select([f"`{c}`" for c in rows.columns if c not in ("shard", "slot")])
    own = rows.columns
    total = rows.count()
    cells = max(LEAST_CELLS, -(-total // ROWS_PER_CELL))
    ids = [F.col(f"`{c}`") for c in row]
    dealt = rows.withColumn("__cell", F.pmod(random_of(ids, seed), F.lit(cells))).withColumn("__order", random_of(ids, seed + 1))
    counted = stored(dealt.groupBy("__cell").count().withColumn("__group", F.col("__cell") % GROUPS), "shard-cells")
    sizes = np.zeros(min(GROUPS, cells), np.int64)
    for r in counted.groupBy("__group").agg(F.sum("count").alias("rows")).collect():  # at most GROUPS
        sizes[r["__group"]] = r["rows"]
    matrix = communication_matrix(sizes, exact_sizes(total, shards), np.random.default_rng(seed))
    plan = counted.groupBy("__group").applyInPandas(split_groups(matrix, seed), "__cell long, __bounds array<long>")
    rank = F.row_number().over(W.partitionBy("__cell").orderBy("__order", *ids))
    sent = dealt.withColumn("__rank", rank).join(plan, "__cell")
    sent = sent.withColumn("shard", F.size(F.filter("__bounds", lambda b: b < F.col("__rank"))).cast("int"))

    blocks = max(-(-LEAST_CELLS // shards), -(-total // (shards * ROWS_PER_CELL)))
    fresh = F.shiftrightunsigned(random_of(ids, seed + 2), 1)
    sent = sent.withColumn("__order", fresh).withColumn("__block", F.floor(fresh / F.lit(2.0 ** 63 / blocks)).cast("int"))
    sent = stored(sent.select(*[f"`{c}`" for c in own], "shard", "__order", "__block"), "shard-rows")
    before = F.sum("count").over(W.partitionBy("shard").orderBy("__block").rowsBetween(W.unboundedPreceding, -1))  # over counts of blocks
    table = sent.groupBy("shard", "__block").count().select("shard", "__block", F.coalesce(before, F.lit(0)).alias("__offset"))
    rank = F.row_number().over(W.partitionBy("shard", "__block").orderBy("__order", *ids))
    return sent.withColumn("__rank", rank).join(table, ["shard", "__block"]).select(
        *[f"`{c}`" for c in own], "shard", (F.col("__offset") + F.col("__rank") - 1).cast("long").alias("slot"))
