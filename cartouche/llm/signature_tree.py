"""N-gram Jaccard join with signature trees.

1. One scan hashes the distinct shingles of each document and deals them to buckets; a shingle that no other document
   holds cannot be in an intersection. A document can link only if at least the share ``threshold`` of its shingles
   is held by others; the rest leave the join here, and the others keep just their shared shingles.
2. Equal sets are one class; only its smallest id goes on.
3. Sets whose similarity reaches the threshold share a shingle among the first ``n - ceil(threshold * n) + 1`` in any fixed
   order (unshared first, then rare, then common shingles, by hash). Classes are gathered into leaves by their first
   shared shingle and their size, at most about ``LEAF_ROWS`` to a leaf, and leaves that share a prefix shingle become leaf pairs. The
   leaves of a shingle are cut into blocks of about ``BLOCK_LEAVES``, and every two blocks are a cell of their own, so that
   no task holds all leaves of a shingle or all pairs of them.
4. Leaf pairs are gathered into cells of two blocks of leaves (``pair_cells``), so that leaves which all meet, as those of
   near copies do, are not sent once a pair.
   Each leaf pair is joined by a dual traversal of two signature trees: a node has the OR of its token bitmaps and its
   range of set sizes, and a node pair is dropped when its largest possible overlap misses the threshold. Surviving
   pairs of end nodes are counted exactly by a product of their incidence matrices.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartouche.llm.exchange import NO_ID, bucket_count, bucket_of, groups_of, joined
from cartouche.llm.graph import components, forest, released
from cartouche.llm.words import hashed_words, shingle_sets, slices

WORDS = 5
PERCENT = 80
LEAF_ROWS = 256
LEAF_TOKENS = 1 << 18
BLOCK_LEAVES = 128
MOST_PAIRS = 1 << 20
CELL_LEAVES = 32
CELL_BYTES = 16 << 20
HEAVY_SHARE = 1000
HEAVY_LEAST = 256
BITS = 2048
FANOUT = 16

DEALT = "bucket int, known boolean, source int, docs binary, hashes binary, ids binary, sizes binary, digests binary"
DEALT_ARROW = pa.schema([
    ("bucket", pa.int32()), ("known", pa.bool_()), ("source", pa.int32()), ("docs", pa.binary()), ("hashes", pa.binary()),
    ("ids", pa.binary()), ("sizes", pa.binary()), ("digests", pa.binary()),
])


def least_overlap(a, b, percent: int):
    """Smallest intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


TOKEN_BITS = np.uint64(48)
TOKEN_BYTES = 6


def token_of(hashes: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """48 bits of one hash under the bucket that the other hash chose."""
    return (bucket.astype(np.uint64) << TOKEN_BITS) | (hashes >> (np.uint64(64) - TOKEN_BITS))


def dealt(bucket: np.ndarray, docs: np.ndarray, tokens: np.ndarray, known: bool, source: np.ndarray | int | None) -> pa.RecordBatch:
    """Rows of DEALT, one per bucket: each entry's document as the step from the one before, compressed, and its token.

    ``docs`` ascend, so most steps are small. ``source`` is the bucket that the tokens of a row begin with; they leave it out.
    """
    order = np.argsort(bucket, kind="stable")
    bucket, docs, tokens = bucket[order], docs[order].astype(np.int64), tokens[order]
    starts = groups_of(bucket)
    cuts = np.r_[starts, len(bucket)].tolist()
    steps = np.diff(docs, prepend=0)
    steps[starts] = docs[starts]
    steps, raw = steps.view(np.uint8).reshape(-1, 8), tokens.view(np.uint8).reshape(-1, 8)[:, :8 if source is None else TOKEN_BYTES]
    spans = list(zip(cuts, cuts[1:]))
    rest = [pa.nulls(len(spans), f.type) for f in DEALT_ARROW][5:]
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[starts], pa.int32()),
        pa.array(np.full(len(spans), known)),
        pa.nulls(len(spans), pa.int32()) if source is None else pa.array(np.broadcast_to(source, bucket.shape)[order][starts], pa.int32()),
        pa.array([pa.compress(steps[a:b].T.tobytes(), "zstd", asbytes=True) for a, b in spans], pa.binary()),
        pa.array([raw[a:b].tobytes() for a, b in spans], pa.binary()),
        *rest,
    ], schema=DEALT_ARROW)


def entries_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document and token of each entry."""
    docs, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for source, steps, raw in zip(table["source"].to_pylist(), table["docs"], table["hashes"]):
        if not raw.is_valid:
            continue
        raw = np.frombuffer(raw.as_buffer(), np.uint8).reshape(-1, 8 if source is None else TOKEN_BYTES)
        whole = np.zeros((len(raw), 8), np.uint8)
        whole[:, :raw.shape[1]] = raw
        tokens.append(whole.view(np.uint64).ravel() | (np.uint64(source or 0) << TOKEN_BITS))
        planes = np.frombuffer(pa.decompress(steps.as_buffer(), 8 * len(raw), "zstd"), np.uint8).reshape(8, -1)
        docs.append(np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel()))
    return np.concatenate(docs), np.concatenate(tokens)


def hash_shingles(length: int, buckets: int):
    """Entries of shared-shingle counting, and for each row its number, id, set size and set digest."""

    def run(batches):
        for batch in slices(batches, "text", 4 << 20):
            rows, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            words, per_row = hashed_words(batch.column(2), lower=True)
            one, two, sizes = shingle_sets(words, per_row, length)
            row = np.repeat(rows, sizes)
            bucket = (two % np.uint64(buckets)).astype(np.int32)
            one = token_of(one, bucket)
            order = np.argsort(one, kind="stable")
            starts = groups_of(one[order])
            many = np.diff(np.r_[starts, len(order)])
            single = np.sort(order[starts])
            # the first row stands for the slice; it is known to be shared if the slice has another
            yield dealt(bucket[single], row[single], one[single], False, bucket[single])
            shared = np.sort(order[np.repeat(many > 1, many)])
            yield dealt(bucket_of(row[shared], buckets), row[shared], one[shared], True, None)
            cuts = np.cumsum(sizes) - sizes
            digests = [hashlib.blake2b(one[c:c + n].tobytes() + np.sort(two[c:c + n]).tobytes(), digest_size=16).digest() for c, n in zip(cuts, sizes)]
            at = bucket_of(rows, buckets)
            sizes = sizes.astype(np.int64)
            table = []
            for b in np.unique(at):
                some = np.flatnonzero(at == b)
                table.append((int(b), True, None, None, None, rows[some].tobytes() + ids[some].tobytes(), sizes[some].tobytes(), b"".join(digests[i] for i in some)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*table), DEALT_ARROW)], schema=DEALT_ARROW)

    return run


def mark_shared(buckets: int):
    """Of each hash that two rows sent, every row; what was known goes on."""

    def run(table: pa.Table) -> pa.Table:
        known = np.asarray(table["known"])
        rows, hashes = entries_of(table.filter(pa.array(~known)))
        order = np.argsort(hashes, kind="stable")
        starts = groups_of(hashes[order])
        many = np.diff(np.r_[starts, len(order)])
        shared = order[np.repeat(many > 1, many)]
        shared = shared[np.argsort(rows[shared], kind="stable")]
        out = dealt(bucket_of(rows[shared], buckets), rows[shared], hashes[shared], True, table["bucket"][0].as_py())
        return pa.concat_tables([table.filter(pa.array(known)), pa.Table.from_batches([out]).cast(table.schema)])

    return run


LEAF = ["ids", "sizes", "copies", "lengths", "tokens"]
SET_ROW = "row long, doc_id long, n_shingles long, digest binary, tokens binary"


def gather_sets(percent: int):
    """One row per document; shared tokens only where enough of the set is shared for a link."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), np.int64) for x in table["ids"] if x.is_valid]
        rows = np.concatenate([p[:len(p) // 2] for p in parts]) if parts else np.zeros(0, np.int64)
        ids = np.concatenate([p[len(p) // 2:] for p in parts]) if parts else rows
        meta = table.filter(table["ids"].is_valid()) if table.num_rows else table
        sizes = joined(meta["sizes"], np.int64)
        raw = b"".join(x.as_buffer() for x in meta["digests"])
        entry_rows, hashes = entries_of(table)
        order = np.lexsort((hashes, entry_rows))
        entry_rows, hashes = entry_rows[order], hashes[order]
        fresh = np.r_[True, (entry_rows[1:] != entry_rows[:-1]) | (hashes[1:] != hashes[:-1])][:len(hashes)]
        entry_rows, hashes = entry_rows[fresh], hashes[fresh]
        first, last = np.searchsorted(entry_rows, rows, "left"), np.searchsorted(entry_rows, rows, "right")
        live = (sizes > 0) & (100 * (last - first) >= percent * sizes)
        return pa.table({
            "row": pa.array(rows, pa.int64()),
            "doc_id": pa.array(ids, pa.int64()),
            "n_shingles": pa.array(sizes, pa.int64()),
            "digest": pa.array([raw[16 * i:16 * i + 16] if n else None for i, n in enumerate(sizes)], pa.binary()),
            "tokens": pa.array([hashes[a:b].tobytes() if ok else None for a, b, ok in zip(first, last, live)], pa.binary()),
        })

    return run


def ordered_tokens(tokens: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens in the global order: rare ones by hash, then heavy ones by hash; and the number of rare ones."""
    if not len(heavy):
        return tokens, len(tokens)
    is_heavy = heavy[np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)] == tokens
    rare = tokens[~is_heavy]
    return np.r_[rare, tokens[is_heavy]], len(rare)


def prefixes(percent: int, heavy_packed):
    """``leaf_key`` and the prefix of each set, as one row per token."""

    def run(batches):
        heavy = np.frombuffer(heavy_packed.value, np.uint64)
        for batch in batches:
            out_id, out_token, out_key = [], [], []
            for doc, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                tokens, rare = ordered_tokens(np.frombuffer(blob.as_buffer(), np.uint64), heavy)
                length = n - -(-percent * n // 100) + 1 - (n - len(tokens))
                take = tokens[:max(length, 1)]
                out_id.append(np.full(len(take), doc, np.int64))
                out_token.append(take)
                # sets that need heavy tokens meet all others that do, so these are gathered by their first heavy one
                out_key.append(np.full(len(take), take[rare] if rare < len(take) else take[0], np.uint64))
            if out_id:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(out_id)), pa.array(np.concatenate(out_token).view(np.int64)),
                    pa.array(np.concatenate(out_key).view(np.int64)),
                ], names=["rep", "token", "leaf_key"])

    return run


def count_tokens(batches):
    """Tokens that two sets of a batch hold, with their number of sets."""
    for batch in batches:
        tokens = joined(batch.column(0), np.uint64)
        values, counts = np.unique(tokens, return_counts=True)
        some = counts > 1
        yield pa.RecordBatch.from_arrays([pa.array(values[some].view(np.int64)), pa.array(counts[some], pa.int64())], names=["token", "n"])


def pack_leaf(table: pa.Table) -> pa.Table:
    """The sets of a leaf in one row, by size."""
    order = np.lexsort((np.asarray(table["rep"]), np.asarray(table["n_shingles"])))
    table = table.take(pa.array(order))
    blobs = [x.as_buffer() for x in table["tokens"]]
    return pa.table({
        "leaf": pa.array([table["leaf"][0].as_py()], pa.int64()),
        "ids": pa.array([np.asarray(table["rep"]).tobytes()], pa.binary()),
        "sizes": pa.array([np.asarray(table["n_shingles"]).tobytes()], pa.binary()),
        "copies": pa.array([np.asarray(table["copies"]).tobytes()], pa.binary()),
        "lengths": pa.array([np.array([b.size // 8 for b in blobs], np.int64).tobytes()], pa.binary()),
        # near copies hold nearly the same tokens in the same order
        "tokens": pa.array([pa.compress(b"".join(blobs), "zstd", asbytes=True)], pa.binary()),
        "bytes": pa.array([sum(b.size for b in blobs)], pa.int64()),
    })


class SignatureTree:
    """Sets in size order under nodes of FANOUT children; a node has an OR-combined bitmap and a size range."""

    def __init__(self, ids, sizes, copies, lengths, tokens):
        self.ids, self.sizes, self.copies, self.tokens = ids, sizes, copies, tokens
        self.cut = np.r_[0, np.cumsum(lengths)]
        bitmap = np.zeros((len(ids), BITS), bool)
        bitmap[np.repeat(np.arange(len(ids)), lengths), (tokens % np.uint64(BITS)).astype(np.int64)] = True
        # unshared tokens are in no bitmap; they lower the possible overlap
        spare = lengths - bitmap.sum(1)  # tokens that share a bit with another of their set
        levels = [(bitmap, sizes, sizes, lengths, spare)]
        while len(levels[-1][1]) > 1:
            bits, low, high, held, spare = levels[-1]
            at = np.arange(0, len(low), FANOUT)
            levels.append((
                np.logical_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                np.maximum.reduceat(held, at), np.maximum.reduceat(spare, at),
            ))
        self.levels = [(np.packbits(bits, axis=1).view(np.uint64), *rest) for bits, *rest in levels]

    def possible(self, level: int, i: np.ndarray, other: SignatureTree, j: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs may hold a link."""
        return possible([x[i] for x in self.levels[level]], [x[j] for x in other.levels[level]], percent, level == 0)

    def join(self, other: SignatureTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """All linked pairs of positions; of a tree with itself, each pair once."""
        own = self is other
        top = max(len(self.levels), len(other.levels)) - 1
        a, b = self.lifted(top), other.lifted(top)
        i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
        found_i, found_j = [], []
        for level in range(top, -1, -1):
            if level < top:
                i, j = a.children(level, i, j, b, own)
            keep = []
            for s in range(0, len(i), 8192):
                keep.append(a.possible(level, i[s:s + 8192], b, j[s:s + 8192], percent))
            keep = np.concatenate(keep) if keep else np.zeros(0, bool)
            i, j = i[keep], j[keep]
        if own:
            i, j = i[i < j], j[i < j]
        # exact counts, a block of rows at a time over the tokens that both sides hold
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        for s in range(0, len(i), 4096):
            x, y = i[s:s + 4096], j[s:s + 4096]
            ok = self.overlaps(x, other, y) >= least_overlap(self.sizes[x], other.sizes[y], percent)
            found_i.append(x[ok])
            found_j.append(y[ok])
        none = np.zeros(0, np.int64)
        return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (none, none)

    def lifted(self, top: int) -> SignatureTree:
        """The tree with its root repeated until it has ``top + 1`` levels."""
        if len(self.levels) == top + 1:
            return self
        out = object.__new__(SignatureTree)
        out.__dict__.update(self.__dict__)
        out.levels = self.levels + [self.levels[-1]] * (top + 1 - len(self.levels))
        return out

    def children(self, level: int, i, j, other: SignatureTree, own: bool):
        out_i, out_j = [], []
        for x, y in zip(i.tolist(), j.tolist()):
            c, d = self.under(level, x), other.under(level, y)
            out_i.append(np.repeat(c, len(d)))
            out_j.append(np.tile(d, len(c)))
        i = np.concatenate(out_i) if out_i else np.zeros(0, np.int64)
        j = np.concatenate(out_j) if out_j else np.zeros(0, np.int64)
        if own:
            i, j = i[i <= j], j[i <= j]
        return i, j

    def under(self, level: int, node: int) -> np.ndarray:
        if len(self.levels[level][1]) == len(self.levels[level + 1][1]):
            return np.array([node])
        return np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level][1])))

    def overlaps(self, x: np.ndarray, other: SignatureTree, y: np.ndarray) -> np.ndarray:
        """Intersection sizes of pairs, from a product of incidence matrices over the tokens both sides hold."""
        left, at_x = np.unique(x, return_inverse=True)
        right, at_y = np.unique(y, return_inverse=True)
        a, row_a = self.some(left)
        b, row_b = other.some(right)
        both = np.intersect1d(a, b)
        out = np.zeros(len(x), np.float32)
        for s in range(0, len(both), 4096):
            part = both[s:s + 4096]
            out += (incidence(a, row_a, len(left), part) @ incidence(b, row_b, len(right), part).T)[at_x, at_y]
        return np.rint(out).astype(np.int64)

    def some(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.cut[rows + 1] - self.cut[rows]
        at = np.repeat(self.cut[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.tokens[at], np.repeat(np.arange(len(rows)), size)


def possible(left, right, percent: int, single: bool) -> np.ndarray:
    """Node pairs whose size ranges and bitmaps allow the overlap that a link needs.

    The common tokens of two sets lie in bits that both nodes have, one to a bit but for tokens that share a bit with
    another of their set. Of single sets, each token in a bit that the other lacks is lost as well.
    """
    (bits, low, high, held, spare), (bits2, low2, high2, held2, spare2) = left, right
    need = least_overlap(low, low2, percent)
    ok = (100 * high >= percent * low2) & (100 * high2 >= percent * low) & (np.minimum(held, held2) >= need)
    some = np.flatnonzero(ok)
    both = np.bitwise_count(bits[some] & bits2[some]).sum(1, dtype=np.int64)
    most = both + np.minimum(spare[some], spare2[some])
    if single:
        own, own2 = (np.bitwise_count(b[some]).sum(1, dtype=np.int64) for b in (bits, bits2))
        most = np.minimum(most, np.minimum(held[some] - own, held2[some] - own2) + both)
    ok[some] = most >= need[some]
    return ok


def incidence(tokens, rows, n: int, part) -> np.ndarray:
    at = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
    hit = part[at] == tokens
    out = np.zeros((n, len(part)), np.float32)
    out[rows[hit], at[hit]] = 1
    return out


NODE = "leaf long, bits binary, low long, high long, held long, spare long"


def leaf_nodes(batches):
    """The root of each leaf's tree: its node one level up."""
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            bits, *rest = tree_of(*(batch.column(m)[k] for m in range(1, 6))).levels[-1]
            rows.append((batch.column(0)[k].as_py(), bits.tobytes(), *(int(x[0]) for x in rest)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["leaf", "bits", "low", "high", "held", "spare"])


def prune_pairs(percent: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c = [batch.column(i) for i in range(12)]
            node = lambda k: [np.frombuffer(b"".join(x.as_buffer() for x in c[k]), np.uint64).reshape(batch.num_rows, -1), *(np.asarray(c[m]) for m in range(k + 1, k + 5))]
            keep = possible(node(2), node(7), percent, False)
            yield pa.RecordBatch.from_arrays([c[0].filter(pa.array(keep)), c[1].filter(pa.array(keep))], names=["a", "b"])

    return run


def tree_of(ids, sizes, copies, lengths, tokens) -> SignatureTree:
    ids, sizes, copies, lengths = (np.frombuffer(x.as_buffer(), np.int64) for x in (ids, sizes, copies, lengths))
    return SignatureTree(ids, sizes, copies, lengths, np.frombuffer(pa.decompress(tokens.as_buffer(), 8 * int(lengths.sum()), "zstd"), np.uint64))


FOUND = "a long, b long, n long"
FOUND_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def links_of(pairs, percent: int) -> pa.RecordBatch:
    """Links of pairs of trees: a star per linked group, and the number of linked documents of each class."""
    ends, counts = [np.zeros((2, 0), np.int64)], [np.zeros((2, 0), np.int64)]
    for a, b in pairs:
        i, j = a.join(b, percent)
        if len(i):
            ends.append(np.stack(forest(a.ids[i], b.ids[j])))
            n = np.r_[np.bincount(i, b.copies[j], len(a.ids)), np.bincount(j, a.copies[i], len(b.ids))].astype(np.int64)
            counts.append(np.stack([np.r_[a.ids, b.ids], n])[:, n > 0])
    node, root = forest(*np.concatenate(ends, 1))
    who, n = np.concatenate(counts, 1)
    who, at = np.unique(who, return_inverse=True)
    total = np.zeros(len(who), np.int64)
    np.add.at(total, at, n)
    return pa.RecordBatch.from_arrays([
        pa.array(np.r_[node, who]), pa.array(np.r_[root, who]), pa.array(np.r_[np.zeros(len(node), np.int64), total]),
    ], schema=FOUND_ARROW)


def join_within(percent: int):
    """Links inside leaves."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                a = tree_of(*(c[k] for c in batch.columns))
                yield links_of([(a, a)], percent)

    return run


def join_cell(percent: int):
    """Links of the leaf pairs of a cell."""

    def run(table: pa.Table) -> pa.Table:
        trees = {leaf: tree_of(*(table[name][k] for name in LEAF)) for k, leaf in enumerate(table["leaf"].to_pylist())}
        pairs = ((trees[leaf], trees[other]) for leaf, others in zip(table["leaf"].to_pylist(), table["others"].to_pylist()) for other in others)
        return pa.Table.from_batches([links_of(pairs, percent)])

    return run


def pair_cells(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """``cell_a, cell_b, leaf, others``: the leaves of each cell once, each with those that it is paired with there.

    Leaves around the same most paired one, as those of a group of near copies are, are cut into blocks, and two blocks
    are a cell: a leaf is sent once for each block that it meets, not once for each leaf. ``sizes`` has ``leaf, bytes``.
    """
    both = pairs.select(F.col("a").alias("leaf"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    paired = both.groupBy("leaf").agg(F.count("*").alias("n"))
    around = both.union(paired.select("leaf", "leaf")).join(paired.withColumnRenamed("leaf", "other"), "other")
    around = around.groupBy("leaf").agg(F.max(F.struct("n", "other"))["other"].alias("centre")).join(sizes, "leaf")
    chunks = around.groupBy("centre").agg(
        F.greatest(F.ceil(F.count("*") / CELL_LEAVES), F.ceil(F.sum("bytes") / CELL_BYTES)).alias("chunks"))
    block = released(around.join(chunks, "centre").select(
        "leaf", F.xxhash64("centre", F.pmod(F.xxhash64("leaf"), "chunks")).alias("block")), "leaf-blocks")
    block_of = lambda side: block.select(F.col("leaf").alias(side), F.col("block").alias(f"{side}_block"))
    placed = pairs.join(block_of("a"), "a").join(block_of("b"), "b").select(
        F.least("a_block", "b_block").alias("cell_a"), F.greatest("a_block", "b_block").alias("cell_b"), "a", "b")
    sent = placed.select("cell_a", "cell_b", F.col("a").alias("leaf"), F.col("b").alias("other")).union(
        placed.select("cell_a", "cell_b", "b", F.lit(None).cast("long")))
    return sent.groupBy("cell_a", "cell_b", "leaf").agg(F.collect_list("other").alias("others"))


def distinct_pairs(held: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.concatenate(held, 1)
    a, b = pairs[:, np.lexsort(pairs[::-1])]
    fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    return pa.RecordBatch.from_arrays([pa.array(a[fresh], pa.int64()), pa.array(b[fresh], pa.int64())], names=["a", "b"])


def pairs_of_cells(batches):
    """Every leaf pair of each cell, the smaller leaf first; once among about MOST_PAIRS."""
    for batch in batches:
        held, n = [], 0
        for left, right, own in zip(*batch.columns):
            x, y = np.asarray(left.values), np.asarray(right.values)
            if own.as_py():
                i, j = np.triu_indices(len(x), 1)
                x, y = x[i], x[j]
            else:
                x, y = np.repeat(x, len(y)), np.tile(y, len(x))
            held.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
            n += len(x)
            if n >= MOST_PAIRS:
                yield distinct_pairs(held)
                held, n = [], 0
        if n:
            yield distinct_pairs(held)


def leaf_cells(holds: DataFrame) -> DataFrame:
    """``left, right, own``: two blocks of the leaves that hold a token, or one with itself; ``holds`` has ``token, leaf`` once.

    Numbers of blocks are powers of two and cells are dealt by the token's smallest leaf, so that tokens which the same
    leaves hold, as those of near copies, have like cells in one task, where their pairs are merged.
    """
    weight = holds.groupBy("token").agg(F.count("*").alias("n"), F.min("leaf").alias("first")).where("n > 1").select(
        "token", "first", F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") / BLOCK_LEAVES, F.lit(1.0))))).cast("int").alias("blocks"))
    rows = holds.join(weight, "token").withColumn("block", F.pmod(F.xxhash64("leaf"), "blocks").cast("int"))
    # a leaf goes to every cell that its block is in
    cell = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda c: F.struct(
        F.least(c, F.col("block")).alias("block_a"), F.greatest(c, F.col("block")).alias("block_b"), (F.col("block") <= c).alias("is_left")))
    dealt = rows.select("token", "leaf", "first", F.explode(cell).alias("c")).select("token", "leaf", "first", "c.*")
    dealt = dealt.repartition("first", "block_a", "block_b")
    side = lambda left: F.collect_list(F.when(F.col("is_left") == left, F.col("leaf")))
    cells = dealt.groupBy("first", "block_a", "block_b", "token").agg(side(True).alias("left"), side(False).alias("right"))
    return cells.sortWithinPartitions("first", "block_a", "block_b").select("left", "right", (F.col("block_a") == F.col("block_b")).alias("own"))


def jaccard_classes(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Link documents whose sets of ``words``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.

    Returns one row per document: ``doc_id, n_shingles, n_links`` (other documents linked directly), ``component_id``
    (smallest ``doc_id`` reachable by links, itself included). Only ``doc_id`` and ``text`` are read. A null, empty or
    blank text has no shingle and links with nothing; a text with fewer words is one shingle. A null ``doc_id`` counts as
    larger than all others. Repeated rows are documents of their own and link with each other. An empty table gives an
    empty result.
    """
    spark = documents.sparkSession
    buckets = bucket_count(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID)))
    rows = documents.select(F.monotonically_increasing_id().alias("row"), key.alias("doc_id"), "text")
    entries = rows.mapInArrow(hash_shingles(words, buckets), DEALT)
    marked = entries.groupBy("bucket").applyInArrow(mark_shared(buckets), DEALT)
    sets = released(marked.groupBy("bucket").applyInArrow(gather_sets(percent), SET_ROW), "sets")
    first = F.min(F.struct("doc_id", "row"))
    classes = released(sets.where("digest is not null").groupBy("digest").agg(first.alias("first"), F.count("*").alias("copies")).select(
        "digest", F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("rep"), "copies"), "classes")
    reps = sets.where("tokens is not null").join(classes, "digest").where("row = rep")
    reps = released(reps.select("rep", "n_shingles", "copies", "tokens"), "reps")

    found = released(link_leaves(reps, percent), "found")
    component = components(found.where("n = 0").select("a", "b"))
    links = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    grouped = classes.join(component, F.col("rep") == component.node).select("digest", "first_id", "component")
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    grouped = grouped.join(smallest, "component").select("digest", "component_id")
    by_class = classes.join(links, classes.rep == links.node, "left").join(grouped, "digest", "left").select(
        "digest", "copies", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component_id", "first_id").alias("component"))
    return sets.drop("tokens").join(by_class, "digest", "left").select(
        F.expr(f"nullif(doc_id, {NO_ID})").alias("doc_id"),
        "n_shingles",
        F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).cast("long").alias("n_links"),
        F.expr(f"nullif(coalesce(component, doc_id), {NO_ID})").alias("component_id"),
    )


def heavy_tokens(reps: DataFrame) -> np.ndarray:
    """Tokens in at least one of HEAVY_SHARE sets. There are at most HEAVY_SHARE times the mean set size, however many
    sets there are; they come last in the token order, which changes the work but not the links."""
    least = max(HEAVY_LEAST, reps.count() // HEAVY_SHARE)
    counts = reps.select("tokens").mapInArrow(count_tokens, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return np.sort(counts.where(F.col("n") >= least).select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def link_leaves(reps: DataFrame, percent: int) -> DataFrame:
    """``a, b, n``: links of a spanning forest (n = 0) and partial counts of linked documents (a = b)."""
    spark = reps.sparkSession
    heavy = spark.sparkContext.broadcast(heavy_tokens(reps).tobytes())
    prefix = released(reps.select("rep", "n_shingles", "tokens").mapInArrow(prefixes(percent, heavy), "rep long, token long, leaf_key long"), "prefixes")
    # sets of one class are alike enough in size to link; a leaf of all sizes would face most others
    like = (F.floor(F.log(100 / percent, "n_shingles")) if percent < 100 else F.col("n_shingles")).alias("like")
    keyed = prefix.where("token = leaf_key").select("rep", "leaf_key").join(
        reps.select("rep", like, (F.length("tokens") / 8).alias("size")), "rep")
    weight = keyed.groupBy("leaf_key", "like").agg(
        F.greatest(F.ceil(F.count("*") / LEAF_ROWS), F.ceil(F.sum("size") / LEAF_TOKENS)).alias("chunks"))
    leaf_of = released(keyed.join(weight, ["leaf_key", "like"]).select(
        "rep", F.xxhash64("leaf_key", "like", F.pmod(F.xxhash64("rep"), "chunks")).alias("leaf")), "leaf-of")
    leaves = reps.join(leaf_of, "rep").groupBy("leaf").applyInArrow(
        pack_leaf, "leaf long, ids binary, sizes binary, copies binary, lengths binary, tokens binary, bytes long")
    leaves = released(leaves, "leaves")
    holds = released(prefix.join(leaf_of, "rep").select("token", "leaf").distinct(), "token-leaves")
    pairs = leaf_cells(holds).mapInArrow(pairs_of_cells, "a long, b long").distinct()
    nodes = released(leaves.mapInArrow(leaf_nodes, NODE), "nodes")
    node_of = lambda side: nodes.select(F.col("leaf").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in nodes.columns[1:]])
    facing = pairs.join(node_of("a"), "a").join(node_of("b"), "b")
    facing = facing.select("a", "b", *[f"a_{c}" for c in nodes.columns[1:]], *[f"b_{c}" for c in nodes.columns[1:]])
    pairs = released(facing.mapInArrow(prune_pairs(percent), "a long, b long"), "leaf-pairs")
    cells = pair_cells(pairs, leaves.select("leaf", "bytes")).join(leaves.drop("bytes"), "leaf")
    between = cells.groupBy("cell_a", "cell_b").applyInArrow(join_cell(percent), FOUND)
    return between.union(leaves.where(F.length("ids") > 8).select(*LEAF).mapInArrow(join_within(percent), FOUND))
