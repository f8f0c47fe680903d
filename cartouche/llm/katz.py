"""LM scoring: a Katz backoff bigram model with Good-Turing discounts and exactly normalised backoff weights.

Every training word is in the vocabulary, and every bigram counts, at any corpus size. The texts are read once, into slices:
a slice holds its distinct words by 64-bit hash and its tokens as places in that list. Slices deal their words to buckets,
which number their words, common ones first, and answer each slice with the counts and numbers of its words; then slices deal
their distinct bigrams, as sorted numbers, to the bucket of the history, which answers with the bigrams' counts and each
history's sums. A common history is spread over all buckets and its sums
are added up. A slice then has all it needs to score its texts. Words that no training text holds are one class. The driver
keeps counts of counts, totals and the sums of common histories (fewer than ``HEAVY_SHARE``), so nothing on it or broadcast
grows with the vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.llm.exchange import NO_ID, bucket_count, bucket_of, groups_of
from cartouche.llm.graph import stored
from cartouche.llm.words import hashed_words, mix, second, slices
from cartouche.sources.scratch import fresh_path

LARGEST_DISCOUNTED = 5
HEAVY_SHARE = 1000
END = np.uint64(0x45D9F3B3335B369)  # stands for the end of a text, and as a history for its beginning
UNKNOWN = np.uint64(1 << 62)  # the number of the class of words outside the vocabulary, above every word's own
SLICE = 4 << 20

WORDS, BIGRAMS, COUNTED, HEAVY = 0, 1, 2, 3
REPLY = "kind int, slice long, bucket int, counts binary, more binary"
REPLY_ARROW = pa.schema([("kind", pa.int32()), ("slice", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("more", pa.binary())])


def squeeze(values: np.ndarray) -> bytes:
    """Bytes of an array, most alike bytes together, compressed."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def expand(blob, dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(memoryview(blob))
    size = np.dtype(dtype).itemsize
    return np.frombuffer(np.frombuffer(raw, np.uint8).reshape(size, -1).T.tobytes(), dtype)


def gather(column, dtype) -> np.ndarray:
    parts = [expand(x.as_buffer(), dtype) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def discounts(of_count: dict[int, int]) -> np.ndarray:
    """Katz's Good-Turing discount ratios of counts 0 to LARGEST_DISCOUNTED + 1; larger counts are kept whole.

    A ratio outside (0, 1), as sparse tables give, is replaced by the one of absolute discounting.
    """
    k = LARGEST_DISCOUNTED
    n = np.array([of_count.get(r, 0) for r in range(k + 2)], float)
    d = np.ones(k + 2)
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
    spare = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        ratio = ((r + 1) * n[r + 1] / (r * n[r]) - spare) / (1 - spare) if n[r] and spare < 1 else 0.0
        d[r] = ratio if 0 < ratio < 1 else 1 - min(max(absolute, 0.1), 0.9) / r
    return d


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * d[np.minimum(counts, len(d) - 1)]


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return (second(words) % np.uint64(buckets)).astype(np.int32)


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that gathers buckets and keeps what was before within each; where each bucket starts, and the end."""
    order = np.argsort(bucket, kind="stable")
    return order, np.r_[groups_of(bucket[order]), len(bucket)]


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each text with its end, and the number of tokens of each text."""
    words, per_row = hashed_words(texts, lower=True)
    return np.insert(words, np.cumsum(per_row), END), per_row + 1


META = np.dtype([("doc_id", "i8"), ("held_out", "i8"), ("training", "i8"), ("n_tokens", "i8")])
CORPUS = "slice long, trained long, meta binary, tokens binary, words binary, counts binary"
CORPUS_ARROW = pa.schema([
    ("slice", pa.int64()), ("trained", pa.int64()), ("meta", pa.binary()), ("tokens", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()),
])


def cut_corpus(batches):
    """One row per slice: its texts, their tokens as places in its list of words, and the words' counts in training texts."""
    for batch in slices(batches, "text", SLICE):
        rows, ids, held, training = (np.asarray(batch.column(i)) for i in range(4))
        words, per_row = tokens_of(batch.column(4))
        words, at, uses = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-uses, kind="stable")  # small numbers for common words
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        tokens = place[at]
        counts = np.bincount(tokens[np.repeat(training == 1, per_row)], minlength=len(words)).astype(np.int64)
        meta = np.rec.fromarrays([ids, held, training, per_row], dtype=META)
        yield batch_of([(int(rows[0]), int(training.sum()), squeeze(meta.view(np.int64)), squeeze(tokens), squeeze(words[order]), squeeze(counts))], CORPUS_ARROW)


DEALT_WORDS = "bucket int, slice long, words binary, counts binary"
DEALT_WORDS_ARROW = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])


def deal_words(buckets: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                words, counts = expand(batch.column(1)[k].as_buffer(), np.uint64), expand(batch.column(2)[k].as_buffer(), np.int64)
                bucket = word_bucket(words, buckets)
                order, cuts = by_bucket(bucket)
                yield batch_of([
                    (int(bucket[order[a]]), batch.column(0)[k].as_py(), squeeze(words[order[a:b]]), squeeze(counts[order[a:b]]))
                    for a, b in zip(cuts[:-1], cuts[1:])], DEALT_WORDS_ARROW)

    return run


def counted(totals: np.ndarray, most: int | None = None) -> tuple:
    """How many of the totals have each value, as a row of REPLY."""
    values, types = np.unique(totals[(totals > 0) & (totals <= (most or totals.max(initial=0)))], return_counts=True)
    return COUNTED, None, None, squeeze(types.astype(np.int64)), squeeze(values.astype(np.int64))


def total_words(table: pa.Table) -> pa.Table:
    """The counts of a bucket's words over all slices and their ranks by count, for each slice its own, in the order that it sent."""
    sent = [expand(x.as_buffer(), np.uint64) for x in table["words"]]
    words, at = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.bincount(at, gather(table["counts"], np.int64), len(words)).astype(np.int64)
    ranks = np.empty(len(words), np.int64)
    ranks[np.argsort(-totals, kind="stable")] = np.arange(len(words))
    ends = np.cumsum([len(x) for x in sent])
    out = [(WORDS, s, b, squeeze(totals[at[e - len(x):e]]), squeeze(ranks[at[e - len(x):e]])) for s, b, x, e in zip(
        table["slice"].to_pylist(), table["bucket"].to_pylist(), sent, ends)]
    return pa.Table.from_batches([batch_of([*out, counted(totals)], REPLY_ARROW)])


def spread_counts(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(gather(batch.column(i), np.int64)) for i in (1, 0)], names=["count", "types"])


def count_of_counts(replies: DataFrame) -> dict[int, int]:
    rows = replies.where(F.col("kind") == COUNTED).select("counts", "more").mapInArrow(spread_counts, "count long, types long")
    return {r["count"]: r["types"] for r in rows.groupBy("count").agg(F.sum("types").alias("types")).collect()}


@dataclass
class Words:
    """The law of single words: totals, discounts ``d``, and the least count of a word of the vocabulary."""

    total: int
    types: int
    least: int
    rest_total: int
    rest_types: int
    room: int
    unknown: float
    d: np.ndarray

    def known(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (counts >= self.least) | (words == END)  # a text's end is always a word of the model

    def p(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities by count; a count below zero is the class of all words outside the vocabulary."""
        return np.where(counts < 0, self.unknown, discounted(np.maximum(counts, 0), self.d) / self.room)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.types + 1)))

    def within_unknown(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.rest_total + 0.5 * (self.rest_types + 1)))


def law_of_words(of_count: dict[int, int], ends: int, most_words: int | None) -> Words:
    """``ends`` is the count of text ends, which stay words of the model whatever ``most_words`` is."""
    counts = np.array(sorted(of_count, reverse=True), np.int64)
    types = np.array([of_count[c] for c in counts.tolist()], np.int64)
    least = 1
    if most_words is not None and len(counts):
        fits = np.cumsum(types) <= most_words
        least = int(counts[fits][-1]) if fits.any() else int(counts[0]) + 1
    total, kinds, d = int((counts * types).sum()), int(types.sum()), discounts(of_count)
    held, n = counts[counts >= least], types[counts >= least]
    if 0 < ends < least:
        held, n = np.r_[held, ends], np.r_[n, 1]
    share = float((discounted(held, d) * n).sum())
    room = total if total - share > 1e-9 * max(total, 1) else total + 1
    return Words(total, kinds, least, total - int((held * n).sum()), kinds - int(n.sum()), room, max(1 - share / room, 0.0), d)


@dataclass
class Bigrams:
    """The distinct bigrams of a slice, by bucket and numbers of history and word; ``at`` is the bigram of each token."""

    words: np.ndarray
    counts: np.ndarray
    tokens: np.ndarray
    at: np.ndarray
    training: np.ndarray
    bucket: np.ndarray
    cuts: np.ndarray
    history: np.ndarray
    heavy: np.ndarray
    word: np.ndarray
    word_count: np.ndarray
    meta: np.ndarray


def bigrams(law: Words, corpus: pa.Table, answers: pa.Table, buckets: int) -> Bigrams:
    """Of one slice, the same whenever it is called."""
    words, tokens = expand(corpus["words"][0].as_buffer(), np.uint64), expand(corpus["tokens"][0].as_buffer(), np.int32)
    meta = expand(corpus["meta"][0].as_buffer(), np.int64).view(META)
    answers, bucket, n = answers.sort_by("bucket"), word_bucket(words, buckets), len(words)
    order, _ = by_bucket(bucket)
    counts, ranks = np.empty(n, np.int64), np.empty(n, np.int64)
    counts[order], ranks[order] = gather(answers["counts"], np.int64), gather(answers["more"], np.int64)
    number = (ranks * buckets + bucket).astype(np.uint64)
    order = np.argsort(number)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    words, counts, number, tokens = words[order], counts[order], np.r_[number[order], UNKNOWN], place[tokens]
    ids = np.where(law.known(words, counts), np.arange(n), n)[tokens]
    starts = np.cumsum(meta["n_tokens"]) - meta["n_tokens"]
    history = np.empty_like(ids)
    history[1:] = ids[:-1]
    history[starts] = np.flatnonzero(words == END)[0]
    pairs, at = np.unique(history * (n + 1) + ids, return_inverse=True)
    training = np.bincount(at[np.repeat(meta["training"] == 1, meta["n_tokens"])], minlength=len(pairs)).astype(np.int64)
    h, w = np.divmod(pairs, n + 1)
    heavy = (np.r_[counts, law.rest_total] * HEAVY_SHARE > law.total)[h]
    # all bigrams of a history in one bucket, but those of a common history anywhere
    bucket = bucket_of(np.where(heavy, mix(number[h]) ^ second(number[w]), number[h]), buckets)
    order, cuts = by_bucket(bucket)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Bigrams(words, counts, tokens, place[at], training[order], bucket[order], cuts, number[h[order]], heavy[order],
                   number[w[order]], np.r_[counts, -1][w[order]], meta)


DEALT = "bucket int, slice long, histories binary, heavy binary, runs binary, words binary, word_counts binary, counts binary"
DEALT_ARROW = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), *[(c, pa.binary()) for c in (
    "histories", "heavy", "runs", "words", "word_counts", "counts")]])


def deal_bigrams(law: Words, buckets: int):
    def run(corpus: pa.Table, answers: pa.Table) -> pa.Table:
        x, out = bigrams(law, corpus, answers, buckets), []
        for a, b in zip(x.cuts[:-1], x.cuts[1:]):
            starts = groups_of(x.history[a:b])
            out.append((
                int(x.bucket[a]), corpus["slice"][0].as_py(), squeeze(np.diff(x.history[a:b][starts], prepend=np.uint64(0))), squeeze(x.heavy[a:b][starts].astype(np.uint8)),
                squeeze(np.diff(np.r_[starts, b - a])), squeeze(x.word[a:b]), squeeze(x.word_count[a:b]), squeeze(x.training[a:b])))
        return pa.Table.from_batches([batch_of(out, DEALT_ARROW)])

    return run


#: Of a history: its count, how many words follow it 1 to LARGEST_DISCOUNTED times, and the next order's probability of all that do.
SUMS = LARGEST_DISCOUNTED + 2


def total_bigrams(law: Words):
    """Counts of a bucket's bigrams and sums of their histories, for each slice its own, in the order that it sent."""

    def run(table: pa.Table) -> pa.Table:
        sent = [np.cumsum(expand(x.as_buffer(), np.uint64), dtype=np.uint64) for x in table["histories"]]
        sent_words = [expand(x.as_buffer(), np.uint64) for x in table["words"]]
        every = np.concatenate(sent)
        history, word = np.repeat(every, gather(table["runs"], np.int64)), np.concatenate(sent_words)
        order = np.lexsort((word, history))
        history, word = history[order], word[order]
        starts = np.flatnonzero(np.r_[True, (history[1:] != history[:-1]) | (word[1:] != word[:-1])])
        totals = np.add.reduceat(gather(table["counts"], np.int64)[order], starts)
        mine = np.empty(len(order), np.int64)
        mine[order] = np.repeat(totals, np.diff(np.r_[starts, len(order)]))
        lower = np.where(totals > 0, law.p(gather(table["word_counts"], np.int64)[order[starts]]), 0.0)
        history = history[starts]
        starts = groups_of(history)
        history = history[starts]
        sums = np.stack([np.add.reduceat(v, starts).astype(float) for v in (
            totals, *[(totals == r).astype(np.int64) for r in range(1, LARGEST_DISCOUNTED + 1)], lower)])
        out, a = [], 0
        for s, b, h, w in zip(table["slice"].to_pylist(), table["bucket"].to_pylist(), sent, sent_words):
            out.append((BIGRAMS, s, b, squeeze(mine[a:a + len(w)]), squeeze(sums[:, np.searchsorted(history, h)].ravel())))
            a += len(w)
        common = np.unique(every[gather(table["heavy"], np.uint8) == 1])
        out.append((HEAVY, None, None, squeeze(common.view(np.int64)), squeeze(sums[:, np.searchsorted(history, common)].ravel())))
        return pa.Table.from_batches([batch_of([*out, counted(totals, LARGEST_DISCOUNTED + 1)], REPLY_ARROW)])

    return run


def spread_sums(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            sums = expand(batch.column(1)[k].as_buffer(), np.float64).reshape(SUMS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(expand(batch.column(0)[k].as_buffer(), np.int64)), *map(pa.array, sums)],
                                             names=["history", *[f"s{i}" for i in range(SUMS)]])


def heavy_sums(replies: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Common histories, of which there are fewer than HEAVY_SHARE, with their sums over all buckets."""
    names = [f"s{i}" for i in range(SUMS)]
    rows = replies.where(F.col("kind") == HEAVY).select("counts", "more").mapInArrow(spread_sums, "history long, " + ", ".join(f"{n} double" for n in names))
    rows = rows.groupBy("history").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    keys = rows["history"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows[names].to_numpy(float)[order].T


def backoff(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Denominators and logarithms of backoff weights, so that each history's probabilities sum to one.

    A history without discounted counts gets one count more, a history after which every word was seen has no backoff.
    """
    count, lower = sums[0], sums[-1]
    seen = count - sum(sums[r] * (r - discounted(np.int64(r), d)) for r in range(1, LARGEST_DISCOUNTED + 1))
    denominator = np.where(count - seen > 1e-9 * np.maximum(count, 1), count, count + 1)
    left, room = 1 - seen / denominator, 1 - lower
    full = room < 1e-12
    denominator = np.where(full & (seen > 0), seen, denominator)
    with np.errstate(divide="ignore", invalid="ignore"):
        return denominator, np.log10(np.where(full, 0.0, left / room))


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_slice(law: Words, d: np.ndarray, heavy: tuple[np.ndarray, np.ndarray], buckets: int):
    def run(corpus: pa.Table, replies: pa.Table) -> pa.Table:
        x = bigrams(law, corpus, replies.filter(pc.equal(replies["kind"], WORDS)), buckets)
        answers = replies.filter(pc.equal(replies["kind"], BIGRAMS)).sort_by("bucket")
        count = gather(answers["counts"], np.int64)
        sums = np.concatenate([expand(v.as_buffer(), np.float64).reshape(SUMS, -1) for v in answers["more"]], 1)
        starts = np.flatnonzero(np.r_[True, (x.history[1:] != x.history[:-1]) | (x.bucket[1:] != x.bucket[:-1])])
        common = x.heavy[starts]
        sums[:, common] = heavy[1][:, np.searchsorted(heavy[0], x.history[starts][common])]
        denominator, log_weight = (np.repeat(v, np.diff(np.r_[starts, len(count)])) for v in backoff(sums, d))
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(count > 0, np.log10(discounted(count, d) / denominator), log_weight + np.log10(law.p(x.word_count)))
        within = np.where(law.known(x.words, x.counts), 0.0, law.within_unknown(x.counts))
        meta = x.meta
        starts = np.cumsum(meta["n_tokens"]) - meta["n_tokens"]
        return pa.table({
            "doc_id": pa.array(meta["doc_id"], pa.int64()), "held_out": pa.array(meta["held_out"] == 1), "n_tokens": pa.array(meta["n_tokens"], pa.int64()),
            "n_known": pa.array(np.add.reduceat((x.counts > 0).astype(np.int64)[x.tokens], starts)),
            "train_tokens": pa.array(np.full(len(meta), law.total, np.int64)),
            "base_score": pa.array(np.add.reduceat(law.base(x.counts)[x.tokens], starts)),
            "score": pa.array(np.add.reduceat(score[x.at] + within[x.tokens], starts)),
        })

    return run


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; of an empty text for a null id."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5


def katz_scores(documents: DataFrame, training: Column, held_out: Column, most_words: int | None = None) -> DataFrame:
    """Score every text by a model of the texts where ``training`` holds.

    Returns one row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. Only
    ``doc_id``, ``text`` and the columns of the two conditions are read. A null or empty text is one token, its end.
    Repeated rows count and are scored one by one; null ids stay null. An empty table gives an empty result; without
    training texts every word is unknown. The vocabulary is every training word; a caller who gives ``most_words`` gets a
    model of that many of the commonest words (whole classes of equal counts), all others being one class.
    """
    spark = documents.sparkSession
    buckets = bucket_count(spark)
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).cast("long").alias("held_out"), F.coalesce(training, F.lit(False)).cast("long").alias("training"), "text")
    corpus = stored(rows.mapInArrow(cut_corpus, CORPUS), "corpus")
    dealt = corpus.select("slice", "words", "counts").mapInArrow(deal_words(buckets), DEALT_WORDS)
    words = stored_by_kind(dealt.groupBy("bucket").applyInArrow(total_words, REPLY), "words")
    ends = corpus.agg(F.sum("trained")).first()[0] or 0
    law = law_of_words(count_of_counts(words), ends, most_words)
    answers = words.where(F.col("kind") == WORDS)
    texts = corpus.select("slice", "meta", "tokens", "words")
    pairs = texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(deal_bigrams(law, buckets), DEALT)
    pairs = stored_by_kind(pairs.groupBy("bucket").applyInArrow(total_bigrams(law), REPLY), "bigrams")
    answers = answers.union(pairs.where(F.col("kind") == BIGRAMS))
    score = score_slice(law, discounts(count_of_counts(pairs)), heavy_sums(pairs), buckets)
    scored = texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(score, RESULT)
    return scored.withColumn("doc_id", F.expr(f"nullif(doc_id, {NO_ID})"))


def stored_by_kind(frame: DataFrame, name: str) -> DataFrame:
    """Replies in the shared folder, partitioned by kind."""
    path = fresh_path(frame.sparkSession, f"llm-{name}")
    frame.write.partitionBy("kind").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path).select(frame.columns)
