"""Toxicity by class-conditional Kneser-Ney models.

Models of toxic and of ordinary texts discount what a class has counted and back off: from bigrams to words, which count
the distinct words that they follow; from words to their beginnings (the first ``STEM`` characters, as inflected and
compound words share them), which count distinct bigrams; and from these to counts that both classes share. Each class and
history has a distribution that sums to one. N-grams that both classes together hold fewer than ``LEAST_COUNT`` times
(bigrams: ``LEAST_PAIRS``) leave their counts to what they back off to, so a rare expression costs both classes nearly the same. A text's score is the
logistic of the length-normalised log-likelihood ratio of the whole text and that of its most toxic run of ``RUN``
words, fitted on labelled texts that the counts have not seen.

Fitting reads a bounded sample of labelled rows (``most_rows`` of each class for the counts, twice as many in all for the
logistic), so the model is bounded by their texts. Scoring reads every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.llm.graph import stored
from cartouche.llm.words import LOWER, give_back, mix, slices, text_buffers, word_hashes, word_spans

MOST_ROWS = 4096
LEAST_COUNT = 5  # of both classes together; words and beginnings
LEAST_PAIRS = 30  # bigrams; this and RUN have the least log loss on labelled rows outside the counts
RUN = 1
STEM = 4
BEGIN = np.uint64(0x1F123BB5159A55E5)
SLICE = 512 << 10  # about twenty arrays of eight bytes a word live at once


def expressions(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, beginning, history and number of words of each text."""
    data, offsets = text_buffers(texts)
    data = LOWER[data]
    starts, ends, per_row = word_spans(data, offsets)
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(heads, starts) + STEM
    stop = np.minimum(np.r_[heads, np.full(STEM, len(data))][at], ends) if len(starts) else ends
    words, stems = word_hashes(data, starts, ends), word_hashes(data, starts, stop)
    history = np.empty_like(words)
    history[1:] = words[:-1]
    some = per_row > 0
    history[(np.cumsum(per_row) - per_row)[some]] = BEGIN
    return words, stems, history, per_row


def pair_key(history: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(mix(history) + words)


def count_pairs(batches):
    """``history, word, stem, t, o``: toxic and ordinary counts of each slice."""
    for batch in slices(batches, "text", SLICE):
        words, stems, history, per_row = expressions(batch.column(0))
        if not len(words):
            continue
        toxic = np.repeat(np.asarray(batch.column(1)) == 1, per_row)
        order = np.lexsort((words, history))
        h, w, t = history[order], words[order], toxic[order]
        starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
        both = np.diff(np.r_[starts, len(h)])
        bad = np.add.reduceat(t.astype(np.int64), starts)
        ids = [pa.array(x.view(np.int64)) for x in (h[starts], w[starts], stems[order][starts])]
        yield pa.RecordBatch.from_arrays([*ids, pa.array(bad), pa.array(both - bad)], names=["history", "word", "stem", "t", "o"])
    give_back()


@dataclass
class Level:
    """N-grams of one kind by sorted key, and one more for all others. ``own`` is what they keep of their own discounted
    counts, ``left`` what goes on to the words after or within them, each a share and by class (0 toxic, 1 ordinary)."""

    keys: np.ndarray
    own: np.ndarray | None = None
    left: np.ndarray | None = None
    pooled: np.ndarray | None = None


@dataclass
class KneserNey:
    stems: Level
    words: Level
    pairs: Level
    histories: Level
    spread: np.ndarray  # by class, the share of the stems' discounts
    words_rest: np.ndarray  # by beginning, the pooled share of all its words outside the model

    def logs(self, words: np.ndarray, stems: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each word after its history in each class.

        A word outside the model stands for all such words of its beginning, a beginning outside it for all such words.
        """
        s, w, h = find(self.stems.keys, stems), find(self.words.keys, words), find(self.histories.keys, history)
        pair = find(self.pairs.keys, pair_key(history, words))
        within = np.where(w < len(self.words.keys), self.words.pooled[w], self.words_rest[s])
        logs = []
        for c in (0, 1):
            p = self.stems.own[c][s] + self.spread[c] * self.stems.pooled[s]
            p = p * (self.words.own[c][w] + self.stems.left[c][s] * within)
            logs.append(np.log(np.maximum(self.pairs.own[c][pair] + self.histories.left[c][h] * p, 1e-300)))
        return logs[0], logs[1]

    def ratios(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratio (toxic to ordinary) of each word, and the number of words of each text."""
        words, stems, history, per_row = expressions(texts)
        toxic, ordinary = self.logs(words, stems, history)
        return toxic - ordinary, per_row


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each key, or the position after the last."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, len(keys))


def text_features(ratio: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Mean ratio of each text, and the largest mean of a run of RUN words (of the whole text if it is shorter)."""
    sums = np.r_[0.0, np.cumsum(ratio)]
    first = np.cumsum(per_row) - per_row
    mean = (sums[first + per_row] - sums[first]) / np.maximum(per_row, 1)
    best = mean.copy()
    counts = np.maximum(per_row - RUN + 1, 0)
    long = counts > 0
    if long.any():
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        best[long] = np.maximum.reduceat((sums[at + RUN] - sums[at]) / RUN, (np.cumsum(counts) - counts)[long])
    return np.stack([mean, best], 1)


def discounts(table: DataFrame) -> np.ndarray:
    """By class, n1 / (n1 + 2 n2) of a count table with columns ``t, o``; a half where nothing is counted once."""
    row = table.agg(*[F.count_if(F.col(c) == n) for c in ("t", "o") for n in (1, 2)]).first()
    return np.array([once / (once + 2 * twice) if once else 0.5 for once, twice in (row[0:2], row[2:4])])


def kept_counts(table: DataFrame, discount: np.ndarray, least: int) -> DataFrame:
    """With ``kept``, and with the discounted counts ``dt, do`` of n-grams that the model keeps, zero for others."""
    kept = F.col("t") + F.col("o") >= least
    less = [F.when(kept, F.greatest(F.col(c) - F.lit(float(d)), F.lit(0.0))).otherwise(0.0).alias(f"d{c}") for c, d in zip("to", discount)]
    return table.select("*", kept.alias("kept"), *less)


def sorted_rows(table: DataFrame, key: list[str]):
    """The rows on the driver by key, and the keys."""
    rows = table.toPandas()
    ids = [rows[k].to_numpy(np.int64).view(np.uint64) for k in key]
    keys = pair_key(*ids) if len(ids) == 2 else ids[0]
    order = np.argsort(keys)
    return keys[order], rows.iloc[order]


def by_class(rows, names: list[str]) -> np.ndarray:
    """Two columns with a zero at their ends, for keys outside the model."""
    return np.stack([np.r_[rows[n].to_numpy(float), 0.0] for n in names])


def shares(part: np.ndarray, whole: np.ndarray, none: float) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), none)


def fit_counts(texts: DataFrame) -> KneserNey:
    """Count in Spark; only n-grams that the model keeps leave it."""
    both = [F.sum("t").alias("t"), F.sum("o").alias("o")]
    counted = texts.select("text", "toxic").mapInArrow(count_pairs, "history long, word long, stem long, t long, o long")
    pairs = stored(counted.groupBy("history", "word", "stem").agg(*both), "toxic-pairs")
    follows = [F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o")]  # distinct histories
    words = stored(pairs.groupBy("word", "stem").agg(*follows), "toxic-words")
    stems = stored(words.groupBy("stem").agg(*both), "toxic-stems")
    pairs, words, stems = [kept_counts(x, discounts(x), n) for x, n in ((pairs, LEAST_PAIRS), (words, LEAST_COUNT), (stems, LEAST_COUNT))]

    below = [*both, F.sum("dt").alias("dt"), F.sum("do").alias("do"), F.count_if("kept").alias("n"), F.sum(F.when(F.col("kept"), F.col("t") + F.col("o")).otherwise(0)).alias("held")]
    pair_keys, pair = sorted_rows(pairs.where("kept").select("history", "word", "dt", "do"), ["history", "word"])
    history_keys, history = sorted_rows(pairs.groupBy("history").agg(*below).where("n > 0"), ["history"])
    word_keys, word = sorted_rows(words.where("kept").select("word", "stem", "t", "o", "dt", "do"), ["word"])
    inner = words.groupBy("stem").agg(*[x.alias(f"w_{n}") for x, n in zip(below, ("t", "o", "dt", "do", "n", "held"))])
    stem_keys, stem = sorted_rows(stems.where("kept").join(inner, "stem"), ["stem"])
    every = stems.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("t", "o", "dt", "do")], F.count_if("kept"), F.coalesce(F.sum(F.when(F.col("kept"), F.col("t") + F.col("o"))), F.lit(0))).first()

    totals = by_class(history, ["t", "o"])
    at = find(history_keys, pair["history"].to_numpy(np.int64).view(np.uint64))
    pairs_of = Level(pair_keys, shares(by_class(pair, ["dt", "do"]), np.c_[totals[:, at], [0, 0]], 0.0))
    histories_of = Level(history_keys, left=shares(totals - by_class(history, ["dt", "do"]), totals, 1.0))

    totals, sizes = by_class(stem, ["w_t", "w_o"]), by_class(stem, ["w_n", "w_held"])
    at = find(stem_keys, word["stem"].to_numpy(np.int64).view(np.uint64))
    within = totals.sum(0) + 0.5 * (sizes[0] + 1)  # half a count for each word and for all others
    words_of = Level(word_keys, shares(by_class(word, ["dt", "do"]), np.c_[totals[:, at], [0, 0]], 0.0),
                     pooled=(by_class(word, ["t", "o"]).sum(0) + 0.5) / np.r_[within[at], 1.0])
    sums = np.array(every[:4], float)
    all_counts = sums[:2].sum() + every[4] + 1
    pooled = (by_class(stem, ["t", "o"]).sum(0) + 1) / all_counts
    pooled[-1] = (sums[:2].sum() - every[5] + 1) / all_counts
    whole = np.maximum(sums[:2], 1)
    stems_of = Level(stem_keys, by_class(stem, ["dt", "do"]) / whole[:, None],
                     shares(totals - by_class(stem, ["w_dt", "w_do"]), totals, 1.0), pooled)
    spread = np.where(sums[:2] > 0, (sums[:2] - sums[2:4]) / whole, 1.0)
    return KneserNey(stems_of, words_of, pairs_of, histories_of, spread, (totals.sum(0) - sizes[1] + 0.5) / within)


def fit_logistic(x: np.ndarray, y: np.ndarray, strength: float = 1e-2) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic regression on standardised features, by Newton's method."""
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.c_[(x - centre) / scale, np.ones(len(x))]
    ridge = strength * len(x) / 100 * np.diag([*([1.0] * x.shape[1]), 0.0])
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(beta)), z.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    weights = beta[:-1] / scale
    return np.r_[weights, beta[-1] - weights @ centre]


@dataclass
class Toxicity:
    model: KneserNey | None
    weights: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.model is None:
            return np.full(len(texts), self.weights[-1])
        x = text_features(*self.model.ratios(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def features_of(shared):
    def run(batches):
        for batch in slices(batches, "text", SLICE):
            x = text_features(*shared.value.ratios(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column(1)], names=["mean", "best", "toxic"])
        give_back()

    return run


def train_toxicity(documents: DataFrame, labels: DataFrame, training: Column, most_rows: int = MOST_ROWS) -> Toxicity:
    """Fit on labelled documents where ``training`` (a condition on ``doc_id``) holds.

    Labels other than 0 and 1 are left out; a document labelled twice is toxic if one label says so. Every fourth
    document by a hash of its id calibrates, the others count. With labels of one class only, every score is that class.
    """
    spark = documents.sparkSession
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(training).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    dice = F.xxhash64("doc_id", F.lit(17))
    marks = stored(marks.withColumn("fold", (F.pmod(dice, F.lit(4)) == 0).cast("int")).withColumn(
        "u", F.pmod(F.shiftright(dice, 2), F.lit(1_000_003)) / 1_000_003), "toxic-labels")
    counts = {(r["fold"], r["toxic"]): r["count"] for r in marks.groupBy("fold", "toxic").count().collect()}
    toxic, ordinary = (sum(n for (_, t), n in counts.items() if t == k) for k in (1, 0))
    if not toxic or not ordinary:
        return Toxicity(None, np.array([float(toxic > 0)]))
    calibrate = sum(n for (f, _), n in counts.items() if f == 1)
    share = F.lit(2.0 * most_rows / max(calibrate, 1))
    for k in (0, 1):
        share = F.when((F.col("fold") == 0) & (F.col("toxic") == k), most_rows / max(counts.get((0, k), 0), 1)).otherwise(share)
    sample = F.broadcast(marks.where(F.col("u") < share).select("doc_id", "toxic", "fold"))  # four times most_rows at most, on average
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id").select("text", "toxic", "fold")
    model = fit_counts(texts.where("fold = 0"))
    shared = spark.sparkContext.broadcast(model)
    seen = texts.where("fold = 1").select("text", "toxic").mapInArrow(features_of(shared), "mean double, best double, toxic int").toPandas()
    if seen["toxic"].nunique() < 2:  # too few labels to calibrate: toxic where the likelier
        return Toxicity(model, np.array([4.0, 4.0, 0.0]))
    return Toxicity(model, fit_logistic(seen[["mean", "best"]].to_numpy(), seen["toxic"].to_numpy(float)))


def score_toxicity(documents: DataFrame, model: Toxicity) -> DataFrame:
    """All columns of ``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5).

    Input columns of these names are replaced. Only ``text`` is an input of the score; null, empty and blank texts have
    no word and get the score of no evidence. Repeated rows get equal scores. An empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    own = [c for c in documents.columns if c not in ("score", "predicted")]
    documents = documents.select([f"`{c}`" for c in own])
    at = own.index("text")

    def run(batches):
        for batch in slices(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(batch.column(at)))], names=[*own, "score"])
        give_back()

    schema = T.StructType([*documents.schema.fields, T.StructField("score", T.DoubleType())])
    return documents.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
