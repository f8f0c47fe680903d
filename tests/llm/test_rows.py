"""Personal data, sharding, packing, pieces and toxicity on small fixtures."""

import math
import os
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartouche.llm import packing, personal, pieces, sharding, toxicity
from cartouche.llm.queries import TOKENIZERS

BPE, PIECES = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
PATTERNS = {  # fixed values: the base grammar
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"ip": lambda: all(int(x) <= 255 for x in match.split(".")), "card": lambda: 14 <= len(digits) <= 19 and personal.luhn(digits),
            "phone": lambda: 10 <= len(digits) <= 15, "email": lambda: True}[kind]()


def test_spans_are_those_of_the_grammar():
    rng, anchors, found = random.Random(2), personal.automaton(), 0
    alphabets = ["a.b@-%é", "0123456789.", "0123456789 -", "+0123456789 ().-", "@@..a1", "4111 1111 1111 1111 "]
    whole = ["4111 1111 1111 1111", "x.y@a-b.co.uk", "+1 (555) 010-9999", " 1.2.3.4.5.6.7.8", "000255.001.1.1", "255.256.1.1.9"]
    for i in range(20_000):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60)))
        text = text[:20] + rng.choice(whole) + text[20:] if i % 3 == 0 else text
        want = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]
        got = [s for s in personal.ordered_spans(text, anchors) if s[0] in personal.BASE]
        assert got == sorted(want, key=lambda s: (s[1], personal.KINDS.index(s[0]))), text
        found += len(want)
    assert found > 5000


def test_personal_rows(spark):
    rows = [(1, "mail a@b.co, see https://x.y/z. iban: DE89370400440532013000"), (2, None), (3, ""), (None, "+1 555 010 9999"), (1, "mail a@b.co")]
    docs = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, spans string")
    got = {(r.doc_id, r.text): r for r in personal.find_personal(docs).collect()}
    assert got[1, rows[0][1]].spans == "email:5:11,url:17:30,account:38:60"
    assert [got[r].n_email + got[r].n_phone for r in rows] == [1, 0, 0, 1, 1] and got[2, None].spans == ""
    masked = [r.text for r in personal.mask_personal(docs.orderBy("doc_id", "text")).collect()]
    assert set(masked) == {"mail <EMAIL>, see <URL>. iban: <ACCOUNT>", "mail <EMAIL>", "<PHONE>", None, ""}
    assert personal.find_personal(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [0, 1, 15, 1000])
def test_shards(spark, monkeypatch, rows):
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 50)
    frame = spark.range(rows).select((F.col("id") % 900).alias("doc_id"), F.lit("x").alias("shard"))
    one, two = ([tuple(r) for r in sharding.shard_rows(f, ["doc_id"]).collect()] for f in (frame, frame.repartition(5)))
    assert sorted(one) == sorted(two)  # however the rows are partitioned
    by_shard = {}
    for doc_id, shard, slot in one:
        by_shard.setdefault(shard, []).append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(by_shard.get(k, [])) for k in range(16)]
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1


def matrix(cells, seed):
    return sharding.communication_matrix(np.array(cells), sharding.exact_sizes(sum(cells), 4), np.random.default_rng(seed))


def test_shards_are_uniform():
    """Counts of the communication matrix follow the hypergeometric law: mean and variance of one entry."""
    drawn = np.array([matrix([30, 50, 20], s)[0, 0] for s in range(4000)])
    assert abs(drawn.mean() - 7.5) < 0.12 and abs(drawn.var() - 30 * 0.25 * 0.75 * 70 / 99) < 0.4


def test_split_groups_keep_the_law():
    """A group's draw split among its cells is the draw of the cells: every entry's mean and variance, and all sums."""
    cells, drawn = np.array([4, 9, 7, 10]), []
    for seed in range(3000):
        group = sharding.communication_matrix(np.array([cells[:2].sum(), cells[2:].sum()]), sharding.exact_sizes(30, 3), np.random.default_rng(seed))
        parts = [sharding.communication_matrix(cells[2 * g:2 * g + 2], group[g], np.random.default_rng([seed, g])) for g in (0, 1)]
        drawn.append(np.concatenate(parts))
        assert (drawn[-1].sum(0) == 10).all() and (drawn[-1].sum(1) == cells).all()
    mean, var = np.mean(drawn, 0), np.var(drawn, 0)
    want = cells[:, None] / 3 * np.ones(3)
    assert np.abs(mean - want).max() < 0.15 and np.abs(var - want * 2 / 3 * ((30 - cells) / 29)[:, None]).max() < 0.2


@pytest.mark.parametrize("good, bad, n", [(12, 30, 9), (5, 4, 7), (40, 3, 20), (1, 50, 25)])
def test_large_draws_keep_the_law(monkeypatch, good, bad, n):
    monkeypatch.setattr(sharding, "LARGEST", 2)
    rng = np.random.default_rng(3)
    seen = np.bincount([sharding.hypergeometric(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1) / 20_000
    law = np.array([math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) if k <= good and n - k <= bad else 0 for k in range(n + 1)])
    assert np.abs(seen - law).max() < 0.02


def test_matrix_of_many_rows():
    """10^11 rows in all groups, drawn on the driver in seconds."""
    cells = np.full(sharding.GROUPS, 10**11 // sharding.GROUPS) + np.arange(sharding.GROUPS)
    begun = time.time()
    drawn = sharding.communication_matrix(cells, sharding.exact_sizes(int(cells.sum()), 16), np.random.default_rng(1))
    assert time.time() - begun < 10 and (drawn.sum(1) == cells).all() and np.ptp(drawn.sum(0)) <= 1
    assert np.abs(drawn / cells[:, None] - 1 / 16).max() < 6 * (1 / 16 / cells.min()) ** 0.5


def test_slots_follow_no_order(spark):
    """A row's place says nothing about its id, its neighbours, or a text that many rows share."""
    rows = sharding.shard_rows(spark.range(16_000).select("id", (F.col("id") % 4).alias("text")), ["id"]).orderBy("shard", "slot").toPandas()
    at = rows["id"].to_numpy().astype(float)
    assert abs(np.corrcoef(at, rows["shard"] * 1000 + rows["slot"])[0, 1]) < 0.04 and abs(np.corrcoef(at[1:], at[:-1])[0, 1]) < 0.04
    assert abs(np.corrcoef(at, rows["slot"])[0, 1]) < 0.04
    held = rows.groupby(["text", "shard"]).size()
    assert len(held) == 64 and ((held - 250) ** 2 / 250).sum() < 90  # chi-squared, 45 degrees of freedom


@pytest.mark.parametrize("histogram", [{10: 10**6, 7: 3}, {600: 1000, 500: 10}, {1024: 5}, {i: 10**9 // i for i in range(1, 1025)}, {1: 1}, {}])
def test_plans_pack_every_piece(histogram):
    plan = packing.make_plan(histogram, 1024)
    used = np.zeros(1025, np.int64)
    ends = {}
    for length, n in histogram.items():
        numbers = np.arange(min(n, 2000))
        sequence, offset = plan.place(np.full(len(numbers), length), numbers)
        used[length] += len(set(zip(sequence.tolist(), offset.tolist())))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            ends[s, o] = max(o + length, ends.get((s, o), 0))
        assert used[length] == len(numbers) and sequence.max(initial=-1) < plan.sequences
    assert max(ends.values(), default=0) <= 1024
    total = sum(k * v for k, v in histogram.items())
    # the first fits eleven to a sequence at best less what is left, the second never pairs its larger pieces
    assert plan.sequences <= {600: 1005}.get(next(iter(histogram), 0), max(1.005 * -(-total // 1024), 1)) + (not histogram) * 0


def test_packing(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(packing, "ROWS_PER_CELL", 40)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(5000, None), (5001, ""), (None, "x"), (5002, "a b " * 5000), (5001, "")], "doc_id long, text string")
    rows = packing.pack_documents(docs.union(odd), BPE, with_ids=True).toPandas()
    encoder = packing.Encoder(BPE)
    for doc_id, text in [(5000, ""), (5002, "a b " * 5000), *[tuple(r) for r in docs.collect()]]:
        mine = rows[rows.doc_id == doc_id].sort_values("piece")
        ids = np.frombuffer(b"".join(mine.ids), "<u4").tolist()
        assert ids == [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert mine.start.tolist() == (mine.length.cumsum() - mine.length).tolist() and (mine.length[1:] == 1024).all()
    assert (rows.ids_crc32 == rows.ids.map(zlib.crc32)).all()
    rows = rows.sort_values(["sequence_id", "offset"])
    groups = rows.groupby("sequence_id").length
    assert (rows.offset == groups.cumsum() - rows.length).all() and groups.sum().max() <= 1024
    assert groups.ngroups <= 1.02 * -(-rows.length.sum() // 1024) + 1
    assert packing.pack_documents(docs.limit(0), BPE).count() == 0


def test_segments_do_not_change_ids():
    encoder, rng = packing.Encoder(BPE), random.Random(1)
    texts = ["".join(rng.choice(["a", " ", "  ", "é", "'s", "\n", "1", "日", " ", "　", "B", "-", "<|endoftext|>", "\u0085"]) for _ in range(30)) for _ in range(2000)]
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.encode(pa.array([*texts, None, ""]))
        cut = np.r_[0, np.cumsum(counts)]
        for i, text in enumerate(texts):
            assert ids[cut[i]:cut[i + 1]].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_joined_segments_are_cut_by_their_bytes():
    encoder, rng = packing.Encoder(BPE), random.Random(2)
    segments = [" " + "".join(rng.choice(["a", "é", "'s", "1", "日", "x", "-", "\n", "  "]) for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    segments = [x.encode() for x in segments if packing.SEGMENT_LEAD[x.encode()[1]]]
    ids, counts = encoder.ids_of(segments)
    for broken in (False, True):  # widths that do not add up: each segment by itself
        encoder.width += broken
        mine, mine_counts = encoder.ids_of_segments(segments)
        assert mine.tolist() == ids.tolist() and mine_counts.tolist() == counts.tolist()


def test_pieces_are_the_librarys(spark, sf_dir):
    import sentencepiece

    model, mine, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Pieces(PIECES), random.Random(1)
    texts = ["", "  a  b", " ", "\n x", "a ", "日本語  日", "😀⑨ ⑨", " " * 40 + "x" + " " * 17, "  ⑨", "   日", "▁▁x", "x" * 3000]
    texts += ["".join(rng.choice("ab theroning  \n\té日①<s>▁0") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for _ in range(2):
        ids, counts = mine.encode(texts)
        cut = np.r_[0, np.cumsum(counts)]
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [model.encode(t) for t in texts]
        assert mine.decode(ids, counts) == [t.replace("▁", " ") for t in texts]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(9000, None), (9001, "")], "doc_id long, text string")).withColumn("ids", F.lit("old"))
    out = pieces.decode_ids(pieces.encode_texts(docs, PIECES), PIECES)
    assert out.where("NOT decoded <=> text OR (ids IS NULL) <> (text IS NULL)").count() == 0 and out.count() == docs.count()
    assert all(r.ids == model.encode(r.text) for r in out.where("text IS NOT NULL").collect())
    once = pieces.round_trip(docs, PIECES)
    assert once.columns == ["doc_id", "ids", "decoded"] and once.exceptAll(out.drop("text")).count() == 0 and once.count() == docs.count()
    assert pieces.encode_texts(docs.limit(0), PIECES).count() == pieces.round_trip(docs.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("most", [4, 60, 1 << 20])
def test_words_learned_together(monkeypatch, most):
    """Words prepared for several parts at once, also while the memory of words overflows, give the library's ids."""
    import sentencepiece

    monkeypatch.setattr(pieces, "MOST_CACHED", most)
    monkeypatch.setattr(pieces, "CELLS_AT_ONCE", 7)
    model, mine, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Pieces(PIECES), random.Random(5)
    words = ["", "a", "the", "unsettled", "\u00e9t\u00e9", "\u6f22\u5b57", "x" * 40, "\U0001f600", "ab\n", "  ", "1234567"] + ["".join(rng.choices("abcde", k=6)) for _ in range(60)]
    for _ in range(3):
        parts = [[" ".join(rng.choices(words, k=rng.randrange(20))) for _ in range(rng.randrange(4))] for _ in range(5)]
        mine.prepare(parts)
        for texts in parts:
            ids, counts = mine.encode(texts)
            cut = np.r_[0, np.cumsum(counts)]
            assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [model.encode(t) for t in texts]


def test_toxicity(spark):
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w = [rng.choice(plain) for _ in range(rng.choice([5, 40, 200]))]
        bad = i % 8 == 0
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["nasty", "nastily", "vile"]))
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(bad)))
    labels += [(3, None), (5000, 1), (None, 1), (4, 7)]
    rows += [(2000, None, "x"), (2001, "", "x"), (2002, " \n", "x"), rows[0], (2003, "word1 " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.train_toxicity(docs, marks, ~held)
    out = toxicity.score_toxicity(docs, model).withColumn("held", held).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    tested = [r for r in out if r.held and r.doc_id < 1200]
    assert sum(r.predicted == int(r.doc_id % 8 == 0) for r in tested) >= 0.98 * len(tested)
    assert all(r.predicted == 0 for r in out if r.doc_id >= 2000)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    one = toxicity.train_toxicity(docs, marks.where("toxic = 0"), ~held)
    assert {r.score for r in toxicity.score_toxicity(docs.limit(5), one).collect()} == {0.0}


def test_toxicity_models_are_kneser_ney(spark, monkeypatch):
    """Every probability equals a plain recursion over counted tuples, and each class and history sums to one."""
    monkeypatch.setattr(toxicity, "LEAST_COUNT", 3)
    monkeypatch.setattr(toxicity, "LEAST_PAIRS", 4)
    rng, vocabulary = random.Random(8), ["abcd", "abcde", "abcdf", "xy", "xyz", "pqrst", "pqrsu", "lone", "\u00e9t\u00e9s", "\u00e9t\u00e9si"]
    texts = [(" ".join(rng.choices(vocabulary, weights=range(1, 11), k=rng.randrange(9))), int(rng.random() < 0.4)) for _ in range(60)]
    texts += [("onlytoxic here", 1), ("onlyplain here", 0), ("", 1)]
    model = toxicity.fit_counts(spark.createDataFrame(texts, "text string, toxic int"))

    pairs = Counter()
    for text, toxic in texts:
        words = text.split()
        pairs.update((1 - toxic, h, w) for h, w in zip([None, *words], words))  # class 0 is the toxic one
    words, stems, firsts = Counter(), Counter(), Counter()
    for (c, h, w), n in pairs.items():
        words[c, w] += 1
        stems[c, w[:4]] += 1
        firsts[c, h] += n

    def discount(counts, c):
        held = Counter(n for key, n in counts.items() if key[0] == c)
        return held[1] / (held[1] + 2 * held[2]) if held[1] else 0.5

    def both(counts, *key):
        return counts[0, *key] + counts[1, *key]

    def own(counts, least, c, *key):
        return max(counts[c, *key] - discount(counts, c), 0) if both(counts, *key) >= least else 0

    all_words, all_stems = {w for _, w in words}, {s for _, s in stems}
    kept_words, kept_stems = {w for w in all_words if both(words, w) >= 3}, {s for s in all_stems if both(stems, s) >= 3}
    everything = sum(stems.values())

    def probability(c, h, w):
        s = w[:4]
        total = sum(n for (k, _), n in stems.items() if k == c)
        mass = both(stems, s) if s in kept_stems else everything - sum(both(stems, x) for x in kept_stems)
        p = (own(stems, 3, c, s) + (total - sum(own(stems, 3, c, x) for x in kept_stems)) * (mass + 1) / (everything + len(kept_stems) + 1)) / total
        if s in kept_stems:
            inner = [x for x in kept_words if x[:4] == s]
            mass = both(words, w) if w in kept_words else both(stems, s) - sum(both(words, x) for x in inner)
            share = (mass + 0.5) / (both(stems, s) + 0.5 * (len(inner) + 1))
            n = stems[c, s]
            p *= (own(words, 3, c, w) + (n - sum(own(words, 3, c, x) for x in inner)) * share) / n if n else share
        n = firsts[c, h]
        return (own(pairs, 4, c, h, w) + (n - sum(own(pairs, 4, c, h, x) for x in all_words)) * p) / n if n else p

    def scored(text):
        found, starts, history, _ = toxicity.expressions(pa.array([text]))
        return np.exp(model.logs(found, starts, history))

    for text in {t for t, _ in texts if t} | {"lone never abcdnever xy"}:
        tokens = text.split()
        want = [[probability(c, h, w) for h, w in zip([None, *tokens], tokens)] for c in (0, 1)]
        assert np.allclose(scored(text), want, rtol=1e-9)
    slots = sorted(kept_words) + [s.ljust(4, "~") + "~never" if len(s) == 4 else None for s in sorted(kept_stems)] + ["never"]
    for h in [*sorted(all_words), "never"]:
        for c in (0, 1):
            # a beginning shorter than STEM is one word, whose other words cannot occur; their share is counted by hand
            total = sum(scored(f"{h} {w}")[c][1] for w in slots if w)
            total += sum(own(pairs, 4, c, h, x) / firsts[c, h] for x in all_words - kept_words if firsts[c, h])
            short = [s for s in kept_stems if len(s) < 4]
            left = (firsts[c, h] - sum(own(pairs, 4, c, h, x) for x in all_words)) / firsts[c, h] if firsts[c, h] else 1
            for s in short:
                top = scored(f"never {s}")[c][1]
                n, mass = stems[c, s], both(stems, s)
                rest = 0.5 / (mass + 1)
                inside = (own(words, 3, c, s) + (n - own(words, 3, c, s)) * (mass + 0.5) / (mass + 1)) / n if n else (mass + 0.5) / (mass + 1)
                total += left * top / inside * ((n - own(words, 3, c, s)) * rest / n if n else rest)
            assert abs(total - 1) < 1e-9


def test_tokenizer_files_are_a_parameter():
    assert os.path.exists(BPE) and os.path.exists(PIECES)
