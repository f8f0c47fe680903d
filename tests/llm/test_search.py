"""Conversation repair, lexical search and graph search on small fixtures, against brute force."""

import hashlib
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartouche.llm import hnsw, lexical, repair

ROLES = {"s": "system", "u": "user", "a": "assistant", "t": "tool", "v": "usher", "": ""}
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


# --- repair --------------------------------------------------------------------


def cheapest(rows):
    """Least (cost, edits) of rows ``(initial, fault)``, from the end backwards."""
    after = {0: "u", 1: "u", 2: "a", 3: "u"}
    state_of = {"s": 1, "u": 2, "a": 3}

    @lru_cache(None)
    def rest(i, state, inserted):
        options = [(0, "")] if i == len(rows) and state in (0, 3) else []
        if inserted < 3:
            cost, edits = rest(i, state_of[after[state]], inserted + 1)
            options.append((cost + 2, "I" + edits))
        if i < len(rows):
            initial, fault = rows[i]
            cost, edits = rest(i + 1, state, 0)
            options.append((cost + 3, "D" + edits))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if initial == "s" and state == 0 or initial == after[state]:
                    cost, edits = rest(i + 1, state_of[initial], 0)
                    options.append((cost + extra, "K" + edits))
                cost, edits = rest(i + 1, state_of[after[state]], 0)
                options.append((cost + 2 + extra, "R" + edits))
        return min(options, default=(10 ** 9, ""))

    return rest(0, 0, 0)


def walk(rows):
    out, most = [], 0
    engine = repair.Repair(lambda letter, turn, role, text: out.append((letter, turn, role, text)))
    for i, (initial, fault) in enumerate(rows):
        engine.add(initial, fault, (i, ROLES.get(initial, initial), f"t{i}"))
        most = max(most, engine.unsettled)
    return engine.finish(), out, most


def test_edits_are_the_cheapest_and_least():
    rng = random.Random(3)
    for _ in range(6000):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.choice([None, None, None, "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(11))]
        cost, out, _ = walk(rows)
        edits = "".join(e[0] for e in out)
        assert (cost, edits) == cheapest(tuple(rows)), rows
        written = "".join(e[2][0] for e in out if e[0] != "D")
        assert written == "" or written.lstrip("s").replace("ua", "") == "" and not written.startswith("ss")
        assert [e[1] for e in out if e[0] != "I"] == list(range(len(rows)))


def test_long_conversations_settle_as_they_come():
    rows = [("u", None), ("a", None)] * 20_000
    for i in range(0, 40_000, 7):
        rows[i] = (rows[i][0], "blank" if i % 2 else "truncated")
    cost, out, most = walk(rows)
    assert most < 40 and len([e for e in out if e[0] != "I"]) == 40_000
    assert walk([("u", "blank")] * 5000)[2] < 10
    # open until the end: an odd number of turns deletes the first, an even one relabels them all
    assert ["".join(e[0] for e in walk([("t", None)] * n)[1]) for n in (501, 500)] == ["D" + "R" * 500, "R" * 500]


def brute_conversation(rows):
    """Contract columns of damaged rows ``(turn, role, text)``."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marks = set(), []
    for turn, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        marks.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    cost, audit = cheapest(tuple((r[1][:1], m) for r, m in zip(rows, marks)))
    lines, at, last = [], iter(rows), ""
    for letter in audit:
        row = None if letter == "I" else next(at)
        if letter != "D":
            role = row[1] if letter == "K" else "assistant" if last == "u" else "user"
            lines.append(f"{role}:{row[2] if row else ''}")
            last = role[0]
    turns = {r[0] for r in rows} - {None}
    counts = Counter(marks)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            SHA("\n".join(lines)))


@pytest.fixture(scope="module")
def odd_conversations(spark):
    rng = random.Random(8)
    texts = ["fine.", "Well!", "", " \t", "cut off", "why?", None, "déjà.", "long " * 4000 + ".", "e. "]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice([*ROLES.values(), None]), rng.choice(texts)) for c in [*range(60), None] for _ in range(rng.randrange(1, 7))]
    rows += rows[:20]
    return spark.createDataFrame([(*r, "old") for r in rows], "conv_id long, turn int, role string, text string, audit string"), rows


def test_conversations(odd_conversations):
    frame, rows = odd_conversations
    got = {r[0]: tuple(r)[1:] for r in repair.audit_conversations(frame.repartition(5)).collect()}
    want = {}
    for conv_id, turn, role, text in rows:
        want.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {c: brute_conversation(r) for c, r in want.items()}
    edits = repair.repair_conversations(frame).collect()
    for conv_id, summary in got.items():
        mine = sorted((e for e in edits if e.conv_id == conv_id), key=lambda e: e.step)
        assert "".join(e.edit for e in mine) == summary[6] and SHA("\n".join(f"{e.role}:{e.text}" for e in mine if e.edit != "D")) == summary[7]
    assert repair.repair_conversations(frame.limit(0)).count() == repair.audit_conversations(frame.limit(0)).count() == 0


def test_damage(odd_conversations):
    import zlib

    frame, rows = odd_conversations
    want = []
    for conv_id, turn, role, text in rows:
        lot = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: text.translate({46: "", 33: "", 63: ""})}.get(lot, text)
        want += [(conv_id, turn, "user" if lot == 4 else role, text)] * {0: 0, 3: 2}.get(lot, 1)
    assert Counter(map(tuple, repair.damaged(frame).collect())) == Counter(want)


# --- lexical search --------------------------------------------------------------


def brute_search(docs, items, k=10):
    import math
    import re

    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    bags = [Counter(terms(t)) for _, t in docs]
    n, total = sum(bool(b) for b in bags), sum(b.total() for b in bags)
    df = Counter(t for b in bags for t in b)
    asked = {}
    for item_id, text in items:
        if item_id is not None:
            asked.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, wanted in asked.items():
        scores = []
        for (doc_id, _), bag in zip(docs, bags):
            m = 10 + (90 * bag.total() * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in wanted if bag[t])
            scores += [(-score, doc_id is None, doc_id)] if score else []
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


@pytest.mark.parametrize("small_blocks", [False, True])
def test_lexical_search(spark, monkeypatch, small_blocks):
    monkeypatch.setattr(lexical, "SLICE_BYTES", 3000)
    if small_blocks:
        monkeypatch.setattr(lexical, "BLOCK_TERMS", 30)
    rng = random.Random(6)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(600)] + ["Étude", "日本", "A", "a9"]
    docs = [(i % 350, " ,.-"[i % 4].join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 8, 60])))) for i in range(400)]
    docs += [(None, docs[3][1]), (900, None), (901, ""), (902, "., -"), (903, docs[5][1]), (904, "W1 w1 " * 20_000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(12))) for i in range(12)]
    items += [(3, "w1 w2 w3"), (50, None), (51, ""), (52, "unheard"), (None, "w1"), (53, "W1"), (54, "A étude Étude")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score long").repartition(6)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long")
    got = [tuple(r) for r in lexical.lexical_search(d, i).collect()]
    assert sorted(got, key=lambda r: r[:2]) == sorted(brute_search(docs, items), key=lambda r: r[:2])
    assert lexical.lexical_search(d.limit(0), i).count() == lexical.lexical_search(d, i.limit(0)).count() == 0


def test_accumulators_are_limited(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toArrow().combine_chunks().to_batches()
    hashes, _ = lexical.hashed_terms(pa.concat_arrays([b.column("text") for b in rows]))
    seen, counts = np.unique(hashes, return_counts=True)
    vocabulary = np.sort(seen[np.argsort(-counts)[np.r_[0:5, 400:403]]])
    row = lexical.index_slice(rows[0], vocabulary).to_pylist()[0]
    df = np.zeros(len(vocabulary), np.int64)
    df[np.frombuffer(row["found"], np.int32)] = np.frombuffer(row["df"], np.int64)
    n = row["n_docs"]
    stats = lexical.Statistics(n, row["n_terms"], df, np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64))
    part, best = lexical.Slice(row, stats), lexical.Best(1)
    made = part.search(np.lexsort((np.arange(len(df)), df)), best)
    assert made < len(np.unique(part.rows)) and best.scores[0] == np.bincount(part.rows, part.adds).max()
    assert not part.scores.any() and not part.held.any()


# --- graph search ----------------------------------------------------------------


def brute_nearest(rows, k, every):
    out = {}
    asked = {}
    for vec_id, v in rows:
        if vec_id % every == 0:
            asked[vec_id] = min(asked.get(vec_id, v), v)
    for query_id, q in asked.items():
        others = [r for r in rows if len(r[1]) == len(q)]
        others.remove((query_id, q))
        scores = sorted((-(np.array(q) * np.array(v)).sum(), vec_id) for vec_id, v in others)
        out[query_id] = [(vec_id, -s) for s, vec_id in scores[:k]]
    return out


def test_graph_search(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "LEAST_SHARDS", 3)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    data = centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    data[200:500] = data[7] + 1e-3 * rng.normal(size=(300, 16))  # near copies
    data *= rng.uniform(0.2, 3, (1500, 1))
    data[500:700] = data[9]  # exact copies
    rows = [(i, data[i].tolist()) for i in range(1500)]
    rows += [(40, data[41].tolist()), (40, data[40].tolist()), (60, data[60].tolist()), (2000, [1.0, 2.0]), (2020, [3.0, -1.0]), (2021, [0.5, 0.5]), (2040, [1.0])]
    odd = [(3000, None), (3020, [0.0] * 16), (3040, []), (3060, [float("nan")] * 16), (3080, [None] + [1.0] * 15), (None, data[0].tolist()), (3100, [float("inf")] + [1.0] * 15)]
    frame = spark.createDataFrame([(*r, 1) for r in [*odd, *rows]], "vec_id long, embedding array<double>, score int").repartition(4)
    got = {}
    for r in sorted(hnsw.approximate_neighbours(frame).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r)
    want = brute_nearest(rows, 20, 20)
    want = {q: v for q, v in want.items() if v}
    assert set(got) == set(want)
    hits = total = 0
    by_id = {}
    for vec_id, v in rows:
        by_id.setdefault(vec_id, []).append(np.array(v))
    for query_id, mine in got.items():
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(want[query_id])
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        q = min(v.tolist() for v in by_id[query_id])
        assert all(any(len(v) == len(q) and abs((np.array(q) * v).sum() - r.score) < 1e-12 * max(1, abs(r.score)) for v in by_id[r.vec_id]) for r in mine)
        hits += sum(r.score >= want[query_id][-1][1] - 1e-9 for r in mine)
        total += len(mine)
    assert hits / total > 0.95
    assert [(r.vec_id, r.score) for r in got[2000]] == [(2021, 1.5), (2020, 1.0)]
    # repeated rows and ids are candidates, the query's own row is not
    assert 60 in [r.vec_id for r in got[60]] and all(r.vec_id != 80 for r in got[80])
    assert hnsw.approximate_neighbours(frame.limit(0)).count() == 0


def test_graph_recall_on_the_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/../sf0.1/embeddings.parquet").select("vec_id", "embedding")
    table = vectors.toArrow()
    ids, x = np.asarray(table["vec_id"]), np.asarray(table["embedding"].combine_chunks().flatten(), np.float64).reshape(len(table), -1)
    found = hnsw.approximate_neighbours(vectors).toPandas()
    asked = np.flatnonzero(ids % 20 == 0)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    worst = dict(zip(ids[asked].tolist(), np.sort(scores, 1)[:, -20]))
    assert len(found) == 20 * len(asked) and (found.score >= found.query_id.map(worst) - 1e-9).mean() > 0.95


def test_an_index_can_be_kept(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = hnsw.build_index(frame)
    found = hnsw.nearest(index, frame.where("vec_id < 5"), 3)
    assert found.count() == 15 and found.groupBy("query_id").agg(F.max("rank")).where("`max(rank)` <> 3").count() == 0
