"""Shingle join, substring dedup and language-model scoring against brute force, with every odd row."""

import math
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartouche.llm import katz, signature_tree
from cartouche.llm.graph import stored
from cartouche.llm.signature_tree import jaccard_classes
from cartouche.llm.substrings import remove_repeats

ROWS = "doc_id long, text string, n_words string, bucket int, row string"  # clashing names


def words(text, lower=False):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found] if lower else found


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], ROWS).repartition(3)


def by_text(rows):
    return sorted(rows, key=str)


def last(doc_id):
    return 10**30 if doc_id is None else doc_id


@pytest.mark.parametrize("small_leaves", [False, True])
def test_jaccard_classes(spark, monkeypatch, small_leaves):
    if small_leaves:
        monkeypatch.setattr(signature_tree, "LEAF_ROWS", 8)
        monkeypatch.setattr(signature_tree, "HEAVY_LEAST", 6)
    rng = random.Random(7 + small_leaves)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randrange(30)) for _ in range(rng.choice([3, 6, 30, 80, 200]))] for _ in range(30)]
    rows = []
    for i in range(400):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[k] = rng.choice(["zz", f"y{i}", w[k].upper()]) if (k := rng.randrange(len(w))) >= 0 else None
        rows.append((i + 1, " ".join(w + [rng.choice("abc") for _ in range(rng.randrange(4))])))
    rows += [(700, None), (701, ""), (702, " \n "), rows[4], (None, rows[7][1]), (None, rows[9][1] + " q"), (None, "lonely text of its own here"),
             (None, "another lonely text of its own"), (800, "w " * 20_000 + " ".join(map(str, range(3000))))]
    sets = [{tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if (w := words(t, True)) else set() for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                links[i], links[j], parent[root(i)] = links[i] + 1, links[j] + 1, root(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[root(i)] = min(smallest.get(root(i), 10**31), last(d))
    want = [(d, len(sets[i]), links[i], None if smallest[root(i)] == 10**30 else smallest[root(i)]) for i, (d, _) in enumerate(rows)]
    assert sum(links) > 500
    assert by_text(tuple(r) for r in jaccard_classes(frame(spark, rows)).collect()) == by_text(want)


def test_signature_tree_prunes_no_link():
    import numpy as np

    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 2**40, n).astype(np.uint64)) for n in (6, 40, 300, 4000)]
    sets = []
    for _ in range(120):
        s = base[rng.integers(4)]
        sets.append(np.unique(np.r_[s[rng.random(len(s)) > rng.choice([0, 0.05, 0.15])], rng.integers(0, 2**40, rng.integers(3)).astype(np.uint64)]))
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sets, sizes = [sets[i] for i in order], sizes[order]
    tree = signature_tree.SignatureTree(np.arange(120), sizes, np.ones(120, int), sizes, np.concatenate(sets))
    got = set(zip(*(x.tolist() for x in tree.join(tree, 80))))
    want = {(i, j) for i in range(120) for j in range(i + 1, 120)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert got == want and len(want) > 100


def test_no_task_holds_all_leaves_of_a_token(spark, monkeypatch):
    """A hot token is cut into cells of bounded size, and its cells have every leaf pair; so do tokens of few leaves."""
    monkeypatch.setattr(signature_tree, "BLOCK_LEAVES", 32)
    leaves = {1: range(1, 1001), 2: range(1, 1001), 3: [-5, 7], 4: [9], 5: [*range(980, 1010)], 6: range(500, 550)}
    holds = spark.createDataFrame([(t, x) for t, many in leaves.items() for x in many], "token long, leaf long").repartition(5)
    cells = signature_tree.leaf_cells(holds)
    assert max(len(r.left) + len(r.right) for r in cells.collect()) <= 4 * 32
    got = [tuple(r) for r in cells.mapInArrow(signature_tree.pairs_of_cells, "a long, b long").distinct().collect()]
    assert sorted(got) == sorted({(a, b) for many in leaves.values() for a in many for b in many if a < b})


def shuffle_files(spark):
    return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")


def test_shuffles_go_with_their_table(spark):
    rows = [(i, " ".join(f"w{(i // 4, j)}".replace(" ", "") for j in range(40)) + f" end{i}") for i in range(200)]
    before = shuffle_files(spark)
    found = jaccard_classes(frame(spark, rows))
    deadline = time.monotonic() + 20  # files are removed in the background
    while shuffle_files(spark) - before > 20 and time.monotonic() < deadline:
        time.sleep(0.5)
    assert shuffle_files(spark) - before <= 20
    assert found.where("n_links = 3").count() == 200


def test_leaves_are_sent_once_for_each_block(spark):
    near, star = range(1, 201), range(1001, 1401)
    pairs = [(a, b) for a in near for b in near if a < b] + [(7, 2000)] + [(x, 5000) for x in star]
    frame_of = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    leaves = spark.createDataFrame([(x, 1000) for x in {x for pair in pairs for x in pair}], "leaf long, bytes long")
    cells = signature_tree.pair_cells(frame_of, leaves).collect()
    assert sorted((min(r.leaf, o), max(r.leaf, o)) for r in cells for o in r.others) == sorted(pairs)
    assert len({(r.cell_a, r.cell_b, r.leaf) for r in cells}) == len(cells)
    assert sum(r.leaf <= 200 for r in cells) < 200 * 12 and sum(r.leaf == 5000 for r in cells) < 30  # of 199 and 400 pairs


def test_leaves_hold_sets_of_like_size(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(signature_tree, "released", lambda frame, name: kept.setdefault(name, stored(frame, name)))
    rows = [(n, " ".join(f"c{j}" for j in range(n))) for n in range(20, 400, 5)]
    jaccard_classes(frame(spark, rows)).collect()
    nodes = kept["nodes"].collect()
    assert max(r.high for r in nodes) > 390 and all(100 * r.low >= 75 * r.high for r in nodes)


def test_pairs_are_sent_on_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(signature_tree, "MOST_PAIRS", 1000)
    side = lambda at: pa.array([[*range(at, at + 20)]] * 10, pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([side(0), side(100), pa.array([False] * 10)], names=["left", "right", "own"])
    parts = list(signature_tree.pairs_of_cells([batch]))
    assert [p.num_rows for p in parts] == [400] * 4  # equal pairs of three, three, three and one cells are merged


def test_remove_repeats(spark):
    rng = random.Random(1)
    shared = [" ".join(rng.choice("abcdef") for _ in range(70)) for _ in range(3)]
    own = lambda: " ".join(str(rng.random()) for _ in range(30))
    rows = [(i, rng.choice([None, "", "x y"]) if i % 10 == 0 else " \n".join(rng.choice([*shared, own(), own()]) for _ in range(4))) for i in range(60)]
    rows += [rows[3], (None, rows[4][1]), (99, "x " * 60_000)]
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - 49):
            first[key] = min(first.get(key, 10**31), last(d)) if (key := tuple(w[i:i + 50])) else None
    want = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i:i + 50])] < last(d):
                gone[i:i + 50] = [True] * 50
        want.append((d, t, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    out = remove_repeats(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "bucket", "row", "n_words", "n_removed", "kept_text"]
    got = [tuple(r) for r in out.select("doc_id", "text", "n_words", "n_removed", "kept_text").collect()]
    assert by_text(got) == by_text(want) and sum(r[3] for r in want) > 1000


@pytest.mark.parametrize("most_words", [60, 100_000])
def test_katz_is_normalised_and_matches_recursion(spark, most_words):
    rng = random.Random(1)
    vocab = ["w%d" % min(int(rng.paretovariate(0.6)), 400) for _ in range(4000)]
    rows = [(i, None if i % 50 == 0 else " ".join(rng.choice(vocab) if rng.random() < 0.8 else f"R{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 10, 80]))))
            for i in range(200)]
    rows += [rows[7], (None, "w1 w2")]
    end = "</s>"
    tokens = lambda t: [*words(t, True), end]
    remainder = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5
    train = [tokens(t) for d, t in rows if remainder(d) != 1]
    c = Counter(w for t in train for w in t)
    n, types = sum(c.values()), len(c)
    of_count, held, least = Counter(c.values()), 0, max(c.values()) + 1
    for k in sorted(of_count, reverse=True):
        held += of_count[k]
        if held > most_words:
            break
        least = k
    known = {w for w in c if c[w] >= least} | {end}
    rare, rare_types = sum(c[w] for w in c if w not in known), sum(w not in known for w in c)
    cut = lambda r, d: r * d[min(r, len(d) - 1)]
    d1 = katz.discounts(dict(of_count))
    share = sum(cut(c[w], d1) for w in known)
    room = n if n - share > 1e-9 * n else n + 1
    p1 = {w: cut(c[w], d1) / room for w in known} | {"?": 1 - share / room}
    short = lambda w: w if w in known else "?"
    pairs, history = Counter(), Counter()
    for t in train:
        before = end
        for w in t:
            pairs[before, short(w)] += 1
            history[before] += 1
            before = short(w)
    d2 = katz.discounts(dict(Counter(pairs.values())))
    seen = {}
    for (x, y), k in pairs.items():
        seen.setdefault(x, {})[y] = k

    def prob(x, w):
        y, after = short(w), seen.get(x, {})
        mass = sum(cut(k, d2) for k in after.values())
        bottom = history[x] if history[x] - mass > 1e-9 * max(history[x], 1) else history[x] + 1
        inner = 1 if y != "?" else (c[w] + 0.5) / (rare + 0.5 * (rare_types + 1))
        if y in after:
            return cut(after[y], d2) / bottom * inner
        return (1 - mass / bottom) / (1 - sum(p1[z] for z in after)) * p1[y] * inner

    for x in list(seen)[:20]:
        assert abs(sum(prob(x, w) for w in {*c, *known}) + prob(x, "never") - 1) < 1e-9
    want = []
    for d, t in rows:
        total, before = 0.0, end
        for w in tokens(t):
            total += math.log10(prob(before, w))
            before = short(w)
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (types + 1))) for w in tokens(t))
        want.append((d, remainder(d) == 1, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, base, total))
    r = katz.remainder()
    got = [tuple(x) for x in katz.katz_scores(frame(spark, rows), r != 1, r == 1, most_words).collect()]
    for a, b in zip(sorted(got, key=lambda x: (str(x[0]), x[2])), sorted(want, key=lambda x: (str(x[0]), x[2])), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-6)


@pytest.mark.parametrize("operator", [jaccard_classes, remove_repeats, lambda d: katz.katz_scores(d, F.lit(True), F.lit(False))])
def test_empty_tables(spark, operator):
    assert operator(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_katz_keeps_every_word(spark):
    """A vocabulary above the old limit of 2^18 words: a rare word's bigram is scored as one, not as an unknown word's."""
    rows = [(i, " ".join(f"x{i}y{j} z{i}y{j}" for j in range(1000))) for i in range(140)] + [(1000, "x5y5 z5y5"), (1001, "x5y5 z7y7")]
    got = {r.doc_id: r for r in katz.katz_scores(frame(spark, rows), F.col("doc_id") < 1000, F.col("doc_id") >= 1000).collect()}
    assert got[1000].n_known == got[1001].n_known == 3 and got[1000].base_score == pytest.approx(got[1001].base_score)
    assert got[1000].score > got[1001].score + 3
