"""Each stage of the corpus pipeline against a plain version over the rows that its predecessor kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartouche.llm import personal, toxicity
from cartouche.llm.katz import remainder
from test_texts import words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, path = random.Random(5), str(tmp_path_factory.mktemp("corpus"))
    plain = [f"word{i}" for i in range(400)]
    passage = " ".join(rng.choice(plain) for _ in range(60))
    texts = []
    for i in range(300):
        w = [rng.choice(plain) for _ in range(rng.choice([3, 40, 120]))]
        if i % 7 == 0:
            w[1:1] = ["nasty", "vile", "nasty"]
        texts.append(" ".join(w) + (f" {passage} end{i}" if i % 11 == 0 else "") + (f" mail me{i}@example.org" if i % 5 == 0 else ""))
    texts += [texts[1], texts[2] + " more", texts[3].replace("word1 ", "word2 ", 1), "", None, texts[1]]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, int(i % 7 == 0)) for i in range(300)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def kept_of_groups(rows):
    sets = {d: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if (w := words(t, True)) else set() for d, t, *_ in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [r for r in rows if root(r[0]) == r[0]]


def without_repeats(rows):
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - 49):
            key = tuple(w[i:i + 50])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t, *rest in rows:
        w = words(t)
        gone = {p for i in range(len(w) - 49) if first[tuple(w[i:i + 50])] < d for p in range(i, i + 50)}
        out.append((d, " ".join(x for p, x in enumerate(w) if p not in gone) if gone else t, *rest))
    return out


def counted(rows):
    return [(d, t, lang, source, None if t is None else len(t)) for d, t, lang, source, _ in rows]


def test_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "repeated passages", "personal data", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet"), remainder() != 0)
    anchors = personal.automaton()
    scored = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    plain = [
        lambda rows: [r for r in rows if not scored[r[0]]], kept_of_groups, lambda rows: counted(without_repeats(rows)),
        lambda rows: counted([(d, t and personal.masked(t, personal.ordered_spans(t, anchors)), *rest) for d, t, *rest in rows]),
    ]
    rows = [tuple(r) for r in docs.select(COLUMNS).collect()]
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain):
        out = stage(spark, docs, folder)
        assert out.columns == COLUMNS
        want, got = sorted(expected(rows)), sorted(tuple(r) for r in out.collect())
        assert got == want, name
        assert 0 < len(got) and (name not in ("toxicity", "near duplicates") or len(got) < len(rows)) and (name != "personal data" or got != sorted(rows))
        docs, rows = spark.createDataFrame(got, docs.schema), got
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count("*"), F.sum("n")).first()
    assert sums[0] <= 1024 and sums[1] <= 1.1 * sums[2] / 1024 + 1 and packed.select("doc_id").distinct().count() == len(rows)


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 200 and "sequence_id" in out.columns


def test_near_duplicates_deal_the_texts_once(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2  # the texts and the kept ids
