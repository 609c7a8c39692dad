import itertools
import zlib

import numpy as np

from matchloom.llm import quality, queries


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    k, n = len(quality.STRUCTURE), quality.BUCKETS + len(quality.STRUCTURE)
    m = quality.Machine(0.3, rng.normal(size=n), rng.normal(size=(n, 4)), rng.normal(size=k), rng.uniform(0.5, 2, k))
    index, value = quality.features(b"Some words, and some MORE words | here.\nA line 123 $$$", 50)
    x = value.copy()
    x[-k:] = (x[-k:] - m.mean) * m.scale
    slow = m.bias + sum(m.linear[i] * v for i, v in zip(index, x)) + sum(m.factors[index[a]] @ m.factors[index[b]] * x[a] * x[b] for a, b in itertools.combinations(range(len(x)), 2))
    assert abs(slow - m.margin(index, value)) < 1e-8


def test_machine_learns_interactions():
    rng = np.random.default_rng(2)
    texts = [b"red car" if a and b else b"red bus" if a else b"blue car" if b else b"blue bus" for a, b in rng.integers(0, 2, (400, 2))]
    rows = [(*quality.features(t, None), int(t in (b"red car", b"blue bus"))) for t in texts]
    m = quality.fit(rows)
    assert np.mean([(m.margin(i, v) > 0) == y for i, v, y in rows]) > 0.95
    assert quality.fit([]).bias == 0 and quality.fit([r for r in rows if r[2]]).bias > 0


def test_awkward_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 1, None), (10, 0, 0), (None, 1, 0), (8, None, 0), (1, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    m = quality.learn(docs, labels)
    rows = quality.scored(docs, m).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r["id"]], set()).add(round(r["score"], 3))
    assert quality.scored(no_docs, m).count() == 0
    assert quality.learn(no_docs, labels).bias == 0 and quality.learn(docs, labels.limit(0)).bias == 0


def test_sample_is_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    labels = df.selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows: seen.append(len(rows)))
    quality.learn(df, labels, sample=50)
    assert seen == [50]


def test_query_and_held_out_accuracy(spark, small):
    path = small.replace("sf0.001", "sf0.01")
    rows = {r["doc_id"]: r for r in queries.op5_quality(spark, path).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.5) for i, r in rows.items())
    labels = [r for r in spark.read.parquet(f"{path}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    assert len(right) > 50 and np.mean(right) > 0.95
    assert len(rows) == spark.read.parquet(f"{path}/documents.parquet").count()
