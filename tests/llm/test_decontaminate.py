import hashlib
import random
import re

from matchloom.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for name, passage in items:
        p = words(passage)
        for k in range(max(1, len(p) - window + 1) if p else 0):
            x = p[k : k + window]
            for at in range(len(w) - len(x) + 1):
                if w[at : at + len(x)] == x:
                    hit.update(range(at, at + len(x)))
                    found.add(str(name))
    return len(w), len(hit), sorted(found)


def run(spark, df, items, **kw):
    rows = decontaminate.matches(df, spark.createDataFrame(items, "item_id long, text string"), **kw).collect()
    return [(r["id"], (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"])) for r in rows]


def test_random_texts(spark):
    rng = random.Random(4)
    vocabulary = ["a", "b", "c", "the", "é", "z9"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.randrange(0, 16))) for i in range(25)] + [(3, None), (30, "a a a a a a a a a a a"), (31, "A, b. C!")]
    texts = [say(rng.randrange(0, 40)) for _ in range(30)] + [f"{say(5)} {t or ''} {say(5)}" for _, t in items] + [None, "", "a " * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = sorted((i, brute(t, items)) for i, t in enumerate(texts))
    assert sorted(run(spark, df, items)) == expected
    assert sorted(run(spark, df, items, block_bytes=200)) == expected  # several passes


def test_awkward_rows(spark, docs, no_docs):
    items = [(1, "the QUICK brown fox jumps over the lazy dog near the"), (2, "two words"), (3, ""), (4, None)]
    assert sorted(map(str, run(spark, docs, items))) == sorted(map(str, [(r["doc_id"], brute(r["text"], items)) for r in docs.collect()]))
    assert run(spark, no_docs, items) == []
    assert all(x[1][1] == 0 for x in run(spark, docs, []))


def test_proximity(spark):
    df = spark.createDataFrame([(1, "zeta omega filler words here gamma and then kappa"), (2, "zeta " + "x " * 40 + "omega gamma kappa")], "doc_id long, text string")
    item = spark.createDataFrame([(7, "kappa gamma omega zeta")], "item_id long, text string")
    rows = {r["id"]: r for r in decontaminate.matches(df, item).collect()}
    assert rows[1]["near_items"] == ["7"] and rows[1]["items"] == [] and rows[2]["near_items"] == []


def test_query(spark, small):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r for r in queries.op7_decontamination(spark, small).collect()}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        n, hit, found = brute(r["text"], items)
        own = rows.pop(r["doc_id"])
        assert (own["n_words"], own["n_hit"], own["n_items"], own["contaminated"]) == (n, hit, len(found), hit > 0)
        assert own["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert not rows


def test_near_items_do_not_depend_on_the_batch(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    edited = passage.replace("p3 ", "q ").replace("p17 ", "q ").replace("p30 ", "q ")
    late = "one two three four " + passage[passage.index("p20 ") :]
    other = "p0 p1 p2 p3 p39"  # would change which terms are rarest among its neighbours
    texts = [passage, edited, late, "nothing of it at all", other] + ["p5 " * 50] * 3
    rows = list(enumerate(texts))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    found = []
    for parts in (1, len(rows)):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found.append({r["id"]: r["near_items"] for r in decontaminate.matches(df, items).collect()})
    assert found[0] == found[1]
    assert {i for i, x in found[0].items() if x} == {0, 1, 2}
