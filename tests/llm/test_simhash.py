import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from matchloom.llm import queries, simhash


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, radius=3):
    """Root of each fingerprint, all pairs compared."""
    found = sorted(set(fps))
    root = {f: f for f in found}
    for i, a in enumerate(found):
        for b in found[:i]:
            if (a ^ b).bit_count() <= radius and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {f: new if r == old else r for f, r in root.items()}
    return root


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_shared_hash_is_sparks_own(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == signed(xxhash.xxh64_intdigest(b"a b c", 42))


def test_near_duplicates_of_awkward_rows(spark, docs):
    rows = simhash.near_duplicates(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(str, [(r["id"], r["fp"]) for r in rows])) == sorted(map(str, [(i, signed(brute_fingerprint(t))) for i, t in texts]))
    component = {r["id"]: r["component_id"] for r in rows}
    assert component[1] == component[2] == 1
    assert component[3] == component[4] == component[7] == 3  # no words: fingerprint 0, linked
    assert component[5] == component[6] == 5 and component[None] is None


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_of_each(no_docs).count() == 0


def test_links_against_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(4):  # dense clusters and chains, which overflow small buckets
        f = rng.getrandbits(64)
        for _ in range(120):
            fps.add(f)
            for _ in range(rng.randrange(1, 4)):
                f ^= 1 << rng.randrange(64) if rng.random() < 0.5 else 1 << rng.randrange(12)
    for bucket in (2048, 16):
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
        found = dict(simhash.components(simhash.links(df)).collect())
        expected = brute_groups(fps)
        by_root = {}
        for f, r in expected.items():
            by_root.setdefault(r, set()).add(signed(f))
        for group in by_root.values():
            assert {found.get(f, f) for f in group} == {min(group)}


def test_pivot_table_loses_no_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(1 << 5), base ^ np.uint64(0b111 << 20), base ^ np.uint64(0b1111 << 30)]))
    i, j = simhash.near_pairs(fps, simhash.references())
    found = {frozenset((int(a), int(b))) for a, b in zip(fps[i], fps[j])}
    assert found == {frozenset((int(a), int(b))) for a in fps for b in fps if a < b and (int(a) ^ int(b)).bit_count() <= 3}


def test_one_of_each_keeps_the_lowest(docs):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 3, None, 5, 8, 9, 10], key=str)


def test_query(spark, small):
    rows = queries.op1_simhash(spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    root = brute_groups(fps.values())
    low = {}
    for i, f in fps.items():
        low[root[f]] = min(i, low.get(root[f], i))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{f:016x}", low[root[f]]) for i, f in fps.items()}


def brute_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar_roots(texts):
    """Root of each id, all pairs of texts compared by Jaccard similarity of five words."""
    sets, root = {i: brute_sets(t) for i, t in texts.items()}, {i: i for i in texts}
    for a in sorted(texts):
        for b in sorted(x for x in texts if x < a):
            shared = len(sets[a] & sets[b])
            if (sets[a] == sets[b] or 5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared)) and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    return root


@pytest.mark.parametrize(("few", "block"), [(simhash.FEW, simhash.BLOCK_SHINGLES), (2, 500_000), (2, 400)])
def test_one_of_each_against_jaccard(spark, monkeypatch, few, block):
    """With the settings, with all larger groups in blocks, and with many small blocks."""
    monkeypatch.setattr(simhash, "FEW", few)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block // 40)
    rng = random.Random(11)
    texts, common = {}, " ".join(f"c{i}" for i in range(12))
    for _ in range(12):  # copies with a few words changed, on both sides of the limit and in chains
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((3, 7, 30, 120, 300)))]
        for _ in range(8):
            texts[len(texts)] = " ".join(words) + (" " + common if rng.random() < 0.5 else "")
            for _ in range(rng.randrange(1, max(2, len(words) // 25))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(5000)}"
    root = similar_roots(texts)
    far = [(a, b) for a, r in root.items() for b in [r] if a != b and (brute_fingerprint(texts[a]) ^ brute_fingerprint(texts[b])).bit_count() > 3]
    assert far and len(set(root.values())) > 20
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.one_of_each(df).collect()) == sorted(set(root.values()))


def test_columns_of_any_name(spark):
    clash = ["_text_key", "_set_text", "_stays", "_row_id", "row", "k", "k0", "id", "bits", "piece", "asked", "root", "key", "n", "fp", "s"]
    rows = [(i, t, *[f"{c}{i}" for c in clash]) for i, t in enumerate(["one two three four five six", "one two three four five six", "other words stand here", None, ""])]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))
    assert sorted(simhash.one_of_each(df).collect()) == sorted(r for r in df.collect() if r["doc_id"] in (0, 2, 3))


def test_sketches_rule_out_no_pair():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 30, 65, 900):
        for share in (0.0, 0.5, 0.8, 1.0):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[: int(share * len(a))], rng.integers(0, 1 << 63, n // 5, dtype=np.uint64)]))
            most = simhash.most_shared(len(a), simhash.sketch(a), len(b), simhash.sketch(b))
            assert len(np.intersect1d(a, b)) <= most <= min(len(a), len(b))
            assert share or n < 65 or most < 0.6 * n
            x, y = (np.frombuffer(simhash.pivot_counts(v), np.uint8).astype(int) for v in (a, b))
            assert np.abs(x - y).sum() <= len(np.setxor1d(a, b))


def test_sets_that_the_table_keeps_against_all_pairs():
    rng = np.random.default_rng(3)
    for _ in range(30):
        base = [rng.integers(0, 2**63, rng.integers(1, 90)).astype(np.uint64) for _ in range(5)]
        sets = [np.unique(np.where(rng.random(len(b)) < 0.07, rng.integers(0, 2**63, len(b)).astype(np.uint64), b)) for b in base for _ in range(6)]
        sizes, roots = np.array([len(x) for x in sets]), rng.integers(0, 9, len(sets))
        table = np.array([np.frombuffer(simhash.pivot_counts(x), np.uint8) for x in sets])
        apart = np.abs(table[:, None].astype(int) - table[None].astype(int)).sum(axis=2)
        ratio = 5 * np.minimum(sizes[:, None], sizes) >= 4 * np.maximum(sizes[:, None], sizes)
        may = ratio & (9 * apart <= sizes[:, None] + sizes) & (roots[:, None] != roots)
        linked = np.array([[5 * (m := len(np.intersect1d(x, y))) >= 4 * (len(x) + len(y) - m) for y in sets] for x in sets]) & (roots[:, None] != roots)
        kept = simhash.near_in_table(sizes, roots, table)
        assert (kept == may.any(axis=1)).all() and kept[linked.any(axis=1)].all()
