import random

import pytest
from pyspark.sql import functions as F

from matchloom.functions import similarity as sim
from matchloom.operators import blocking, decide, features, keys, labels, metric, model, profile

ROWS = "gid long, country string, name_tokens array<string>, addr_components array<string>, addr_house_number string, addr_zip string, name_legal_form string"


def row(gid, name, comps=(), house="", zip_="", country="US", legal=""):
    return (gid, country, name.split(" "), list(comps), house, zip_, legal)


def key_set(df, kind, **kw):
    return sorted(r["key"] for r in keys.keys(df, (kind,), hashed=False, **kw).collect())


def test_keys_of_cleaned_rows(spark):
    df = spark.createDataFrame([row(1, "b a b  c", ["42 oak st", "x 42"], "42", "78701")], ROWS)
    assert key_set(df, "tok") == ["a", "b", "c"] and key_set(df, "pair") == ["a|b", "a|c", "b|c"]
    assert key_set(df, "house") == ["42|oak", "42|st", "42|x"] and key_set(df, "zip") == ["78701"]
    many = spark.createDataFrame([row(1, " ".join(f"t{i}" for i in range(12)))], ROWS)
    assert len(key_set(many, "pair")) == 28 and key_set(many, "zip") == [] and key_set(many, "house") == []
    twice = spark.createDataFrame([row(1, "n", ["oak oak"], "1")], ROWS)
    assert key_set(twice, "house", distinct=False) == ["1|oak", "1|oak"] and key_set(twice, "house") == ["1|oak"]


@pytest.mark.parametrize("name,key", [("www acme traders com", "acmetraders"), ("acme", ""), ("com com com", ""), ("http www acmeco in", "acmeco"), ("sharma co in", "sharma"), ("abc def", "abcdef"), ("", ""), ("www", ""), ("a b c d e f com org net biz", "abcdefcom")])
def test_nospace(spark, name, key):
    df = spark.createDataFrame([(name.split(" "),)], "t array<string>")
    assert df.select(keys.nospace(F.col("t"))).first()[0] == key


def test_keys_of_records(spark):
    df = spark.createDataFrame([(1, "US", "acme of trading", "oak 12 rd 7 pine", "tx", "acmeoftrading", "acmtrdng"), (2, "US", "ab", "", "", "ab", "b")], "gid long, country string, core string, addr string, region string, ns string, skel string")
    assert key_set(df, "na") == ["acme|oak", "acme|pine", "trading|oak", "trading|pine"]
    assert key_set(df, "rns") == ["tx|acmeoftrading"] and key_set(df, "rsk") == ["tx|acmtrdng"] and key_set(df, "cns") == ["acmeoftrading"]
    assert key_set(df, "aa") == ["12|oak", "12|pine", "oak|pine"]


def test_hashed_keys_tell_kinds_apart(spark):
    df = spark.createDataFrame([row(1, "78701", zip_="78701")], ROWS)
    assert len({r["key"] for r in keys.keys(df, ("tok", "zip")).collect()}) == 2


@pytest.fixture
def two_sides(spark):
    s1 = spark.createDataFrame([row(1, "acme traders", ["5 oak st"], "5", "11111"), row(2, "zeta", country="India")], ROWS)
    s23 = spark.createDataFrame(
        [row(10, "acme traders", ["5 oak st"], "5", "11111"), row(11, "acme"), row(12, "traders x"), row(13, "acme", country="India"), row(14, "zeta", country="India"), row(15, "other", ["5 oak st"], "5")], ROWS
    )
    return s1, s23


def test_first_list(two_sides):
    out = {(r["s1_gid"], r["s23_gid"]): r for r in blocking.first_list(*two_sides).collect()}
    assert set(out) == {(1, 10), (1, 11), (1, 12), (1, 15), (2, 14)}  # countries don't mix
    assert out[1, 10]["blocking_rank"] == 1 and out[1, 11]["addr_score"] == 0 and out[1, 15]["name_score"] == 0
    short = {(r["s1_gid"], r["s23_gid"]): r for r in blocking.first_list(*two_sides, k_name=1, k_address=1).collect()}
    assert set(short) == {(1, 10), (2, 14)}


def test_scores_ties_and_caps(spark, two_sides):
    s1, s23 = two_sides
    a = keys.keys(s1, ("tok",), hashed=False).withColumnRenamed("gid", "s1_gid")
    b = keys.keys(s23, ("tok",), hashed=False)
    rare = blocking.rare_keys(b, blocking.pool_sizes(s23), {"tok": 1})
    assert {r["key"] for r in rare.filter("country = 'US'").collect()} == {"x", "other"}
    rare = blocking.rare_keys(b, blocking.pool_sizes(s23), {"tok": 5})
    b = b.withColumnRenamed("gid", "s23_gid")
    scored = blocking.score(a, b, rare, ("tok",))
    import math

    idf = round(math.log(5 / 3) + 1, 6)
    assert {(r[0], r[1]): r[2] for r in scored.filter("s1_gid = 1").collect()} == {(1, 10): pytest.approx(2 * idf, abs=2e-6), (1, 11): pytest.approx(idf), (1, 12): pytest.approx(idf)}
    assert [(r["s23_gid"], r["rank"]) for r in blocking.top(scored, 2).filter("s1_gid = 1").orderBy("rank").collect()] == [(10, 1), (11, 2)]
    assert blocking.top(scored, 0).count() == 0
    assert {r["country"]: r["n_pairs"] for r in blocking.estimate_pairs(a, b, rare).collect()} == {"US": 4, "India": 1}
    with pytest.raises(MemoryError):
        blocking.check_budget(a, b, rare, 4)
    assert blocking.check_budget(a, b, rare, 5) == 5


def test_union_has_sentinels(spark):
    first = spark.createDataFrame([(1, 2, 3.0, 1), (1, 3, 2.0, 31)], "s1_gid long, s23_gid long, blocking_score double, blocking_rank int")
    v3 = spark.createDataFrame([(1, 4, 1.5, 1)], "s1_gid long, s23_gid long, v3_score double, v3_rank int")
    out = {r["s23_gid"]: tuple(r)[2:] for r in blocking.union_lists(first, v3, k1=30).collect()}
    assert out == {2: (3.0, 1, 0.0, 999), 4: (0.0, 999, 1.5, 1)}


def test_recall(spark):
    truth = spark.createDataFrame([(1, 2), (1, 3), (4, 5), (6, 7)], "s1_gid long, s23_gid long")
    cand = spark.createDataFrame([(1, 2, 1), (1, 9, 2), (1, 3, 3)], "s1_gid long, s23_gid long, r int")
    assert tuple(blocking.recall(cand, truth).first()) == (4, 2, 0.5) and blocking.recall(cand, truth.limit(0)).first()["recall"] is None
    assert {r["k"]: r["recall"] for r in blocking.recall_curve(cand, truth, "r", [1, 3]).collect()} == {1: 0.25, 3: 0.5}


def test_same_name_without_address(spark):
    ddl = "gid long, country string, ns string, addr string"
    s1 = spark.createDataFrame([(1, "US", "acme", "x"), (2, "US", "abc", "x")], ddl)
    s23 = spark.createDataFrame([(10, "US", "acme", ""), (11, "US", "acme", "y"), (12, "US", "abc", ""), (13, "India", "acme", "")], ddl)
    assert [tuple(r) for r in blocking.same_name_without_address(s1, s23).collect()] == [(1, 10)]


# ---------------------------------------------------------------- similarity


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_lcs_against_the_table():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(90))) for _ in range(2))
        assert sim.lcs(a, b) == slow_lcs(a, b)


def test_known_similarities():
    assert sim.ratio("", "") == 100 and sim.ratio("abc", "") == 0 and sim.ratio("this is a test", "this is a test!") == pytest.approx(96.55172)
    assert sim.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert sim.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100 and sim.token_set_ratio("", "a") == 0 and sim.token_set_ratio("", "") == 0
    assert sim.partial_ratio("this is a test", "this is a test!") == 100 and sim.partial_ratio("", "") == 100 and sim.partial_ratio("a", "") == 0
    assert sim.jaro_winkler("martha", "marhta") == pytest.approx(0.9611111) and sim.jaro_winkler("", "") == 1 and sim.jaro_winkler("a", "") == 0
    assert sim.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133333)


def test_partial_ratio_against_all_windows():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(1, 14))) for _ in range(2))
        s, t = (a, b) if len(a) <= len(b) else (b, a)
        best = max(sim.ratio(s, t[i:j]) for i in range(len(t)) for j in range(i + 1, len(t) + 1) if j - i == len(s) or (j - i < len(s) and (i == 0 or j == len(t))))
        if len(s) == len(t):
            best = max(best, max(sim.ratio(t, s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1) if i == 0 or j == len(s)))
        assert sim.partial_ratio(a, b) == pytest.approx(best)


# ---------------------------------------------------------------- features


def test_simple_features(spark):
    s1 = spark.createDataFrame([row(1, "a b c", ["x y", "z"], "5", "1", legal="ltd"), row(2, "")], ROWS)
    s23 = spark.createDataFrame([row(3, "a b", ["x y q"], "5", "", legal="llc"), row(4, "")], ROWS)
    pairs = spark.createDataFrame([(1, 3), (2, 4)], "s1_gid long, s23_gid long")
    out = {r["s1_gid"]: tuple(r)[2:] for r in features.simple_features(pairs, s1, s23).collect()}
    assert out[1] == (pytest.approx(2 / 3), 2, 0.5, 1, 0, 0, 1)
    assert out[2] == (1.0, 1, 0.0, 0, 0, 0, 0)  # empty names share the empty token


def test_context_windows(spark):
    df = spark.createDataFrame([(1, 1, 100.0, 100.0), (1, 2, 100.0, 60.0), (1, 3, 50.0, 50.0), (2, 4, 95.0, 0.0)], "s1_gid long, s23_gid long, n_tset double, a_tset double")
    out = {r["s23_gid"]: r for r in features.full_context(df).collect()}
    assert [out[i]["ctx_c_rank"] for i in (1, 2, 3)] == [1, 2, 3] and [out[i]["ctx_c_gap"] for i in (1, 2, 3)] == [0, 40, 100]
    assert [out[i]["ctx_n_rank"] for i in (1, 2, 3)] == [1, 1, 3] and out[1]["ctx_n_hi"] == 2 and out[4]["ctx_n_cand"] == 1


def test_number_features(spark):
    ddl = "gid long, addr string"
    a = spark.createDataFrame([(1, "007 oak st 000"), (2, "oak st")], ddl)
    b = spark.createDataFrame([(3, "7 oak st 12"), (4, "elm")], ddl)
    pairs = spark.createDataFrame([(1, 3), (2, 4)], "s1_gid long, s23_gid long")
    out = {r["s1_gid"]: r for r in features.number_features(pairs, a, b).collect()}
    assert out[1]["x_num_jacc"] == pytest.approx(1 / 3) and (out[1]["x_num_extra2"], out[1]["x_num_miss2"], out[1]["x_hn_absdiff"]) == (1, 1, 0)
    assert out[1]["x_a_ratio_nod"] == 100 and out[2]["x_num_jacc"] == -1 and out[2]["x_hn_absdiff"] == -1 and out[2]["x_num_tset"] == 0


def test_soundex(spark):
    cases = {"robert": "R163", "ashcraft": "A261", "tymczak": "T522", "pfister": "P236", "honeyman": "H555", "a": "A000", "12": "", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "n string").select("n", features.soundex_code(F.col("n")).alias("s"))
    assert {r["n"]: r["s"] for r in df.collect()} == cases


def test_second_pass(spark):
    df = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.9), (1, 12, 0.2), (2, 13, 0.4)], "s1_gid long, s23_gid long, p1 double")
    out = {r["s23_gid"]: r for r in features.rivals(df).collect()}
    assert [(out[i]["p1_rank"], out[i]["p1_max_other"], out[i]["p1_n_conf_other"]) for i in (10, 11, 12, 13)] == [(1, 0.9, 1), (2, 0.9, 1), (3, 0.9, 2), (1, 0.0, 0)]
    r23 = spark.createDataFrame([(10, "acme", "x"), (11, "acme co", "x y"), (12, "zz", "q"), (13, "a", "b")], "gid long, core string, addr string")
    sib = {r["s23_gid"]: r["sib_both_max"] for r in features.siblings(df, r23).collect()}
    assert sib[10] == 100 and sib[13] == -1 and 0 <= sib[12] < 60


# ---------------------------------------------------------------- decisions and metric


def test_one_per_second_and_thresholds(spark):
    df = spark.createDataFrame([(1, 10, 0.9), (2, 10, 0.9), (3, 10, 0.8), (3, 11, 0.3)], "s1_gid long, s23_gid long, prob double")
    assert [(r[0], r[1]) for r in decide.one_per_second(df).orderBy("s23_gid").collect()] == [(1, 10), (3, 11)]
    assert [(r[0], r[1]) for r in decide.at_threshold(df, 0.5).collect()] == [(1, 10)]


def f05(pred, true):
    if not true:
        return float(not pred)
    if not (tp := len(pred & true)):
        return 0.0
    p, r = tp / len(pred), tp / len(true)
    return 1.25 * p * r / (0.25 * p + r)


def test_metric_against_the_definition(spark):
    rng = random.Random(3)
    rows = range(60)
    truth = {(rng.randrange(80), i) for i in range(100)}
    pred = {(s if rng.random() < 0.6 else rng.randrange(80), i) for s, i in truth if rng.random() < 0.7}
    ddl = "s1_gid long, s23_gid long"
    p, t, s = spark.createDataFrame(list(pred), ddl), spark.createDataFrame(list(truth), ddl), spark.createDataFrame([(i,) for i in rows], "s1_gid long")
    out = {r["s1_gid"]: r["f05"] for r in metric.per_row(p, t, s, check=True).collect()}
    of = lambda x, i: {b for a, b in x if a == i}
    assert out == {i: pytest.approx(f05(of(pred, i), of(truth, i))) for i in rows}
    with pytest.raises(metric.DuplicateLinks):
        metric.per_row(p.unionByName(p), t, s, check=True)
    with pytest.raises(metric.DuplicateLinks):
        decide.score_links(spark.createDataFrame([(1, 5), (2, 5)], ddl), t, s.withColumns({"country": F.lit("x"), "bucket": F.lit("0")}))
    assert metric.macro(metric.ceiling(t, t, s)).first()["f05"] == 1


def test_threshold_curve_equals_one_by_one(spark):
    rng = random.Random(4)
    scored = spark.createDataFrame([(a, b, round(rng.random(), 2)) for a in range(20) for b in rng.sample(range(40), 5)], "s1_gid long, s23_gid long, prob double")
    truth = spark.createDataFrame([(i % 20, i) for i in range(0, 40, 2)], "s1_gid long, s23_gid long")
    rows = spark.createDataFrame([(i,) for i in range(22)], "s1_gid long")
    curve = {r["threshold"]: r["f05"] for r in decide.threshold_curve(scored, truth, rows, [0.1, 0.5, 0.9]).collect()}
    for t, v in curve.items():
        assert v == pytest.approx(metric.macro(metric.per_row(decide.at_threshold(scored, t), truth, rows)).first()["f05"])
    best = decide.best_threshold(decide.threshold_curve(scored, truth, rows, [0.1, 0.5, 0.9])).first()
    assert best["f05"] == pytest.approx(max(curve.values()))


def test_expected_best_set(spark):
    import math

    rng = random.Random(5)
    groups = {s: sorted((round(rng.random(), 3) for _ in range(rng.randrange(1, 6))), reverse=True) for s in range(30)}
    df = spark.createDataFrame([(s, 100 * s + k, p) for s, ps in groups.items() for k, p in enumerate(ps)], "s1_gid long, s23_gid long, prob double")
    got = {}
    for r in decide.expected_best_set(df, 0.2, 0.1).collect():
        got[r["s1_gid"]] = got.get(r["s1_gid"], 0) + 1
    expected = {}
    for s, ps in groups.items():
        total, none = sum(ps) + 0.1, math.prod(max(1 - p, 1e-9) for p in ps)
        f = [(1.25 * sum(ps[: k + 1]) / (0.25 * total + k + 1), k + 1) for k in range(len(ps)) if ps[k] >= 0.2]
        if f and max(f)[0] > none:
            expected[s] = max(f)[1]
    assert got == expected


def test_rescue(spark):
    df = spark.createDataFrame([(1, 10, 0.4, "en"), (1, 11, 0.35, "en"), (2, 12, 0.4, "de"), (3, 13, 0.6, "de")], "s1_gid long, s23_gid long, prob double, country string")
    out = decide.with_rescue(df, {}, {"en": 0.3}, 0.5, 0.45).collect()
    assert {(r["s1_gid"], r["s23_gid"]) for r in out} == {(1, 10), (3, 13)}


# ---------------------------------------------------------------- labels, splits, model


def test_links_and_integrity(spark):
    truth = spark.createDataFrame([("S1-1", "S2-1,S3-1"), ("S1-2", ""), ("S1-3", "S2-1,S2-9,S2-9,"), ("S1-9", "")], "source1_entity_id string, matched_entity_ids string")
    s1 = spark.createDataFrame([("S1-1", 1, "US"), ("S1-2", 2, "US"), ("S1-3", 3, "India"), ("S1-4", 4, "US")], "entity_id string, gid long, country string")
    s23 = spark.createDataFrame([("S2-1", 10, 2, "US"), ("S3-1", 11, 3, "US")], "entity_id string, gid long, src int, country string")
    bad = {r["check"]: r["violations"] for r in labels.integrity(truth, s1, s23).collect()}
    assert bad == {"first_side_without_row": 1, "row_without_first_side": 1, "first_side_repeated": 0, "id_repeated_in_list": 1, "empty_id_in_list": 1, "unknown_second_side": 2, "second_side_linked_twice": 1, "countries_differ": 1}
    found = labels.links(truth.limit(2), s1, s23)
    assert {(r["s1_gid"], r["s23_gid"], r["s23_src"]) for r in found.collect()} == {(1, 10, 2), (1, 11, 3)}
    counts = {r["s1_gid"]: (r["n_s2"], r["n_s3"], r["n_total"], r["bucket"]) for r in labels.match_counts(found, s1).collect()}
    assert counts[1] == (1, 1, 2, "1-2") and counts[4] == (0, 0, 0, "0")


def test_split_and_stress(spark):
    counts = spark.createDataFrame([(i, f"S1-{i}", "US" if i % 2 else "India", str(i % 3)) for i in range(1200)], "s1_gid long, s1_id string, country string, bucket string")
    a = labels.split(counts)
    assert labels.strata(a).agg(F.max("off_by")).first()[0] <= 0.5
    assert labels.split_differences(a, labels.split(counts.orderBy(F.desc("s1_gid")).repartition(3))).count() == 0
    pool = lambda n1, n2: spark.createDataFrame([("US", 1)] * n1 + [("US", 2)] * n2 + [("India", 1)] * 5, "country string, src int")
    targets = labels.stress_targets(pool(10, 20), pool(10, 40))
    assert [(r["country"], r["n_hide"]) for r in targets.collect()] == [("US", 5)]
    hidden = labels.stress(a, targets)
    assert {(r["country"], r["split"]) for r in hidden.filter("stress_hidden").collect()} == {("US", "FIT")} and hidden.filter("stress_hidden").count() == 5
    assert labels.sample(counts, 7).groupBy("country").count().agg(F.max("count"), F.min("count")).first()[0:2] == (7, 7)
    assert labels.halves(counts, 10).groupBy("country", "half").count().select("count").distinct().first()[0] == 5


def test_training(spark):
    rng = random.Random(6)
    rows = [(i % 150, i, rng.random() + (i % 4 == 0), rng.random(), int(i % 4 == 0)) for i in range(1500)]
    df = spark.createDataFrame(rows, "s1_gid long, s23_gid long, a double, b double, label int")
    m = model.train(df, ["a", "b"], rounds=10, depth=3)
    p = model.predict(m, df).groupBy("label").agg(F.avg("prob")).collect()
    means = {r[0]: r[1] for r in p}
    assert means[1] - means[0] > 0.3 and model.importance(m)["a"] > model.importance(m)["b"]
    oof = model.out_of_fold(df, ["a", "b"], rounds=3, depth=2)
    assert oof.count() == df.count() and "p1" in oof.columns


def test_subsample_weights_sum_to_all(spark):
    df = spark.range(20_000).select((F.col("id") % 500).alias("s1_gid"), F.col("id").alias("s23_gid"), F.when(F.col("id") % 10 == 0, 80.0).otherwise(10.0).alias("n_tset"), F.lit(0).alias("label"))
    out = model.subsample(df)
    assert out.filter("n_tset = 80").count() == 2000 and 0.95 < out.agg(F.sum("weight")).first()[0] / 20_000 < 1.05


def test_gates_and_hashes(spark):
    g = profile.Gates()
    g.add("rows", True, 5, 5)
    g.require()
    g.add("nulls", False, 2, 0)
    with pytest.raises(AssertionError, match="nulls"):
        g.require()
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    assert profile.content_hash(df, ["id", "x"]).first() == profile.content_hash(df.repartition(5).orderBy(F.desc("id")), ["id", "x"]).first()
    nulls = [spark.createDataFrame([r], "a string, b string") for r in (("a", None), (None, "a"))]
    assert profile.content_hash(nulls[0], ["a", "b"]).first() != profile.content_hash(nulls[1], ["a", "b"]).first()
    assert profile.content_hash(df, ["id"]).first() != profile.content_hash(df.filter("id > 0"), ["id"]).first()
    assert profile.same_rows(df, df.repartition(3)) and not profile.same_rows(df, df.unionByName(df.limit(1)))
