import json

import pytest
from pyspark.sql import functions as F

from matchloom.operators import profile
from matchloom.sources import guard, tsv


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "s1.tsv"
    rows = ['S1-1\tA "quoted" name\t 5 Main St\tUS', "S1-2\t\t\\N\tnull", "S1-3\tNA\t,,\tIndia", "S1-4\tहिन्दी\tx\\y\tIndia"]
    path.write_text("\t".join(tsv.RAW) + "\n" + "\n".join(rows) + "\n")
    return str(path), rows


def test_reading_is_lossless(spark, raw_file):
    path, rows = raw_file
    df = tsv.read_tsv(spark, path, tsv.RAW).orderBy("line_no")
    assert ["\t".join(r[c] for c in tsv.RAW) for r in df.collect()] == rows and [r["line_no"] for r in df.collect()] == [2, 3, 4, 5]
    with pytest.raises(tsv.BadFile):
        tsv.read_tsv(spark, path, tsv.TRUTH)


def test_bronze_numbers_run_over_files(spark, raw_file):
    path, rows = raw_file
    out = tsv.bronze(spark, {("train", 1): path, ("train", 2): path}).orderBy("gid").collect()
    assert [(r["src"], r["gid"], r["line_no"]) for r in out] == [(1, i, i + 2) for i in range(4)] + [(2, 4 + i, i + 2) for i in range(4)]


def test_file_checks(spark, raw_file, tmp_path):
    assert {r["check"]: r["violations"] for r in tsv.check_file(spark, raw_file[0], tsv.RAW).collect() if r["violations"]} == {"padded_field": 1, "quote": 1}
    bad = tmp_path / "bad.tsv"
    bad.write_bytes(b"a\tb\r\n\nx\ty\tz\0\n\xff\tq")
    found = {r["check"]: r["violations"] for r in tsv.check_file(spark, str(bad), ["a", "b"]).collect()}
    assert found["carriage_return"] == 1 and found["blank_line"] == 1 and found["nul"] == 1 and found["broken_utf8"] == 1 and found["wrong_number_of_tabs"] == 2 and found["no_final_line_feed"] == 1


def test_output_round_trip_and_checks(spark, tmp_path):
    s1 = spark.createDataFrame([(1, "S1-1"), (2, "S1-2"), (3, "S1-3")], "gid long, entity_id string")
    s23 = spark.createDataFrame([(10, "S2-9"), (11, "S3-1"), (12, "S2-10")], "gid long, entity_id string")
    links = spark.createDataFrame([(1, 10), (1, 12), (3, 11)], "s1_gid long, s23_gid long")
    rows = tsv.link_rows(links, s1, s23, s1)
    assert sorted(map(tuple, rows.collect())) == [("S1-1", "S2-10,S2-9"), ("S1-2", ""), ("S1-3", "S3-1")]
    tsv.write_tsv(rows.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text.splitlines()[0] == "source1_entity_id\tmatched_entity_ids" and '"' not in text and "S1-2\t\n" in text
    assert sorted(map(tuple, tsv.read_links(spark, str(tmp_path / "out")).collect())) == [("S1-1", "S2-10"), ("S1-1", "S2-9"), ("S1-3", "S3-1")]
    ok = tsv.check_output(rows, rows.withColumnRenamed("matched_entity_ids", "candidate_entity_ids"), s1)
    assert ok.agg(F.sum("violations")).first()[0] == 0
    broken = spark.createDataFrame([("S1-1", "S1-1,S2-9"), ("S1-1", "S2-9"), ("S1-7", "S3-4,S3-4")], "source1_entity_id string, matched_entity_ids string")
    found = {r["check"]: r["violations"] for r in tsv.check_output(broken, rows, s1).collect()}
    assert found["matches_repeated_first_side"] == 1 and found["matches_missing_first_side"] == 2 and found["matches_unknown_first_side"] == 1 and found["matches_self_match"] == 1
    assert found["matches_wrong_prefix"] == 1 and found["matches_repeated_id"] == 2 and found["match_not_among_candidates"] == 3


def test_merged_sources(spark):
    a = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.9)], "s1_gid long, s23_gid long, prob double")
    b = spark.createDataFrame([(4, 5, 0.3)], "s1_gid long, s23_gid long, prob double")
    assert sorted(tuple(r)[:2] for r in tsv.merged([(a, 0.6), (b, 0.2)]).collect()) == [(1, 3), (4, 5)]
    with pytest.raises(ValueError):
        tsv.merged([(a, 0.1), (a, 0.1)])


def test_guard(spark, tmp_path):
    split = spark.createDataFrame([(1, "FIT"), (2, "VALIDATION"), (3, "LOCKBOX")], "s1_gid long, split string")
    links = spark.createDataFrame([(i, 10 + i) for i in (1, 2, 3)], "s1_gid long, s23_gid long")
    for name, df in (("split", split), ("links", links)):
        df.write.parquet(str(tmp_path / name))
    tables = {"split": (split, ["s1_gid", "split"]), "links": (links, ["s1_gid", "s23_gid"])}
    (tmp_path / "manifest.json").write_text(json.dumps(guard.manifest(tables, True)))
    store = guard.Store(spark, str(tmp_path))
    assert [r["s23_gid"] for r in store.labels("FIT").collect()] == [11]
    with pytest.raises(guard.LockboxError):
        store.labels("VALIDATION")
    assert store.labels("VALIDATION", "matchloom.operators.metric").count() == 1
    assert store.labels("LOCKBOX", "matchloom.plans.lockbox").count() == 1
    with pytest.raises(guard.LockboxError):
        store.labels("LOCKBOX", "matchloom.plans.lockbox")
    links.limit(2).write.mode("overwrite").parquet(str(tmp_path / "links"))
    with pytest.raises(guard.IntegrityError):
        guard.Store(spark, str(tmp_path)).table("links")
    (tmp_path / "manifest.json").write_text(json.dumps(guard.manifest(tables, False)))
    with pytest.raises(guard.IntegrityError):
        guard.Store(spark, str(tmp_path))
    assert len(guard.file_sha256(str(tmp_path / "manifest.json"))) == 64


def test_hash_ignores_order(spark):
    df = spark.range(10)
    assert profile.content_hash(df, ["id"]).first() == profile.content_hash(df.orderBy(F.desc("id")), ["id"]).first()
