import pytest
from pyspark.sql import functions as F

from matchloom.operators import blocking, keys
from matchloom.plans import fixture
from matchloom.plans.job import Job, StaleStageError
from matchloom.streaming import incremental


def test_end_to_end(spark, small, tmp_path):
    """Copies of documents with changed names and addresses must find their originals."""
    base = fixture.raw(spark, small).filter("country = 'en'").select("gid", "country", "business_name", F.concat(F.col("gid").cast("string"), F.lit(" "), F.col("business_address")).alias("business_address"))
    s1 = base.dropDuplicates(["business_name"]).withColumn("src", F.lit(1))
    noisy = s1.select((F.col("gid") + 10_000).alias("gid"), "country", F.concat(F.upper("business_name"), F.lit(" Ltd.")).alias("business_name"), "business_address", F.lit(2).alias("src"))
    raw = s1.unionByName(noisy)
    truth = s1.select(F.col("gid").alias("s1_gid"), (F.col("gid") + 10_000).alias("s23_gid"))
    job = Job(spark, str(tmp_path))
    out = job.train(raw, truth, rounds=3, depth=2)
    whole = next(r for r in out["report"] if r["level"] == "all")
    assert whole["f05"] > 0.9 and out["ceiling"] == 1.0 and job.done("train_features") and not job.done("nothing")
    found = {(r["s1_gid"], r["s23_gid"]) for r in job.links(raw, out["threshold"]).collect()}
    right = {tuple(r) for r in truth.collect()}
    assert len(found & right) / len(found) > 0.9 and len(found & right) / len(right) > 0.9


def test_a_stage_of_other_inputs_stops_the_run(spark, tmp_path):
    a, b = spark.range(3), spark.range(50)
    made = lambda d, *more: Job(spark, str(tmp_path)).stage("x", lambda: d, d, *more).count()
    assert made(a, 5) == 3 and made(a.repartition(3), 5) == 3
    for again in ((b, 5), (a, 6)):
        with pytest.raises(StaleStageError):
            made(*again)


def test_streamed_rows_find_the_same_candidates(spark, small, tmp_path):
    rows = fixture.cleaned(spark, small).select("gid", "src", "country", "name_tokens", "addr_components", "addr_house_number", "addr_zip")
    a, b = fixture.first_side(rows), fixture.second_side(rows)
    kinds = ("tok", "zip")
    incremental.store_index(b, kinds, str(tmp_path / "index"))
    for i in range(3):
        a.filter(F.floor(F.col("gid") / 3) % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    incremental.start(stream, kinds, str(tmp_path / "index"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), 5, once=True).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("s1_gid", "s23_gid", "rank").collect()}
    assert len(list((tmp_path / "out").iterdir())) == 3
    scored = blocking.score(keys.keys(a, kinds).withColumnRenamed("gid", "s1_gid"), keys.keys(b, kinds).withColumnRenamed("gid", "s23_gid"), blocking.rare_keys(keys.keys(b, kinds), blocking.pool_sizes(b)), kinds)
    assert got == {tuple(r) for r in blocking.top(scored, 5).select("s1_gid", "s23_gid", "rank").collect()}
