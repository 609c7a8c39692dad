"""Counts of common shingles."""

import numpy as np
from pyspark.sql import functions as F

from matchloom.llm import simhash


def test_every_text_is_counted(spark):
    """Each of 64 shingles that ten rows hold stands out in both tables, whatever the hash of its text."""
    texts = [f"one two three four w{i}" for i in range(64)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(10)))).select("text").repartition(3)
    slots = simhash._counters(np.concatenate(simhash._sets([t.encode() for t in texts])))
    found = simhash.common_shingles(df).tables
    for (slot, level), want in zip(found, slots, strict=True):
        assert set(slot.tolist()) == set(want.tolist()) and level.min() >= 1


def test_no_text_at_all(spark):
    assert all(len(slot) == 0 for slot, _ in simhash.common_shingles(spark.createDataFrame([], "text string")).tables)
