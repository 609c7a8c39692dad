"""What Python workers hold from step to step."""

import numpy as np
import pyarrow as pa

from matchloom.llm import common, packing, quality


def test_another_module_empties_what_is_kept(monkeypatch):
    """A change of modules empties caches; tasks of one module, and its other steps, keep them."""
    monkeypatch.setattr(common, "_last", [])
    common.begin("matchloom.llm.quality", "scored")
    quality.features(b"some words", None)
    packing._encoders["x"] = None
    assert quality._buckets
    common.begin("matchloom.llm.quality", "scored")
    common.begin("matchloom.llm.quality", "learn")
    assert quality._buckets and not packing._encoders
    common.begin("matchloom.llm.simhash", "prefixes")
    assert not quality._buckets


def test_steps_begin_in_workers(spark):
    """A worker that has scored texts holds no words of theirs when a step of another module runs in it."""

    def held(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([len(quality._buckets)] * batch.num_rows, pa.int64())], ["n"])

    docs = spark.createDataFrame([(i, f"word{i} and more", 5) for i in range(20)], "doc_id long, text string, n_chars long").repartition(2)
    machine = quality.Machine(0.0, np.zeros(quality.BUCKETS + 24), np.zeros((quality.BUCKETS + 24, 1)), np.zeros(24), np.ones(24))
    for _ in range(3):
        assert quality.scored(docs, machine).count() == 20
        assert {r[0] for r in common.map_batches(docs, held, "n long").collect()} == {0}
