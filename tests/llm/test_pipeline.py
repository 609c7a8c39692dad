import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchloom.llm import quality, queries, secrets
from tests.llm.test_decontaminate import brute as brute_matches
from tests.llm.test_packing import check_sequences
from tests.llm.test_simhash import similar_roots


def test_stages_against_brute_force(spark, small):
    """Every stage on its own input, and the whole run."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels = [r for r in spark.read.parquet(f"{small}/labels.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    df = docs
    stages = [f for _, f in corpus_pipeline.STAGES]

    machine = quality.learn(docs, spark.createDataFrame(labels))
    df = stages[0](spark, df, small)
    assert df.columns == docs.columns
    rows = {i: r for i, r in rows.items() if machine.margin(*quality.features(r["text"].encode(), r["n_chars"])) >= 0}
    assert {r["doc_id"]: r for r in df.collect()} == rows and 0 < len(rows) < docs.count()

    df = stages[1](spark, df, small)
    root = similar_roots({i: r["text"] for i, r in rows.items()})
    assert 0 < len(set(root.values())) < len(rows)
    rows = {i: rows[i] for i in set(root.values())}
    assert {r["doc_id"]: r for r in df.collect()} == rows

    df = stages[2](spark, df, small)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = {i: r for i, r in rows.items() if not brute_matches(r["text"], items)[1]}
    assert {r["doc_id"]: r for r in df.collect()} == rows

    df = stages[3](spark, df, small)
    guess = secrets.Guesser(tuple(map(public_tokenizers.path, queries.WORD_VOCABULARIES)))
    texts = {i: secrets.redact(r["text"], [(a, b) for a, _, b, _ in secrets.scan(r["text"], guess)]) for i, r in rows.items()}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in df.collect()} == {i: (t, len(t)) for i, t in texts.items()}

    library, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, t in texts.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        expected += [(i, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    for out in (stages[4](spark, df, small).collect(), corpus_pipeline.run(spark, small).collect()):
        assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == sorted(expected)
        check_sequences(out, 4096)


@pytest.mark.parametrize("k", range(4))
def test_stages_take_awkward_rows(spark, docs, no_docs, small, k):
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, docs, small).columns == docs.columns
    stage(spark, docs, small).collect()
    assert stage(spark, no_docs, small).count() == 0
