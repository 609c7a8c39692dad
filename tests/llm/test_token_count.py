import random

import public_tokenizers
import sentencepiece

from matchloom.llm import queries, token_count

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_counter_equals_the_library():
    rng = random.Random(1)
    texts = ["", " ", "  a", "a  ", "a\n\n b  \n", "▁x ▁", "\n", " \n ", "<s> </s> <unk>", "x" * 300, "\x00a", "a" + " " * 40 + "b", " " * 33]
    texts += ["".join(rng.choice("ab .,!'s\n\t  ▁é漢12<|>% \x1f🙂") for _ in range(rng.randrange(80))) for _ in range(600)]
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    own = token_count.WholeTokens(PATH)
    assert [own.count(t) for t in texts * 2] == [len(x) for x in sp.encode(texts)] * 2


def test_proof_of_whole_tokens():
    own = token_count.WholeTokens(PATH)
    assert len(own.whole) > 10_000
    assert all(len(own.sp.encode(w)) == 1 for w in list(own.whole)[::97])


def test_awkward_rows(docs, no_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = token_count.token_counts(docs, PATH, limit=10).collect()
    expected = [(r["doc_id"], len((r["text"] or "").encode()), n, n > 10) for r in docs.collect() for n in [len(sp.encode(r["text"] or ""))]]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    assert token_count.token_counts(no_docs, PATH).count() == 0


def test_query(spark, small):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = spark.read.parquet(f"{small}/documents.parquet").collect()
    expected = sorted((r["doc_id"], len(r["text"].encode()), n, n > 4096) for r in texts for n in [len(sp.encode(r["text"]))])
    assert sorted(map(tuple, queries.op8_token_counts(spark, small).collect())) == expected
