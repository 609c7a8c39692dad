import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchloom.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check_sequences(rows, limit):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_encoder_equals_the_library(library):
    rng = random.Random(1)
    texts = ["", " ", "Ab, c's DON'T", "<|endoftext|> x<|startoftext|>.", "a\x1cb\x85c d", "Σας ΣΑΣ. İß", "x" * 500, "…, a… 1! 3.14", "é café", "a,b.c", "\x00"]
    texts += ["".join(rng.choice("abz .,!'s\n\t▁éΣ́12<|>% \x1f㐀İßŉſK") for _ in range(rng.randrange(80))) for _ in range(400)]
    own = packing.WordEncoder(PATH)
    for t in texts * 2:
        assert np.frombuffer(own.ids(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_plan_is_gapless_and_tight():
    rng = random.Random(2)
    for limit in (10, 64, 4096):
        histogram = {n: rng.randrange(1, 40) for n in rng.sample(range(1, limit + 1), min(limit, 60))}
        rows = packing.plan(histogram, limit)
        used, placed = {}, {}
        for length, low, high, first, each, base in rows:
            for r in range(low, high):
                used.setdefault(first + (r - low) // each, []).append((base + (r - low) % each * length, length))
                placed[length] = placed.get(length, 0) + 1
        assert placed == histogram
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= limit
        total = sum(n * c for n, c in histogram.items())
        rooms = []  # best-fit decreasing, one piece at a time
        for length in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
            fits = [k for k, room in enumerate(rooms) if room >= length]
            if fits:
                rooms[min(fits, key=lambda k: rooms[k])] -= length
            else:
                rooms.append(limit - length)
        assert -(-total // limit) <= len(used) <= len(rooms)


def test_awkward_rows(docs, library):
    rows = packing.packed(docs, PATH, with_ids=True).collect()
    check_sequences(rows, 4096)
    expected = []
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        expected += [(r["doc_id"], k, a, ids[a : a + 4096]) for k, a in enumerate(range(0, len(ids), 4096))]
    got = [(r["id"], r["piece"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and r["length"] == len(r["ids"]) // 4 for r in rows)


def test_hot_length_is_salted(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 7)
    cut = spark.createDataFrame([(i, 0, 5 if i % 3 else 6, i) for i in range(200)], "id long, piece int, length long, ids_crc32 long")
    rows = packing.pack(cut, 16).collect()
    assert len(rows) == 200 and check_sequences(rows, 16) == 78  # as best-fit decreasing has it


def test_empty_table(no_docs):
    assert packing.packed(no_docs, PATH).count() == 0


def test_query(spark, small, library):
    rows = queries.op2_packing(spark, small).collect()
    n = check_sequences(rows, 4096)
    total, expected = 0, []
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        expected += [(r["doc_id"], k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    assert n <= -(-total // 4096) + 1
