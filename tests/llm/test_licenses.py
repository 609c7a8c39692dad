import random

import numpy as np

from matchloom.llm import licenses, queries


def shingle_set(text):
    return set(licenses.shingles(licenses.word_hashes((text or "").encode())).tolist())


def brute(text, templates=licenses.TEMPLATES):
    """Names of templates of which some stretch of the template's group window holds the share; by all windows, without bands."""
    h = licenses.shingles(licenses.word_hashes((text or "").encode()))
    found = set()
    for g in licenses.groups(templates):
        for name, own in zip(g.names, g.sets):
            for a in range(0, len(h), 1):
                part = h[a : a + g.blocks * g.step]
                if len(np.intersect1d(part, own)) / len(own) >= licenses.CONTAINMENT:
                    found.add(name)
                    break
    return found


def test_every_template_is_found_wherever_it_starts():
    rng = random.Random(1)
    groups = licenses.groups(licenses.TEMPLATES)
    noise = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    texts = [f"{noise(a)} {t} {noise(30)}" for t in licenses.TEMPLATES.values() for a in range(0, 40, 3)]
    names = [n for n in licenses.TEMPLATES for _ in range(0, 40, 3)]
    for n, found in zip(names, licenses.scan([t.encode() for t in texts], groups), strict=True):
        assert n in {s["license"] for s in found}


def test_damaged_templates():
    rng = random.Random(2)
    groups = licenses.groups(licenses.TEMPLATES)
    texts = []
    for t in list(licenses.TEMPLATES.values()) * 12:
        words = t.split()
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(["changed", "", "x y"])
        texts.append(f"before it {' '.join(words)} after it and so on")
    missed = extra = 0
    for t, found in zip(texts, licenses.scan([t.encode() for t in texts], groups), strict=True):
        names = {s["license"] for s in found}
        missed += len(brute(t) - names)
        extra += len(names - brute(t))
    assert extra == 0 and missed <= 1  # windows start at blocks, and a shared band is very likely but not certain


def test_band_settings_guarantee_the_chance():
    for g in licenses.groups(licenses.TEMPLATES):
        window, t = g.blocks * g.step, max(len(s) for s in g.sets)
        lowest = min((c := int(np.ceil(licenses.CONTAINMENT * len(s)))) / (window + len(s) - c) for s in g.sets)
        assert window >= t + g.step - 1 and 1 - (1 - lowest**g.rows) ** g.bands >= licenses.LEAST_CHANCE


def test_awkward_rows(spark, docs, no_docs):
    assert licenses.license_spans(docs).count() == docs.count() and licenses.license_spans(no_docs).count() == 0
    assert all(r["spans"] == [] for r in licenses.license_spans(docs).collect())
    df = spark.createDataFrame([(1, "Released under the MIT License. " * 3), (2, "x " * 50_000 + "Licensed under CC BY-NC 4.0."), (3, None)], "doc_id long, text string")
    rows = {r["id"]: r["spans"] for r in licenses.license_spans(df).collect()}
    assert [s["license"] for s in rows[1]] == ["MIT"] * 3 and [s["start"] for s in rows[1]] == [0, 5, 10]
    assert [s["license"] for s in rows[2]] == ["CC-BY-NC-4.0"] and rows[3] == []


def test_query(spark, small):
    rows = {r["doc_id"]: set(filter(None, r["licenses"].split(","))) for r in queries.op4_licenses(spark, small).collect()}
    assert rows == {r["doc_id"]: brute(r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def test_edited_notices_do_not_depend_on_what_stands_before():
    own = licenses.groups(licenses.TEMPLATES)
    for name, inserted in (("MPL-2.0-notice", 8), ("ISC-permission", 12)):
        w = licenses.TEMPLATES[name].split()
        text = " ".join([*w[: len(w) // 2], *(f"zz{i}" for i in range(inserted)), *w[len(w) // 2 :]]).encode()
        for before in range(12):
            first = " ".join(f"y{i}" for i in range(before + 5)).encode()
            assert [s["license"] for s in licenses.scan([first, text, b"and some more words behind it"], own)[1]] == [name], (name, before)
            assert licenses.scan([first, text], own)[1] == licenses.scan([text], own)[0]
