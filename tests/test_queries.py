"""Every registered query that has SQL, against DuckDB on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__
from matchloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return float(v) if isinstance(v, int) else str(v)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, small, con, name):
    df = registry.QUERIES[name](spark, small)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    out = con.execute(registry.SQL[name])
    at = [d[0] for d in out.description]
    assert sorted(at) == cols
    assert got == sorted((tuple(plain(r[at.index(c)]) for c in cols) for r in out.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql(spark, small, name):
    assert registry.QUERIES[name](spark, small).count() > 0


def test_edit_distances_against_brute_force(spark, small):
    """Of all candidates, in code points."""
    from matchloom.functions import similarity
    from matchloom.plans import fixture

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rows = registry.QUERIES["edit_distances"](spark, small).collect()
    ns = {r["gid"]: r["ns"] for r in fixture.records(spark, small).select("gid", "ns").collect()}
    assert any(not ns[r["s1_gid"]].isascii() for r in rows)
    for r in rows:
        a, b = ns[r["s1_gid"]], ns[r["s23_gid"]]
        assert r["lev"] == distance(a, b) and abs(r["jw"] - similarity.jaro_winkler(a, b)) < 1e-6


def test_entry(spark, small):
    assert __spark_entry__.entry(spark).count() == 1
    assert set(registry.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scans_are_pruned_and_filtered(spark, small):
    """The scan of a narrow query reads its columns only, and a filter reaches it."""
    from matchloom.plans import fixture

    df = fixture.raw(spark, small).filter("country = 'en'").select("gid", "business_name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan and "EqualTo(lang,en)" in plan


def test_heavy_joins_stay_in_the_jvm(spark, small):
    plan = registry.QUERIES["macro_f05"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
