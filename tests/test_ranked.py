"""Candidate lists of blocks against the lists of the pair join."""

import numpy as np
import pytest

from matchloom.operators import blocking, keys, metric, ranked
from matchloom.plans import fixture, registry


def joined_lists(c, r, k_name, k_address, k1, k3, ka):
    v3 = blocking.ranked_list(*r, keys.NAME_KINDS, k3, "v3")
    return blocking.union_lists(blocking.first_list(*c, k_name, k_address), v3, blocking.ranked_list(*r, keys.ADDRESS_KINDS, ka, "va"), k1, k3, ka)


@pytest.mark.parametrize("cuts", [(100, 50, 30, 20, 10), (2, 3, 2, 1, 1)])
def test_united_equals_the_joined_lists(spark, small, monkeypatch, cuts):
    """Ranks and scores too, with short lists (ties at the cut), rows repeated under one gid in two countries, and several blocks of a country."""
    monkeypatch.setattr(ranked, "ROWS", 7)
    fixture.fresh()

    def sides(rows):
        d = rows(spark, small)
        d = d.unionByName(d.filter("gid % 7 = 0")).unionByName(d.filter("gid % 9 = 0").replace({"en": "de"}, subset=["country"]))
        return fixture.first_side(d), fixture.second_side(d)

    c, r = sides(fixture.cleaned), sides(fixture.records)
    new = ranked.united(c, r, *cuts)
    old = joined_lists(c, r, *cuts).select(new.columns)
    got, want = sorted(map(tuple, new.collect())), sorted(map(tuple, old.collect()))
    assert got == want and len({x[0] for x in got}) > 20
    first = ranked.first_cut(*c, *cuts[:3])
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, blocking.first_list(*c, *cuts[:2]).filter(f"blocking_rank <= {cuts[2]}").select(first.columns).collect()))


def test_chunks_and_rounding(monkeypatch):
    """Any chunk gives the same list; halves are rounded up by the shortest decimal, as in SQL."""
    rng = np.random.default_rng(1)
    others = np.concatenate([np.sort(rng.choice(50, 20, replace=False)) for _ in range(10)])
    rows, key = np.repeat(np.arange(0, 18, 2), 3), rng.integers(0, 10, 27)
    args = (rows, key, 1 + rng.random(10), np.arange(0, 200, 20), np.full(10, 20), others, 50, 4)
    whole = ranked.summed(*args)
    monkeypatch.setattr(ranked, "PLACES", 50)
    apart = ranked.summed(*args)
    assert all(np.array_equal(a, b) for a, b in zip((*whole[0], whole[1]), (*apart[0], apart[1]), strict=True)) and len(whole[1]) == 36
    assert ranked.millionths(np.array([1.0000005, 1.0000015, 2.0000004, 8.1234565])).tolist() == [1000001, 1000002, 2000000, 8123457]
    assert ranked.unplanes(ranked.planes(np.array([5, 2, 9, -3, 1 << 40]))).tolist() == [5, 2, 9, -3, 1 << 40]


def test_no_pair_is_shuffled(spark, small):
    """candidates_union shuffles rows, keys and packed lists, never pairs."""
    plan = registry.QUERIES["candidates_union"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(s1_gid" not in plan and "hashpartitioning(s23_gid" not in plan


def test_training_reads_a_stored_table(spark, small):
    """gbt_score makes its pairs once, from cut lists, and not again for every step of the training."""
    plan = registry.QUERIES["gbt_score"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan and "FileScan parquet" in plan


@pytest.mark.parametrize("name", ["record_features", "number_noise_sets", "pair_flags", "number_features", "sound_features", "edit_distances"])
def test_features_read_stored_pairs(spark, small, name):
    """The candidates are a table when the features are made, and their keys and lists are in no plan of them."""
    plan = registry.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan and "WindowGroupLimit" not in plan


def test_ceiling_needs_no_shuffle_of_pairs_below_the_lists(spark, small):
    """oracle_ceiling takes its candidates from blocks: no window or sum over pairs of shared keys is left."""
    plan = registry.QUERIES["oracle_ceiling"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and "sum(idf" not in plan


def test_ceiling_lists_rows_with_links_only(spark, small, monkeypatch):
    """Rows without a true link need no lists; the score over all rows is that of the lists of all rows."""
    fixture.fresh()
    rows, truth = fixture.first_side(fixture.raw(spark, small)).selectExpr("gid as s1_gid"), fixture.truth(spark, small)
    whole = metric.macro(metric.ceiling(registry._united(spark, small), truth, rows)).selectExpr("round(f05, 9)", "n").first()
    asked, united = [], ranked.united

    def noted(*args):
        asked.extend({r[0] for r in side.select("gid").collect()} for side, _ in args[:2])
        return united(*args)

    monkeypatch.setattr(ranked, "united", noted)
    assert tuple(registry.QUERIES["oracle_ceiling"](spark, small).first()) == tuple(whole)
    links = {r[0] for r in truth.select("s1_gid").collect()}
    assert asked == [links, links] and 0 < len(links) < whole[1]
