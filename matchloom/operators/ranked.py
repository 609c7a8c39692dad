"""The cut candidate lists of ``blocking`` without a shuffle of pairs.

A key with n first-side and m second-side rows makes n * m pairs, which ``blocking.score`` shuffles to add them up.
Here the first side is dealt into blocks of about ``ROWS`` rows of a country, and what is shuffled is, for every key of a
block, the block's rows and the key's second-side rows, as packed lists. A block then holds all keys of its rows,
so it adds up, ranks, cuts and joins its lists by itself. Nothing is sampled or capped beyond the keys' own caps, and
results are those of ``blocking.first_list``, ``ranked_list`` and ``union_lists``.
"""

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.ship import bounded_batches, ship
from matchloom.operators import blocking
from matchloom.operators import keys as K

#: First-side rows of a block; places of a block's sums that are held at a time (one row's at least), and pairs.
ROWS, PLACES, PAIRS = 2000, 4 << 20, 4 << 20
SEGMENT = "block long, lists binary, idf binary, n1 binary, n2 binary, s1 binary, s23 binary"
LISTS = {k: i for i, kinds in enumerate((K.FIRST_NAME_KINDS, K.FIRST_ADDRESS_KINDS, K.NAME_KINDS, K.ADDRESS_KINDS)) for k in kinds}
Cut = tuple[np.ndarray, np.ndarray, np.ndarray]


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as the byte planes of their steps: ascending lists leave most planes empty."""
    return np.diff(values.astype(np.int64), prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel(), dtype=np.int64)


def _taken(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[0], starts[0] + 1, ... of every run."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, list, idf, s1, s23) -> a segment for each block of a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, which, idf = (batch.column(i).to_numpy() for i in range(3))
        order = np.argsort(block, kind="stable")
        sides = []
        for c in (3, 4):
            at = batch.column(c).offsets.to_numpy().astype(np.int64)
            sides.append((batch.column(c).values.to_numpy(), at[:-1], np.diff(at)))
        for own in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            rows = [flat[_taken(at[own], n[own])] for flat, at, n in sides]
            data = [which[own].astype(np.uint8).tobytes(), idf[own].tobytes(), *(planes(n[own]) for _, _, n in sides), *map(planes, rows)]
            yield pa.record_batch([pa.array([block[own[0]]], pa.int64()), *(pa.array([x], pa.binary()) for x in data)], [f.split()[0] for f in SEGMENT.split(", ")])


def millionths(sums: np.ndarray) -> np.ndarray:
    """``sums`` rounded to six places as SQL does (halves up, by the shortest decimal), in millionths."""
    scaled = sums * 1e6
    out = np.floor(scaled + 0.5).astype(np.int64)
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-5):
        out[i] = int(Decimal(repr(float(sums[i]))).scaleb(6).quantize(Decimal(1), ROUND_HALF_UP))
    return out


def top(rows: np.ndarray, others: np.ndarray, scores: np.ndarray, k: int) -> tuple[Cut, np.ndarray]:
    """The best ``k`` of each row, ties by the lower other, with their ranks; ``rows`` ascend."""
    keep = np.ones(len(rows), bool)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1, [len(rows)]]) if len(rows) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a > k > 0:
            keep[a:b] = scores[a:b] >= np.partition(scores[a:b], b - a - k)[b - a - k]
    rows, others, scores = rows[keep], others[keep], scores[keep]
    order = np.lexsort((others, -scores, rows))
    rows, others, scores = rows[order], others[order], scores[order]
    first = np.searchsorted(rows, rows, "left")
    rank = np.arange(len(rows)) - first + 1
    best = rank <= k
    return (rows[best], others[best], scores[best]), rank[best]


def summed(rows: np.ndarray, keys: np.ndarray, idf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, others: np.ndarray, width: int, k: int) -> tuple[Cut, np.ndarray]:
    """The best ``k`` others of each row by the sum of the idf of the keys that they share. ``rows`` (ascending) and ``keys`` belong together; a key's others are ``others[start : start + size]``."""
    found, many = [], sizes[keys]
    bounds = np.searchsorted(rows, np.arange(rows[-1] + 2)) if len(rows) else np.zeros(1, np.int64)
    done, pairs = 0, np.concatenate([[0], np.cumsum(many)])
    while done < len(bounds) - 1:
        most = max(1, PLACES // max(1, width))
        end = min(len(bounds) - 1, done + most, max(done + 1, int(np.searchsorted(pairs[bounds], pairs[bounds[done]] + PAIRS, "right")) - 1))
        own = slice(bounds[done], bounds[end])
        at = others[_taken(starts[keys[own]], many[own])] + np.repeat((rows[own] - done) * width, many[own])
        sums = np.bincount(at, np.repeat(idf[keys[own]], many[own]), (end - done) * width)
        at = np.flatnonzero(sums)  # an idf is 1 or more
        found.append(top(done + at // width, at % width, millionths(sums[at]), k))
        done = end
    none = np.zeros(0, np.int64)
    cuts = [np.concatenate([none, *(f[0][i] for f in found)]) for i in range(3)]
    return (cuts[0], cuts[1], cuts[2]), np.concatenate([none, *(f[1] for f in found)])


def joined(lists: list[tuple[Cut, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Rows and others of any list, and each list's scores and ranks there; 0 and ``MISSING_RANK`` where it lacks the pair."""
    codes = [rows * width + others for (rows, others, _), _ in lists]
    all_codes = np.unique(np.concatenate(codes))
    columns = []
    for code, ((_, _, score), rank) in zip(codes, lists, strict=True):
        s, r = np.zeros(len(all_codes), np.int64), np.full(len(all_codes), blocking.MISSING_RANK)
        at = np.searchsorted(all_codes, code)
        s[at], r[at] = score, rank
        columns.append((s, r))
    return all_codes // max(1, width), all_codes % max(1, width), columns


def _block(parts: list[list[bytes]], ks: tuple[int, ...], k_first: int) -> pa.RecordBatch:
    """All lists of a block's rows."""
    which, idf, n1, n2, s1, s23 = (np.concatenate(x) for x in zip(*([np.frombuffer(p[0], np.uint8), np.frombuffer(p[1], np.float64), *map(unplanes, p[2:])] for p in parts), strict=True))
    gid, row = np.unique(s1, return_inverse=True)
    other_gid, other = np.unique(s23, return_inverse=True)
    key = np.repeat(np.arange(len(n1)), n1)
    order = np.argsort(row, kind="stable")
    row, key = row[order], key[order]
    starts, width = np.cumsum(n2) - n2, len(other_gid)
    lists = []
    for i, k in enumerate(ks):
        mine = which[key] == i
        lists.append(summed(row[mine], key[mine], idf, starts, n2, other, width, k))
    rows, others, ((name, _), (address, _)) = joined(lists[:2], width)
    lists = [top(rows, others, name + address, k_first), *lists[2:]]
    rows, others, columns = joined(lists, width)
    data = [x for score, rank in columns for x in (pa.array(score / 1e6), pa.array(rank.astype(np.int32)))]
    return pa.record_batch([pa.array(gid[rows]), pa.array(other_gid[others]), *data], ["s1_gid", "s23_gid", *(f"{p}_{c}" for p in ("v1", "v3", "va")[: len(columns)] for c in ("score", "rank"))])


def _lists(sides: list[tuple[DataFrame, DataFrame]], ks: tuple[int, ...], k_first: int) -> DataFrame:
    """The lists of cleaned rows and, with a second pair of sides, those of records."""
    spark = sides[0][0].sparkSession
    ship(spark)
    bounded_batches(spark)
    on = ["country", "kind", "key"]
    firsts = [s1.select("gid", "country") for s1, _ in sides]
    of = firsts[0] if len(firsts) == 1 else firsts[0].unionByName(firsts[1])
    of = of.groupBy("gid").agg(F.min("country").alias("home"))  # rows repeated under one gid are one row of the lists
    many = of.groupBy("home").agg(F.ceil(F.count("*") / ROWS).alias("parts"))
    of = of.join(F.broadcast(many), "home").select("gid", F.xxhash64("home", F.pmod(F.xxhash64("gid"), F.col("parts"))).alias("block"))
    met = None
    for (s1, s23), kinds in zip(sides, (K.FIRST_NAME_KINDS + K.FIRST_ADDRESS_KINDS, K.NAME_KINDS + K.ADDRESS_KINDS), strict=False):
        pool = K.keys(s23, kinds)
        rare = blocking.rare_keys(pool, blocking.pool_sizes(s23))
        own = K.keys(s1, kinds).join(of, "gid").join(rare, on).groupBy(*on, "block", "idf").agg(F.array_sort(F.collect_list("gid")).alias("s1"))
        others = pool.join(rare.select(*on), on, "left_semi").groupBy(*on).agg(F.array_sort(F.collect_list("gid")).alias("s23"))
        which = F.create_map(*(F.lit(x) for kv in LISTS.items() for x in kv))[F.col("kind")]
        part = own.join(others, on).select("block", which.alias("list"), "idf", "s1", "s23")
        part = part.mapInArrow(_packed, SEGMENT)
        met = part if met is None else met.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []
        for batch in batches:
            for b, *data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != block and parts:
                    yield _block(parts, ks, k_first)
                    parts = []
                block = b
                parts.append(data)
        if parts:
            yield _block(parts, ks, k_first)

    columns = ", ".join(f"{p}_score double, {p}_rank int" for p in ("v1", "v3", "va")[: len(ks) - 1])
    return met.repartition("block").sortWithinPartitions("block").mapInArrow(run, f"s1_gid long, s23_gid long, {columns}")


def first_cut(s1: DataFrame, s23: DataFrame, k_name: int = blocking.BEST_NAME, k_address: int = blocking.BEST_ADDRESS, k: int = blocking.BEST_FIRST) -> DataFrame:
    """(s1_gid, s23_gid, blocking_score, blocking_rank) of ``blocking.first_list``, down to rank ``k``."""
    return _lists([(s1, s23)], (k_name, k_address), k).withColumnsRenamed({"v1_score": "blocking_score", "v1_rank": "blocking_rank"})


def united(cleaned: tuple[DataFrame, DataFrame], records: tuple[DataFrame, DataFrame], k_name: int = blocking.BEST_NAME, k_address: int = blocking.BEST_ADDRESS, k1: int = blocking.BEST_FIRST, k3: int = blocking.BEST_V3, ka: int = blocking.BEST_VA) -> DataFrame:
    """``blocking.union_lists`` of all three lists; ``cleaned`` and ``records`` are (first side, second side)."""
    return _lists([cleaned, records], (k_name, k_address, k3, ka), k1)
