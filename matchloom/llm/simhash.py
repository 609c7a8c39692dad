"""SimHash near-duplicate groups, with pivot distance tables.

Fingerprints of 64 bits that differ in at most ``RADIUS`` bits are linked. The links are found without
comparing all pairs:

1. *Split.* The bits are cut into ``BANDS`` bands. Two fingerprints within 3 bits agree on at least
   ``BANDS - 3`` whole bands, so they meet in the bucket of some pair of bands (10 tables for 5 bands).
   Agreeing on a band is the same as having equal distances to all references inside that band, so a
   bucket is a cell of the pivot table with coordinate difference 0.
2. *Pivot distance tables.* In a bucket, the Hamming distances of every fingerprint to ``PIVOTS``
   reference fingerprints are computed once. By the triangle inequality |d(x,p) - d(y,p)| <= d(x,y), so
   a pair whose coordinates differ by more than 3 for some reference is discarded.
3. *Verify.* The survivors' true distance decides.

A bucket of more than ``BUCKET`` distinct fingerprints isn't compared in one task: it is split again by
pairs of bands of its remaining bits, until it is small or so few bits remain that it is small by
counting (``2 ** FEW_BITS``). This is exact: nothing is capped. A bucket returns a spanning star per
local group and not its pairs; the groups are then joined by alternating large-star and small-star
rounds (public connected-components method), whose state is written to the checkpoint folder.

``one_of_each`` has settings of its own: rows go whose sets of ``SIMILAR_WORDS``-word shingles have a
Jaccard similarity of 0.8 or more. Such texts differ in about ten bits, often in more, and no
band split of 64 bits finds that radius without comparing nearly all pairs. So fingerprint links only
propose pairs there, and a prefix join proposes the rest: two sets that similar share a shingle among the first
``n - ceil(0.8 n) + 1`` of each in any common order. A pivot table of the sets discards proposed pairs by coordinate
difference, a finer sketch more of them, and every survivor is verified by its exact similarity.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.durable import Stored, stored
from matchloom.llm.common import LOWER, durable, id_text, map_batches, passing, slices, with_fields

WORDS, RADIUS, BANDS, PIVOTS, BUCKET, FEW_BITS = 3, 3, 5, 24, 2048, 11
#: Low bit of each byte: eight bit counters in one 64-bit number.
LANES = np.uint64(0x0101010101010101)
#: Near copies share SIMILAR[0] / SIMILAR[1] of the shingles of both.
SIMILAR_WORDS, SIMILAR = 5, (4, 5)
#: All texts are counted, in two tables of counters of shingles that travel in pieces, to put common shingles last; any order is exact.
SLOT_BITS, PIECE = 22, 1 << 16
#: Sets that share a prefix shingle and are compared in pairs; beyond, they meet in blocks of about two times so many shingles.
FEW, BLOCK_SHINGLES = 64, 500_000
#: Rows of the pivot table in half a block of theirs.
BLOCK_ROWS = 8192
#: References of the pivot table of sets; places of a sketch for each shingle, at least.
TABLE, SKETCH = 128, 4


def shingle_hashes(text: bytes, n: int = WORDS) -> list[int]:
    """XXH64 (seed 42) of every ``n``-word shingle; words are separated by white space of ASCII."""
    words = text.translate(LOWER).split()
    if not words:
        return []
    h = xxhash.xxh64_intdigest
    if len(words) <= n:
        return [h(b" ".join(words), 42)]
    joined, at, starts = b" ".join(words), 0, []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    return [h(joined[a : b - 1], 42) for a, b in zip(starts, [*starts[n:], at], strict=False)]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of ``hashes``: a bit is set if it is set in over half of the run."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    ends = np.cumsum(sizes[full])
    starts = ends - sizes[full]
    pieces = [np.arange(a, b, 255) for a, b in zip(starts, ends, strict=True)]  # eight-bit counters hold 255
    first = np.cumsum([0, *(len(p) for p in pieces[:-1])])
    cuts = np.concatenate(pieces)
    bits = np.zeros(len(full), np.uint64)
    for b in range(8):
        part = np.add.reduceat((hashes >> np.uint64(b)) & LANES, cuts)
        count = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for lane in range(8):
            bits |= (2 * count[:, lane] > sizes[full]).astype(np.uint64) << np.uint64(8 * lane + b)
    out[full] = bits
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp[, the columns of ``keep``]): the SimHash of every text as a signed 64-bit number. Null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, texts in slices(batch):
                hashed = [np.array(shingle_hashes(t), np.uint64) if t else np.zeros(0, np.uint64) for t in texts]
                bits = majority(np.concatenate(hashed), np.array([len(x) for x in hashed]))
                rest = [c.slice(done, len(ids)) for c in batch.columns[2:]]
                done += len(ids)
                yield pa.record_batch([ids, pa.array(bits.view(np.int64)), *rest], ["id", "fp", *keep])

    own = id_text(df, id_col, text_col, keep)
    return map_batches(own, run, with_fields("id long, fp long", own.schema.fields[2:]))


def sub_masks(mask: int) -> list[int]:
    """``mask`` joined with every choice of the bands that must stay whole, of the bits it leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    bands = [sum(1 << int(b) for b in part) for part in np.array_split(free, BANDS)]
    return [mask | sum(c) for c in combinations(bands, BANDS - RADIUS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def references(n: int = PIVOTS) -> np.ndarray:
    """Fixed pseudo-random reference fingerprints."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), 42) for i in range(n)], np.uint64)


def near_pairs(fps: np.ndarray, refs: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``radius``, by pivot table, coordinate difference and verification."""
    dist = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    order = np.argsort(dist[:, 0], kind="stable")
    fps, dist = fps[order], np.ascontiguousarray(dist[order])
    reach = np.searchsorted(dist[:, 0], dist[:, 0] + radius, side="right")
    left, right = [], []
    for i in range(len(fps) - 1):
        if (hi := reach[i]) > i + 1:
            j = np.arange(i + 1, hi)
            for c in (slice(1, 5), slice(5, None)):  # few coordinates first
                j = j[(np.abs(dist[j, c] - dist[i, c]) <= radius).all(axis=1)]
            j = j[np.bitwise_count(fps[j] ^ fps[i]) <= radius]
            left.append(np.full(len(j), i))
            right.append(j)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return order[np.concatenate(left)], order[np.concatenate(right)]


def stars(fps: np.ndarray, refs: np.ndarray) -> list[tuple[int, int]]:
    """(smallest of its group, member) for the groups that the pairs of a bucket form."""
    signed = fps.view(np.int64)
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in zip(*near_pairs(fps, refs), strict=True):
        if (a := root(i)) != (b := root(j)):
            if signed[a] > signed[b]:
                a, b = b, a
            parent[b] = a
    return [(int(signed[root(i)]), int(signed[i])) for i in range(len(fps)) if root(i) != i]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (mask, value) -> edges (hot false: a, b) and, of large buckets, rows to split (hot true: mask, value, fp)."""
    refs = references()
    held: list[np.ndarray] = []  # of the bucket that is open: key and fingerprints
    key, count, large = None, 0, False

    def out(edges=(), hot=None):
        a, b, c = ([x[0] for x in edges], [x[1] for x in edges], [0] * len(edges)) if hot is None else hot
        return pa.record_batch([pa.array([hot is not None] * len(a)), *(pa.array(x, pa.int64()) for x in (a, b, c))], ["hot", "a", "b", "c"])

    def close():
        if key is not None and not large and count > 1:
            fps = np.unique(np.concatenate(held))
            if len(fps) > 1 and (found := stars(fps.view(np.uint64), refs)):
                yield out(found)

    for batch in batches:
        mask, value, fp = (batch.column(i).to_numpy() for i in range(3))
        if not len(mask):
            continue
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(mask)]])
        lone = (ends - starts == 1) & (np.arange(len(starts)) > 0) & (np.arange(len(starts)) < len(starts) - 1)
        for s, e in zip(starts[~lone], ends[~lone], strict=True):
            this = (int(mask[s]), int(value[s]))
            if this != key:
                yield from close()
                key, held, count, large = this, [], 0, False
            held.append(fp[s:e])
            count += e - s
            if not large and count > BUCKET and 64 - bin(key[0] & (1 << 64) - 1).count("1") > FEW_BITS:
                large = True
            if large:
                rows = np.concatenate(held)
                yield out(hot=(np.full(len(rows), key[0]), np.full(len(rows), key[1]), rows))
                held = []
    yield from close()


def links(fps: DataFrame) -> DataFrame:
    """Spanning edges (a, b), a < b, of the graph of distinct fingerprints ``fp`` within the radius.

    Every bucket's local groups come as stars, so edges number at most ten for each fingerprint and level.
    """
    rows = fps.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in sub_masks(0)))).alias("mask"))
    found = None
    while True:
        keyed = rows.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("value"), "fp")
        part = keyed.repartition("mask", "value").sortWithinPartitions("mask", "value")
        level = durable(map_batches(part, _buckets, "hot boolean, a long, b long, c long"))
        edges = level.filter(~F.col("hot")).select("a", "b")
        found = edges if found is None else found.unionByName(edges)
        hot = level.filter("hot")
        masks = [r[0] for r in hot.select("a").distinct().collect()]  # at most ten times those of the level before
        if not masks:
            return found.distinct()
        narrower = F.create_map(*(x for m in masks for x in (F.lit(m), F.array(*(F.lit(_signed(s)) for s in sub_masks(m & (1 << 64) - 1))))))
        rows = hot.select(F.col("c").alias("fp"), F.explode(narrower[F.col("a")]).alias("mask"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b), the smallest node reachable."""
    edges = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = durable(small.filter("a > b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp, component_id, root[, the columns of ``keep``]) for every row of ``df``.

    component_id is the smallest id among the rows whose fingerprints can be reached over links of at
    most 3 bits; root, the smallest such fingerprint, names the group. Null or empty texts have
    fingerprint 0 and are linked like any other; rows repeated under one id stay rows; null ids are kept
    and never serve as component_id while their group has another id; an empty table gives an empty
    result. Other columns are ignored unless named in ``keep``.
    """
    docs = durable(fingerprints(df, id_col, text_col, keep))
    fps = docs.groupBy("fp").agg(F.min("id").alias("low"))
    comps = components(links(fps.select("fp"))).withColumnRenamed("node", "fp")
    linked = fps.join(comps, "fp")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    of_linked = linked.select("fp", "root").join(lows, "root").select("fp", "root", "component_id")
    by_fp = fps.join(of_linked, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return docs.join(by_fp, "fp").select("id", "fp", "component_id", "root", *keep)


def _counters(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two counters of every shingle."""
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64), ((hashes >> np.uint64(10)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


@dataclass
class Common:
    """Levels of the counters that stand out, by table: (slots, levels)."""

    tables: list[tuple[np.ndarray, np.ndarray]]

    def dense(self) -> list[np.ndarray]:
        out = [np.zeros(1 << SLOT_BITS, np.uint8) for _ in self.tables]
        for levels, (slot, level) in zip(out, self.tables, strict=True):
            levels[slot] = level
        return out


def common_shingles(df: DataFrame, text_col: str = "text") -> Common:
    """Which counters stand out over all texts. They only order the shingles: any order is exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 << SLOT_BITS, np.uint32)
        for batch in batches:
            for _, texts in slices(batch):
                for own in _sets(texts):
                    for t, slot in enumerate(_counters(own)):
                        np.add.at(counts, slot + (t << SLOT_BITS), 1)
        for at in range(0, len(counts), PIECE):
            if (piece := counts[at : at + PIECE]).any():
                yield pa.record_batch([pa.array([at]), pa.array([piece.view(np.uint8).reshape(-1, 4).T.tobytes()], pa.binary())], ["slot", "counts"])  # small counts: planes of zeros

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.ascontiguousarray(np.frombuffer(piece, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
                sums[at] = sums.get(at, 0) + own.astype(np.int64)
        for at, n in sums.items():
            often, total = np.flatnonzero(n >= 4), n.sum() if at < 1 << SLOT_BITS else 0
            yield pa.record_batch([pa.array(np.append(often + at, -1)), pa.array(np.append(n[often], total))], ["slot", "n"])

    texts = id_text(df.select(F.lit(0).alias("id"), text_col), "id", text_col)
    counts = durable(map_batches(map_batches(texts, run, "slot long, counts binary").repartition("slot"), summed, "slot long, n long"))
    mean = (counts.filter("slot < 0").agg(F.sum("n")).first()[0] or 0) / (1 << SLOT_BITS)
    least = max(4.0, 2 * mean + 4 * mean**0.5)
    got = counts.filter((F.col("slot") >= 0) & (F.col("n") >= least)).toArrow()  # under half the counters, whatever the input
    slot, n = got.column("slot").to_numpy(), got.column("n").to_numpy()
    level = np.minimum(255, np.ceil(2 * np.log2(n / least)) + 1).astype(np.uint8)
    first = slot < 1 << SLOT_BITS
    return Common([(slot[first], level[first]), (slot[~first] - (1 << SLOT_BITS), level[~first])])


def _sets(texts: list[bytes | None]) -> list[np.ndarray]:
    return [np.unique(np.array(shingle_hashes(t, SIMILAR_WORDS), np.uint64)) if t else np.zeros(0, np.uint64) for t in texts]


def _set_key(own: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(own.tobytes(), 42))


def keyed_sets(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """(id, fp, key, n, pivots, t, the columns of ``keep`` as k0, k1 ...): fingerprint, key, size and row of the pivot table of the set of shingles, and a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, texts in slices(batch):
                hashed = [np.array(shingle_hashes(t, SIMILAR_WORDS), np.uint64) if t else np.zeros(0, np.uint64) for t in texts]
                fp = majority(np.concatenate(hashed), np.array([len(x) for x in hashed]))
                own = [np.unique(x) for x in hashed]
                rest = [c.slice(done, len(ids)) for c in batch.columns[2:]]
                done += len(ids)
                yield pa.record_batch([ids, pa.array(fp.view(np.int64)), pa.array([_set_key(x) for x in own], pa.int64()), pa.array([len(x) for x in own], pa.int64()), pa.array([pivot_counts(x) for x in own], pa.binary()), *rest], ["id", "fp", "key", "n", "pivots", "t", *(f"k{i}" for i in range(len(keep)))])

    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.xxhash64(text_col).alias("t"), *(F.col(k).alias(f"k{i}") for i, k in enumerate(keep)))
    return map_batches(own, run, with_fields("id long, fp long, key long, n long, pivots binary", own.schema.fields[2:]))


def prefixes(df: DataFrame, common: Common, text_col: str) -> DataFrame:
    """(shingle, key, n): the rarest shingles of every set, as many as must hold one of any set that is similar enough. A set that comes again in a task isn't repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, seen = common.dense(), set()
        for batch in batches:
            for _, texts in slices(batch):
                first, keys, sizes = [], [], []
                for own in _sets(texts):
                    key = _set_key(own)
                    if len(own) and key not in seen:
                        seen.add(key)
                        level = np.minimum(*(t[slot] for t, slot in zip(levels, _counters(own), strict=True)))
                        first.append(own[np.argsort(level, kind="stable")][: least_prefix(len(own))].view(np.int64))
                        keys.append(key)
                        sizes.append(len(own))
                if first:
                    many = [len(x) for x in first]
                    yield pa.record_batch([np.concatenate(first), np.repeat(np.array(keys, np.int64), many), np.repeat(np.array(sizes, np.int64), many)], ["shingle", "key", "n"])

    return map_batches(id_text(df.select(F.lit(0).alias("id"), text_col), "id", text_col), run, "shingle long, key long, n long")


def least_prefix(n: int) -> int:
    """So many of the first of ``n`` shingles must share one with any set that is similar enough."""
    return n + -(SIMILAR[0] * n) // SIMILAR[1] + 1 if n else 0


def shingle_sets(df: DataFrame, text_col: str, asked: DataFrame, sketched: bool = False) -> DataFrame:
    """(key, shingles), or (key, n, sketch), of the sets of the texts whose keys are ``asked`` (k), and of a few more texts: no text is shuffled. Sets may come again, from other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, texts in slices(batch):
                own = {k: x for x in _sets(texts) if (k := _set_key(x)) not in seen}
                seen.update(own)
                keys, many = pa.array(list(own), pa.int64()), [len(x) for x in own.values()]
                if sketched:
                    yield pa.record_batch([keys, pa.array(many, pa.int64()), pa.array([sketch(x) for x in own.values()], pa.binary())], ["key", "n", "sketch"])
                else:
                    flat = np.concatenate([np.zeros(0, np.uint64), *own.values()]).view(np.int64)
                    yield pa.record_batch([keys, pa.ListArray.from_arrays(pa.array(np.cumsum([0, *many]), pa.int32()), pa.array(flat))], ["key", "shingles"])

    texts = passing(df.select(F.xxhash64(text_col).alias("k"), F.col(text_col).alias("text")), asked)[0]
    return map_batches(id_text(texts, "k", "text"), run, "key long, n long, sketch binary" if sketched else "key long, shingles array<long>")


def pivot_counts(own: np.ndarray) -> bytes:
    """A row of the pivot table: how many shingles a set shares with each of ``TABLE`` reference classes, which part all shingles (255 at most)."""
    return np.minimum(np.bincount((own >> np.uint64(20) & np.uint64(TABLE - 1)).astype(np.int64), minlength=TABLE), 255).astype(np.uint8).tobytes()


def close_in_table(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose rows of the pivot table differ by no more than similar sets can: every unit of difference is a shingle that only one of them has."""
    side = lambda c: nodes.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("pivots").alias(f"s{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, TABLE).astype(np.int16) for c in (3, 5))
            may = sum(SIMILAR) * np.abs(a - b).sum(axis=1) <= (SIMILAR[1] - SIMILAR[0]) * (na + nb)
            yield batch.select([0, 1]).filter(pa.array(may))

    return map_batches(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "sa", "nb", "sb"), run, "a long, b long")


def sketch(own: np.ndarray) -> bytes:
    """Which of at least ``SKETCH`` times as many places, a power of two, the shingles of a set take."""
    size = 1 << max(6, (SKETCH * len(own) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(own & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def most_shared(na: int, a: bytes, nb: int, b: bytes) -> int:
    """No less than the shingles that two sets share: a place that only one of them takes holds a shingle that the other lacks."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(v.reshape(-1, size)) for v in (x, y))
    return min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))


def sketched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that their sketches don't rule out."""
    side = lambda c: sets.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
            may = [SIMILAR[1] * (m := most_shared(na, a, nb, b)) >= SIMILAR[0] * (na + nb - m) for na, a, nb, b in rows]
            yield batch.select([0, 1]).filter(pa.array(may, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "sa", "nb", "sb")
    return map_batches(joined, run, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough."""
    side = lambda c: sets.select(F.col("key").alias(c), F.col("shingles").alias(f"s{c}"))
    d = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    return d.filter(SIMILAR[1] * F.col("both") >= SIMILAR[0] * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b").distinct()


def near_in_table(sizes: np.ndarray, roots: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which sets have another of a different root whose size and row of the pivot table don't rule the pair out.

    Only sets outside the most frequent root look for others, as two sets of one root need no link.
    """
    order = np.argsort(sizes, kind="stable")
    n, r, t = sizes[order], roots[order], table[order].astype(np.int16)
    own, inverse = np.unique(r, return_inverse=True)
    near = np.zeros(len(n), bool)
    low = np.searchsorted(n, -(-SIMILAR[0] * n // SIMILAR[1]), "left")
    high = np.searchsorted(n, SIMILAR[1] * n // SIMILAR[0], "right")
    for i in np.flatnonzero(inverse != np.bincount(inverse).argmax()) if len(own) > 1 else ():
        at = slice(low[i], high[i])
        apart = np.abs(t[at] - t[i]).sum(axis=1)
        may = (sum(SIMILAR) * apart <= (SIMILAR[1] - SIMILAR[0]) * (n[at] + n[i])) & (r[at] != r[i])
        near[at] |= may
        near[i] |= may.any()
    out = np.zeros(len(n), bool)
    out[order] = near
    return out


def _table_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, cell, key, root, n, pivots), sorted by block -> (cell, key) of the sets that ``near_in_table`` keeps. Only the open block is held."""
    block, held = None, []

    def close():
        if held:
            cells, keys, roots, sizes, rows = (np.concatenate(x) for x in zip(*held, strict=True))
            if (near := near_in_table(sizes, roots, rows)).any():
                yield pa.record_batch([cells[near], keys[near]], ["cell", "key"])

    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, *rest = (batch.column(i).to_numpy() for i in range(5))
        rest.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(-1, TABLE))
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1), len(blocks)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if blocks[a] != block:
                yield from close()
                block, held = blocks[a], []
            held.append([x[a:b] for x in rest])
    yield from close()


def block_links(keys: list[int], roots: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning links between the sets of a block that are similar enough and whose roots differ.

    Sets of one root are one group from the start. Every set outside the largest group is compared with all others, by counting
    through an index of the block's shingles, until its group has joined the largest.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    groups = Counter(roots)
    largest, found = groups.most_common(1)[0][0], []
    for i in sorted(range(len(sets)), key=lambda i: (groups[roots[i]], roots[i])):
        if root(roots[i]) == root(largest):
            continue
        low, high = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        many = high - low
        at = np.arange(many.sum()) + np.repeat(low - (np.cumsum(many) - many), many)
        both = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero(SIMILAR[1] * both >= SIMILAR[0] * (sizes + sizes[i] - both)):
            if (a := root(roots[i])) != (b := root(roots[j])):
                parent[a] = b
                found.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
    return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, key, root, shingles), sorted by cell and key -> links. Only the open cell is held."""
    cell, keys, roots, sets = None, [], [], []

    def close():
        if len(set(roots)) > 1 and (found := block_links(keys, roots, sets)):
            yield pa.record_batch([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    for batch in batches:
        for c, k, r, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            if c != cell:
                yield from close()
                cell, keys, roots, sets = c, [], [], []
            if not keys or keys[-1] != k:  # a set may come again
                keys.append(k)
                roots.append(r)
                sets.append(own.values.to_numpy().view(np.uint64))
    yield from close()


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, root[, the columns of ``keep``]) for every row of ``df``; root names the group of texts that exact links of similarity reach.

    Equal sets are one node; wordless texts are one group. Links are found in three steps, each without all pairs:

    1. Pairs proposed by fingerprints, and by the least set of every shared prefix shingle with each other set of it, join most near copies.
    2. Of prefix shingles that at most ``FEW`` sets share, the pairs that step 1 leaves in different groups.
    3. The sets of a more frequent prefix shingle that step 1 leaves in several groups meet in blocks of bounded size: first only
       their rows of the pivot table, which leave the sets that may have a partner in another group; then the whole sets of
       these. A block returns spanning links. Of shingles that the same sets share one is enough.
    """
    own = tuple(f"k{i}" for i in range(len(keep)))
    rows = durable(keyed_sets(df, id_col, text_col, keep))
    nodes = durable(rows.groupBy("key").agg(F.min(F.struct("n", "fp", "t", "pivots")).alias("s")).select("key", "s.n", "s.fp", "s.t", "s.pivots"))
    entries = prefixes(df, common_shingles(df, text_col), text_col).repartition("shingle")
    least = entries.groupBy("shingle").agg(F.min(F.struct("key", "n")).alias("low"), F.max("key").alias("high")).filter("low.key < high")
    signs = stored(entries.join(least, "shingle").select("shingle", "key", "n", F.col("low.key").alias("low"), F.col("low.n").alias("low_n")).distinct())

    def fit(d: DataFrame) -> DataFrame:
        return d.filter((F.col("a") != F.col("b")) & (SIMILAR[1] * F.least("na", "nb") >= SIMILAR[0] * F.greatest("na", "nb")))

    def met(d: DataFrame) -> DataFrame:
        """Pairs that share so many prefix shingles that all shingles behind a prefix could make up the rest."""
        behind = lambda c: F.ceil(F.col(c) * SIMILAR[0] / SIMILAR[1]) - 1
        found = fit(d).groupBy("a", "b").agg(F.count("*").alias("hits"), F.first("na").alias("na"), F.first("nb").alias("nb"))
        return found.filter(sum(SIMILAR) * (F.col("hits") + F.greatest(behind("na"), behind("nb"))) >= SIMILAR[0] * (F.col("na") + F.col("nb"))).select("a", "b")

    def sets_of(keys: DataFrame, sketches: bool = False) -> Stored:
        return stored(shingle_sets(df, text_col, nodes.join(keys, "key", "left_semi").select(F.col("t").alias("k")), sketches))

    def compared(pairs: DataFrame) -> DataFrame:
        pairs = durable(close_in_table(pairs, nodes))
        for check, kind in ((sketched, True), (verified, False)):
            sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), kind)
            pairs = durable(check(pairs, sets.df))
            sets.remove()
        return pairs

    named = lambda c: nodes.groupBy("fp").agg(F.min(F.struct("key", "n")).alias("s")).select(F.col("fp").alias(f"f{c}"), F.col("s.key").alias(c), F.col("s.n").alias(f"n{c}"))
    linked = links(nodes.filter("n > 0").select("fp").distinct()).toDF("fa", "fb")
    by_link = linked.join(named("a"), "fa").join(named("b"), "fb").select("a", "na", "b", "nb")
    same_fp = nodes.select(F.col("fp").alias("fa"), F.col("key").alias("b"), F.col("n").alias("nb")).join(named("a"), "fa").select("a", "na", "b", "nb")
    by_sign = signs.df.select(F.col("low").alias("a"), F.col("low_n").alias("na"), F.col("key").alias("b"), F.col("n").alias("nb"))
    proposed = fit(by_link.unionByName(same_fp)).select("a", "b").unionByName(met(by_sign))
    tried = durable(proposed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    edges = compared(tried)

    comps = components(edges).withColumnRenamed("node", "key")
    left = signs.df.join(comps, "key", "left").select("shingle", "key", "n", "low", F.coalesce("root", "key").alias("root"))
    split = left.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("c")).filter("x < y").select("shingle", "c")
    open_ = stored(left.join(split, "shingle"))
    signs.remove()

    side = lambda c: open_.df.filter(F.col("c") <= FEW).select("shingle", F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("root").alias(f"r{c}"))
    apart = side("a").join(side("b"), "shingle").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")))
    more = durable(met(apart).join(tried, ["a", "b"], "left_anti"))
    edges = edges.unionByName(compared(more))

    def cells(d: DataFrame, parts: Column) -> DataFrame:
        """Rows (cell, key, root, n) of one of the cells that the same sets share, and into how many parts it is cut."""
        alike = d.groupBy("cell").agg(F.count("*").alias("m"), F.sum(F.xxhash64("key").cast("decimal(20,0)")).alias("h"), F.ceil(parts).alias("parts"))
        return d.join(alike.groupBy("m", "h").agg(F.min(F.struct("cell", "parts")).alias("s")).select("s.cell", "s.parts"), "cell")

    def meeting(d: DataFrame) -> DataFrame:
        """Every row once for each block of its cell: of the parts every two are a block."""
        at = d.withColumn("p", F.pmod(F.xxhash64("key"), F.col("parts")))
        others = F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda q: q != F.col("p")))
        return at.select("cell", "key", "root", "n", "p", F.explode(others).alias("q")).select("cell", "key", "root", "n", F.xxhash64("cell", F.least("p", "q"), F.greatest("p", "q")).alias("block"))

    members = durable(cells(open_.df.filter(F.col("c") > FEW).select(F.col("shingle").alias("cell"), "key", "root", "n"), F.count("*") / BLOCK_ROWS))
    open_.remove()
    rows_met = meeting(members).join(nodes.select("key", "pivots"), "key").select("block", "cell", "key", "root", "n", "pivots").repartition("block").sortWithinPartitions("block")
    near = map_batches(rows_met, _table_blocks, "cell long, key long").distinct()
    members = durable(cells(durable(members.drop("parts").join(near, ["cell", "key"])), F.sum("n") / BLOCK_SHINGLES))
    sets = sets_of(members.select("key").distinct())
    held = meeting(members).join(sets.df, "key").select("block", "key", "root", "shingles").repartition("block").sortWithinPartitions("block", "key")
    edges = edges.unionByName(durable(map_batches(held, _blocks, "a long, b long")))
    sets.remove()
    comps = components(edges).withColumnRenamed("node", "key")
    return rows.join(comps, "key", "left").select("id", F.coalesce("root", "key").alias("root"), *(F.col(k).alias(name) for k, name in zip(own, keep, strict=True)))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, without all but one of each group of ``similar_groups``: the one of the smallest id stays.

    Of rows that share id and text one stays; a group whose rows all lack an id keeps one of them. Null and wordless
    texts are one group; very long texts are compared whole; columns may have any names; an empty table gives an empty
    result. Only rows of groups of several rows, and the few that share their place in a filter of fixed size, are shuffled.
    """
    names = df.columns
    plain = df.select(F.struct(*names).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("k"))
    found = durable(similar_groups(plain, "id", "text", ("k",)))
    several = found.groupBy("root").agg(F.count("*").alias("c"), F.min(F.struct(F.col("id").isNull(), "id", "k")).alias("s")).filter("c > 1")
    several = durable(several)
    stays = several.select(F.coalesce("s.id", F.lit(0)).alias("row_id"), F.col("s.id").isNull().alias("lacks_id"), F.col("s.k").alias("k"))
    met, alone = passing(plain, found.join(several, "root", "left_semi").select("k"))
    others = met.select("row", F.coalesce("id", F.lit(0)).alias("row_id"), F.col("id").isNull().alias("lacks_id"), "k")
    whole = found.join(several, "root", "left_anti").select(F.coalesce("id", F.lit(0)).alias("row_id"), F.col("id").isNull().alias("lacks_id"), "k")
    return alone.select("row.*").unionByName(others.join(stays.unionByName(whole), ["row_id", "lacks_id", "k"], "left_semi").dropDuplicates(["row_id", "lacks_id", "k"]).select("row.*"))
