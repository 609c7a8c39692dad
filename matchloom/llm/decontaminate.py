"""Benchmark decontamination over a distributed positional inverted index.

``index`` stores the postings of all documents as a table of segments in the checkpoint folder: a segment
holds the terms of about ``STEP_BYTES`` of text and, for each, the ascending list of its word positions. A
document lies in one segment, so lists of a frequent word, or of a passage that a third of all documents
share, are many short ones, and no posting is shuffled.

A phrase (a window of consecutive benchmark words) is found by intersecting the lists of its terms,
shifted by their places in the phrase, from the rarest term of the segment on; proximity matches look up the nearest postings of
an item's rarest terms, which are chosen once, by counts over all documents.

The benchmark is the stated query set. It is read in blocks of at most about ``BLOCK_BYTES`` of text; a larger benchmark
takes several passes over the stored index, never over the texts, and each pass stores its matches. The driver holds one block at a time.
"""

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.durable import stored
from matchloom.llm.common import ALNUM, durable, id_text, map_batches, passing, slices

WINDOW, NEAR_TERMS, SLOP = 10, 4, 15
BLOCK_BYTES, STEP_BYTES = 8 << 20, 16 << 20


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(ALNUM).split()


class Phrases:
    """The windows and proximity sets of a block of items, as term numbers."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW, near_terms: int = NEAR_TERMS):
        self.terms: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        found: dict[tuple[int, ...], set[int]] = defaultdict(set)
        self.words: list[tuple[int, np.ndarray, int]] = []
        self.near: list[tuple[int, np.ndarray, int, int]] = []
        for name, text in items:
            w = [self.terms.setdefault(x, len(self.terms)) for x in words_of(text)]
            if w:
                self.words.append((number[name], np.array(list(dict.fromkeys(w))), len(w)))
            for k in range(max(1, len(w) - window + 1) if w else 0):
                found[tuple(w[k : k + window])].add(number[name])
        by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for w in sorted(found):
            by_length[len(w)].append(w)
        self.windows = {n: np.array(ws, np.int64) for n, ws in by_length.items()}
        self.items = {n: [sorted(found[w]) for w in ws] for n, ws in by_length.items()}
        self.near_terms = near_terms

    def choose(self, counts: np.ndarray, slop: int) -> None:
        """Which terms of every item, how many of them and how near: by the counts of all documents, and by the size of the item."""
        for item, terms, size in self.words:
            have = terms[counts[terms] > 0]
            if len(have) >= min(self.near_terms, len(terms)):
                most = len(have) if len(have) <= self.near_terms else max(self.near_terms + 1, -(-len(terms) // 4))
                rare = have[np.argsort(counts[have], kind="stable")[:most]]
                self.near.append((item, rare, len(rare) if len(rare) <= self.near_terms else -(-3 * len(rare) // 4), max(slop, size + size // 2)))


def segment(texts: list[bytes | None]) -> tuple[bytes, bytes, bytes, bytes]:
    """Words of each document, terms, postings of each term, and the positions, as they are stored; a gap follows every document."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    split = [np.fromiter(map(number.__getitem__, words_of(t)), np.int32) if t else np.zeros(0, np.int32) for t in texts]
    sizes = np.array([len(x) for x in split], np.uint32)
    flat = np.concatenate([np.zeros(0, np.int32), *split])
    at = np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes)
    places = at[np.argsort(flat, kind="stable")].astype(np.uint32)
    steps = np.diff(places, prepend=np.uint32(0))  # modulo 2 ** 32 where the next list begins
    return sizes.tobytes(), b" ".join(number), np.bincount(flat, minlength=len(number)).astype(np.uint32).tobytes(), steps.view(np.uint8).reshape(-1, 4).T.tobytes()  # small steps: planes of zeros


class Postings:
    """Positional posting lists of a stored segment, for the terms of a block of the benchmark."""

    def __init__(self, sizes: bytes, terms: bytes, counts: bytes, places: bytes, wanted: dict[bytes, int]):
        self.sizes = np.frombuffer(sizes, np.uint32).astype(np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.length = int((self.sizes + 1).sum())
        own, self.counts = term_counts(terms, counts, wanted)
        ends = np.cumsum(np.frombuffer(counts, np.uint32).astype(np.int64))
        self.ends = np.zeros(len(own), np.int64)
        self.ends[own >= 0] = ends[own[own >= 0]]
        planes = np.frombuffer(places, np.uint8).reshape(4, -1)
        self.places = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)

    def of(self, term: int) -> np.ndarray:
        return self.places[self.ends[term] - self.counts[term] : self.ends[term]].astype(np.int64)

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Places where ``terms`` stand in a row."""
        order = np.argsort(self.counts[terms], kind="stable")
        at = self.of(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(at):
                break
            more = self.of(terms[k])
            i = np.searchsorted(more, at + k)
            i[i == len(more)] = 0
            at = at[more[i] == at + k]
        return at

    def near(self, terms: np.ndarray, least: int, slop: int) -> np.ndarray:
        """Places of any of ``terms`` that have ``least`` of them within the next ``slop`` words of the same document."""
        terms = terms[self.counts[terms] > 0]
        if len(terms) < least:
            return np.zeros(0, np.int64)
        at = np.concatenate([self.of(t) for t in terms])
        doc = np.searchsorted(self.starts, at, side="right") - 1
        high = np.minimum(at + slop + 1, self.starts[doc] + self.sizes[doc])
        n = np.zeros(len(at), np.int64)
        for t in terms:
            more = self.of(t)
            n += np.searchsorted(more, at, side="left") < np.searchsorted(more, high, side="left")
        return at[n >= least]


def term_counts(terms: bytes, counts: bytes, wanted: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """For every wanted term, its number in a segment (-1: not there) and its postings."""
    own = np.full(max(1, len(wanted)), -1, np.int64)
    for k, t in enumerate(terms.split(b" ") if terms else ()):
        if (w := wanted.get(t)) is not None:
            own[w] = k
    return own, np.where(own >= 0, np.append(np.frombuffer(counts, np.uint32).astype(np.int64), 0)[own], 0)


def search(index: Postings, phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[set[int]], list[set[int]]]:
    """Per document of a segment: merged spans of words that phrases cover, items with a phrase, items nearby."""
    edges = np.zeros(index.length + 1, np.int32)
    exact: list[set[int]] = [set() for _ in index.sizes]
    near: list[set[int]] = [set() for _ in index.sizes]
    for n, windows in phrases.windows.items():
        for w in np.flatnonzero(index.counts[windows].min(axis=1) > 0):
            if len(at := index.phrase(windows[w])):
                np.add.at(edges, at, 1)
                np.add.at(edges, at + n, -1)
                for d in np.unique(np.searchsorted(index.starts, at, side="right") - 1):
                    exact[d].update(phrases.items[n][w])
    for item, rare, least, span in phrases.near:
        for d in np.unique(np.searchsorted(index.starts, index.near(rare, least, span), side="right") - 1):
            near[d].add(item)
    near = [a | b for a, b in zip(near, exact, strict=True)]  # a passage is near where it stands
    covered = np.concatenate([[0], (np.cumsum(edges[:-1]) > 0).astype(np.int8), [0]])
    turns = np.diff(covered)
    begins, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    spans: list[list[tuple[int, int]]] = [[] for _ in index.sizes]
    for d, a, b in zip(np.searchsorted(index.starts, begins, side="right") - 1, begins, ends, strict=True):
        spans[d].append((int(a - index.starts[d]), int(b - index.starts[d])))
    return spans, exact, near


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
HITS = "row long, spans array<struct<start:long,end:long>>, items array<string>, near_items array<string>"
SEGMENT = "first long, ids array<long>, sizes binary, terms binary, counts binary, places binary"


def index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", step_bytes: int = STEP_BYTES) -> DataFrame:
    """The positional index of ``df``, one row a segment; rows of ``df`` have the numbers from ``first`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        for batch in batches:
            for ids, texts in slices(batch, step_bytes):
                yield pa.record_batch([pa.array([first]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x], pa.binary()) for x in segment(texts))], ["first", "ids", "sizes", "terms", "counts", "places"])
                first += len(ids)

    return map_batches(id_text(df, id_col, text_col), run, SEGMENT)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, ids, sizes in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            yield pa.record_batch([first + np.arange(len(ids.values)), ids.values, np.frombuffer(sizes, np.uint32).astype(np.int64)], ["row", "id", "n_words"])


def found_in(segments: DataFrame, phrases: Phrases, slop: int) -> DataFrame:
    """The rows that hold something of a block of the benchmark."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(max(1, len(phrases.terms)), np.int64)
        for batch in batches:
            for terms, many in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n += term_counts(terms, many, phrases.terms)[1]
        found = np.flatnonzero(n)
        yield pa.record_batch([pa.array(found), pa.array(n[found])], ["term", "n"])

    total = np.zeros(max(1, len(phrases.terms)), np.int64)
    for term, n in map_batches(segments.select("terms", "counts"), counts, "term long, n long").groupBy("term").agg(F.sum("n")).collect():  # terms of the block
        total[term] = n
    phrases.choose(total, slop)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = phrases.names
        for batch in batches:
            for i in range(batch.num_rows):  # a segment at a time
                first, *stored = (c[i].as_py() for c in batch.columns)
                spans, exact, near = search(Postings(*stored, phrases.terms), phrases)
                hit = [k for k, x in enumerate(near) if x]
                lists = [pa.array([sorted(names[n] for n in found[k]) for k in hit], pa.list_(pa.string())) for found in (exact, near)]
                yield pa.record_batch([pa.array([first + k for k in hit], pa.int64()), pa.array([[{"start": a, "end": b} for a, b in spans[k]] for k in hit], SPANS), *lists], ["row", "spans", "items", "near_items"])

    return map_batches(segments.select("first", "sizes", "terms", "counts", "places"), hits, HITS)


def matches(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, spans, items, near_items) for every row of ``df``.

    spans are the stretches [start, end) of words covered by some benchmark window, items the ids (as
    text, sorted) of benchmark items with a window that occurs, near_items those, and
    the items most of whose rarest terms (all, of up to ``NEAR_TERMS``) stand within ``slop`` words, or one and a half times
    the item's length (a hint for paraphrases, which decides nothing). An item of
    fewer words than a window is one window; one without words matches nothing; null texts have no
    words; a null item id is written "null"; rows repeated under one id are rows of their own; very long texts are a segment of
    their own; empty tables give empty results or no matches; other columns are ignored.
    """
    segments = stored(index(df, id_col, text_col)).df
    items = durable(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")).distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    hits = None
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        phrases = Phrases(sorted((r[0], bytes(r[1])) for r in part.collect()), window)  # about block_bytes
        own = durable(found_in(segments, phrases, slop))
        hits = own if hits is None else hits.unionByName(own)
    if blocks > 1:
        listed = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        hits = hits.groupBy("row").agg(listed("spans"), listed("items"), listed("near_items")).withColumn("spans", _joined(F.col("spans")))
    rows = map_batches(segments.select("first", "ids", "sizes"), _documents, "row long, id long, n_words long")
    none = lambda c: F.coalesce(F.col(c), F.array().cast(dict(hits.dtypes)[c])).alias(c)
    return rows.join(hits, "row", "left").select("id", "n_words", none("spans"), none("items"), none("near_items"))


def without_matches(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose texts hold no window of ``benchmark``.

    Null, empty and wordless texts stay; very long ones are searched whole; of repeated rows all stay or all go; columns may have any
    names; an empty table gives an empty result. Only rows that go, and the few that share their place in a filter of fixed size, are shuffled.
    """
    rows = df.select(F.struct(*df.columns).alias("row"), F.xxhash64(text_col).alias("k"), F.col(text_col).alias("text"))
    dirty = durable(matches(rows, benchmark, window, id_col="k").filter(F.size("spans") > 0).select(F.col("id").alias("k")).distinct())
    met, clean = passing(rows.select("row", "k"), dirty)
    return clean.select("row.*").unionByName(met.join(dirty, "k", "left_anti").select("row.*"))


def _joined(spans: Column) -> Column:
    """Spans in order, those that touch or overlap made one."""
    last = lambda done: F.element_at(done, -1)
    more = lambda done, s: F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], s["end"]).alias("end"))
    add = lambda done, s: F.when(F.coalesce(F.try_element_at(done, F.lit(-1))["end"] >= s["start"], F.lit(False)), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(more(done, s)))).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"), add)


def covered_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
