"""Best-fit packing of token pieces into fixed-length sequences, planned on the length histogram.

1. Every text becomes token ids and an end id; longer ones are cut into full pieces and a rest.
2. The histogram of piece lengths (one row for each length up to the limit, however many documents) goes
   to the driver, where best-fit decreasing runs on *counts*: all pieces of a length fill all open
   sequences of the tightest room at once. The plan says, for runs of ranks within a length, in which
   sequences and at which offset they go.
3. Pieces take a rank within their length (salted, so that no task sorts a whole hot length) and join
   the plan on length and rank.
"""

import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchloom.llm.common import durable, id_text, kept, map_batches, slices

LIMIT, END_ID, CACHE, LONGEST_CACHED = 4096, 1, 800_000, 64
#: Punctuation that is cut off a chunk: a run of it after letters is a pre-token.
TAIL = b".,;:!?|%$#*&)"
#: Rows that take their ranks in one group.
GROUP_ROWS = 20_000
PLAN = "length long, low long, high long, first long, each long, base long"
_encoders: dict[str, "WordEncoder"] = kept(__name__)


class WordEncoder:
    """Ids (as little-endian unsigned 32-bit numbers) of whole texts for a tokenizer that drops white space.

    Its pre-tokens never span white space, so a text's ids are those of its white-space chunks in a row,
    and each distinct chunk is encoded once while it stays in a bounded cache. A chunk of Latin letters,
    perhaps with plain punctuation after them, is one pre-token or two and goes to the merges
    directly; any other chunk passes through the library's whole pipeline.
    """

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cache: dict[bytes, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte alphabet of byte-level vocabularies
        sign = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.alphabet = {b: sign[b] for b in range(256)}  # from Latin-1 characters
        self.merge = self.tok.model.tokenize
        probe = "Ab, c's\nÉl1ève!!\t<|x|> d Thinking, ñandú"
        if self.tok.encode(probe, add_special_tokens=False).ids != [i for w in probe.split() for i in np.frombuffer(self._new(w.encode()), "<u4")]:
            raise ValueError("the tokenizer isn't a byte-level BPE with word ends that drops white space")

    def _merged(self, pretoken: bytes) -> bytes:
        found = self.merge(pretoken.decode("latin-1").translate(self.alphabet))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def _new(self, chunk: bytes) -> bytes:
        """Ids of a chunk that isn't in the cache."""
        if len(chunk) > LONGEST_CACHED:
            return self._library(chunk)
        rest = chunk.rstrip(TAIL)
        if rest.isalpha():  # of ASCII
            low = rest.lower()
        else:
            word = rest.decode("utf-8", "replace")
            text = word.lower()
            if not (text.isalpha() and word.isalpha() and max(text) < "\u0250" and max(word) < "\u0250"):
                self.cache[chunk] = ids = self._library(chunk)
                return ids
            low = text.encode()
        cache = self.cache
        if (ids := cache.get(low)) is None:
            cache[low] = ids = self._merged(low)
        if len(rest) < len(chunk):
            tail = chunk[len(rest) :]
            if (more := cache.get(tail)) is None:
                cache[tail] = more = self._merged(tail)
            ids += more
        cache[chunk] = ids
        return ids

    def _library(self, chunk: bytes) -> bytes:
        return np.array(self.tok.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: bytes) -> bytes:
        words = text.split()
        if len(self.cache) > CACHE:
            self.cache.clear()
        found = list(map(self.cache.get, words))
        if None in found:
            get, new = self.cache.get, self._new
            found = [x if x is not None else get(w) or new(w) for x, w in zip(found, words, strict=True)]
        return b"".join(found)


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(df: DataFrame, vocabulary: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the pieces of every text's ids and end id."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary)
        for batch in batches:
            for ids, texts in slices(batch):
                cols: tuple[list, ...] = ([], [], [], [], [], [])
                for i, tokens in zip(ids.to_pylist(), texts, strict=True):
                    tokens = (e.ids(tokens) if tokens else b"") + end
                    for k, a in enumerate(range(0, len(tokens), 4 * limit)):
                        own = tokens[a : a + 4 * limit]
                        for c, x in zip(cols, (i, k, a // 4, len(own) // 4, zlib.crc32(own), own), strict=True):
                            c.append(x)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(c, k) for c, k in list(zip(cols, kinds, strict=True))[: len(names)]], names)

    return map_batches(id_text(df, id_col, text_col), run, "id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, low, high, first, each, base).

    The pieces of ``length`` with rank r in low <= r < high go to sequence ``first + (r - low) // each``
    at offset ``base + (r - low) % each * length``. A run of equal sequences is handled as one, so the plan
    grows with the lengths and not with the pieces.
    """
    rows, opened = [], 0
    rooms: dict[int, list[tuple[int, int]]] = {}  # room left: runs (first sequence, count)
    order: list[int] = []  # heap of rooms

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                heapq.heappush(order, room)
            rooms[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, low = histogram[length], 0
        fits = sorted(r for r in rooms if r >= length)

        def fill(room: int, first: int, count: int, length: int = length) -> int:
            """Pieces put into a run of sequences; the rest of the run keeps its room."""
            nonlocal left, low
            each = room // length
            take = min(left, count * each)
            whole, part = divmod(take, each)
            if whole:
                rows.append((length, low, low + whole * each, first, each, limit - room))
                put(room - each * length, first, whole)
            if part:
                rows.append((length, low + whole * each, low + take, first + whole, each, limit - room))
                put(room - part * length, first + whole, 1)
            put(room, first + whole + bool(part), count - whole - bool(part))
            low, left = low + take, left - take
            return take

        for room in fits:
            if not left:
                break
            for first, count in rooms.pop(room):
                if left:
                    fill(room, first, count)
                else:
                    put(room, first, count)
        if left:
            count = -(-left // (limit // length))
            first, opened = opened, opened + count
            fill(limit, first, count)
    return rows


def pack(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``cut`` (id, piece, length, ...) with sequence_id and offset."""
    spark = cut.sparkSession
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # a row for each length at most
    if not histogram:
        return cut.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    slots = spark.createDataFrame(plan(histogram, limit), PLAN)  # its size follows the limit, not the rows
    salts = {n: 1 + c // GROUP_ROWS for n, c in histogram.items() if c >= GROUP_ROWS}
    groups = F.lit(1)
    if salts:
        groups = F.coalesce(F.create_map(*(F.lit(x).cast("long") for kv in salts.items() for x in kv))[F.col("length")], F.lit(1).cast("long"))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), groups))
    own = Window.partitionBy("length", "salt").orderBy("id", "piece")
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.select("length", "salt", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = salted.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.row_number().over(own) - 1)
    p, s = ranked.alias("p"), F.broadcast(slots).alias("s")
    found = p.join(s, (F.col("p.length") == F.col("s.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    at = F.col("rank") - F.col("low")
    return found.select("p.*", (F.col("first") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"), (F.col("base") + at % F.col("each") * F.col("s.length")).alias("offset")).drop("salt", "before", "rank")


def packed(df: DataFrame, vocabulary: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset) for every piece of every text.

    A null or empty text is the end id alone; very long texts are cut at ``limit`` and nowhere else; rows
    repeated under one id (also a null one) are packed each; an empty table gives an empty result; other
    columns are ignored. Pieces are tokenized once, into the checkpoint folder.
    """
    return pack(durable(pieces(df, vocabulary, limit, end_id, with_ids, id_col, text_col)), limit)
