"""Shared pieces of the text operators."""

import ctypes
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.durable import durable, shared_dir  # noqa: F401
from matchloom.functions.ship import bounded_batches, ship

#: Byte table that lower-cases A-Z and leaves every other byte alone.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: As LOWER, but every byte outside 0-9, A-Z, a-z and 0x80-0xFF becomes a space.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of text that one step of a vectorised kernel takes at a time (a longer text is a step of its own).
SLICE_BYTES = 4 << 20
#: Bits of the filter of ``passing``.
ASKED_BITS = 22
#: What a Python worker keeps from task to task, by the module that keeps it.
KEPT: defaultdict[str, list[dict]] = defaultdict(list)
_last: list[tuple[str, str]] = []


def kept(module: str) -> dict:
    """An empty dict that lasts from task to task, until the worker runs a step of another module."""
    KEPT[module].append({})
    return KEPT[module][-1]


def begin(module: str, step: str) -> None:
    """Called in a worker before each task: at a change of steps, memory that the last one has freed goes back, and with another module what the others keep.

    Spark runs the steps of all queries in the same workers, which would hold the most that any step has needed.
    """
    if _last == [(module, step)]:
        return
    _last[:] = [(module, step)]
    for other, held in KEPT.items():
        if other != module:
            for d in held:
                d.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` after the package has been shipped, in batches that fit long texts unless the session sets its own."""
    ship(df.sparkSession)
    bounded_batches(df.sparkSession)
    module, step = fn.__module__, fn.__qualname__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(module, step)
        yield from fn(batches)

    return df.mapInArrow(run, schema)


def with_fields(ddl: str, fields: list[T.StructField]) -> T.StructType:
    """The fields of ``ddl`` and then ``fields``."""
    return T.StructType([*T.StructType.fromDDL(ddl).fields, *fields])


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """What text operators read, under fixed names: id, text (as UTF-8 bytes, null stays null), and columns to pass on."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"), *keep)


def crc32_of_id(col: Column) -> Column:
    return F.crc32(col.cast("string").cast("binary"))


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    """(ids, texts) of consecutive rows whose texts hold about ``most`` bytes together."""
    ids, texts = batch.column(0), batch.column(1)
    first, size = 0, 0
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield ids.slice(first, i - first), texts.slice(first, i - first).to_pylist()
            first, size = i, 0
        size += int(n)
    if first < len(lengths):
        yield ids.slice(first), texts.slice(first).to_pylist()


def passing(df: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` that a filter of fixed size over ``keys`` (k) lets through, which are all whose k is among them and a few more; and the others."""
    bits = filter_bits(keys)
    table = df.sparkSession.createDataFrame([(i, bytes(bits[i * 4096 : i * 4096 + 4096])) for i in range(len(bits) // 4096)], "piece long, bits binary")  # 512 KB
    names = df.columns
    asked = F.expr(f"shiftright(cast(conv(hex(substring(bits, cast(pmod(k, {1 << ASKED_BITS}) % 32768 div 8 as int) + 1, 1)), 16, 10) as int), cast(pmod(k, 8) as int)) & 1")
    marked = df.withColumn("piece", F.floor(F.pmod(F.col("k"), F.lit(1 << ASKED_BITS)) / 32768)).join(F.broadcast(table), "piece").withColumn("asked", asked)
    return marked.filter("asked = 1").select(*names), marked.filter("asked = 0").select(*names)


def filter_bits(keys: DataFrame) -> np.ndarray:
    """A filter of fixed size over ``keys`` (k): the bits of their last ``ASKED_BITS`` bits."""
    slot = F.pmod(F.col("k"), F.lit(1 << ASKED_BITS))
    bits = np.zeros((1 << ASKED_BITS) // 8, np.uint8)
    for piece, own in keys.groupBy(F.floor(slot / 32768)).agg(F.bitmap_construct_agg(slot % 32768)).collect():  # in pieces of 4 KB
        bits[piece * 4096 : piece * 4096 + 4096] = np.frombuffer(bytes(own), np.uint8)
    return bits
