"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise part is computed in time
linear in the features of a text, as half of sum_f (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2.

The model is fitted on the driver on a bounded sample: the ``SAMPLE`` labelled rows of lowest hash that the
caller offers for learning. Only their features, computed on the executors, reach the driver. Scoring is one
pass over the texts, with the model (a few hundred KB, whatever the input) sent to the tasks.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import LOWER, kept, map_batches, slices, with_fields

#: Hash buckets for words, rank of the interactions, rows to learn from at most, passes, step, penalty.
BUCKETS, RANK, SAMPLE, EPOCHS, RATE, PENALTY = 2048, 6, 3000, 30, 0.03, 1e-4
WORD_CACHE = 200_000
CLASSES = 10  # other, lower, upper, digit, space, line feed, sentence mark, bar, symbol, beyond ASCII
STRUCTURE = (
    "letters upper digits space lines marks bars symbols foreign other log_bytes log_words word_length long_words distinct_words "
    "top_word repeated_lines line_length marks_per_word symbol_words upper_words capital_words metadata_length metadata_gap"
).split()
CLASS_OF = np.zeros(256, np.uint8)
for _chars, _class in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b" \t", 4), (b"\n\r", 5), (b".,;:!?'\"-", 6), (b"|", 7), (b"#$%&*+/<=>@[]\\^_`{}~()", 8), (range(128, 256), 9)):
    CLASS_OF[list(_chars)] = _class
SYMBOL_END = tuple(bytes([c]) for c in b"#$%&*|=+~!")
_buckets: dict[bytes, int] = kept(__name__)


def structure(text: bytes, words: list[bytes], counts: Counter, n_chars: int | None) -> list[float]:
    """Values of about 0 to 1, in the order of STRUCTURE."""
    n, k = max(1, len(text)), max(1, len(words))
    kinds = np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=CLASSES) / n
    lines = text.split(b"\n")
    chars = len(text) - int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
    said = chars if n_chars is None else n_chars
    return [
        kinds[1], kinds[2], kinds[3], kinds[4], min(1, 20 * kinds[5]), min(1, 5 * kinds[6]), min(1, 10 * kinds[7]), min(1, 5 * kinds[8]), kinds[9], kinds[0],
        np.log1p(len(text)) / 12, np.log1p(len(words)) / 10, min(2, len(text) / k / 10), sum(c for w, c in counts.items() if len(w) > 14) / k, len(counts) / k,
        max(counts.values(), default=0) / k, 1 - len(set(lines)) / len(lines), min(1, n / len(lines) / 1000), min(1, 5 * n * kinds[6] / k / 10),
        sum(c for w, c in counts.items() if w.endswith(SYMBOL_END)) / k, sum(c for w, c in counts.items() if w.isupper()) / k,
        sum(c for w, c in counts.items() if 65 <= w[0] <= 90) / k, np.log1p(max(0, said)) / 12, min(1, abs(said - chars) / (chars + 1)),
    ]


def features(text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: words (bucket, damped frequency, unit length), then structure."""
    text = text or b""
    words = text.split()
    counts = Counter(words)
    if len(_buckets) > WORD_CACHE:
        _buckets.clear()
    get, hashed = _buckets.get, {}
    for w, c in counts.items():
        if (b := get(w)) is None:
            _buckets[w] = b = zlib.crc32(w.translate(LOWER)) % BUCKETS
        hashed[b] = hashed.get(b, 0) + c
    own = np.fromiter(hashed, np.int64, len(hashed))
    value = np.log1p(np.fromiter(hashed.values(), np.float64, len(hashed)))
    if len(own):
        value /= np.sqrt((value * value).sum())
    return np.concatenate([own, np.arange(BUCKETS, BUCKETS + len(STRUCTURE))]), np.concatenate([value, structure(text, words, counts, n_chars)])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        value = value.copy()
        value[-len(self.mean) :] = (value[-len(self.mean) :] - self.mean) * self.scale
        own = self.factors[index] * value[:, None]
        total = own.sum(axis=0)
        return float(self.bias + self.linear[index] @ value + 0.5 * (total @ total - (own * own).sum()))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Machine:
    """Log loss with class weights of equal total, by Adam on small batches. One class only: a constant."""
    n, dims, k = len(rows), BUCKETS + len(STRUCTURE), len(STRUCTURE)
    y = np.array([r[2] for r in rows], np.float32)
    if not n or y.min() == y.max():
        return Machine(0.0 if not n else 5.0 if y[0] else -5.0, np.zeros(dims), np.zeros((dims, RANK)), np.zeros(k), np.ones(k))
    x = np.zeros((n, dims), np.float32)
    for i, (index, value, _) in enumerate(rows):
        x[i, index] = value
    mean = x[:, -k:].mean(axis=0)
    scale = 1 / np.maximum(x[:, -k:].std(axis=0), 1e-3)
    x[:, -k:] = (x[:, -k:] - mean) * scale
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(dims, np.float32), rng.normal(0, 0.01, (dims, RANK)).astype(np.float32), np.zeros(1, np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, v, b)]
    t, epochs, batch = 0, max(EPOCHS, -(-EPOCHS * 1500 // n) if n < 1500 else EPOCHS), 128
    for epoch in range(epochs):
        order = rng.permutation(n)
        rate = RATE * (1 - epoch / epochs) + 1e-3
        for a in range(0, n, batch):
            own = order[a : a + batch]
            xb = x[own]
            total = xb @ v
            z = b + xb @ w + 0.5 * ((total * total).sum(1) - (xb * xb) @ (v * v).sum(1))
            g = weight[own] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) / len(own)
            gx = xb * g[:, None]
            grads = (gx.sum(0) + PENALTY * w, gx.T @ total - v * (gx * xb).sum(0)[:, None] + PENALTY * v, np.array([g.sum()], np.float32))
            t += 1
            for p, d, (m, s) in zip((w, v, b), grads, state, strict=True):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return Machine(float(b[0]), w.astype(np.float64), v.astype(np.float64), mean.astype(np.float64), scale.astype(np.float64))


def _columns(df: DataFrame, *more: str) -> DataFrame:
    has = "n_chars" in df.columns
    return df.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").cast("binary").alias("text"), (F.col("n_chars") if has else F.lit(None)).cast("long").alias("n_chars"), *more)


def learn(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine fitted on the rows of ``df`` that ``labels`` (doc_id, quality) mark; labels and ids are no features.

    ``sample`` bounds the labelled rows that teach: those with the lowest hash of the id, then mark and features. Up to
    that bound contradicting marks of one id all count, and so does each of several rows of one id. Rows without
    a mark or an id teach nothing. Empty tables give a machine that scores 0.5 throughout.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("y")).filter("id is not null and y in (0, 1)").distinct()
    marks = marks.orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    rows = _columns(df).join(F.broadcast(marks), "id").select("id", "text", "n_chars", "y")  # at most ``sample`` marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, texts in slices(batch):
                found = [features(t, c) for t, c in zip(texts, batch.column(2).slice(done, len(ids)).to_pylist(), strict=True)]
                y = batch.column(3).slice(done, len(ids))
                done += len(ids)
                yield pa.record_batch([ids, pa.array([f[0].astype(np.int16).tobytes() for f in found], pa.binary()), pa.array([f[1].astype(np.float32).tobytes() for f in found], pa.binary()), y], ["id", "i", "x", "y"])

    got = map_batches(rows, run, "id long, i binary, x binary, y int").orderBy(F.xxhash64("id"), "y", "x").limit(sample).collect()
    return fit([(np.frombuffer(r[1], np.int16).astype(np.int64), np.frombuffer(r[2], np.float32), r[3]) for r in got])


def scored(df: DataFrame, machine: Machine, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, score[, the columns of ``keep``]) for every row of ``df``; score is the probability of label 1.

    Null texts are scored as empty ones, a null n_chars as the text's own length; very long texts are
    scored whole; rows repeated under one id are rows of their own; an empty table gives an empty result.
    """
    own = _columns(df, *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, texts in slices(batch):
                said = batch.column(2).slice(done, len(ids)).to_pylist()
                z = [machine.margin(*features(t, c)) for t, c in zip(texts, said, strict=True)]
                rest = [c.slice(done, len(ids)) for c in batch.columns[3:]]
                done += len(ids)
                yield pa.record_batch([ids, pa.array(1 / (1 + np.exp(-np.clip(np.array(z), -30, 30))), pa.float64()), *rest], ["id", "score", *keep])

    return map_batches(own, run, with_fields("id long, score double", own.schema.fields[3:]))
