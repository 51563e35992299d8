"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration.

Random Fourier features stand for a Gaussian kernel over standardised statistics of the whole text. Each task
sums its part of the normal equations; the parts are added and solved once. Raw scores of a second fold are counted
in fixed bins, and the pool-adjacent-violators rule makes them probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import map_batches, texts_of
from loadkit.session import stage

# At most about this many labelled rows are used to fit; a larger set is sampled evenly by a hash of the id.
FIT_ROWS = 200_000
FEATURES = 256
RIDGE = 1e-3
BINS = 4096
LOW, HIGH = -1.0, 2.0
FIT_TASKS = 16
ACCEPT = 0.7

_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)
_STOPS, _OTHERS = np.array([ord(c) for c in ".,;:'-()\"?"]), np.array([ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~!"])


def statistics(text: str) -> list[float]:
    """Statistics of one text; an empty one has zeros."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * N_STATISTICS
    size, count = len(raw), len(words)
    bytes_of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = bytes_of[bytes_of > 0] / size
    lengths = np.fromiter(map(len, words), np.int64, count)
    lines = [line for line in raw.split(b"\n") if line]
    distinct = len(set(words))
    ends = np.bincount(np.fromiter((w[-1] for w in words), np.uint8, count), minlength=256)
    return [
        np.log1p(size), np.log1p(count), bytes_of[_UPPER].sum() / size, bytes_of[_LOWER].sum() / size, bytes_of[_DIGIT].sum() / size, bytes_of[_STOPS].sum() / size,
        bytes_of[_OTHERS].sum() / size, bytes_of[128:].sum() / size, bytes_of[32] / size, bytes_of[10] / count, bytes_of[33] / count, bytes_of[124] / count, -(shares * np.log(shares)).sum(),
        lengths.mean(), lengths.std(), np.log1p(lengths.max()), distinct / count, np.log1p(distinct) / np.log1p(count), len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)),
        ends[_OTHERS].sum() / count, ends[_STOPS].sum() / count, len(set(zip(words, words[1:]))) / count,
    ]


N_STATISTICS = 23


@dataclass(frozen=True)
class Model:
    """Fixed score where `weights` is None: the share of label 1, or 1 without any label."""

    constant: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return expand((rows - self.mean) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.constant)
        return np.clip(np.interp(self.raw(rows), self.knots, self.values), 0.0, 1.0)


def expand(x: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant. The same directions on every machine."""
    source = np.random.default_rng(17)
    directions = source.normal(0, 1 / np.sqrt(N_STATISTICS), (N_STATISTICS, FEATURES))
    shift = source.uniform(0, 2 * np.pi, FEATURES)
    return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(np.clip(x, -6, 6) @ directions + shift), np.ones((len(x), 1))], axis=1)


def isotonic(x: np.ndarray, total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising shares of ones over the sorted x, as knots and values to interpolate."""
    blocks: list[list[float]] = []
    for at, n, k in zip(x, total, ones):
        blocks.append([n, k, at * n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, k2, a2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + k2, blocks[-1][2] + a2]
    return np.array([a / n for n, _, a in blocks]), np.array([k / n for n, k, _ in blocks])


def learnable(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(doc_id, y, fold) of the rows that may teach: fold 3 calibrates, 0 and 1 fit. Ids with both labels or none teach nothing."""
    fold = F.crc32(F.col(key).cast("string")) % 4
    taught = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("double").alias("y"), fold.alias("fold")).filter("doc_id IS NOT NULL AND y IN (0, 1) AND fold <> 2")
    return taught.groupBy("doc_id", "fold").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").drop("most")


def fit(docs: DataFrame, taught: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """Fit on documents whose id is in `taught` (doc_id, y, fold). Null texts count as empty; repeated documents count each."""
    spark = docs.sparkSession
    taught = stage(taught, "quality-labels")
    n, ones = taught.agg(F.count("*"), F.sum("y")).first()
    if not n or ones in (0, n):
        return Model(ones / n if n else 1.0)
    part = int(min(1.0, FIT_ROWS / n) * (1 << 20))
    sample = taught.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < part)
    # The sample is bounded by FIT_ROWS; its real size is checked before it is broadcast.
    sample = F.broadcast(sample) if sample.count() <= 2 * FIT_ROWS else sample
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(sample, "doc_id").select("text", "y", "fold")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [statistics(t) for t in texts_of(batch, "text")]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "y", "fold"])

    rows = stage(map_batches(given, measure, "x array<double>, y double, fold bigint"), "quality-rows")
    first, second = rows.filter("fold <> 3"), rows.filter("fold = 3")
    moments = first.agg(F.count("*"), *[f(F.col("x")[i]) for i in range(N_STATISTICS) for f in (F.avg, F.stddev_pop)]).first()
    if not moments[0]:
        return Model(ones / n)
    mean, scale = np.array(moments[1::2]), np.array(moments[2::2])
    scale = np.where(scale > 1e-9, scale, 1.0)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            if batch.num_rows:
                z = expand((_matrix(batch.column(0)) - mean) / scale)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                left += z.T @ z
                right += z.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()]), pa.array([right.tobytes()])], names=["left", "right"])

    left, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
    for r in first.select("x", "y").coalesce(FIT_TASKS).mapInArrow(equations, "left binary, right binary").collect():
        left += np.frombuffer(r["left"]).reshape(left.shape)
        right += np.frombuffer(r["right"])
    weights = np.linalg.solve(left + RIDGE * moments[0] * np.diag(np.append(np.full(FEATURES, 1.0 / FEATURES), 0.0) + 1e-9), right)
    plain = Model(ones / n, mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def raw(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.clip((plain.raw(_matrix(batch.column(0))) - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], names=["bin", "y"])

    held = map_batches(second.select("x", "y"), raw, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("ones")).orderBy("bin").collect()
    if not held:
        return plain
    at = LOW + (np.array([r["bin"] for r in held]) + 0.5) * (HIGH - LOW) / BINS
    knots, values = isotonic(at, np.array([r["n"] for r in held], float), np.array([r["ones"] for r in held], float))
    return Model(ones / n, mean, scale, weights, knots, values)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All columns and `out`, the calibrated score from 0 to 1 (higher: label 1 is likelier).

    Null and empty texts are scored by zero statistics. Rows stay as they are, repeated ones too; a column that
    is already named `out` is replaced. The model has a fixed size and travels with the task.
    """
    given = docs.drop(out)
    place = given.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t or "") for t in batch.column(place).to_pylist()], dtype=float)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(rows), pa.float64())], names=[*batch.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return map_batches(given, run, f"{fields}, `{out}` double")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
