"""Quality scores: ridge regression on random Fourier features, then isotonic calibration.

Random Fourier features turn a Gaussian kernel over document statistics into a linear
model: z(x) = sqrt(2/D) cos(Wx + b). Every task sums its part of the normal equations
Z'Z and Z'y; the sums of all tasks give the same model as one pass over all labelled
documents would. Isotonic regression over binned scores makes them probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, load, stored, text_slices

STATISTICS = (
    "log_chars log_words word_length upper digits stops commas marks symbols spaces non_ascii "
    "distinct_words top_word repeated_pairs marked_words log_line repeated_lines short_lines log_longest_word"
).split()
FEATURES = 256
RIDGE = 1e-3
#: Width of the kernel in standard deviations of the statistics.
KERNEL_WIDTH = 3.0
SEED = 42
BINS, LOW, HIGH = 400, -0.5, 1.5
THRESHOLD = 0.3

CLASSES = np.zeros((256, 8))
for name, chars in enumerate((range(65, 91), range(48, 58), b".", b",;:", b"!?", b"#$%&*+/<=>@\\^_`{|}~", b" \t\n\r\x0b\x0c", range(128, 256))):
    CLASSES[list(chars), name] = 1


def statistics(text: str | None) -> list[float]:
    """Statistics of a text, each finite. A null text counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, lines = raw.split(), raw.split(b"\n")
    n, m = max(1, len(raw)), max(1, len(words))
    shares = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES) / n
    counts = Counter(words)
    top = max(counts.values(), default=0)
    marked = sum(1 for w in counts if not w[-1:].isalpha() and w[-1] < 128 and w[-1:] not in (b".", b","))
    filled = [x for x in lines if x]
    return [
        np.log1p(len(raw)), np.log1p(len(words)), min(50.0, sum(map(len, words)) / m), *shares.tolist(),
        len(counts) / m, top / m, len(set(zip(words, words[1:]))) / max(1, len(words) - 1), marked / max(1, len(counts)),
        np.log1p(len(raw) / max(1, len(lines))), 1 - len(set(filled)) / max(1, len(filled)), sum(len(x) < 30 for x in lines) / max(1, len(lines)),
        np.log1p(max(map(len, words), default=0)),
    ]


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and a column for each of STATISTICS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = np.array([statistics(t) for t in batch.column(1).to_pylist()], np.float32).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.T)], names=["doc_id", *STATISTICS])

    rows = docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text")
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{s} float" for s in STATISTICS))


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    curve: np.ndarray  # calibrated score of each bin


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of rows of statistics, with a constant in the last column."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(size=(x.shape[1], FEATURES)) / KERNEL_WIDTH
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.sqrt(2 / FEATURES) * np.cos(((x - mean) / scale).clip(-8, 8) @ w + b)
    return np.column_stack((z, np.ones(len(x))))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS]).astype(np.float64)


def summed(rows: DataFrame, by: list[str]) -> DataFrame:
    """Element-wise sums of the vectors `v` of each group."""

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([x.values.to_numpy() for x in table.column("v")], axis=0)
        return pa.table([*(table.column(c).slice(0, 1) for c in by), pa.array([total.tolist()], pa.list_(pa.float64()))], names=[*by, "v"])

    return rows.groupBy(*by).applyInArrow(add, ", ".join(f"{c} int" for c in by) + ", v array<double>")


def partial_equations(rows: DataFrame, held) -> DataFrame:
    """Z'Z with Z'y of every task and each half of the rows, by rows `i`, dealt out to 16 groups `part` by the number of the task.

    Rows `i` of the second half follow those of the first. A task that runs again has the same
    `part`; with another, its sums would reach reducers that have them already and miss some that
    have not.
    """
    size = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2 * size, size + 1))
        for batch in batches:
            z = fourier(matrix(batch), *held.value)
            both = np.column_stack((z, batch.column("y").to_numpy(zero_copy_only=False)))
            half = batch.column("half").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                total[k * size : (k + 1) * size] += z[half == k].T @ both[half == k]
        part = TaskContext.get().partitionId() % 16
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * size), pa.int32()), pa.array(np.full(2 * size, part), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "part", "v"])

    return rows.select(*STATISTICS, "y", half_of_rows()).mapInArrow(equations, "i int, part int, v array<double>")


def half_of_rows():
    """0 or 1 by the statistics of a row, so copies of a text are in one half."""
    return F.pmod(F.xxhash64(*STATISTICS), F.lit(2)).cast("int").alias("half")


def solved(total: np.ndarray, n: int) -> np.ndarray:
    """Ridge weights of the summed equations of `n` rows; the constant is free."""
    return np.linalg.solve(total[:, :-1] + RIDGE * n * np.diag([*[1.0] * FEATURES, 0.0]), total[:, -1])


def fit(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> Model | None:
    """A model of all rows of `stats` that have a label. None without both labels. Of several labels of one id the larger counts.

    The curve is calibrated on scores that a row gets from the equations of the half it isn't in; a
    half without rows takes the weights of all.
    """
    spark = stats.sparkSession
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).cast("double").alias("y"))
    rows = stored(stats.join(known, "doc_id"), "quality-training")
    whole = rows.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), *(f(s).alias(f"{f.__name__}_{s}") for s in STATISTICS for f in (F.avg, F.stddev_pop))).first()
    if not whole.n or whole.ones in (0, whole.n):
        return None
    mean = np.array([whole[f"avg_{s}"] for s in STATISTICS])
    scale = np.array([max(whole[f"stddev_pop_{s}"], 1e-6) for s in STATISTICS])
    held = spark.sparkContext.broadcast((mean, scale))
    parts = partial_equations(rows, held)
    lines = summed(summed(parts, ["i", "part"]).select("i", "v"), ["i"]).collect()  # one row a feature
    halves = np.array([r.v for r in sorted(lines)]).reshape(2, FEATURES + 1, FEATURES + 2)
    weights = solved(halves.sum(axis=0), whole.n)
    sizes = halves[:, -1, -2].round().astype(int)  # the sum of the constant's squares
    other = np.array([solved(halves[1 - k], sizes[1 - k]) if sizes[1 - k] else weights for k in (0, 1)])
    raw = spark.sparkContext.broadcast((mean, scale, other))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column("half").to_numpy(zero_copy_only=False)
            at = bins((fourier(matrix(batch), *raw.value[:2]) * raw.value[2][half]).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column("y")], names=["bin", "y"])

    seen = rows.select(*STATISTICS, "y", half_of_rows()).mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("ones")).orderBy("bin").collect()
    share = whole.ones / whole.n
    level = never_falling([(r.ones + share) / (r.n + 1) for r in seen], [r.n + 1 for r in seen])
    return Model(mean, scale, weights, np.interp(np.arange(BINS), [r.bin for r in seen], level))


def never_falling(values: list[float], weights: list[float]) -> list[float]:
    """The closest sequence that never falls: neighbours that do are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return [v for v, _, n in pools for _ in range(n)]


def bins(raw: np.ndarray) -> np.ndarray:
    return ((raw - LOW) / (HIGH - LOW) * BINS).clip(0, BINS - 1).astype(np.int32)


def scored(stats: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, `score` (0 to 1, higher: label 1 likelier), `predicted`. Without a model every score is 0.5."""
    held = stats.sparkSession.sparkContext.broadcast(model and tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if held.value is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                mean, scale, weights, curve = held.value
                raw = fourier(matrix(batch), mean, scale) @ weights
                # A trace of the raw score keeps the order of documents of one level.
                scores = (0.999 * curve[bins(raw)] + 0.001 * ((raw - LOW) / (HIGH - LOW)).clip(0, 1)).clip(0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array(scores >= threshold).cast(pa.int32())], names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(run, "doc_id long, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `score`, `predicted`, learned from `labels`, which should hold training labels only.

    Null and empty texts are scored by the statistics of an empty text. Null ids stay null and train nothing;
    repeated rows are scored, and train, each; other columns, whatever their names, are left out. A text is read
    whole, however long. An empty table gives no rows.
    """
    stats = stored(with_statistics(docs, doc_id, text), "quality-statistics")
    return scored(stats, fit(stats, labels, doc_id), threshold)


def query(spark, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    rows = quality(load(spark, sf_dir, "documents"), labels)
    return rows.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
