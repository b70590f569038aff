"""Toxicity by compression distance to two zstandard dictionaries.

One dictionary is trained on the whole texts of toxic documents, one on whole texts of
ordinary ones, as many bytes of each, with the same parameters. No word is picked: what
the dictionaries hold is what zstandard's trainer finds repeated in either class.

A window is a word of a document with its gaps. Its difference is its compressed length
under the ordinary dictionary less that under the toxic one. A sequence of zstandard costs
some three bytes, as much as a short word, so windows are coded with three bytes a letter:
the letter and two that depend on the letters before it. The score of a document adds up
weights: for each threshold that its largest difference reaches, for each that its second
reaches, and for the number of its windows; a logistic curve makes it a probability. The
weights are calibrated on labelled documents that trained no dictionary, and no difference
counts against toxicity.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PieceMemo, different
from .common import by_number, fold, kept, load, text_slices
from .decontaminate import words_of

#: Labelled documents of each class that a fit reads at most, those with the smallest hashes of their
#: ids, and the longest text among them; no more than both together reach the driver.
SAMPLE, SAMPLE_CHARS = 6000, 16_384
#: Bytes of a dictionary at most (a quarter of the training text, if that is less), and the trainer's segment and match lengths.
DICTIONARY, SEGMENT, MATCH = 900_000, 72, 6
#: Bytes of coded text of each class that train a dictionary at most: whole documents in a random order.
TRAINING = 16 << 20
#: Words of a training sample.
SAMPLE_WORDS = 64
LEVEL = 3
#: Thresholds for the largest and the second difference of a document.
FIRST, SECOND = tuple(range(2, 22, 2)), tuple(range(4, 18, 3))
TOP = len(FIRST) + len(SECOND)
#: Weight of toxic documents among those that calibrate: a missed one counts more than their own share would have it.
SHARE = 0.25
NO_WINDOW = -100
THRESHOLD = 0.7
#: Windows that a worker remembers.
MEMO_WINDOWS = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def coded(words: list[bytes]) -> list[bytes]:
    """Each word with its gaps, three bytes a letter: the letter, and two that also depend on the two letters before it."""
    texts = [b" %b " % w for w in words]
    if not texts:
        return []
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    c = np.frombuffer(b"".join(texts), np.uint8).astype(np.int32)
    starts = np.concatenate(([0], ends[:-1]))
    p, q = np.concatenate(([0], c[:-1])), np.concatenate(([0, 0], c[:-2]))
    p[starts] = q[starts] = q[starts + 1] = 0
    out = np.column_stack((c, 167 * c + 59 * p + 13, 59 * c + 31 * p + 17 * q + 101)).astype(np.uint8).tobytes()
    return [out[3 * a : 3 * b] for a, b in zip(starts.tolist(), ends.tolist())]


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    weights: tuple  # of the TOP thresholds, the logarithm of the number of windows, and 1
    prior: float  # score without dictionaries or windows


class Windows(PieceMemo):
    """Differences of compressed lengths of windows (words): what the ordinary dictionary costs more than the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes, limit: int = MEMO_WINDOWS):
        import zstandard

        super().__init__(limit)

        def compressor(raw: bytes):
            shape = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=64, dict_size=DICTIONARY, write_content_size=False, write_checksum=False, write_dict_id=False)
            return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), compression_params=shape)

        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)

    def learn(self, pieces: list[str]) -> list[int]:
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        return [len(ordinary(w)) - len(toxic(w)) for w in coded([p.encode("utf-8") for p in pieces])]


def features(texts: pa.Array, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Of each text (no nulls) which of the thresholds FIRST and SECOND it reaches, the logarithm of its number of windows, and 1; and that number."""
    if not len(texts):
        return np.zeros((0, TOP + 2)), np.zeros(0, np.int64)
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), SEPARATORS, " ")
    codes, words, starts = different(pc.split_pattern(plain, " "))
    of = np.array([NO_WINDOW if w == "" else v for w, v in zip(words, windows.values(words))], np.int64)
    values, starts = of[codes], starts[:-1]  # every text has a piece, if an empty one
    n = np.add.reduceat((values != NO_WINDOW).astype(np.int64), starts)
    reached = []
    for steps in (FIRST, SECOND):
        best = np.maximum.reduceat(values * len(values) - np.arange(len(values)), starts)
        at = -best % len(values)
        reached += [values[at] >= t for t in steps]
        values[at] = NO_WINDOW
    return np.column_stack((*reached, np.log1p(n), np.ones(len(n)))).astype(float), n


class Scorer:
    def __init__(self, model: Model):
        self.model, self.windows = model, Windows(model.toxic, model.ordinary) if model.toxic else None

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Scores of texts (no nulls) and their numbers of windows."""
        if self.windows is None:
            return np.full(len(texts), self.model.prior), np.zeros(len(texts), np.int64)
        x, n = features(texts, self.windows)
        return np.where(n > 0, logistic(x @ np.array(self.model.weights)), 0.0), n


def kept_scorer(model: Model) -> Scorer:
    """The scorer of this worker process, which outlives its tasks."""
    return kept(("toxicity", model), lambda: Scorer(model))


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve by Newton's method with a little ridge; thresholds of negative weight are left out."""
    own, use = np.zeros(x.shape[1]), np.ones(x.shape[1], bool)
    for _ in range(TOP + 1):
        part, ridge = x[:, use], 1e-2 * np.eye(use.sum())
        w = np.zeros(use.sum())
        for _ in range(60):
            p = logistic(part @ w)
            step = np.linalg.solve((part * (weight * p * (1 - p))[:, None]).T @ part + ridge, part.T @ (weight * (y - p)) - ridge @ w)
            w += step * min(1.0, 4 / (1e-9 + np.abs(step).max()))
        own[:] = 0
        own[use] = w
        if (own[:TOP] >= 0).all():
            break
        use[:TOP] &= own[:TOP] >= 0
    return own


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes] | None:
    """A dictionary of the whole texts of each class, from as many bytes of either. None if there are too few to train on."""
    import zstandard

    rng, sets = np.random.default_rng(42), []
    for texts in (toxic, ordinary):
        own, size = [], 0
        for i in rng.permutation(len(texts)):
            if size < TRAINING:
                words = coded(words_of(texts[i]))
                own += [b"".join(words[k : k + SAMPLE_WORDS]) for k in range(0, len(words), SAMPLE_WORDS)]
                size += sum(map(len, words))
        sets.append(own)
    most, trained = min(sum(map(len, own)) for own in sets), []
    for own in sets:
        own = [own[i] for i in rng.permutation(len(own))]
        own = own[: int(np.searchsorted(np.cumsum([len(x) for x in own]), most, "right")) + 1]
        if len(own) < 16 or most < 16_384:
            return None
        trained.append(zstandard.train_dictionary(min(DICTIONARY, most // 4), own, k=SEGMENT, d=MATCH).as_bytes())
    return trained[0], trained[1]


def train(rows: list[tuple[str, int]], toxic_share: float) -> Model:
    """`rows`: (text, 0 or 1) of labelled documents in a fixed order; `toxic_share`: of toxic ones among all labelled."""
    texts = sorted({(t, y) for t, y in rows if words_of(t)})  # exact copies tell nothing new
    order = np.random.default_rng(42).permutation(len(texts))
    cut = len(order) * 7 // 10
    fit, held = [texts[i] for i in order[:cut]], [texts[i] for i in order[cut:]]
    y = np.array([label for _, label in held], float)
    both = dictionaries([t for t, own in fit if own], [t for t, own in fit if not own]) if 0 < y.sum() < len(y) else None
    if both is None:
        return Model(b"", b"", (), toxic_share)
    windows = Windows(*both)
    x = np.vstack([features(pa.array([t for t, _ in held[i : i + 256]], pa.string()), windows)[0] for i in range(0, len(held), 256)])
    weight = np.where(y == 1, SHARE / max(1, (y == 1).sum()), (1 - SHARE) / max(1, (y == 0).sum())) * len(y)
    return Model(*both, tuple(calibrated(x, y, weight).tolist()), toxic_share)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of at most 2 * `sample` documents of up to SAMPLE_CHARS characters with labels.

    Rows with null label or id teach nothing; of several labels of one id the larger counts, of several
    texts of one id the smallest. Without both classes every score is the share of toxic labels.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max(F.col(label)).cast("int").alias("y"))
    totals = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    picked = None
    for y in totals:
        own = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
        picked = own if picked is None else picked.union(own)
    if picked is None:
        return Model(b"", b"", (), 0.0)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    rows = rows.join(F.broadcast(picked), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"))  # at most 2 * sample rows, folded by task
    found = sorted((r.text, r.y) for r in rows.toLocalIterator())
    return train(found, totals.get(1, 0) / sum(totals.values()))


def toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """`docs` with `tox_windows` (windows of the text), `tox_score` (0 to 1) and `tox_flag` (1 from `threshold` on).

    Null and empty texts, and texts without words, have no windows and score 0. Every row is scored by itself,
    so null ids and repeated rows are no matter, and a very long text costs what its different words cost.
    Columns of `docs` with the names of new ones are replaced.
    """
    out = docs.drop("tox_windows", "tox_score", "tox_flag")
    at, width = out.columns.index(text), len(out.columns)
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept_scorer(Model(*held.value))
        for batch in text_slices(batches):
            scores, n = scorer.scores(pc.fill_null(pc.cast(batch.column(at), pa.string()), ""))
            new = [pa.array(n, pa.int64()), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]
            fields = [*(batch.schema.field(i) for i in range(width)), pa.field("tox_windows", pa.int64()), pa.field("tox_score", pa.float64()), pa.field("tox_flag", pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema=pa.schema(fields))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    return out.mapInArrow(run, f"{kinds}, tox_windows long, tox_score double, tox_flag int")


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that are not flagged, with their columns as they were.

    Null and empty texts have no windows and stay, as do null ids, which train nothing; equal rows stay or go
    together. Texts are read whole, however long. Columns keep their names, whatever these are. Without rows
    of both labels there is nothing to learn and nothing goes; an empty table stays empty.
    """
    model = fit(docs, labels, text=text, **options)
    flagged = toxicity(by_number(docs), model, text=f"c{docs.columns.index(text)}")
    return flagged.where("tox_flag = 0").drop("tox_windows", "tox_score", "tox_flag").toDF(*docs.columns)


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(fold("doc_id", 3) != 1)


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, training_labels(load(spark, sf_dir, "labels")))
    return toxicity(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("tox_score").alias("score"), F.col("tox_flag").alias("predicted"), "tox_windows")
