"""Language of texts: averaged embeddings of hashed subwords with a linear softmax.

Every run of one, two and three characters of the lower-cased text is hashed to a row of
an embedding table; the average row goes through a linear softmax. Both are trained by
stochastic gradient descent in numpy on a bounded sample. A temperature fitted on held-back
documents makes the scores probabilities, and a text whose probability is lower than
that of nearly all held-back documents is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, load, text_slices

#: Training documents of each language: so many in expectation, chosen by a hash of id and text; twice as
#: many over all languages at most, and none longer than this. So no more than that reaches the driver.
SAMPLE, SAMPLE_CHARS = 1000, 16_384
BUCKETS, WIDTH, EPOCHS, RATE, SEED = 1 << 16, 16, 3, 0.5, 42
#: Share of held-back documents whose scores may lie under the limit of rejection.
REJECT_SHARE = 0.01
NO_LANGUAGE = "und"
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    found = LETTER.search(text) if text else None
    return bool(found) and (found.group().isalpha() or any(c.isalpha() for c in text))


def subwords(text: str) -> np.ndarray:
    """Bucket numbers of all runs of 1 to 3 characters."""
    c = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (c[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
    return np.concatenate((one, two, three)) >> np.uint32(16)


class Model(NamedTuple):
    languages: tuple
    table: np.ndarray  # softmax input of each bucket: embeddings times weights
    bias: np.ndarray
    temperature: float
    limit: float

    def probabilities(self, text: str) -> np.ndarray:
        logits = (self.table.take(subwords(text), axis=0).mean(axis=0, dtype=np.float64) + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        return p / p.sum()


def train(rows: list[tuple[str, str]]) -> Model | None:
    """`rows`: (text, language). None without any."""
    languages = tuple(sorted({lang for _, lang in rows}))
    rows = [(t, languages.index(lang)) for t, lang in rows if has_letter(t)]
    if not rows:
        return None
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(rows))
    bags = [np.unique(subwords(t), return_counts=True) for t, _ in rows]
    bags = [(ids, (n / n.sum()).astype(np.float32)) for ids, n in bags]
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    fit = fit if len(fit) else order
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weights, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, at = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            ids, share = bags[i]
            rate, at = RATE * (1 - at / steps), at + 1
            x = share @ table[ids]
            z = x @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[rows[i][1]] -= 1
            back = weights @ p
            weights -= rate * np.outer(x, p)
            bias -= rate * p
            table[ids] -= 20 * rate * share[:, None] * back  # an average over many buckets moves each of them little
    scores = table @ weights
    check = held if len(held) else fit
    logits = np.array([bags[i][1] @ scores[bags[i][0]] + bias for i in check])
    truth = np.array([rows[i][1] for i in check])

    def loss(t: float) -> float:
        z = logits / t
        return float((np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(z)), truth]).mean())

    temperature = min(np.geomspace(0.05, 20, 61), key=loss)
    z = logits / temperature
    best = 1 / np.exp(z - z.max(1, keepdims=True)).sum(1)
    return Model(languages, scores.astype(np.float32), bias, float(temperature), float(np.quantile(best, REJECT_SHARE)))


def fit(docs: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model of rows with text and language: about `sample` of each language, those with the smallest hashes. Repeated rows count once."""
    known = docs.where(F.col(lang).isNotNull() & (F.length(F.col(text).cast("string")) <= SAMPLE_CHARS)).select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    totals = known.groupBy("lang").count().collect()  # a row a language
    if not totals:
        return None
    place = F.abs(F.xxhash64(F.coalesce("id", F.lit("")), "text") % 1_000_000)
    below = F.lit(0)
    for r in totals:
        below = F.when(F.col("lang") == r.lang, F.lit(int(1_000_000 * min(1.0, sample / r["count"])) + 1)).otherwise(below)
    picked = known.where(place < below).select("id", "text", "lang").distinct()
    rows = picked.orderBy(F.xxhash64("id", "text", "lang")).limit(2 * sample * len(totals)).collect()
    return train([(r.text, r.lang) for r in sorted(rows, key=lambda r: (r.id or "", r.text))])


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `lang_pred`, `score`, `rejected`.

    A null text, or one without a letter, is `und` with score 0 and rejected, as is any text without a model.
    `rejected` marks texts whose best score lies under the calibrated limit; their `lang_pred` is the best guess.
    Null ids and repeated rows are kept; other columns, whatever their names, are left out. A text is read whole,
    however long. An empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model and tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value and Model(*held.value)
        for batch in text_slices(batches):
            found = []
            for t in batch.column(1).to_pylist():
                if own is None or not has_letter(t):
                    found.append((NO_LANGUAGE, 0.0, True))
                else:
                    p = own.probabilities(t)
                    best = int(p.argmax())
                    found.append((own.languages[best], float(p[best]), bool(p[best] < own.limit)))
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(fold("doc_id", 4) != 2))
    return identify(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
