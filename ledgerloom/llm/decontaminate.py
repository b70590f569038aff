"""Benchmark decontamination by a prefix-filtered set join.

Every run of `window` words of a benchmark item (the whole item, if shorter) is a set
that must lie in a document in full. Then any one of its words is a necessary prefix:
its rarest word, by counts over all documents, stands for it. A document is read once;
only at its occurrences of such prefix words does it meet windows, and only those of
the prefix word. The word's place in the window fixes where the window would start
(positional bound) and the document must be long enough on both sides (length bound).
One lookup of the words there then verifies the containment exactly.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_number, load, stored, text_slices

WINDOW = 10
#: Words of benchmark text in one pass, whose index takes some 200 MB of a worker. A larger benchmark takes more passes over the documents.
PASS_WORDS = 400_000
#: A-Z become a-z; every other ASCII character that is no letter or digit becomes a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def windows_of(words: list[bytes], window: int) -> set[tuple]:
    return {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else set()


class WindowIndex:
    """`by_word`: prefix word -> [(place in window, window length, words -> items)]."""

    def __init__(self, items: list[tuple[str, str]], counts: dict[bytes, int], window: int):
        holders = defaultdict(set)
        for item, text in items:
            for w in windows_of(words_of(text), window):
                holders[w].add(item)
        by_word = defaultdict(lambda: defaultdict(dict))
        for w, own in holders.items():
            place = min(range(len(w)), key=lambda i: (counts.get(w[i], 0), w[i], i))
            by_word[w[place]][place, len(w)][w] = sorted(own)
        self.by_word = {word: [(*k, v) for k, v in kinds.items()] for word, kinds in by_word.items()}

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [start, end) runs of hit words, and the items with occurring windows."""
        spans, items, n, by_word = [], set(), len(words), self.by_word
        if by_word.keys().isdisjoint(words):
            return spans, items
        for at in [i for i, w in enumerate(words) if w in by_word]:
            for place, length, windows in by_word[words[at]]:
                start = at - place
                if start >= 0 and start + length <= n and (own := windows.get(tuple(words[start : start + length]))):
                    spans.append((start, start + length))
                    items.update(own)
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def word_counts(docs: DataFrame, wanted: frozenset, text: str) -> dict[bytes, int]:
    """How often each of `wanted` occurs in all documents: summed per task, then over tasks."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Counter = Counter()
        for batch in text_slices(batches):
            for t in batch.column(0).to_pylist():
                own.update(filter(held.value.__contains__, words_of(t)))
        yield pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.binary()), pa.array(own.values(), pa.int64())], names=["word", "n"])

    found = docs.selectExpr(f"CAST(`{text}` AS STRING) AS text").mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}


def passes(benchmark: DataFrame, item_id: str, text: str, pass_words: int) -> Iterator[list[tuple[str, str]]]:
    """Benchmark items in lists of at most `pass_words` words (or one item), read from the cluster one after another."""
    rows = benchmark.selectExpr(f"CAST(`{item_id}` AS STRING) AS item", f"CAST(`{text}` AS STRING) AS text").where("item IS NOT NULL AND text IS NOT NULL")
    block, size = [], 0
    for r in rows.toLocalIterator():
        n = len(words_of(r.text))
        if block and size + n > pass_words:
            yield block
            block, size = [], 0
        block.append((r.item, r.text))
        size += n
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_words: int = PASS_WORDS, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """`docs` with `n_words`, `n_hit`, `contam_items` (sorted item ids) and `contam_spans` (word runs "start-end").

    Null and empty texts have no words and no hits. Items with null id or text, or without words, have no
    windows; items that share an id count as one. Rows are neither joined nor moved, so repeated rows and null
    ids keep their own results. Columns of `docs` with the names of new ones are replaced. No items: no hits.
    """
    spark = docs.sparkSession
    out = docs.drop("n_words", "n_hit", "contam_items", "contam_spans")
    names, kinds = out.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    at = names.index(text)
    new = "n_words long, n_hit long, contam_items array<string>, contam_spans array<string>"
    fields = [pa.field("n_words", pa.int64()), pa.field("n_hit", pa.int64()), pa.field("contam_items", pa.list_(pa.string())), pa.field("contam_spans", pa.list_(pa.string()))]

    def mark(held, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index: WindowIndex = held.value
            for batch in text_slices(batches):
                texts = pc.cast(batch.column(at), pa.string()).to_pylist()
                before = [((), ())] * len(texts) if first else zip(batch.column(len(names) + 2).to_pylist(), batch.column(len(names) + 3).to_pylist())
                sizes, hit, items, runs = [], [], [], []
                for t, (old_items, old_runs) in zip(texts, before):
                    words = words_of(t)
                    spans, own = index.hits(words)
                    if old_runs:
                        spans = merged(spans + [tuple(map(int, x.split("-"))) for x in old_runs])
                    sizes.append(len(words))
                    hit.append(sum(b - a for a, b in spans))
                    items.append(sorted(own.union(old_items)))
                    runs.append([f"{a}-{b}" for a, b in spans])
                arrays = [*batch.columns[: len(names)], *(pa.array(x, f.type) for x, f in zip((sizes, hit, items, runs), fields))]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([*(batch.schema.field(i) for i in range(len(names))), *fields]))

        return run

    first = True
    for block in passes(benchmark, item_id, item_text, pass_words):
        wanted = frozenset(w for _, t in block for w in words_of(t))
        index = spark.sparkContext.broadcast(WindowIndex(block, word_counts(docs, wanted, text), window))
        if not first:
            out = stored(out, "contamination")
        out, first = out.mapInArrow(mark(index, first), f"{kinds}, {new}"), False
    if first:
        out = out.mapInArrow(mark(spark.sparkContext.broadcast(WindowIndex([], {}, window)), True), f"{kinds}, {new}")
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents of `docs` in which no benchmark window occurs, with their columns as they were.

    Null and empty texts have no words and stay, as do null ids; equal rows stay or go together. Texts are read
    whole, however long. Columns keep their names, whatever these are. An empty table, or an empty benchmark,
    takes nothing away.
    """
    text = docs.columns.index(options.pop("text", "text"))
    marked = contamination(by_number(docs), benchmark, text=f"c{text}", **options)
    return marked.where("n_hit = 0").drop("n_words", "n_hit", "contam_items", "contam_spans").toDF(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    return contamination(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("contam_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contam_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
     bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS win FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS r(i) WHERE len(w) > 0),
     d AS (SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     sizes AS (SELECT DISTINCT n FROM bw),
     dw AS (SELECT row_id, n, i, list_slice(w, i, i + n - 1) AS win FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
     hit AS (SELECT DISTINCT row_id, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
     words AS (SELECT row_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(p) GROUP BY row_id),
     items AS (SELECT row_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS own FROM hit GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(own, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row_id) LEFT JOIN items USING (row_id)
"""
