"""Token counts of whole texts. Huge texts are encoded in overlapping chunks and spliced.

A chunk that starts in the middle of a text begins with wrong tokens and soon falls
into step with the true ones. The splitting rule reads left to right and looks at most
one character ahead, so once two overlapping chunks start a word at the same place,
every later token of the second chunk is a token of the whole text. `spliced` takes
such a place as the seam, away from the first chunk's end, where the rule may see a
false end of text. An overlap without one is doubled until it has one or ends the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import bpe
from .common import load, text_slices

#: Characters of a chunk and of the overlap of two; a text longer than a chunk is huge and is cut into several.
CHUNK_CHARS = 8192
OVERLAP_CHARS = 512
#: No seam so near to a chunk's end: longer than any special token, with two whole words between.
END_MARGIN = 32
TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def seam_of(here, start: int, first: int, then, begin: int, end: int, last: bool) -> tuple[int, int] | None:
    """The last place where both chunks start a word, as the token of `here` (begun at `start`) and of `then` (begun at `begin`).

    The first place at which a chunk starts is no evidence, as a word may be cut there, and nor are the last
    two words of `here`, or what is near its end, unless the text ends there. Special tokens belong to no word.
    """
    edge = end - (0 if last else END_MARGIN)
    words = here.word_ids
    final = next((w for w in reversed(words) if w is not None), -1) - (0 if last else 2)
    for place in range(min(edge, end - 1), begin, -1):
        ours, theirs = here.char_to_word(place - start), then.char_to_word(place - begin)
        if ours is None or theirs is None or ours > final or here.word_to_chars(ours)[0] != place - start or then.word_to_chars(theirs)[0] != place - begin:
            continue
        token = here.word_to_tokens(ours)[0]
        return (token, then.word_to_tokens(theirs)[0]) if token >= first else None
    return None


def spliced(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[tuple[object, int, int]]:
    """Parts (encoding, first token, end token) that together are the encoding of `text`."""
    encode = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False)
    parts, start, end = [], 0, min(len(text), chunk)
    here, first = encode(start, end), 0
    while end < len(text):
        begin, width = end - min(overlap, end - start), overlap
        upto = min(len(text), begin + chunk)
        then = encode(begin, upto)
        while (seam := seam_of(here, start, first, then, begin, end, end == len(text))) is None and end < len(text):
            width *= 2
            end = min(len(text), begin + width)
            if end > upto:
                upto = min(len(text), end + chunk)
                then = encode(begin, upto)
            here = encode(start, end)
        if seam is None:  # the widened chunk has reached the end of the text
            break
        parts.append((here, first, seam[0]))
        here, first, start, end = then, seam[1], begin, upto
    return [*parts, (here, first, len(here))]


def spliced_ids(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    return [i for encoding, a, b in spliced(tokenizer, text, chunk, overlap) for i in encoding.ids[a:b]]


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = TOKEN_LIMIT, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: `doc_id`, `n_bytes`, `n_tokens`, `over_limit`, `n_chunks`.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each; a null id
    stays null; other columns, whatever their names, are left out. An empty table gives none.
    Texts of up to `chunk` characters fit one chunk, which is counted piece by piece with a memo.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = bpe.kept_memo(bpe.ByteCounts, tokenizer)
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column(1), "")
            huge = pc.greater(pc.utf8_length(texts), chunk)
            tokens, chunks = memo.count(pc.if_else(huge, "", texts)), np.ones(len(texts), np.int32)
            for i, t in zip(np.flatnonzero(huge.to_numpy(zero_copy_only=False)), texts.filter(huge).to_pylist()):
                parts = spliced(memo.tokenizer, t, chunk, overlap)
                tokens[i], chunks[i] = sum(b - a for _, a, b in parts), len(parts)
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), n, pc.greater(n, limit), pa.array(chunks)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks"],
            )

    rows = docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text")
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks int")


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(load(spark, sf_dir, "documents"))
