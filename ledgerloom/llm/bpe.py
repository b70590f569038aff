"""Exact tokenisation with a bounded memo of pieces.

A tokenizer whose splitting rule never joins two sides of a white-space gap gives
the same ids for a text as for its pieces one by one. The classes below cut texts
only at such gaps. Arrow cuts the texts and finds the different pieces of a batch;
Python looks those up in a memo, asks the library for new ones, and numpy puts the
results of all pieces together.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core already

#: Pieces that a worker remembers, in two generations, and characters of the longest one:
#: a piece takes 200 bytes as a rule and never over 1,000.
MEMO_PIECES, MEMO_CHARS = 1_400_000, 64


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceMemo:
    """Remembers what `learn` made of pieces. The older half goes when the memo is full; pieces in use stay."""

    def __init__(self, limit: int = MEMO_PIECES):
        self.limit, self.young, self.old = limit, {}, {}

    def learn(self, pieces: list[str]) -> list:
        raise NotImplementedError

    def known(self, piece: str):
        """What is remembered of `piece`, which is young again; None if nothing is."""
        value = self.young.get(piece)
        if value is None:
            value = self.old.get(piece)
            if value is not None:
                self.young[piece] = value
        return value

    def keep(self, piece: str, value) -> None:
        if len(piece) <= MEMO_CHARS:
            self.young[piece] = value

    def values(self, pieces: list[str]) -> list:
        """The results of `pieces`, in their order."""
        if len(self.young) > self.limit // 2:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, pieces))
        new = []
        for i, value in enumerate(found):
            if value is None:
                found[i] = self.known(pieces[i])
                if found[i] is None:
                    new.append(i)
        for i, value in zip(new, self.learn([pieces[i] for i in new]) if new else ()):
            found[i] = value
            self.keep(pieces[i], value)
        return found


#: Letters beyond which the splitting rules of the vocabularies and Python might not agree on what a letter is.
LATIN = "\u024f"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is printable, else the next from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()


def spelled(piece: str) -> str:
    """`piece` as byte-level vocabularies write it."""
    return piece.encode("utf-8").decode("latin-1").translate(LETTERS)


def kept_memo(kind: type, name: str) -> PieceMemo:
    """The memo of this worker process, which outlives its tasks."""
    return kept((kind.__name__, name), lambda: kind(vocabulary(name)))


def different(lists: pa.ListArray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Of lists of pieces: the number of each piece among the different ones, those, and where each list starts and the last ends."""
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    starts = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_numpy(zero_copy_only=False).tolist(), starts - starts[0]


class WordIds(PieceMemo):
    """Ids of the lower-case word-end vocabulary, which drops white space; results are little-endian bytes of `dtype`."""

    #: A full stop or comma between a small letter and a gap is a token of its own.
    STOP = r"(\p{Ll})([.,])( |\z)"

    def __init__(self, path: str, limit: int = MEMO_PIECES):
        from tokenizers import Tokenizer

        super().__init__(limit)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def packed(self, ids: list[int]) -> bytes:
        return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()

    def learn(self, pieces: list[str]) -> list[bytes]:
        out, other, tokenize = [], [], self.model.tokenize
        for i, p in enumerate(pieces):
            if p.isalpha() and p.islower() and max(p) <= LATIN:  # one word of small letters: nothing to normalise or split
                out.append(self.packed([t.id for t in tokenize(spelled(p))]))
            else:
                other.append(i)
                out.append(b"")
        for i, encoding in zip(other, self.tokenizer.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False)):
            out[i] = self.packed(encoding.ids)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all `texts` (no nulls) in a row, and how many each text has."""
        plain = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))  # special tokens may have capitals
        cut = pc.replace_substring_regex(pc.replace_substring(plain, "\n", " "), self.STOP, r"\1 \2\3")
        codes, pieces, starts = different(pc.split_pattern(cut, " "))
        found = self.values(pieces)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        flat, first = np.frombuffer(b"".join(found), self.dtype), np.cumsum(sizes) - sizes
        n = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = flat[np.repeat((first[codes] - ends[:-1]).astype(np.int32), n) + np.arange(ends[-1], dtype=np.int32)]
        return ids, np.diff(ends[starts])


class ByteCounts(PieceMemo):
    """Token counts of a byte-level vocabulary in which white space leads the word that follows it."""

    #: White space as Python knows it, for Arrow's regular expressions.
    SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
    ODD = rf"{SPACE}{SPACE}|\A{SPACE}|{SPACE}\z|\x00"
    #: Where no two white-space characters meet, every space and line end begins a piece, and so does
    #: a full stop or comma between a small letter and one of them. Elsewhere a piece begins only
    #: where white space follows other text.
    STOP = r"(\p{Ll})([.,])(\x00|\z)"
    GAPS = re.compile(r"(?<=\S)(?=[ \n\t\r])")

    def __init__(self, path: str, limit: int = MEMO_PIECES):
        from tokenizers import Tokenizer

        super().__init__(limit)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def learn(self, pieces: list[str]) -> list[int]:
        out, other, tokenize = [], [], self.model.tokenize
        for i, p in enumerate(pieces):
            word = p[1:] if p[:1] == " " else p
            if word.isalpha() and max(word) <= LATIN:  # one word
                out.append(len(tokenize(spelled(p))))
            else:
                other.append(i)
                out.append(0)
        for i, encoding in zip(other, self.tokenizer.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False)):
            out[i] = len(encoding)
        return out

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each of `texts` (no nulls)."""
        odd = pc.match_substring_regex(texts, self.ODD)
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        marked = pc.replace_substring_regex(marked, self.STOP, "\\1\0\\2\\3")
        codes, pieces, starts = different(pc.split_pattern(pc.if_else(odd, "", marked), "\0"))
        sums = np.concatenate(([0], np.cumsum(np.array(self.values(pieces), np.int64)[codes])))
        total = np.diff(sums[starts])
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        for i, text in zip(at, texts.filter(odd).to_pylist()):
            total[i] = sum(self.values(self.GAPS.split(text)))
        return total
