"""Packing token ids into training sequences of a fixed length, online and in bounded space.

A task keeps a fixed number of open windows. A document goes, whole if it can, into the
window that it leaves with the least room (best fit); what a document has beyond the
length fills windows of its own. If no window has the room, the fullest goes out: its
room, if it is worth a cut, is first filled with the head of the document at hand.

What is open at the end of a task is left over: at most `WINDOWS` windows. Leftovers of
`FAN` tasks are merged by one task in the same way, largest piece first, and what that
leaves open goes on, until one task has what is left of all. It lays its open windows
end to end, cuts full sequences and divides the rest into powers of two, which need no
padding. A level has a `FAN`-th of the tasks of the level under it and its tasks read no
more than `FAN * WINDOWS` windows, whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import load, stored, text_slices

TOKENIZER, END_ID = "word_bpe_49k.json", 2
LENGTH = 4096
#: Open windows of a task, and tasks whose leftovers one task merges.
WINDOWS, FAN = 64, 32
#: No document is cut for fewer ids than these; so much padding, less one, a sequence may have.
LEAST_CUT = 16


class Piece:
    """Ids `start`, ... of a document that has `total`."""

    __slots__ = ("doc", "start", "total", "ids")

    def __init__(self, doc: int | None, start: int, total: int, ids: np.ndarray):
        self.doc, self.start, self.total, self.ids = doc, start, total, ids

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.total, self.ids[:n]), Piece(self.doc, self.start + n, self.total, self.ids[n:])


class Packer:
    """Open windows; `add` returns the sequences, lists of pieces, that a piece closes."""

    def __init__(self, length: int = LENGTH, windows: int = WINDOWS, least_cut: int = LEAST_CUT):
        self.length, self.windows, self.least_cut = length, windows, least_cut
        #: (room, number) of every open window, in order, and its pieces.
        self.rooms: list[tuple[int, int]] = []
        self.open: dict[int, list[Piece]] = {}
        self.number = 0

    def put(self, at: int | None, piece: Piece) -> list[list[Piece]]:
        """Puts `piece` into the window at place `at` of the rooms, or into a new one; the sequence, if that is full now."""
        if at is None:
            room, number, pieces = self.length, self.number, []
            self.number += 1
        else:
            room, number = self.rooms.pop(at)
            pieces = self.open.pop(number)
        pieces.append(piece)
        room -= len(piece.ids)
        if not room:
            return [pieces]
        insort(self.rooms, (room, number))
        self.open[number] = pieces
        return []

    def add(self, piece: Piece) -> list[list[Piece]]:
        out = []
        while len(piece.ids) >= self.length:
            head, piece = piece.cut(self.length)
            out.append([head])
        while n := len(piece.ids):
            at = bisect_left(self.rooms, (n, -1))
            if at < len(self.rooms):
                return out + self.put(at, piece)
            if len(self.rooms) < self.windows:
                return out + self.put(None, piece)
            room, number = self.rooms[0]
            if room >= self.least_cut:
                head, piece = piece.cut(room)
                out += self.put(0, head)
            else:
                self.rooms.pop(0)
                out.append(self.open.pop(number))
        return out

    def left(self) -> list[list[Piece]]:
        """The open windows, the fullest first."""
        return [self.open[number] for _, number in self.rooms]


def divided(windows: list[list[Piece]], length: int) -> list[list[Piece]]:
    """All pieces end to end, cut into full sequences and then into ever smaller powers of two."""
    left = [p for w in windows for p in w][::-1]
    n, out = sum(len(p.ids) for p in left), []
    while n:
        room, own = length if n >= length else 1 << (n.bit_length() - 1), []
        n -= room
        while room:
            piece = left.pop()
            if len(piece.ids) > room:
                piece, rest = piece.cut(room)
                left.append(rest)
            own.append(piece)
            room -= len(piece.ids)
        out.append(own)
    return out


#: `seq` numbers the sequences of a task (`level`, `part`); of a piece that is left over it is null and `place` orders the pieces.
PIECES = "level int, part int, seq long, place int, doc_id long, start long, length long, doc_tokens long, offset long, ids_crc32 long, ids binary"
PIECES_ARROW = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in PIECES.split(", ")])


def rows_of(level: int, part: int, seq: int | None, pieces: list[Piece], place: int = 0) -> list[dict]:
    out, offset = [], 0
    for i, p in enumerate(pieces):
        ids = p.ids.astype("<u4")
        out.append({"level": level, "part": part, "seq": seq, "place": place + i, "doc_id": p.doc, "start": p.start, "length": len(ids), "doc_tokens": p.total, "offset": offset, "ids_crc32": zlib.crc32(ids), "ids": p.ids.tobytes()})
        offset += len(ids)
    return out


def left_over(level: int, part: int, windows: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
    place = 0
    for pieces in windows:
        yield pa.RecordBatch.from_pylist(rows_of(level, part, None, pieces, place), schema=PIECES_ARROW)
        place += len(pieces)


def packed_tasks(docs: DataFrame, tokenizer: str, end_id: int, length: int, windows: int, least_cut: int, doc_id: str, text: str) -> DataFrame:
    """The pieces that the tasks of `docs` pack, level 0. Documents stay where they are read: nothing is shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = bpe.kept_memo(bpe.WordIds, tokenizer)
        part, packer, seq, end = TaskContext.get().partitionId(), Packer(length, windows, least_cut), 0, np.array([end_id], memo.dtype)
        for batch in text_slices(batches):
            ids, counts = memo.encode(pc.fill_null(batch.column(1), ""))
            at, out = 0, []
            for key, n in zip(batch.column(0).to_pylist(), counts.tolist()):
                own = np.concatenate((ids[at : at + n], end))
                at += n
                for pieces in packer.add(Piece(key, 0, n + 1, own)):
                    out += rows_of(0, part, seq, pieces)
                    seq += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=PIECES_ARROW)
        yield from left_over(0, part, packer.left())

    return docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(pack, PIECES)


def merged_tasks(left: DataFrame, level: int, last: bool, length: int, windows: int, least_cut: int) -> DataFrame:
    """Leftovers of each `FAN` neighbouring tasks (of all, in the `last` level) packed by one."""

    def merge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        held = rows.sort_by([("part", "ascending"), ("place", "ascending")]).to_pylist()
        part, packer, seq = held[0]["part"] // FAN, Packer(length, windows, least_cut), 0
        pieces = [Piece(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], f"<u{len(r['ids']) // r['length']}")) for r in held]
        for piece in sorted(pieces, key=lambda p: -len(p.ids)):
            for own in packer.add(piece):
                yield pa.RecordBatch.from_pylist(rows_of(level, part, seq, own), schema=PIECES_ARROW)
                seq += 1
        if not last:
            yield from left_over(level, part, packer.left())
            return
        for own in divided(packer.left(), length):
            yield pa.RecordBatch.from_pylist(rows_of(level, part, seq, own), schema=PIECES_ARROW)
            seq += 1

    def merge_table(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(merge(rows)), PIECES_ARROW)

    # In the last level there are `FAN` tasks at most, so that this is one group as well.
    return left.groupBy(F.expr(f"part div {FAN}")).applyInArrow(merge_table, PIECES)


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, length: int = LENGTH, windows: int = WINDOWS, least_cut: int = LEAST_CUT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: `doc_id`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`, and `ids` (little-endian).

    A document is its ids and the end id; every id is in one piece. Sequences are numbered from 0 without
    gaps and hold `length` ids at most; one that holds fewer, and not a power of two, is to be padded.
    A null text is empty (its end id only), a null id stays null, repeated rows are packed each. A document
    longer than a sequence is cut at multiples of it, and its rest placed like a short one. Other columns,
    whatever their names, are left out. An empty table gives no pieces.
    """
    options = {"length": length, "windows": windows, "least_cut": least_cut}
    done = [stored(packed_tasks(docs, tokenizer, end_id, doc_id=doc_id, text=text, **options), "pack")]
    parts, level = (done[0].agg(F.max("part")).first()[0] or 0) + 1, 0
    last = False
    while not last:
        level, last = level + 1, parts <= FAN
        done.append(stored(merged_tasks(done[-1].where("seq IS NULL"), level, last, **options), "pack-merge"))
        parts = -(-parts // FAN)
    every = done[0]
    for df in done[1:]:
        every = every.unionByName(df)
    every = every.where("seq IS NOT NULL")
    # Sequences before those of each task: a row a task, in one small window and sent to every task.
    numbers = every.groupBy("level", "part").agg((F.max("seq") + 1).alias("_n"))
    first = numbers.selectExpr("level", "part", "coalesce(sum(_n) OVER (ORDER BY level, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _first")
    out = every.join(F.broadcast(first), ["level", "part"])
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_first") + F.col("seq")).alias("sequence_id"), "offset", "ids")


def sequences(pieces: DataFrame, length: int = LENGTH, width: int = 2, pad_id: int = 0) -> DataFrame:
    """What `pack` packed as rows to train on: `sequence_id`, `n_tokens`, `ids` (bytes, padded), `doc_ids` and `lengths` of its pieces in order."""
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    rows = pieces.groupBy("sequence_id").agg(held.alias("p"), F.sum("length").alias("n_tokens"))
    is_power = F.bit_count("n_tokens") == 1
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    padded = F.when(is_power, joined).otherwise(F.concat(joined, F.expr(f"unhex(repeat('{pad_id.to_bytes(width, 'little').hex()}', CAST({length} - n_tokens AS INT)))")))
    return rows.select("sequence_id", "n_tokens", padded.alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), F.transform("p", lambda x: x["length"]).alias("lengths"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents")).drop("ids")
