"""Alignment of two tokenizers: which tokens of one overlap which of the other, and how often in the whole corpus.

Both tokenizers are byte-exact, so tokens have byte ranges in the same bytes. A pair of
ids is linked wherever their ranges overlap. The index is inverted: a pair's posting is,
for every block of documents, a row of compressed bitmaps, one a plane. A document is in
plane k if bit k of the number of its links with that pair is set. Planes OR-merged are
the documents that hold the pair, and popcounts weighed by plane are its links. Postings
carry what the whole corpus says of a pair back to the documents that hold it.

A bitmap is an array of 16-bit places or, once that is longer, a bit for every document
of the block, with a leading byte that says which.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import kept, load, stored, text_slices

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A block of documents is closed once it has so many documents or links; a document is never divided.
BLOCK_DOCS, BLOCK_LINKS = 1 << 16, 1 << 21
#: A pair is `a << B_BITS | b`.
B_BITS = 20
ARRAY, BITS = b"a", b"b"
#: The sign that stands for a space in pieces of B. Texts that hold it as such can't be told from it.
GAP = "▁"
#: Units whose alignment a worker remembers; one takes under 2,000 bytes, for the most part under 600.
MEMO_UNITS = 600_000


class Unit(NamedTuple):
    """The alignment of a piece of text: how many tokens of A and B, groups and links; the groups as text; the links as pairs."""

    numbers: tuple[int, int, int, int]
    groups: bytes
    pairs: bytes


#: What stands for a piece that a tokenizer doesn't give back; a text with one has no tokens.
NOTHING = Unit((0, 0, 0, 0), b"", b"")
#: What follows an id in the text of groups.
MARKS = (b",", b"|", b";", b"")


class Aligner(bpe.PieceMemo):
    """Alignments of units. A unit begins with the space or line end before it, where both tokenizers begin a token.

    No piece of B holds a space after other text, and none a line end; the splitting rule of A begins a word at
    either. This holds where no two white-space characters meet; other texts are one unit.
    """

    ODD = bpe.ByteCounts.ODD + f"|{GAP}"

    def __init__(self, paths: tuple[str, str], limit: int = MEMO_UNITS):
        import sentencepiece
        from tokenizers import Tokenizer

        super().__init__(limit)
        self.a = Tokenizer.from_file(paths[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        letters = {c: b for b, c in bpe.LETTERS.items()}
        named = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else b"" for t, i in self.a.get_vocab().items()}
        self.a_bytes = [named.get(i, b"") for i in range(max(named) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(GAP, " ").encode() for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.most = max(len(self.a_bytes), len(self.b_bytes))
        self.marked = [b"%d%s" % (i, mark) for mark in MARKS for i in range(self.most)]
        self.marked_sizes = np.array(list(map(len, self.marked)), np.int64)

    def aligned(self, pieces: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> list[Unit]:
        """The units of `pieces`, all at once; NOTHING for those that a row of tokens doesn't spell.

        The pieces lie end to end. Every place where a token of A or B ends is one link, of the tokens that
        hold the byte before it; every place where both end closes a group.
        """
        raw = [p.encode() for p in pieces]
        size = np.array(list(map(len, raw)), np.int64)
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (a_ids, b_ids))
        a, b = (np.array([i for x in ids for i in x], np.int64) for ids in (a_ids, b_ids))
        of_a, of_b = (np.repeat(np.arange(len(raw)), n) for n in (n_a, n_b))
        total = lambda of, w: np.bincount(of, w, len(raw)).astype(np.int64)
        good = (total(of_a, self.a_sizes[a]) == size) & (total(of_b, self.b_sizes[b]) == size) & (size > 0)
        spelled = lambda ids, table: b"".join(map(table.__getitem__, ids))
        a, b, of_a, of_b = a[good[of_a]], b[good[of_b]], of_a[good[of_a]], of_b[good[of_b]]
        own = b"".join(raw[i] for i in np.flatnonzero(good).tolist())
        if spelled(a.tolist(), self.a_bytes) != own or spelled(b.tolist(), self.b_bytes) != own:
            if len(pieces) == 1:
                return [NOTHING]
            return [u for p, x, y in zip(pieces, a_ids, b_ids) for u in self.aligned([p], [x], [y])]
        end_a, end_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        pairs, n_links = (a[at_a] << B_BITS | b[at_b]).tobytes(), np.bincount(of_a[at_a], minlength=len(raw))
        closing = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(closing, end_a), np.searchsorted(closing, end_b)
        last_a, last_b = closing[group_a] == end_a, closing[group_b] == end_b
        n_groups = np.bincount(of_b[last_b], minlength=len(raw))
        final = last_b & (np.append(of_b[1:], -1) != of_b)
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        codes = np.concatenate((a + self.most * last_a, b + self.most * np.where(final, 3, 2 * last_b)))[order]
        groups, n_text = spelled(codes.tolist(), self.marked), total(np.concatenate((of_a, of_b))[order], self.marked_sizes[codes])
        out, to_text, to_link = [], np.cumsum(n_text).tolist(), (8 * np.cumsum(n_links)).tolist()
        for ok, *numbers, t, e, l, f in zip(good.tolist(), n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), n_text.tolist(), to_text, n_links.tolist(), to_link):
            out.append(Unit(tuple(numbers), groups[e - t : e], pairs[f - 8 * l : f]) if ok else NOTHING)
        return out

    def learn(self, pieces: list[str]) -> list[Unit]:
        a, other, tokenize = [], [], self.a.model.tokenize
        for i, p in enumerate(pieces):
            if p[0] == " " and p[1:].isalpha() and max(p) <= bpe.LATIN:  # one word
                a.append([t.id for t in tokenize(bpe.spelled(p))])
            else:
                other.append(i)
                a.append([])
        for i, encoding in zip(other, self.a.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False)):
            a[i] = encoding.ids
        # B puts a space first: a unit goes without its own, and before a line end the space is dropped again.
        b = self.b.encode([p.removeprefix(" ") for p in pieces], num_threads=1)
        return self.aligned(pieces, a, [y if p[0] == " " else y[1:] for p, y in zip(pieces, b)])

    def whole(self, text: str) -> Unit:
        """The unit of a text that can't be cut."""
        if GAP in text:
            return NOTHING
        return self.aligned([" " + text], [self.a.encode(" " + text, add_special_tokens=False).ids], [self.b.encode(text, num_threads=1)])[0]

    def documents(self, texts: pa.Array) -> Iterator[tuple[list[int], str, bytes]]:
        """Of each of `texts` (no nulls): its numbers, the digest of its groups, its links as pairs."""
        odd = pc.match_substring_regex(texts, self.ODD)
        plain = pc.if_else(pc.or_(odd, pc.equal(texts, "")), "", pc.binary_join_element_wise("", texts, " "))
        marked = pc.replace_substring(pc.replace_substring(plain, " ", "\0 "), "\n", "\0\n")
        codes, pieces, starts = bpe.different(pc.split_pattern(marked, "\0"))
        units = self.values([p or " " for p in pieces])  # what precedes the first mark is nothing
        numbers = np.array([u.numbers if p else (0, 0, 0, 0) for p, u in zip(pieces, units)], np.int64).reshape(-1, 4)
        failed = np.array([u is NOTHING and p != "" for p, u in zip(pieces, units)], bool)
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(numbers[codes], axis=0)))
        fails = np.concatenate(([0], np.cumsum(failed[codes])))
        groups, pairs = [u.groups for u in units], [u.pairs for u in units]
        is_odd = odd.to_numpy(zero_copy_only=False)
        for d in range(len(texts)):
            a, b = starts[d], starts[d + 1]
            if is_odd[d]:
                unit = self.whole(texts[d].as_py())
                yield list(unit.numbers), sha256(unit.groups).hexdigest() if unit is not NOTHING else "", unit.pairs
            elif fails[b] > fails[a] or b - a == 1:
                yield [0, 0, 0, 0], "", b""
            else:
                own = codes[a + 1 : b].tolist()
                yield (sums[b] - sums[a]).tolist(), sha256(b";".join([groups[c] for c in own])).hexdigest(), b"".join([pairs[c] for c in own])


def kept_aligner(names: tuple[str, str]) -> Aligner:
    return kept(("Aligner", *names), lambda: Aligner(tuple(map(bpe.vocabulary, names))))


def bitmap(places: np.ndarray, size: int) -> bytes:
    """Sorted places, under `size`, as the shorter of both forms."""
    if 2 * len(places) <= (size + 7) // 8:
        return ARRAY + places.astype("<u2").tobytes()
    bits = np.zeros(size, bool)
    bits[places] = True
    return BITS + np.packbits(bits, bitorder="little").tobytes()


def places(data: bytes) -> np.ndarray:
    if data[:1] == ARRAY:
        return np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))


def popcount(data: bytes) -> int:
    return (len(data) - 1) // 2 if data[:1] == ARRAY else int(np.bitwise_count(np.frombuffer(data, np.uint8, offset=1)).sum())


def merged(planes: list[bytes]) -> bytes:
    """The OR of bitmaps of a block."""
    if len(planes) == 1:
        return planes[0]
    if all(p[:1] == ARRAY for p in planes):
        return ARRAY + np.unique(np.concatenate([places(p) for p in planes])).astype("<u2").tobytes()
    out = np.zeros(max(8 * len(p) for p in planes if p[:1] == BITS), bool)
    for p in planes:
        out[places(p)] = True
    return BITS + np.packbits(out, bitorder="little").tobytes()


class Block:
    """Links of the documents of a task, until a block is full: rows (pair, planes) of their bitmaps."""

    def __init__(self):
        self.docs, self.n_links, self.pairs, self.counts = 0, 0, [], []

    def add(self, pairs: np.ndarray) -> None:
        self.pairs.append(pairs)
        self.counts.append(len(pairs))
        self.docs += 1
        self.n_links += len(pairs)

    def postings(self) -> tuple[list[int], list[list[bytes]]]:
        links = np.concatenate(self.pairs) << 16 | np.repeat(np.arange(self.docs), self.counts)
        links.sort()
        first = np.flatnonzero(np.diff(links, prepend=-1))
        times, links = np.diff(first, append=len(links)), links[first]
        new = np.diff(links >> 16, prepend=-1) != 0
        pairs, entries = links[new] >> 16, (np.cumsum(new) - 1) << 16 | links & 0xFFFF
        out = [[] for _ in pairs]
        for k in range(int(times.max(initial=0)).bit_length()):
            # Of a pair without documents in this plane an empty bitmap stands, if a higher plane has some.
            own = entries[times >> k & 1 == 1]
            cuts, at = np.searchsorted(own >> 16, np.arange(len(pairs) + 1)), (own & 0xFFFF).astype("<u2")
            flat, dense = at.tobytes(), (self.docs + 7) // 8
            for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if a < b:
                    out[i] += [ARRAY] * (k - len(out[i]))
                    out[i].append(ARRAY + flat[2 * a : 2 * b] if 2 * (b - a) <= dense else bitmap(at[a:b], self.docs))
        return pairs.tolist(), out


#: A row is either a document of a block (`pairs` is null) or all postings of a block, pair by pair (`place` is null).
INDEX = "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, planes array<array<binary>>"
INDEX_ARROW = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("planes", pa.list_(pa.list_(pa.binary())))])


def table(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in INDEX_ARROW], schema=INDEX_ARROW)


def indexed(docs: DataFrame, tokenizers: tuple[str, str] = (TOKENIZER_A, TOKENIZER_B), block_docs: int = BLOCK_DOCS, block_links: int = BLOCK_LINKS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents and postings of `docs`, block by block, in the columns `INDEX`. To be stored before use: blocks are numbered by task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block, number = kept_aligner(tokenizers), Block(), TaskContext.get().partitionId() << 32
        for batch in text_slices(batches):
            ids, out = batch.column(0).to_pylist(), []

            def closed():
                nonlocal block, number, out
                if out:
                    yield table(block=[number] * len(out), place=[x[0] for x in out], doc_id=[x[1] for x in out], **{c: [x[2][i] for x in out] for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}, groups_sha256=[x[3] for x in out])
                out = []
                if block.docs >= block_docs or block.n_links >= block_links:
                    yield from written()

            def written():
                nonlocal block, number
                pairs, planes = block.postings()
                yield table(block=[number], pairs=[pairs], planes=[planes])
                block, number = Block(), number + 1

            for key, (numbers, digest, pairs) in zip(ids, aligner.documents(pc.fill_null(batch.column(1), ""))):
                out.append((block.docs, key, numbers, digest))
                block.add(np.frombuffer(pairs, np.int64))
                if block.docs >= block_docs or block.n_links >= block_links:
                    yield from closed()
            yield from closed()
        if block.docs:
            yield from written()

    return docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(rows, INDEX)


def pair_counts(index: DataFrame) -> DataFrame:
    """Of every linked pair: `pair`, `a`, `b`, `n_docs`, `n_links` in the whole corpus, and `is_best`, if no other id of A has more links with `b`."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                planes = batch.column(1)[at].as_py()
                yield pa.RecordBatch.from_arrays([batch.column(0)[at].values, pa.array([popcount(merged(p)) for p in planes], pa.int64()), pa.array([sum(popcount(x) << k for k, x in enumerate(p)) for p in planes], pa.int64())], names=["pair", "n_docs", "n_links"])

    each = index.where("pairs IS NOT NULL").select("pairs", "planes").mapInArrow(counted, "pair long, n_docs long, n_links long")
    sums = stored(each.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")), "align-pairs")
    sums = sums.select("pair", F.shiftright("pair", B_BITS).alias("a"), F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b"), "n_docs", "n_links")
    best = sums.groupBy("b").agg(F.max("n_links").alias("most"))
    return sums.join(best, "b").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("is_best"))


SCORES = "block long, place int, n_best long, count_sum long"


def scored(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Of every document that holds a pair: (block, place), its links that are best for their B id, and the sum of its links' counts.

    Only the numbers of the pairs travel to be joined with their counts; what comes back to a block is a list of
    its pairs, which are bounded, and meets its postings.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, pairs, planes, said = (batch.column(c)[i] for c in ("block", "pairs", "planes", "said"))
                pairs, said = pairs.values.to_numpy(), said.values
                own, n, is_best = (said.field(c).to_numpy(zero_copy_only=False) for c in ("pair", "n_links", "is_best"))
                order = np.argsort(own)
                order = order[np.searchsorted(own[order], pairs)]
                n_best, count_sum, seen = np.zeros(BLOCK_DOCS + 1, np.int64), np.zeros(BLOCK_DOCS + 1, np.int64), np.zeros(BLOCK_DOCS + 1, bool)
                for held, times, best in zip(planes.as_py(), n[order].tolist(), is_best[order].tolist()):
                    for k, data in enumerate(held):
                        at = places(data)
                        count_sum[at] += times << k
                        seen[at] = True
                        if best:
                            n_best[at] += 1 << k
                at = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block.as_py(), np.int64)), pa.array(at, pa.int32()), pa.array(n_best[at]), pa.array(count_sum[at])], names=["block", "place", "n_best", "count_sum"])

    held = index.where("pairs IS NOT NULL")
    asked = held.select("block", F.explode("pairs").alias("pair")).join(counts.select("pair", "n_links", "is_best"), "pair")
    said = asked.groupBy("block").agg(F.collect_list(F.struct("pair", "n_links", "is_best")).alias("said"))
    return held.select("block", "pairs", "planes").join(said, "block").mapInArrow(sums, SCORES)


def align(docs: DataFrame, **options) -> DataFrame:
    """Per document `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    A text that is null or empty, or that a tokenizer doesn't give back byte by byte, has no tokens: zeros and
    an empty digest. Repeated rows count each, a null id stays null. A very long text is aligned whole and is in
    one block. Ties for the highest count are all best. Other columns, whatever their names, are left out. An
    empty table gives none.
    """
    index = stored(indexed(docs, **options), "align-index")
    found = scored(index, pair_counts(index))
    own = index.where("pairs IS NULL").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    both = own.join(found, ["block", "place"], "left")
    return both.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    return align(load(spark, sf_dir, "documents"))
