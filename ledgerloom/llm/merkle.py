"""A Merkle manifest of a dataset: a leaf a row, a tree a language, and one root over the languages' subroots.

Trees are cut into aligned blocks of 1,024 leaves, ten levels high, and what tops the
blocks is cut into blocks in turn, until a language has one. A block is a row, and a
task needs nothing but the block and the path above it, so no tree is ever in one place.

Inside a block the tree is persistent: `Tree.put` makes a version with one other leaf,
which copies the ancestors of that leaf and shares every other node. The version's top
then goes on through the path above its block, as `folded` does it: the same siblings,
other ancestors. A row verifies if its version ends in the root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.keys import add_dense_id

from .common import load, stored

#: Levels of a block, which stands on 2 ** HEIGHT nodes.
HEIGHT = 10
#: Columns of a leaf, in their order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: A row is tampered with, in the query, where this divides the crc32 of its id.
TAMPER_EVERY = 7

ITEM = "struct<pos:bigint,hash:string,tag:string,changed:string>"
PATHS = "g string, parent long, block long, tag string, own array<string>"
PATH_ARROW = pa.schema([("g", pa.string()), ("parent", pa.int64()), ("block", pa.int64()), ("tag", pa.string()), ("own", pa.list_(pa.string()))])


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Tree:
    """A persistent tree over the nodes of one block; `levels[0]` are its leaves. `height` levels, or up to a single node without it."""

    def __init__(self, leaves: list[str], height: int | None = None):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1 if height is None else len(self.levels) <= height:
            below = self.levels[-1]
            self.levels.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, place: int) -> list[str]:
        """The siblings of a leaf and of its ancestors, from below; a node alone in its run has none."""
        out = []
        for nodes in self.levels[:-1]:
            if place ^ 1 < len(nodes):
                out.append(nodes[place ^ 1])
            place >>= 1
        return out

    def put(self, place: int, leaf: str) -> list[str]:
        """A version with another leaf: its copied path from leaf to top. Every other node is shared with this tree."""
        path = [leaf]
        for nodes in self.levels[:-1]:
            run = nodes[place & ~1 : place | 1], nodes[place + 1 : (place | 1) + 1]
            path.append(digest(*run[0], path[-1]) if place & 1 else digest(path[-1], *run[1]))
            place >>= 1
        return path


def folded(node: str, pos: int, n: int, siblings: Iterator[str]) -> str:
    """The root over `n` nodes of which `node` is the one at `pos`, by its siblings from below."""
    while n > 1:
        if pos & 1:
            node = digest(next(siblings), node)
        elif pos + 1 < n:
            node = digest(node, next(siblings))
        else:
            node = digest(node)
        pos, n = pos >> 1, (n + 1) >> 1
    return node


def block_tree(block: dict, height: int) -> Tree:
    """The tree of a block; `n` are the nodes of its whole level."""
    return Tree([i["hash"] for i in block["items"]], height if block["n"] > 1 << height else None)


def own_paths(blocks: DataFrame, height: int) -> DataFrame:
    """Of every node of the blocks its siblings in there: g, its block as `parent`, its place as `block`, tag, `own`."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in each_row(batches):
            tree = block_tree(b, height)
            yield pa.RecordBatch.from_pylist([{"g": b["g"], "parent": b["block"], "block": i["pos"], "tag": i["tag"], "own": tree.siblings(place)} for place, i in enumerate(b["items"])], schema=PATH_ARROW)

    return blocks.mapInArrow(paths, PATHS)


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def leaf_hash(columns: dict[str, Column]) -> Column:
    """The digest of a row: of each column `-` for null, else the bytes of its text, a colon and the text."""
    text = lambda c: c.cast("string")
    return F.sha2(F.concat(*(F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text(c)).cast("string"), F.lit(":"), text(c))) for c in columns.values())).cast("binary"), 256)


def in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Nodes (g, n, pos, hash, tag, changed) as rows of blocks: g, block, n, items; a row holds 2 ** `height` nodes at most."""
    item = F.struct("pos", "hash", "tag", "changed")
    return nodes.groupBy("g", F.shiftright("pos", height).alias("block")).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(item)).cast(f"array<{ITEM}>").alias("items"))


def above(blocks: DataFrame, crown: Callable[[DataFrame], DataFrame], height: int) -> DataFrame:
    """Of every block the path above it: g, block, `siblings` from below, and what `crown` says of the group.

    `crown` gets (g, top), one row a group, and returns (g, siblings, ...). A level has a 1,024th of the
    rows of the level under it, so there are few levels whatever the size.
    """

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in each_row(batches):
            yield pa.RecordBatch.from_pylist([{"g": b["g"], "block": b["block"], "n": -(-b["n"] >> height), "top": block_tree(b, height).top}])

    found = stored(blocks.mapInArrow(tops, "g string, block long, n long, top string"), "merkle-tops")
    if (found.agg(F.max("n")).first()[0] or 1) == 1:
        return crown(found.select("g", "top")).withColumn("block", F.lit(0).cast("long"))
    nodes = found.select("g", "n", F.col("block").alias("pos"), F.col("top").alias("hash"), F.lit(None).cast("string").alias("tag"), F.lit(None).cast("string").alias("changed"))
    upper = stored(in_blocks(nodes, height), "merkle-blocks")
    up = above(upper, crown, height).withColumnRenamed("block", "parent")
    joined = own_paths(upper, height).drop("tag").join(up, ["g", "parent"])
    return joined.withColumn("siblings", F.concat("own", "siblings")).drop("own", "parent")


def over_groups(tops: DataFrame, height: int) -> DataFrame:
    """The tree over the subroots: of each group its subroot, its path to the root, its place among the groups, and the root."""
    ranked = stored(add_dense_id(tops, ["g"], "pos", 0), "merkle-groups")
    n = ranked.count()
    nodes = ranked.select(F.lit("").alias("g"), F.lit(n).cast("long").alias("n"), "pos", F.col("top").alias("hash"), F.col("g").alias("tag"), F.lit(None).cast("string").alias("changed"))
    blocks = stored(in_blocks(nodes, height), "merkle-blocks")
    last = lambda top: top.select("g", F.array().cast("array<string>").alias("siblings"), F.col("top").alias("root"))

    up = above(blocks, last, height).select("g", F.col("block").alias("parent"), "siblings", "root")
    found = own_paths(blocks, height).join(up, ["g", "parent"])
    named = found.select(F.col("tag").alias("g"), F.concat("own", "siblings").alias("siblings"), "root", F.col("block").alias("g_pos"), F.lit(n).cast("long").alias("g_n"))
    return named.join(tops.select("g", F.col("top").alias("subroot")), "g")


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Of each row its group (language, null first in order), id, leaf, and the leaf after tampering (null without)."""
    held = {c: F.col(f"`{c}`") for c in LEAF_COLUMNS}
    own = leaf_hash(held)
    hit = F.crc32(held["doc_id"].cast("string").cast("binary")) % TAMPER_EVERY == 0 if tampered is None else tampered
    other = leaf_hash(held | {"n_chars": (held["n_chars"].cast(T.DecimalType(20, 0)) + 1)})
    group = F.when(held["lang"].isNull(), "-").otherwise(F.concat(F.lit("="), held["lang"].cast("string")))
    return docs.select(group.alias("g"), held["doc_id"].cast("long").alias("doc_id"), own.alias("leaf"), F.when(hit, other).alias("changed"))


def placed(rows: DataFrame) -> DataFrame:
    """`leaves` with the place of each among those of its group, `pos`, and how many these are, `n`.

    Rows are dealt by ranges of (group, id, leaf); equal rows, which may be many, by their place in the
    table. A place is the rows of the group in earlier ranges plus those before it in the own range.
    """
    order = ["g", "doc_id", "leaf", "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    dealt = stored(dealt.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)}), "merkle-leaves")
    counts = dealt.groupBy("g", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # Few rows: one a task and group.
    offsets = counts.selectExpr("g", "_part", "coalesce(sum(_n) OVER (PARTITION BY g ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - _first AS _shift", "sum(_n) OVER (PARTITION BY g) AS n")
    return dealt.join(offsets, ["g", "_part"]).select("g", "n", (F.col("_at") + F.col("_shift")).alias("pos"), F.col("leaf").alias("hash"), F.col("doc_id").cast("string").alias("tag"), "changed")


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """Per row of `docs` its leaf, subroot, root, the digest of its proof, the root that its version folds to, and whether they agree.

    `tampered` is a condition on `docs`: rows for which 1 is added to `n_chars` before they are verified
    (by default those whose id's crc32 7 divides). Nulls are parts of a leaf like any value; a null id
    comes first in its language, is never tampered with by default, and stays null; rows with null `lang`
    are a group, the first. Rows that share an id are ordered by their leaves; equal rows are leaves each.
    A text of any length is hashed whole. Other columns are left out, whatever their names. An empty table
    gives an empty manifest.
    """

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in each_row(batches):
            tree, n_blocks, out = block_tree(b, height), -(-b["n"] >> height), []
            for place, item in enumerate(b["items"]):
                version = tree.put(place, item["changed"] or item["hash"])
                rest = iter(b["siblings"])
                subroot = folded(version[-1], b["block"], n_blocks, rest)
                root = folded(subroot, b["g_pos"], b["g_n"], rest)
                proof = digest(*tree.siblings(place), *b["siblings"])
                tag = item["tag"]
                out.append({"doc_id": None if tag is None else int(tag), "leaf": item["hash"], "subroot": b["subroot"], "root": b["root"], "proof_sha256": proof, "folded_root": root, "verified": root == b["root"]})
            yield pa.RecordBatch.from_pylist(out, schema=RESULT_ARROW)

    blocks = stored(in_blocks(placed(stored(leaves(docs, tampered), "merkle-rows")), height), "merkle-blocks")
    paths = above(blocks, lambda tops: over_groups(tops, height), height)
    return blocks.join(paths, ["g", "block"]).mapInArrow(finish, RESULT)


RESULT_ARROW = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[f.split()[1]]) for f in RESULT.split(", ")])


def query(spark, sf_dir: str) -> DataFrame:
    return manifest(load(spark, sf_dir, "documents"))


#: The same by level: nodes of all levels, then each leaf climbs. DuckDB has no crc32: it is worked out bit by bit.
ORACLE = """
WITH RECURSIVE f AS (
    SELECT coalesce('=' || lang, '-') AS g, doc_id, n_chars,
           CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
           CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
           xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
    FROM documents),
l AS (
    SELECT g, doc_id, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS leaf,
           CASE WHEN crc % 7 = 0 THEN sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) END || tail) END AS changed FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM l),
t AS (
    SELECT g, 0 AS level, pos, leaf AS hash, n FROM p
    UNION ALL
    SELECT g, any_value(level) + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), any_value(n + 1) // 2 FROM t WHERE n > 1 GROUP BY g, pos // 2),
s AS (SELECT g, hash AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
    SELECT 0 AS level, pos, subroot AS hash, n FROM s
    UNION ALL
    SELECT any_value(level) + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), any_value(n + 1) // 2 FROM u WHERE n > 1 GROUP BY pos // 2),
c AS (
    SELECT g, pos AS own, 0 AS level, pos, n, coalesce(changed, leaf) AS node, '' AS proof FROM p
    UNION ALL
    SELECT c.g, own, c.level + 1, c.pos // 2, (c.n + 1) // 2, sha256(CASE WHEN c.pos % 2 = 1 THEN t.hash || node ELSE node || coalesce(t.hash, '') END), proof || coalesce(t.hash, '')
    FROM c LEFT JOIN t ON t.g = c.g AND t.level = c.level AND t.pos = xor(c.pos, 1) WHERE c.n > 1),
d AS (
    SELECT c.g, own, 0 AS level, s.pos, s.n, node, proof FROM c JOIN s ON s.g = c.g WHERE c.n = 1
    UNION ALL
    SELECT d.g, own, d.level + 1, d.pos // 2, (d.n + 1) // 2, sha256(CASE WHEN d.pos % 2 = 1 THEN u.hash || node ELSE node || coalesce(u.hash, '') END), proof || coalesce(u.hash, '')
    FROM d LEFT JOIN u ON u.level = d.level AND u.pos = xor(d.pos, 1) WHERE d.n > 1),
r AS (SELECT hash AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM d JOIN p ON p.g = d.g AND p.pos = d.own JOIN s ON s.g = d.g CROSS JOIN r WHERE d.n = 1
"""
