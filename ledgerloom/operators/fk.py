"""Foreign keys between id spaces: remap them, or hold rows back until parents arrive."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import tokens


class Link(NamedTuple):
    child_col: str
    parent_table: str
    parent_col: str


def table_order(tables: list[str], links: dict[str, list[Link]]) -> list[str]:
    """Tables with parents before children; links of a table to itself don't count, and cycles end in name order."""
    left, out = sorted(tables), []
    while left:
        free = [t for t in left if all(link.parent_table == t or link.parent_table not in left for link in links.get(t, []))]
        out += free or left[:1]
        left = [t for t in left if t not in out]
    return out


#: Join keys over which rows without a foreign key are spread.
SPREAD = 1024
#: Child rows up to which their different foreign keys are sent to the parents; `child_count` says how many there are.
BROADCAST_ROWS = 100_000


def needed(ids: DataFrame, token: str, child: DataFrame, fk: str, child_count: int | None) -> DataFrame:
    """The parents (by `token`) that some child names. With few children the others go before anything is moved."""
    if child_count is None or child_count > BROADCAST_ROWS:
        return ids
    return ids.join(F.broadcast(child.select(F.col(fk).alias(token)).where(F.col(token).isNotNull()).distinct()), token, "left_semi")


def _resolved(child: DataFrame, link: Link, ids: DataFrame, i: int, rewrite: bool) -> DataFrame:
    """`child` with `_late_i`, and with `rewrite` its foreign key replaced.

    Rows without a foreign key match nothing. A second join key, 0 wherever there is a foreign key, deals
    them out by a hash of the row, so that many of them don't gather in one task.
    """
    fk, token = F.col(f"_fk_{i}"), F.col(f"_token_{i}")
    spread = F.when(fk.isNull(), F.pmod(F.xxhash64(*child.columns), F.lit(SPREAD)) + 1).otherwise(F.lit(0))
    known = ids.withColumns({f"_found_{i}": F.lit(True), f"_zero_{i}": F.xxhash64(token) % 1})
    found = child.withColumn(f"_spread_{i}", spread).join(known, (fk == token) & (F.col(f"_spread_{i}") == F.col(f"_zero_{i}")), "left")
    late = F.col(link.child_col).isNotNull() & F.col(f"_found_{i}").isNull()
    out = found.withColumn(f"_late_{i}", late)
    if rewrite:
        out = out.withColumn(link.child_col, F.when(F.col(f"_found_{i}"), F.col(f"_id_{i}")).otherwise(F.col(link.child_col)).cast(child.schema[link.child_col].dataType))
    return out.drop(*(f"_{x}_{i}" for x in ("found", "token", "id", "fk", "spread", "zero")))


def _split(child: DataFrame, columns: list[str], n: int) -> tuple[DataFrame, DataFrame]:
    late = F.lit(False)
    for i in range(n):
        late = late | F.col(f"_late_{i}")
    return child.where(~late).select(*columns), child.where(late).select(*columns)


def with_remapped(child: DataFrame, parents: dict[str, DataFrame], links: list[Link], source_id: str, adopt_legacy: bool = False, child_count: int | None = None) -> DataFrame:
    """`child` with foreign keys in the target's ids and `_late_i` for every link i whose parent is unknown.

    Each token stands for one parent, the smallest id if lineage is not unique, so that no child row multiplies.
    With `adopt_legacy` an unlabelled parent stands for its own key, unless a labelled one has that record id.
    """
    out = child
    for i, link in enumerate(links):
        parent, key = parents[link.parent_table], F.col(link.parent_col)
        named = parent.where((F.col("sync_source_id") == source_id) & F.col("source_record_id").isNotNull()).select(F.col("source_record_id").alias(f"_token_{i}"), F.struct(F.lit(0).alias("rank"), key.alias("id")).alias("best"))
        if adopt_legacy:
            own = tokens.source_record_token(key, parent.schema[link.parent_col].dataType)
            named = named.union(parent.where(F.col("sync_source_id").isNull() & key.isNotNull()).select(own, F.struct(F.lit(1).alias("rank"), key.alias("id"))))
        out = out.withColumn(f"_fk_{i}", tokens.source_record_token(F.col(link.child_col), child.schema[link.child_col].dataType))
        asked = child.select(tokens.source_record_token(F.col(link.child_col), child.schema[link.child_col].dataType).alias(f"_fk_{i}"))
        ids = needed(named, f"_token_{i}", asked, f"_fk_{i}", child_count).groupBy(f"_token_{i}").agg(F.min("best").alias("best")).select(f"_token_{i}", F.col("best.id").alias(f"_id_{i}"))
        out = _resolved(out, link, ids, i, rewrite=True)
    return out


def remap_fks(child: DataFrame, parents: dict[str, DataFrame], links: list[Link], source_id: str, adopt_legacy: bool = False, child_count: int | None = None) -> tuple[DataFrame, DataFrame]:
    """J5. (ready, deferred): foreign keys replaced by the target ids of the parents known by (source, record id).

    A null key passes. Every link has a join of its own, so two links to one parent don't mix; all must resolve.
    Deferred rows keep the keys they came with.
    """
    marked = child.withColumns({f"_was_{i}": F.col(link.child_col) for i, link in enumerate(links)})
    ready, late = _split(with_remapped(marked, parents, links, source_id, adopt_legacy, child_count), marked.columns, len(links))
    back = late.withColumns({link.child_col: F.col(f"_was_{i}") for i, link in enumerate(links)})
    return ready.select(*child.columns), back.select(*child.columns)


def with_found(child: DataFrame, parents: dict[str, DataFrame], links: list[Link], child_count: int | None = None) -> DataFrame:
    """`child` with `_late_i` for every link i whose parent is unknown; foreign keys stay."""
    out = child
    for i, link in enumerate(links):
        ids = parents[link.parent_table].select(F.col(link.parent_col).alias(f"_token_{i}")).where(f"_token_{i} IS NOT NULL")
        ids = needed(ids, f"_token_{i}", child, link.child_col, child_count).distinct().withColumn(f"_id_{i}", F.lit(None))
        out = _resolved(out.withColumn(f"_fk_{i}", F.col(link.child_col)), link, ids, i, rewrite=False)
    return out


def split_by_parent(child: DataFrame, parents: dict[str, DataFrame], links: list[Link], child_count: int | None = None) -> tuple[DataFrame, DataFrame]:
    """J6. (ready, deferred): rows whose non-null foreign keys all exist on the target, unchanged, and the others."""
    return _split(with_found(child, parents, links, child_count), child.columns, len(links))
