"""Schemas: alignment, target types, rows that can't land, drift and conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE_TYPES = {"sync_source_id": T.StringType(), "source_record_id": T.StringType()}
#: Declared text widths from which a target column is unbounded.
UNBOUNDED_FROM = 50


def align_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """P6. The target with typed nulls for columns that the source gained and for the lineage pair. Nothing is dropped or retyped."""
    held = {c.lower() for c in target.columns}
    new = {f.name: f.dataType for f in source.schema if f.name.lower() not in held}
    new |= {c: t for c, t in LINEAGE_TYPES.items() if c not in held and c not in {n.lower() for n in new}}
    return target.withColumns({c: F.lit(None).cast(t) for c, t in new.items()}) if new else target


def target_schema(schema: T.StructType, default_decimal: T.DecimalType = T.DecimalType(18, 4)) -> T.StructType:
    """P7. The types that a target takes: declared widths under 50 stay as metadata, other texts are unbounded,
    zoned times lose their zone, unbounded decimals get (18, 4); nullability stays, lineage comes last."""
    out = []
    for f in schema:
        kind, about = f.dataType, dict(f.metadata)
        if isinstance(kind, (T.CharType, T.VarcharType)):
            if kind.length < UNBOUNDED_FROM:
                about["length"] = kind.length
            kind = T.StringType()
        elif isinstance(kind, T.StringType) and about.get("length", UNBOUNDED_FROM) >= UNBOUNDED_FROM:
            about.pop("length", None)
        elif isinstance(kind, T.TimestampType):
            kind = T.TimestampNTZType()
        elif isinstance(kind, T.ByteType):
            kind = T.ShortType()
        elif isinstance(kind, T.FloatType):
            kind = T.DoubleType()
        elif isinstance(kind, T.DecimalType) and kind == T.DecimalType():
            kind = default_decimal
        out.append(T.StructField(f.name, kind, f.nullable, about))
    names = {f.name.lower() for f in out}
    return T.StructType([*out, *(T.StructField(c, t, True) for c, t in LINEAGE_TYPES.items() if c not in names)])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """P7. `df` in the columns and types of `schema`; columns it lacks are null, values that can't be cast too."""
    names = {c.lower(): c for c in df.columns}
    return df.select(*((F.col(names[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def rejection(df: DataFrame, schema: T.StructType) -> Column:
    """P8. Why a row can't land: a null where `schema` allows none, or a value it can't hold; null for rows that can."""
    reason = F.lit(None).cast("string")
    for f in reversed([f for f in schema if f.name in df.columns]):
        c = F.col(f"`{f.name}`")
        reason = F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}")).otherwise(reason)
        if not f.nullable:
            reason = F.when(c.isNull(), F.lit(f"{f.name}: null")).otherwise(reason)
    return reason


def split_rejects(df: DataFrame, schema: T.StructType, key: str) -> tuple[DataFrame, DataFrame]:
    """P8. (rows that land, rejected keys with the reason): no null where the target allows none, no value it can't hold."""
    marked = df.withColumn("_reason", rejection(df, schema))
    ok = marked.where(F.col("_reason").isNull()).select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns))
    return ok, marked.where(F.col("_reason").isNotNull()).select(F.col(key).cast("string").alias("pk_value"), F.col("_reason").alias("reason"))


def schema_conflicts(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """J13. Conflicts between the sources of each table, for every pair of sources in name order.

    `columns`: source_id, table_name, column_name (case-sensitive), data_type, length. `keys`: source_id,
    table_name, column_name, ordinal. Kinds: KEY and TYPE are CRITICAL, MISSING (reported with the source
    that has the column) is WARNING, LENGTH (equal types, both lengths above 0) is INFO.
    """
    sources = columns.select("table_name", "source_id").distinct()
    a, b = sources.withColumnRenamed("source_id", "source_a"), sources.withColumnRenamed("source_id", "source_b")
    pairs = a.join(b, "table_name").where("source_a < source_b")
    side = lambda s: columns.select("table_name", F.col("source_id").alias(f"source_{s}"), "column_name", F.col("data_type").alias(f"type_{s}"), F.col("length").alias(f"length_{s}"))
    left = pairs.join(side("a"), ["table_name", "source_a"])
    right = pairs.join(side("b"), ["table_name", "source_b"])
    both = left.join(right, ["table_name", "source_a", "source_b", "column_name"], "full_outer")
    kind = F.when(F.col("type_a").isNull() | F.col("type_b").isNull(), "MISSING").when(F.col("type_a") != F.col("type_b"), "TYPE").when((F.col("length_a") > 0) & (F.col("length_b") > 0) & (F.col("length_a") != F.col("length_b")), "LENGTH")
    found = both.withColumn("kind", kind).where("kind IS NOT NULL")
    swapped = (F.col("kind") == "MISSING") & F.col("type_a").isNull()
    first, second = F.when(swapped, F.col("source_b")).otherwise(F.col("source_a")), F.when(swapped, F.col("source_a")).otherwise(F.col("source_b"))
    by_column = found.select("table_name", first.alias("first_source"), second.alias("second_source"), "column_name", "kind")

    listed = keys.groupBy("table_name", "source_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "column_name"))), lambda s: s["column_name"]).alias("key"))
    key_of = lambda s: listed.select("table_name", F.col("source_id").alias(f"source_{s}"), F.col("key").alias(f"key_{s}"))
    keyed = pairs.join(key_of("a"), ["table_name", "source_a"], "left").join(key_of("b"), ["table_name", "source_b"], "left")
    none = F.array().cast("array<string>")
    by_key = keyed.where(F.coalesce("key_a", none) != F.coalesce("key_b", none)).select("table_name", F.col("source_a").alias("first_source"), F.col("source_b").alias("second_source"), F.lit(None).cast("string").alias("column_name"), F.lit("KEY").alias("kind"))
    severity = F.when(F.col("kind").isin("KEY", "TYPE"), "CRITICAL").when(F.col("kind") == "MISSING", "WARNING").otherwise("INFO")
    return by_column.unionByName(by_key).withColumn("severity", severity)


def column_set_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """J14. Per table of the source (table_name, column_name on both sides): are the column sets equal?

    Names are lower-cased, the lineage pair doesn't count. The first that holds: ABSENT, COUNT, MISSING, EXTRA, OK.
    """
    name = F.lower("column_name")
    own = lambda df, c: df.where(~name.isin(*LINEAGE_TYPES)).groupBy("table_name").agg(F.array_sort(F.collect_set(name)).alias(c))
    there = target.select("table_name").distinct().withColumn("_there", F.lit(True))
    none = F.array().cast("array<string>")
    both = source.select("table_name").distinct().join(own(source, "s"), "table_name", "left").join(own(target, "t"), "table_name", "left").join(there, "table_name", "left")
    both = both.select("table_name", "_there", F.coalesce("s", none).alias("s"), F.coalesce("t", none).alias("t"))
    missing, extra = F.array_except("s", "t"), F.array_except("t", "s")
    verdict = F.when(F.col("_there").isNull(), "ABSENT").when(F.size("s") != F.size("t"), "COUNT").when(F.size(missing) > 0, "MISSING").when(F.size(extra) > 0, "EXTRA").otherwise("OK")
    return both.select("table_name", verdict.alias("verdict"), F.array_join(missing, ",").alias("missing"), F.array_join(extra, ",").alias("extra"))


def captured_tables(rules: DataFrame, scope: DataFrame, n: int) -> DataFrame:
    """A12. Tables in scope with whether at least `n` different capture rules cover them; those not captured are newly found."""
    full = rules.select("table_name", "rule_name").distinct().groupBy("table_name").count().where(F.col("count") >= n).select("table_name", F.lit(True).alias("captured"))
    return scope.select("table_name").distinct().join(full, "table_name", "left").select("table_name", F.coalesce("captured", F.lit(False)).alias("captured"))


def scope_list(counts: DataFrame) -> DataFrame:
    """A13. All names, and names with counts, in one ordered list each."""
    return counts.select("table_name", F.concat_ws("=", "table_name", F.col("n_rows").cast("string")).alias("pair")).agg(
        F.expr("listagg(table_name, ', ') WITHIN GROUP (ORDER BY table_name)").alias("names"), F.expr("listagg(pair, ', ') WITHIN GROUP (ORDER BY pair)").alias("names_with_counts")
    )
