"""Canonical texts of keys and values: one rendering, so that lineage, diffs and logs agree.

Every function maps a column to a column by its type and keeps nulls null.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
#: All white space, as opposed to SQL's trim, which strips spaces only.
EDGES = r"^\s+|\s+$"
UUID = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
TEMPORAL_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?Z?$"
#: Numbers above this are epoch milliseconds.
EPOCH_MS_FROM = 100_000_000_000
RECORD_ID_WIDTH = 100

TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@F.pandas_udf(T.StringType())
def float_text(values: pd.Series) -> pd.Series:
    """Doubles as Python prints them (12345678.0, not 1.2345678E7)."""
    return values.map(lambda v: None if pd.isna(v) else str(v)).astype(object)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, EDGES, "")


def text_of_bytes(c: Column) -> Column:
    """UTF-8 text of bytes; what is no UTF-8 is dropped."""
    return F.replace(F.make_valid_utf8(c.cast("string")), F.lit("\ufffd"), F.lit(""))


def source_record_token(c: Column, kind: T.DataType) -> Column:
    """F1. The key text that lineage stores, at most 100 characters long (`fitted`)."""
    if isinstance(kind, T.BinaryType):
        text = strip(text_of_bytes(c))
    elif isinstance(kind, TEMPORAL):
        text = F.date_format(c, MILLIS)
    elif isinstance(kind, T.DecimalType):
        text = decimal_text(c, kind)
    elif isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        text = strip(c)
        text = F.when(text.rlike(UUID), F.upper(text)).otherwise(text)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        text = float_text(c.cast("double"))
    else:
        text = c.cast("string")
    return fitted(text)


def record_token(schema: T.StructType, keys: tuple[str, ...]) -> Column:
    """F1 of a whole key: tokens of its columns, joined by `|`."""
    each = [source_record_token(F.col(f"`{k}`"), schema[k].dataType) for k in keys]
    return each[0] if len(each) == 1 else fitted(F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in each)))


def identity_text(columns: list[Column]) -> Column:
    """A key as one text, different for different keys: a single column's text, several with their lengths; a null is its own value among several."""
    texts = [c.cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*(F.when(c.isNull(), "-").otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), c)) for c in texts))


def fitted(text: Column) -> Column:
    """Key text in at most 100 characters. Of a longer one the first 67, `#` and 32 digits of its SHA-256 stay, so that keys which differ later remain apart."""
    return F.when(F.length(text) <= RECORD_ID_WIDTH, text).otherwise(F.concat(F.substring(text, 1, RECORD_ID_WIDTH - 33), F.lit("#"), F.substring(F.sha2(text.cast("binary"), 256), 1, 32)))


def decimal_text(c: Column, kind: T.DecimalType) -> Column:
    """Decimals as Python prints the float: `5.0`. Short ones need no Python: 15 digits are exact, and none is under 0.0001."""
    if kind.precision > 15 or kind.scale > 4:
        return float_text(c.cast("double"))
    plain = c.cast("string")
    if kind.scale == 0:
        return F.concat(plain, F.lit(".0"))
    return F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", ".0")


def key_token(c: Column, kind: T.DataType) -> Column:
    """F2. The form in which keys of text and temporal columns compare: no outer white space, zero fraction, `T` or final `Z`; decimals as float text.

    Only text that looks like a timestamp is rewritten.
    """
    if isinstance(kind, TEMPORAL):
        text = F.date_format(c, MICROS)
    elif isinstance(kind, T.DecimalType):
        return decimal_text(c, kind)
    else:
        text = c.cast("string")
        if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
            text = strip(text)
        if not isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
            return text
    plain = F.regexp_replace(F.regexp_replace(text, "T", " "), "Z$", "")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(text.rlike(TEMPORAL_TEXT), plain).otherwise(text)


def audit_token(c: Column, kind: T.DataType) -> Column:
    """F3. The key text of the change log."""
    return F.date_format(c, MILLIS) if isinstance(kind, TEMPORAL) else c.cast("string")


def capture_key_text(c: Column, kind: T.DataType, declared: str = "datetime2") -> Column:
    """F4. Key text at capture: `datetime` and `smalldatetime` keep milliseconds, `datetime2` every digit."""
    if not isinstance(kind, TEMPORAL):
        return c.cast("string")
    return F.date_format(c, MILLIS if declared in ("datetime", "smalldatetime") else MICROS)


def epoch_ms_text(c: Column) -> Column:
    """F5. Epoch milliseconds as UTC timestamp text; smaller numbers as they are."""
    moment = F.date_format(F.timestamp_millis(F.when(c > EPOCH_MS_FROM, c.cast("long"))), MILLIS)
    return F.when(c > EPOCH_MS_FROM, moment).otherwise(c.cast("string"))


def legacy_label(c: Column, kind: T.DataType, declared: str = "datetime2") -> Column:
    """F6. The text that a back-fill stores: 23 characters of a timestamp, else spaces trimmed, in 100 characters (`fitted`)."""
    if isinstance(kind, TEMPORAL):
        return F.substring(F.date_format(c, MILLIS if declared == "datetime" else MICROS), 1, 23)
    return fitted(F.trim(c.cast("string")))


def clean_text(c: Column) -> Column:
    """F7. Text without outer white space, empty as null, and timestamps of six fraction digits cut to three."""
    text = F.nullif(strip(c), F.lit(""))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}\.\d{6}$"), F.substring(text, 1, 23)).otherwise(text)


def normalize(df: DataFrame, epoch_ms: tuple[str, ...] = (), uuids: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """P2. Every column as the target takes it: texts cleaned, bytes as text, times as text with milliseconds, decimals as doubles.

    Columns in `keep` stay as they are: keys, and what refers to them, must not lose digits or become equal.
    """
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            pass
        elif f.name in epoch_ms:
            c = epoch_ms_text(c)
        elif isinstance(f.dataType, T.BinaryType):
            c = strip(text_of_bytes(c))
        elif isinstance(f.dataType, TEMPORAL):
            c = F.date_format(c, MILLIS)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.StringType):
            c = F.upper(clean_text(c)) if f.name in uuids else clean_text(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def clip_strings(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """P3. Texts cut to the widths that the target declares."""
    return df.withColumns({name: F.substring(name, 1, n) for name, n in limits.items() if name in df.columns})
