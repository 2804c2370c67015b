"""Feeds that nobody declared: their schema, what each field holds, and typed rows.

The schema is an aggregate over the parsed records: types of a field are merged as they are met, within each task
first, so the feed is read once and only types are shuffled. Kinds of numbers widen to one that holds them all; a
field whose records disagree otherwise becomes text. Arrays and what is in them are one field.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions import jsons

ROOT = "$"
_NAME_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def _variants(df: DataFrame, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, _v)``: every record as a variant, null unless it is one JSON object. Both levels of encoding are
    undone. Each record is parsed once: the explode keeps what is asked of it from being pushed below it."""
    parsed = df.select(*keep, F.explode(F.array(F.try_parse_json(jsons.unwrap(F.col(value))))).alias("_p"))
    is_object = F.startswith(F.schema_of_variant("_p"), F.lit("OBJECT<"))
    return parsed.select(*keep, F.when(is_object, F.col("_p")).alias("_v"))


def _settled(kind: T.DataType) -> T.DataType:
    """What disagrees, or was null in every record, is text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(kind.elementType))
    return T.StringType() if isinstance(kind, T.VariantType | T.NullType) else kind


def _merged(records: DataFrame) -> T.StructType:
    found = records.agg(F.schema_of_variant_agg(F.col("_v"))).first()[0]
    if not (found or "").startswith("OBJECT<"):
        return T.StructType()
    named = _NAME_OR_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return _settled(T.DataType.fromDDL(named))


def inferred_schema(df: DataFrame, value: str = "value") -> T.StructType:
    """The schema that every record of ``df`` fits; without fields if no record is an object.

    An object without keys and an empty feed add nothing. Fields are in order of their names.
    """
    return _merged(_variants(df, value).where(F.col("_v").isNotNull()))


def read_inferred(df: DataFrame, value: str = "value", keep: Sequence[str] = (), schema: T.StructType | None = None) -> DataFrame:
    """``keep`` and the record as the struct ``post`` of the inferred (or a given, earlier inferred) type.

    A record that is no object, or one that a given schema doesn't fit, has a null ``post``. What became text keeps its
    JSON, strings without their quotes.
    """
    kind = inferred_schema(df, value) if schema is None else schema
    records = _variants(df, value, keep)
    if not kind.fields:
        return records.select(*keep, F.when(F.col("_v").isNotNull(), F.struct()).alias("post"))
    return records.select(*keep, F.try_variant_get("_v", ROOT, kind.simpleString() if _plain(kind) else _ddl(kind)).alias("post"))


def _plain(kind: T.StructType) -> bool:
    return all(re.fullmatch(r"\w+", f.name) and (not isinstance(f.dataType, T.StructType) or _plain(f.dataType)) for f in kind)


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        names = (f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind)
        return f"STRUCT<{', '.join(names)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def _leaves(kind: T.StructType) -> T.StructType:
    """The same fields with every value as it is written."""
    held = lambda f: _leaves(f.dataType) if isinstance(f.dataType, T.StructType) else T.VariantType()
    return T.StructType([T.StructField(f.name, held(f)) for f in kind])


def _fields(kind: T.StructType, record: Column, path: tuple[str, ...] = ()) -> Iterator[tuple[str, str, Column]]:
    for f in kind:
        value, here = record.getField(f.name), (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            yield ".".join(here), "struct", value.isNotNull()
            yield from _fields(f.dataType, value, here)
        else:
            yield ".".join(here), f.dataType.simpleString(), value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def profile(df: DataFrame, value: str = "value") -> DataFrame:
    """Per path of the feed: path, merged type, present (records with a value other than null there) and null_share, the part
    of records without.

    The path ``$`` stands for the record: how many of all rows are objects. The shares of the others are of these. A
    feed without rows has no share.
    """
    kind = inferred_schema(df, value)
    records = _variants(df, value)
    record = F.try_variant_get("_v", ROOT, _ddl(_leaves(kind))) if kind.fields else F.lit(None)
    rows = records.select("_v", F.explode(F.array(record)).alias("_r")) if kind.fields else records.withColumn("_r", record)
    fields = [(ROOT, "struct", F.col("_v").isNotNull()), *_fields(kind, F.col("_r"))]
    counted = rows.agg(F.count("*").alias("rows"), *(F.count_if(there).alias(f"n{i}") for i, (_, _, there) in enumerate(fields)))
    each = F.array(*(F.struct(F.lit(p).alias("path"), F.lit(t).alias("type"), F.col(f"n{i}").alias("present")) for i, (p, t, _) in enumerate(fields)))
    listed = counted.select("rows", "n0", F.explode(each).alias("f"))
    whole = F.when(F.col("f.path") == ROOT, F.col("rows")).otherwise(F.col("n0"))
    return listed.select("f.path", "f.type", "f.present", (1 - F.col("f.present") / F.nullif(whole, F.lit(0))).alias("null_share"))
