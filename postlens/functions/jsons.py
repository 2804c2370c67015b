"""JSON helpers built on Spark's own parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def unwrap(value: Column) -> Column:
    """Undo one level of JSON string encoding; anything but a JSON string passes through unchanged."""
    text = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>")[0]
    return F.when(F.startswith(F.ltrim(value), F.lit('"')), F.coalesce(text, value)).otherwise(value)


def parse(value: Column, schema: T.StructType) -> Column:
    """``value`` as ``schema`` plus the raw text of records the parser had trouble with."""
    widened = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value, widened, {"columnNameOfCorruptRecord": CORRUPT})


def is_object(value: Column) -> Column:
    """Whether ``value`` is one well-formed JSON object. Costly: ask it only for doubtful rows."""
    return F.coalesce(
        F.startswith(F.ltrim(value), F.lit("{")) & F.try_parse_json(value).isNotNull(), F.lit(False)
    )


def is_usable(value: Column, parsed: Column) -> Column:
    """A record is usable unless it is no JSON object; one odd field alone does not spoil it."""
    clean = parsed.isNotNull() & parsed[CORRUPT].isNull()
    return F.when(clean, F.startswith(F.ltrim(value), F.lit("{"))).otherwise(is_object(value))


def list_text(raw: Column, separator: str) -> Column:
    """A JSON list of strings joined to one text; null when any element is not a string.

    ``raw`` is the JSON text of the list, as Spark keeps it for a field declared ``STRING``.
    """
    items = F.from_json(raw, "array<string>")
    only_strings = (F.to_json(items) == raw) & ~F.exists(items, lambda item: item.isNull())
    return F.when(only_strings, F.array_join(items, separator))


# The end of an object, before the start of another: an opening brace with a key (a whole string and a colon) or with
# nothing in it. Quantifiers don't give back, so long strings need no deep recursion.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
BOUNDARY = rf"\}}(?=\s*+\{{\s*+(?:{STRING}\s*+:|\}}))"


def split_concatenated(value: Column) -> Column:
    """JSON objects written one after the other, with or without white space between, as an array of objects.

    A text that ends in ``}{`` is no boundary: the quote that closes it opens no key there.
    """
    pieces = F.split(F.regexp_replace(value, BOUNDARY, "}\x1e"), "\x1e")
    return F.filter(F.transform(pieces, lambda p: F.btrim(p, F.lit(" \t\r\n"))), lambda p: p != "")


# Everything up to the next end of an object that another follows, with texts taken as a whole.
OUTSIDE = rf'\G((?:[^"}}]++|{STRING}|\}}(?!\s*+\{{))*+)\}}(?=\s*+\{{)'


def split_well_formed(value: Column) -> Column:
    """The same for objects whose texts all close, whatever is in their texts: nothing in a text is a boundary."""
    pieces = F.split(F.regexp_replace(value, OUTSIDE, "$1}\x1e"), "\x1e")
    return F.filter(F.transform(pieces, lambda p: F.btrim(p, F.lit(" \t\r\n"))), lambda p: p != "")
