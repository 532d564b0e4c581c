"""List columns that the collector stored as Python literals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels
from .urls import is_video_prefix

_JSON_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowUnquotedControlChars": "true",
}


# The grammar of what Python's ``str`` writes for a list of strings, numbers, None,
# True, False, lists and dicts with string keys. All loops are possessive: no stack,
# however long the list.
def _separated(item: str) -> str:
    return f"(?:{item}[ \\t]*+(?:,[ \\t]*+{item}[ \\t]*+)*+)?+"


# The escapes that ``str`` writes.
_ESCAPE = r"""\\(?:[\\'nrt]|x[0-9a-f]{2}|u[0-9a-f]{4}|U00(?:0[0-9a-f]|10)[0-9a-f]{4})"""
_STRING = rf"""(?:'(?:[^'\\\n\r]++|{_ESCAPE})*+'|"(?:[^"\\\n\r]++|{_ESCAPE})*+")"""
_NUMBER = r"(?:-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++(?:e[+-][0-9]++)?|e[+-][0-9]++)|0|-?[1-9][0-9]*+)"
_SCALAR = rf"(?:{_STRING}|{_NUMBER}|None|True|False)"
_NESTED = 2


def _value(depth: int) -> str:
    if depth == 0:
        return _SCALAR
    inner = _value(depth - 1)
    pair = rf"{_STRING}[ \t]*+:[ \t]*+{inner}"
    return rf"(?:{_SCALAR}|\[[ \t]*+{_separated(inner)}\]|\{{[ \t]*+{_separated(pair)}\}})"


PLAIN_LIST = rf"^ *+\[[ \t]*+{_separated(_value(_NESTED))}\] *+\z"
_TOKEN = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|None|True|False|[^'"NTF]++"""
_JSON_WORDS = {"None": "null", "True": "true", "False": "false"}
_PIECE = r"\\x[0-9a-f]{2}|\\U[0-9a-f]{8}|\\.|[^\\]++"


def _code_unit(value: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(value)), 4, "0"))


def _unescaped(raw: Column) -> Column:
    """Python's escapes that JSON lacks, as JSON's."""

    def piece(text: Column) -> Column:
        point = F.conv(F.substring(text, 3, 8), 16, 10).cast("bigint")
        above = point - 0x10000
        high, low = F.lit(0xD800) + F.floor(above / 1024), F.lit(0xDC00) + above % 1024
        wide = F.when(point < 0x10000, _code_unit(point)).otherwise(F.concat(_code_unit(high), _code_unit(low)))
        byte = F.concat(F.lit("\\u00"), F.substring(text, 3, 2))
        return F.when(text.startswith("\\x"), byte).when(text.startswith("\\U"), wide).otherwise(text)

    pieces = F.regexp_extract_all(raw, F.lit(_PIECE), F.lit(0))
    return F.when(raw.contains("\\"), F.array_join(F.transform(pieces, piece), "")).otherwise(raw)


def _as_json(raw: Column) -> Column:
    """A plain list with Python's three words as JSON's, outside of strings only."""

    def word(token):
        out = token
        for python, json in _JSON_WORDS.items():
            out = F.when(token == python, json).otherwise(out)
        return out

    tokens = F.regexp_extract_all(raw, F.lit(_TOKEN), F.lit(0))
    words = F.array_join(F.transform(tokens, word), "")
    return _unescaped(F.when(raw.rlike("None|True|False"), words).otherwise(raw))


def _native(raw: Column, schema: T.ArrayType) -> Column:
    """Parse in the JVM; null where the text is no plain list."""
    return F.from_json(F.when(raw.rlike(PLAIN_LIST), _as_json(raw)), schema, _JSON_OPTIONS)


def parse_literals(
    df: DataFrame, schemas: Mapping[str, T.ArrayType], on_bad: str = "null", others: str = "python"
) -> DataFrame:
    """Replace each literal column by its parsed array, in one pass.

    What Python's ``str`` writes parses in the JVM. ``others`` says what becomes of
    literals in another form (joined strings, bytes, hexadecimal numbers, tuples, deep
    nesting): ``python`` reads them in Arrow batches, in which every parsed row is a
    null; ``bad`` takes them for bad text and keeps Python out of the plan. Columns
    nobody reads afterwards are pruned with their parsing. Run this once at ingest and
    store the arrays.

    ``on_bad``: ``null``, ``empty`` or ``fail`` for text that is no list literal.
    """
    if on_bad not in ("null", "empty", "fail") or others not in ("python", "bad"):
        raise ValueError(f"unknown on_bad {on_bad!r} or others {others!r}")
    parsed = df.withColumns({f"_{n}": _native(F.col(n), schema) for n, schema in schemas.items()})
    if others == "python":
        to_json = F.pandas_udf(kernels.literals_to_json, "string")
        parsed = parsed.withColumns(
            {f"_json_{n}": to_json(F.when(F.col(f"_{n}").isNull(), F.col(n))) for n in schemas}
        )
    values = {}
    for name, schema in schemas.items():
        value = F.col(f"_{name}")
        if others == "python":
            value = F.coalesce(value, F.from_json(f"_json_{name}", schema))
        bad = F.col(name).isNotNull() & value.isNull()
        if on_bad == "fail":
            message = F.concat(F.lit(f"{name} is no list literal: "), F.col(name))
            value = F.when(bad, F.raise_error(message).cast(schema)).otherwise(value)
        elif on_bad == "empty":
            value = F.when(bad, F.array().cast(schema)).otherwise(value)
        values[name] = value
    return parsed.withColumns(values).select(*df.columns)


def has_items(col: Column) -> Column:
    return col.isNotNull() & (F.size(col) > 0)


def expanded_urls(urls: Column) -> Column:
    """Array of link structs to the array of its non-null expanded URLs."""
    names = F.transform(urls, lambda link: link["expanded_url"])
    return F.filter(names, lambda name: name.isNotNull())


def video_urls(urls: Column) -> Column:
    """Keep the links to a video site; a missing URL counts as the empty string."""
    return F.filter(
        urls, lambda link: is_video_prefix(F.coalesce(link["expanded_url"], F.lit("")))
    )


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def zip_mentions(ids: Column, names: Column) -> Column:
    """Pair ids with names in order, cut to the shorter list, last name per id.

    Gives ``array<struct<id: string, name: string>>``. Pairs are sorted by id, the last
    of each stays, and what stays goes back to its place.
    """
    n = F.greatest(F.coalesce(F.least(F.size(ids), F.size(names)), F.lit(0)), F.lit(0))
    zipped = F.arrays_zip(F.slice(ids, F.lit(1), n).alias("id"), F.slice(names, F.lit(1), n).alias("name"))
    placed = F.transform(
        zipped,
        lambda pair, i: F.struct(
            pair["id"].cast("string").alias("id"), (-i).alias("back"), pair["name"].cast("string").alias("name")
        ),
    )

    def last_of_each(rows: Column) -> Column:
        return F.filter(rows, lambda r, i: (i == 0) | ~F.get(rows, i - 1)["id"].eqNullSafe(r["id"]))

    kept = _bound(F.sort_array(placed), last_of_each)
    ordered = F.sort_array(F.transform(kept, lambda r: F.struct((-r["back"]).alias("at"), r["id"], r["name"])))
    return F.transform(ordered, lambda r: F.struct(r["id"].alias("id"), r["name"].alias("name")))
