"""Bytes, JSON and delimited text to and from columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T


def decode_utf8(value: Column, strict: bool = False) -> Column:
    """Bytes as text.  Invalid sequences fail when strict, else become U+FFFD."""
    if strict:
        return F.decode(value, "utf-8")
    return F.make_valid_utf8(value.cast("string"))


def encode_utf8(text: Column) -> Column:
    return F.encode(text, "utf-8")


def base64_text(encoded: Column) -> Column:
    """Text carried as base64, as in a notification payload."""
    return F.decode(F.unbase64(encoded), "utf-8")


def text_base64(text: Column) -> Column:
    return F.base64(encode_utf8(text))


def row_json(*columns: str | Column) -> Column:
    """One JSON object per row."""
    return F.to_json(F.struct(*columns))


def parse_json(text: Column, schema: T.StructType, corrupt: str | None = None) -> Column:
    """JSON text as a struct.

    A record that does not parse gives a struct of nulls; with ``corrupt`` the
    struct gains a field of that name which holds the offending text.
    """
    if corrupt is None:
        return F.from_json(text, schema)
    widened = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    return F.from_json(text, widened, options)


def delimited_item(text: Column, position: int, delimiter: str = ",") -> Column:
    """Item of a plainly delimited string; negative positions count from the end.

    The delimiter is taken literally and quotes mean nothing; for quoted items
    use ``parse_delimited``.  Out of range is null, also under ANSI mode.
    """
    parts = F.split(text, "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E")
    if position < 0:
        return F.try_element_at(parts, F.lit(position))
    return F.get(parts, F.lit(position))


#: Stands for null in a delimited line; a control character that no text item consists of.
NULL_ITEM = "\x01"


def _delimited_options(delimiter: str) -> dict[str, str]:
    return {
        "sep": delimiter,
        "escape": '"',
        "nullValue": NULL_ITEM,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def row_delimited(columns: Sequence[str | Column], delimiter: str = ",") -> Column:
    """One delimited line per row: items quoted where needed, null marked apart from empty text."""
    return F.to_csv(F.struct(*columns), _delimited_options(delimiter))


def parse_delimited(text: Column, schema: T.StructType, delimiter: str = ",") -> Column:
    """A delimited line as a struct; missing and unfit items are null."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(text, fields, _delimited_options(delimiter))
