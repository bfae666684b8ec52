"""Messages to typed columns.  Works on batches of messages as well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from scorestream.functions.encode import decode_utf8, parse_delimited, parse_json

_BAD = "_unparsed"


def parse_json_messages(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Fields of JSON messages; a message that does not parse gives nulls."""
    parsed = parse_json(decode_utf8(F.col(value)), schema)
    return messages.select(parsed.alias("input")).select("input.*")


def judged_json_messages(
    messages: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Kept columns, ``input`` struct, ``message`` text and whether it ``parsed``: one row per message.

    A null, empty, blank or broken message has not parsed.
    """
    text = messages.select(*keep, decode_utf8(F.col(value)).alias("message"))
    read = text.withColumn("input", parse_json(F.col("message"), schema, _BAD))
    parsed = F.col("input").isNotNull() & F.col(f"input.{_BAD}").isNull() & (F.trim("message") != "")
    read = read.withColumn("parsed", F.coalesce(parsed, F.lit(False)))
    return read.withColumn("input", F.col("input").dropFields(_BAD))


def split_json_messages(
    messages: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and apart from them key columns and raw text of every other message."""
    judged = judged_json_messages(messages, schema, value, keep)
    good = judged.where("parsed").select(*keep, "input.*")
    return good, judged.where("not parsed").select(*keep, "message")


def parse_delimited_messages(
    messages: DataFrame, schema: T.StructType, value: str = "value", delimiter: str = ","
) -> DataFrame:
    """Fields of delimited messages; missing or unfit items are null."""
    parsed = parse_delimited(decode_utf8(F.col(value)), schema, delimiter)
    return messages.select(parsed.alias("input")).select("input.*")
