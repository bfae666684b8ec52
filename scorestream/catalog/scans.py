"""Readers, writers, unions and message round trips."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from scorestream.catalog.registry import query, table
from scorestream.functions.encode import base64_text, text_base64
from scorestream.functions.text import line_count, path_label
from scorestream.operators.project import cast_nullable, message_text
from scorestream.operators.sets import row_and_column_count, top_rows, union_all
from scorestream.schemas import MESSAGE_ENVELOPE
from scorestream.sources import batch
from scorestream.sources.sinks import delimited_messages, json_messages, publish, write_json
from scorestream.streaming.messages import (
    parse_delimited_messages,
    parse_json_messages,
    judged_json_messages,
)
from scorestream.workspace import scratch_path

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
    f"(SELECT count(*)::INTEGER FROM (DESCRIBE {t})) AS n_columns"
    for t in _TABLES
)


@query("table_scan_count", _COUNTS_SQL)
def table_scan_count(spark, sf_dir):
    counted = []
    for name in _TABLES:
        batch.table_scan(spark, f"{sf_dir}/{name}.parquet", view=name)
        counted.append(row_and_column_count(spark.table(name), name))
    return union_all(*counted)


_ORDER_LINE = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@query(
    "csv_scan_typed",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority <> '2-HIGH'
      AND NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')
    """,
)
def csv_scan_typed(spark, sf_dir):
    """Headerless CSV: short, long and non-numeric records are dropped by the reader."""
    orders = table(spark, sf_dir, "orders", *_ORDER_LINE.names)
    price = F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("unknown")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    head = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", price)
    full = F.concat_ws(",", head, "o_orderpriority")
    long = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    line = (
        F.when(F.col("o_orderstatus") == "P", head)
        .when(long, F.concat(full, F.lit(",extra")))
        .otherwise(full)
    )
    path = scratch_path(spark, "orders-csv")
    orders.select(line.alias("value")).write.text(path)
    return batch.csv_scan(spark, path, _ORDER_LINE, header=False)


@query(
    "csv_scan_strings",
    """
    SELECT p_partkey, p_name, CASE WHEN p_type <> 'ECONOMY' THEN p_size END AS p_size,
           p_retailprice
    FROM part
    """,
)
def csv_scan_strings(spark, sf_dir):
    """CSV with a header and no schema, cast afterwards; unfit values become null."""
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    size = F.when(F.col("p_type") == "ECONOMY", F.lit("n/a")).otherwise(
        F.col("p_size").cast("string")
    )
    path = scratch_path(spark, "part-csv")
    part.withColumn("p_size", size).drop("p_type").write.csv(path, header=True)
    strings = batch.csv_scan(spark, path)
    return cast_nullable(
        strings, {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"}
    )


@query(
    "json_scan_inferred",
    "SELECT p_partkey, p_name, p_size::BIGINT AS p_size, p_retailprice FROM part",
)
def json_scan_inferred(spark, sf_dir):
    path = scratch_path(spark, "part-json")
    write_json(table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size", "p_retailprice"), path)
    return batch.json_scan(spark, path)


_CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


@query("json_scan_schema", "SELECT * FROM customer")
def json_scan_schema(spark, sf_dir):
    path = scratch_path(spark, "customer-json")
    write_json(table(spark, sf_dir, "customer"), path)
    return batch.json_scan(spark, path, _CUSTOMER)


_PARTIES_SQL = """
    SELECT c_name AS name, c_acctbal AS acctbal FROM customer
    UNION ALL SELECT s_name, s_acctbal FROM supplier
"""


def _parties(spark, sf_dir):
    customers = table(spark, sf_dir, "customer", "c_name", "c_acctbal").toDF("name", "acctbal")
    suppliers = table(spark, sf_dir, "supplier", "s_name", "s_acctbal")
    return customers, suppliers


@query("union_parts", _PARTIES_SQL)
def union_parts(spark, sf_dir):
    return union_all(*_parties(spark, sf_dir))


@query("multi_part_scan", _PARTIES_SQL)
def multi_part_scan(spark, sf_dir):
    """Several part folders read by one scan node."""
    paths = []
    for part in _parties(spark, sf_dir):
        paths.append(scratch_path(spark, "part"))
        write_json(part.toDF("name", "acctbal"), paths[-1])
    return batch.json_scan(spark, paths, "name string, acctbal double")


@query(
    "binary_scan",
    """
    SELECT (sum(strlen(html)) + count(*))::BIGINT AS n_bytes,
           (sum(length(html) - length(replace(html, chr(10), ''))) + count(*))::BIGINT AS n_newlines
    FROM pages
    """,
)
def binary_scan(spark, sf_dir):
    """Text files written by Spark, read back as bytes, one row per file."""
    path = scratch_path(spark, "pages-text")
    table(spark, sf_dir, "pages", "html").write.option("maxRecordsPerFile", 1000).text(path)
    files = batch.binary_scan(spark, path, glob="*.txt")
    newlines = line_count(F.col("content").cast("string")) - 1
    return files.agg(
        F.sum("length").alias("n_bytes"), F.sum(newlines.cast("bigint")).alias("n_newlines")
    )


@query(
    "limit_ordered",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
    """,
)
def limit_ordered(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return top_rows(orders, 100, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "path_label",
    r"""
    SELECT page_id, regexp_extract(url, 'example\.(?:com|net|org)/([^/]+)', 1) AS label FROM pages
    """,
)
def page_label(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    label = path_label(F.col("url"), r"example\.(?:com|net|org)")
    return pages.select("page_id", label.alias("label"))


@query(
    "base64_decode",
    "SELECT page_id, base64(encode(url)) AS data, url AS message FROM pages",
)
def base64_decode(spark, sf_dir):
    """Page addresses as notification payloads and back."""
    events = table(spark, sf_dir, "pages", "page_id", "url").select(
        "page_id", text_base64(F.col("url")).alias("data")
    )
    return events.withColumn("message", base64_text(F.col("data")))


@query(
    "file_line_count",
    """
    SELECT page_id, (length(html) - length(replace(html, chr(10), '')) + 1)::INTEGER AS n_lines
    FROM pages
    """,
)
def file_line_count(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", line_count(F.col("html")).alias("n_lines"))


_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query(
    "message_cast",
    """
    SELECT event_id::VARCHAR AS key, event_type || ',' || user_id::VARCHAR AS value FROM events
    """,
)
def message_cast(spark, sf_dir):
    """Binary key and value of a message as strings."""
    events = table(spark, sf_dir, "events", "event_id", "event_type", "user_id")
    value = F.concat_ws(",", "event_type", "user_id")
    envelope = events.select(
        F.encode(F.col("event_id").cast("string"), "utf-8").alias("key"),
        F.encode(value, "utf-8").alias("value"),
    )
    return message_text(envelope)


@query(
    "json_parse",
    "SELECT event_id, user_id, event_type, value, CAST(props->>'k' AS INTEGER) AS k FROM events",
)
def json_parse(spark, sf_dir):
    """JSON messages to columns, with a JSON string inside parsed too."""
    events = table(spark, sf_dir, "events", *_EVENT.names, "props")
    schema = T.StructType([*_EVENT.fields, T.StructField("props", T.StringType())])
    rows = parse_json_messages(json_messages(events, "event_id"), schema)
    return rows.withColumn("k", F.from_json("props", "k int")["k"]).drop("props")


@query("json_publish", "SELECT * FROM customer")
def json_publish(spark, sf_dir):
    """Rows published as messages by the executors, then consumed."""
    path = scratch_path(spark, "customer-topic")
    publish(json_messages(table(spark, sf_dir, "customer"), "c_custkey"), path)
    topic = batch.table_scan(spark, path, options={}).select(*MESSAGE_ENVELOPE.names)
    return parse_json_messages(topic, _CUSTOMER)


@query(
    "json_dead_letter",
    """
    SELECT event_type <> 'error' AND event_id % 10 > 2 AS parsed, count(*) AS n_messages
    FROM events GROUP BY 1
    """,
)
def json_dead_letter(spark, sf_dir):
    """Truncated, null, empty and blank messages are set apart; every message counts once."""
    events = table(spark, sf_dir, "events", *_EVENT.names)
    messages = events.select(
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 10 == 1, F.lit(""))
        .when(F.col("event_id") % 10 == 2, F.lit("  "))
        .when(F.col("event_type") == "error", F.lit('{"event_id": '))
        .otherwise(F.to_json(F.struct(*_EVENT.names)))
        .cast("binary")
        .alias("value")
    )
    judged = judged_json_messages(messages, _EVENT)
    return judged.groupBy("parsed").agg(F.count("*").alias("n_messages"))


@query(
    "delimited_text_messages",
    """
    SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN ''
                        ELSE '"' || text || '", ' || chr(10) || lang END AS body, n_chars
    FROM documents
    """,
)
def delimited_text_messages(spark, sf_dir):
    """Texts with delimiters, quotes and line breaks, nulls and empty ones, as delimited messages."""
    text = F.concat(F.lit('"'), "text", F.lit('", \n'), "lang")
    body = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 7 == 1, "").otherwise(text)
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    rows = docs.select("doc_id", body.alias("body"), "n_chars")
    return parse_delimited_messages(delimited_messages(rows, "doc_id", "|"), rows.schema, delimiter="|")


@query(
    "csv_message_parse",
    """
    SELECT event_id, user_id, event_type,
           CASE WHEN event_type <> 'click' THEN value END AS value
    FROM events
    """,
)
def csv_message_parse(spark, sf_dir):
    """Delimited messages; a record cut short gives nulls, not a failure."""
    events = table(spark, sf_dir, "events", *_EVENT.names)
    whole = delimited_messages(events.where(F.col("event_type") != "click"))
    short = delimited_messages(events.where(F.col("event_type") == "click").drop("value"))
    return parse_delimited_messages(union_all(whole, short), _EVENT)
