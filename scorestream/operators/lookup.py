"""Join a big table with a look-up table whose size has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

#: A look-up table above this many bytes is shuffled, not broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(table: DataFrame) -> int:
    """Size of a written table: its text plus eight bytes per other value."""
    text = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text]
    row = table.agg(F.count("*"), *lengths).first()
    return row[0] * 8 * len(table.columns) + sum(row[1:])


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    on: str,
    how: str,
    table_bytes: int,
    limit: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """``big`` joined with ``table`` on one column, ``how`` in inner or left.

    Below the limit the table is broadcast.  Above it both sides are shuffled
    on (key, salt): each table row is repeated once per salt, so that the rows
    of a key which holds a large share of ``big`` go to ``salts`` tasks, by default as many
    as there are shuffle partitions.  The
    salt is a hash of the whole row, so ``big`` should carry a row identifier.
    """
    if table_bytes <= limit:
        return big.join(F.broadcast(table), on, how)
    salts = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int")
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = big.withColumn("_salt", salt)
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")
