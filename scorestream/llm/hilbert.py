"""Shards along a Hilbert curve through several metadata dimensions.

Every dimension is cut into at most 2**bits - 1 classes at quantiles of its
values, class 0 being null.  The classes, spread over the whole axis however few
they are, are the coordinates of a cell, and rows are ordered by the cell's place
on the curve.  Equal runs of that order are the
shards, so that each spans a small box in all dimensions at once and minimum
and maximum of a file prune well in each of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

from scorestream.workspace import materialize

MOST_CELL_BITS = 16
#: Hash classes of a cell, and rows of the table for one class more.
FAN_OUT = 256
ROWS_PER_CLASS = 1_000_000
ACCURACY = 10_000
ROW_BYTES = 16


def curve_places(dimensions: int, bits: int) -> np.ndarray:
    """Place on the curve of every cell, by the cell's coordinates read as one number.

    Coordinates are turned into the curve's Gray code from the highest bit down
    (Skilling, "Programming the Hilbert curve", 2004), for all cells at once.
    """
    cells = np.arange(1 << (dimensions * bits))
    axes = [cells >> (bits * (dimensions - 1 - d)) & ((1 << bits) - 1) for d in range(dimensions)]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(dimensions):
            is_set = (axes[d] & bit) > 0
            exchanged = np.where(is_set, 0, (axes[0] ^ axes[d]) & low)
            axes[0] = axes[0] ^ np.where(is_set, low, exchanged)
            if d:
                axes[d] = axes[d] ^ exchanged
    for d in range(1, dimensions):
        axes[d] = axes[d] ^ axes[d - 1]
    turned = np.zeros_like(cells)
    for level in range(bits - 1, 0, -1):
        turned = turned ^ np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    places = np.zeros_like(cells)
    for level in range(bits - 1, -1, -1):
        for d in range(dimensions):
            places = places << 1 | ((axes[d] ^ turned) >> level & 1)
    return places


def _is_text(docs: DataFrame, name: str) -> bool:
    return isinstance(docs.schema[name].dataType, (StringType, BinaryType))


def _ordinal(docs: DataFrame, name: str) -> Column:
    """What orders as the column does: texts as they are, else a number."""
    if _is_text(docs, name) or isinstance(docs.schema[name].dataType, NumericType):
        return F.col(name) if _is_text(docs, name) else F.col(name).cast("double")
    return F.col(name).cast("long").cast("double")


def _text_cuts(docs: DataFrame, name: str, wanted: int) -> list:
    """At most ``wanted`` values where the running share of the rows passes the next of as many steps.

    Distinct values are counted, dealt out by range and summed up range by range,
    so whole strings are compared and no task holds more than one range.
    """
    counts = docs.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange("value").withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "shard-values")
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(F.min("value").alias("first"), F.sum("n").alias("rows"))
    sums = sums.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    total = ranged.agg(F.sum("n")).scalar()
    so_far = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = (F.col("start") + F.sum("n").over(so_far)).alias("upto")
    step = lambda c: F.floor(c * F.lit(wanted + 1) / total)
    passed = ranged.join(sums, "range").select("value", "n", upto).where(step(F.col("upto")) > step(F.col("upto") - F.col("n")))
    return sorted(r["value"] for r in passed.where(F.col("upto") < total).select("value").collect())


def quantile_cuts(docs: DataFrame, dimensions: list[str], bits: int) -> list[list]:
    """Per dimension at most 2**bits - 2 increasing cuts: of numbers from mergeable sketches, of texts from counts."""
    wanted = (1 << bits) - 2
    shares = [(i + 1) / (wanted + 1) for i in range(wanted)]
    numbers = [d for d in dimensions if not _is_text(docs, d)]
    found: dict[str, list] = {}
    if numbers:
        row = docs.agg(
            *[F.percentile_approx(_ordinal(docs, d), shares, ACCURACY).alias(f"cuts{i}") for i, d in enumerate(numbers)]
        ).first()
        found = {d: sorted({cut for cut in cuts or [] if cut == cut}) for d, cuts in zip(numbers, row)}
    return [found[d] if d in found else _text_cuts(docs, d, wanted) for d in dimensions]


def _class(value: Column, cuts: list) -> Column:
    above = F.lit(1)
    for cut in cuts:
        above = above + (value > F.lit(cut)).cast("int")
    return F.coalesce(above, F.lit(0))


def _coordinate(value: Column, cuts: list, bits: int) -> Column:
    """The class, spread over the axis: few classes lie far apart."""
    return F.floor(_class(value, cuts) * F.lit((1 << bits) - 1) / F.lit(len(cuts) + 1)).cast("long")


def _places_table(spark: SparkSession, dimensions: int, bits: int) -> DataFrame:
    places = curve_places(dimensions, bits)
    return spark.createDataFrame(pd.DataFrame({"cell": np.arange(len(places)), "place": places}))


def curve_shards(
    docs: DataFrame,
    dimensions: tuple[str, ...] = ("lang", "source", "n_chars"),
    shards: int = 40,
    bits: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, place), one row per row.

    The law is ``rows``: counts of any two shards differ by one at most.  Order:
    place on the curve, then a hash of the id, then id, checksum and size; rows
    equal in all of these are interchangeable.  A null text has size 16 and
    checksum 0, a null coordinate is the lowest class.  Texts are measured where
    they are read and never shuffled.  The place of a row is the sum of three
    counts: rows of earlier cells, rows of earlier hash classes of its cell, and
    rows before it in its own class; a cell that holds a third of all rows is
    thereby dealt to ``FAN_OUT`` groups, and to more as the table grows.
    """
    if len(dimensions) * bits > MOST_CELL_BITS:
        raise ValueError(f"cells of more than {MOST_CELL_BITS} bits would not fit a broadcast table")
    cuts = quantile_cuts(docs, list(dimensions), bits)
    cell = F.lit(0).cast("long")
    for name, found in zip(dimensions, cuts):
        cell = cell * (1 << bits) + _coordinate(_ordinal(docs, name), found, bits)
    fan_out = max(FAN_OUT, docs.count() // ROWS_PER_CLASS)
    text = F.coalesce(F.col(text_column), F.lit(""))
    measured = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        cell.alias("cell"),
        F.pmod(F.xxhash64(F.col(id_column)), F.lit(fan_out)).cast("int").alias("part"),
    )
    places = F.broadcast(_places_table(docs.sparkSession, len(dimensions), bits))
    placed = measured.join(places, "cell").drop("cell")

    counts = placed.groupBy("place", "part").agg(F.count("*").alias("n"))
    per_cell = counts.groupBy("place").agg(F.sum("n").alias("cell_rows"))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_cell = per_cell.select(
        "place",
        F.coalesce(F.sum("cell_rows").over(before), F.lit(0)).alias("cell_start"),
        F.sum("cell_rows").over(everything).alias("total"),
    )
    inside = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("part_start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(per_cell, "place")
    starts = starts.select("place", "part", (F.col("cell_start") + F.col("part_start")).alias("start"), "total")

    own = Window.partitionBy("place", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = placed.join(starts, ["place", "part"]).withColumn("rank", F.col("start") + F.row_number().over(own) - 1)
    shard = F.expr(f"rank * {shards} div total").cast("int")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "place",
    )
