"""As-of join: the last row of one table at or before each row of another, by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _number(df: DataFrame, time: str) -> Column:
    kind = df.schema[time].dataType.typeName()
    return F.unix_micros(time).cast("double") if kind == "timestamp" else F.col(time).cast("double")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    take: Sequence[str],
    slices: int = 32,
) -> DataFrame:
    """Every row of ``left`` with columns ``take`` of the last row of its key in ``right`` at or before its time.

    Both tables are laid in one order and the last right row is carried along it:
    a sort, no pairs.  A key is cut into ``slices`` ranges of time, at quantiles of
    all rows, so that the rows of a hot key go to that many tasks; what a range
    ends with is carried into the next, one row per key and range.  Of right rows
    with equal key and time the greatest by ``take`` counts.  Without an earlier
    row, with a null key or a null time, the taken columns are null; all rows and
    columns of ``left`` are kept.  Names of ``take`` must not be columns of ``left``.
    """
    clash = set(take) & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in both tables")
    taken = F.struct(F.col(right_time).alias("_at"), *take)
    events = right.dropna(subset=[key, right_time]).select(
        F.col(key).alias("_key"), F.col(right_time).alias("_time"), F.lit(0).alias("_side"),
        taken.alias("_taken"), F.lit(None).cast(left.schema).alias("_row"),
    )
    asked = left.select(
        F.col(key).alias("_key"), F.col(left_time).alias("_time"), F.lit(1).alias("_side"),
        F.lit(None).cast(events.schema["_taken"].dataType).alias("_taken"), F.struct(*left.columns).alias("_row"),
    )
    times = events.select(_number(events, "_time").alias("t")).unionAll(asked.select(_number(asked, "_time").alias("t")))
    shares = [(i + 1) / slices for i in range(slices - 1)]
    cuts = sorted(set(times.agg(F.percentile_approx("t", shares, 1000)).first()[0] or [])) if shares else []
    both = events.unionAll(asked)
    place = F.lit(0)
    for cut in cuts:
        place = place + F.coalesce((_number(both, "_time") > cut).cast("int"), F.lit(0))
    both = both.withColumn("_slice", place)

    ends = both.groupBy("_key", "_slice").agg(F.max("_taken").alias("_end"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_key", "_slice", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    so_far = Window.partitionBy("_key", "_slice").orderBy("_time", "_side", "_taken").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("_taken", ignorenulls=True).over(so_far)
    walked = both.withColumn("_found", found).where(F.col("_side") == 1)
    same = walked["_key"].eqNullSafe(carried["_key"]) & (walked["_slice"] == carried["_slice"])
    joined = walked.join(carried.select("_key", "_slice", "_carried"), same, "left")
    known = F.col("_row")[left_time].isNotNull() & F.col("_row")[key].isNotNull()
    answer = F.when(known, F.coalesce("_found", "_carried"))
    return joined.withColumn("_answer", answer).select("_row.*", *(F.col("_answer")[c].alias(c) for c in take))
