"""Exact percentiles by group, without a group in one task.

Selection by refinement: every wanted rank has an interval of values that holds
it, and a pass counts the rows of each interval in equal slices. The slice in
which the rank falls is the next interval. Counts combine map side, so a pass
shuffles at most one row per group, rank, slice and task; a group with a third
of all rows is counted by all tasks. With 1,024 slices a pass takes 10 bits off
the range: two or three passes for money, seven at most for any 64-bit value.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.plans.sink import materialize, remove_path


def _as_long(df: DataFrame, value: str):
    """The value as an order-preserving integer, and the way back."""
    kind = df.schema[value].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(value).cast("long"), lambda c: c.cast(kind)
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(value)).cast("long"), lambda c: F.date_from_unix_date(c.cast("int"))
    if isinstance(kind, T.DecimalType):
        unit = Decimal(1).scaleb(-kind.scale)
        return (F.col(value).cast(T.DecimalType(18, kind.scale)) * F.lit(10 ** kind.scale)).cast("long"), \
            lambda c: (c.cast(T.DecimalType(18, 0)) * F.lit(unit)).cast(kind)
    raise TypeError(f"{value}: an integer, a date or a decimal, not {kind.simpleString()} (cast it)")


def percentiles(df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, float], slices: int = 1024) -> DataFrame:
    """``by`` columns, ``n`` (non-null values) and one column per entry of
    ``ranks`` (name: fraction): the smallest value with at least that share of
    the group's values at or below it (``quantile_disc``; 0 gives the least).

    Nulls of ``value`` do not count; groups without other values do not appear;
    null groups are a group. Integers, dates and decimals of up to 18 digits.
    The result is small (a row per group) and written once."""
    by = list(by)
    if not all(0 <= p <= 1 for p in ranks.values()):
        raise ValueError(f"fractions between 0 and 1: {ranks}")
    as_long, back = _as_long(df, value)
    # groups are told by a struct, which equals itself where a column is null
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    values, path = materialize(df.filter(F.col(value).isNotNull()).select(group.alias("g"), as_long.alias("v")), "percentiles-values")
    used = [path]
    try:
        sizes = values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in ranks.items()])
        # rank from 1; below: rows under the interval [lo, hi]
        state = sizes.withColumn("w", F.explode(wanted)).select(
            "g", "n", "w.name", F.greatest(F.lit(1), F.ceil(F.col("w.p") * F.col("n"))).cast("long").alias("rank"),
            F.col("least").alias("lo"), F.col("most").alias("hi"), F.lit(0).cast("long").alias("below"))
        state, path = materialize(state, "percentiles-state")
        used.append(path)
        # differences of far ends need more than 64 bits
        far = "lo < -4000000000000000000 or hi > 4000000000000000000"
        width = F.expr(f"case when {far} then (cast(hi as decimal(20,0)) - lo) div {slices} else (hi - lo) div {slices} end + 1")
        while state.filter("lo < hi").limit(1).count():
            open_ = state.filter("lo < hi").withColumn("width", width)
            met = values.join(open_, "g").filter("v >= lo and v <= hi")
            slice_ = F.expr(f"case when {far} then (cast(v as decimal(20,0)) - lo) div width else (v - lo) div width end")
            counts = met.withColumn("slice", slice_).groupBy("g", "name", "slice").agg(F.count(F.lit(1)).alias("rows"))
            # at most ``slices`` counts per group and rank: an array, summed up to the rank
            sums = counts.groupBy("g", "name").agg(F.array_sort(F.collect_list(F.struct("slice", "rows"))).alias("counts"))
            step = F.aggregate("counts", F.struct(F.col("below").alias("below"), F.lit(None).cast("long").alias("slice")),
                               lambda s, c: F.when(s["slice"].isNotNull(), s)
                               .when(s["below"] + c["rows"] >= F.col("rank"), F.struct(s["below"].alias("below"), c["slice"].alias("slice")))
                               .otherwise(F.struct((s["below"] + c["rows"]).alias("below"), F.lit(None).cast("long").alias("slice"))))
            start = F.expr("cast(cast(lo as decimal(20,0)) + cast(s.slice as decimal(5,0)) * width as bigint)")
            found = open_.join(sums, ["g", "name"]).withColumn("s", step).withColumn("start", start).select(
                "g", "n", "name", "rank", F.col("start").alias("lo"), F.least("hi", F.try_add("start", F.col("width") - 1)).alias("hi"),
                F.col("s.below").alias("below"))
            state, path = materialize(state.filter("lo = hi").unionByName(found), "percentiles-state")
            used.append(path)
        result = state.groupBy("g", "n").agg(*[F.max(F.when(F.col("name") == name, back(F.col("lo")))).alias(name) for name in ranks])
        result, _ = materialize(result.select(*[F.col("g")[c].alias(c) for c in by], "n", *ranks), "percentiles")
        return result
    finally:
        for path in used:
            remove_path(df.sparkSession, path)
