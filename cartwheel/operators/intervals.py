"""Interval-overlap join without a cross join.

Two closed intervals overlap if each begins before the other ends, which no
hash or sort key expresses. So both sides get bin keys: an interval's level is
the first whose bin width is not below its length, and on its level or any
coarser one it touches two bins at most, however long it is. A pair meets on
the coarser of its two levels, in the first bin that both touch, so it is found
there and nowhere else; what is left to check is the overlap itself.

Hot bins (a promotion week, one customer with a third of all rows) are split by
heat: the larger side's rows of such a bin are dealt over several keys, the
smaller side's are repeated for each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROWTH = 16  # bin widths of neighbouring levels
_KEY = ["__level", "__bin"]


def _day(c: str, kind: str) -> Column:
    """Days or the integer itself: what bins are cut from."""
    if kind == "date":
        return F.unix_date(F.col(c)).cast("long")
    if kind in ("int", "bigint", "smallint", "tinyint"):
        return F.col(c).cast("long")
    raise TypeError(f"{c}: a date or an integer, not {kind}")


def _leveled(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """Usable rows with their bounds as integers and their level. The level is
    found by integer arithmetic: how often the length divides by the growth."""
    kinds = dict(df.dtypes)
    level = F.lit(0)
    reach = width
    for k in range(1, 17):
        level = F.when(F.col("__e") - F.col("__s") >= F.lit(reach), F.lit(k)).otherwise(level)
        reach = min(reach * GROWTH, 1 << 62)
    return df.withColumn("__s", _day(start, kinds[start])).withColumn("__e", _day(end, kinds[end])) \
             .filter("__s <= __e").withColumn("__own", level)


def _binned(df: DataFrame, levels: list[int], other: list[int], width: int) -> DataFrame:
    """A row per interval, level on which it may meet one of the other side, and bin."""
    # on its own level it meets finer ones and equals; on coarser ones, those of the other side that are there
    at = F.filter(F.array(*[F.lit(m) for m in sorted(set(levels) | set(other))]),
                  lambda m: (m == F.col("__own")) | ((m > F.col("__own")) & m.isin(other)))
    wide = F.element_at(F.array(*[F.lit(min(width * GROWTH ** m, 1 << 62)).cast("long") for m in range(17)]), F.col("__level") + 1)
    return df.withColumn("__level", F.explode(at)).withColumn("__w", wide) \
             .withColumn("__first", F.expr("(__s - pmod(__s, __w)) div __w")).withColumn("__last", F.expr("(__e - pmod(__e, __w)) div __w")) \
             .withColumn("__bin", F.explode(F.sequence("__first", "__last"))).drop("__w", "__last", "__s", "__e")


def overlap_join(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], by: Sequence[str] = (),
                 width: int = 16, hot_rows: int = 1_000_000) -> DataFrame:
    """Pairs of rows whose closed intervals ``(start, end)`` overlap and that
    agree in the columns ``by``: columns ``by``, then the others of ``left``,
    then those of ``right`` (their names must differ). Starts and ends are dates
    or integers. Intervals with a null bound or ending before they start, and
    rows with a null in ``by``, overlap nothing; repeated rows give repeated
    pairs. ``width`` is the finest bin (days or units), ``hot_rows`` the number
    of rows from which a bin's larger side is dealt over several keys."""
    by = list(by)
    if set(left.columns) & set(right.columns) - set(by):
        raise ValueError(f"columns on both sides: {sorted(set(left.columns) & set(right.columns) - set(by))}")
    for c in by:
        left, right = left.filter(F.col(c).isNotNull()), right.filter(F.col(c).isNotNull())
    a, b = _leveled(left, *left_range, width), _leveled(right, *right_range, width)
    # at most 17 levels on each side
    sets = [sorted(r[0] for r in side.select("__own").distinct().collect()) or [0] for side in (a, b)]
    a, b = _binned(a, sets[0], sets[1], width), _binned(b, sets[1], sets[0], width)
    key = by + _KEY

    heat = a.groupBy(*key).agg(F.count(F.lit(1)).alias("__na")).join(b.groupBy(*key).agg(F.count(F.lit(1)).alias("__nb")), key) \
            .filter(F.greatest("__na", "__nb") > hot_rows) \
            .select(*key, F.ceil(F.greatest("__na", "__nb") / F.lit(hot_rows)).cast("int").alias("__parts"), (F.col("__na") >= F.col("__nb")).alias("__deal_a"))

    def split(side: DataFrame, is_a: bool) -> DataFrame:
        side = side.join(heat, key, "left")
        dealt = F.array(F.pmod(F.xxhash64(*side.columns[:-2]), F.col("__parts")).cast("int"))
        parts = F.when(F.col("__parts").isNull(), F.array(F.lit(0))) \
                 .when(F.col("__deal_a") == F.lit(is_a), dealt).otherwise(F.sequence(F.lit(0), F.col("__parts") - 1))
        return side.withColumn("__part", F.explode(parts)).drop("__parts", "__deal_a")

    a = split(a, True).withColumnsRenamed({"__own": "__own_a", "__first": "__first_a"})
    b = split(b, False).withColumnsRenamed({"__own": "__own_b", "__first": "__first_b"})
    met = a.join(b, [*key, "__part"]).filter(
        (F.greatest("__own_a", "__own_b") == F.col("__level")) & (F.greatest("__first_a", "__first_b") == F.col("__bin"))
        & (F.col(left_range[0]) <= F.col(right_range[1])) & (F.col(right_range[0]) <= F.col(left_range[1])))
    return met.select(*by, *[c for c in left.columns if c not in by], *[c for c in right.columns if c not in by])
