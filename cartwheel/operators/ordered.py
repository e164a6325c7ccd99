"""Operators along time within a key: gap sessions and as-of joins.

A window over a key puts all rows of the key in one task, and one user may hold
a third of them. Here rows are range-sorted on (key, time), so a hot key spans
many tasks, each of which streams over its rows in Arrow batches and holds one
row between them. What the first key of a range needs from the ranges before it
is settled from one row per range and patched in by a broadcast join of that
many rows. One shuffle, however the keys are spread.
"""

from __future__ import annotations

import sys
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.plans.sink import materialize

# the functions that run in Python workers carry their code along
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _range_sorted(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows sorted over all tasks, with the number of their range."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("__range", F.spark_partition_id())


def _changes(key: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Mask of the rows whose key differs from the row before (nulls are equal)."""
    n = len(key)
    first = np.ones(1, dtype=bool) if before is None else _differ(key.slice(0, 1), before)
    return np.concatenate([first, _differ(key.slice(1), key.slice(0, n - 1))])


def _differ(a: pa.Array, b: pa.Array) -> np.ndarray:
    same = pc.if_else(pc.and_(pc.is_valid(a), pc.is_valid(b)), pc.equal(a, b), pc.and_(pc.is_null(a), pc.is_null(b)))
    return ~pc.fill_null(same, False).to_numpy(zero_copy_only=False)


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def _free(df: DataFrame, *names: str) -> None:
    taken = set(names) & set(df.columns)
    if taken:
        raise ValueError(f"columns in the way: {sorted(taken)}")


# ------------------------------------------------------------------ sessions
def with_session_start(df: DataFrame, key: str, time: str, gap_seconds: float) -> DataFrame:
    """``df`` with ``session_start``: the time of the first row of its session.

    A session is a run of one key's rows, by time, in which no row comes more
    than ``gap_seconds`` after the one before. Rows with a null time belong to
    none and are left out; rows with a null key are one key's. Rows of the same
    time share a session, in any order. ``time`` is a timestamp or
    timestamp_ntz. The result reads a table written once under the checkpoint
    directory."""
    _free(df, "session_start", "__range", "__opening")
    gap = round(gap_seconds * 1_000_000)
    kind = df.schema[time].dataType
    sorted_ = _range_sorted(df.filter(F.col(time).isNotNull()), [key, time])
    micros = pa.int64()

    def sessions(batches):
        last_key, last_time, start, opening = None, None, None, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = pc.cast(batch.column(time), micros).to_numpy(zero_copy_only=False)
            keys = batch.column(key)
            new = _changes(keys, last_key)
            step = np.diff(at, prepend=at[0] if last_time is None else last_time)
            new |= step > gap
            begins = np.where(new, np.arange(n), -1)
            begins = np.maximum.accumulate(begins)
            starts = np.where(begins >= 0, at[np.maximum(begins, 0)], 0 if start is None else start)
            # the range's first session may have begun in a range before
            sessions_seen = np.cumsum(new) + (0 if last_time is None else 1 if opening else 2)
            opens = sessions_seen == 1
            last_key, last_time, start, opening = keys.slice(n - 1), int(at[-1]), int(starts[-1]), bool(opens[-1])
            yield _with(batch, __opening=pa.array(opens), session_start=pc.cast(pa.array(starts, micros), batch.schema.field(time).type))

    schema = T.StructType([*sorted_.schema.fields, T.StructField("__opening", T.BooleanType()), T.StructField("session_start", kind)])
    local, _ = materialize(sorted_.mapInArrow(sessions, schema), "sessions")

    # one row per range: its first and last row, and where its last session began
    edge = F.struct(F.col(key).alias("k"), F.col(time).alias("t"), F.col("session_start").alias("start"), F.col("__opening").alias("o"))
    order = F.struct(F.col(key).isNotNull(), F.col(key), F.col(time))  # as the ranges are sorted: null keys first
    told = local.groupBy("__range").agg(F.min_by(edge, order).alias("first"), F.max_by(edge, order).alias("last")).orderBy("__range").toArrow()
    ranges, began, before = [], [], None
    for r in told.to_pylist():
        first, last = r["first"], r["last"]
        if before and before["k"] == first["k"] and first["t"] - before["t"] <= timedelta(microseconds=gap):
            ranges.append(r["__range"])
            began.append(before["start"])
            if last["o"]:  # one session from end to end
                last["start"] = before["start"]
        before = last
    columns = df.columns
    if not ranges:
        return local.select(*columns, "session_start")
    start_type = told.schema.field("last").type.field("start").type
    patch = df.sparkSession.createDataFrame(pa.table({"range": pa.array(ranges, pa.int32()), "began": pa.array(began, start_type)}),
                                            T.StructType([T.StructField("range", T.IntegerType()), T.StructField("began", kind)]))
    return local.join(F.broadcast(patch), (F.col("__range") == F.col("range")) & F.col("__opening"), "left").select(
        *columns, F.coalesce("began", "session_start").alias("session_start"))


def sessions(df: DataFrame, key: str, time: str, gap_seconds: float, *measures) -> DataFrame:
    """One row per session: key, ``session_start``, ``session_end``,
    ``n_events`` and the aggregates ``measures``. They combine map side, so a
    session of any length is a partial row per task."""
    return with_session_start(df, key, time, gap_seconds).groupBy(key, "session_start").agg(
        F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n_events"), *measures)


# --------------------------------------------------------------- as-of joins
def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, how: str = "left",
              within_seconds: float | None = None) -> DataFrame:
    """Every row of ``left`` with the row of ``right`` of the same key that has
    the greatest ``right_time <= left_time``: the columns of ``left``, then
    those of ``right`` but the key.

    ``how`` is ``left`` (rows without a match get nulls) or ``inner``;
    ``within_seconds`` is the greatest distance of a match. Null keys and times
    match nothing. ``right`` should have one row per key and time; of several,
    the greatest by its other columns, in their order, is taken. Both times
    have one type, timestamp or timestamp_ntz. Column names of the two sides
    other than the key must differ. The result reads a table written once under
    the checkpoint directory."""
    if how not in ("left", "inner"):
        raise ValueError(f"how: left or inner, not {how!r}")
    values = [c for c in right.columns if c != key]
    own = [c for c in left.columns if c != key]
    if set(values) & set(own):
        raise ValueError(f"columns on both sides: {sorted(set(values) & set(own))}")
    _free(left, "__range", "__side", "__time", "__late", *[f"__{c}" for c in values])
    fields = {f.name: f.dataType for f in (*left.schema.fields, *right.schema.fields)}
    usable = F.col(key).isNotNull() & F.col(right_time).isNotNull()
    none = lambda c: F.lit(None).cast(fields[c]).alias(c)
    # one frame of both sides; of equal times the right rows come first
    both = left.select(key, F.col(left_time).alias("__time"), F.lit(1).alias("__side"), *own, *[none(c) for c in values]).unionByName(
        right.filter(usable).select(key, F.col(right_time).alias("__time"), F.lit(0).alias("__side"), *[none(c) for c in own], *values))
    rest = [c for c in values if c != right_time]
    sorted_ = _range_sorted(both, [key, "__time", "__side", *rest])
    out = T.StructType([T.StructField(c, fields[c]) for c in (key, *own)]
                       + [T.StructField("__range", T.IntegerType()), T.StructField("__side", T.IntegerType()), T.StructField("__late", T.BooleanType())]
                       + [T.StructField(f"__{c}", fields[c]) for c in values])

    def fill(batches):
        last_key, carried, opening = None, None, True  # carried: the key's latest right row
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key)
            new = _changes(keys, last_key)
            place = np.arange(n)
            run = np.maximum.accumulate(np.where(new, place, 0))
            ends_before = not new[0] if last_key is not None else False  # the first run goes on from the batch before
            is_right = batch.column("__side").to_numpy(zero_copy_only=False) == 0
            latest = np.maximum.accumulate(np.where(is_right, place, -1))
            inside = latest >= run
            first_run = np.cumsum(new) == (0 if ends_before else 1)
            from_carried = ~inside & first_run & ends_before & (carried is not None)
            take = np.where(inside, latest + 1, np.where(from_carried, 0, -1))
            index = pa.array(take, pa.int64(), mask=take < 0)
            # not settled here: rows of the range's first key before its first right row
            in_opening = first_run & opening if (last_key is None or ends_before) else np.zeros(n, dtype=bool)
            late = in_opening & (take < 0)
            filled = {}
            for c in values:
                column = batch.column(c)
                head = pa.nulls(1, column.type) if carried is None else carried[c]
                filled[f"__{c}"] = pa.concat_arrays([head, column]).take(index)
            columns = [batch.column(c) for c in (key, *own, "__range", "__side")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(late), *filled.values()],
                                             names=[key, *own, "__range", "__side", "__late", *filled])
            opening = opening and bool(in_opening[-1])
            last_key = keys.slice(n - 1)
            carried = None if take[-1] < 0 else {c: filled[f"__{c}"].slice(n - 1) for c in values}

    local, _ = materialize(sorted_.select(key, *own, *values, "__range", "__side").mapInArrow(fill, out), "asof")

    # what each range leaves behind: its last key and that key's latest right row
    t = f"__{right_time}"
    found = [F.col(f"__{c}").alias(c) for c in values]
    order = F.struct(F.col(key).isNotNull(), F.col(key), F.col(t), *[F.col(f"__{c}") for c in rest])
    told = local.groupBy("__range").agg(F.min_by(key, order).alias("first"), F.max_by(key, order).alias("last"),
                                        F.max_by(F.struct(*found), order).alias("row")).orderBy("__range").toArrow()
    has = pc.is_valid(pc.struct_field(told.column("row"), right_time)).to_pylist()
    ranges, takes, before = [], [], None  # before: place and key of the row that later ranges may need
    for i, (r, first, last) in enumerate(zip(*(told.column(c).to_pylist() for c in ("__range", "first", "last")))):
        goes_on = before is not None and first is not None and before[1] == first
        if goes_on:
            ranges.append(r)
            takes.append(before[0])
        if has[i]:
            before = (i, last)
        elif not goes_on or last != first:
            before = None
    result = local.filter("__side = 1")
    picked = found
    if ranges:
        row = T.StructType([T.StructField(c, fields[c]) for c in values])
        patch = left.sparkSession.createDataFrame(pa.table({"range": pa.array(ranges, pa.int32()), "patch": told.column("row").take(pa.array(takes))}),
                                                  T.StructType([T.StructField("range", T.IntegerType()), T.StructField("patch", row)]))
        result = result.join(F.broadcast(patch), (F.col("__range") == F.col("range")) & F.col("__late"), "left")
        picked = [F.when(F.col(t).isNotNull(), F.col(f"__{c}")).otherwise(F.col("patch")[c]).alias(c) for c in values]
    result = result.select(*left.columns, *picked)
    if within_seconds is not None:
        near = F.col(right_time) >= F.col(left_time) - F.make_dt_interval(secs=F.lit(within_seconds).cast("decimal(18,6)"))
        result = result.select(*left.columns, *[F.when(near, F.col(c)).alias(c) for c in values])
    return result.filter(F.col(right_time).isNotNull()) if how == "inner" else result
