"""Heavy hitters: the keys that hold more than a share of all rows, exactly.

First pass: every task keeps a Misra-Gries summary, at most ``2 / share``
counters whatever the number of keys. Summaries of parts merge by adding up:
a key's sum is below its true count by no more than what all tasks took off. So
every key above the share is among the candidates, and there are at most
``2 / share`` of them. Second pass: only the candidates' rows are counted. The
full count by key, which would shuffle a row per key and task, never happens.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.plans.sink import materialize, remove_path

# the functions that run in Python workers carry their code along
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class MisraGries:
    """At most ``limit`` counters. ``taken``: what a counter may lack."""

    def __init__(self, limit: int):
        self.limit, self.taken, self.total = limit, 0, 0
        self.counts: dict = {}

    def add(self, keys, weights) -> None:
        for key, weight in zip(keys, weights):
            self.total += weight
            self.counts[key] = self.counts.get(key, 0) + weight
        if len(self.counts) > self.limit:
            # take the weight of the first that does not fit off all; what is left fits
            sizes = np.fromiter(self.counts.values(), dtype=np.int64, count=len(self.counts))
            off = int(-np.partition(-sizes, self.limit)[self.limit])
            self.taken += off
            self.counts = {k: c - off for k, c in self.counts.items() if c > off}


def summaries(df: DataFrame, key: str, weight: str, limit: int) -> DataFrame:
    """Per task: its counters (``key, count``) and a row with a null key's place
    taken by ``taken`` and ``total``."""
    kind = df.schema[key].dataType

    def of(batches):
        state = MisraGries(limit)
        key_type, step = None, max(4 * limit, 4096)
        for batch in batches:
            key_type = batch.schema.field(key).type
            for at in range(0, batch.num_rows, step):  # counters between two prunings stay bounded
                sums = pa.Table.from_batches([batch.slice(at, step)]).group_by(key).aggregate([(weight, "sum")])
                state.add(sums.column(key).to_pylist(), sums.column(f"{weight}_sum").to_pylist())
        if key_type is not None:
            keys, counts = list(state.counts), list(state.counts.values())
            yield pa.RecordBatch.from_arrays([pa.array([*keys, None], key_type), pa.array([*counts, 0], pa.int64()),
                                              pa.array([*[0] * len(keys), state.taken], pa.int64()), pa.array([*[0] * len(keys), state.total], pa.int64())],
                                             names=["key", "count", "taken", "total"])

    return df.select(key, weight).mapInArrow(of, f"key {kind.simpleString()}, count long, taken long, total long")


def heavy_hitters(df: DataFrame, key: str, share: float, weight: str | None = None) -> DataFrame:
    """``key, n, total``: keys with more than ``share`` of the rows (or of the
    sum of the integer column ``weight``; nulls and negative weights count 0),
    their exact counts, and the total over all keys. Rows with a null key count
    in the total only. At most ``1 / share`` rows."""
    if not 0 < share < 1:
        raise ValueError(f"share between 0 and 1: {share}")
    limit = math.ceil(2 / share)
    w = F.lit(1).cast("long") if weight is None else F.greatest(F.lit(0), F.coalesce(F.col(weight).cast("long"), F.lit(0)))
    rows = df.select(F.col(key).alias("key"), w.alias("weight"))
    keyed = rows.filter("key is not null")
    parts, path = materialize(summaries(keyed, "key", "weight", limit), "heavy-summaries")
    told = parts.agg(F.sum("taken").alias("taken"), F.sum("total").alias("total")).first()
    total = rows.agg(F.sum("weight")).first()[0] or 0
    taken = told["taken"] or 0
    # taken <= total / limit in all, so a candidate's counters exceed share / 2 of the total: at most 2 / share candidates
    candidates = parts.filter("key is not null").groupBy("key").agg(F.sum("count").alias("c")) \
                      .filter(F.col("c") + F.lit(taken) > F.lit(share) * F.lit(total)).select("key")
    exact = keyed.join(F.broadcast(candidates), "key", "left_semi").groupBy("key").agg(F.sum("weight").alias("n"))
    result, _ = materialize(exact.filter(F.col("n") > F.lit(share) * F.lit(total)).select(
        F.col("key").alias(key), "n", F.lit(total).cast("long").alias("total")), "heavy")
    remove_path(df.sparkSession, path)
    return result
