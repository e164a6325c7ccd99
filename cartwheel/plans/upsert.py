"""Upsert sink: rows of a keyed table inserted or replaced by key.

The table is kept in hash buckets of its key (:mod:`cartwheel.plans.parts`). An
upsert reads the buckets that its rows fall into and rewrites those in which a
row really changes; the others keep their files. So a rerun after a lost job,
or the same rows once more, writes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.plans.parts import PartTable
from cartwheel.plans.sink import materialize, remove_path

_BUCKET = "__bucket"


@dataclass(frozen=True)
class Upserted:
    changed: int              # rows inserted or replaced
    rewritten: tuple[str, ...]  # buckets
    kept: int                 # buckets that stay as they are


def _equal(keys, other: str):
    """Null-safe equality of columns and those of the same names with a prefix."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(other + c)) for c in keys])


def upsert(table: PartTable, rows: DataFrame, keys: Sequence[str], buckets: int = 64) -> Upserted:
    """Rows of ``rows`` replace those of the same ``keys`` in ``table`` or are
    added; all others stay. Null keys are keys. ``rows`` must have every key
    once. ``buckets`` must be the same for all upserts of a table: about one
    per 256 MB of it."""
    keys = list(keys)
    repeated = rows.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"a key comes twice: {repeated[0].asDict()}")
    bucket = F.lpad(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"), 6, "0")
    new = rows.withColumn(_BUCKET, bucket)
    have = table.read()
    before = table.parts()
    if have is not None:
        if sorted(have.columns) != sorted(rows.columns):
            raise ValueError(f"the table has the columns {have.columns}, not {rows.columns}")
        new = new.select(*have.columns, _BUCKET)
        touched = {r[0] for r in new.select(_BUCKET).distinct().collect()}  # at most ``buckets``
        # what is there already, in all columns, needs no writing
        have = table.read(touched).select(*[F.col(c).alias(f"__have_{c}") for c in have.columns])
        new = new.join(have, _equal(rows.columns, "__have_"), "left_anti")
    changes, path = materialize(new, "upsert-changes")
    try:
        told = {r[_BUCKET]: r["count"] for r in changes.groupBy(_BUCKET).count().collect()}
        if told or have is None:
            merged = changes
            if have is not None:
                stays = table.read(set(told)).withColumn(_BUCKET, bucket)
                replaced = changes.select(*[F.col(c).alias(f"__new_{c}") for c in keys])
                merged = changes.unionByName(stays.join(replaced, _equal(keys, "__new_"), "left_anti"))
            table.commit(merged, _BUCKET, set(told))
    finally:
        remove_path(rows.sparkSession, path)
    return Upserted(sum(told.values()), tuple(sorted(told)), len(set(before) - set(told)))
