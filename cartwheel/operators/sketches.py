"""Distinct counts that roll up: mergeable sketch state beside the measures.

A distinct count cannot be summed over months or regions. A HyperLogLog sketch
can be united, so the state saved per fine group answers any coarser question
without going back to the fact. State of small groups is small (a list of
hashes up to eight values), and a group's state never grows beyond ``2**lg_k``
bytes and a header, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the standard error of a sketch is at most RSE / sqrt(2**lg_k)
RSE = 1.04
SKETCH = "sketch"


def sketch_state(df: DataFrame, by: Sequence[str], of: str, lg_k: int = 12) -> DataFrame:
    """``by`` columns and the ``sketch`` of the distinct non-null values of
    ``of`` (null where there are none). Partial sketches combine map side."""
    return df.groupBy(*by).agg(F.when(F.count(of) > 0, F.hll_sketch_agg(of, F.lit(lg_k))).alias(SKETCH))


def roll_up(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """The state by fewer or other columns: sketches united, rows of the state
    and not of the fact are read. No columns: one row over all."""
    return state.groupBy(*by).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def estimate(sketch: str | Column = SKETCH) -> Column:
    """The distinct count of a sketch; 0 for a null one."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0).cast("long"))


def error_bound(exact: str | Column, lg_k: int = 12, deviations: float = 4.0) -> Column:
    """How far an estimate may be from the exact count: so many standard
    deviations (beyond 4, fewer than one estimate in 15,000), at least 1."""
    n = F.col(exact) if isinstance(exact, str) else exact
    return F.greatest(F.lit(1.0), n * F.lit(deviations * RSE / 2 ** (lg_k / 2)))


def levels(state: DataFrame, sets: Sequence[Sequence[str]], finest: Sequence[str]) -> DataFrame:
    """Several roll-ups of ``state`` in one frame: ``finest`` columns (null
    where a level does without one) and the sketch. The state is united to the
    finest columns first and every level comes from that."""
    base = roll_up(state, finest)
    out = None
    for columns in sets:
        level = base if list(columns) == list(finest) else roll_up(base, columns)
        level = level.select(F.lit("_".join(columns) or "all").alias("level"),
                             *[F.col(c) if c in columns else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in finest], SKETCH)
        out = level if out is None else out.unionByName(level)
    return out
