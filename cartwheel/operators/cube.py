"""Grouping sets with distinct counts, rolled up along a lattice.

``GROUP BY CUBE`` with a distinct count expands every fact row once per
grouping set and distinct column. Here the fact is aggregated once, to the
finest sets of dimensions together with the counted key. Every coarser set
comes from the smallest finer one that is there already: sums are summed on,
and the key's rows, one per key and set, are what a distinct count counts. Only
that first table is read; it is written under the checkpoint directory, as are
the inner nodes that have children. What is aggregated is dealt over tasks by
its number of rows, so that no task's hash table grows with the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.plans.sink import materialize, remove_path
from cartwheel.session import task_count


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for r in range(len(dims), -1, -1) for s in combinations(dims, r)]


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:r]) for r in range(len(dims), -1, -1)]


def lattice(finest: DataFrame, dims: Sequence[str], distinct: str, sums: dict[str, str], sets: Sequence[Sequence[str]], count_as: str,
            rows: int | None = None) -> DataFrame:
    """Aggregates of ``finest`` over each of ``sets`` (subsets of ``dims``).

    ``finest`` has the dimensions, the key ``distinct`` and the measures that
    ``sums`` (output: column) adds up; it may still have several rows per
    dimensions and key. Returns ``dims`` (null where a set does without one),
    ``grouping_id`` (bit set for each dimension left out, the last one lowest,
    as SQL's), the sums and ``count_as``: distinct non-null keys. Nulls of a
    dimension are a group of their own, told from a left-out one by the
    grouping_id. The empty set gives one row, on an empty table too.

    ``rows``: about how many ``finest`` has, where that is known. They are
    then dealt by dimensions and key before they are aggregated; else they are
    combined map side, and AQE chooses the tasks."""
    dims, used = list(dims), []
    sets = [tuple(d for d in dims if d in s) for s in sets]
    kinds = {f.name: f.dataType for f in finest.schema.fields}

    def node(parent: DataFrame, own: tuple[str, ...], rows: int | None) -> DataFrame:
        if rows is not None:
            parent = parent.repartition(task_count(parent.sparkSession, rows), *own, distinct)
        return parent.groupBy(*own, distinct).agg(*[F.sum(c).alias(c) for c in dict.fromkeys(sums.values())])

    order = sorted(set(sets) | {tuple(dims)}, key=len, reverse=True)
    children = {s: sum(set(t) < set(s) for t in order) for s in order}
    nodes: dict[tuple[str, ...], DataFrame] = {}
    sizes: dict[tuple[str, ...], int] = {}
    for own in order:
        finer = [s for s in nodes if set(own) < set(s)]
        best = min(finer, key=lambda s: (sizes[s], s)) if finer else None
        made = node(nodes[best], own, sizes[best]) if finer else node(finest, own, rows)
        if children[own]:
            made, path = materialize(made, "lattice")
            used.append(path)
            sizes[own] = made.count()  # from the files' footers
        else:
            sizes[own] = 0
        nodes[own] = made
    out = None
    for own in sets:
        level = nodes[own].groupBy(*own).agg(*[F.sum(c).alias(name) for name, c in sums.items()], F.count(distinct).alias(count_as))
        gid = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in own)
        level = level.select(*[F.col(d) if d in own else F.lit(None).cast(kinds[d]).alias(d) for d in dims],
                             F.lit(gid).cast("long").alias("grouping_id"), *sums, count_as)
        out = level if out is None else out.unionByName(level)
    result, _ = materialize(out, "lattice-levels")
    for path in used:
        remove_path(finest.sparkSession, path)
    return result
