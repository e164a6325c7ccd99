"""Running values along groups that may be larger than any task.

:func:`running` numbers the rows of every group and names the prefixes they
end, in an order given by columns. Rows are range-sorted over all tasks, so a
group with a third of all rows spans many of them; each range runs over its own
rows, and what its first group brought along from the ranges before is added in
a second pass. That works because a prefix's name is associative: ``t1 .. tn``
is the polynomial ``t1*B + t2*B**2 + ..`` modulo a prime of 127 bits, and what
stands before a part only adds to it and shifts it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.words import emit, release_caches, rows
from cartwheel.plans.sink import materialize

PRIME = (1 << 127) - 1
BASE = 0x3C6EF372FE94F82BA54FF53A5F1D36F1  # any number below the prime

#: name of the sequence without elements
EMPTY = bytes(16)

_STATE = [("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("cum", pa.int64())]


def _number(name: bytes) -> int:
    return int.from_bytes(name, "big")


def _name(number: int) -> bytes:
    return number.to_bytes(16, "big")


def join_names(before: bytes, count: int, name: bytes) -> bytes:
    """Name of a sequence of ``count`` elements called ``before`` and the one called ``name`` behind it."""
    return _name((_number(before) + pow(BASE, count, PRIME) * _number(name)) % PRIME)


def running(table: DataFrame, order: list[str], name: str) -> tuple[DataFrame, str]:
    """``conv_id, item, words`` and ``depth`` (from 1), ``node`` and ``parent`` (names
    of the prefix with and without the row) and ``cum`` (sum of ``words`` up to
    the row) of every row of ``table(conv_id, item, words)``, where ``item`` is
    the 16-byte identity of a row's content.

    Rows that ``conv_id`` and ``order`` leave equal come in any order, so they
    must be interchangeable. One shuffle; the driver gets one row per range.
    An empty table gives no rows. Returns the lazy frame and the path of the
    table under it."""
    spark = table.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    by = list(dict.fromkeys(["conv_id", *order]))
    ranged = table.repartitionByRange(n, *by).sortWithinPartitions(*by) \
                  .select(F.spark_partition_id().alias("range"), "conv_id", "item", "words")
    schema = pa.schema([("range", pa.int32()), ("pos", pa.int64()), ("opening", pa.bool_()), ("conv_id", pa.int64()), ("item", pa.binary()),
                        ("words", pa.int64()), *_STATE])
    ddl = "range int, pos long, opening boolean, conv_id long, item binary, words long, depth long, node binary, parent binary, cum long"

    def run(batches):
        release_caches()

        def out():
            now, opening, depth, power, total, cum = None, True, 0, 1, 0, 0
            parent = EMPTY
            for pos, (r, conv, item, words) in enumerate(rows(batches, "range", "conv_id", "item", "words")):
                if conv != now:
                    now, opening = conv, pos == 0
                    depth, power, total, cum, parent = 0, 1, 0, 0, EMPTY
                power = power * BASE % PRIME
                total = (total + power * _number(item)) % PRIME
                depth, cum, node = depth + 1, cum + words, _name(total)
                yield (r, pos, opening, conv, item, words, depth, node, parent, cum)
                parent = node
        yield from emit(schema, out(), max_rows=8192)

    local, path = materialize(ranged.mapInArrow(run, ddl), name)
    told = local.groupBy("range").agg(F.min(F.struct("pos", "conv_id")).alias("first"),
                                      F.max(F.struct("pos", "conv_id", "depth", "node", "cum")).alias("last")).orderBy("range").collect()
    carried: dict[int, tuple[int, bytes, int]] = {}
    before = None  # group and state that the ranges so far leave open
    for r in told:
        state = (r["last"]["depth"], bytes(r["last"]["node"]), r["last"]["cum"])
        if before and before[0] == r["first"]["conv_id"]:
            carried[r["range"]] = before[1]
            if r["last"]["conv_id"] == before[0]:
                d, h, c = before[1]
                state = (d + state[0], join_names(h, d, state[1]), c + state[2])
        before = (r["last"]["conv_id"], state)

    columns = ["conv_id", "item", "words", "depth", "node", "parent", "cum"]
    if not carried:
        return local.select(*columns), path
    whole = pa.schema([schema.field(c) for c in columns])

    def add(batches):
        for batch in batches:
            ranges, opening = batch.column("range").to_pylist(), batch.column("opening").to_pylist()
            late = [r in carried and o for r, o in zip(ranges, opening)]
            if not any(late):
                yield batch.select(columns)
                continue
            state = {c: batch.column(c).to_pylist() for c in ("depth", "node", "parent", "cum")}
            for i, r in enumerate(ranges):
                if late[i]:
                    d, h, c = carried[r]
                    state["depth"][i] += d
                    state["cum"][i] += c
                    state["node"][i] = join_names(h, d, state["node"][i])
                    state["parent"][i] = join_names(h, d, state["parent"][i])
            yield pa.RecordBatch.from_arrays([pa.array(state[c], type=whole.field(c).type) if c in state else batch.column(c) for c in columns],
                                             schema=whole)

    return local.mapInArrow(add, "conv_id long, item binary, words long, depth long, node binary, parent binary, cum long"), path
