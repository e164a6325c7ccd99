"""Bulk-synchronous best-fit packing of token pieces into sequences.

Documents longer than a sequence are cut; the pieces are then packed in
rounds, each over all open pieces and all gaps at once:

1. pieces and gaps are range-sorted together by size, largest first;
2. every task sweeps its range: a gap goes on a stack, a piece takes the top of
   it, which is its successor, the smallest gap that still holds it;
3. pieces that found no gap in their range meet the gaps that larger ranges
   left over. Which ones is settled by rank: only the two counts of each range
   are compared, then pieces and gaps join on the rank;
4. gaps shrink, placed pieces leave, and the next round starts.

A gap that holds several of the largest open piece is offered as that many
slots, so the number of rounds follows the logarithm of a sequence's pieces.
Sequences are opened by need: one for every piece longer than half a sequence,
then as many as the open pieces need beyond the gaps. Token lengths and
identities are all that is shuffled; the rounds' tables are written under
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.tokens import piece_rows
from cartwheel.llm.words import release_caches
from cartwheel.plans.sink import materialize


@dataclass(frozen=True)
class PackParams:
    tokenizer: str | None = None  # file of a `tokenizers` vocabulary; None: word_bpe_49k.json
    capacity: int = 2048
    end_id: int = 0               # closes every document


_SWEPT = pa.schema([("range", pa.int64()), ("rank", pa.int64()), ("item", pa.int64()), ("size", pa.int64()), ("gap", pa.int64())])
_SWEPT_DDL = "range long, rank long, item long, size long, gap long"


def _sweep(batches):
    """One sorted range: matched pairs, then what is left of it.

    Rows out: matched ``(-, -, piece, length, sequence)``; a piece without a
    gap here ``(range, rank, piece, length, -)``, ranked from the largest; a
    gap left over ``(range, rank, -, size, sequence)``, ranked from the top of
    the stack (the smallest). The stack holds (slots of) gaps of one range."""
    release_caches()  # the tokens are counted
    stack: list[tuple[int, int]] = []
    where, unplaced = None, 0
    out: list[tuple] = []

    def batch():
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=_SWEPT)

    for b in batches:
        for rng, kind, size, ident in zip(*(b.column(c).to_pylist() for c in ("range", "kind", "size", "ident"))):
            where = rng
            if kind == 0:
                stack.append((ident, size))
            elif stack:
                out.append((None, None, ident, size, stack.pop()[0]))
            else:
                out.append((rng, unplaced, ident, size, None))
                unplaced += 1
        yield batch()
        out = []
    for rank, (ident, size) in enumerate(reversed(stack)):
        out.append((where, rank, None, size, ident))
        if len(out) >= 65536:
            yield batch()
            out = []
    if out:
        yield batch()


def _across(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Ranges' (range, pieces left, gaps left), largest sizes first ->
    (piece range, first rank, gap range, first rank, number)."""
    stack: list[list[int]] = []
    out = []
    for rng, pieces, gaps in counts:
        taken = 0
        while pieces > taken and stack:
            top = stack[-1]
            n = min(pieces - taken, top[2])
            out.append((rng, taken, top[0], top[1], n))
            taken, top[1], top[2] = taken + n, top[1] + n, top[2] - n
            if not top[2]:
                stack.pop()
        if gaps:
            stack.append([rng, 0, gaps])
    return out


#: pieces and gaps of a range, about: late rounds, in which few are open, take few ranges
RANGE_ROWS = 25_000


def _round(spark: SparkSession, pieces: DataFrame, gaps: DataFrame, longest: int, shortest: int, rows: int) -> DataFrame:
    """``item, size, gap``: each open piece with the sequence it goes to, if any.
    ``rows``: pieces and gaps together."""
    slots = gaps.filter(F.col("gap") >= shortest).withColumn("n", F.greatest(F.lit(1), F.floor(F.col("gap") / longest))) \
        .select(F.lit(0).alias("kind"), F.floor(F.col("gap") / F.col("n")).alias("size"),
                F.col("seq").alias("ident"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("slot")).drop("slot")
    both = slots.unionByName(pieces.select(F.lit(1).alias("kind"), F.col("length").alias("size"), F.col("item").alias("ident")))
    n = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), 1 + rows // RANGE_ROWS)
    order = [F.desc("size"), F.asc("kind"), F.asc("ident")]
    swept = (both.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("range", F.spark_partition_id().cast("long")).mapInArrow(_sweep, _SWEPT_DDL))
    swept, _ = materialize(swept, "pack-swept")
    # two counts of each range reach the driver: as many rows as ranges
    left = swept.filter("range is not null").groupBy("range").agg(
        F.count("item").alias("pieces"), (F.count("*") - F.count("item")).alias("gaps")).orderBy("range").collect()
    pairs = _across([(r["range"], r["pieces"], r["gaps"]) for r in left])
    done = swept.filter("item is not null and gap is not null").select("item", "size", "gap")
    waiting = swept.filter("item is not null and gap is null")
    if not pairs:
        return done.unionByName(waiting.select("item", "size", "gap"))
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "m long, pr long, p0 long, gr long, g0 long, n long")
    inside = lambda rng, first: (F.col("range") == F.col(rng)) & (F.col("rank") >= F.col(first)) & (F.col("rank") < F.col(first) + F.col("n"))
    p = waiting.join(F.broadcast(table), inside("pr", "p0"), "left") \
        .select("item", "size", "m", (F.col("rank") - F.col("p0")).alias("k"))
    g = swept.filter("item is null").join(F.broadcast(table), inside("gr", "g0")) \
        .select("gap", "m", (F.col("rank") - F.col("g0")).alias("k"))
    return done.unionByName(p.join(g, ["m", "k"], "left").select("item", "size", "gap"))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces``: unique ``item`` (long) and ``length`` (1 to ``capacity``) ->
    ``item, seq, offset``; every piece once, sequences gapless from 0."""
    spark = pieces.sparkSession
    # sequences of pieces over half the capacity are named by the piece; opened ones count down from -1
    big = pieces.filter(F.col("length") > capacity // 2)
    placed = big.select("item", F.col("item").alias("seq"), F.lit(0).cast("long").alias("offset"))
    gaps, _ = materialize(big.select(F.col("item").alias("seq"), (F.lit(capacity) - F.col("length")).cast("long").alias("gap"))
                             .filter("gap > 0"), "pack-gaps")
    open_, _ = materialize(pieces.filter(F.col("length") <= capacity // 2).select("item", F.col("length").cast("long").alias("length")), "pack-open")
    results, opened = [placed], 0
    while True:
        o = open_.agg(F.max("length"), F.min("length"), F.sum("length"), F.count("*")).first()
        longest, shortest, total, n_open = o
        if longest is None:
            break
        g = gaps.filter(F.col("gap") >= shortest).agg(F.max("gap"), F.sum("gap"), F.count("*")).first()
        need = max(0, -(-(total - (g[1] or 0)) // capacity))
        if not need and (g[0] or 0) < longest:
            need = 1
        if need:
            new = spark.range(opened, opened + need).select((-F.col("id") - 1).alias("seq"), F.lit(capacity).cast("long").alias("gap"))
            gaps, opened = gaps.unionByName(new), opened + need
        got, _ = materialize(_round(spark, open_, gaps, longest, shortest, n_open + g[2] + need), "pack-round")
        hit = got.filter("gap is not null").select("item", "size", F.col("gap").alias("seq"))
        # a gap's pieces of this round lie one behind the other (a sequence holds at most `capacity` pieces)
        w = Window.partitionBy("seq").orderBy(F.desc("size"), "item")
        before = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1))
        laid = hit.join(gaps, "seq").select("item", "seq", "size", "gap", F.coalesce(before, F.lit(0)).alias("before"))
        laid, _ = materialize(laid.select("item", "seq", "size", "gap", (F.lit(capacity) - F.col("gap") + F.col("before")).cast("long").alias("offset")), "pack-laid")
        results.append(laid.select("item", "seq", "offset"))
        used = laid.groupBy("seq").agg(F.sum("size").alias("used"))
        open_, _ = materialize(got.filter("gap is null").select("item", F.col("size").alias("length")), "pack-open")
        gaps, _ = materialize(gaps.join(used, "seq", "left").select("seq", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"))
                                  .filter("gap > 0"), "pack-gaps")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def pack_documents(docs: DataFrame, params: PackParams = PackParams(), with_ids: bool = False) -> DataFrame:
    """One row per piece of every row of ``docs``: ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset`` (and ``ids``, the piece's packed
    unsigned 32-bit ids, on request).

    A null or empty text is its closing id alone. Repeated rows and null ids
    are packed like any other row. Extra columns are ignored; an empty table
    gives an empty result. ``sequence_id`` tells sequences apart and nothing
    else."""
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    table = piece_rows(docs, params.tokenizer, params.capacity, params.end_id, with_ids)
    table, _ = materialize(table.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    places = pack(table.select("item", "length"), params.capacity)
    return table.join(places, "item").select(*cols, F.col("seq").alias("sequence_id"), "offset")
