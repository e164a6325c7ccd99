"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes of the UTF-8 text decides where a
chunk ends (so boundaries move with the content), every chunk adds one
character to a signature, and two signatures of the same block size are
compared by edit distance. The block size follows from the length and is halved
while the signature stays short. A fingerprint holds the signatures of two block
sizes, ``size:signature:signature of twice the size``, so documents whose
lengths differ by up to a factor of about two still have one in common.
"""

from __future__ import annotations

from dataclasses import dataclass

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.words import MULTIPLIER, emit, mix, powers

_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_INVERSE = pow(MULTIPLIER, -1, 1 << 64)


@dataclass(frozen=True)
class FingerprintParams:
    window: int = 7       # bytes of the rolling hash
    length: int = 64      # chunks that a signature has about, at most
    smallest: int = 2     # block size of the shortest texts
    slice_bytes: int = 32_000  # of a long text that are hashed at a time
    files: int = 4        # neighbour blocks per shuffle partition


def block_size(n: int, p: FingerprintParams) -> int:
    """The smallest power-of-two multiple whose chunks fit the signature."""
    size = p.smallest
    while size * p.length < n:
        size *= 2
    return size


def _slices(data: bytes, p: FingerprintParams):
    """``at, bytes + 1, rolling hash``, a bounded part of the text at a time."""
    for at in range(0, len(data), p.slice_bytes):
        lead = min(at, p.window - 1)  # bytes before the slice that its first windows hold
        b = np.frombuffer(data, np.uint8, min(p.slice_bytes, len(data) - at) + lead, at - lead).astype(np.uint64) + np.uint64(1)
        rolling = np.zeros(len(b), dtype=np.uint64)
        for j, m in enumerate(powers(p.window)):
            rolling[j:] += b[:max(len(b) - j, 0)] * m
        yield at, b[lead:], mix(rolling)[lead:]


def _ends(rolling: np.ndarray, size: int) -> np.ndarray:
    return np.flatnonzero((rolling & np.uint64(size - 1)) == np.uint64(size - 1)) + 1


class _Signature:
    """A character per chunk, slice by slice; chunks beyond the limit share the
    last one (their bytes still count)."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.hashes: list[np.ndarray] = []
        self.count, self.start, self.open = 0, 0, np.uint64(0)

    def add(self, at: int, b: np.ndarray, rolling: np.ndarray, last: bool) -> None:
        n = len(b)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(b * powers(n), dtype=np.uint64)])
        ends = _ends(rolling, self.size)
        if last:
            ends = ends[ends < n]
        ends = ends[:self.limit - 1 - self.count]
        # the open chunk's polynomial goes on from where the slice begins
        shift = np.uint64(pow(MULTIPLIER, at - self.start, 1 << 64))
        if len(ends):
            first = self.open + shift * total[ends[0]]
            later = (total[ends[1:]] - total[ends[:-1]]) * powers(n + 1, _INVERSE)[ends[:-1]]
            self.hashes.append(np.append(first, later))
            self.count += len(ends)
            self.start = at + int(ends[-1])
            self.open = (total[n] - total[ends[-1]]) * powers(n + 1, _INVERSE)[ends[-1]]
        else:
            self.open = self.open + shift * total[n]

    def text(self) -> str:
        h = mix(np.concatenate([*self.hashes, np.array([self.open], np.uint64)]))
        return _ALPHABET[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes, p: FingerprintParams = FingerprintParams()) -> str:
    """Equal bytes have equal fingerprints; no bytes have block size and no signature.

    The block size that follows from the length is halved as long as the text
    has fewer than ``length / 2`` chunks of it, so repetitive texts get whole
    signatures too. What stays short even at the smallest size: texts of few
    bytes, and texts of one repeated character or cycle in which no window
    ends a chunk. Very long texts are read in slices of ``slice_bytes``."""
    n = len(data)
    size = block_size(n, p)
    if not n:
        return f"{size}::"
    parts = list(_slices(data, p)) if n <= p.slice_bytes else None  # one slice is hashed once
    rungs = [size >> k for k in range(size.bit_length()) if size >> k >= p.smallest]
    found = dict.fromkeys(rungs, 0)
    for at, _, rolling in parts or _slices(data, p):
        for rung in rungs:
            ends = _ends(rolling, rung)
            found[rung] += int(np.count_nonzero(at + ends < n))
            if found[rung] + 1 >= p.length // 2:
                break  # smaller sizes are not needed for what was read so far
    size = next((r for r in rungs if found[r] + 1 >= p.length // 2), rungs[-1])
    one, two = _Signature(size, 2 * p.length), _Signature(2 * size, p.length)
    for at, b, rolling in parts or _slices(data, p):
        with np.errstate(over="ignore"):  # arithmetic modulo 2**64
            for s in (one, two):
                s.add(at, b, rolling, at + len(b) == n)
    return f"{size}:{one.text()}:{two.text()}"


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 minus the edit distance over the longer signature, the best of
    the block sizes that both fingerprints have; equal fingerprints have 1,
    fingerprints without a common block size 0. Computed in the JVM."""
    x, y = F.split(a, ":"), F.split(b, ":")
    sa, sb = x[0].cast("long"), y[0].cast("long")

    def near(s: Column, t: Column) -> Column:
        longest = F.greatest(F.length(s), F.length(t))
        return F.when(longest == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(s, t) / longest)

    return F.when(a == b, F.lit(1.0)) \
            .when(sa == sb, F.greatest(near(x[1], y[1]), near(x[2], y[2]))) \
            .when(sa == 2 * sb, near(x[1], y[2])) \
            .when(2 * sa == sb, near(x[2], y[1])).otherwise(F.lit(0.0))


def edited(text: str, follower: str) -> str:
    """The last third of the code points replaced by the follower's first."""
    k = len(text) // 3
    return text[:len(text) - k] + follower[:k]


def in_order(docs: DataFrame, p: FingerprintParams) -> DataFrame:
    """``block, place, halo, doc_id, text``: rows in blocks of descending id.

    Block bounds are id quantiles (as many numbers as blocks). Each block also
    gets, marked ``halo``, the first row of the following one (of the first
    block, after the last): so every row's follower is next to it, and only one
    row per block is sent twice. Rows of equal ids are ordered by text; null
    ids come last."""
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1) * p.files
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = base.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    bounds = sorted({int(c) for c in cuts or []}, reverse=True)
    # block 0 holds ids above the first bound, block i those down to bound i
    at = F.array(*[F.lit(c) for c in bounds]).cast("array<bigint>")
    block = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)) \
             .otherwise(F.size(F.filter(at, lambda c: c >= F.col("doc_id"))))
    placed = base.withColumn("block", block.cast("int"))
    # the first row of each block: its largest id, then the smallest text
    tops = placed.groupBy("block").agg(F.count("*").alias("c"), F.max("doc_id").alias("top")).collect()
    order = sorted(r["block"] for r in tops)
    top = {r["block"]: r["top"] for r in tops}
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first follows the last
    pairs = [(b, top[b], before[b]) for b in order]
    if not pairs:
        return placed.withColumn("halo", F.lit(False))
    heads = spark.createDataFrame(pairs, "block int, top long, goes int")
    first = placed.join(F.broadcast(heads), "block").filter(F.col("doc_id").eqNullSafe(F.col("top"))) \
        .groupBy("block", "goes", "doc_id").agg(F.min("text").alias("text")) \
        .select("doc_id", "text", F.col("goes").alias("block"), F.lit(True).alias("halo"))
    both = placed.withColumn("halo", F.lit(False)).unionByName(first)
    return both.repartition(n, "block").sortWithinPartitions(
        "block", "halo", F.col("doc_id").desc_nulls_last(), "text")


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("next_fingerprint", pa.string())]


def fingerprints(docs: DataFrame, params: FingerprintParams = FingerprintParams()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.

    Null texts count as empty. The next document is the one after it in
    descending id order (equal ids: ascending text; null ids last; after the
    last, the first); a single row follows itself. Extra columns are ignored;
    an empty table gives an empty result."""
    p = params

    def of(batches):
        def row(a, b):
            text, follower = a[2], b[2]
            change = edited(text, follower).encode()
            return (a[1], len(text), hashlib.sha256(change).hexdigest(), a[3], fingerprint(change, p), b[3])

        def out():
            last = None
            for batch in batches:
                for block, doc_id, text, halo in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "text", "halo"))):
                    here = (block, doc_id, text, fingerprint(text.encode(), p))
                    if last is not None and last[0] == block:
                        yield row(last, here)
                    last = None if halo else here
        yield from emit(pa.schema(_OUT), out())

    ddl = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    made = in_order(docs, p).select("block", "doc_id", "text", "halo").mapInArrow(of, ddl)
    fp = F.col("fingerprint")
    return made.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(fp, F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(fp, F.col("next_fingerprint")).alias("near_next"))
