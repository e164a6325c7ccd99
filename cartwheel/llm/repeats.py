"""Which 64-bit hashes of a document also occur in another document?

The primitive under the similarity join and the substring search. Input is
one row per document: ``key`` (16 bytes: its identity) and ``hashes`` (packed
little-endian uint64). Output is one row per document that has any: its key and
those of its hashes that at least one document with a different key has too.

Two shuffles, by hash and back by document, and they survive any skew:

* map side, each task works on blocks of about ``block`` postings. Within a
  block a hash held by two or more keys is known to repeat: its documents are
  credited at once and only one marker per block goes on. So a hash that a
  third of all documents share costs one entry per block, not per document;
* postings travel as packed arrays, one row per block and bucket, not as rows
  of their own;
* reduce side, a task's rows come sorted by bucket. It holds the postings of one
  bucket at a time (a bounded slice: there are as many as
  ``spark.sql.shuffle.partitions``, sized from the input), sorts these and sends
  the repeated ones on, packed by their documents' bucket. More buckets than
  tasks would hold less at once, but pack a block's postings into more rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwheel.llm.words import emit, release_caches, rows

_MARK = np.uint32(0xFFFFFFFF)
_PACKED = pa.schema([("bucket", pa.int32()), ("credit", pa.bool_()), ("keys", pa.binary()),
                     ("owner", pa.binary()), ("hashes", pa.binary())])
_PACKED_DDL = "bucket int, credit boolean, keys binary, owner binary, hashes binary"
_FOUND = pa.schema([("key", pa.binary()), ("hashes", pa.binary())])


def _key_words(keys: list[bytes]) -> np.ndarray:
    """First 8 bytes of each key, to tell owners of a hash apart."""
    return np.frombuffer(b"".join(k[:8] for k in keys), dtype="<u8")


def _runs(h: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (hash, owner), start of each hash's run, and distinct owners per run."""
    order = np.lexsort((who, h))
    hs, ws = h[order], who[order]
    first = np.empty(len(hs), dtype=bool)
    first[:1] = True
    first[1:] = hs[1:] != hs[:-1]
    new = first.copy()
    new[1:] |= ws[1:] != ws[:-1]
    starts = np.flatnonzero(first)
    return order, starts, np.add.reduceat(new.astype(np.int64), starts)


def _pack(keys: list[bytes], owner: np.ndarray, h: np.ndarray, bucket: np.ndarray, credit: bool) -> Iterator[tuple]:
    """One row per bucket that has any; owners are numbered anew within it."""
    by = np.argsort(bucket, kind="stable")
    there, cuts = np.unique(bucket[by], return_index=True)
    for b, part in zip(there.tolist(), np.split(by, cuts[1:])):
        ids, local = np.unique(owner[part], return_inverse=True)
        local = np.where(owner[part] == _MARK, _MARK, local).astype(np.uint32)
        yield (b, credit, b"".join(keys[i] for i in ids if i != _MARK), local.tobytes(), h[part].tobytes())


def _pack_by_key(keys: list[bytes], owner: np.ndarray, h: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows that bring repeated hashes to their documents' buckets."""
    at = np.frombuffer(b"".join(k[8:16] for k in keys), dtype="<u8") % np.uint64(buckets)
    yield from _pack(keys, owner, h, at.astype(np.int32)[owner], True)


def _unpack(parts: list[tuple]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Keys, owners (-1: a marker) and hashes of packed rows."""
    keys: list[bytes] = []
    owners, hashes = [], []
    for k, o, h in parts:
        own = np.frombuffer(o, dtype=np.uint32).astype(np.int64)
        owners.append(np.where(own == int(_MARK), -1, own + len(keys)))
        hashes.append(np.frombuffer(h, dtype="<u8"))
        keys.extend(k[i:i + 16] for i in range(0, len(k), 16))
    return keys, np.concatenate(owners), np.concatenate(hashes)


def _block(keys: list[bytes], arrays: list[np.ndarray], buckets: int) -> Iterator[tuple]:
    h = np.concatenate(arrays)
    owner = np.repeat(np.arange(len(keys), dtype=np.uint32), [len(a) for a in arrays])
    order, starts, distinct = _runs(h, _key_words(keys)[owner])
    h, owner = h[order], owner[order]
    repeated = distinct > 1
    credited = np.repeat(repeated, np.diff(np.append(starts, len(h))))
    if credited.any():
        yield from _pack_by_key(keys, owner[credited], h[credited], buckets)
    # one posting per hash: its owner, or the mark that it already repeats
    h = h[starts]
    yield from _pack(keys, np.where(repeated, _MARK, owner[starts]), h, (h % np.uint64(buckets)).astype(np.int32), False)


def repeated_hashes(docs: DataFrame, block: int = 250_000) -> DataFrame:
    """``docs``: columns ``key`` (16-byte binary) and ``hashes`` (packed uint64).

    Null or empty ``hashes`` give no rows; rows with equal keys count as one
    document. Returns ``key, hashes``, one row per key (see module text)."""
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def pack(batches):
        release_caches()

        def blocks():
            keys: list[bytes] = []
            arrays: list[np.ndarray] = []
            seen: set[bytes] = set()
            held = 0
            for key, packed in rows(batches, "key", "hashes"):
                if not packed or key in seen:
                    continue
                seen.add(key)
                keys.append(key)
                arrays.append(np.frombuffer(packed, dtype="<u8"))
                held += len(arrays[-1])
                if held >= block:
                    yield from _block(keys, arrays, buckets)
                    keys, arrays, seen, held = [], [], set(), 0
            if keys:
                yield from _block(keys, arrays, buckets)
        yield from emit(_PACKED, blocks())

    def find(batches):
        release_caches()

        def found():
            for bucket, told in groupby(rows(batches, *_PACKED.names), itemgetter(0)):
                own = []
                for _, credit, k, o, h in told:
                    if credit:
                        yield (bucket, True, k, o, h)
                    else:
                        own.append((k, o, h))
                if not own:
                    continue
                keys, owner, h = _unpack(own)
                del own
                if not keys:
                    continue
                marked = owner < 0
                order, starts, distinct = _runs(h, np.where(marked, np.uint64(0), _key_words(keys)[owner]))
                lengths = np.diff(np.append(starts, len(h)))
                marks = np.add.reduceat(marked[order].astype(np.int64), starts)
                hit = np.repeat((distinct > 1) | (marks > 0), lengths) & ~marked[order]
                if hit.any():
                    yield from _pack_by_key(keys, owner[order][hit].astype(np.uint32), h[order][hit], buckets)
        yield from emit(_PACKED, found())

    def collect(batches):
        def found():
            for _, told in groupby(rows(batches, *_PACKED.names), itemgetter(0)):
                keys, owner, h = _unpack([r[2:] for r in told])
                names, ids = np.unique(np.array(keys, dtype="V16"), return_inverse=True)
                who = ids[owner]
                order = np.lexsort((h, who))
                who, h = who[order], h[order]
                keep = np.ones(len(h), dtype=bool)
                keep[1:] = (who[1:] != who[:-1]) | (h[1:] != h[:-1])
                who, h = who[keep], h[keep]
                cuts = np.searchsorted(who, np.arange(len(names) + 1))
                for i, name in enumerate(names):
                    yield (name.tobytes(), h[cuts[i]:cuts[i + 1]].tobytes())
        yield from emit(_FOUND, found())

    packed = docs.select("key", "hashes").mapInArrow(pack, _PACKED_DDL)
    found = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(find, _PACKED_DDL)
    return found.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(collect, "key binary, hashes binary")
