"""Words, word hashes and packed hash columns shared by the text operators.

The words of the n-gram operators are the runs of bytes that are not ASCII
white space (space, ``\\t \\n \\v \\f \\r``): exactly what ``bytes.split``
returns for UTF-8 text. Word hashes are 64-bit (xxHash); a window of words
is hashed by a polynomial over them, modulo 2**64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash

MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


class WordHashes(dict):
    """word bytes -> 64-bit hash; emptied beyond ``limit`` words, so its
    memory does not grow with the corpus vocabulary."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        release_caches()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer: spreads a polynomial hash over all 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = MULTIPLIER) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 15), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n > 1 << 15:  # one very long text: not kept
            return have[:n]
        _POWERS[base] = have
    return have[:n]


_INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def window_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive words (empty if fewer)."""
    n = len(w) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    if size <= 12:
        out = np.zeros(n, dtype=np.uint64)
        for j, p in enumerate(powers(size)):
            out += w[j:j + n] * p
        return mix(out)
    # prefix sums of w[i] * M**i; a window's difference is M**start times its
    # polynomial, and M**-start (exact modulo 2**64) takes the place out
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * powers(len(w)), dtype=np.uint64)])
    return mix((total[size:] - total[:-size]) * powers(n, _INVERSE))


def text_key(text: bytes) -> bytes:
    """128-bit identity of a text; Spark's ``unhex(md5(text))`` gives the same."""
    return hashlib.md5(text, usedforsecurity=False).digest()


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def rows(batches: Iterator, *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(c).to_pylist() for c in columns))


def values(column, few: int = 256) -> Iterator:
    """Python values of an Arrow array, a few at a time."""
    for at in range(0, len(column), few):
        yield from column.slice(at, few).to_pylist()


def emit(schema, buffered: Iterator[tuple], max_rows: int = 2000, max_bytes: int = 8 << 20):
    """Arrow batches of ``schema`` from row tuples, bounded by rows and by the
    bytes of their binary and string values."""
    import pyarrow as pa

    out: list[tuple] = []
    held = 0

    def batch():
        columns = list(zip(*out)) if out else [[] for _ in schema]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in buffered:
        out.append(row)
        held += sum(len(v) for v in row if isinstance(v, (bytes, str, np.ndarray)))
        if len(out) >= max_rows or held >= max_bytes:
            yield batch()
            out, held = [], 0
    if out:
        yield batch()
    out, held = [], 0
    trim()


def process_cache(name: str, make):
    """An object that lives as long as its Python worker: tasks that run one
    after the other in a worker share it. Keep its size bounded. Only the last
    name's object is kept; tasks without one call :func:`release_caches`, so a
    worker that goes on with another operator gives the memory back."""
    import builtins

    caches = builtins.__dict__.setdefault("_cartwheel_caches", {})
    if name not in caches:
        caches.clear()
        caches[name] = make()
    return caches[name]


def release_caches() -> None:
    import builtins

    caches = builtins.__dict__.get("_cartwheel_caches")
    if caches:
        caches.clear()
        trim()


def trim() -> None:
    """Give freed memory back to the system: workers stay alive between tasks,
    and several of them share an executor's memory."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: it keeps its pages
        pass
