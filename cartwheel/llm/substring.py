"""Substring deduplication by seed and extend.

Removes every word that lies in a window of ``window`` words whose word
sequence also starts anywhere else, in another document or the same one.

1. *Seeds.* Each text is winnowed: of every ``window - anchor + 1`` consecutive
   anchors (k-word windows) the one with the smallest hash is kept, the
   rightmost of equals. Two equal windows of ``window`` words hold the same
   anchors, so they keep the same one at the same place: no repeat is missed.
   About 7 % of the positions are kept.
2. *Join* on anchors: :func:`cartwheel.llm.repeats.repeated_hashes` finds the
   anchors that occur in another text; repeats within a text are found there.
3. *Extend.* Around each such anchor all windows that hold it are its possible
   extensions to the left and right. A window occurs elsewhere exactly if its
   own hash does, which the same join decides; so an anchor of m places costs m
   rows, not m * m pairs. Windows are told apart by 64 bits on top of the
   64-bit anchor filter.
4. *Maximal repeats* are the unions of overlapping repeated windows. They are
   removed from the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.repeats import repeated_hashes
from cartwheel.llm.tables import materialize, passing
from cartwheel.llm.words import WordHashes, emit, rows, sha256_hex, trim, window_hashes


@dataclass(frozen=True)
class SubstringParams:
    window: int = 35   # words of a repeat, at least
    anchor: int = 8    # words of a seed


def winnow(h: np.ndarray, span: int) -> np.ndarray:
    """Positions of the rightmost smallest hash of every ``span`` consecutive ones."""
    n = len(h)
    if n < span or n == 0:
        return np.empty(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(h[::-1], span)
    chosen = [views[i:i + 65536].argmin(axis=1) + np.arange(i, min(i + 65536, len(views)))
              for i in range(0, len(views), 65536)]
    return np.unique(n - 1 - np.concatenate(chosen))


def _again(h: np.ndarray) -> np.ndarray:
    """Mask of the values that occur twice or more in ``h``."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    mask = np.zeros(len(h), dtype=bool)
    mask[order[1:][same]] = True
    mask[order[:-1][same]] = True
    return mask


def _unpack(packed: bytes | None) -> np.ndarray:
    return np.frombuffer(packed or b"", dtype="<u8")


def _union(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask over n places of the union of [start, start + width)."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.clip(starts, 0, n), 1)
    np.add.at(edge, np.clip(starts + width, 0, n), -1)
    return np.cumsum(edge[:-1]) > 0


def candidate_windows(w: np.ndarray, anchors: np.ndarray, p: SubstringParams) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows that hold a repeated anchor."""
    seeds = window_hashes(w, p.anchor)
    picked = winnow(seeds, p.window - p.anchor + 1)
    h = seeds[picked]
    places = picked[np.isin(h, anchors) | _again(h)]
    last = len(w) - p.window
    mask = _union(places - (p.window - p.anchor), p.window - p.anchor + 1, max(last + 1, 0)) if len(places) else None
    if mask is None or last < 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    starts = np.flatnonzero(mask)
    return starts, window_hashes(w, p.window)[starts]


def removal_mask(w: np.ndarray, anchors: np.ndarray, windows: np.ndarray, p: SubstringParams) -> np.ndarray:
    """Mask of the words to remove."""
    starts, h = candidate_windows(w, anchors, p)
    hit = starts[np.isin(h, windows) | _again(h)] if len(starts) else starts
    return _union(hit, p.window, len(w))


def spans(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal repeats as (first word, number of words)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


_MARKS = ("key", "anchors", "windows", "copies")


def _fresh(columns: list[str]) -> dict[str, str]:
    """Names for the marks that no input column has."""
    prefix = "__"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return {m: prefix + m for m in _MARKS}


def _keyed(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Adds the text's 128-bit identity (JVM side; null text as empty)."""
    return docs.withColumn(name, F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))))


def repeats(docs: DataFrame, p: SubstringParams = SubstringParams()) -> DataFrame:
    """``key, anchors, windows, copies`` of the texts that hold repeats.

    ``anchors`` and ``windows``: packed hashes that occur in another text;
    ``copies``: whether the whole text occurs in more than one row. Texts that
    only repeat themselves appear too. Written once."""
    keyed = _keyed(docs.select("text"), "key").select("key", F.col("text").cast("string").cast("binary").alias("text"))

    def seeds(batches):
        def out():
            hashes = WordHashes()
            for key, text in rows(batches, "key", "text"):
                words = (text or b"").split()
                if len(words) < p.window:
                    continue
                s = window_hashes(hashes.of(words), p.anchor)
                h = s[winnow(s, p.window - p.anchor + 1)]
                own = np.unique(h)
                yield (key, own.tobytes(), len(own) < len(h))
        yield from emit(pa.schema([("key", pa.binary()), ("hashes", pa.binary()), ("inner", pa.bool_())]), out())

    with passing(docs.sparkSession) as keep:
        seeded, _ = materialize(keyed.mapInArrow(seeds, "key binary, hashes binary, inner boolean"), "substring-seeds")
        again = repeated_hashes(seeded).withColumnRenamed("hashes", "anchors")
        per_text = seeded.groupBy("key").agg((F.count("*") > 1).alias("copies"), F.max("inner").alias("inner"))
        hot = per_text.join(again, "key", "left").filter("copies or inner or anchors is not null")
        hot, _ = materialize(hot, "substring-anchors")

        # one row of each text is enough to extend: copies are settled already
        own = keyed.join(hot.select("key", "anchors"), "key")

        def extend(batches):
            def out():
                hashes = WordHashes()
                for key, text, anchors in rows(batches, "key", "text", "anchors"):
                    _, h = candidate_windows(hashes.of((text or b"").split()), _unpack(anchors), p)
                    if len(h):
                        yield (key, np.unique(h).tobytes())
            yield from emit(pa.schema([("key", pa.binary()), ("hashes", pa.binary())]), out())

        windows = repeated_hashes(own.mapInArrow(extend, "key binary, hashes binary")).withColumnRenamed("hashes", "windows")
        found, path = materialize(hot.join(windows, "key", "left").select("key", "anchors", "windows", "copies"), "substring-found")
        keep(path)
    return found


def marked(docs: DataFrame, params: SubstringParams = SubstringParams()) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the marks of :func:`repeats`, and the marks' column names."""
    names = _fresh(docs.columns)
    found = repeats(docs, params)
    found = found.select(*[F.col(m).alias(names[m]) for m in _MARKS])
    return _keyed(docs, names["key"]).join(found, names["key"], "left"), names


def cut(words: list[bytes], hashes: WordHashes, anchors, windows, copies, p: SubstringParams) -> np.ndarray:
    """Mask of the words to remove from one text."""
    n = len(words)
    if n < p.window or anchors is None and windows is None and copies is None:
        return np.zeros(n, dtype=bool)
    if copies:
        return np.ones(n, dtype=bool)  # every window starts in the copy, too
    return removal_mask(hashes.of(words), _unpack(anchors), _unpack(windows), p)


def digests(docs: DataFrame, params: SubstringParams = SubstringParams()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``.

    Null and empty texts have no words (the hash is that of no bytes). Rows
    with equal texts of at least ``window`` words are each other's repeats, so
    nothing of them stays. Extra columns and null ids are harmless."""
    p = params
    d, names = marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), p)
    d = d.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"), *[F.col(names[m]).alias(m) for m in _MARKS[1:]])

    def of(batches):
        def out():
            hashes = WordHashes()
            for doc_id, text, anchors, windows, copies in rows(batches, "doc_id", "text", *_MARKS[1:]):
                words = (text or b"").split()
                mask = cut(words, hashes, anchors, windows, copies, p)
                removed = int(mask.sum())
                kept = [w for w, m in zip(words, mask) if not m] if removed else words
                yield (doc_id, len(words), removed, sha256_hex(b" ".join(kept)))
        yield from emit(pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                                   ("kept_sha256", pa.string())]), out())

    return d.mapInArrow(of, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, params: SubstringParams = SubstringParams()) -> DataFrame:
    """``docs`` with every repeat taken out of ``text`` (and ``n_chars`` set to
    its new length, where that column exists). Texts without repeats stay as
    they are, byte for byte; where something goes, the kept words are joined by
    one space. No row goes: a text that is all repeats becomes empty, a null one
    stays null. All other columns, whatever their names, pass unchanged. Rows
    are worked on a few at a time, and a batch without repeats is handed on as
    it came."""
    p, columns = params, docs.columns
    d, names = marked(docs, p)
    d = d.withColumn("text", F.col("text").cast("string")).select(*columns, *[names[m] for m in _MARKS[1:]])
    at, marks = columns.index("text"), [names[m] for m in _MARKS[1:]]

    def of(batches):
        hashes = WordHashes()

        def kept(text, anchors, windows, copies):
            if text is None or copies is None:
                return text
            words = text.encode().split()
            mask = cut(words, hashes, anchors, windows, copies, p)
            return b" ".join([w for w, m in zip(words, mask) if not m]).decode() if mask.any() else text

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                told = part.column(marks[2]).is_valid()
                own = [part.column(c) for c in columns]
                if told.true_count:
                    own[at] = pa.array([kept(*row) for row in zip(*(part.column(c).to_pylist() for c in ("text", *marks)))], own[at].type)
                yield pa.RecordBatch.from_arrays([*own, told], names=[*columns, marks[2]])
        del hashes
        trim()

    schema = T.StructType([*d.select(*columns).schema.fields, T.StructField(marks[2], T.BooleanType())])
    out = d.mapInArrow(of, schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(marks[2]), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*columns)
