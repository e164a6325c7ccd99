"""Fill-in-the-middle transformation with a piece table.

A document is never rearranged in memory. It becomes a list of descriptors
``(buffer, start, end)`` over two immutable buffers: the text's bytes and the
sentinels. Cutting splits a descriptor, an arrangement permutes the descriptors
and puts the sentinels' between them, and a hash streams what they describe.
Restoring finds the sentinels in an output, which makes its descriptors, and
applies the inverse permutation.

Units are tokens: a run of ASCII white space with the run of other characters
behind it, or the white space at the text's end. Prefix and middle end at two
cuts drawn from the SHA-256 of ``seed:doc_id``, so the same document is cut
alike in every run and on every executor.

Forms: ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is
``<S>suffix<P>prefix<M>middle``, ``plain`` is the text itself. A text that
holds a sentinel stays plain, so an output's sentinels are the only ones in it
and reading back is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.words import emit, release_caches, rows

PLAIN, PSM, SPM = "plain", "psm", "spm"
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}  # arrangement of the three parts


@dataclass(frozen=True)
class FimParams:
    seed: int = 42
    percent: int = 50       # of the documents are rearranged
    spm_percent: int = 80   # of the rearranged ones, suffix first
    sentinels: tuple[str, str, str] = ("<P>", "<M>", "<S>")  # of prefix, middle and suffix

    def __post_init__(self):
        """A sentinel must not be able to arise where a part meets another one."""
        for i, a in enumerate(self.sentinels):
            for j, b in enumerate(self.sentinels):
                if not a or (i != j and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"sentinels must neither hold nor overlap each other: {self.sentinels}")


TEXT, SENTINEL = 0, 1
Piece = tuple[int, int, int]


@dataclass
class PieceTable:
    """``pieces`` are descriptors over ``buffers`` (text, sentinels)."""
    buffers: tuple[memoryview, memoryview]
    pieces: list[Piece]

    @classmethod
    def of(cls, text: bytes, sentinels: bytes = b"") -> "PieceTable":
        return cls((memoryview(text), memoryview(sentinels)), [(TEXT, 0, len(text))])

    def cut(self, at: Iterable[int]) -> None:
        """Split the descriptors at byte places of what the table describes
        (ascending); a cut at an edge or a repeated one leaves an empty piece."""
        for place in at:
            passed = 0
            for i in reversed(range(len(self.pieces))):
                passed = sum(e - s for _, s, e in self.pieces[:i])
                if passed <= place:
                    break
            buffer, start, end = self.pieces[i]
            middle = start + place - passed
            self.pieces[i:i + 1] = [(buffer, start, middle), (buffer, middle, end)]

    def arrange(self, order: Iterable[int], marks: Iterable[Piece] | None = None) -> "PieceTable":
        """The pieces in another order, each behind its mark."""
        out: list[Piece] = []
        marks = list(marks) if marks else None
        for i in order:
            out += ([marks[i]] if marks else []) + [self.pieces[i]]
        return PieceTable(self.buffers, out)

    def views(self) -> Iterator[memoryview]:
        return (self.buffers[b][s:e] for b, s, e in self.pieces)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.views():
            digest.update(view)
        return digest.hexdigest()

    def tobytes(self) -> bytes:
        return b"".join(self.views())


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(order.index(i) for i in range(len(order)))


_BLOCK = 1 << 20  # bytes looked at together: memory beside the text stays bounded
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True


def _token_ends(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(start, ends) of each block: byte places behind which a token ends."""
    data = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, len(data), _BLOCK):
        blank = _BLANK[data[at:at + _BLOCK + 1]]
        if at + _BLOCK >= len(data):  # the last block: the text's end ends a token, too
            ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
            yield at, np.append(ends, len(blank))
        else:
            yield at, np.flatnonzero(~blank[:-1] & blank[1:]) + 1


def count_tokens(text: bytes) -> int:
    return sum(len(ends) for _, ends in _token_ends(text))


def token_places(text: bytes, units: Iterable[int]) -> list[int]:
    """Byte places behind the first ``u`` tokens, for ascending ``u``."""
    want, out, passed = list(units), [], 0
    while want and want[0] == 0:
        out.append(want.pop(0))
    if want:
        for at, ends in _token_ends(text):
            while want and want[0] <= passed + len(ends):
                out.append(at + int(ends[want.pop(0) - passed - 1]))
            passed += len(ends)
            if not want:
                break
    return out


def characters(view) -> int:
    """Code points of UTF-8 bytes: all that are not continuation bytes."""
    data = np.frombuffer(view, dtype=np.uint8)
    return sum(int(np.count_nonzero((data[i:i + _BLOCK] & 0xC0) != 0x80)) for i in range(0, len(data), _BLOCK))


def draws(doc_id: int | None, p: FimParams) -> list[int]:
    """The first four 32-bit groups of the SHA-256 of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{p.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def _marks(p: FimParams) -> tuple[bytes, list[Piece]]:
    """The sentinel buffer, and each part's descriptor in it."""
    names = [s.encode() for s in p.sentinels]
    ends = np.cumsum([len(s) for s in names])
    return b"".join(names), [(SENTINEL, int(e) - len(s), int(e)) for s, e in zip(names, ends)]


def form_of(text: bytes, h: list[int], p: FimParams) -> str:
    if not text or any(s.encode() in text for s in p.sentinels) or h[2] % 100 >= p.percent:
        return PLAIN
    return SPM if h[3] % 100 < p.spm_percent else PSM


def transform_text(doc_id: int | None, text: bytes, p: FimParams) -> tuple[int, str, PieceTable, PieceTable]:
    """(tokens, form, the table cut in three or whole, the arranged table)."""
    h = draws(doc_id, p)
    n = count_tokens(text)
    form = form_of(text, h, p)
    sentinels, marks = _marks(p)
    table = PieceTable.of(text, sentinels)
    if form == PLAIN:
        return n, form, table, table
    table.cut(token_places(text, sorted((h[0] % (n + 1), h[1] % (n + 1)))))
    return n, form, table, table.arrange(ORDERS[form], marks)


def restore_text(output: bytes, form: str, p: FimParams) -> PieceTable:
    """The text's table, from an output and its form alone."""
    table = PieceTable.of(output)
    if form == PLAIN:
        return table
    order = ORDERS[form]
    parts: list[Piece] = []
    at = 0
    for k, mark in enumerate(p.sentinels[i].encode() for i in order):
        place = output.find(mark, at)
        if place < 0 or (k == 0 and place):
            raise ValueError(f"not an output of form {form}")
        if k:
            parts.append((TEXT, at, place))
        at = place + len(mark)
    return PieceTable(table.buffers, [*parts, (TEXT, at, len(output))]).arrange(inverse(order))


_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                  ("middle_chars", pa.int64()), ("output", pa.binary())])


def transform(docs: DataFrame, params: FimParams = FimParams()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of
    ``docs(doc_id, text)``; ``output`` is the rearranged text.

    Map only: nothing is shuffled. A null text counts as empty; an empty text
    has no token and stays plain. A null doc_id draws as the empty string, rows
    with one doc_id are drawn alike, repeated rows give repeated results, an
    empty table gives none and extra columns, whatever their names, are not
    read. A very long text is cut in blocks of 1 MB: beside the text and its
    output a task holds three descriptors. Both cuts may fall together or on an
    end of the text, which leaves empty parts."""
    p = params

    def of(batches):
        release_caches()

        def out():
            for doc_id, text in rows(batches, "doc_id", "text"):
                n, form, cut, arranged = transform_text(doc_id, text or b"", p)
                chars = (None, None) if form == PLAIN else tuple(characters(v) for v, _ in zip(cut.views(), (PREFIX, MIDDLE)))
                yield (doc_id, n, form, *chars, arranged.tobytes())
        yield from emit(_OUT, out())

    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    made = table.mapInArrow(of, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restore(made: DataFrame, params: FimParams = FimParams()) -> DataFrame:
    """``doc_id, text`` from the outputs and forms of :func:`transform` alone."""
    p = params

    def of(batches):
        yield from emit(pa.schema([("doc_id", pa.int64()), ("text", pa.binary())]),
                        ((doc_id, restore_text(output, form, p).tobytes()) for doc_id, form, output in rows(batches, "doc_id", "form", "output")))

    table = made.select("doc_id", "form", F.col("output").cast("binary").alias("output"))
    return table.mapInArrow(of, "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))


def digests(made: DataFrame, params: FimParams = FimParams()) -> DataFrame:
    """``made`` of :func:`transform` with ``output_sha256`` and
    ``restored_sha256`` instead of the output: the second one streams the
    descriptors that the output and its form give, so no text is built."""
    p = params
    keep = _OUT.names[:-1]
    schema = pa.schema([*list(_OUT)[:-1], ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

    def of(batches):
        def out():
            for *told, output in rows(batches, *keep, "output"):
                yield (*told, PieceTable.of(output).sha256(), restore_text(output, told[2], p).sha256())
        yield from emit(schema, out())

    table = made.select(*keep, F.col("output").cast("binary").alias("output"))
    return table.mapInArrow(of, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                "output_sha256 string, restored_sha256 string")
