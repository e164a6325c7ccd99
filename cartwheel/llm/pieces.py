"""SentencePiece encoding and decoding.

The vocabulary's pieces form an Aho-Corasick automaton. One pass over a text
follows it; at every position the automaton's output links list all pieces
that end there, and each relaxes the best score of that position (Viterbi). A
character that no piece covers costs ``unknown`` and becomes its UTF-8 bytes.

A space is written as U+2581, with one in front of the text, as the model's
normaliser does (identity otherwise). No piece has that mark behind another
character, and none has a character that stands alone in the vocabulary's
alphabet gaps (a line break, say): texts fall apart at such places into units
whose best segmentations are independent, so units are looked up before they
are segmented. A U+2581 of the text itself is encoded by bytes; so decoding
gives back every text exactly.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.words import emit, process_cache, rows

SPACE = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """``pieces``: (text, score, kind) by id; kind: ``normal`` or ``byte``,
    others never match."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.pieces = pieces
        self.byte_ids = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(pieces) if kind == "byte"}

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: ("byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "normal")
        return cls([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())])


class Codec:
    """Encoder and decoder of one task; the unit cache is bounded."""

    def __init__(self, vocabulary: Vocabulary, max_units: int = 400_000):
        import ahocorasick

        self.vocabulary = vocabulary
        normal = [(t, s, i) for i, (t, s, kind) in enumerate(vocabulary.pieces) if kind == "normal" and t]
        self.automaton = ahocorasick.Automaton()
        for text, score, i in normal:
            self.automaton.add_word(text, (len(text), score, i))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s, _ in normal), default=0.0) - 10.0
        inside = {c for t, _, _ in normal for c in t}
        if any(SPACE in t.lstrip(SPACE) for t, _, _ in normal):
            raise ValueError("a piece goes on behind a space: texts do not fall apart at spaces")
        self.breaks = "\n" not in inside
        self.line = self._bytes("\n")
        self.literal = self._bytes(SPACE)
        self.units: dict[str, bytes] = {}
        self.max_units = max_units
        self.out = [b"" if kind == "other" else bytes([int(t[3:5], 16)]) if kind == "byte" else t.replace(SPACE, " ").encode()
                    for t, _, kind in vocabulary.pieces]

    def _bytes(self, char: str) -> bytes:
        return b"".join(self.vocabulary.byte_ids[b].to_bytes(4, "little") for b in char.encode())

    def viterbi(self, unit: str) -> tuple[float, list[tuple[int, int]]]:
        """Best score of a unit and its segmentation as (end, id or -1)."""
        n = len(unit)
        best = [0.0] + [-np.inf] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        unknown, at = self.unknown, 1

        def settle(upto: int, at: int) -> int:
            while at < upto:  # all pieces that end at `at` are in: try the unknown character
                if best[at - 1] + unknown > best[at]:
                    best[at], back[at] = best[at - 1] + unknown, (at - 1, -1)
                at += 1
            return at

        if n:
            for end, (length, score, i) in self.automaton.iter(unit):
                if end + 1 > at:
                    at = settle(end + 1, at)
                start = end + 1 - length
                if best[start] + score > best[end + 1]:
                    best[end + 1], back[end + 1] = best[start] + score, (start, i)
            settle(n + 1, at)
        steps, at = [], n
        while at:
            start, i = back[at]
            steps.append((at, i))
            at = start
        return best[n], steps[::-1]

    def unit(self, unit: str) -> bytes:
        if len(self.units) >= self.max_units:
            self.units.clear()
        found = b"".join(i.to_bytes(4, "little") if i >= 0 else self._bytes(unit[end - 1])
                         for end, i in self.viterbi(unit)[1])
        self.units[unit] = found
        return found

    def _line(self, text: str, first: bool) -> list[bytes]:
        """Ids of the units of a line; ``first``: the dummy prefix stands before it."""
        if "  " in text or text.endswith(" ") or text.startswith(" "):
            units = re.findall(" *[^ ]+| +", " " + text if first else text)
            units = [u.replace(" ", SPACE) for u in units]
        else:
            parts = text.split(" ")
            units = [SPACE + p for p in parts]
            if not first:
                units[0] = parts[0]
        known = self.units
        return [known.get(u) or self.unit(u) for u in units]

    def encode(self, text: str) -> bytes:
        """Packed little-endian uint32 ids."""
        if not text:
            return b""
        if SPACE in text:  # its own: cut it out, bytes in its place
            out = []
            for k, part in enumerate(text.split(SPACE)):
                if k:
                    out.append(self.literal)
                if part or not k:
                    out.append(self._lines(part, not k))
            return b"".join(out)
        return self._lines(text, True)

    def _lines(self, text: str, first: bool) -> bytes:
        if not self.breaks:
            return b"".join(self._line(text, first))
        out = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self.line)
            if line or (first and not k):
                out.extend(self._line(line, first and not k))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        out = self.out
        text = b"".join([out[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode()
        return text[1:] if ids else text


def encode_documents(docs: DataFrame, model: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_chars, n_pieces, ids_crc32,
    decoded_sha256`` (and ``ids``, packed unsigned 32-bit, on request).

    ``decoded_sha256`` is the digest of the text that decoding the ids gives
    back. Null texts count as empty and have no pieces. Repeated rows and null
    ids are harmless, extra columns ignored; an empty table gives an empty
    result. No shuffle; the vocabulary (a constant) travels with the code."""
    pieces = Vocabulary.load(model or default_model()).pieces
    name = f"pieces {zlib.crc32(repr(pieces).encode())}"
    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()),
              ("decoded_sha256", pa.string())] + [("ids", pa.binary())] * with_ids
    ddl = "doc_id long, n_chars long, n_pieces long, ids_crc32 long, decoded_sha256 string" + ", ids binary" * with_ids

    def of(batches):
        codec = process_cache(name, lambda: Codec(Vocabulary(pieces)))

        def out():
            for doc_id, text in rows(batches, "doc_id", "text"):
                text = text or ""
                ids = codec.encode(text)
                back = codec.decode(ids)
                yield (doc_id, len(text), len(ids) // 4, zlib.crc32(ids), hashlib.sha256(back.encode()).hexdigest()) \
                    + ((ids,) if with_ids else ())
        yield from emit(pa.schema(fields), out())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, ddl)
