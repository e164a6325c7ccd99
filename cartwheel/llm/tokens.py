"""Token ids of whole texts with the word-level BPE vocabulary, in pieces.

The vocabulary lower-cases, drops white space and closes every word with an
end mark, so a text's ids are those of its words one after the other. That
makes a cache of words exact: each task splits texts at ASCII blanks and looks
the parts up; only parts not seen yet are tokenised. Texts with characters for
which splitting and lower-casing in Python might differ from the vocabulary's
normaliser (anything beyond Latin-1, odd control characters, special tokens)
go through the tokenizer as a whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.words import emit, process_cache, rows

# the vocabulary's own split, for lower-cased Latin-1 (fixed values)
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_ODD = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\xff]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class CachedTokenizer:
    """text -> packed little-endian uint32 ids; memory bounded by the limits:
    ``max_parts`` parts and words of at most ``max_length`` characters are known,
    ``max_words`` more have been met once. What is met once more becomes known,
    so the many that never come again do not push out the others."""

    def __init__(self, vocabulary: str, max_parts: int = 250_000, max_words: int = 150_000, max_length: int = 64):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # one cache for parts and the words in them: a part that is a word has the same ids
        self.known: dict[str, bytes] = {}
        self.once: set[str] = set()
        self.max_parts, self.max_words, self.max_length = max_parts, max_words, max_length
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]  # shared by all entries
        # byte-level alphabet: printable bytes stand for themselves, others move up
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        self.bytes_to_chars = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of a word of the vocabulary's split, which is not known yet."""
        ids = self.id_bytes
        chars = word.encode().decode("latin-1").translate(self.bytes_to_chars)
        return self.keep(word, b"".join([ids[t.id] for t in self.model.tokenize(chars)]))

    def keep(self, part: str, found: bytes) -> bytes:
        if part in self.once:
            if len(self.known) >= self.max_parts:
                self.known.clear()
            self.known[part] = found
            self.once.discard(part)
        elif len(part) <= self.max_length:
            if len(self.once) >= self.max_words:
                self.once.clear()
            self.once.add(part)
        return found

    def part(self, part: str) -> bytes:
        known = self.known.get
        found = known(part)
        if found is not None:  # met before in this text
            return found
        if part.isalpha():  # of Latin-1: one word
            return self.word(part)
        words = _SPLIT.findall(part)
        if len(words) == 1:
            return self.word(part)
        return self.keep(part, b"".join([known(w) or self.word(w) for w in words]))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD.search(text) or any(s in text for s in self.specials):
            return self.whole(text)
        parts = text.lower().split()
        out = list(map(self.known.get, parts))
        if None in out:
            out = [self.part(p) if v is None else v for v, p in zip(out, parts)]
        return b"".join(out)


_PIECES = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]


def piece_rows(docs: DataFrame, path: str | None, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every text."""
    schema = pa.schema(_PIECES + [("ids", pa.binary())] * with_ids)
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    # the vocabulary (a constant of a few MB) travels with the code: executors
    # need no such file
    with open(path or default_tokenizer(), encoding="utf-8") as f:
        vocabulary = f.read()
    name = f"tokenizer {zlib.crc32(vocabulary.encode())}"

    def of(batches):
        tok = process_cache(name, lambda: CachedTokenizer(vocabulary))
        close = int(end_id).to_bytes(4, "little")

        def out():
            for doc_id, text in rows(batches, "doc_id", "text"):
                ids = tok.encode(text or "") + close
                for k in range(0, len(ids) // 4, capacity):
                    part = ids[4 * k:4 * (k + capacity)]
                    yield (doc_id, k // capacity, k, len(part) // 4, zlib.crc32(part)) + ((part,) if with_ids else ())
        yield from emit(schema, out())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, ddl)
