"""Language ID by compression.

One raw-content zstandard dictionary per language is cut from a bounded sample
of its training texts. A text is encoded once per language, block by block (so
the dictionary matters all along a long text), and the language with the
smallest total wins. Near-equal totals mean that no dictionary fits: such
texts are marked as not accepted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.words import release_caches, trim, values

UNDETERMINED = "und"


@dataclass(frozen=True)
class LangParams:
    dictionary_bytes: int = 96 << 10  # per language, after normalising
    sample_docs: int = 400            # training texts per language that the driver gathers at most
    sample_chars: int = 2000          # of each, so that one long text does not fill a dictionary
    total_bytes: int = 6 << 20        # of all dictionaries: with more languages each is smaller
    block: int = 4096                 # bytes encoded at a time
    level: int = 9
    min_margin: float = 0.004         # accepted if the runner-up is this share larger


@dataclass(frozen=True)
class LangModel:
    dictionaries: dict[str, bytes]    # ordered: most frequent language first
    params: LangParams = field(default_factory=LangParams)


# ASCII that is no letter becomes a space; bytes of other characters stay
_LETTERS = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def normalise(text: str | None) -> bytes:
    """Lower-cased letters, one space between runs; empty if there is no letter."""
    if not text:
        return b""
    data = b" ".join(text.lower().encode().translate(_LETTERS).split())
    if data.isascii() or any(64 < b < 123 for b in data):
        return data
    return data if any(map(str.isalpha, text)) else b""


class Encoders:
    """Compressors of one task, built once per model."""

    def __init__(self, model: LangModel):
        p = model.params
        self.block, self.langs, self.zc = p.block, list(model.dictionaries), []
        for content in model.dictionaries.values():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=p.level)
            self.zc.append(zstandard.ZstdCompressor(level=p.level, dict_data=d, write_content_size=False,
                                                    write_checksum=False, write_dict_id=False))

    def sizes(self, data: bytes) -> list[int]:
        parts = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(z.compress(x)) for x in parts) for z in self.zc]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score (0 to 1), accepted."""
        data = normalise(text)
        if not data or not self.langs:
            return UNDETERMINED, 0.0, False
        sizes = self.sizes(data)
        ranked = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[ranked[0]]
        if len(ranked) == 1:
            return self.langs[0], 1.0, True
        second = sizes[ranked[1]]
        margin = (second - best) / second
        return self.langs[ranked[0]], min(1.0, margin), margin >= self._least

    _least = 0.0


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("accepted", T.BooleanType())])


def fit(training: DataFrame, params: LangParams = LangParams()) -> LangModel:
    """``training``: ``doc_id, text, lang``; rows with a null text or lang are
    skipped. What is gathered is bounded: ``sample_docs`` texts per language
    (those with the smallest hashes of id and text), ``sample_chars`` of each,
    from a place anywhere in the text that its hash decides. Every gathered text
    gives its share to the dictionary. Any number of languages will do: beyond
    ``total_bytes / dictionary_bytes`` of them, dictionaries and samples shrink.

    Counts and the label set cover all rows. Repeated rows and ties of hashes
    are interchangeable; extra columns are ignored. An empty table gives a model
    without languages, which answers ``und``."""
    rows = training.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           F.col("lang").cast("string").alias("lang")).dropna(subset=["text", "lang"])
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    if not counts:
        return LangModel({}, params)
    room = max(min(params.dictionary_bytes, params.total_bytes // len(counts)), 1)
    docs = max(params.sample_docs * room // params.dictionary_bytes, 1)
    # one more pass for all languages: rows whose hash lies in the lowest part
    # of the range, where about twice the sample is expected, then the lowest
    bounds = [(r["lang"], int(-2**63 + min(1.0, 2 * docs / r["n"]) * (2**64 - 2**11))) for r in counts]
    low = training.sparkSession.createDataFrame(bounds, "lang string, bound long")
    if sum(len(lang) + 8 for lang, _ in bounds) <= params.total_bytes:  # a row per language
        low = F.broadcast(low)
    spare = F.greatest(F.length("text") - params.sample_chars, F.lit(0)) + 1
    part = F.col("text").substr((F.pmod(F.xxhash64("h"), spare) + 1).cast("int"), F.lit(params.sample_chars))
    nearest = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    own = rows.withColumn("h", F.xxhash64("doc_id", "text")).join(low, "lang").filter("h <= bound") \
        .select("lang", "h", part.alias("text")) \
        .withColumn("k", nearest).filter(F.col("k") <= docs).orderBy("lang", F.desc("k")).collect()
    texts: dict[str, list[bytes]] = {}
    for r in own:
        texts.setdefault(r["lang"], []).append(normalise(r["text"]))
    dictionaries = {}
    for row in counts:  # zstandard prefers recent content: the first texts go last
        content = b" ".join(shares(texts.get(row["lang"], []), room))
        if content.strip():
            dictionaries[row["lang"]] = content
    return LangModel(dictionaries, params)


def shares(texts: list[bytes], room: int) -> list[bytes]:
    """Every text whole if short, else cut to one common length, so that all
    of them and a space between each fit into ``room`` bytes."""
    left, each = room - len(texts), 0
    for i, size in enumerate(sorted(map(len, texts))):
        each = max(left, 0) // (len(texts) - i)
        if size > each:
            break
        left, each = left - size, size
    return [t[:each] for t in texts]


def prediction_column(model: LangModel, text: str | Column = "text") -> Column:
    """Struct ``lang_pred, score, accepted`` of a string column, row by row.

    Null texts and texts without a letter are ``und``, score 0, not accepted; of
    equally small encodings the more frequent language wins, not accepted. Whole
    texts are encoded, ``block`` bytes at a time. Empty tables give no rows."""
    # a bounded broadcast: total_bytes
    @F.arrow_udf(PREDICTION)
    def of(texts: pa.Array) -> pa.Array:
        release_caches()
        enc = Encoders(model)
        enc._least = model.params.min_margin
        lang, score, accepted = zip(*(enc.predict(t) for t in values(texts))) if len(texts) else ((), (), ())
        out = pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                                         names=["lang_pred", "score", "accepted"])
        del enc
        trim()
        return out
    return of(F.col(text) if isinstance(text, str) else text)


def language_filter(docs: DataFrame, params: LangParams = LangParams()) -> DataFrame:
    """The rows of ``docs`` whose language is determined, with all columns.

    Learns from the rows that have a ``lang``; ``lang`` is no input of the
    prediction. Null texts, texts without a letter and narrow margins go. If no
    row has a language, nothing can be learned and nothing is rejected. Repeated
    rows are judged alike; extra columns pass whatever their names."""
    model = fit(docs, params)
    if not model.dictionaries:
        return docs
    temp = "__lang"
    while temp in docs.columns:
        temp += "_"
    out = docs.withColumn(temp, prediction_column(model, F.col("text").cast("string")))
    return out.filter(F.col(temp)["accepted"]).drop(temp)
