"""Registered queries of the operators, with their production parameters.

Each ``opN_...`` applies its operator to the whole table and returns the full
result; columns are digests of what the operator makes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark, sf_dir):
    from cartwheel.llm.packing import pack_documents
    return pack_documents(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark, sf_dir):
    from cartwheel.llm.pieces import encode_documents
    return encode_documents(_table(spark, sf_dir, "documents"))


def op3_license_scan(spark, sf_dir):
    from cartwheel.llm.licenses import scan
    return scan(_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark, sf_dir):
    from cartwheel.llm.jaccard import similarity_classes
    return similarity_classes(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: a conversation of control strings, formatted like the table's own
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op5_chat_format(spark, sf_dir):
    from cartwheel.llm.chat import build_forest, read_back
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return read_back(build_forest(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)))


def op6_language_id(spark, sf_dir):
    from cartwheel.llm import langid
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = langid.fit(docs.filter(~F.coalesce(held_out, F.lit(False))))
    out = docs.withColumn("p", langid.prediction_column(model))
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "p.lang_pred", "p.score", "p.accepted")


def op7_substring_dedup(spark, sf_dir):
    from cartwheel.llm.substring import digests
    return digests(_table(spark, sf_dir, "documents"))


#: (host, path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op8_url_filter(spark, sf_dir):
    from cartwheel.llm.urlfilter import RULES_SCHEMA, match_rules
    rules = spark.createDataFrame(URL_RULES, RULES_SCHEMA)
    return match_rules(_table(spark, sf_dir, "pages").select("page_id", "url"), rules) \
        .select("page_id", "host", "path", "rule", "verdict")


def op9_fingerprints(spark, sf_dir):
    from cartwheel.llm.fingerprint import fingerprints
    return fingerprints(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark, sf_dir):
    from cartwheel.llm import quality
    stats = quality.document_statistics(_table(spark, sf_dir, "documents"))
    model = quality.fit(stats, _table(spark, sf_dir, "labels"))
    return quality.judge(stats, model).select(
        "doc_id", *[F.col("f")[c].alias(c) for c in quality.COUNTS], "base_failed", "kept", "score")


def op11_top_k(spark, sf_dir):
    from cartwheel.llm.mtree import top_k
    return top_k(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op12_fill_in_middle(spark, sf_dir):
    from cartwheel.llm import fim
    return fim.digests(fim.transform(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_prefix_trie(spark, sf_dir):
    from cartwheel.llm.trie import prefix_trie
    return prefix_trie(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_license_scan": op3_license_scan,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_chat_format": op5_chat_format,
    "op6_language_id": op6_language_id,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_fingerprints": op9_fingerprints,
    "op10_quality_rules": op10_quality_rules,
    "op11_top_k": op11_top_k,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_prefix_trie": op13_prefix_trie,
}
