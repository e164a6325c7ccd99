"""URL filters in DataFrame operations only.

A rule names a host (which covers its subdomains) and a path prefix. Every URL
is expanded into the expressions that could be rules about it: each suffix of
its host at a dot that has as many labels as some rule's host, with each prefix
of its path that is as long as some rule's path. Expressions and rules meet in an equi-join on a short (32-bit) hash
prefix; the full SHA-256 digests then confirm, and of the rules that fit the
longest decides.

Expressions are made once per distinct host and path prefix, so a host that
holds a third of all URLs costs a few keys. The decisions are written out
before the URLs join them: both sides of that join are plain scans, which lets
the adaptive planner split a hot host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.plans.sink import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES_SCHEMA = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                             T.StructField("verdict", T.StringType())])


@dataclass(frozen=True)
class UrlParams:
    default: str = "allow"    # verdict where no rule fits
    hash_chars: int = 8       # hexadecimal digits of the hash prefix (32 bits)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end;
    A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # a host holds no slash and a rule's path starts anywhere: the separator
    # keeps the pair apart
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _n_labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def _host_suffixes(host: Column, counts: Column) -> Column:
    """What the host ends in, of each number of labels in ``counts`` that it has."""
    return F.transform(F.filter(counts, lambda k: k <= _n_labels(host)),
                       lambda k: F.call_function("substring_index", host, F.lit("."), -k))


def match_rules(urls: DataFrame, rules: DataFrame, params: UrlParams = UrlParams(), url: str = "url") -> DataFrame:
    """``urls`` with ``host, path, rule, verdict`` added (``rule``: host and
    path of the rule that decides, null if none).

    The rule with the longest host and path together wins; of equally long
    ones the longer host, then ``block`` before other verdicts. Rules with a
    null or empty host or a null path are ignored, repeated rules count once
    (``block`` wins); a rule with an empty path fits every path. Null URLs and
    URLs without ``://`` have empty host and path, and no rule fits an empty
    host. A host of any length costs one expression per number of labels that
    rules have. Repeated rows stay; columns that clash with the added ones are
    replaced. Empty tables give empty results, no rules the default verdict."""
    p = params
    clean = rules.select(*[F.col(c).cast("string").alias(c) for c in ("host", "path", "verdict")]) \
        .dropna(subset=["host", "path"]).filter("host <> ''").groupBy("host", "path") \
        .agg(F.min(F.struct(F.coalesce(F.col("verdict") != "block", F.lit(True)).alias("o"), F.col("verdict").alias("verdict"))).alias("v")) \
        .select("host", "path", F.col("v.verdict").alias("verdict"))
    clean = clean.withColumn("digest", _digest(F.col("host"), F.col("path"))) \
                 .withColumn("short", F.substring("digest", 1, p.hash_chars))
    # the lengths that rule paths have and the numbers of labels of rule hosts:
    # bounded by the longest rule, whatever the URLs
    sizes = clean.agg(F.collect_set(F.length("path")).alias("lengths"), F.collect_set(_n_labels(F.col("host"))).alias("labels")).first()
    lengths, labels = sorted(sizes["lengths"]), sorted(sizes["labels"])

    out = urls.withColumn("__host", host_of(F.col(url).cast("string"))).withColumn("__path", path_of(F.col(url).cast("string")))
    out = out.drop("host", "path", "rule", "verdict") \
             .withColumn("__prefix", F.substring("__path", 1, max(lengths, default=0)))
    cuts, counts = (F.array(*[F.lit(n) for n in of]).cast("array<int>") for of in (lengths, labels))
    grown = out.select("__host", "__prefix").filter("__host <> ''").distinct() \
               .withColumn("suffix", F.explode(_host_suffixes(F.col("__host"), counts))) \
               .withColumn("n", F.explode(F.filter(cuts, lambda n: n <= F.length("__prefix")))) \
               .withColumn("digest", _digest(F.col("suffix"), F.col("__prefix").substr(F.lit(1), F.col("n")))) \
               .withColumn("short", F.substring("digest", 1, p.hash_chars))
    e, r = grown.alias("e"), clean.alias("r")
    fits = e.join(r, F.col("e.short") == F.col("r.short")).filter(F.col("e.digest") == F.col("r.digest"))
    rank = F.struct((F.length("r.host") + F.length("r.path")).alias("l"), F.length("r.host").alias("h"),
                    (F.col("r.verdict") == "block").alias("b"), F.concat("r.host", "r.path").alias("rule"),
                    F.col("r.verdict").alias("verdict"))
    best, _ = materialize(fits.groupBy("__host", "__prefix").agg(F.max(rank).alias("__best")), "url-best")
    return out.join(best, ["__host", "__prefix"], "left") \
              .withColumn("host", F.col("__host")).withColumn("path", F.col("__path")) \
              .withColumn("rule", F.col("__best.rule")) \
              .withColumn("verdict", F.coalesce("__best.verdict", F.lit(p.default))) \
              .drop("__host", "__path", "__prefix", "__best")
