"""Prefix trie of conversations by whole-sequence collapse.

Every distinct sequence of first turns is a node of a trie. The trie is never
walked or gathered:

1. conversations are rebuilt from their base's first turns and their own rest,
   as rows of 16-byte turn identities and word counts (texts are not shuffled);
2. a distributed running pass (:mod:`cartwheel.llm.scan`) names every prefix;
3. *collapse*: conversations with one last prefix are one weighted sequence,
   called by its smallest conversation, with the list of the conversations that
   end there; only that one's rows go on;
4. *leaves*: an anti-join drops the sequences that are proper prefixes of others;
5. *weighted prefixes*: the prefixes of all sequences are summed up by node.

A subtree's sum needs every node once, though many sequences pass it. A node
belongs to the smallest conversation through it; a sequence's own nodes are
then the last ones of its path, so their words are the sequence's words less
those before its first own node, and a subtree holds all own nodes of the
sequences through its top (of the top's owner: those from the top on).

All sums combine map side, so a first turn or a whole conversation that a third
of the rows share is one partial row per task. End lists are hashed from packed
parts of a global sort, so only text of digits, not rows, meets in one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.scan import EMPTY, running
from cartwheel.llm.words import emit, release_caches, rows
from cartwheel.plans.sink import materialize, remove_path


@dataclass(frozen=True)
class TrieParams:
    family: int = 20       # conversations c with one c - c % family share a base
    shared_turns: int = 4  # a conversation takes crc32(c) % shared_turns turns from it
    part_bytes: int = 1 << 18  # of an end list that are packed together


def _items(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, item, words``: identity and words of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("item"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")).filter("conv_id is not null")


def _placed(items: DataFrame) -> tuple[DataFrame, str]:
    """``conv_id, place, item, words``: a turn's place (from 0) in its own conversation."""
    placed, path = running(items, ["turn", "item"], "trie-placed")
    return placed.select("conv_id", (F.col("depth") - 1).alias("place"), "item", "words"), path


def rebuild(placed: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """``conv_id, part, place, item, words``: the turns that a conversation has
    from its base (part 0; at most ``shared_turns - 1`` rows) and its own ones
    behind as many (part 1)."""
    p = params
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % p.shared_turns
    heads = placed.filter((F.col("place") < p.shared_turns - 1) & (F.col("conv_id") % p.family == 0)) \
                  .withColumnRenamed("conv_id", "base")
    ids = placed.select("conv_id").distinct().withColumn("taken", taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % p.family)
    shared = ids.join(heads, "base").filter("place < taken")
    own = placed.filter(F.col("place") >= taken)
    return shared.select("conv_id", F.lit(0).alias("part"), "place", "item", "words").unionByName(
        own.select("conv_id", F.lit(1).alias("part"), "place", "item", "words"))


def _end_digests(ends: DataFrame, p: TrieParams) -> DataFrame:
    """``depth, node, ends_sha256`` of the nodes where conversations end: the
    decimal ids, ascending, joined by commas. A global sort packs them into
    parts; a node's parts meet in one task that holds one of them, because
    SHA-256 is sequential by nature."""
    n = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    part = pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())])
    limit = p.part_bytes

    def pack(batches):
        release_caches()

        def out():
            for (depth, node), group in groupby(rows(batches, "depth", "node", "conv_id"), itemgetter(0, 1)):
                held, size, first = [], 0, None
                for _, _, conv in group:
                    first = conv if first is None else first
                    held.append(b"%d" % conv)
                    size += len(held[-1]) + 1
                    if size >= limit:
                        yield (depth, node, first, b",".join(held))
                        held, size, first = [], 0, None
                if held:
                    yield (depth, node, first, b",".join(held))
        yield from emit(part, out())

    def digest(batches):
        def out():
            for (depth, node), group in groupby(rows(batches, "depth", "node", "ids"), itemgetter(0, 1)):
                told, between = hashlib.sha256(), b""
                for _, _, ids in group:
                    told.update(between)
                    told.update(ids)
                    between = b","
                yield (depth, node, told.hexdigest())
        yield from emit(pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("ends_sha256", pa.string())]), out())

    by = ["depth", "node", "conv_id"]
    packed = ends.select(*by).repartitionByRange(n, *by).sortWithinPartitions(*by) \
                 .mapInArrow(pack, "depth long, node binary, first long, ids binary")
    return packed.repartition(n, "depth", "node").sortWithinPartitions("depth", "node", "first") \
                 .mapInArrow(digest, "depth long, node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """Nodes of the trie over the rebuilt ``conversations(conv_id, turn, role,
    text)``: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``.

    Turns are ordered by turn (null first), equal turns by the MD5 of role and
    text; repeated rows are turns of their own. Null roles and texts count as
    empty. Rows with a null conv_id belong to no conversation. A conversation
    that is left without turns ends at the root. An empty table has no node,
    not even the root. Extra columns are not read. A text is only hashed and
    its words counted, in the JVM and before any shuffle, so very long ones
    cost no more than reading them. Written once; the tables on the way are
    removed."""
    p, used = params, []

    def stored(df: DataFrame, name: str) -> DataFrame:
        df, path = materialize(df, f"trie-{name}")
        used.append(path)
        return df

    placed, path = _placed(_items(conversations))
    used.append(path)
    steps, path = running(rebuild(placed, p), ["part", "place"], "trie-steps")
    used.append(path)

    # collapse: the last prefix of every conversation, turnless ones included
    root = [F.lit(0).cast("long").alias("depth"), F.lit(EMPTY).alias("node"), F.lit(0).cast("long").alias("cum")]
    ends = placed.select("conv_id", *root).unionByName(steps.select("conv_id", "depth", "node", "cum")) \
                 .groupBy("conv_id").agg(F.max(F.struct("depth", "node", "cum")).alias("e")).select("conv_id", "e.*")
    ends = stored(ends, "ends")
    sequences = stored(ends.groupBy("depth", "node").agg(
        F.min("conv_id").alias("sequence"), F.count("*").alias("weight"), F.max("cum").alias("total")), "sequences")

    # the prefixes of the sequences, the root's among them
    named = sequences.select("sequence", "weight", "total")
    prefixes = steps.drop("item").withColumnRenamed("conv_id", "sequence").join(named, "sequence").unionByName(
        named.select("*", *root, F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("words")))
    prefixes = stored(prefixes, "prefixes")
    nodes = stored(prefixes.groupBy("depth", "node", "parent").agg(
        F.min("sequence").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"), F.max("cum").alias("cum"),
        F.sum(F.col("weight") * F.col("total")).alias("passing"), F.min_by("total", "sequence").alias("total")), "nodes")
    children = stored(nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node"))
                      .agg(F.count("*").alias("n_children")), "children")

    # words of the nodes that a sequence owns, and whether it is a leaf
    leaves = sequences.join(children, ["depth", "node"], "left_anti").select("sequence", F.lit(1).alias("leaf"))
    before = nodes.groupBy(F.col("conv_id").alias("sequence")).agg(F.min(F.col("cum") - F.col("words")).alias("before"))
    told = named.join(before, "sequence", "left").join(leaves, "sequence", "left").select(
        "sequence", F.coalesce(F.col("total") - F.col("before"), F.lit(0)).alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    told = stored(told, "told")
    summed = stored(prefixes.select("depth", "node", "sequence").join(told, "sequence").groupBy("depth", "node").agg(
        F.sum("own").alias("own"), F.min_by("own", "sequence").alias("first_own"), F.sum("leaf").alias("n_leaves")), "summed")

    digests = stored(_end_digests(ends, p), "digests")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    said = F.col("passing") - F.col("n_convs") * (F.col("cum") - F.col("words"))   # words of all members, from the node on
    distinct = F.col("total") - F.col("cum") + F.col("words") + F.col("own") - F.col("first_own")  # of the subtree's nodes
    trie = nodes.join(summed, ["depth", "node"]).join(children, ["depth", "node"], "left").join(digests, ["depth", "node"], "left") \
                .join(parents, ["depth", "parent"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        (said - distinct).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    trie, _ = materialize(trie, "trie")
    for path in used:
        remove_path(trie.sparkSession, path)
    return trie
