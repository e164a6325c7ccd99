"""Exact n-gram Jaccard join by T-occurrence search.

Two documents link when the Jaccard similarity of their shingle sets reaches
the threshold. A set of n shingles needs at least T = ceil(t * n) of them in
common with any partner, so partners are exactly the sets that occur at least
T times in the inverted lists of its shingles. The search has these steps, all
on Spark tables:

1. *Shingle rows.* Each text becomes a set of 64-bit shingle hashes, its
   128-bit signature (equal sets collapse) and the ``n - T + k`` smallest
   hashes. Any two linked sets share at least ``min(k, k')`` of these, so
2. *occurrence filter*: only sets with enough of them in some other set can
   have a link (:mod:`cartwheel.llm.repeats`). The few that remain are reduced
   once more on their whole sets: T shingles must occur elsewhere.
3. *Pivots.* Remaining sets are checked against the smallest set that shares a
   min-hash with them. Verified links form components, so groups of thousands
   of near copies collapse without comparing all their pairs.
4. *Search blocks.* Sets whose rarest ``n - T + 1`` shared shingles meet are in
   one cluster. Each cluster is cut into blocks of bounded size and only block
   pairs that touch different components are searched: DivideSkip
   (:func:`divide_skip`) merges the short lists and binary-probes the long
   ones. Links between components finish the classes.

Nothing is capped or sampled: blocks bound memory, pivots and components only
skip pairs whose link cannot change a class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.graph import connected_components
from cartwheel.llm.repeats import repeated_hashes
from cartwheel.llm.tables import materialize, passing
from cartwheel.llm.words import WordHashes, emit, mix, powers, rows, text_key, window_hashes


@dataclass(frozen=True)
class JaccardParams:
    words: int = 5               # words of a shingle
    percent: int = 80            # link when 100 * intersection >= percent * union
    pivot_hashes: int = 3        # min-hashes that pick pivots
    block_shingles: int = 300_000  # bound of a search block (memory)

    def needed(self, n):
        """T: overlap that a set of n shingles needs with any partner."""
        return -(-self.percent * n // 100)

    def prefix_overlap(self, n):
        """k: how much longer the hash prefix is than the shortest exact one."""
        return n // 10 + 1


def shingles(words: list[bytes], hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle."""
    w = hashes.of(words)
    if len(w) >= size:
        return np.unique(window_hashes(w, size))
    if not len(w):
        return np.empty(0, dtype=np.uint64)
    return mix((w * powers(len(w))).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w)))


_ROWS_DDL = "doc_id long, tkey binary, n_shingles long, sig binary, prefix binary"
_ROWS = pa.schema([("doc_id", pa.int64()), ("tkey", pa.binary()), ("n_shingles", pa.int64()),
                   ("sig", pa.binary()), ("prefix", pa.binary())])


def _bytes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))


def shingle_rows(docs: DataFrame, p: JaccardParams) -> DataFrame:
    def of(batches):
        def out():
            hashes = WordHashes()
            for doc_id, text in rows(batches, "doc_id", "text"):
                text = text or b""
                s = shingles(text.lower().split(), hashes, p.words)
                n = len(s)
                if not n:
                    yield (doc_id, text_key(text), 0, None, None)
                    continue
                keep = n - p.needed(n) + p.prefix_overlap(n)
                yield (doc_id, text_key(text), n, xxhash.xxh3_128_digest(s.tobytes()), s[:keep].tobytes())
        yield from emit(_ROWS, out())
    return _bytes(docs).mapInArrow(of, _ROWS_DDL)


def shingle_sets(docs: DataFrame, p: JaccardParams) -> DataFrame:
    """``sig, n, sh`` (packed whole set) of every non-empty text."""
    def of(batches):
        def out():
            hashes = WordHashes()
            for (text,) in rows(batches, "text"):
                s = shingles((text or b"").lower().split(), hashes, p.words)
                if len(s):
                    yield (xxhash.xxh3_128_digest(s.tobytes()), len(s), s.tobytes())
        yield from emit(pa.schema([("sig", pa.binary()), ("n", pa.int64()), ("sh", pa.binary())]), out())
    return _bytes(docs).mapInArrow(of, "sig binary, n long, sh binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def divide_skip(index: list[np.ndarray], queries: list[np.ndarray], p: JaccardParams):
    """T-occurrence search: yields (query, index) pairs that link.

    The index holds an inverted list per shingle. Of a query's lists the
    longest ``L`` are set aside (L < T): a partner must then occur at least
    T - L times in the others, which are merged (counted in one sort). The
    survivors are looked up in the long lists by binary probes and kept if
    they reach the overlap that the pair's sizes ask for."""
    if not index or not queries:
        return
    sizes = np.array([len(s) for s in index])
    key = np.concatenate(index)
    doc = np.repeat(np.arange(len(index), dtype=np.int64), sizes)
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    vocab, start = np.unique(key, return_index=True)
    end = np.append(start[1:], len(key))
    for q, s in enumerate(queries):
        n = len(s)
        need = int(p.needed(n))
        at = np.searchsorted(vocab, s)
        at[at == len(vocab)] = 0
        at = at[vocab[at] == s]
        if len(at) < need:
            continue
        length = end[at] - start[at]
        by = np.argsort(length, kind="stable")
        at, length = at[by], length[by]
        # set aside the longest lists, as far as that makes the merge shorter
        long_lists = min(need - 1, int((length > 16).sum()))
        short = at[:len(at) - long_lists]
        merged = np.concatenate([doc[start[i]:end[i]] for i in short]) if len(short) else np.empty(0, np.int64)
        cand, count = np.unique(merged, return_counts=True)
        ok = (count >= need - long_lists) & (100 * np.minimum(sizes[cand], n) >= p.percent * np.maximum(sizes[cand], n))
        cand, count = cand[ok], count[ok]
        left = long_lists
        for i in at[len(at) - long_lists:]:
            if not len(cand):
                break
            members = doc[start[i]:end[i]]
            pos = np.searchsorted(members, cand)
            pos[pos == len(members)] = 0
            count = count + (members[pos] == cand)
            left -= 1
            keep = count + left >= need
            cand, count = cand[keep], count[keep]
        hit = 100 * count >= p.percent * (n + sizes[cand] - count)
        for c in cand[hit]:
            yield q, int(c)


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u8")


def _candidates(docs: DataFrame, table: DataFrame, p: JaccardParams) -> DataFrame:
    """``vid, sig, n, sh, common, shared``: sets that can have a link, with the
    shingles that others have, too (steps 1 and 2)."""
    found = repeated_hashes(table.select(F.col("sig").alias("key"), F.col("prefix").alias("hashes")).filter("key is not null"))
    hits = found.select("key", F.shiftright(F.length("hashes"), 3).alias("hits"))
    sets = table.filter("sig is not null").groupBy("sig").agg(
        F.min(F.struct("doc_id", "tkey")).alias("one"), F.first("n_shingles").alias("n"))
    n = F.col("n")
    least = F.floor((p.percent * n + 99) / 100)
    # k is monotone: a partner of a set of n has at least T(n) shingles
    few = sets.join(hits, sets["sig"] == hits["key"]).filter(F.col("hits") >= F.floor(least / 10) + 1) \
              .select("sig", F.col("one.doc_id").alias("doc_id"))
    few, _ = materialize(few, "jaccard-few")
    # their texts once more; equal ids with other texts fall out by signature
    ids = few.select("doc_id").distinct()
    has_null = few.filter("doc_id is null").head(1)
    own = docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["doc_id"]) if has_null
                    else docs["doc_id"].cast("long") == ids["doc_id"], "left_semi")
    whole = shingle_sets(own, p).dropDuplicates(["sig"]).join(few.select("sig"), "sig", "left_semi")
    whole, _ = materialize(whole.withColumn("vid", F.monotonically_increasing_id()), "jaccard-sets")
    common = repeated_hashes(whole.select(F.col("sig").alias("key"), F.col("sh").alias("hashes")))
    least = F.floor((p.percent * F.col("n") + 99) / 100)
    out = whole.join(common, whole["sig"] == common["key"]).withColumn("shared", F.shiftright(F.length("hashes"), 3).cast("long")) \
               .filter(F.col("shared") >= least).select("vid", "sig", "n", "sh", F.col("hashes").alias("common"), "shared")
    return materialize(out, "jaccard-candidates")[0]


def _pivot_links(sets: DataFrame, p: JaccardParams) -> DataFrame:
    """Verified links ``a, b`` of sets with the pivots of their min-hashes."""
    def mins(batches):
        def out():
            for vid, sh in rows(batches, "vid", "sh"):
                s = _unpack(sh)
                for r in range(p.pivot_hashes):
                    yield (vid, r, int((mix(s * np.uint64(2 * r + 3))).min().view(np.int64)))
        yield from emit(pa.schema([("vid", pa.int64()), ("r", pa.int32()), ("m", pa.int64())]), out())

    low = sets.select("vid", "sh").mapInArrow(mins, "vid long, r int, m long")
    low, _ = materialize(low, "jaccard-minhash")
    # written out, like the other small sides below: a join of two scans lets
    # the adaptive planner split a hot key
    center, _ = materialize(low.groupBy("r", "m").agg(F.min("vid").alias("b"), F.count("*").alias("c")).filter("c > 1"), "jaccard-pivot")
    pairs = low.join(center, ["r", "m"]).select(F.col("vid").alias("a"), "b").filter("a <> b").distinct()

    def verify(batches):
        def out():
            for a, b, x, y in rows(batches, "a", "b", "x", "y"):
                if linked(_unpack(x), _unpack(y), p.percent):
                    yield (a, b)
        yield from emit(pa.schema([("a", pa.int64()), ("b", pa.int64())]), out())

    x = sets.select(F.col("vid").alias("a"), F.col("sh").alias("x"))
    y = sets.select(F.col("vid").alias("b"), F.col("sh").alias("y"))
    return pairs.join(x, "a").join(y, "b").mapInArrow(verify, "a long, b long")


def _clusters(sets: DataFrame, p: JaccardParams) -> DataFrame:
    """Star edges ``a, b`` between sets that meet in the rarest shared shingles."""
    def postings(batches):
        for batch in batches:
            parts = [np.frombuffer(x, dtype="<i8") for x in batch.column("common").to_pylist()]
            count = [len(x) for x in parts]
            n, shared = batch.column("n").to_numpy(), batch.column("shared").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("vid").to_numpy(), count)),
                 pa.array(np.repeat(shared - p.needed(n) + 1, count)),
                 pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64))], names=["vid", "keep", "h"])

    post = sets.select("vid", "n", "shared", "common").mapInArrow(postings, "vid long, keep long, h long")
    post, _ = materialize(post, "jaccard-postings")
    df, _ = materialize(post.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "jaccard-df")
    # rarest first; a document's postings are bounded by its own length
    rank = F.row_number().over(Window.partitionBy("vid").orderBy("df", "h"))
    rare = post.join(df, "h").withColumn("rank", rank).filter("rank <= keep").select("vid", "h")
    rare, _ = materialize(rare, "jaccard-rare")
    first, _ = materialize(rare.groupBy("h").agg(F.min("vid").alias("b")), "jaccard-first")
    return rare.join(first, "h").select(F.col("vid").alias("a"), "b").filter("a <> b")


def _search(sets: DataFrame, comp: DataFrame, cluster: DataFrame, p: JaccardParams) -> DataFrame:
    """Links ``a, b`` between components, by DivideSkip over block pairs."""
    one = (sets.select("vid", "n", "sh")
               .join(comp.select(F.col("node").alias("vid"), "component"), "vid", "left")
               .withColumn("component", F.coalesce("component", "vid")))
    member = cluster.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    one, _ = materialize(one.join(member, "component"), "jaccard-members")
    size = one.groupBy("cluster", "component").agg(F.sum("n").alias("n"))
    # a component that fills a block gets blocks of its own; the others of a
    # cluster share blocks by component
    big = F.col("n") >= p.block_shingles
    total = size.filter(~big).groupBy("cluster").agg(F.ceil(F.sum("n") / p.block_shingles).alias("shares"))
    place = size.join(total, "cluster", "left").select(
        "cluster", "component", big.alias("big"),
        F.when(big, F.ceil(F.col("n") / p.block_shingles)).otherwise(F.coalesce("shares", F.lit(1))).alias("shares"))
    block = F.when(F.col("big"), F.concat_ws("/", F.lit("own"), "component", F.pmod(F.xxhash64("vid"), F.col("shares")))) \
             .otherwise(F.concat_ws("/", F.lit("mix"), F.pmod(F.xxhash64("component"), F.col("shares"))))
    placed = one.join(place, ["cluster", "component"]).withColumn("block", block)
    placed, _ = materialize(placed.select("cluster", "component", "big", "block", "vid", "sh"), "jaccard-placed")
    blocks = placed.groupBy("cluster", "block").agg(F.first("big").alias("big"), F.min("component").alias("c0"))
    x = blocks.select("cluster", F.col("block").alias("x"), F.col("big").alias("xb"), F.col("c0").alias("xc"))
    y = blocks.select("cluster", F.col("block").alias("y"), F.col("big").alias("yb"), F.col("c0").alias("yc"))
    # a block pair within one component has nothing to find
    pairs = x.join(y, "cluster").filter("x <= y and not (xb and yb and xc = yc)").select("cluster", "x", "y")
    pairs, _ = materialize(pairs.withColumn("task", F.monotonically_increasing_id()), "jaccard-tasks")
    sides = pairs.select("cluster", "task", F.explode(F.when(F.col("x") == F.col("y"), F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("block"))))
                                                     .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("block")),
                                                                        F.struct(F.lit(1).alias("side"), F.col("y").alias("block"))))).alias("s")) \
                 .select("cluster", "task", "s.side", "s.block")
    work = placed.join(sides, ["cluster", "block"]).select("task", "side", "vid", "component", "sh")

    def search(table: pa.Table) -> pa.Table:
        side = table.column("side").to_pylist()
        vid, comp_of = table.column("vid").to_pylist(), table.column("component").to_pylist()
        sh = [_unpack(s) for s in table.column("sh").to_pylist()]
        left = [i for i, s in enumerate(side) if s == 0]
        right = [i for i, s in enumerate(side) if s == 1] or left
        seen = set()
        for q, c in divide_skip([sh[i] for i in left], [sh[i] for i in right], p):
            i, j = right[q], left[c]
            a, b = comp_of[i], comp_of[j]
            if a != b:
                seen.add((min(a, b), max(a, b)))
        a, b = zip(*sorted(seen)) if seen else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work.groupBy("task").applyInArrow(search, "a long, b long")


def similarity_classes(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, tkey, n_shingles, sig, component_id``.

    ``component_id`` is the smallest doc_id that links reach from the row.
    ``tkey`` identifies the text. Null and empty texts (or white space only)
    have no shingles, link with nothing and keep their own id. Rows with equal
    texts link even if their ids repeat; a null id takes part in links but is
    never the smallest (a class without any other id gets null). Extra columns
    are ignored; an empty table gives an empty result."""
    p = params
    with passing(docs.sparkSession) as keep:
        table, _ = materialize(shingle_rows(docs, p), "jaccard-rows")
        sets = _candidates(docs, table, p)
        links, _ = materialize(_pivot_links(sets, p), "jaccard-pivots")
        comp = connected_components(links)
        label = comp.select(F.col("node").alias("vid"), "component")
        stars = _clusters(sets, p)
        # clusters of components: edges between the components of the star's ends
        at = lambda end: label.select(F.col("vid").alias(end), F.col("component").alias(f"{end}c"))
        edges = stars.join(at("a"), "a", "left").join(at("b"), "b", "left").select(
            F.coalesce("ac", "a").alias("a"), F.coalesce("bc", "b").alias("b"))
        cluster = connected_components(edges)
        more = connected_components(_search(sets, comp, cluster, p))
        final = (sets.select("sig", "vid").join(label, "vid", "left")
                     .select("sig", F.coalesce("component", "vid").alias("node"))
                     .join(more, "node", "left").select("sig", F.coalesce("component", "node").alias("class")))
        final, _ = materialize(final, "jaccard-classes")
        # a class is named by its label, or by the set itself if it has no candidate
        named = table.join(final, "sig", "left").withColumn(
            "class", F.coalesce(F.col("class").cast("string"), F.hex("sig")))
        least = named.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
        least, _ = materialize(least, "jaccard-least")
        result, path = materialize(named.join(least, "class", "left").select(
            "doc_id", "tkey", "n_shingles", "sig",
            F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")), "jaccard-result")
        keep(path)
    return result


def deduplicate(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each class the
    row with the smallest doc_id (equal ids: the smallest text identity; a null
    id counts as largest), and of repeated rows (same id and text) one.

    Rows without shingles (null, empty or blank texts) link with nothing and
    stay."""
    with passing(docs.sparkSession) as keep:
        classes, _ = materialize(similarity_classes(docs, params).filter("sig is not null")
                                 .withColumn("least", F.coalesce(F.col("component_id").cast("string"), F.hex("sig"))), "jaccard-rows-classes")
        members = classes.groupBy("least", "doc_id", "tkey").agg(F.count("*").alias("copies"))
        order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tkey"))
        first = members.groupBy("least").agg(F.min(order).alias("first"))
        judged = members.join(first, "least").withColumn("wins", order == F.col("first"))
        # rows to look at again: losers, and winners that occur more than once
        away, path = materialize(judged.filter("not wins or copies > 1").select(
            F.col("doc_id").alias("__id"), F.col("tkey").alias("__tk"), "wins"), "jaccard-away")
        keep(path)
    return _without(docs, away)


def _without(docs: DataFrame, away: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    keyed = docs.withColumn("__tkey", F.unhex(F.md5(text)))  # text_key, in the JVM
    same = keyed["doc_id"].cast("long").eqNullSafe(away["__id"]) & (keyed["__tkey"] == away["__tk"])
    out = keyed.join(away, same, "left_anti").drop("__tkey")
    twice = away.filter("wins")
    if twice.head(1):  # repeated rows of a winner: one of them
        same = keyed["doc_id"].cast("long").eqNullSafe(twice["__id"]) & (keyed["__tkey"] == twice["__tk"])
        again = keyed.join(twice, same, "left_semi").dropDuplicates(["doc_id", "__tkey"]).drop("__tkey")
        out = out.unionByName(again)
    return out
