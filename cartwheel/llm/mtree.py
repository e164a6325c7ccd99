"""Exact top-k search by inner product in a paged M-tree.

*Metric.* Vectors of integers ``x`` with ``|x| <= M`` become points
``(x, sqrt(M**2 - |x|**2))`` and a query ``(q, 0)``; then ``distance**2 =
|q|**2 + M**2 - 2 * score``, so nearest means highest inner product, and the
triangle inequality holds.

*Tree.* Root entries are subtrees (*parts*) of a bounded number of rows: rows
go to the nearest of a sample of routing objects, and a region that gets too
many rows (a third of all vectors may be copies) is dealt over several parts. A
part is bulk-loaded by halving it between two far objects until pages are full.
Every entry has its routing object (one of the rows), the covering radius and
the distance to the parent's object; a page's rows have theirs to the page's.

*Search*, in two bulk-synchronous rounds over blocks of queries. A query first
descends into the part with the least bound; its k-th best score there is the
distance that prunes the root entries of the second round. Inside a part the
search is best-first: a heap of pages, first by the bound that the stored parent
distance gives without any computation, then by the real one, until the heap's
best cannot beat the k-th result. In a page the rows' parent distances leave out
rows the same way. Scores are exact integers, bounds have a slack for rounding,
and only what is strictly worse is pruned, so results do not depend on the tree.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.words import emit, release_caches, rows
from cartwheel.plans.sink import materialize, remove_path


@dataclass(frozen=True)
class MTreeParams:
    k: int = 5
    scale: float = 256.0       # components become floor(scale * x)
    page_rows: int = 512       # of a leaf page
    part_rows: int = 32_768    # of a subtree: built and searched in one task
    max_regions: int = 4096    # routing objects at the root, sampled from the rows
    query_block: int = 4096    # queries that are searched together
    root_page: int = 4096      # root entries that are compared together


@dataclass(frozen=True)
class Space:
    """What bounds need to know: the largest squared norm and dimension."""
    m2: float
    dim: int

    @property
    def exact(self) -> bool:
        """Sums of products stay below 2**53 in size, so floats hold them."""
        return self.m2 < 2.0 ** 52

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.m2 - np.einsum("ij,ij->i", x, x), 0.0))

    def between(self, x, ax, y, ay) -> np.ndarray:
        """Distances of the points of ``x`` to those of ``y`` (matrices and lifts)."""
        return np.sqrt(np.maximum(2.0 * (self.m2 - x @ y.T - np.multiply.outer(ax, ay)), 0.0))

    def reach(self, norm2, score):
        """Distance of a query of squared norm ``norm2`` to a point of that score."""
        return np.sqrt(np.maximum(norm2 + self.m2 - 2.0 * score, 0.0))

    def slack(self, norm2):
        return 1e-6 * (np.sqrt(self.m2) + np.sqrt(norm2)) + 1e-9


def _pack(x: np.ndarray) -> bytes:
    """Integers as 4 bytes each where they fit, else 8."""
    small = not x.size or np.abs(x).max() < 2 ** 31
    return x.astype("<i4" if small else "<i8").tobytes()


def _unpack(packed: bytes, n: int, dim: int) -> np.ndarray:
    if not n * dim:
        return np.zeros((n, dim), dtype=np.int64)
    wide = len(packed) // (n * dim) == 8
    return np.frombuffer(packed, dtype="<i8" if wide else "<i4").reshape(n, dim)


def _matrix(packed: list[bytes], dims: list[int], dim: int) -> np.ndarray:
    """Rows of their own dimensions as an int64 matrix, padded or cut to ``dim``."""
    if packed and dims.count(dim) == len(dims) and all(len(v) == 4 * dim for v in packed):
        return np.frombuffer(b"".join(packed), dtype="<i4").reshape(len(packed), dim).astype(np.int64)
    out = np.zeros((len(packed), dim), dtype=np.int64)
    for i, (v, d) in enumerate(zip(packed, dims)):
        out[i, :min(d, dim)] = _unpack(v, 1, d)[0, :dim]
    return out


_VECTOR = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("v", pa.binary()), ("norm2", pa.float64())])


def vectors(table: DataFrame, params: MTreeParams = MTreeParams()) -> DataFrame:
    """``vec_id, dim, v, norm2`` of the rows of ``table(vec_id, embedding)``
    that take part: not those with a null id or vector, or with a component
    that is null, not finite or, scaled, beyond 2**62."""
    scale = params.scale

    def of(batches):
        release_caches()

        def out():
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    column = part.column("embedding")
                    ids = part.column("vec_id").to_pylist()
                    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                    good = np.abs(flat) < 2.0 ** 62  # not so for NaN, which nulls become, too
                    lengths = [0 if n is None else n for n in column.value_lengths().to_pylist()]
                    begin = 0
                    for vec_id, n, valid in zip(ids, lengths, column.is_valid().to_pylist()):
                        x, ok = flat[begin:begin + n], good[begin:begin + n]
                        begin += n
                        if valid and ok.all():
                            x = x.astype(np.int64)
                            y = x.astype(np.float64)
                            yield (vec_id, n, _pack(x), float(y @ y))
        yield from emit(_VECTOR, out())

    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")) \
                .filter("vec_id is not null and embedding is not null").mapInArrow(of, "vec_id long, dim int, v binary, norm2 double")


# ------------------------------------------------------------------ building
_PAGE = pa.schema([("part", pa.int64()), ("page", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vs", pa.binary()),
                   ("dists", pa.binary()), ("object", pa.int32()), ("radius", pa.float64()), ("to_parent", pa.float64()),
                   ("part_object", pa.binary()), ("part_radius", pa.float64())])
_PAGE_DDL = ("part long, page int, n int, ids binary, vs binary, dists binary, object int, radius double, to_parent double, "
             "part_object binary, part_radius double")


def _center(x: np.ndarray, a: np.ndarray) -> int:
    """The row nearest to the mean."""
    m, am = x.mean(axis=0), a.mean()
    gap = x - m
    return int((np.einsum("ij,ij->i", gap, gap) + (a - am) ** 2).argmin())


def bulk_load(part: int, ids: np.ndarray, x: np.ndarray, space: Space, page_rows: int):
    """Page rows of one part: halved between two far objects until pages are full."""
    points, lifts = x.astype(np.float64), space.lift(x.astype(np.float64))
    far = lambda i, rows_: space.between(points[rows_], lifts[rows_], points[i:i + 1], lifts[i:i + 1])[:, 0]
    todo, pages = [np.arange(len(ids))], []
    while todo:
        own = todo.pop()
        if len(own) <= page_rows:
            pages.append(own)
            continue
        a = own[far(own[0], own).argmax()]
        to_a = far(a, own)
        b = own[to_a.argmax()]
        order = np.argsort(to_a - far(b, own), kind="stable")
        todo += [own[order[len(own) // 2:]], own[order[:len(own) // 2]]]
    top = _center(points, lifts)
    top_radius = float(far(top, np.arange(len(ids))).max())
    for k, own in enumerate(pages):
        o = _center(points[own], lifts[own])
        dists = far(own[o], own)
        yield (part, k, len(own), ids[own].astype("<i8").tobytes(), _pack(x[own]), dists.astype("<f8").tobytes(), o, float(dists.max()),
               float(far(top, own[o:o + 1])[0]), _pack(x[top]), top_radius)


@dataclass(frozen=True)
class MTree:
    """``pages``: a row per leaf page, with its part's root entry."""
    pages: DataFrame
    space: Space
    params: MTreeParams
    paths: tuple[str, ...]


def build(points: DataFrame, params: MTreeParams = MTreeParams()) -> MTree | None:
    """The tree over the rows of :func:`vectors` (None if there are none).
    Every row is in it once; rows that repeat an id and its vector are one."""
    p = params
    spark = points.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    told = points.agg(F.count("*").alias("n"), F.max("norm2").alias("m2"), F.max("dim").alias("dim")).first()
    if not told["n"]:
        return None
    space = Space(float(told["m2"]) * (1 + 1e-12) + 1.0, int(told["dim"]))
    dim = space.dim

    # routing objects: a sample by hash, of bounded size; all rows are indexed
    regions = min(-(-told["n"] // p.part_rows), p.max_regions)
    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 32))
    picked = []
    if regions > 1:
        share = min(1.0, max(2.0 * regions, 64.0) / told["n"]) * (1 << 32)
        picked = points.filter(spread < F.lit(int(share) + 1)).select("dim", "v").distinct().limit(4 * regions).collect()
        picked = sorted((bytes(r["v"]), r["dim"]) for r in picked)[:regions]
    picked = picked or [(b"", 0)]  # one region around the origin, dealt over as many parts as it takes
    objects = _matrix([v for v, _ in picked], [d for _, d in picked], dim).astype(np.float64)
    lifts = space.lift(objects)

    def assign(batches):
        release_caches()
        step = max(16, (1 << 21) // len(objects))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = _matrix(part.column("v").to_pylist(), part.column("dim").to_pylist(), dim).astype(np.float64)
                near = (x @ objects.T + np.multiply.outer(space.lift(x), lifts)).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(near, pa.int32()), *(part.column(c) for c in ("vec_id", "dim", "v"))],
                                                 names=["region", "vec_id", "dim", "v"])

    assigned, assigned_path = materialize(points.select("vec_id", "dim", "v").mapInArrow(assign, "region int, vec_id long, dim int, v binary"),
                                          "mtree-assigned")
    # a row per region, at most max_regions
    sizes = sorted((r["region"], r["count"]) for r in assigned.groupBy("region").count().collect())
    dealt, first = [], 0
    for region, count in sizes:
        dealt.append((region, first, -(-count // p.part_rows)))
        first += dealt[-1][2]
    dealt = spark.createDataFrame(dealt, "region int, first long, parts long")
    parted = assigned.join(F.broadcast(dealt), "region").withColumn("part", F.col("first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")))

    def load(batches):
        release_caches()

        def pages(part, held):
            ids, dims, vs = zip(*sorted(set(held)))
            yield from bulk_load(part, np.array(ids, dtype=np.int64), _matrix(list(vs), list(dims), dim), space, p.page_rows)

        def out():
            now, held = None, []
            for part, *row in rows(batches, "part", "vec_id", "dim", "v"):
                if part != now and held:
                    yield from pages(now, held)
                    held = []
                now = part
                held.append(tuple(row))
            if held:
                yield from pages(now, held)
        yield from emit(_PAGE, out())

    stored, path = materialize(parted.select("part", "vec_id", "dim", "v").repartition(n, "part").sortWithinPartitions("part")
                               .mapInArrow(load, _PAGE_DDL), "mtree-pages")
    return MTree(stored, space, p, (assigned_path, path))


# ----------------------------------------------------------------- searching
class Found:
    """The k best (score, id) of a query so far; ties go to the smaller id."""

    def __init__(self, k: int, floor: int | None):
        self.k, self.floor = k, floor  # floor: k-th best score known from elsewhere
        self.scores = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int64)

    def worst(self) -> int | None:
        own = int(self.scores[-1]) if len(self.scores) == self.k else None
        return self.floor if own is None else own if self.floor is None else max(own, self.floor)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        worst = self.worst()
        if worst is not None:
            keep = scores >= worst
            scores, ids = scores[keep], ids[keep]
        if len(scores):
            if len(scores) > self.k:  # all that tie with the k-th stay for the order by id
                keep = scores >= np.partition(scores, -self.k)[-self.k]
                scores, ids = scores[keep], ids[keep]
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            order = np.lexsort((ids, -scores))[:self.k]
            self.scores, self.ids = scores[order], ids[order]


def search_part(pages: list[dict], queries: np.ndarray, query_ids: np.ndarray, floors: list[int | None], space: Space, p: MTreeParams):
    """Best-first search of one part for each query: (query's place, Found)."""
    dim = space.dim
    x = [_unpack(g["vs"], g["n"], dim) for g in pages]
    fast = [m.astype(np.float64) for m in x] if space.exact else None
    ids = [np.frombuffer(g["ids"], dtype="<i8") for g in pages]
    dists = [np.frombuffer(g["dists"], dtype="<f8") for g in pages]
    radius, to_parent = (np.array([g[c] for g in pages]) for c in ("radius", "to_parent"))
    objects = np.array([m[g["object"]] for m, g in zip(x, pages)], dtype=np.float64)
    top = _unpack(pages[0]["part_object"], 1, dim)[0].astype(np.float64)
    for i in range(len(queries)):
        q = queries[i]
        qf = q.astype(np.float64)
        norm2 = float(qf @ qf)
        slack = space.slack(norm2)
        found = Found(p.k, floors[i])
        worst = found.worst()
        limit = np.inf if worst is None else float(space.reach(norm2, worst)) + slack
        # bounds from stored parent distances alone; a page's own distance is computed when it comes up
        cheap = np.maximum(np.abs(float(space.reach(norm2, qf @ top)) - to_parent) - radius, 0.0)
        heap = [(float(b), g, None) for g, b in enumerate(cheap) if b <= limit]
        heapq.heapify(heap)
        while heap:
            bound, g, at = heapq.heappop(heap)
            if bound > limit:
                break
            if at is None:
                at = float(space.reach(norm2, qf @ objects[g]))
                bound = max(bound, at - radius[g])
                if bound > limit:
                    continue
                if heap and bound > heap[0][0]:
                    heapq.heappush(heap, (bound, g, at))
                    continue
            near = np.abs(dists[g] - at) <= limit
            near &= ids[g] != query_ids[i]
            if near.all():
                near = slice(None)
            scores = (fast[g][near] @ qf).astype(np.int64) if fast else x[g][near].astype(np.int64) @ q
            found.add(scores, ids[g][near])
            worst = found.worst()
            if worst is not None:
                limit = float(space.reach(norm2, worst)) + slack
        yield i, found


_HIT = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_HIT_DDL = "block long, pos int, query_id long, vec_id long, score long"


def _query_blocks(queries: DataFrame, dim: int, p: MTreeParams) -> tuple[DataFrame, str]:
    """``block, n, ids, vs``: queries packed in blocks; repeated ones are one."""
    queries = queries.select("vec_id", "dim", "v").distinct()
    n = -(-max(queries.count(), 1) // p.query_block)
    part = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("vs", pa.binary())])
    limit = p.query_block

    def pack(batches):
        def out():
            ids, vs, dims = [], [], []
            block = -1
            for at, vec_id, d, v in rows(batches, "at", "vec_id", "dim", "v"):
                block = (at << 32) + (block + 1 & 0xFFFFFFFF if not ids else block & 0xFFFFFFFF)
                ids.append(vec_id)
                vs.append(v)
                dims.append(d)
                if len(ids) == limit:
                    yield (block, len(ids), np.array(ids, "<i8").tobytes(), _pack(_matrix(vs, dims, dim)))
                    ids, vs, dims = [], [], []
            if ids:
                yield (block, len(ids), np.array(ids, "<i8").tobytes(), _pack(_matrix(vs, dims, dim)))
        yield from emit(part, out())

    return materialize(queries.repartition(n, "vec_id").sortWithinPartitions("vec_id", "v").withColumn("at", F.spark_partition_id().cast("long"))
                       .mapInArrow(pack, "block long, n int, ids binary, vs binary"), "mtree-queries")


def _bounds(tree: MTree, blocks: DataFrame):
    """Rows of query blocks, each beside every page of the root: ``block, n, vs,
    .., entries`` (the number of root pages follows from that of the parts)."""
    p = tree.params
    root = tree.pages.filter("page = 0").select("part", "part_object", "part_radius") \
                     .withColumn("root", F.expr(f"part div {p.root_page}"))
    # part numbers are dense, so a root page has at most root_page entries
    root = root.groupBy("root").agg(F.collect_list(F.struct("part", "part_object", "part_radius")).alias("entries"))
    count = tree.pages.agg(F.max("part")).first()[0] // p.root_page + 1
    return blocks.withColumn("root", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))).join(root, "root")


def _entry_bounds(entries: list[dict], q: np.ndarray, space: Space) -> tuple[list[int], np.ndarray]:
    """Parts and, for each query and part, the least distance that the covering radius leaves."""
    objects = _matrix([e["part_object"] for e in entries], [space.dim] * len(entries), space.dim).astype(np.float64)
    radius = np.array([e["part_radius"] for e in entries])
    norm2 = np.einsum("ij,ij->i", q, q)
    reach = space.reach(norm2[:, None], q @ objects.T)
    return [e["part"] for e in entries], np.maximum(reach - radius - space.slack(norm2)[:, None], 0.0)


def _search(tree: MTree, blocks: DataFrame, routes: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Hits of ``routes(block, part, places, floors)``: which queries of a block
    a part is searched for, and their k-th best scores so far (packed)."""
    space, p = tree.space, tree.params
    dim = space.dim
    asked = routes.join(blocks, "block").select("part", "block", "places", "floors", "n", "ids", "vs")
    pages = tree.pages.join(routes.select("part", F.col("block").alias("asking")), "part").withColumnRenamed("part", "asked")

    def of(left, right):
        hits = []
        pages_ = right.select(["n", "ids", "vs", "dists", "object", "radius", "to_parent", "part_object"]).to_pylist()
        for r in left.to_pylist():
            places = np.frombuffer(r["places"], dtype="<i4")
            floors = np.frombuffer(r["floors"], dtype="<i8")
            q = _unpack(r["vs"], r["n"], dim)[places].astype(np.int64)
            ids = np.frombuffer(r["ids"], dtype="<i8")[places]
            known = [None if f == _NONE else int(f) for f in floors]
            for i, found in search_part(pages_, q, ids, known, space, p):
                m = len(found.ids)
                hits.append((np.full(m, places[i]), np.full(m, ids[i]), found.ids, found.scores))
            block = r["block"]
        if not hits:
            return _HIT.empty_table()
        pos, query, vec, score = (np.concatenate(c) for c in zip(*hits))
        return pa.table([pa.array(np.full(len(pos), block), pa.int64()), pa.array(pos, pa.int32()), pa.array(query, pa.int64()),
                         pa.array(vec, pa.int64()), pa.array(score, pa.int64())], schema=_HIT)

    hits = asked.groupBy("part", "block").cogroup(pages.groupBy("asked", "asking")).applyInArrow(of, _HIT_DDL)
    return materialize(hits, name)


_NONE = -(1 << 63)  # no k-th best score yet
_ROUTE = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("places", pa.binary()), ("floors", pa.binary())])
_ROUTE_DDL = "block long, part long, places binary, floors binary"


def search(tree: MTree, queries: DataFrame) -> tuple[DataFrame, list[str]]:
    """``query_id, rank, vec_id, score`` of rows like those of :func:`vectors`,
    and the paths of the tables under it."""
    space, p = tree.space, tree.params
    dim = space.dim
    blocks, used = _query_blocks(queries, dim, p)
    used = [used]
    beside = _bounds(tree, blocks)
    step = 256  # queries compared with a root page at once

    def nearest(batches):
        release_caches()

        def out():
            for block, n, vs, entries in rows(batches, "block", "n", "vs", "entries"):
                q = _unpack(vs, n, dim).astype(np.float64)
                for at in range(0, n, step):
                    parts, low = _entry_bounds(entries, q[at:at + step], space)
                    best = low.argmin(axis=1)
                    yield from ((block, at + i, float(low[i, b]), parts[b]) for i, b in enumerate(best))
        yield from emit(pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("low", pa.float64()), ("part", pa.int64())]), out())

    first = beside.select("block", "n", "vs", "entries").mapInArrow(nearest, "block long, pos int, low double, part long") \
                  .groupBy("block", "pos").agg(F.min(F.struct("low", "part")).alias("b")).select("block", "pos", "b.part")
    first, path = materialize(first, "mtree-first")
    used.append(path)

    def route(batches):  # one row per block and part
        yield from emit(_ROUTE, ((block, part, np.array(sorted(places), "<i4").tobytes(), np.full(len(places), _NONE, "<i8").tobytes())
                                 for block, part, places in rows(batches, "block", "part", "places")))

    begun = first.groupBy("block", "part").agg(F.collect_list("pos").alias("places")).mapInArrow(route, _ROUTE_DDL)
    near, path = _search(tree, blocks, begun, "mtree-near")
    used.append(path)

    # the k-th best score of every query so far, by block
    floors = near.groupBy("block", "pos").agg(F.when(F.count("*") == p.k, F.min("score")).alias("floor"))
    state = first.join(floors, ["block", "pos"], "left").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("pos", "part", F.coalesce("floor", F.lit(_NONE)).alias("floor")))).alias("state"))

    def further(batches):
        release_caches()

        def out():
            for block, n, vs, entries, state in rows(batches, "block", "n", "vs", "entries", "state"):
                q = _unpack(vs, n, dim).astype(np.float64)
                seen = np.array([s["part"] for s in state])
                floor = np.array([s["floor"] for s in state], dtype=np.int64)
                places: dict[int, list[np.ndarray]] = {}
                for at in range(0, n, step):
                    own, f = q[at:at + step], floor[at:at + step]
                    parts, low = _entry_bounds(entries, own, space)
                    norm2 = np.einsum("ij,ij->i", own, own)
                    limit = np.where(f == _NONE, np.inf, space.reach(norm2, f.astype(np.float64)) + space.slack(norm2))
                    go = low <= limit[:, None]
                    for j, part in enumerate(parts):
                        hit = np.flatnonzero(go[:, j] & (seen[at:at + step] != part))
                        if len(hit):
                            places.setdefault(part, []).append(hit + at)
                for part, hits in places.items():
                    hit = np.concatenate(hits)
                    yield (block, part, hit.astype("<i4").tobytes(), floor[hit].astype("<i8").tobytes())
        yield from emit(_ROUTE, out())

    routes = beside.join(state, "block").select("block", "n", "vs", "entries", "state").mapInArrow(further, _ROUTE_DDL)
    routes, path = materialize(routes, "mtree-routes")
    used.append(path)
    far, path = _search(tree, blocks, routes, "mtree-far")
    used.append(path)
    best = Window.partitionBy("block", "pos").orderBy(F.col("score").desc(), "vec_id")
    return near.unionByName(far).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= p.k) \
               .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), used


def top_k(table: DataFrame, is_query, params: MTreeParams = MTreeParams()) -> DataFrame:
    """``query_id, rank, vec_id, score`` (integer inner product) of the rows of
    ``table(vec_id, embedding)`` for which the condition ``is_query`` on vec_id
    holds, against all other rows; ties go to the smaller vec_id.

    Rows with a null id or vector, or with a null, non-finite or (scaled)
    beyond 2**62 component take no part. A shorter vector counts as padded with
    zeros; an empty one scores 0. A row is told by id and vector: exact repeats
    are one row, other vectors under one id are rows (and queries) of their
    own, and a query never meets its own id. Scores must fit a long. With fewer
    than k other rows all are returned; an empty table gives none. Extra
    columns are not read. Written once; the tables on the way are removed."""
    points, path = materialize(vectors(table, params), "mtree-vectors")
    spark, used = points.sparkSession, [path]
    tree = build(points, params)
    if tree is None:
        result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    else:
        found, paths = search(tree, points.filter(is_query))
        result, _ = materialize(found, "mtree-found")
        used += [*tree.paths, *paths]
    for path in used:
        remove_path(spark, path)
    return result
