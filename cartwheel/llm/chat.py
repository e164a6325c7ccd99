"""Chat formatting through a prefix tree.

Conversations that start with the same turns share those turns: every distinct
prefix is a node, its turn is formatted and emitted once. Nodes are emitted in
depth-first order into one stream; each carries the position id of its first
character (what its conversation's formatted text has before it) and the
intervals of the stream that its characters may attend to (its ancestors).

Depth-first order comes from a range sort of the distinct conversations. A
conversation is named by its last node (digests are chained, so that names the
whole path), and its sort key holds only the turns where paths part: the
children of nodes that go on in more than one way. Whoever parts from a path
at depth d has d turns of its own, so N turns give a key of at most sqrt(2 N)
entries, however long the conversation; its turns are rows everywhere. A node
belongs to the first path through it, so sorting nodes by that path's rank and
their depth lists every subtree without a gap. No subtree is gathered anywhere,
so a first turn that a third of all conversations share is one row.

Template (one code point is one unit): ``<<SYS>>text<</SYS>>`` for system
turns, ``[INST]text[/INST]`` for the user, ``<s>text</s>`` for the assistant
and ``<|role|>text<|end|>`` for other roles. A control string inside a text is
escaped with a backslash; backslashes before it, or at the text's end, are
doubled, so reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.words import emit, rows
from cartwheel.plans.sink import materialize

# fixed values: the template's control strings
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
_CONTROL = r"<</?SYS>>|\[/?INST\]|</?s>|<\|[^|<>\[\]]*\|>"
_ESCAPE = re.compile(rf"(\\*)({_CONTROL}|\Z)")
_MARK = re.compile(rf"(\\*)({_CONTROL})")
_STARTS = {start: role for role, (start, _) in MARKS.items()}


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[1] * 2 + ("\\" + m[2] if m[2] else ""), text)


def unescape(text: str) -> str:
    """Inverse of :func:`escape`, for one turn's text."""
    def back(m):
        if m[2]:  # 2n + 1 backslashes stand for n and a control string
            return "\\" * ((len(m[1]) - 1) // 2) + m[2]
        return "\\" * (len(m[1]) // 2)
    return _ESCAPE.sub(back, text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """Formatted turn, and where its text stands in it."""
    start, close = MARKS.get(role) or (f"<|{quote(role, safe='')}|>", "<|end|>")
    body = escape(text)
    return start + body + close, len(start), len(start) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out = []
    role, begin = None, 0
    for m in _MARK.finditer(formatted):
        if len(m[1]) % 2:  # escaped: part of a text
            continue
        mark = m[2]
        if role is None:
            role = _STARTS.get(mark) if mark in _STARTS else unquote(mark[2:-2])
            begin = m.end()
        else:
            out.append((role, unescape(formatted[begin:m.start(2)])))
            role = None
    return out


@dataclass(frozen=True)
class ChatParams:
    loss_role: str = "assistant"


_TURN = [("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("body", pa.string()),
         ("units", pa.int64()), ("position", pa.int64()), ("loss_from", pa.int64()), ("loss_to", pa.int64()), ("last", pa.bool_())]
_TURN_DDL = ("conv_id long, depth long, node binary, parent binary, body string, units long, position long, "
             "loss_from long, loss_to long, last boolean")


def _turns(conversations: DataFrame, p: ChatParams) -> DataFrame:
    """A row per turn with its node; the last turn of a conversation is marked.
    A conversation streams through one task, turn by turn, and only one turn is
    held: its digests are sequential by nature."""
    table = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def of(batches):
        def out():
            now, chain, depth, position, held = object(), b"", 0, 0, None
            for conv, role, text in rows(batches, "conv_id", "role", "text"):
                if held:
                    yield held + (conv != now,)
                if conv != now:
                    now, chain, depth, position = conv, b"", 0, 0
                body, a, b = format_turn(role, text)
                parent = chain or None
                chain = xxhash.xxh3_128_digest(chain + body.encode())
                loss = (a, b) if role == p.loss_role else (None, None)
                held = (conv, depth, chain, parent, body, len(body), position, *loss)
                depth, position = depth + 1, position + len(body)
            if held:
                yield held + (True,)
        yield from emit(pa.schema(_TURN), out())

    return table.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text") \
                .select("conv_id", "role", "text").mapInArrow(of, _TURN_DDL)


@dataclass(frozen=True)
class ChatForest:
    """``nodes``: one row per emitted turn: ``node, parent, depth, body, units,
    start`` (place in the stream), ``position`` (of its first unit),
    ``attends`` (stream intervals of its ancestors, merged, as arrays [from,
    to)), ``loss_from, loss_to`` (units of the body under the loss mask; null:
    none). ``paths``: ``path, rank`` of the distinct conversations (``path``:
    the last node). ``steps``: ``rank, depth, node`` of every step of every
    distinct path. ``leaves``: ``conv_id, path``."""
    nodes: DataFrame
    paths: DataFrame
    steps: DataFrame
    leaves: DataFrame


def _ranked(steps: DataFrame, nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``path, rank`` in depth-first order, from ``steps(path, depth, node,
    parent)``, the distinct nodes and the paths (their last nodes)."""
    n = max(int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("at")).agg(F.count("*").alias("kids"))
    # nodes that go on in several ways; to end there is a way too
    forks = kids.join(ends.select(F.col("path").alias("at"), F.lit(1).alias("ends")), "at", "left") \
                .filter(F.col("kids") + F.coalesce("ends", F.lit(0)) > 1).select("at")
    forks, _ = materialize(forks, "chat-forks")
    taken = steps.filter("depth = 0").select("path", "depth", "node").unionByName(
        steps.join(forks, F.col("parent") == F.col("at"), "left_semi").select("path", "depth", "node"))
    key = F.transform(F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda x: x["node"])
    ranked = taken.groupBy("path").agg(key.alias("key")).repartitionByRange(n, "key").sortWithinPartitions("key") \
                  .withColumn("rank", F.monotonically_increasing_id()).select("path", "rank")
    return materialize(ranked, "chat-paths")[0]


def _ancestry(steps: DataFrame, info: DataFrame) -> DataFrame:
    """``owner, own, base``: for every path, where the nodes that it owns start
    in the stream, and the merged intervals of the ones before them. The steps
    that another path owns are one run of the stream."""
    runs = steps.join(info, "node").groupBy("rank", "owner").agg(
        F.min("start").alias("a"), F.max(F.col("start") + F.col("units")).alias("b"))
    other = F.when(F.col("owner") != F.col("rank"), F.struct("a", "b"))
    each = runs.groupBy("rank").agg(F.min(F.when(F.col("owner") == F.col("rank"), F.col("a"))).alias("own"),
                                    F.array_sort(F.collect_list(other)).alias("runs")) \
               .filter("own is not null").select("rank", "own", "runs")

    def of(batches):
        def out():
            for rank, own, found in rows(batches, "rank", "own", "runs"):
                base = []
                for r in found:
                    if base and base[-1][1] == r["a"]:
                        base[-1][1] = r["b"]
                    else:
                        base.append([r["a"], r["b"]])
                yield (rank, own, base)
        yield from emit(pa.schema([("owner", pa.int64()), ("own", pa.int64()), ("base", pa.list_(pa.list_(pa.int64())))]), out())

    return each.mapInArrow(of, "owner long, own long, base array<array<bigint>>")


def _numbered(nodes: DataFrame) -> DataFrame:
    """Adds ``start``: units emitted before the node, in (rank, depth) order."""
    spark = nodes.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sort = nodes.repartitionByRange(n, "rank", "depth").sortWithinPartitions("rank", "depth") \
                .withColumn("range", F.spark_partition_id())

    def running(batches):
        total = 0
        for batch in batches:
            units = batch.column("units").to_numpy(zero_copy_only=False)
            ends = units.cumsum() + total
            starts = ends - units
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts, pa.int64())],
                                             names=[*batch.schema.names, "local"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sort.schema.fields) + ", local long"
    out, _ = materialize(sort.mapInArrow(running, ddl), "chat-emitted")
    # one total per range reaches the driver
    totals = out.groupBy("range").agg(F.sum("units").alias("units")).orderBy("range").collect()
    if not totals:
        return out.withColumn("start", F.col("local")).drop("local", "range")
    before, ranges = 0, []
    for r in totals:
        ranges.append((r["range"], before))
        before += r["units"]
    offsets = spark.createDataFrame(ranges, "range int, before long")
    return out.join(F.broadcast(offsets), "range").withColumn("start", F.col("local") + F.col("before")) \
              .drop("local", "range", "before")


def build_forest(conversations: DataFrame, params: ChatParams = ChatParams()) -> ChatForest:
    """Formats ``conversations(conv_id, turn, role, text)``.

    Turns are ordered by turn (equal turns: by role, then text; null first).
    Null roles and texts count as empty; rows with a null conv_id form one
    conversation. Repeated rows are turns of their own. Extra columns are
    ignored; an empty table gives empty tables."""
    turns, _ = materialize(_turns(conversations, params), "chat-turns")
    leaves = turns.filter("last").select("conv_id", F.col("node").alias("path"))
    # one conversation stands for all with the same turns
    first = leaves.groupBy("path").agg(F.min(F.struct("conv_id")).alias("c")).select("path", F.col("c.conv_id").alias("stands"))
    first, _ = materialize(first, "chat-first")
    told, _ = materialize(turns.join(first, F.col("conv_id").eqNullSafe(F.col("stands"))).select("path", "depth", "node", "parent"), "chat-told")
    bodies = turns.groupBy("node").agg(*[F.first(c).alias(c) for c in ("parent", "depth", "body", "units", "position", "loss_from", "loss_to")])
    bodies, _ = materialize(bodies, "chat-bodies")
    paths = _ranked(told, bodies, first)
    steps, _ = materialize(told.join(paths, "path").select("rank", "depth", "node"), "chat-steps")
    owner = steps.groupBy("node").agg(F.min("rank").alias("rank"))
    placed = _numbered(bodies.select("node", "depth", "units").join(owner, "node"))
    info, _ = materialize(placed.select("node", "units", "start", F.col("rank").alias("owner")), "chat-info")
    before, _ = materialize(_ancestry(steps, info), "chat-ancestry")

    # a node attends to what stands before its path's own nodes, and to those up to itself
    base, own, start = F.col("base"), F.col("own"), F.col("start")
    end = F.try_element_at("base", F.lit(-1))
    attends = F.when(start == own, base) \
               .when((F.size(base) > 0) & (end[1] == own),
                     F.concat(F.slice(base, 1, F.size(base) - 1), F.array(F.array(end[0], start)))) \
               .otherwise(F.concat(base, F.array(F.array(own, start))))
    spans, _ = materialize(info.join(before, "owner").select("node", "start", F.col("owner").alias("rank"), attends.alias("attends")), "chat-spans")
    return ChatForest(bodies.join(spans, "node"), paths, steps, leaves)


def read_turns(bodies):
    """(role, text) of the turns of formatted text that arrives in pieces: what
    a piece leaves open goes on with the next one."""
    tail = ""
    for body in bodies:
        tail += body
        role, begin, done = None, 0, 0
        for m in _MARK.finditer(tail):
            if len(m[1]) % 2:  # escaped: part of a text
                continue
            if role is None:
                role = _STARTS.get(m[2]) if m[2] in _STARTS else unquote(m[2][2:-2])
                begin = m.end()
            else:
                yield role, unescape(tail[begin:m.start(2)])
                role, done = None, m.end()
        tail = tail[done:]


def read_back(forest: ChatForest) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars`` of every conversation, from the emitted nodes alone: each
    distinct path is read once, turn by turn, in one task that holds counters,
    running digests and a turn (SHA-256 is sequential by nature)."""
    parts = forest.steps.join(forest.nodes.select("node", "body", "position", "loss_from", "loss_to"), "node") \
        .repartition("rank").sortWithinPartitions("rank", "depth") \
        .select("rank", "body", "position", "loss_from", "loss_to")

    def of(batches):
        def out():
            for rank, path in groupby(rows(batches, "rank", "body", "position", "loss_from", "loss_to"), itemgetter(0)):
                said, loss = hashlib.sha256(), hashlib.sha256()
                count = {"turns": 0, "loss": 0, "chars": 0}

                def bodies():
                    for _, body, position, a, b in path:
                        if a is not None:  # the mask's place in the whole text, by the position id
                            at = position - count["chars"]
                            masked = unescape(body[max(at + a, 0):max(at + b, 0)])
                            count["loss"] += len(masked)
                            loss.update(masked.encode())
                        count["chars"] += len(body)
                        yield body

                for role, text in read_turns(bodies()):
                    count["turns"] += 1
                    said.update(f"{role}\n{text}\n".encode())
                yield (rank, count["turns"], said.hexdigest(), count["loss"], loss.hexdigest(), count["chars"])
        yield from emit(pa.schema([("rank", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]), out())

    read, _ = materialize(parts.mapInArrow(of, "rank long, n_turns long, turns_sha256 string, loss_chars long, "
                                               "loss_sha256 string, formatted_chars long"), "chat-read")
    digests = forest.paths.join(read, "rank").drop("rank")
    digests, _ = materialize(digests, "chat-digests")
    return forest.leaves.join(digests, "path").select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
