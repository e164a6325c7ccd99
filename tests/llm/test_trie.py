"""The prefix trie against a plain recursive version, and the running pass
over groups that span many tasks."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from cartwheel.llm import scan, trie
from llm.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            tie = hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, tie, r, x))
    told = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(told):
        h = zlib.crc32(str(c).encode()) % 4
        turns = told.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + told[c][h:]
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    out = []

    def visit(path):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved, leaves = (len(members[path]) - 1) * words, 0 if kids[path] else 1
        for k in kids[path]:
            s, n = visit(k)
            saved, leaves = saved + s, leaves + n
        out.append((members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), len(kids[path]), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest()))
        return saved, leaves

    if members:
        visit(())
    return out


def check(spark, rows, extra=False, params=trie.TrieParams()):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("node", "depth", "item", "sequence", "range", "place", "first"):
            df = df.selectExpr("*", f"'x' as {name}")
    got = sorted((tuple(r) for r in trie.prefix_trie(df, params).collect()), key=repr)
    assert got == sorted(plain(rows), key=repr)


def test_small_table(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SMALL}/conversations.parquet'").fetchall()
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(0, 0, "user", "hello there"), (0, 1, None, None), (0, None, "system", "be kind"), (0, 1, "user", "tie"), (0, 1, "user", "tie"),
            (1, 0, "", ""), (None, 0, "user", "nobody's"), (None, None, None, None), (3, 5, "user", "x " * 40_000), (4, 0, "user", "hello there"),
            (-7, 0, "user", "below"), (-20, 0, "user", "base below"), (-21, 1, "a", "b"), (47, 0, "user", "no base"), (47, 1, "user", "no base 2")]
    check(spark, rows, extra=True)
    check(spark, [])
    check(spark, [(1, 0, "user", "one")])


def test_random_tries_with_hot_turns(spark):
    rnd = random.Random(11)
    rows = []
    for c in rnd.sample(range(400), 150):
        for t in range(rnd.choice([1, 2, 3, 4, 9])):
            rows.append((c, t, rnd.choice(["user", "user", "assistant"]), "same" if rnd.random() < 0.7 else f"w{rnd.randrange(3)} x"))
    check(spark, rows)


def test_one_conversation_with_a_third_of_all_rows(spark):
    """It spans many tasks; its copies are one sequence."""
    rnd = random.Random(5)
    rows = [(c, t, "user", f"t {t % 7}") for c in (20, 21) for t in range(700)]
    rows += [(c, t, "user", f"{rnd.randrange(4)} b") for c in range(22, 222) for t in range(7)]
    check(spark, rows)


def test_end_lists_in_many_parts(spark):
    rows = [(c, 0, "user", "one for all") for c in range(0, 3000, 3)] + [(c, 3, "user", "behind") for c in range(0, 3000, 3)]
    check(spark, rows, params=trie.TrieParams(part_bytes=40))


@pytest.mark.parametrize("groups", [[90], [1, 88, 1], [30, 30, 30], [5] * 18])
def test_running_across_ranges(spark, groups):
    rows = [(g, p, hashlib.md5(b"%d" % (p % 4)).digest(), p) for g, n in enumerate(groups) for p in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, place long, item binary, words long").repartition(4)
    got, _ = scan.running(df, ["place"], "test-running")
    by = {(r.conv_id, r.depth): r for r in got.collect()}
    assert len(by) == len(rows)
    for g, n in enumerate(groups):
        name, cum = scan.EMPTY, 0
        for p in range(n):
            r = by[g, p + 1]
            item = hashlib.md5(b"%d" % (p % 4)).digest()
            assert (bytes(r.parent), bytes(r.item)) == (name, item)
            one = scan.join_names(scan.EMPTY, 1, item)  # B * item
            name, cum = scan.join_names(name, p, one), cum + p
            assert (bytes(r.node), r.cum) == (name, cum)
