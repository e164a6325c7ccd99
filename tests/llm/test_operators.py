"""Every operator against its plain version, on the smallest tables and on odd
rows (nulls, empty, blank and long texts, ties, repeated rows and ids, empty
tables, extra columns with clashing names)."""

from __future__ import annotations

import hashlib
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import chat, fingerprint, jaccard, langid, licenses, packing, pieces, quality, queries, substring, urlfilter
from cartwheel.llm.tokens import CachedTokenizer, default_tokenizer
from llm import brute
from llm.conftest import ODD_ROWS, SMALL


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# ------------------------------------------------------------------- op1
@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def check_packing(df, expected, capacity):
    rows = [tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32").collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    places = defaultdict(list)
    for r in df.select("sequence_id", "offset", "length").collect():
        places[r.sequence_id].append((r.offset, r.length))
    for items in places.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_small_table(documents, rows, encode):
    expected = [(d, k, *v) for (d, k), v in brute.pieces(rows, encode).items()]
    df = packing.pack_documents(documents).cache()
    n = check_packing(df, expected, 2048)
    lengths = [e[3] for e in expected]
    assert -(-sum(lengths) // 2048) <= n <= 1.01 * brute.best_fit_decreasing(lengths) + 1


def test_packing_odd_rows(frame, encode):
    expected = []
    for doc_id, text in ODD_ROWS:
        expected += [(doc_id, k, *v) for (_, k), v in brute.pieces([(doc_id, text)], encode).items()]
    check_packing(packing.pack_documents(frame(ODD_ROWS)).cache(), expected, 2048)
    assert packing.pack_documents(frame([])).count() == 0


def test_packing_many_equal_lengths(spark):
    """A hot length, and lengths around a half."""
    rng = random.Random(3)
    lengths = [100] * 400 + [rng.randint(1, 200) for _ in range(300)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    out = packing.pack(items, 200).join(items, "item").collect()
    assert len(out) == len(lengths)
    fill = defaultdict(list)
    for r in out:
        fill[r.seq].append((r.offset, r.length))
    for x in fill.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 200
    assert len(fill) <= 1.02 * brute.best_fit_decreasing(lengths, 200) + 1


def test_sweep_across_ranges():
    # range 0 leaves gaps, range 1 pieces and gaps, range 2 pieces
    assert packing._across([(0, 0, 3), (1, 2, 1), (2, 3, 0)]) == [(1, 0, 0, 0, 2), (2, 0, 1, 0, 1), (2, 1, 0, 2, 1)]


def test_cached_tokenizer_matches_the_library(rows, encode):
    with open(default_tokenizer(), encoding="utf-8") as f:
        tok = CachedTokenizer(f.read(), max_parts=50, max_words=50)  # small caches: they empty often
    texts = [t for _, t in rows[:60]] + [
        "", " ", "it's WE'LL you've", "a\u00a0b\u0085c\x1cd", "x<|endoftext|>y <|startoftext|>", "İstanbul ΣΑΣ ﬁ e\u0301 中文 🙂",
        "1²³ ½ µ º ª ß ÿ Ÿ", "''s '''ll", "a\x00b", "Ñandú\tñ\r\nÇa", "tab\tnew\nline\x0bv\x0cf", "soft\u00adhyphen", "!!??...((("]
    for t in texts:
        assert tok.encode(t) == b"".join(i.to_bytes(4, "little") for i in encode(t)), repr(t)[:80]


# ------------------------------------------------------------------- op2
@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.Vocabulary.load(pieces.default_model()), max_units=100)


def plain_viterbi(codec, unit):
    table = {t: s for t, s, kind in codec.vocabulary.pieces if kind == "normal"}
    best = [0.0] + [float("-inf")] * len(unit)
    for e in range(1, len(unit) + 1):
        best[e] = best[e - 1] + codec.unknown
        for s in range(max(0, e - 16), e):
            if unit[s:e] in table:
                best[e] = max(best[e], best[s] + table[unit[s:e]])
    return best[-1]


def score(codec, ids):
    return sum(codec.vocabulary.pieces[i][1] if codec.vocabulary.pieces[i][2] == "normal" else 0.0 for i in ids)


def test_pieces_round_trip_and_best_score(codec, rows):
    import numpy as np

    texts = [t for _, t in rows[:40]] + ["", " ", "  a  b ", "\n", "\n\n x\n", "▁ ▁▁a", "a ▁", "☃é\x00", " lead", "trail ", "naïve 中文 🙂"]
    for t in texts:
        assert codec.decode(codec.encode(t)) == t
    for t in texts:  # units are independent: the whole text has no better segmentation
        if "▁" in t or not t or len(t) > 3000:
            continue
        whole = ("▁" + t.replace(" ", "▁"))
        ids = np.frombuffer(codec.encode(t), dtype="<u4").tolist()
        unknown = sum(1 for c in whole if not codec.automaton.exists(c))
        assert score(codec, ids) + unknown * codec.unknown == pytest.approx(plain_viterbi(codec, whole))


def test_pieces_score_no_worse_than_the_library(codec):
    """The library's own Viterbi over the same pieces (single precision) never
    finds a better segmentation."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(pieces.default_model(), "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    sp = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    for t in ["hello world", "the quick brown fox", "tionsheren thththe", "Straße über"]:
        import numpy as np
        ours = np.frombuffer(codec.encode(t), dtype="<u4").tolist()
        assert score(codec, sp.encode(t)) <= score(codec, ours)


def test_pieces_table(frame):
    out = pieces.encode_documents(frame(ODD_ROWS)).collect()
    assert len(out) == len(ODD_ROWS)
    expected = sorted((d is None, d or 0, len(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in ODD_ROWS)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.decoded_sha256) for r in out) == expected
    assert all((r.n_pieces == 0) == (r.n_chars == 0) for r in out)
    assert pieces.encode_documents(frame([])).count() == 0


# ------------------------------------------------------------------- op3
def test_licenses(frame):
    notice = licenses.TEMPLATES["mit"]
    texts = [
        (1, "The MIT License, and the Apache  License. mit-license"), (2, notice), (3, None), (4, ""),
        (5, "x " * 10 + notice.replace("free of", "totally free of")), (6, "GENERAL public\nLICENSE"), (7, "general public"),
        (8, "Licensed under CC BY-NC 4.0."), (None, "apache license"), (9, "permission denied"), (9, "permission denied"), (10, "mit"),
    ]
    out = {(r.doc_id, r.n_words): r for r in licenses.scan(frame(texts)).collect()}
    assert licenses.scan(frame(texts)).count() == len(texts)
    one = out[1, 9]
    assert (one.n_base, one.first_word, one.last_word, one.base_labels) == (3, 1, 7, "apache,mit")
    two = out[2, len(notice.split())]
    assert (two.n_base, two.first_word, two.labels, two.score) == (0, None, "mit", 1.0)
    assert (out[3, 0].n_base, out[3, 0].labels, out[3, 0].score) == (0, "", 0.0)
    shifted = out[5, len(notice.split()) + 11]
    assert shifted.labels == "mit" and 0.6 <= shifted.score < 1.0  # two diagonals, merged
    assert out[6, 3].base_labels == "gpl" and out[7, 2].labels == ""
    assert out[8, 7].labels == "cc-by-nc" and out[8, 7].base_labels == ""
    assert out[None, 2].base_labels == "apache" and out[10, 1].labels == ""
    assert licenses.scan(frame([])).count() == 0


def test_licenses_whole_notices_and_variants(frame):
    from cartwheel.llm.notices import notices
    whole = {text[:40]: (label, text) for label, text, _ in notices() if len(text) > 500}
    body = [text for label, text in whole.values()]
    says = [label for label, text in whole.values()]
    cc = "This work is licensed under a Creative Commons Attribution{} License and so on"
    texts = [cc.format(" 4.0 International"), cc.format("-NonCommercial-ShareAlike 4.0 International"), cc.format("-NoDerivs 3.0 Unported"),
             cc.format("-Non-Commercial 2.0 Generic"), "is licensed under CC BY-NC-ND 4.0 now", "is licensed under CC BY 4.0 now",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
             "Public License as published by the Free Software Foundation", "This is free and unencumbered software released into the public domain."]
    want_cc = ["cc-by", "cc-by-nc-sa", "cc-by-nd", "cc-by-nc", "cc-by-nc-nd", "cc-by", "agpl,gpl", "unlicense"]
    out = {r.doc_id: r.labels for r in licenses.scan(frame(list(enumerate(texts + body)))).collect()}
    assert [out[i] for i in range(len(texts))] == want_cc
    for i, label in enumerate(says, len(texts)):  # base phrases add theirs
        assert set(out[i].split(",")) - {"gpl", "apache"} == {label} - {"gpl", "apache"} and label in out[i].split(","), (body[i - len(texts)][:60], out[i])


# ------------------------------------------------------------------- op4
def test_jaccard_small_table(documents, rows):
    assert got(jaccard.similarity_classes(documents), "doc_id", "n_shingles", "component_id") == want(brute.classes(rows))


def test_jaccard_odd_rows(frame):
    df = jaccard.similarity_classes(frame(ODD_ROWS))
    assert got(df, "doc_id", "n_shingles", "component_id") == want(brute.classes(ODD_ROWS))
    assert jaccard.similarity_classes(frame([])).count() == 0


def near_copies(n=120, seed=5):
    """Groups of near copies at all distances around the threshold, with a line
    that all texts share."""
    rng = random.Random(seed)
    line = "this very line stands in each of the texts here"
    out = []
    for g in range(4):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([20, 60, 150]))]
        for _ in range(n // 4):
            w = list(base)
            for _ in range(rng.randint(0, max(2, len(w) // 18))):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 10**6)}"
            out.append(line + " " + " ".join(w))
    rng.shuffle(out)
    return list(enumerate(out + out[:7]))


def test_jaccard_near_copies_and_tiny_blocks(frame):
    rows = near_copies()
    expected = want(brute.classes(rows))
    assert len({c for _, _, c in expected}) > 4
    assert got(jaccard.similarity_classes(frame(rows)), "doc_id", "n_shingles", "component_id") == expected
    # without pivots and with tiny blocks every link must come from the block search
    small = jaccard.JaccardParams(pivot_hashes=0, block_shingles=300)
    assert got(jaccard.similarity_classes(frame(rows), small), "doc_id", "n_shingles", "component_id") == expected


def test_divide_skip_finds_every_link():
    from cartwheel.llm.words import WordHashes

    h, p = WordHashes(), jaccard.JaccardParams()
    sets = [jaccard.shingles(t.encode().split(), h, 5) for _, t in near_copies(80, 9)]
    found = set(jaccard.divide_skip(sets, sets, p))
    assert found == {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if jaccard.linked(a, b, 80)}


def test_deduplicate_keeps_one_row_of_each_class(frame):
    rows = near_copies() + ODD_ROWS
    kept = jaccard.deduplicate(frame(rows))
    classes = brute.classes(rows)
    out = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    blank = [(d, t) for (d, t), (_, n, _) in zip(rows, classes) if n == 0]
    assert sorted((x for x in out if not brute.shingle_set(x[1])), key=repr) == sorted(blank, key=repr)
    # one row per class; rows under one id can be several classes
    sets = {frozenset([(d, c)]) for d, n, c in classes if n and c is not None}
    assert sorted({d for d, t in out if brute.shingle_set(t)}) == sorted({c for s in sets for _, c in s})
    assert len(out) == len(set(out))
    assert kept.columns == frame(rows).columns


# ------------------------------------------------------------------- op5
def chat_expected(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn, role or "", text or ""))
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((c, len(turns), brute.sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), brute.sha(loss),
                    sum(len(chat.format_turn(r, t)[0]) for _, r, t in turns)))
    return out


CHAT_COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "</s>"),
    (3, 0, "user", "hi"), (3, 1, "assistant", "bye \\"), (4, 0, "system", "<<SYS>>\\"), (4, 1, None, None), (4, 1, "a|b>%", "x<|"),
    (4, 2, "user", "|>\\\\[INST] \\[/INST]\\"), (None, 0, "user", "hi"), (5, None, "user", None), (6, 0, "assistant", ""),
    (7, 0, "user", "hi"), (7, 0, "user", "hi"), (8, 0, "end", "<|end|>"), (9, 0, "user", "z" * 50000),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("path", F.lit("x"))
    forest = chat.build_forest(df)
    assert got(chat.read_back(forest), *CHAT_COLUMNS) == want(chat_expected(CHATS))
    nodes = forest.nodes.collect()
    # the stream has no gap, and shared turns are emitted once
    at = 0
    for r in sorted(nodes, key=lambda r: r.start):
        assert r.start == at
        at += r.units
    assert sum(r.body == "[INST]hi[/INST]" and r.depth == 0 for r in nodes) == 1
    # ancestors' intervals hold exactly what stands before a node
    by = {r.node: r for r in nodes}
    stream = "".join(r.body for r in sorted(nodes, key=lambda r: r.start))
    for r in nodes:
        before, up = "", r.parent
        while up is not None:
            before, up = by[up].body + before, by[up].parent
        assert "".join(stream[a:b] for a, b in r.attends) == before and r.position == len(before)
    # depth first: a node's parent stands before it with only its own subtree between
    order = sorted(nodes, key=lambda r: r.start)
    stack = []
    for r in order:
        while stack and stack[-1] != r.parent:
            stack.pop()
        assert r.parent is None or stack
        stack.append(r.node)
    empty = chat.build_forest(df.limit(0))
    assert chat.read_back(empty).count() == 0 and empty.nodes.count() == 0


def test_chat_escape_is_reversible():
    rng = random.Random(1)
    parts = ["\\", "<", "[", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>", "<|end|>", "a", "/", "|", "S"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "tool", ""]), "".join(rng.choices(parts, k=rng.randint(0, 8)))) for _ in range(3)]
        assert chat.parse("".join(chat.format_turn(r, t)[0] for r, t in turns)) == turns


def test_chat_long_conversation_is_rows(spark):
    """A conversation of a third of all rows: no cell and no task's memory grows
    with its turns, also where others part from it or end on it."""
    long = [(None, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(6000)]
    others = [(c, t, r, x) for c in range(1, 40) for _, t, r, x in long[:7 * c]]
    others += [(c, 7 * c, "user", f"parts {c}") for c in range(1, 40, 2)]
    forest = chat.build_forest(spark.createDataFrame(long + others, "conv_id long, turn long, role string, text string"))
    assert got(chat.read_back(forest), *CHAT_COLUMNS) == want(chat_expected(long + others))
    assert forest.leaves.agg(F.max(F.length("path"))).first()[0] == 16
    assert forest.paths.agg(F.max(F.length("path"))).first()[0] == 16 and "path" not in forest.steps.columns
    nodes = {r.node: r for r in forest.nodes.collect()}
    stream = "".join(r.body for r in sorted(nodes.values(), key=lambda r: r.start))
    whole = {None: ""}
    for r in sorted(nodes.values(), key=lambda r: r.depth):
        before, whole[r.node] = whole[r.parent], whole[r.parent] + r.body
        assert "".join(stream[a:b] for a, b in r.attends) == before and r.position == len(before)
        assert all(a[1] < b[0] for a, b in zip(r.attends, r.attends[1:]))


def test_chat_reads_pieces():
    turns = [("user", "a </s> b\\"), ("", "<|x|>"), ("assistant", "[INST]"), ("user", "")]
    text = "".join(chat.format_turn(r, t)[0] for r, t in turns)
    ends = [sum(len(chat.format_turn(r, t)[0]) for r, t in turns[:k]) for k in range(5)]
    assert list(chat.read_turns(text[a:b] for a, b in zip(ends, ends[1:]))) == chat.parse(text) == turns


# ------------------------------------------------------------------- op6
def test_language_held_out_accuracy(spark):
    out = queries.op6_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all() and len(out) == 1000


def test_language_odd_rows(frame, documents):
    model = langid.fit(documents.select("doc_id", "text", "lang"))
    out = frame([(1, None), (2, ""), (3, "12 34 !!"), (4, "the thing is that of the"), (None, "und der nicht"), (5, "中文")]) \
        .withColumn("p", langid.prediction_column(model)).select("doc_id", "p.*").collect()
    pred = {r.doc_id: r for r in out}
    assert [pred[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and not pred[1].accepted
    assert pred[4].lang_pred == "en" and pred[5].lang_pred != "und"
    kept = langid.language_filter(documents)
    assert kept.columns == documents.columns and 0.97 * documents.count() <= kept.count()
    none = langid.fit(documents.limit(0))
    assert none.dictionaries == {} and langid.language_filter(documents.limit(0)).count() == 0
    clash = documents.selectExpr("*", "'x' as __lang", "doc_id as p", "1 as h", "1 as bound")
    assert langid.language_filter(clash).columns == clash.columns and langid.language_filter(clash).count() == kept.count()


def test_language_by_plain_compression(documents, rows):
    model = langid.fit(documents.filter("doc_id % 2 = 0"))
    rows = rows + [(10**6 + i, t) for i, t in enumerate([None, "", "12 34 !!", "ÀÉ ß", "中文", "The thing. " * 5000, "zz" * 300_000, "the der les que"])]
    table = documents.sparkSession.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in table.select("doc_id", langid.prediction_column(model).alias("p")).select("doc_id", "p.*").collect()}
    assert len(out) == len(rows) and all(len(d) <= model.params.dictionary_bytes for d in model.dictionaries.values())
    for doc_id, text in rows:
        assert (out[doc_id].lang_pred, out[doc_id].score, out[doc_id].accepted) == brute.language(text, model.dictionaries)


def test_language_any_number_of_labels(spark):
    """No cap on languages: dictionaries and samples shrink instead; a hot one and repeated rows change nothing."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    stems = {f"l{k:03d}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(40)] for k in range(100)}
    text = lambda lang: " ".join(rng.choice(stems[lang]) for _ in range(60))
    train = [(i, text(lang), lang) for i, lang in enumerate([*stems] * 4 + ["l000"] * 300)]
    model = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), langid.LangParams(total_bytes=100 * 1024, sample_docs=400))
    assert len(model.dictionaries) == 100 and next(iter(model.dictionaries)) == "l000"
    assert sum(map(len, model.dictionaries.values())) <= 100 * 1024
    ask = [(i, text(lang), lang) for i, lang in enumerate(stems)]
    got_ = spark.createDataFrame(ask, "doc_id long, text string, lang string").select("lang", langid.prediction_column(model).alias("p")).collect()
    assert sum(r.lang == r.p.lang_pred for r in got_) >= 95


def test_language_shares_use_every_text():
    assert langid.shares([], 100) == [] and langid.shares([b"ab", b"c"], 100) == [b"ab", b"c"]
    parts = langid.shares([b"a" * 50, b"b" * 3, b"c" * 80], 63)
    assert parts == [b"a" * 28, b"b" * 3, b"c" * 28] and len(b" ".join(parts)) <= 63
    assert all(len(b" ".join(langid.shares([b"x" * n for n in range(40)], room))) <= room for room in (60, 100, 500, 5000))


# ------------------------------------------------------------------- op7
def test_substring_small_table(documents, rows):
    assert got(substring.digests(documents), "doc_id", "n_words", "n_removed", "kept_sha256") == want(brute.substring(rows))


def passages(seed=2):
    rng = random.Random(seed)
    shared = [[f"p{k}x{i}" for i in range(n)] for k, n in enumerate([34, 35, 36, 60, 200])]
    out = []
    for d in range(40):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [f"d{d}u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 50))]
            part = rng.choice(shared)
            a = rng.randint(0, 3)
            w += part[a:] if rng.random() < 0.3 else part
        out.append((d, " ".join(w)))
    out += [(100, "a " * 36), (101, "b " * 35), (102, "loop one two " * 40), (103, out[0][1]), (104, out[1][1].replace(" ", "\n"))]
    return out


def test_substring_passages_and_odd_rows(frame):
    for rows in (passages(), passages(8) + ODD_ROWS):
        assert got(substring.digests(frame(rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == want(brute.substring(rows))
    assert substring.digests(frame([])).count() == 0


def test_remove_repeats_changes_only_what_repeats(frame):
    rows = passages() + ODD_ROWS
    out = substring.remove_repeats(frame(rows))
    assert out.columns == frame(rows).columns
    texts = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
    expected = {(d, n, s) for d, n, r, s in brute.substring(rows) if r}
    whole = {(d, t) for (d, t), x in zip(rows, brute.substring(rows)) if not x[2]}
    for d, t in texts:
        assert (d, t) in whole or any(d == e[0] and brute.sha(t) == e[2] for e in expected)


# ------------------------------------------------------------------- op8
def plain_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = brute.lower(rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
           if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_url_filter(spark):
    urls = ["http://a.example.net/en/x", "https://EXAMPLE.net/de/?q", "http://x.org/fr", "http://x.org/fr/1#t", None, "", "no scheme/net/",
            "http://net", "http://net/", "http://notnet/", "ftp://u@b.example.com:8/de/", "http://b.example.com/de/y?z#w", "a://b.net/x://c.org/fr/",
            "http://example.net/en", "http://..net/", "http://a.b.c.d.org/fr/\nx", "http://?x/", "HTTP://Ärger.NET/"]
    rules = queries.URL_RULES
    df = spark.createDataFrame(list(enumerate(urls + urls[:3])), "page_id long, url string").withColumn("rule", F.lit("x")).withColumn("short", F.lit(1))
    table = spark.createDataFrame(rules, urlfilter.RULES_SCHEMA)
    expected = [(i, *plain_rule(u, rules)) for i, u in enumerate(urls + urls[:3])]
    assert got(urlfilter.match_rules(df, table), "page_id", "host", "path", "rule", "verdict") == want(expected)
    odd = rules + [(None, "/", "block"), ("", "/", "block"), ("net", None, "block"), ("b.net", "", "block"), ("net", "/x:", "allow"), ("net", "/", "allow")]
    expected = [(i, *plain_rule(u, odd)) for i, u in enumerate(urls + urls[:3])]
    assert got(urlfilter.match_rules(df, spark.createDataFrame(odd, urlfilter.RULES_SCHEMA)), "page_id", "host", "path", "rule", "verdict") == want(expected)
    assert {r.verdict for r in urlfilter.match_rules(df, table.limit(0)).collect()} == {"allow"}
    assert urlfilter.match_rules(df.limit(0), table).count() == 0


def test_url_filter_very_long_hosts_and_paths(spark):
    rules = queries.URL_RULES + [("a.b.example.com", "/", "block"), ("x.", "/", "block")]
    urls = ["http://" + "a." * 8000 + "example.net/en/x", "http://" + "b." * 8000 + "net/", "http://x.org/fr/" + "y/" * 100_000,
            "http://" + "." * 5000 + "org/fr/", "http://a.b.example.com/", "http://b.example.com/", "http://c.x./", "http://" + "q" * 100_000 + "/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = urlfilter.match_rules(df, spark.createDataFrame(rules, urlfilter.RULES_SCHEMA))
    expected = [(i, *plain_rule(u, rules)) for i, u in enumerate(urls)]
    assert got(out, "page_id", "host", "path", "rule", "verdict") == want(expected)


# ------------------------------------------------------------------- op9
def plain_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (sa, a1, a2), (sb, b1, b2) = a.split(":"), b.split(":")
    near = lambda x, y: 1 - plain_levenshtein(x, y) / max(len(x), len(y)) if x or y else 0.0
    sa, sb = int(sa), int(sb)
    if sa == sb:
        return max(near(a1, b1), near(a2, b2))
    return near(a1, b2) if sa == 2 * sb else near(a2, b1) if 2 * sa == sb else 0.0


def fingerprint_expected(rows):
    order = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0), x[1].encode()))
    out = []
    for k, (d, t) in enumerate(order):
        follower = order[(k + 1) % len(order)][1]
        n = len(t) // 3
        change = t[:len(t) - n] + follower[:n]
        a, b, c = (brute.fingerprint(x.encode()) for x in (t, change, follower))
        out.append((d, len(t), brute.sha(change), a, b, round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)))
    return out


def test_fingerprints(documents, rows, frame):
    for df, data in ((documents, rows), (frame(ODD_ROWS), ODD_ROWS), (frame([(7, "alone in the table")]), [(7, "alone in the table")])):
        out = fingerprint.fingerprints(df)
        out = out.withColumn("a", F.round("near_edited", 9)).withColumn("b", F.round("near_next", 9))
        assert got(out, "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "a", "b") == want(fingerprint_expected(data))
    assert fingerprint.fingerprints(frame([])).count() == 0


def test_fingerprints_byte_by_byte_and_in_slices():
    rng = random.Random(4)
    texts = [b"", b"a", b"\xff" * 7, b"ab" * 40, b"word1 " * 300, b"other " * 300, bytes(rng.randrange(256) for _ in range(5000)),
             b" ".join(b"%d" % rng.randrange(50) for _ in range(3000)), b"x" * 3000, b"same line of a table\n" * 200 + b"and an end"]
    small = [fingerprint.FingerprintParams(slice_bytes=k) for k in (1, 5, 64, 1000, 4999, 5000)]
    for text in texts:
        expected = brute.fingerprint(text)
        assert fingerprint.fingerprint(text) == expected
        for p in small if len(text) < 6000 else small[2:]:
            assert fingerprint.fingerprint(text, p) == expected, (text[:20], p)
    assert fingerprint.fingerprint(texts[4]).split(":")[1] != fingerprint.fingerprint(texts[5]).split(":")[1]


def test_fingerprints_of_varied_texts_are_whole(rows):
    """Texts of 200 bytes or more with varied content have signatures of 16 characters or more; very long ones too."""
    long = [t for _, t in rows if t and len(t.encode()) >= 200] + [" ".join(f"w{i * 7919 % 10007}" for i in range(300_000)), "line of a log\n" * 100_000 + "end"]
    assert len(long) > 50
    for text in long:
        _, one, two = fingerprint.fingerprint(text.encode()).split(":")
        assert 16 <= len(one) <= 128 and len(two) <= 64


def test_fingerprints_tell_edits_from_strangers(spark):
    out = fingerprint.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("n_chars >= 60").toPandas()
    assert out.near_edited.median() > 0.5 and out.near_next.median() < 0.25
    assert (out.near_edited > out.near_next).mean() > 0.97


# ------------------------------------------------------------------ op10
def test_quality_counts(documents, rows, frame):
    for df, data in ((documents, rows), (frame(ODD_ROWS + [(20, "a\na\n \n \na\r\nb c d e f b c d e f b")]), ODD_ROWS + [(20, "a\na\n \n \na\r\nb c d e f b c d e f b")])):
        out = df.select("doc_id", quality.features_column("text").alias("f")).select("doc_id", *[f"f.{c}" for c in quality.COUNTS])
        assert got(out, *out.columns) == want((d, *brute.quality_counts(t)) for d, t in data)


def test_quality_separates_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op10_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    good, bad = out[out.quality == 1], out[out.quality == 0]
    assert (good[~good.base_failed].kept).mean() > 0.97 and bad.kept.mean() < 0.1
    assert (out.base_failed == ((out.n_words < 10) | (100 * out.n_repeat_words > 20 * out.n_words))).all()
    assert not (out.kept & out.base_failed).any()


def test_quality_verdicts_follow_plain_paths(spark, documents, rows):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    stats = quality.document_statistics(documents)
    model = quality.fit(stats, labels)
    judged = {r.doc_id: r for r in quality.judge(stats.withColumn("good", F.lit("x")), model).collect()}
    assert len(judged) == len(rows)
    for doc_id, text in rows:
        counts, vector = brute.quality_counts(text), [float(x) for x in quality.features(text, quality.WordHashes())[len(quality.COUNTS):]]
        score = brute.forest_score(model.forest, [abs(a - b) for a, b in zip(vector, model.medians)])
        n, _, _, _, rep = counts
        r = judged[doc_id]
        assert abs(r.score - score) < 1e-9 and r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert r.kept == (not r.base_failed and score < model.threshold)


def test_quality_rejects_oddity_on_either_side(spark, frame):
    """Too little of something is as odd as too much; very long words and texts have finite vectors."""
    rng = random.Random(3)
    junk = [" ".join(rng.choice("abcdefghij") for _ in range(60)),
            " ".join("".join(rng.choice("bcdfghklm") for _ in range(rng.randint(1, 3))) for _ in range(200)),
            " ".join("".join(rng.choice(".,;:?!-()") for _ in range(rng.randint(1, 3))) for _ in range(200)),
            " ".join("q" * 5000 + str(i) for i in range(12)), "z" * 2_000_000 + " a b c d e f g h i j",
            " ".join(str(rng.random()) for _ in range(200))]
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(quality.document_statistics(docs), spark.read.parquet(f"{sf}/labels.parquet"))
    clean = docs.join(spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 and doc_id > 9"), "doc_id").select("doc_id", "text").orderBy("doc_id").limit(50)
    mixed = frame([(-1 - i, t) for i, t in enumerate(junk)] + [tuple(r) for r in clean.collect()] + ODD_ROWS)
    judged = quality.judge(quality.document_statistics(mixed), model).collect()
    assert len(judged) == len(junk) + 50 + len(ODD_ROWS)
    assert not any(r.kept for r in judged if (r.doc_id or 0) < 0)
    regular = [r for r in judged if (r.doc_id or 0) > 9 and not r.base_failed]
    assert len(regular) >= 45 and sum(r.kept for r in regular) >= len(regular) - 1


def test_quality_without_labels(spark, frame, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    stats = quality.document_statistics(frame(ODD_ROWS))
    model = quality.fit(stats, labels)
    judged = quality.judge(stats, model)
    assert judged.count() == len(ODD_ROWS) and judged.filter("kept and base_failed").count() == 0
    lab = spark.read.parquet(f"{SMALL}/labels.parquet").unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 0, 0)], "doc_id long, quality long, toxic long"))
    kept = quality.quality_filter(spark, documents, lab)
    assert kept.columns == documents.columns and 0 < kept.count() <= documents.count()
    assert quality.quality_filter(spark, documents.limit(0), lab).count() == 0


def test_code_runs_in_workers_without_the_package():
    """Functions travel by value: no operator refers to this package by name."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = cloudpickle.dumps((jaccard.shingles, jaccard.WordHashes, quality.features))
    code = ("import sys, pickle; f, h, q = pickle.loads(sys.stdin.buffer.read()); assert len(f(b'a b c d e f'.split(), h(), 5)) == 2; "
            "assert q('a b', h())[0] == 2; assert 'cartwheel' not in sys.modules")
    subprocess.run([sys.executable, "-c", code], input=blob, check=True, cwd="/", env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_remove_repeats_keeps_columns_of_any_name(frame):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = frame([(1, f"a {passage} b"), (2, f"{passage} c"), (3, None), (4, "d")]).selectExpr(
        "*", "'k' as __tkey", "'a' as __anchors", "doc_id as ___copies", "array(doc_id) as windows")
    got = substring.remove_repeats(docs)
    assert got.dtypes == docs.dtypes
    assert {r.doc_id: r.text for r in got.collect()} == {1: "a b", 2: "c", 3: None, 4: "d"}
    assert got.drop("text", "n_chars").collect() and sorted(map(repr, got.drop("text", "n_chars").collect())) == sorted(
        map(repr, docs.drop("text", "n_chars").collect()))


def test_repeats_pack_only_buckets_that_have_rows():
    import numpy as np

    from cartwheel.llm import repeats

    keys = [bytes([i]) * 16 for i in range(5)]
    h = np.arange(1, 51, dtype=np.uint64)
    packed = list(repeats._block(keys, np.split(h, 5), 1 << 20))
    assert len(packed) == 50 and all(k for _, _, k, _, _ in packed)
    got, owner, back = repeats._unpack([r[2:] for r in packed])
    assert sorted(zip((got[o] for o in owner), back.tolist())) == sorted((keys[i // 10], i + 1) for i in range(50))
