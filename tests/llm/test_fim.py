"""Fill-in-the-middle against a plain version by regular expression and string
concatenation, and the piece table's own rules."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from cartwheel.llm import fim
from llm.conftest import ODD_ROWS

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    t = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    prefix, middle, suffix = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(t), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(t), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(t), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(df, rows):
    made = fim.transform(df)
    expected = sorted((plain(*r) for r in rows), key=repr)
    assert sorted((tuple(r) for r in made.collect()), key=repr) == expected
    back = sorted((tuple(r) for r in fim.restore(made).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t in rows), key=repr)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    digests = sorted((tuple(r) for r in fim.digests(made).collect()), key=repr)
    texts = {(i, sha(t or "")) for i, t in rows}
    assert [d[:6] for d in digests] == sorted(((*e[:5], sha(e[5])) for e in expected), key=repr)
    assert {(d[0], d[6]) for d in digests} == texts


def test_small_table(documents, rows):
    check(documents, rows)
    assert {plain(*r)[2] for r in rows} == {"plain", "psm", "spm"}


def test_odd_rows(frame):
    extra = [(i, t) for i in range(20, 60) for t in ("x", " ", "a b", " a b\n", "<P", "a<S>b", "<M>", "é ☃\u2003z", "<P<S> <M", ">< M>")]
    check(frame(ODD_ROWS + extra), ODD_ROWS + extra)
    check(frame([]), [])


def test_very_long_texts(frame):
    """Longer than a block; one of them is a single token, one has none."""
    rnd = random.Random(3)
    words = " ".join("wörd"[:rnd.randrange(1, 5)] for _ in range(900_000))
    rows = [(i, t) for i in (1, 2, 3, 5, 8, 13) for t in (words, "x" * 2_500_000, " " * 2_200_000, "ab " * 349_526)]
    check(frame(rows, extra=False), rows)


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_tokens_across_blocks(monkeypatch, block):
    monkeypatch.setattr(fim, "_BLOCK", block)
    rnd = random.Random(block)
    for _ in range(300):
        text = "".join(rnd.choice("ab \t\né") for _ in range(rnd.randrange(12)))
        tokens = TOKEN.findall(text)
        places = [len("".join(tokens[:k]).encode()) for k in range(len(tokens) + 1)]
        data = text.encode()
        assert fim.count_tokens(data) == len(tokens)
        assert fim.token_places(data, range(len(tokens) + 1)) == places
        assert fim.characters(memoryview(data)) == len(text)


def test_arrangements_and_inverses():
    for form, order in fim.ORDERS.items():
        table = fim.PieceTable.of(b"0123456789")
        table.cut([3, 3])
        table.cut([7])
        assert [bytes(v) for v in table.views()] == [b"012", b"", b"3456", b"789"]
        three = fim.PieceTable.of(b"aabbcc")
        three.cut([2, 4])
        assert three.arrange(order).arrange(fim.inverse(order)).pieces == three.pieces


def test_sentinels_that_could_merge_are_refused():
    for bad in (("<P>", "<P>", "<S>"), ("", "a", "b"), ("ab", "bc", "d"), ("aa", "x", "aaa"), ("aba", "c", "d")):
        with pytest.raises(ValueError):
            fim.FimParams(sentinels=bad)
    with pytest.raises(ValueError):
        fim.restore_text(b"no sentinel", "psm", fim.FimParams())
