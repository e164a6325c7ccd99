"""Plain, slow versions of what the operators return (no Spark, no hashing
tricks): one function per operator, over a list of rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WS = re.compile("[^\\x20\\x09-\\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------- op1
def pieces(rows, encode, capacity=2048, end_id=0):
    """{(doc_id, piece): (start, length, crc)}"""
    out = {}
    for doc_id, text in rows:
        ids = encode(text or "") + [end_id]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            out[doc_id, k // capacity] = (k, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
    return out


def best_fit_decreasing(lengths, capacity=2048):
    """Number of sequences that sequential best-fit decreasing needs."""
    gaps = Counter()
    n = 0
    for length in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= length and gaps[g]), default=None)
        if fit is None:
            n, fit = n + 1, capacity
        else:
            gaps[fit] -= 1
        gaps[fit - length] += 1
    return n


# ------------------------------------------------------------------- op4
def shingle_set(text, size=5):
    w = WS.findall(lower(text))
    if len(w) >= size:
        return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def classes(rows, percent=80):
    """[(doc_id, n_shingles, component_id)] by comparing every pair that shares a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    index, seen = defaultdict(list), {}
    for i, s in enumerate(sets):
        if not s:
            continue
        if s in seen:
            parent[find(i)] = find(seen[s])
            continue
        seen[s] = i
        count = Counter(j for x in s for j in index[x])
        for j, both in count.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
        for x in s:
            index[x].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            c = find(i)
            least[c] = min(least.get(c, doc_id), doc_id)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


# ------------------------------------------------------------------- op7
def substring(rows, size=35):
    """[(doc_id, n_words, n_removed, sha256 of kept)]"""
    words = [WS.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


# ------------------------------------------------------------------ op10
def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    w = WS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WS.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    rep = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, len(rep))


def forest_score(forest, vector):
    """Isolation score of one vector: every tree walked from its root, node by node."""
    paths = []
    for feature, value, left, right, path, _ in forest.trees:
        at = 0
        while left[at] != at:
            at = left[at] if vector[feature[at]] <= value[at] else right[at]
        paths.append(path[at])
    return 2.0 ** (-sum(paths) / len(paths) / forest.norm)


def _mixed(h):
    """The finalising mixer of 64-bit splitmix generators."""
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 % 2**64
    h ^= h >> 27
    h = h * 0x94D049BB133111EB % 2**64
    return h ^ h >> 31


def fingerprint(data, window=7, length=64, smallest=2, base=0x9E3779B97F4A7C15):
    """Piecewise hashes byte by byte, in whole numbers."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rolling = [_mixed(sum((data[i - j] + 1) * base**j for j in range(min(window, i + 1))) % 2**64) for i in range(len(data))]

    def signature(size, limit):
        out, chunk, place = "", 0, 1
        for i, byte in enumerate(data):
            chunk, place = (chunk + (byte + 1) * place) % 2**64, place * base % 2**64
            if i == len(data) - 1 or rolling[i] % size == size - 1 and len(out) < limit - 1:
                out, chunk, place = out + alphabet[_mixed(chunk) >> 58], 0, 1
        return out

    size = smallest
    while size * length < len(data):
        size *= 2
    while data and size > smallest and len(signature(size, 2 * length)) < length // 2:
        size //= 2
    return f"{size}:{signature(size, 2 * length)}:{signature(2 * size, length)}"


def language(text, dictionaries, block=4096, level=9, least=0.004):
    """Language, score and acceptance of one text, by encoding it once per dictionary."""
    import zstandard

    words = re.findall(r"[a-z\x80-\U0010FFFF]+", (text or "").lower())
    data = " ".join(words).encode()
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, False
    sizes = []
    for content in dictionaries.values():
        told = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        told.precompute_compress(level=level)
        z = zstandard.ZstdCompressor(level=level, dict_data=told, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(z.compress(data[i:i + block])) for i in range(0, len(data), block)))
    best, second = sorted(sizes)[:2]
    return list(dictionaries)[sizes.index(best)], (second - best) / second, (second - best) / second >= least
