"""Quality rules: an isolation forest over rule statistics.

Each text becomes a vector of rule statistics (counts and shares of symbols,
repeated lines and words, capitals, ...). Random trees split a bounded sample
of labelled vectors at random values; a vector that few splits part from the
good ones is unlike them, and its path is short. Scores follow Liu, Ting and Zhou (2008):
``2 ** (-mean path / c(sample))``, 0 to 1, higher is more anomalous. The
threshold is read off the scores of *all* labelled rows.

A statistic counts by its distance from the good rows' median, so too little of
something is as odd as too much. All statistics are shares or level off, and
none is cut: texts of any length and words of any length have a finite vector.

Only the forest's training sample is bounded (``sample_rows``, the rows whose
ids have the smallest hashes); statistics, scores and the calibration cover
every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.words import WordHashes, trim, values, window_hashes
from cartwheel.plans.sink import materialize

SYMBOLS = b"#*$%&|<>"  # fixed values of the rule
_SPACE = b" \t\n\v\f\r"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = ["symbol_share", "dup_line_share", "repeat_share", "capital_share", "digit_share",
              "mark_share", "shout_share", "word_length"]
_USUAL_WORD = 5  # characters; where word_length is one half
FEATURES_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]
                             + [T.StructField(s, T.DoubleType()) for s in STATISTICS])


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    tree_rows: int = 256        # rows that grow one tree
    depth: int = 20             # cuts on a path at most
    sample_rows: int = 8192     # bound of the labelled rows that the driver gathers
    max_good_lost: float = 0.005  # share of good-labelled rows the threshold may reject
    min_words: int = 10
    max_repeat_pct: int = 20
    seed: int = 7


def repeat_words(w: np.ndarray, size: int = 5) -> int:
    """Words covered by windows of ``size`` words that occur twice or more."""
    h = window_hashes(w, size)
    if len(h) < 2:
        return 0
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(h), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    edge = np.zeros(len(w) + 1, dtype=np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def features(text: str | None, hashes: WordHashes) -> tuple:
    """Counts of the base rules, then the statistics the forest sees."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    n_chars = len(text or "")
    word_chars = n_chars - (len(data) - len(data.translate(None, _SPACE)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    n_dup = len(lines) - len(set(lines))
    n_rep = repeat_words(hashes.of(words)) if n >= 6 else 0
    chars = max(word_chars, 1)
    count = lambda of: len(data) - len(data.translate(None, of))
    share = (n_symbols / chars, n_dup / max(len(lines), 1), n_rep / max(n, 1),
             count(_UPPER) / chars, count(_DIGITS) / chars, count(_MARKS) / chars,
             data.count(b"!!") / max(n, 1), word_chars / max(word_chars + _USUAL_WORD * n, 1))
    return (n, word_chars, n_symbols, n_dup, n_rep, *share)


def features_column(text: str | Column = "text") -> Column:
    """Struct of :data:`COUNTS` and :data:`STATISTICS` of a string column."""
    names = COUNTS + STATISTICS
    types = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(STATISTICS)

    @F.arrow_udf(FEATURES_TYPE)
    def of(texts: pa.Array) -> pa.Array:
        hashes = WordHashes()
        columns = list(zip(*(features(t, hashes) for t in values(texts)))) or [()] * len(names)
        out = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        del hashes
        trim()
        return out
    return of(F.col(text) if isinstance(text, str) else text)


# ------------------------------------------------------------------ forest
def _mean_path(n: float) -> float:
    """Mean depth at which a random tree over n rows isolates one."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n if n > 2 else 1.0


class IsolationForest:
    """Trees as flat arrays; plain numpy, small enough to ship to every task.

    ``rows`` (the regular ones) decide where a tree stops; ``box`` (low and
    high of every statistic, irregular rows included) is what the random cuts
    divide. So a statistic that is the same in all regular rows is still cut,
    and a row outside their region falls into an empty leaf after few cuts."""

    def __init__(self, rows: np.ndarray, box: tuple[np.ndarray, np.ndarray], params: ForestParams):
        rng = np.random.default_rng(params.seed)
        take = max(min(params.tree_rows, len(rows)), 1)
        self.norm = max(_mean_path(take), 1e-9)
        self.trees = []
        if len(rows):
            for _ in range(params.trees):
                part = rows[rng.choice(len(rows), take, replace=False)]
                self.trees.append(self._grow(part, box, params.depth, rng))

    @staticmethod
    def _grow(rows, box, depth, rng):
        feature, value, left, right, path = [], [], [], [], []

        def node(part, low, high, level):
            i = len(feature)
            feature.append(0), value.append(0.0), left.append(i), right.append(i)
            path.append(level + _mean_path(len(part)))
            free = np.flatnonzero(high > low)
            if level < depth and len(part) > 1 and len(free):
                f = int(rng.choice(free))
                cut = float(rng.uniform(low[f], high[f]))
                below = part[:, f] <= cut
                feature[i], value[i] = f, cut
                up, down = high.copy(), low.copy()
                up[f] = down[f] = cut
                left[i] = node(part[below], low, up, level + 1)
                right[i] = node(part[~below], down, high, level + 1)
            return i

        node(rows, *box, 0)
        return (np.array(feature), np.array(value), np.array(left), np.array(right), np.array(path), depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        at_row = np.arange(len(x))
        for feature, value, left, right, path, depth in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = np.where(x[at_row, feature[at]] <= value[at], left[at], right[at])
            total += path[at]
        return 2.0 ** (-(total / len(self.trees)) / self.norm)


@dataclass(frozen=True)
class QualityModel:
    forest: IsolationForest
    medians: np.ndarray
    threshold: float
    params: ForestParams

    def vectors(self, x: np.ndarray) -> np.ndarray:
        """Distances from the good rows' medians, on either side."""
        return np.abs(np.nan_to_num(x) - self.medians)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.forest.score(self.vectors(x))


def with_labels(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``stats(doc_id, f)`` that a label covers, with ``good`` (0/1).

    Several labels of one id count as good only if all are; rows with a null
    id or a null label are not labelled."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"))
                 .dropna().groupBy("doc_id").agg(F.min("q").alias("good")))
    return stats.join(lab, "doc_id")


def fit(stats: DataFrame, labels: DataFrame, params: ForestParams = ForestParams()) -> QualityModel:
    """``stats``: ``doc_id`` and struct ``f`` of :func:`features_column`,
    already materialised (it is read a few times). Extra columns are ignored.
    Rows of equal ids are all labelled; equal vectors are interchangeable, so
    ties in the sample's order change nothing. Without any good-labelled row
    the forest is empty, scores are 0 and only the base rules decide."""
    labelled = with_labels(stats.select("doc_id", "f"), labels)
    hashed = labelled.select(F.xxhash64("doc_id", *[F.col("f")[s] for s in STATISTICS]).alias("h"), "good",
                             *[F.col("f")[s].alias(s) for s in STATISTICS])
    # hashes in the lowest part of their range, where about twice the sample is
    # expected: only these reach the sort
    share = min(1.0, 2 * params.sample_rows / max(hashed.count(), 1))
    low = hashed.filter(F.col("h") <= F.lit(int(-2**63 + share * (2**64 - 2**11))))
    sample = low.orderBy("h", "good", *STATISTICS).limit(params.sample_rows).toPandas()
    rows = sample[STATISTICS].to_numpy(dtype=float)
    regular = rows[sample["good"].to_numpy() == 1]
    medians = np.median(regular, axis=0) if len(regular) else np.zeros(len(STATISTICS))
    rows, regular = np.abs(rows - medians), np.abs(regular - medians)
    box = (np.zeros(len(STATISTICS)), rows.max(axis=0) if len(rows) else np.zeros(len(STATISTICS)))
    model = QualityModel(IsolationForest(regular, box, params), medians, 1.0, params)
    if not model.forest.trees:
        return model
    bins = 1000  # the calibration's resolution: at most 2 * bins rows reach the driver
    hist = (labelled.filter(~base_failed(F.col("f"), params))
                    .withColumn("score", score_column(model, F.col("f")))
                    .groupBy(F.floor(F.col("score") * bins).cast("int").alias("bin"), "good")
                    .agg(F.count("*").alias("n")).toPandas())
    return QualityModel(model.forest, medians, calibrate(hist, bins, params.max_good_lost), params)


def calibrate(hist: pd.DataFrame, bins: int, max_good_lost: float) -> float:
    """The score above which rows are rejected: it gains the most (bad rows
    caught minus good rows lost, as shares) among thresholds that lose at most
    ``max_good_lost`` of the good rows; 1 (reject none) if none gains."""
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for b, g, n in hist[["bin", "good", "n"]].itertuples(index=False):
        (good if g == 1 else bad)[min(max(int(b), 0), bins)] += n
    lost = np.cumsum(good[::-1])[::-1] / max(good.sum(), 1)
    caught = np.cumsum(bad[::-1])[::-1] / max(bad.sum(), 1)
    gain = np.where(lost <= max_good_lost, caught - lost, -1.0)
    best = int(np.argmax(gain))
    return best / bins if gain[best] > 0 else 1.0


def score_column(model: QualityModel, f: Column) -> Column:
    @F.pandas_udf(T.DoubleType())
    def of(x: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score(x[STATISTICS].to_numpy(dtype=float)))
    return of(f)


def base_failed(f: Column, params: ForestParams = ForestParams()) -> Column:
    """Too few words, or too many of them in repeated five-word windows."""
    return (f["n_words"] < params.min_words) | (100 * f["n_repeat_words"] > params.max_repeat_pct * f["n_words"])


def judge(stats: DataFrame, model: QualityModel) -> DataFrame:
    """Adds ``base_failed, score, kept`` to rows that hold the struct ``f``."""
    out = stats.withColumn("score", score_column(model, F.col("f")))
    out = out.withColumn("base_failed", base_failed(F.col("f"), model.params))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") < model.threshold))


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, f`` of every row, written once (two readers follow)."""
    stats = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        features_column(F.col("text").cast("string")).alias("f"))
    return materialize(stats, "quality-stats")[0]


def quality_filter(spark: SparkSession, docs: DataFrame, labels: DataFrame,
                   params: ForestParams = ForestParams()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Null and empty texts have no words and go (base rule). Repeated rows are
    judged alike; a null ``doc_id`` only means no label. Empty tables give an
    empty result; extra columns pass whatever their names. The statistics are
    computed once and written beside the rows: fitting reads them alone, the
    decision reads both, and no text is shuffled."""
    temp = "__quality_f"
    while temp in docs.columns:
        temp += "_"
    told, _ = materialize(docs.withColumn(temp, features_column(F.col("text").cast("string"))), "quality-told")
    model = fit(told.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(temp).alias("f")), labels, params)
    ok = ~base_failed(F.col(temp), params) & (score_column(model, F.col(temp)) < model.threshold)
    return told.filter(ok).select(*docs.columns)
