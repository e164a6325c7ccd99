"""The corpus pipeline against plain versions of its stages."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from llm import brute
from llm.conftest import DOCUMENTS, ODD_ROWS, SMALL

from cartwheel.llm import quality
from cartwheel.llm.tokens import default_tokenizer


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_one_by_one(spark, documents):
    docs = documents
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "jaccard_join", "substring_dedup", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = _rows(docs)
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns
        after = _rows(docs)
        kept[name] = len(after)
        if name == "quality_rules":  # base rules, for certain
            for _, text in after:
                n, _, _, _, rep = brute.quality_counts(text)
                assert n >= 10 and 100 * rep <= 20 * n
            # the forest's verdicts, row by row, and most rows stay
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            stats = quality.document_statistics(spark.createDataFrame(before, "doc_id long, text string"))
            model = quality.fit(stats, labels)
            expected = []
            for doc_id, text in before:
                n, _, _, _, rep = brute.quality_counts(text)
                vector = quality.features(text, quality.WordHashes())[len(quality.COUNTS):]
                score = brute.forest_score(model.forest, [abs(a - b) for a, b in zip(vector, model.medians)])
                if n >= 10 and 100 * rep <= 20 * n and score < model.threshold:
                    expected.append((doc_id, text))
            assert sorted(after) == sorted(expected) and len(after) >= 0.75 * len(before)
        elif name == "jaccard_join":
            least = {c for _, n, c in brute.classes(before) if n}
            assert sorted(d for d, _ in after) == sorted(least | {d for d, n, _ in brute.classes(before) if not n})
        elif name == "substring_dedup":
            assert len(after) == len(before)
            texts = dict(after)
            for (d, text), (_, _, removed, sha) in zip(before, brute.substring(before)):
                assert texts[d] == text if not removed else brute.sha(texts[d]) == sha
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "language_id":
            assert set(after) <= set(before) and len(after) >= 0.97 * len(before)

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    expected = brute.pieces(_rows(docs), lambda x: t.encode(x, add_special_tokens=False).ids)
    out = corpus_pipeline.packing(spark, docs, SMALL).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == expected and len(out) == len(expected)
    fill = defaultdict(int)
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048


def test_run_writes_every_stage(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


def test_stages_survive_odd_and_empty_tables(spark):
    odd = spark.createDataFrame([(i, t, "en" if i else None, None, None) for i, t in ODD_ROWS], DOCUMENTS).selectExpr("*", "1 as score", "'k' as key")
    for table in (odd, odd.limit(0)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == table.columns
            docs.count()
        assert corpus_pipeline.packing(spark, docs, SMALL).count() >= docs.count()
