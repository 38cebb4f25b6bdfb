"""Every pipeline stage against a brute-force version of its decision, on its own input."""

import corpus_pipeline
from jobtide.llm import decontam

from .test_operators import _components, _line_dedup

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [(r["item_id"], r["text"].encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, SF).cache()
        rows = out.collect()
        after = {r["doc_id"] for r in rows}
        assert len(rows) == len(after) and after <= set(before)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
        if name == "quality_rules":
            assert 0 < len(after) < len(before)
        elif name == "line_dedup":
            assert {(r["doc_id"], r["text"]) for r in rows} == {(i, t) for i, _, _, t in _line_dedup(list(before.items()), 10)}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "minhash_near_dedup":
            assert after == {i for i, _, _, kept in _components(list(before.items()), 80) if kept}
        elif name == "benchmark_decontamination":
            search = decontam.build(bench)
            clean = set()
            for i, t in before.items():
                words = decontam.words_of(t.encode())
                hit = sum(b - a for a, b in decontam.scan(words, search)[0])
                if not (hit and 20 * hit >= len(words)):
                    clean.add(i)
            assert after == clean
        else:
            assert after == set(before) and all(r["lossless"] and r["n_pieces"] == len(r["piece_ids"]) for r in rows)
        docs = out


def test_columns_named_like_results_keep_their_values(spark):
    names = ["w", "n_words", "n_lines", "kept", "spans", "items", "n_dropped", "component_id", "digest", "__lines", "lang.x"]
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    docs = plain.select("*", *[(plain.doc_id * 100 + k).cast("string").alias(c) for k, c in enumerate(names)])
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == str(r["doc_id"] * 100 + i) for r in rows for i, c in enumerate(names))
        want = {r["doc_id"]: r["text"] for r in stage(spark, plain, SF).collect()}
        assert {r["doc_id"]: r["text"] for r in rows} == want
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF).columns == last(spark, plain, SF).columns
