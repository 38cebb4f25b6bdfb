"""Corpus pipeline: five stages, each calling one operator of ``jobtide.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs``. Nulls, empty and repeated rows are
handled as the operators' docstrings say. Columns that no operator reads go through the
stages under private names, so columns named like an operator's results keep their values.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import decontam, line_dedup, minhash_join, piece_sampling, quality_rules
from jobtide.llm.common import small_batches, table
from jobtide.session import cut_lineage, ensure_checkpoint_dir

MODEL = "piece_bpe_32k.model"
NEAR_PERCENT = 80
#: SQL can't draw the last stage's samples; a brute-force version tests the stages.
ORACLE_SQL = None


#: Columns that operators read.
READ = ("doc_id", "text", "lang", "source")


def _private(docs: DataFrame) -> DataFrame:
    return docs.select([F.col(f"`{c}`").alias(c if c in READ else f"__own{i}") for i, c in enumerate(docs.columns)])


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select([F.col(c if c in READ else f"__own{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _restored(quality_rules.judge(_private(docs)).where("kept"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them have; ``n_chars``, where there is one, follows the text."""
    clean = _restored(line_dedup.dedup_lines(_private(docs)), docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return _restored(minhash_join.keep_one(_private(docs), NEAR_PERCENT), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage makes up a twentieth of."""
    found = decontam.find_contamination(_private(docs), table(spark, sf_dir, "benchmark"))
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return _restored(found.where(~((hit > 0) & (20 * hit >= F.col("n_words")))), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, piece_ids, lossless``: a sampled segmentation of every text that is left."""
    encoded = piece_sampling.encode_sampled(_private(docs), public_tokenizers.path(MODEL))
    return encoded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "lossless")


def _stage(fn):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        small_batches(spark)
        return fn(spark, docs, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


STAGES = [
    ("quality_rules", _stage(quality)),
    ("line_dedup", _stage(lines)),
    ("minhash_near_dedup", _stage(near_duplicates)),
    ("benchmark_decontamination", _stage(decontaminate)),
    ("sentencepiece_encoding", _stage(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are checkpointed for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
