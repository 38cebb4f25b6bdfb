"""URL filter: allow and block rules, then logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table; the query takes as
labels the verdicts of the rules on the pages they cover.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches

FEATURES = 1 << 16
NGRAMS = (3, 4)
TRAIN_ROWS = 20_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "net/es/")``: the host up to the first slash, the path from it."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without one."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls if none does.

    Equal lengths: the longer host, then block before allow.
    """
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text).otherwise(text)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def parsed(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, ruled`` of every row; only the two columns are read."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    text, verdict = matched_rule(rules, F.col("host"), F.col("path"))
    return rows.select("page_id", "host", "path", text.alias("rule"), verdict.alias("ruled"))


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, each with its ends marked."""
    found = set()
    for kind, s in (("h", host), ("p", path)):
        s = f"^{s}$".encode()
        for n in NGRAMS:
            found.update(zlib.crc32(s[i:i + n], ord(kind)) for i in range(len(s) - n + 1))
    return np.fromiter(found, dtype=np.int64, count=len(found)) % FEATURES


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS, epochs: int = 12, rate: float = 0.5, l2: float = 1e-6,
          seed: int = 7) -> np.ndarray:
    """Weights (bias last) from rows ``host, path, blocked``; 1 means block.

    At most ``max_rows`` rows are taken, by the order of a hash of host and
    path, so the choice does not depend on partitioning. Both kinds weigh the
    same in all. Without rows of both kinds the bias alone says the one kind (no rows: allow).
    """
    sample = (labelled.where("blocked IS NOT NULL").select("host", "path", F.col("blocked").cast("int").alias("blocked"))
              .distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "blocked").limit(max_rows).collect())
    weights = np.zeros(FEATURES + 1)
    y = np.array([r["blocked"] for r in sample], dtype=float)
    if len(set(y)) < 2:
        weights[-1] = 10.0 if len(y) and y[0] else -10.0
        return weights
    rows = [grams(r["host"], r["path"]) for r in sample]
    balance = len(y) / 2 / np.where(y > 0, y.sum(), len(y) - y.sum())
    seen = np.full(FEATURES + 1, 1e-8)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for chunk in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
            idx = np.concatenate([rows[i] for i in chunk])
            sizes = np.array([len(rows[i]) for i in chunk])
            owner = np.repeat(np.arange(len(chunk)), sizes)
            z = np.bincount(owner, weights[idx] / np.sqrt(sizes)[owner], minlength=len(chunk)) + weights[-1]
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[chunk]) * balance[chunk] / len(chunk)
            grad = np.bincount(idx, (err / np.sqrt(sizes))[owner], minlength=FEATURES + 1)
            grad[-1] = err.sum()
            touched = np.flatnonzero(grad)
            grad = grad[touched] + l2 * weights[touched]
            seen[touched] += grad * grad
            weights[touched] -= rate * grad / np.sqrt(seen[touched])
    return weights


def score(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """``rows`` (``page_id, host, path, rule, ruled``) with ``p_block``, the model's probability."""
    sent = rows.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    types = dict(rows.dtypes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = sent.value
        p = []
        for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
            at = grams(host, path)
            z = float(w[at].sum()) / max(1, len(at)) ** 0.5 + float(w[-1])
            p.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pa.record_batch([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, "p_block"])

    return map_batches(rows, run, ", ".join(f"`{c}` {t}" for c, t in types.items()) + ", p_block double")


def filter_urls(pages: DataFrame, rules: list[Rule], labelled: DataFrame, id_col: str = "page_id", url_col: str = "url",
                threshold: float = 0.5, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """``page_id, host, path, rule, verdict, p_block`` per row of ``pages``.

    The verdict is the longest fitting rule's, else block where the model's
    probability reaches ``threshold``. A null url or one without ``://`` has an
    empty host and path, which the model judges too. Repeated rows give
    repeated results; an empty table gives none. Very long urls are judged whole.
    """
    rows = score(parsed(pages, rules, id_col, url_col), train(labelled, max_rows))
    verdict = F.coalesce("ruled", F.when(F.col("p_block") >= threshold, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
