"""Toxicity scores by a factorization machine over hashed terms.

Terms are a document's distinct words and their four-byte beginnings (for
inflected forms), hashed into a fixed number of slots. Training first
screens the slots: one gets weights if its share of documents differs clearly
between the classes, or if it is half of a pair whose share does, beyond what
either half shows alone. The machine then learns a weight and a factor vector per
slot; the factors' inner products score pairs of terms that occur together,
such as an insult with a group's name, also where neither says anything alone.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MEMO_ENTRIES, id_and_text, map_batches
from .decontam import words_of

SLOTS = 1 << 20
FACTORS = 4
MAX_POSITIVE, MAX_NEGATIVE = 4_000, 12_000
THRESHOLD = 0.7
MIN_Z = 3.0
#: A pair must differ by so many standard errors, and by ``MIN_Z`` more than its halves. The most frequent terms are paired.
PAIR_Z = 12.0
PAIR_TERMS = 4_000
#: Least share of a class that holds a term or pair.
MIN_SHARE = 0.005


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose crc32(id as text) mod 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class _Slots(dict):
    """Word -> slots of its terms (only those in ``wanted``, if given)."""

    def __init__(self, wanted: dict[int, int] | None = None) -> None:
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        slots = [zlib.crc32(word) % SLOTS]
        if len(word) > 4:
            slots.append(zlib.crc32(word[:4] + b"*") % SLOTS)
        if self.wanted is not None:
            slots = [self.wanted[s] for s in slots if s in self.wanted]
        found = self[word] = tuple(slots)
        return found


def terms(text: str | None, slots: _Slots) -> set[int]:
    found: set[int] = set()
    for own in map(slots.__getitem__, set(words_of((text or "").lower().encode()))):
        if own:
            found.update(own)
    return found


@dataclass
class Machine:
    bias: float
    slots: np.ndarray    # admitted slots
    linear: np.ndarray   # weight of each
    factors: np.ndarray  # vector of each

    def log_odds(self, at: np.ndarray) -> float:
        """Bias, weights, and the inner product of every pair of factor vectors (as the square of their sum less their squares)."""
        v = self.factors[at]
        return float(self.bias + self.linear[at].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum()))

    def score(self, at: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.log_odds(at), -30, 30))))


def sample_labelled(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_positive: int = MAX_POSITIVE,
                    max_negative: int = MAX_NEGATIVE) -> DataFrame:
    """At most that many labelled training rows of each class, by the order of a hash of the id.

    Held-out rows, null ids and null labels are left out. A document with
    several labels counts as positive if one of them is.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .where("doc_id IS NOT NULL AND label IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = rows.where("label > 0").orderBy(*order).limit(max_positive).union(rows.where("label <= 0").orderBy(*order).limit(max_negative))
    return id_and_text(docs).join(F.broadcast(chosen), "doc_id")  # bounded by the two limits


def fit(sample: DataFrame, factors: int = FACTORS, epochs: int = 20, rate: float = 0.1, l2: float = 1e-4,
        positive_weight: float = 3.0, seed: int = 11) -> Machine:
    """Machine from ``text, label`` rows (a bounded sample); terms are hashed on the executors.

    Positive rows weigh ``positive_weight`` times as much. Without rows of both
    classes no slot is admitted and the bias says the one class.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots = _Slots()
        found = [sorted(terms(t, slots)) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "label", "slots"])

    got = map_batches(sample.select("doc_id", "label", "text"), run, "doc_id long, label int, slots array<int>").toArrow().combine_chunks()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    y = (got.column("label").to_numpy()[order] > 0).astype(float)
    n1, n0 = y.sum(), len(y) - y.sum()
    if not n1 or not n0:
        return Machine(-6.0 if not n1 else 6.0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
    lists = got.column("slots").combine_chunks()
    rows = [np.asarray(lists[int(i)].values.to_numpy(), dtype=np.int64) for i in order]
    admitted, alone = screened(rows, y)
    where = np.full(SLOTS, -1)
    where[admitted] = np.arange(len(admitted))
    rows = [where[r][where[r] >= 0] for r in rows]
    rng = np.random.default_rng(seed)
    bias, w, v = float(np.log(n1 / n0)), np.zeros(len(admitted)), rng.normal(0, 0.01, (len(admitted), factors))
    seen_b, seen_w, seen_v = 1e-8, np.full(len(admitted), 1e-8), np.full((len(admitted), factors), 1e-8)
    for _ in range(epochs):
        for chunk in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            at = np.concatenate([rows[i] for i in chunk])
            own = np.repeat(np.arange(len(chunk)), [len(rows[i]) for i in chunk])
            va = v[at]
            sums = np.stack([np.bincount(own, va[:, f], minlength=len(chunk)) for f in range(factors)], 1)
            squares = np.bincount(own, (va ** 2).sum(1), minlength=len(chunk))
            score = bias + np.bincount(own, w[at], minlength=len(chunk)) + 0.5 * ((sums ** 2).sum(1) - squares)
            err = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[chunk]) * np.where(y[chunk] > 0, positive_weight, 1.0)
            seen_b += err.sum() ** 2
            bias -= rate * err.sum() / np.sqrt(seen_b)
            touched, back = np.unique(at, return_inverse=True)
            gw = np.bincount(back, err[own], minlength=len(touched)) + l2 * w[touched]
            seen_w[touched] += gw ** 2
            w[touched] -= alone[touched] * rate * gw / np.sqrt(seen_w[touched])
            each = err[own][:, None] * (sums[own] - va)
            gv = np.stack([np.bincount(back, each[:, f], minlength=len(touched)) for f in range(factors)], 1) + l2 * v[touched]
            seen_v[touched] += gv ** 2
            v[touched] -= 0.2 * rate * gv / np.sqrt(seen_v[touched])
    # a text without known terms is at most as likely of the label as not, however the classes are weighed
    return Machine(min(bias, 0.0), admitted, w, v)


def _z(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Standard errors between the shares of ``a`` in ``n1`` and ``b`` in ``n0``; 0 where neither or all have it."""
    p = (a + b) / (n1 + n0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.nan_to_num((a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0)), posinf=0.0, neginf=0.0)


def screened(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots that tell the classes apart alone or as half of a pair, sorted, and whether they do alone: others get no weight but a factor vector.

    ``rows`` hold each document's different slots. Pairs are counted among the ``PAIR_TERMS`` most frequent slots that
    enough of a class has, a block of documents after the other.
    """
    n1, n0 = y.sum(), len(y) - y.sum()
    every, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    a = np.bincount(every, y[owner], minlength=SLOTS)
    b = np.bincount(every, minlength=SLOTS) - a
    alone = _z(a, b, n1, n0)
    by_itself = (np.abs(alone) >= MIN_Z) & (a + b >= 3)
    admitted = by_itself.copy()
    often = np.flatnonzero((a >= max(3, MIN_SHARE * n1)) | (b >= max(3, MIN_SHARE * n0)))
    often = np.sort(often[np.argsort(-(a + b)[often], kind="stable")[:PAIR_TERMS]])
    at = np.full(SLOTS, -1)
    at[often] = np.arange(len(often))
    met = {0.0: np.zeros((len(often), len(often)), np.float32), 1.0: np.zeros((len(often), len(often)), np.float32)}
    for label, total in met.items():
        mine = [at[rows[i]] for i in np.flatnonzero(y == label)]
        for start in range(0, len(mine), 1024):
            block = np.zeros((len(mine[start:start + 1024]), len(often)), np.float32)
            for k, r in enumerate(mine[start:start + 1024]):
                block[k, r[r >= 0]] = 1
            total += block.T @ block
    for k in range(len(often)):
        x, z = met[1.0][k, k + 1:].astype(float), met[0.0][k, k + 1:].astype(float)
        pair = np.abs(_z(x, z, n1, n0))
        halves = np.maximum(np.abs(alone[often[k]]), np.abs(alone[often[k + 1:]]))
        # beyond what the halves' own shares in each class bring together
        chance = (a[often[k]] * a[often[k + 1:]] / n1, b[often[k]] * b[often[k + 1:]] / n0)
        p = (x + z) / len(y)
        with np.errstate(invalid="ignore", divide="ignore"):
            excess = np.nan_to_num(((x - chance[0]) / n1 - (z - chance[1]) / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0)))
        found = np.flatnonzero((pair >= PAIR_Z) & (pair >= halves + MIN_Z) & (np.abs(excess) >= PAIR_Z) & (x + z >= 3))
        if len(found):
            admitted[often[k]] = True
            admitted[often[k + 1 + found]] = True
    slots = np.flatnonzero(admitted)
    return slots, by_itself[slots]


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Only the text decides the score. Null and empty texts get the score of no
    terms. Repeated rows give repeated results; an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batch: pa.RecordBatch, held: list = []) -> pa.RecordBatch:
        m = sent.value
        if not held:
            held.append(_Slots({int(s): k for k, s in enumerate(m.slots)}))
        scores = [m.score(np.array(sorted(terms(t, held[0])), dtype=np.int64)) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", held_out())
    return map_batches(rows, run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
