"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last bytes of a text sets a boundary wherever its low
bits are all ones, so boundaries depend on the text around them only and
survive edits elsewhere. The number of those bits is the block size: the
smallest at which the text has at most ``MAX_PIECES`` boundaries. Each piece
gives two characters of its digest; a fingerprint holds the signatures at
that block size and the next. Two fingerprints are comparable where they
share a block size, and are as alike as the edit distance (insertions and
deletions) of their signatures says.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 7
MIN_BITS = 2
MAX_BITS = 31
MAX_PIECES = 64
_MULTIPLIER = 0x9E3779B1
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Bytes whose window hashes are worked out at once.
_STRIDE = 1 << 20


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the ``WINDOW`` bytes that end at each place; missing bytes before the text count as 0."""
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint32), data.astype(np.uint32) + np.uint32(1)])
    h = np.zeros(len(data), np.uint32)
    for k in range(WINDOW):
        h = h * np.uint32(_MULTIPLIER) + padded[k:k + len(data)]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return h


def boundaries(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a piece may end at the smallest block size, and how many low bits of the hash are ones there."""
    places, levels = [], []
    low = np.uint32((1 << MIN_BITS) - 1)
    for start in range(0, len(text), _STRIDE):
        before = min(start, WINDOW - 1)
        h = _window_hashes(np.frombuffer(text, np.uint8, min(_STRIDE, len(text) - start) + before, start - before))[before:]
        at = np.flatnonzero(h & low == low)
        ones = ~h[at]
        levels.append(np.where(ones == 0, 32, np.bitwise_count((ones & (~ones + np.uint32(1))) - np.uint32(1))).astype(np.uint8))
        places.append(at + start + 1)
    return (np.concatenate(places), np.concatenate(levels)) if places else (np.zeros(0, np.int64), np.zeros(0, np.uint8))


def _signature(text: bytes, ends: list[int]) -> str:
    out, start = [], 0
    for end in (*ends, len(text)):
        if end > start:
            code = zlib.crc32(text[start:end])
            code ^= code >> 12 ^ code >> 24
            out.append(_ALPHABET[code >> 6 & 63] + _ALPHABET[code & 63])
        start = end
    return "".join(out)


def fingerprint(text: bytes) -> str:
    """``bits:signature:signature at the next block size``. Equal texts have equal fingerprints; the empty text's is ``2::``."""
    places, levels = boundaries(text)
    counts = np.bincount(levels, minlength=34)[::-1].cumsum()[::-1]
    bits = next((b for b in range(MIN_BITS, MAX_BITS) if counts[b] <= MAX_PIECES), MAX_BITS)
    return f"{bits}:{_signature(text, places[levels >= bits].tolist())}:{_signature(text, places[levels > bits].tolist())}"


def common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one step over machine words a piece of ``b``."""
    masks: dict[str, int] = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & masks.get(x, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _alike(a: str, b: str) -> float:
    p, q = ([s[k:k + 2] for k in range(0, len(s), 2)] for s in (a, b))
    return 2 * common(p, q) / (len(p) + len(q)) if p and q else 0.0


def likeness(a: str, b: str) -> float:
    """1 minus edit distance over the signatures' length, at the block size they share (the better of two); 0 where they share none."""
    if a == b:
        return 1.0
    (bits_a, *sig_a), (bits_b, *sig_b) = a.split(":"), b.split(":")
    at_a, at_b = ({int(n): s[0], int(n) + 1: s[1]} for n, s in ((bits_a, sig_a), (bits_b, sig_b)))
    return max((_alike(at_a[n], at_b[n]) for n in at_a.keys() & at_b.keys()), default=0.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last third (code points, rounded down) replaced by the first as many of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(doc_id: int | None, text: str, own: str, following: str, following_print: str) -> tuple:
    new = edited(text, following).encode()
    new_print = fingerprint(new)
    return (doc_id, len(text), hashlib.sha256(new).hexdigest(), own, new_print, likeness(own, new_print), likeness(own, following_print))


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every whole text; a null text is empty, repeated rows are given as often as they occur."""
    arrow = pa.schema([_ARROW.field(n) for n in ("doc_id", "n_chars", "fingerprint")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = batch.column(1).to_pylist()
                yield _batch([(i, len(t), fingerprint(t.encode())) for i, t in zip(batch.column(0).to_pylist(), texts, strict=True)], arrow)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's fingerprint against that of its edited text and of the next document, by descending id; the first follows the last.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The rows are dealt and sorted by id, so nearly every document
    meets the next one in its own task; the last row of each task is
    finished with the first row of the next task that has any. A null text is empty; very long texts
    are whole; rows of equal id follow each other in the order of their
    texts' hashes, null ids come last; a lone row follows itself; extra
    columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # the last key splits rows that are equal in id and text; their order does not matter
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    keys = [F.col("doc_id").desc_nulls_last(), F.col("h"), F.col("at")]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    arrow = pa.schema([*_ARROW, ("kind", pa.string()), ("task", pa.int32()), ("text", pa.string())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last: tuple | None = None
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = fingerprint(text.encode())
                if last is None:
                    out.append((*[None] * 3, own, *[None] * 3, "head", task, text))
                else:
                    out.append((*_compared(*last, text, own), "done", task, None))
                last = doc_id, text, own
            if out:
                yield _batch(out, arrow)
        if last is not None:
            yield _batch([(last[0], None, None, last[2], *[None] * 3, "open", task, last[1])], arrow)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _batch([_compared(*r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)], _ARROW)

    walked = stored(dealt.mapInArrow(walk, f"{_RESULT}, kind string, task int, text string"))
    heads = walked.where("kind = 'head'").select(F.col("task").alias("next_task"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    # one row a task: which task comes next
    order = walked.where("kind = 'head'").selectExpr("task", "coalesce(lead(task) OVER (ORDER BY task), min(task) OVER ()) AS next_task")
    ends = walked.where("kind = 'open'").select("doc_id", "text", "fingerprint", "task").join(order, "task").join(heads, "next_task")
    rest = ends.select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(finish, _RESULT)
    return walked.where("kind = 'done'").select(*_ARROW.names).unionByName(rest)
