"""Stupid-backoff scores of documents, against n-gram counts of the corpus.

Documents are packed into blocks of words. A block sends each of its
distinct n-grams (hash and own count) once to the bucket its hash falls in;
the buckets together are the count tables, partitioned by hash. A bucket
adds the counts up and sends each block the totals of the n-grams it asked
about, in the order asked. The block joins them back to its words and sums
the scores per document. A frequent n-gram is thus one entry per block, not
one row per occurrence.

Words and pairs are counted first. A longer n-gram is asked about only where
both shorter n-grams in it reach ``min_count``; elsewhere it cannot.

Score of a word after its context, longest context first: count(n-gram) /
count(context) if the n-gram occurs at least ``min_count`` times, else
``ALPHA`` times the score with the context's first word left out; a single
word has count / words. Contexts do not reach over the document's start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WordHashes, as_bytes, bucketed, id_and_text, mix64, word_hashes

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 2
BLOCK_WORDS = 2_000_000
MIN_BUCKETS = 256
MICRO = 1_000_000
_BLOCK = "block long, doc_ids array<long>, n_words array<long>, words binary, vocabulary binary, uses binary"
_ASK = "bucket long, block long, keys binary, counts binary"
_TOTALS = "block long, bucket long, totals binary"


def pack(a: np.ndarray) -> bytes:
    """Bytes of a vector, transposed (like bytes of all entries together), compressed."""
    kind = {"uint64": b"8", "uint32": b"4"}[a.dtype.name]
    return kind + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), int(kind)).T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = int(data[:1])
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(np.uint64 if width == 8 else np.uint32).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def _by_use(uses: np.ndarray) -> np.ndarray:
    return np.argsort(-uses.astype(np.int64), kind="stable")


def _blocks(docs: DataFrame, block_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo, ids, sizes, parts, held, made = WordHashes(), [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            vocabulary, at, uses = np.unique(words, return_inverse=True, return_counts=True)
            rank = np.empty(len(uses), np.uint32)  # frequent words get small numbers, which pack well
            rank[_by_use(uses)] = np.arange(len(uses), dtype=np.uint32)
            number = (TaskContext.get().partitionId() << 32) + made
            return pa.record_batch([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                                    pa.array([pack(rank[at])], pa.binary()), pa.array([pack_sorted(vocabulary)], pa.binary()), pa.array([pack(uses.astype(np.uint32))], pa.binary())],
                                   ["block", "doc_ids", "n_words", "words", "vocabulary", "uses"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                words = text.lower().split() if text else []
                ids.append(doc_id)
                sizes.append(len(words))
                parts.append(word_hashes(words, memo))
                held += len(words)
                if held >= block_words:
                    yield block()
                    ids, sizes, parts, held, made = [], [], [], 0, made + 1
        if ids:
            yield block()

    return docs.mapInArrow(run, _BLOCK)


def _grams(words: np.ndarray, sizes: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1..order: hashes of the n-grams that end at a word, and where such exist."""
    position = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, key = [], words
    for n in range(1, order + 1):
        if n > 1:
            key = key.copy()
            # the n-gram that ends here: the shorter one that ended a word before, then this word
            key[1:] = mix64(previous[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
        previous = key
        out.append((mix64(key + np.uint64(n)), position >= n - 1))
    return out


class _Block:
    """A block's n-grams, and the counts that came back for them so far."""

    def __init__(self, row: dict, order: int, bits: int, min_count: int, totals: pa.Table | None = None) -> None:
        vocabulary = unpack_sorted(row["vocabulary"])[_by_use(unpack(row["uses"]))]
        self.sizes = np.array(row["n_words"], dtype=np.int64)
        self.grams = _grams(vocabulary[unpack(row["words"])], self.sizes, order)
        self.bits, self.min_count = bits, min_count
        self.counts: list[np.ndarray] = []
        if totals is not None:
            found = sorted(zip(totals.column("bucket").to_pylist(), totals.column("totals").to_pylist()))
            for n in range(1, order + 1):
                own = [unpack(t) for b, t in found if b >> bits == n]
                if n > 2 and not own:
                    break
                ok, _, back, _ = self.distinct(n)
                count = np.zeros(len(ok))
                count[ok] = np.concatenate(own)[back] if own else 0
                self.counts.append(count)

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where n-grams worth asking about end; their distinct hashes, each one's place among these, own counts."""
        key, ok = self.grams[n - 1]
        if n > 2:
            shorter = self.counts[n - 2] >= self.min_count
            ok = ok & shorter & np.r_[False, shorter[:-1]][:len(shorter)]
        return ok, *np.unique(key[ok], return_inverse=True, return_counts=True)

    def ask(self, block: int, n: int) -> pa.RecordBatch:
        """A row for each bucket: the distinct hashes in it, and own counts."""
        _, keys, _, counts = self.distinct(n)
        bounds = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(bounds))
        return pa.record_batch([
            pa.array((n << self.bits) + full, pa.int64()), pa.array([block] * len(full), pa.int64()),
            pa.array([pack_sorted(keys[bounds[b]:bounds[b + 1]]) for b in full], pa.binary()),
            pa.array([pack(counts[bounds[b]:bounds[b + 1]].astype(np.uint32)) for b in full], pa.binary())],
            ["bucket", "block", "keys", "counts"])


def _total(asked: DataFrame) -> DataFrame:
    """Totals of the hashes of each bucket, for each block in its own order."""
    def run(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([unpack(c) for c in table.column("counts").to_pylist()]).astype(np.float64)
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.minimum(np.bincount(at, counts), 2 ** 32 - 1).astype(np.uint32)[at]
        stops = np.cumsum([len(k) for k in keys])
        return pa.table([table.column("block").combine_chunks(), table.column("bucket").combine_chunks(),
                         pa.array([pack(p) for p in np.split(total, stops[:-1])], pa.binary())], ["block", "bucket", "totals"])

    return cut_lineage(asked.groupBy("bucket").applyInArrow(run, _TOTALS))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA,
          min_count: int = MIN_COUNT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, micro_logprob, mean_micro`` per row of ``docs``.

    ``micro_logprob`` sums log10 of the words' scores, each rounded to a
    millionth (as integers, so sums do not depend on their order);
    ``mean_micro`` is it per word, rounded down. Words are runs without white
    space, A-Z lowered. A null or empty text has no words, sum 0 and a null
    mean. Repeated rows count as often as they occur. An empty table gives no rows.
    Keys are 64-bit hashes; two n-grams of one hash would share their count.
    """
    blocks = bucketed(_blocks(id_and_text(docs, id_col, text_col), block_words), "block")
    n_blocks, total = blocks.agg(F.count("*"), F.sum(F.expr("aggregate(n_words, 0L, (a, x) -> a + x)"))).first()
    total = total or 0
    bits = max(MIN_BUCKETS, n_blocks).bit_length() - 1 + (max(MIN_BUCKETS, n_blocks) & (max(MIN_BUCKETS, n_blocks) - 1) > 0)

    def ask_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _Block(row, min(order, 2), bits, min_count)
                for n in range(1, min(order, 2) + 1):
                    yield own.ask(row["block"], n)

    totals = _total(blocks.mapInArrow(ask_short, _ASK))
    by_block = blocks.groupBy("block")

    def ask_long(n: int):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.to_pylist()[0]
            return pa.Table.from_batches([_Block(row, n, bits, min_count, right).ask(row["block"], n)])
        return run

    for n in range(3, order + 1):
        totals = totals.unionByName(_total(by_block.cogroup(totals.groupBy("block")).applyInArrow(ask_long(n), _ASK)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        own = _Block(row, order, bits, min_count, right)
        counts, sizes = own.counts, own.sizes
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.log10(counts[0] / total) if total else np.zeros(0)
            for n in range(1, order):
                ok = own.grams[n][1]
                if n >= len(counts):  # no n-gram of this length was worth asking about
                    value = np.where(ok, value + np.log10(alpha), value)
                    continue
                context = np.r_[1.0, counts[n - 1][:-1]][:len(ok)]
                seen = ok & (counts[n] >= min_count)
                value = np.where(seen, np.log10(counts[n] / context), np.where(ok, value + np.log10(alpha), value))
        micro = np.r_[0, np.cumsum(np.rint(value * MICRO).astype(np.int64))]
        stop = np.cumsum(sizes)
        return pa.table([pa.array(row["doc_ids"], pa.int64()), pa.array(sizes), pa.array(micro[stop] - micro[stop - sizes])], ["doc_id", "n_words", "micro_logprob"])

    scored = by_block.cogroup(totals.groupBy("block")).applyInArrow(run, "doc_id long, n_words long, micro_logprob long")
    return scored.withColumn("mean_micro", F.expr("CASE WHEN n_words > 0 THEN cast(floor(micro_logprob / n_words) as long) END"))
