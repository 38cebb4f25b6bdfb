"""Benchmark decontamination by Wu-Manber search over words.

Every benchmark item gives windows of consecutive words (an item shorter
than a window is one window). Windows of one length form a pattern set with
a shift table over blocks of two words (one word for one-word windows): the
table says how far the search may move on when a block ends at the current
word. Where the shift is zero, the bucket of the block holds the windows
that end with it, and comparing words confirms an occurrence.

The benchmark's text goes to the executors in blocks of bounded size, and
every block is searched in all documents; one block is the usual case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import as_bytes, map_batches

WINDOW = 13
BLOCK_BYTES = 32 << 20
#: ASCII letters and digits (upper case lowered) and all bytes of other characters make words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class WuManber:
    """Pattern windows of one length: shift table, buckets by last block, owners of a window."""

    def __init__(self, length: int, owners: dict[tuple[bytes, ...], set]) -> None:
        self.length, self.owners = length, owners
        self.block = 2 if length > 1 else 1
        self.most = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for window in owners:
            for end in range(self.block, length + 1):
                key = window[end - 2:end] if self.block == 2 else window[end - 1]
                self.shift[key] = min(self.shift.get(key, self.most), length - end)
            self.bucket.setdefault(window[-2:] if self.block == 2 else window[-1], set()).add(window)

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(first word, window) of every occurrence."""
        shift, most, length, i = self.shift.get, self.most, self.length, self.length - 1
        pairs, n = self.block == 2, len(words)
        while i < n:
            key = (words[i - 1], words[i]) if pairs else words[i]
            step = shift(key, most)
            if step:
                i += step
                continue
            start = i - length + 1
            window = tuple(words[start:i + 1])
            if window in self.bucket[key]:
                yield start, window
            i += 1


def build(items: list[tuple[object, bytes | None]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], set]] = {}
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            by_length.setdefault(n, {}).setdefault(tuple(words[i:i + n]), set()).add(item)
    return [WuManber(n, owners) for n, owners in sorted(by_length.items())]


def scan(words: list[bytes], searches: list[WuManber]) -> tuple[list[tuple[int, int]], set]:
    """Covered spans of words (start, stop), joined where they touch, and the items found."""
    spans: list[tuple[int, int]] = []
    items: set = set()
    for search in searches:
        for start, window in search.occurrences(words):
            items |= search.owners[window]
            spans.append((start, start + search.length))
    return joined(spans), items


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """The benchmark's items in blocks of about ``block_bytes`` of text."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    block, held = [], 0
    for row in rows.toLocalIterator():
        block.append((row["item"], bytes(row["text"])))
        held += len(block[-1][1])
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words, spans, items`` added: hit spans of words and the item ids (text, sorted).

    A null text has no words; null items or items without words match
    nothing; repeated documents or items give repeated or equal results;
    an empty benchmark hits nothing. Columns of ``docs`` stay; those of
    the three new names are replaced.
    """
    spans_type = "array<struct<start:int,stop:int>>"
    new = ["n_words", "spans", "items"]
    docs = docs.drop(*new)
    kept = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    spark = docs.sparkSession
    blocks = list(_item_blocks(benchmark, item_col, item_text_col, block_bytes)) or [[]]
    out = docs.withColumns({"n_words": F.lit(None).cast("long"), "spans": F.expr(f"cast(array() as {spans_type})"), "items": F.expr("cast(array() as array<string>)")})
    for k, block in enumerate(blocks):
        sent = spark.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch, sent=sent, searches: list = []) -> pa.RecordBatch:
            if not searches:
                searches.append(build(sent.value, window))
            n_words, spans, items = [], [], []
            for text, old_spans, old_items in zip(as_bytes(batch.column(text_col)), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                words = words_of(text)
                found, hit = scan(words, searches[0])
                if old_spans:
                    found = joined(found + [(s["start"], s["stop"]) for s in old_spans])
                n_words.append(len(words))
                spans.append([{"start": a, "stop": b} for a, b in found])
                items.append(sorted(hit | set(old_items)))
            columns = [batch.column(c) for c in kept] + [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(items, pa.list_(pa.string()))]
            return pa.record_batch(columns, [*kept, *new])

        out = map_batches(out, run, f"{fields}, n_words long, spans {spans_type}, items array<string>")
        if k + 1 < len(blocks):
            out = cut_lineage(out)
    return out


def verdicts(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from the output of ``find_contamination``."""
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return found.select(
        F.col(id_col).alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
