"""Filter interaction audit over a sparse document-term matrix.

Blocks of documents are counted into CSR shards whose columns are numbered
within the block. The blocks' words, each once a block, are then merged into
one dictionary for the whole table, and every shard's columns are renamed to
its ids: the result is one document-term matrix, cut by rows. Row sums are
the documents' words and nonzero counts their distinct words. The filters
that need no words are decided in the pass over the text, equal texts by
their digests. What the filters do in every order then follows from counts
of documents per part and set of failed filters.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_batches, stored

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
FILTERS = "ABCDE"
#: A block ends with the document that brings it to so many matrix entries or bytes of text.
BLOCK_ENTRIES = 1 << 20
BLOCK_BYTES = 32 << 20
DICTIONARY_BUCKET = 1 << 19
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#$%&*|"
_CONTINUATION = bytes(range(0x80, 0xC0))
_BLOCK_SCHEMA = ("block long, n_terms int, doc_ids array<long>, parts array<string>, digests array<binary>, failed array<int>, "
                 "indptr array<int>, indices binary, counts binary, words binary")
_SHARD_SCHEMA = ("block long, doc_ids array<long>, parts array<string>, digests array<binary>, failed array<int>, "
                 "indptr array<int>, columns array<long>, counts array<int>")
_ROW_SCHEMA = "doc_id long, part string, digest binary, n_words long, n_distinct long, failed int"


class _Numbers(dict):
    """Word -> its number in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _pack(values: np.ndarray) -> bytes:
    """Integers with their bytes sorted by place, compressed."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpack(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _join_words(words: list[bytes]) -> bytes:
    return zstandard.compress(b"\n".join(words), 1)  # no word holds a line break


def _split_words(blob: bytes) -> list[bytes]:
    text = zstandard.decompress(blob)
    return text.split(b"\n") if text else []


def _text_failures(text: bytes) -> int:
    """Bits of the filters C and D."""
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUATION))
    return (4 if 100 * upper > MAX_UPPER_PERCENT * points else 0) | (8 if len(text.translate(None, _SYMBOLS)) < len(text) else 0)


def _batch(schema: list[tuple[str, pa.DataType]], *rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows, strict=True), schema, strict=True)], names=[n for n, _ in schema])


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row per block of documents: their ids, parts, text digests and C and D bits, and a CSR shard over the block's own words.

    A null text is empty, a null part the empty string. Column numbers ascend within a row and are kept as steps.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    schema = [("block", pa.int64()), ("n_terms", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())),
              ("digests", pa.list_(pa.binary())), ("failed", pa.list_(pa.int32())), ("indptr", pa.list_(pa.int32())),
              ("indices", pa.binary()), ("counts", pa.binary()), ("words", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        made = itertools.count()
        ids: list = []

        def shard() -> pa.RecordBatch:
            return _batch(schema, (first + next(made), len(numbers), ids, parts, digests, failed, indptr,
                                   _pack(np.concatenate(steps)), _pack(np.concatenate(counts)), _join_words(list(numbers))))

        for batch in batches:
            for doc_id, text, part in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if not ids:
                    numbers, parts, digests, failed, indptr, steps, counts, size = _Numbers(), [], [], [], [0], [], [], 0
                seen = Counter(text.split())
                at = np.fromiter(map(numbers.__getitem__, seen), np.int32, len(seen))
                order = np.argsort(at)
                ids.append(doc_id)
                parts.append(part)
                digests.append(hashlib.sha256(text).digest())
                failed.append(_text_failures(text))
                steps.append(np.diff(at[order], prepend=np.int32(0)))
                counts.append(np.fromiter(seen.values(), np.int32, len(seen))[order])
                indptr.append(indptr[-1] + len(seen))
                size += len(text)
                if indptr[-1] >= entries or size >= BLOCK_BYTES:
                    yield shard()
                    ids = []
        if ids:
            yield shard()

    return rows.mapInArrow(run, _BLOCK_SCHEMA)


def numbered_words(cut: DataFrame) -> DataFrame:
    """``bucket, block, numbers, words, ids``: every block's words (packed) with their ids in the whole table's dictionary.

    A block sends each of its words once, packed by bucket. A bucket, which holds about ``DICTIONARY_BUCKET`` words
    of all blocks, numbers its different words in their order, so the ids are unique, near dense, and
    depend on the words only. ``cut`` are stored blocks.
    """
    n_terms = cut.agg(F.coalesce(F.sum("n_terms"), F.lit(0))).first()[0]
    buckets = max(1, -(-n_terms // DICTIONARY_BUCKET))
    sent = [("bucket", pa.int64()), ("block", pa.int64()), ("numbers", pa.binary()), ("words", pa.binary())]

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _split_words(blob)
            where = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) % np.uint64(buckets)
            order = np.argsort(where, kind="stable").astype(np.int32)
            for mine in np.split(order, np.flatnonzero(np.diff(where[order])) + 1) if words else []:
                out.append((int(where[mine[0]]), block, _pack(mine), _join_words([words[k] for k in mine.tolist()])))
        return _batch(sent, *out) if out else None

    def number(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        lists = [_split_words(blob) for blob in table.column("words").to_pylist()]
        known = {word: k * buckets + bucket for k, word in enumerate(sorted(set().union(*lists)))}
        ids = [_pack(np.fromiter(map(known.__getitem__, words), np.int64, len(words))) for words in lists]
        return table.append_column("ids", pa.array(ids, pa.binary()))

    dealt = map_batches(cut.select("block", "words"), deal, "bucket long, block long, numbers binary, words binary")
    return dealt.groupBy("bucket").applyInArrow(number, "bucket long, block long, numbers binary, words binary, ids binary")


def dictionary(cut: DataFrame) -> DataFrame:
    """``word, term_id``: every word of the stored blocks once."""
    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [w for blob in batch.column(0).to_pylist() for w in _split_words(blob)]
        ids = np.concatenate([_unpack(blob, np.int64) for blob in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(ids)], names=["word", "term_id"])

    return map_batches(numbered_words(cut).select("words", "ids"), spread, "word binary, term_id long").distinct()


def _shards(cut: DataFrame, use: Callable[[dict, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``use`` on every shard of the document-term matrix: the block's lists, ``indptr``, ``columns`` (the dictionary's ids) and ``counts``.

    A block's part of the dictionary is no larger than the block.
    """
    def run(blocks_: pa.Table, terms: pa.Table) -> pa.Table:
        row = blocks_.to_pylist()[0]
        indptr = np.array(row["indptr"], np.int64)
        steps, counts = _unpack(row["indices"], np.int32), _unpack(row["counts"], np.int32)
        # steps start anew with every row
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(steps, dtype=np.int64)])
        numbers = upto[1:] - np.repeat(upto[indptr[:-1]], np.diff(indptr))
        named = np.zeros(int(numbers.max()) + 1 if len(numbers) else 0, np.int64)
        for at, ids in zip(terms.column("numbers").to_pylist(), terms.column("ids").to_pylist(), strict=True):
            named[_unpack(at, np.int32)] = _unpack(ids, np.int64)
        return use(row, indptr, named[numbers], counts)

    terms = numbered_words(cut).select("block", "numbers", "ids")
    return cut.drop("words", "n_terms").groupBy("block").cogroup(terms.groupBy("block")).applyInArrow(run, schema)


def matrix(cut: DataFrame) -> DataFrame:
    """The document-term matrix of stored blocks: a CSR shard per block (``indptr, columns, counts``) whose columns are the dictionary's ids."""
    schema = [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())), ("digests", pa.list_(pa.binary())),
              ("failed", pa.list_(pa.int32())), ("indptr", pa.list_(pa.int32())), ("columns", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))]

    def use(row: dict, indptr: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> pa.Table:
        return pa.Table.from_batches([_batch(schema, (*(row[k] for k in ("block", "doc_ids", "parts", "digests", "failed", "indptr")), columns, counts))])

    return _shards(cut, use, _SHARD_SCHEMA)


def failures(cut: DataFrame) -> DataFrame:
    """``doc_id, part, digest, n_words, n_distinct, failed`` per document; ``failed`` holds the bits of A to D, A the lowest.

    Row sums and nonzero counts of the matrix decide A and B.
    """
    def use(row: dict, indptr: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> pa.Table:
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])
        n_words = sums[indptr[1:]] - sums[indptr[:-1]]
        # a row's columns are different, for the dictionary gives every word its own id
        at = np.repeat(np.arange(len(n_words)), np.diff(indptr))
        n_distinct = np.bincount(at[counts > 0], minlength=len(n_words))
        failed = np.array(row["failed"], np.int32) | (n_words < MIN_WORDS) | 2 * (100 * n_distinct < MIN_DISTINCT_PERCENT * n_words)
        return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "part": pa.array(row["parts"], pa.string()), "digest": pa.array(row["digests"], pa.binary()),
                         "n_words": pa.array(n_words), "n_distinct": pa.array(n_distinct.astype(np.int64)), "failed": pa.array(failed.astype(np.int32))})

    return _shards(cut, use, _ROW_SCHEMA)


def cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, n, n_good, n_toxic``: documents by part and set of failed filters, with E (bit 16) added.

    E fails where an equal text has a smaller doc_id; rows that repeat the
    smallest id pass, and so do null ids, which are not smaller than any. Copies are
    counted per text before they are sent anywhere, so a hot text is a few rows.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    keys = ["part", "digest", "failed"]
    known = failed.where("doc_id IS NOT NULL").groupBy("doc_id", *keys).agg(F.count("*").alias("n")).join(marks, "doc_id", "left")
    keys += ["good", "toxic"]
    per_text = (known.groupBy(*keys).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
                .withColumn("least", F.expr("min(first.doc_id) OVER (PARTITION BY digest)"))
                .withColumn("n_first", F.expr("CASE WHEN first.doc_id = least THEN first.n ELSE 0L END")))
    split = per_text.select("part", "good", "toxic", F.expr("inline(array(struct(failed, n_first AS n), struct(failed | 16 AS failed, n - n_first AS n)))"))
    unknown = failed.where("doc_id IS NULL").selectExpr("part", "CAST(NULL AS boolean) good", "CAST(NULL AS boolean) toxic", "failed", "1L AS n")
    return split.unionByName(unknown).groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("n_toxic"))


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it), for every order of the filters."""
    out = []
    for order in itertools.permutations(filters):
        bits = [1 << filters.index(f) for f in order]
        out += [("".join(order), k + 1, bits[k], sum(bits[:k])) for k in range(len(bits))]
    return out


def interactions(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, with what the step's filter does there.

    ``counted`` has a part's at most 2^filters rows. A document that fails m
    filters is removed by each of them in one m-th of all orders, which gives ``shapley``.
    """
    table = F.expr("array(" + ", ".join(f"struct('{o}' AS filter_order, {k} AS step, {bit} AS bit, {before} AS before)" for o, k, bit, before in orders(filters)) + ")")
    per_part = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "n_good", "n_toxic")).alias("c"))
    steps = per_part.select("part", "c", F.explode(table).alias("s")).select("part", "c", "s.*")
    total = 1
    for k in range(2, len(filters) + 1):
        total *= k

    def over(where: str, value: str = "x.n") -> str:
        return f"aggregate(c, 0L, (a, x) -> a + CASE WHEN {where} THEN {value} ELSE 0L END)"

    here = "x.failed & before = 0 AND x.failed & bit != 0"
    return steps.selectExpr(
        "part", "filter_order", "step", f"{over('x.failed & (before | bit) = 0')} AS kept", f"{over(here)} AS removed",
        f"{over('x.failed & before != 0 AND x.failed & bit != 0')} AS redundant", f"{over('x.failed = bit')} AS unique_fails",
        f"{over(here, 'x.n_good')} AS good_lost", f"{over(here, 'x.n_toxic')} AS toxic_lost",
        f"{over('x.failed & bit != 0', f'x.n * {total} DIV bit_count(x.failed)')} AS shapley")


def audit(docs: DataFrame, labels: DataFrame, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    Null texts are empty and null langs the part of the empty string; very
    long texts are whole, in a block of their own; repeated rows count as
    often as they occur; a doc_id that ``labels`` repeats is good or toxic
    if one of its rows says so; extra columns are not read; an empty table gives no rows.
    """
    cut = stored(blocks(docs, entries=entries))
    return interactions(cells(stored(failures(cut)), labels))
