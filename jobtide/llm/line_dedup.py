"""Line dedup with sharded cuckoo filters over exact reference counts.

A line's key is its digest after stripping white space and lowering A-Z. The
reference table holds, exactly, how many documents have a key. Keys of
enough documents are *common*; each shard keeps a cuckoo filter of its
common keys, so most lines are cleared by two bucket probes, and only lines
that the filter lets through are looked up among the exact keys.

``LineIndex`` keeps both as tables and takes documents in and out: counts
go up and down, and a key enters or leaves its filter when its count
crosses the threshold, so a deletion takes back what an insertion did.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import as_bytes, map_batches, mix64

MIN_DOCS = 10
SHARDS = 64
BROADCAST_BYTES = 16 << 20
_SLOTS = 4
_SPACE = b" \t\n\v\f\r"


def line_key(line: bytes, min_chars: int = 1) -> bytes | None:
    """Digest of a line's key; None where the key is shorter than ``min_chars`` code points."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


def _parts(digests: bytes) -> tuple[np.ndarray, np.ndarray]:
    pair = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    return pair[:, 0], pair[:, 1]


def shard_of(digest: bytes, shards: int) -> int:
    return int.from_bytes(digest[6:8], "little") % shards


class Cuckoo:
    """Cuckoo filter of 16-bit fingerprints, four slots a bucket.

    A key that finds no place after many moves goes to an exact stash.
    """

    def __init__(self, expected: int, table: bytes | None = None, stash: Iterable[bytes] = ()) -> None:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, expected) / (_SLOTS * 0.85)))))
        self.table = np.zeros((buckets, _SLOTS), np.uint16) if table is None else np.frombuffer(table, np.uint16).reshape(-1, _SLOTS).copy()
        self.stash = list(stash)

    @staticmethod
    def marks(second: np.ndarray) -> np.ndarray:
        return np.maximum(second & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)

    @staticmethod
    def other(bucket: np.ndarray, mark: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(mark.astype(np.uint64)) & mask)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        first, second = _parts(digest)
        mask = np.uint64(len(self.table) - 1)
        mark, a = self.marks(second), first & mask
        return int(mark[0]), int(a[0]), int(self.other(a, mark, mask)[0])

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return bool(len(free))

    def insert(self, digest: bytes) -> None:
        mark, a, b = self._places(digest)
        if self._put(a, mark) or self._put(b, mark):
            return
        mask = np.uint64(len(self.table) - 1)
        trail, at, carried = [], a, mark
        for k in range(200):
            slot = k % _SLOTS
            trail.append((at, slot, int(self.table[at, slot])))
            carried, self.table[at, slot] = int(self.table[at, slot]), carried
            at = int(self.other(np.array([at], np.uint64), np.array([carried], np.uint16), mask)[0])
            if self._put(at, carried):
                return
        for at, slot, old in reversed(trail):  # as before; this key is kept exactly
            self.table[at, slot] = old
        self.stash.append(digest)

    def delete(self, digest: bytes) -> None:
        """Takes out a key that was inserted."""
        if digest in self.stash:
            self.stash.remove(digest)
            return
        mark, a, b = self._places(digest)
        for bucket in (a, b):
            found = np.flatnonzero(self.table[bucket] == mark)
            if len(found):
                self.table[bucket, found[0]] = 0
                return

    def contains(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b] or digest in self.stash


FILTER_SCHEMA = "shard int, n_keys long, buckets binary, stash array<binary>, digests binary"


class Probe:
    """The filters of several shards as one array, with the exact keys behind them."""

    def __init__(self, rows: list[tuple], shards: int) -> None:
        self.shards = shards
        self.base, self.mask = np.zeros(shards, np.int64), np.zeros(shards, np.uint64)
        tables, at = [np.zeros((1, _SLOTS), np.uint16)], 1
        self.stash: set[bytes] = set()
        self.exact: set[bytes] = set()
        for shard, table, stash, digests in rows:
            own = np.frombuffer(table, np.uint16).reshape(-1, _SLOTS)
            tables.append(own)
            self.base[shard], self.mask[shard] = at, len(own) - 1
            at += len(own)
            self.stash.update(stash)
            self.exact.update(digests[i:i + 16] for i in range(0, len(digests), 16))
        self.table = np.concatenate(tables)

    def maybe(self, digests: list[bytes]) -> np.ndarray:
        """Whether each key passes its shard's filter."""
        if not digests:
            return np.zeros(0, bool)
        first, second = _parts(b"".join(digests))
        shard = ((first >> np.uint64(48)) % np.uint64(self.shards)).astype(np.int64)
        mark, mask = Cuckoo.marks(second), self.mask[shard]
        a = first & mask
        b = Cuckoo.other(a, mark, mask)
        base = self.base[shard]
        hit = (self.table[base + a.astype(np.int64)] == mark[:, None]).any(1) | (self.table[base + b.astype(np.int64)] == mark[:, None]).any(1)
        if self.stash:
            hit |= np.fromiter((d in self.stash for d in digests), bool, len(digests))
        return hit


def document_keys(docs: DataFrame, text_col: str = "text", shards: int = SHARDS, min_chars: int = 1) -> DataFrame:
    """``shard, digest``: a row for every distinct key of every document (row)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in as_bytes(batch.column(0)):
            if text:
                out.extend({line_key(line, min_chars) for line in text.split(b"\n")} - {None})
        return pa.record_batch([pa.array([shard_of(d, shards) for d in out], pa.int32()), pa.array(out, pa.binary())], ["shard", "digest"])

    return map_batches(docs.select(F.col(text_col).cast("string").alias("text")), run, "shard int, digest binary")


def reference_counts(docs: DataFrame, text_col: str = "text", shards: int = SHARDS, min_chars: int = 1) -> DataFrame:
    """``shard, digest, n_docs``: exact number of documents of every key; counted where the lines are first."""
    return document_keys(docs, text_col, shards, min_chars).groupBy("shard", "digest").agg(F.count("*").alias("n_docs"))


def build_filters(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per shard with common keys: its cuckoo filter, stash and exact keys."""
    def run(table: pa.Table) -> pa.Table:
        digests = sorted(table.column("digest").to_pylist())
        made = Cuckoo(len(digests))
        for d in digests:
            made.insert(d)
        return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int32()), pa.array([len(digests)], pa.int64()), pa.array([made.table.tobytes()], pa.binary()),
                         pa.array([made.stash], pa.list_(pa.binary())), pa.array([b"".join(digests)], pa.binary())], ["shard", "n_keys", "buckets", "stash", "digests"])

    return counts.where(F.col("n_docs") >= min_docs).groupBy("shard").applyInArrow(run, FILTER_SCHEMA)


def split_text(text: bytes | None, common: set[bytes], min_chars: int) -> tuple[bytes, int, int]:
    """Text without its common lines, its lines, and the lines dropped."""
    lines = (text or b"").split(b"\n")
    if not common:
        return text or b"", len(lines), 0
    kept = [line for line in lines if line_key(line, min_chars) not in common]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def drop_common_lines(docs: DataFrame, filters: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                      min_docs: int = MIN_DOCS, min_chars: int = 1, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without common lines; adds ``n_lines`` (before) and ``n_dropped``.

    Filters and common keys are sent to the tasks if they take at most
    ``broadcast_bytes``; beyond, filters go out in blocks of shards of that
    size, and what passes them is joined with the counts.
    """
    new = ["n_lines", "n_dropped"]
    docs = docs.drop(*new)
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", n_lines long, n_dropped long"
    spark = docs.sparkSession
    sizes = filters.select("shard", F.octet_length("buckets").alias("filter"), F.octet_length("digests").alias("exact")).orderBy("shard").collect()

    def result(batch: pa.RecordBatch, parts: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        made = {text_col: pa.array([p[0] for p in parts], pa.binary()).cast(pa.string())}
        return pa.record_batch([made.get(c, batch.column(c)) for c in names] + [pa.array([p[k] for p in parts], pa.int64()) for k in (1, 2)], [*names, *new])

    if sum(s["filter"] + s["exact"] for s in sizes) <= broadcast_bytes:
        sent = spark.sparkContext.broadcast([tuple(r) for r in filters.select("shard", "buckets", "stash", "digests").collect()])

        def run(batch: pa.RecordBatch, held: list = []) -> pa.RecordBatch:
            if not held:
                held.append(Probe(sent.value, shards))
            probe, texts = held[0], as_bytes(batch.column(text_col))
            keys = [[line_key(line, min_chars) for line in (t or b"").split(b"\n")] for t in texts]
            real = [k for own in keys for k in own if k is not None]
            common = {k for k, hit in zip(real, probe.maybe(real)) if hit and k in probe.exact}
            parts = []
            for text, own in zip(texts, keys):
                if common.isdisjoint(own):
                    parts.append((text or b"", len(own), 0))
                else:
                    kept = [line for line, k in zip(text.split(b"\n"), own) if k not in common]
                    parts.append((b"\n".join(kept), len(own), len(own) - len(kept)))
            return result(batch, parts)

        return map_batches(docs, run, schema)

    def blocks() -> Iterator[list[int]]:
        block, held = [], 0
        for s in sizes:
            if block and held + s["filter"] > broadcast_bytes:
                yield block
                block, held = [], 0
            block.append(s["shard"])
            held += s["filter"]
        if block:
            yield block

    def keys_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = {(i, k) for i, t in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text"))) if t
                for k in (line_key(line, min_chars) for line in t.split(b"\n")) if k is not None}
        ids, keys = [r[0] for r in rows], [r[1] for r in rows]
        return pa.record_batch([pa.array(ids, pa.string()), pa.array([shard_of(k, shards) for k in keys], pa.int32()), pa.array(keys, pa.binary())], ["id", "shard", "digest"])

    # rows go by their id as text; a shared id only shares the set of common keys
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("null"))
    keys = map_batches(docs.select(key.alias("id"), F.col(text_col).cast("string").alias("text")), keys_of, "id string, shard int, digest binary")
    passed = None
    for block in blocks():
        sent = spark.sparkContext.broadcast([tuple(r) for r in filters.where(F.col("shard").isin(block)).select("shard", "buckets", "stash", F.lit(b"").alias("digests")).collect()])

        def probe_block(batch: pa.RecordBatch, sent=sent, held: list = []) -> pa.RecordBatch:
            if not held:
                held.append(Probe(sent.value, shards))
            return batch.filter(pa.array(held[0].maybe(batch.column("digest").to_pylist())))

        own = map_batches(keys.where(F.col("shard").isin(block)), probe_block, "id string, shard int, digest binary")
        passed = own if passed is None else passed.unionByName(own)
    common = cut_lineage(counts.where(F.col("n_docs") >= min_docs).select("digest"))
    found = passed.join(common, "digest").groupBy("id").agg(F.collect_set("digest").alias("__common"))
    rows = docs.withColumn("__id", key).join(found.withColumnRenamed("id", "__id"), "__id", "left").drop("__id")

    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = batch.column("__common").to_pylist()
        return result(batch, [split_text(t, set(c or ()), min_chars) for t, c in zip(as_bytes(batch.column(text_col)), sets)])

    return map_batches(rows, drop, schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = 1,
                shards: int = SHARDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the lines whose key at least ``min_docs`` documents have.

    Adds ``n_lines`` and ``n_dropped`` (columns of these names are replaced).
    Every row is a document, also repeated rows. Null and empty texts are one
    empty line, which has no key and stays; a null text comes back empty. An
    empty table gives no rows. Texts and lines of any length are read whole.
    """
    counts = cut_lineage(reference_counts(docs, text_col, shards, min_chars).where(F.col("n_docs") >= min_docs))
    filters = cut_lineage(build_filters(counts, min_docs))
    return drop_common_lines(docs, filters, counts, id_col, text_col, shards, min_docs, min_chars, broadcast_bytes)


class LineIndex:
    """Reference counts and filters as tables under ``path``, one folder per version.

    A version is complete once its ``filters`` folder is; older versions stay
    until the user removes them.
    """

    def __init__(self, spark: SparkSession, path: str, version: int = 0, min_docs: int = MIN_DOCS, min_chars: int = 1, shards: int = SHARDS) -> None:
        self.spark, self.path, self.version = spark, path.rstrip("/"), version
        self.min_docs, self.min_chars, self.shards = min_docs, min_chars, shards

    def _at(self, name: str, version: int | None = None) -> str:
        return f"{self.path}/v{self.version if version is None else version}/{name}"

    @property
    def counts(self) -> DataFrame:
        return self.spark.read.schema("shard int, digest binary, n_docs long").parquet(self._at("counts"))

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.schema(FILTER_SCHEMA).parquet(self._at("filters"))

    def _change(self, docs: DataFrame, sign: int, text_col: str) -> None:
        delta = reference_counts(docs, text_col, self.shards, self.min_chars).select("shard", "digest", F.lit(0).cast("long").alias("old"), (sign * F.col("n_docs")).alias("delta"))
        if self.version:
            delta = delta.unionByName(self.counts.select("shard", "digest", F.col("n_docs").alias("old"), F.lit(0).cast("long").alias("delta")))
        both = cut_lineage(delta.groupBy("shard", "digest").agg(F.sum("old").alias("old"), F.sum("delta").alias("delta"))
                           .withColumn("n_docs", F.greatest(F.col("old") + F.col("delta"), F.lit(0))))
        nxt = self.version + 1
        both.where("n_docs > 0").select("shard", "digest", "n_docs").write.mode("overwrite").parquet(self._at("counts", nxt))
        least = self.min_docs
        turned = both.where(f"(old >= {least}) != (n_docs >= {least})").select("shard", "digest", (F.col("n_docs") >= least).alias("enters"))
        if not self.version:
            made = build_filters(both.select("shard", "digest", "n_docs"), least)
        else:
            def update(changes: pa.Table, old: pa.Table) -> pa.Table:
                shard = (changes if changes.num_rows else old).column("shard")[0].as_py()
                keys: set[bytes] = set()
                if old.num_rows:
                    packed = old.column("digests")[0].as_py()
                    keys = {packed[i:i + 16] for i in range(0, len(packed), 16)}
                enter = [d for d, e in zip(changes.column("digest").to_pylist(), changes.column("enters").to_pylist()) if e]
                leave = [d for d, e in zip(changes.column("digest").to_pylist(), changes.column("enters").to_pylist()) if not e]
                room = old.num_rows and (len(keys) + len(enter)) <= 0.95 * len(old.column("buckets")[0].as_py()) / 2
                after = sorted((keys - set(leave)) | set(enter))
                if room:
                    own = Cuckoo(1, old.column("buckets")[0].as_py(), old.column("stash")[0].as_py())
                    for d in leave:
                        own.delete(d)
                    for d in sorted(enter):
                        own.insert(d)
                else:  # full: made anew from the exact keys
                    own = Cuckoo(len(after))
                    for d in after:
                        own.insert(d)
                return pa.table([pa.array([shard], pa.int32()), pa.array([len(after)], pa.int64()), pa.array([own.table.tobytes()], pa.binary()),
                                 pa.array([own.stash], pa.list_(pa.binary())), pa.array([b"".join(after)], pa.binary())], ["shard", "n_keys", "buckets", "stash", "digests"])

            made = turned.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(update, FILTER_SCHEMA)
        made.write.mode("overwrite").parquet(self._at("filters", nxt))
        self.version = nxt

    def insert(self, docs: DataFrame, text_col: str = "text") -> None:
        self._change(docs, 1, text_col)

    def delete(self, docs: DataFrame, text_col: str = "text") -> None:
        """Takes out documents that were inserted, given with the same texts."""
        self._change(docs, -1, text_col)

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` without the lines that are common in the indexed documents."""
        return drop_common_lines(docs, self.filters, self.counts, id_col, text_col, self.shards, self.min_docs, self.min_chars)
