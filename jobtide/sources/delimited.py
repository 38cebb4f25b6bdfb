"""Delimited text whose files differ in column order and may hold line breaks
inside quoted fields (SRC-01, SRC-03, SRC-08).

One pass over the lines surveys the files: header, whether a quoted field goes
over a line end, and how many quotes each input split holds. Then

* files are grouped by header and their columns matched by name;
* files without such fields go to the CSV reader, which splits them freely;
* the others are split just the same. The quotes before a split tell whether it
  starts inside a quoted field, so every task puts its lines together into records,
  and only records that cross a split's end are joined, through a small shuffle.

No file is one task because of a line break in it.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV_OPTIONS = {"sep": ";", "header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
               "mode": "PERMISSIVE"}
EXTRA = "_extra"
_LINE = re.compile(r"([^\r\n]*)(\r\n|\r|\n)")
_SURVEY = "file string, start bigint, odd boolean, crosses boolean, header string"
_RECORDS = "file string, start bigint, kind string, text string"


@dataclass(frozen=True)
class SourceFile:
    """One input file: path, column names in its order, and whether records cross line ends."""
    path: str
    names: tuple[str, ...]
    crosses: bool


def all_string_schema(names, extra: bool = False) -> StructType:
    fields = [StructField(n, StringType(), True) for n in names]
    if extra:
        fields.append(StructField(EXTRA, StringType(), True))
    return StructType(fields)


def _lines(spark: SparkSession, paths) -> DataFrame:
    """Lines in file order within a task; ``start`` is the first byte of their split."""
    text = spark.read.option("lineSep", "\n").text(list(paths))
    return text.select(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, start, first row, rows) of each split in a batch."""
    at = 0
    ends = {e for c in (0, 1) for e in pc.run_end_encode(batch.column(c)).run_ends.to_pylist()}
    for k in sorted(ends):
        yield batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), at, k - at
        at = k


def _has(lines: pa.Array, text: str) -> bool:
    return bool(pc.any(pc.match_substring(lines, text)).as_py())


def _split_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: odd number of quotes, a record over a line end, first record of the file."""
    facts: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, start, at, n in _runs(batch):
            lines = batch.column(2).slice(at, n)
            quotes = pc.count_substring(lines, '"')
            odd = pc.bit_wise_and(quotes, 1)
            row = facts.setdefault((file, start), [0, False, None, False])
            row[1] = row[1] or bool(pc.any(pc.equal(odd, 1)).as_py()) or _has(lines, "\r") and bool(
                pc.any(pc.match_substring_regex(lines, r"\r[^\r]")).as_py())
            row[0] ^= pc.sum(odd).as_py() & 1
            if start == 0 and not row[3]:
                for text, end in (x for line in lines.to_pylist() for x in _LINE.findall(line + "\n")):
                    if row[2] is None and not text.strip():
                        continue
                    row[2] = (row[2] or "") + text
                    if row[2].count('"') % 2 == 0:
                        row[3] = True
                        break
                    row[2] += end
    rows = [(f, s, bool(r[0]), r[1], r[2]) for (f, s), r in facts.items()]
    if rows:
        types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                         names=["file", "start", "odd", "crosses", "header"])


def header_names(record: str, sep: str = ";") -> tuple[str, ...]:
    """Names of a header record; empty names become ``_c<i>``, repeated ones get their position."""
    cells = next(csv.reader(io.StringIO(record, newline=""), delimiter=sep), [])
    if cells:
        cells[0] = cells[0].removeprefix("\ufeff")
    folded = [c.lower() for c in cells]
    return tuple(f"_c{i}" if not c else f"{c}{i}" if folded.count(c.lower()) > 1 else c
                 for i, c in enumerate(cells))


def survey(spark: SparkSession, paths, sep: str = ";") -> list[SourceFile]:
    """Every non-empty file with its header, in path order. The driver gets one row
    per input split, as many as it plans tasks for, of all tasks at once: a local iterator
    would run them one after the other."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    found: dict[str, list] = {}
    for r in _lines(spark, paths).mapInArrow(_split_facts, _SURVEY).collect():
        row = found.setdefault(r["file"], [None, False])
        row[0] = row[0] if r["header"] is None else r["header"]
        row[1] = row[1] or r["crosses"]
    return [SourceFile(unquote(f), header_names(h, sep), crosses)
            for f, (h, crosses) in sorted(found.items()) if h is not None]


def _assemble(inside: dict[tuple[str, int], bool], kinds: tuple[str, ...]):
    """Lines → records of the wanted kinds: ``record``; ``tail``, open at its split's end;
    ``head``, the rest of a record that an earlier split began."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, quoted, kind, parts, last_end, header_due = None, False, "record", [], "", False
        out: list[tuple] = []

        def put(file, start, which, text):
            nonlocal header_due
            if which == "record" and header_due and text.strip():
                header_due = False
            elif which in kinds and (which != "record" or text.strip()):
                out.append((file, start, which, text))

        for batch in batches:
            for file, start, at, n in _runs(batch):
                if (file, start) != key:
                    if parts:
                        put(*key, "head" if kind == "head" else "tail", "".join(parts))
                    key, quoted, parts, last_end = (file, start), inside[file, start], [], ""
                    kind, header_due = "head" if quoted else "record", start == 0
                lines = batch.column(2).slice(at, n)
                if _has(lines, "\r"):                # lines that the text reader did not part
                    for text, end in (x for line in lines.to_pylist() for x in _LINE.findall(line + "\n")):
                        parts += [last_end, text] if parts or kind == "head" else [text]
                        quoted ^= bool(text.count('"') & 1)
                        last_end = end
                        if not quoted:
                            put(file, start, kind, "".join(parts))
                            kind, parts, last_end = "record", [], ""
                    continue
                # a record ends with each line after which the number of quotes is even
                after = (pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).cumsum() + quoted) & 1
                closed = (after == 0).nonzero()[0].tolist()
                quoted, first = bool(after[-1]), 0
                if "record" not in kinds and kind == "record" and closed:
                    parts, last_end, first, closed = [], "", closed[-1] + 1, []
                texts = lines.slice(first).to_pylist()
                begin = 0
                for stop in closed:
                    text = texts[begin] if begin == stop else "\n".join(texts[begin:stop + 1])
                    put(file, start, kind, "".join([*parts, last_end, text]) if parts else text)
                    kind, parts, last_end, begin = "record", [], "", stop + 1
                if begin < len(texts):
                    parts += [last_end, "\n".join(texts[begin:])]
                    last_end = "\n"
            if out:
                yield _record_batch(out)
                out = []
        if parts:
            put(*key, "head" if kind == "head" else "tail", "".join(parts))
        if out:
            yield _record_batch(out)

    return run


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["file", "start", "kind", "text"])


def crossing_records(spark: SparkSession, paths) -> DataFrame:
    """``text``: the records, without headers, of files whose records cross line ends."""
    lines = _lines(spark, paths)
    splits: dict[str, list] = {}
    for r in lines.mapInArrow(_split_facts, _SURVEY).collect():
        splits.setdefault(r["file"], []).append((r["start"], r["odd"]))
    inside = {}
    for file, rows in splits.items():
        quoted = False
        for start, odd in sorted(rows):
            inside[file, start] = quoted
            quoted ^= odd
    made = lines.mapInArrow(_assemble(inside, ("record",)), _RECORDS)
    # A record over a split's end: its tail, then the heads up to where it closes.
    parts = lines.mapInArrow(_assemble(inside, ("head", "tail")), _RECORDS)
    order = Window.partitionBy("file").orderBy("start", "kind")  # head < tail
    began = parts.withColumn("began", F.last(F.when(F.col("kind") == "tail", F.col("start")), True).over(order))
    joined = began.groupBy("file", "began").agg(F.expr(
        "concat_ws('\n', transform(array_sort(collect_list(struct(start, text))), x -> x.text))").alias("text"))
    return made.select("text").unionByName(joined.select("text"))


def _read_class(spark: SparkSession, names, files: list[SourceFile], sep: str, extra: bool) -> list[DataFrame]:
    """Readers of the files that share one header."""
    schema = all_string_schema(names, extra)
    options = {**CSV_OPTIONS, "sep": sep}
    out = []
    if plain := [f.path for f in files if not f.crosses]:
        out.append(spark.read.options(**options).schema(schema).csv(plain))
    if crossing := [f.path for f in files if f.crosses]:
        rows = F.from_csv("text", _ddl(schema), {k: v for k, v in options.items() if k != "header"})
        out.append(crossing_records(spark, crossing).select(rows.alias("r")).select("r.*"))
    return out


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)


def read_by_name(spark: SparkSession, paths, sep: str = ";", skip_long: bool = False,
                 allow_missing: bool = False, check=None) -> DataFrame:
    """Every field as text, columns matched by name across files.

    Short rows are padded with null; fields beyond the header are cut, or with
    ``skip_long`` the whole row is left out. All files must have the same names, in any
    order; with ``allow_missing`` absent columns are null. ``check`` sees the names before any row is read.
    """
    files = survey(spark, paths, sep)
    if not files:
        raise ValueError(f"no header found in {paths}")
    names = list(files[0].names)
    for f in files[1:]:
        odd = sorted(set(f.names) ^ set(files[0].names))
        if odd and not allow_missing:
            raise ValueError(f"columns of {f.path} and {files[0].path} differ: {odd}")
        names += [n for n in f.names if n not in names]
    if check is not None:
        check(names)
    frame = None
    for header in dict.fromkeys(f.names for f in files):
        for part in _read_class(spark, header, [f for f in files if f.names == header], sep, skip_long):
            if skip_long:
                part = part.filter(F.col(EXTRA).isNull()).drop(EXTRA)
            frame = part if frame is None else frame.unionByName(part, allowMissingColumns=True)
    return frame.select(*[F.col(f"`{n}`") for n in names])
