"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are
context, and only that reply is under the loss mask. Turns after the last
reply end in one further example without a mask, so that no turn is lost.

A turn reads ``[TURN role] text </TURN>`` with the marks below. Inside
roles and texts, a backslash is doubled and one is put into every mark, so
that the output reads back to exactly the turns that went in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, BODY, CLOSE = "<s>[INST ", "]\n", "</s>\n"
#: Control strings that no text may spell unescaped: this template's and those of the common chat formats.
CONTROLS = ("<s>", "</s>", "[INST", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(OPEN) + r"((?:[^\\\]]|\\.)*)" + re.escape(BODY) + r"(.*?)" + re.escape(CLOSE), re.DOTALL)
EXAMPLE = "conv_id long, example long, formatted string, loss_start long, loss_stop long, n_turns long, is_last boolean"
OUT_CHARS = 4 << 20


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def open_turn(role: str | None) -> str:
    return OPEN + escape(role or "").replace("]", "\\]") + BODY


def expand(turns: list[tuple[str | None, str | None]]) -> Iterator[tuple[str, int, int, int]]:
    """(formatted, loss start, loss stop, turns) of each example; the mask is empty where nothing is trained."""
    prefix, trained = "", 0
    for n, (role, text) in enumerate(turns, 1):
        head, body = open_turn(role), escape(text or "")
        start = len(prefix) + len(head)
        prefix += head + body + CLOSE
        if role == "assistant":
            trained = n
            yield prefix, start, start + len(body), n
    if trained < len(turns):
        yield prefix, 0, 0, len(turns)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted example."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per example: ``conv_id, example, formatted, loss_start, loss_stop, n_turns, is_last``.

    Positions count code points. Turns go by (turn, role, text); rows that
    repeat stay. A null text is empty, a null role an empty role, null turns
    come first, null conversation ids form one conversation. An empty table
    gives no rows. A conversation's own turns are the only thing gathered.
    """
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.struct(
        F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("conv_id", pa.int64()), ("example", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()),
                  ("loss_stop", pa.int64()), ("n_turns", pa.int64()), ("is_last", pa.bool_())]

        def made(out: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[k] for r in out], t) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])

        out, held = [], 0
        for batch in batches:
            for conv, roles, texts in zip(*(batch.column(c) for c in ("conv_id", "roles", "texts"))):
                turns = list(zip(roles.as_py(), texts.as_py()))
                for k, (formatted, start, stop, n) in enumerate(expand(turns)):
                    out.append((conv.as_py(), k, formatted, start, stop, n, n == len(turns)))
                    held += len(formatted)
                    if held >= OUT_CHARS:
                        yield made(out)
                        out, held = [], 0
        if out:
            yield made(out)

    return chats.mapInArrow(run, EXAMPLE)


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: turns, text under the mask, and sizes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            turns, losses = [], []
            for r in rows:
                if r["is_last"]:
                    spelled = "".join(f"{role}\n{text}\n" for role, text in read_back(r["formatted"]))
                    turns.append(hashlib.sha256(spelled.encode()).hexdigest())
                else:
                    turns.append(None)
                losses.append(unescape(r["formatted"][r["loss_start"]:r["loss_stop"]]))
            yield pa.record_batch([batch.column("conv_id"), batch.column("example"), batch.column("n_turns"),
                                   pa.array([len(r["formatted"]) for r in rows], pa.int64()), pa.array(turns, pa.string()),
                                   pa.array(losses, pa.string())],
                                  ["conv_id", "example", "n_turns", "chars", "turns_sha256", "loss"])

    parts = examples.mapInArrow(run, "conv_id long, example long, n_turns long, chars long, turns_sha256 string, loss string")
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    return parts.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), loss.alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    ).select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
             F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
