"""Token counts by a compiled finite-state tokenizer.

The BPE vocabulary is compiled, state by state as texts need them, into a
deterministic transducer whose transitions carry the change in the number
of emitted tokens. A token sequence is the tokenizer's own exactly if every
adjacent pair of its tokens is, so a state needs to hold only the places
where a token may still have begun: (trie node reached from there, token
before it, tokens emitted since). Transitions into a character that no
piece joins to the one before lead back to the start state.

A text is cut into chunks. The map of a chunk says, for any state before
it, how many tokens it emits and which state follows: the characters up to
the chunk's first return to the start state, the tokens of the rest and the
state at its end. Maps compose associatively, and a pairwise scan folds
them. Within a chunk whole units (start state to start state) are
remembered as one transition.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MEMO_ENTRIES, id_and_text, map_batches
from .pieces import SPACE_MARK, PieceTable, piece_table

CHUNK_CHARS = 1 << 16
STATE_LIMIT = 200_000
ChunkMap = tuple[str, int, int]  # head, tokens after the head, state at the end (-1: all is head)
_UNIT = re.compile(r" +[^ ]*")


class _Memo(dict):
    """Unit (without its one leading space, if any) -> tokens emitted from the start state."""

    def __init__(self, run, prefix: str) -> None:
        super().__init__()
        self.run, self.prefix = run, prefix

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[word] = self.run(0, self.prefix + word)[1]
        return value


class Transducer:
    """Deterministic transducer of one vocabulary; states are made when first reached."""

    def __init__(self, pieces: PieceTable) -> None:
        self.pieces = pieces
        self.children: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        for piece in pieces.ids:
            node = 0
            for c in piece:
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = nxt
            self.token[node] = piece
        self._pairs: dict[tuple[str, str], bool] = {}
        self._halves: dict[str, tuple[str, str] | None] = {}
        self._reset()
        self.spaced = _Memo(self.run, " ")
        self.bare = _Memo(self.run, "")

    def _reset(self) -> None:
        self.states = [((0, "", 0),)]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the tokenizer's last merge joined to make ``piece``;
        None for a character, ("", "") for a piece that merging never makes."""
        known = self._halves.get(piece, 0)
        if known == 0:
            scores, parts, known = self.pieces.scores, list(piece), None
            while len(parts) > 1:
                best = max(((scores[p], -i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in scores), default=None)
                if best is None:
                    known = "", ""
                    break
                i = -best[1]
                known = parts[i], parts[i + 1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self._halves[piece] = known
        return known

    def follows(self, before: str, token: str) -> bool:
        """Whether the tokenizer splits ``before + token`` into these two.

        Undoes the merges next to the border, the latest first; the border
        holds if at no time its two neighbours would have merged before one
        of them was taken up by the merge undone last.
        """
        if self.halves(token) == ("", ""):
            return False
        if not before:
            return True
        known = self._pairs.get((before, token))
        if known is not None:
            return known
        scores, (left, right) = self.pieces.scores, (before, token)
        until, at_right = float("-inf"), False  # the undone merge's score; whether it was right of the border
        known = True
        while known:
            joint = scores.get(left + right)
            # equal scores: the leftmost pair merges first
            if joint is not None and (joint > until or joint == until and at_right):
                known = False
                break
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                break
            if b is None or a is not None and scores[left] < scores[right]:
                until, at_right, left = scores[left], False, a[1]
            else:
                until, at_right, right = scores[right], True, b[0]
        if len(self._pairs) >= MEMO_ENTRIES:
            self._pairs.clear()
        self._pairs[before, token] = known
        return known

    def move(self, state: int, c: str) -> tuple[int, int]:
        """Next state and change of the token count; the transition is kept."""
        places = self.states[state]
        last = places[-1][1]
        if last and last[-1] + c not in self.pieces.bigrams:
            places = self.states[0]
        if c not in self.pieces.chars:
            found = 0, len(c.encode())
        else:
            live, ended = [], None
            for node, before, emitted in places:
                node = self.children[node].get(c)
                if node is not None:
                    token = self.token[node]
                    if token is not None and ended is None and self.follows(before, token):
                        ended = token, 1 - emitted
                    if self.children[node]:
                        live.append((node, before, emitted))
            token, change = ended
            nxt = (*((n, b, e + change) for n, b, e in live), (0, token, 0))
            at = self.number.get(nxt)
            if at is None:
                at = self.number[nxt] = len(self.states)
                self.states.append(nxt)
                self.moves.append({})
            found = at, change
        self.moves[state][c] = found
        return found

    def run(self, state: int, text: str) -> tuple[int, int]:
        """State and tokens after ``text`` (spaces as such), from ``state``."""
        total, moves = 0, self.moves
        for c in text:
            nxt = moves[state].get(c)
            state, change = nxt if nxt is not None else self.move(state, c)
            total += change
        return state, total

    def units(self, text: str) -> int:
        """Tokens of a text that begins with a space in the start state."""
        total, first = 0, True
        for line in text.split("\n") if "\n" not in self.pieces.chars else [text]:
            if first:
                first = False
            else:
                total += 1
                if not line:
                    continue
                if line[0] != " ":
                    head, _, line = line.partition(" ")
                    total += self.bare[head]
                    if not _:
                        continue
                    line = " " + line
            if "  " in line:
                for unit in _UNIT.findall(line):
                    total += self.run(0, unit)[1] if unit[:2] == "  " else self.spaced[unit[1:]]
            else:
                total += sum(map(self.spaced.__getitem__, line[1:].split(" ")))
        return total

    def chunk_map(self, chunk: str) -> ChunkMap:
        """The map of one chunk; its head ends where a space follows another character."""
        first = re.search(r"(?<=[^ ]) ", chunk)
        if first is None:
            return chunk, 0, -1
        head, rest = chunk[:first.start()], chunk[first.start():]
        tail = re.search(r" +[^ ]*\Z", rest).start()
        state, last = self.run(0, rest[tail:])
        return head, (self.units(rest[:tail]) if tail else 0) + last, state

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of two neighbouring chunks; associative."""
        if a[2] < 0:
            return a[0] + b[0], b[1], b[2]
        state, emitted = self.run(a[2], b[0])
        return a[0], a[1] + emitted + b[1], state if b[2] < 0 else b[2]

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """Pairwise rounds of composition, as a parallel scan does them."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        if not text:
            return 0
        if len(self.states) > STATE_LIMIT:
            self._reset()
        text = " " + text.replace(SPACE_MARK, " ")
        if len(text) <= chunk_chars:
            return self.units(text)
        head, rest, state = self.scan([self.chunk_map(text[i:i + chunk_chars]) for i in range(0, len(text), chunk_chars)])
        return self.run(0, head)[1] + (rest if state >= 0 else 0)


_MACHINES: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(piece_table(path))
    return _MACHINES[path]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row of ``docs``.

    A null text counts as empty (0 bytes, 0 tokens). A null id stays null,
    repeated rows give repeated results, an empty table gives none. Texts of
    any length are read whole, chunk by chunk. Columns other than the two
    named are not read. ``model_path`` must exist on every executor.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(model_path)
        texts = batch.column("text").to_pylist()
        counts = np.fromiter((machine.count(t, chunk_chars) if t else 0 for t in texts), dtype=np.int64, count=len(texts))
        return pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    rows = id_and_text(docs, id_col, text_col).withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    return map_batches(rows, run, "doc_id long, n_bytes long, n_tokens long")
