"""SentencePiece encoding by sampling, and decoding.

A text is a lattice of pieces: every way to spell it with the vocabulary is
a path, weighted by exp(alpha * sum of piece scores). The forward filter
gives each position the total weight of the paths into it; walking backward
from the end, each step draws the last piece in proportion to the weight of
the paths that end with it. Draws are a hash of the row key, the unit of
the text and the step, so that a row always gets the same segmentation,
whatever the partitioning.

No piece has a space after another character or spans a line break that the
vocabulary lacks, so a lattice falls apart into units (a word with its
spaces). Units are filtered many at a time with arrays and remembered.
Characters outside the vocabulary become byte pieces, also a literal space
mark; decoding gives back every text exactly.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import id_and_text, map_batches, mix64
from .pieces import PieceTable, piece_table

ALPHA = 1e-4
EDGE_LIMIT = 6_000_000
DENSE_CLASSES = 160
FLUSH_UNITS = 1 << 18
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Lattices:
    """Forward-filtered lattices of the units met so far.

    A node is a position in a unit; node r owns the edges whose key lies in
    [r, r + 1), the keys being r plus the cumulative probability.
    """

    def __init__(self, pieces: PieceTable, alpha: float) -> None:
        self.pieces, self.alpha = pieces, alpha
        self.unit = re.compile(r"\n| *[^ \n]+| +" if "\n" not in pieces.chars else r" *[^ ]+| +")
        self._trie()
        self.surface = [p.encode() for p in pieces.text]
        for b, i in enumerate(pieces.byte_id):
            self.surface[i] = bytes([b])
        self.forget()

    def _trie(self) -> None:
        p = self.pieces
        uses: dict[str, int] = {}
        for piece in p.ids:
            for c in piece:
                uses[c] = uses.get(c, 0) + 1
        order = sorted(uses, key=lambda c: (-uses[c], c))
        cls = {c: k for k, c in enumerate(order)}
        self.byte_class = len(order)
        self.n_class = len(order) + 256
        self.class_of = np.full(0x110000, -1, dtype=np.int32)
        for c, k in cls.items():
            self.class_of[ord(c)] = k
        spelled = [([cls[c] for c in s], i) for s, i in p.ids.items()] + [([self.byte_class + b], i) for b, i in enumerate(p.byte_id)]
        children: list[dict[int, int]] = [{}]
        ends = {}
        for syms, i in spelled:
            node = 0
            for k in syms:
                if k not in children[node]:
                    children[node][k] = len(children)
                    children.append({})
                node = children[node][k]
            ends[node] = i
        inner = [n for n in range(len(children)) if children[n]]
        number = {n: r for r, n in enumerate(inner + [n for n in range(len(children)) if not children[n]])}
        self.n_inner = len(inner)
        self.node_piece = np.full(len(children), -1, dtype=np.int32)
        for n, i in ends.items():
            self.node_piece[number[n]] = i
        self.dense = np.full((self.n_inner, DENSE_CLASSES), -1, dtype=np.int32)
        sparse = []
        for n in inner:
            for k, m in children[n].items():
                if k < DENSE_CLASSES:
                    self.dense[number[n], k] = number[m]
                else:
                    sparse.append((number[n] * self.n_class + k, number[m]))
        sparse.sort()
        self.sparse_key = np.array([k for k, _ in sparse] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.sparse_to = np.array([m for _, m in sparse] + [-1], dtype=np.int32)
        self.weight = np.zeros(p.size)
        for s, i in p.ids.items():
            self.weight[i] = self.alpha * p.scores[s]

    def forget(self) -> None:
        self.ends: dict[str, int] = {}
        self.n_nodes = 0
        self.key, self.before, self.piece = np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _step(self, node: np.ndarray, sym: np.ndarray) -> np.ndarray:
        nxt = np.full(len(node), -1, dtype=np.int32)
        inner = node < self.n_inner
        near = inner & (sym < DENSE_CLASSES)
        nxt[near] = self.dense[node[near], sym[near]]
        far = np.flatnonzero(inner & ~near)
        if len(far):
            want = node[far].astype(np.int64) * self.n_class + sym[far]
            at = np.searchsorted(self.sparse_key, want)
            nxt[far] = np.where(self.sparse_key[at] == want, self.sparse_to[at], -1)
        return nxt

    def _symbols(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol classes of the units end to end, and the units' lengths in symbols."""
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        sym = self.class_of[codes]
        odd = np.flatnonzero(sym < 0)
        if len(odd):
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in codes[odd]]
            n_sym = np.ones(len(sym), dtype=np.int64)
            n_sym[odd] = [len(b) for b in spelled]
            first = np.cumsum(n_sym) - n_sym
            out = np.repeat(sym, n_sym)
            for at, b in zip(first[odd], spelled):
                out[at:at + len(b)] = np.frombuffer(b, dtype=np.uint8).astype(np.int32) + self.byte_class
            starts = np.cumsum(lengths) - lengths
            return out, np.add.reduceat(n_sym, starts)
        return sym, lengths

    def learn(self, units: list[str]) -> None:
        """Forward filter of new units; appends their edges."""
        if not units:
            return
        sym, lengths = self._symbols(units)
        n = len(sym)
        unit_start = np.cumsum(lengths) - lengths
        stop = np.repeat(unit_start + lengths, lengths)
        first = np.repeat(unit_start, lengths)
        starts, stops, found = [], [], []
        at = np.arange(n)
        node = np.zeros(n, dtype=np.int32)
        for length in range(1, self.pieces.longest + 1):
            node = self._step(node, sym[at + length - 1])
            alive = node >= 0
            at, node = at[alive], node[alive]
            piece = self.node_piece[node]
            hit = piece >= 0
            starts.append(at[hit])
            stops.append(at[hit] + length)
            found.append(piece[hit])
            more = at + length < stop[at]
            at, node = at[more], node[more]
            if not len(at):
                break
        start, end, piece = np.concatenate(starts), np.concatenate(stops), np.concatenate(found)
        depth = end - first[start]
        order = np.argsort(depth * (n + 1) + end, kind="stable")
        start, end, piece, depth = start[order], end[order], piece[order], depth[order]
        head = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
        owner = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(end)]))
        node_of_end = np.full(n + 1, -1, dtype=np.int64)
        node_of_end[end[head]] = np.arange(len(head))
        from_first = start == first[start]
        before = np.where(from_first, -1, node_of_end[start])
        log_f = np.zeros(len(head))
        share = np.empty(len(end))
        weight = self.weight[piece]
        level = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1]])
        for lo, hi in zip(level, np.r_[level[1:], len(end)]):
            value = weight[lo:hi] + np.where(before[lo:hi] < 0, 0.0, log_f[before[lo:hi]])
            heads = head[owner[lo]:owner[hi - 1] + 1] - lo
            own = owner[lo:hi] - owner[lo]
            top = np.maximum.reduceat(value, heads)
            value = np.exp(value - top[own])
            total = np.add.reduceat(value, heads)
            log_f[owner[lo]:owner[hi - 1] + 1] = top + np.log(total)
            run = np.cumsum(value)
            run -= (run[heads] - value[heads])[own]
            share[lo:hi] = run / total[own]
        share[np.r_[head[1:], len(end)] - 1] = 1.0
        np.clip(share, 0.0, 1.0, out=share)
        self.key = np.concatenate([self.key, self.n_nodes + owner + share])
        self.before = np.concatenate([self.before, np.where(before < 0, -1, before + self.n_nodes).astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece.astype(np.int32)])
        last = node_of_end[unit_start + lengths] + self.n_nodes
        self.ends.update(zip(units, last.tolist()))
        self.n_nodes += len(head)

    def sample(self, units: list[str], seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A drawn segmentation per unit: piece ids end to end, and their number."""
        if len(self.key) > EDGE_LIMIT:
            self.forget()
        self.learn([u for u in dict.fromkeys(units) if u not in self.ends])
        node = np.fromiter(map(self.ends.__getitem__, units), dtype=np.int64, count=len(units))
        active = np.argsort(node)  # neighbouring nodes together: their edges are near each other
        node, rounds, count = node[active], [], np.zeros(len(units), dtype=np.int64)
        while len(active):
            draw = mix64(seed[active] + mix64(np.array([len(rounds) + 1], dtype=np.uint64) * _GOLDEN))
            edge = np.searchsorted(self.key, node + (draw >> np.uint64(12)) * 2.0 ** -52, side="right")
            rounds.append((active, self.piece[edge]))
            count[active] += 1
            node = self.before[edge].astype(np.int64)
            more = node >= 0
            active, node = active[more], node[more]
        ids = np.empty(int(count.sum()), dtype=np.int32)
        stop = np.cumsum(count)
        for r, (which, piece) in enumerate(rounds):
            ids[stop[which] - 1 - r] = piece
        return ids, count

    def decode(self, ids: list[int]) -> bytes:
        """The text's UTF-8 bytes; the encoder's leading space goes."""
        return b"".join(map(self.surface.__getitem__, ids))[1:]


_LATTICES: dict[tuple[str, float], Lattices] = {}


def lattices(path: str, alpha: float = ALPHA) -> Lattices:
    if (path, alpha) not in _LATTICES:
        _LATTICES[path, alpha] = Lattices(piece_table(path), alpha)
    return _LATTICES[path, alpha]


def _encode_texts(lat: Lattices, keys: list, texts: list[str | None], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts end to end, and the number of each text.

    Texts are taken in groups of bounded size, a very long one on its own."""
    all_ids, all_counts = [], []
    group: list[list[str]] = []
    group_keys: list = []

    def flush() -> None:
        sizes = np.fromiter(map(len, group), dtype=np.int64, count=len(group))
        row_seed = np.fromiter((xxhash.xxh64_intdigest(str(k), seed) for k in group_keys), dtype=np.uint64, count=len(group))
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        ordinal = (np.arange(int(sizes.sum())) - first).astype(np.uint64)
        ids, count = lat.sample([u for g in group for u in g], mix64(np.repeat(row_seed, sizes) + mix64(ordinal + _GOLDEN)))
        total = np.r_[0, np.cumsum(count)]
        stop = np.cumsum(sizes)
        all_ids.append(ids)
        all_counts.append(total[stop] - total[stop - sizes])
        group.clear()
        group_keys.clear()

    held = 0
    for key, text in zip(keys, texts):
        units = lat.unit.findall(" " + text) if text else []
        if held and held + len(units) > FLUSH_UNITS:
            flush()
            held = 0
        group.append(units)
        group_keys.append(key)
        held += len(units)
    if group:
        flush()
    return np.concatenate(all_ids), np.concatenate(all_counts)


def encode_sampled(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                   alpha: float = ALPHA, seed: int = 0) -> DataFrame:
    """``doc_id, piece_ids, lossless`` per row: a sampled segmentation of the whole text.

    ``lossless`` says that decoding gave back the text. Null and empty texts
    have no pieces. Equal (id, text, seed) give equal pieces wherever the row
    is; a null id is a key of its own. An empty table gives no rows; columns
    other than the two named are not read. A smaller ``alpha`` samples more
    freely. ``model_path`` must exist on every executor.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lat = lattices(model_path, alpha)
        texts = batch.column("text").to_pylist()
        ids, counts = _encode_texts(lat, batch.column("doc_id").to_pylist(), texts, seed)
        offsets = np.r_[0, np.cumsum(counts)]
        same = [lat.decode(ids[a:b].tolist()) == (t or "").encode() for t, a, b in zip(texts, offsets[:-1], offsets[1:])]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return pa.record_batch([batch.column("doc_id"), lists, pa.array(same)], ["doc_id", "piece_ids", "lossless"])

    return map_batches(id_and_text(docs, id_col, text_col), run, "doc_id long, piece_ids array<int>, lossless boolean")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "piece_ids") -> DataFrame:
    """``doc_id, text`` from piece ids; null ids give a null text, no ids the empty text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lat = lattices(model_path)
        texts = [None if ids is None else lat.decode(ids).decode("utf-8", "replace") for ids in batch.column("piece_ids").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"cast(`{ids_col}` as array<int>) AS piece_ids")
    return map_batches(rows, run, "doc_id long, text string")
