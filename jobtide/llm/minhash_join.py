"""Near-duplicate documents by an inverted join over MinHash signatures.

1. A document's distinct word shingles give a digest of the set and a
   signature of minima. Documents with equal sets form a class, a node of
   its own number, kept by its smallest doc_id.
2. Two sets above the similarity threshold agree in at least ``matches`` of
   the signature's coordinates (but for a chance below ``MISS``). All classes
   sort their coordinate-value pairs by one order, the rarest first, so two
   such sets share one of their first ``coordinates - matches + 1`` pairs: only
   this prefix is posted, a row each. What a common passage or a large group
   of copies brings to many documents is so left out wherever enough else is there.
3. The members of a posting list are compared by counting collisions over
   whole signatures. Each member is paired with its nearest neighbours of
   enough collisions before and after it; lists and members that are
   settled are skipped, so a list of n copies gives at most 2n pairs.
4. Pairs are confirmed on the full shingle sets; confirmed links are joined
   to components.
5. Later rounds visit only lists that still hold several components, and
   pair members of different ones: first a few partners each, then all
   that are left. A pair that shares several lists is skipped in all but
   the first, and one whose odd sketches differ in more bits than the sets
   of a link may differ in shingles is refused there. Every pair above the
   match threshold is so either confirmed, refused or already within one
   component.

Long posting lists are split by a salt, and the members that head a split
meet. Where these are many, a common passage and not copying brings the
list together: it is posted anew by a further pair, which parts it, and
so on while it has more than ``VISITS`` splits. In later rounds members outside
a list's largest component meet all splits, also heads without a candidate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WordHashes, as_bytes, id_and_text, map_batches, mix64, word_hashes

SHINGLE = 5
COORDINATES = 32
MISS = 1e-6
PARTNERS = 16
LIST_ROWS = 1024
VISITS = 8
SMALL_TABLE = 100_000
#: Longer lists count by their length in the order of pairs, shorter ones are all alike.
RARE_ROWS = 16
TASK_EDGES = 200_000
SKETCH_BITS = 512
_SALTS = 16
_GOLDEN = 0x9E3779B97F4A7C15
_FACTORS = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)
_OFFSETS = mix64(np.arange(101, COORDINATES + 101, dtype=np.uint64) * np.uint64(_GOLDEN))


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Most collisions that a pair at the threshold reaches but for a chance of ``miss``."""
    p, below, t = percent / 100, 0.0, 0
    while True:
        below += comb(coordinates, t) * p ** t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(1, t)
        t += 1


def shingle_set(text: bytes | None, memo: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words, memo)
    size = min(size, len(words))
    key = h[:len(h) - size + 1].copy()
    for k in range(1, size):
        key = mix64(key * np.uint64(_GOLDEN) + h[k:len(h) - size + 1 + k])
    return np.unique(mix64(key + np.uint64(size)))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, digest, low, sig``: 32 bits for every coordinate-value pair and 16 bits of every coordinate; nulls for empty sets. Also ``text_hash`` if ``docs`` has it."""
    hashed = ["text_hash"] if "text_hash" in docs.columns else []

    def run(batch: pa.RecordBatch, memo: WordHashes = WordHashes()) -> pa.RecordBatch:
        sets = [shingle_set(t, memo, shingle) for t in as_bytes(batch.column("text"))]
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        digests, lows, sigs = ([None] * len(sets) for _ in range(3))
        if len(full):
            every = np.concatenate([sets[i] for i in full])
            starts = np.cumsum(sizes[full]) - sizes[full]
            minima = np.stack([np.minimum.reduceat(mix_low(every, k), starts) for k in range(COORDINATES)], 1)
            short = (minima & np.uint64(0xFFFF)).astype(np.uint16)
            posted = (mix64(minima + _OFFSETS) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            for row, i in enumerate(full):
                digests[i], lows[i], sigs[i] = _digest(sets[i]), posted[row].tolist(), short[row].tobytes()
        return pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(lows, pa.list_(pa.int32())),
                                pa.array(sigs, pa.binary()), *[batch.column(c) for c in hashed]], ["doc_id", "n_shingles", "digest", "low", "sig", *hashed])

    return map_batches(docs, run, "doc_id long, n_shingles long, digest binary, low array<int>, sig binary" + "".join(f", {c} binary" for c in hashed))


def mix_low(shingles: np.ndarray, k: int) -> np.ndarray:
    """The k-th ordering of shingles: a product, its high bits mixed into the low ones."""
    x = (shingles ^ _OFFSETS[k]) * _FACTORS[k]
    return x ^ (x >> np.uint64(32))


def _ordered(classes: DataFrame) -> DataFrame:
    """``classes`` with ``ord``, the coordinates by (length of their pair's list, pair).

    A pair is posted under a hash of its coordinate and its ``low``. Only the lengths of
    lists of over ``RARE_ROWS`` rows are looked up, for the members of these lists.
    """
    pairs = classes.select("node", F.posexplode("low").alias("pos", "own")).select("node", "pos", F.xxhash64("pos", "own").alias("token"))
    long = cut_lineage(pairs.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > RARE_ROWS))
    lengths = pairs.join(_small(long), "token").groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("pos", "n"))).alias("n_at"))
    by = f"array_sort(transform(sequence(0, {COORDINATES - 1}), j -> struct(coalesce(try_element_at(n_at, j), 0L) AS n, xxhash64(j, low[j]) AS token, j)))"
    return classes.join(lengths, "node", "left").select(*classes.columns, F.expr(f"transform({by}, x -> cast(x.j as byte))").alias("ord"))


def _posted(classes: DataFrame, prefix: int) -> DataFrame:
    """The classes' first pairs in order, a row ``token, k, chain`` each: ``k`` is the place in ``ord``, ``chain`` the coordinate's bit; other columns stay."""
    first = f"transform(slice(ord, 1, {prefix}), (j, k) -> struct(xxhash64(cast(j as int), low[j]) AS token, k, shiftleft(1L, cast(j as int)) AS chain))"
    return classes.select("*", F.expr(f"inline({first})"))


def _refined(postings: DataFrame, loose: DataFrame, prefix: int, level: int) -> DataFrame:
    """``token, k, chain, node``: lists of the ``loose`` tokens, posted anew by a further pair, whose bit joins the ``chain``.

    The pair that comes after ``level`` others in what two sets share is among the
    first ``prefix + level`` of either's order: nothing is lost, and documents that only
    a common passage brings together fall apart.
    """
    rows = postings.join(_small(loose), "token").select(
        "token", "chain", "node", "low", "ord", F.explode(F.expr(f"filter(sequence(0, {prefix + level - 1}), i -> i > k)")).alias("k"))
    rows = rows.withColumn("j", F.expr("cast(ord[k] as int)"))
    return rows.select(F.expr("xxhash64(token, j, low[j])").alias("token"), "k", F.expr("chain | shiftleft(1L, j)").alias("chain"), "node")


def _small(table: DataFrame) -> DataFrame:
    """Broadcast if it has at most ``SMALL_TABLE`` rows of a few numbers."""
    return F.broadcast(table) if table.count() <= SMALL_TABLE else table


def _hot(postings: DataFrame) -> DataFrame | None:
    """``token, splits`` of the lists of over ``LIST_ROWS`` rows; None if there are none."""
    hot = cut_lineage(postings.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > LIST_ROWS)
                      .select("token", F.expr(f"cast(ceil(n / {LIST_ROWS}) as int)").alias("splits")))
    return hot if hot.head(1) else None


def _salted(postings: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Postings with a ``salt`` that splits the ``hot`` lists."""
    if hot is None:
        return postings.withColumn("salt", F.lit(0)).withColumn("splits", F.lit(1))
    rows = postings.join(_small(hot), "token", "left").withColumn("splits", F.coalesce("splits", F.lit(1)))
    return rows.withColumn("salt", F.expr("cast(pmod(xxhash64(node), splits) as int)"))


_CANDIDATES = "a long, b long, token long, sig binary"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables that never cut a list in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        token, salt = batch.column("token").to_numpy(), batch.column("salt").to_numpy()
        same = (token == token[-1]) & (salt == salt[-1])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if held and (held[-1].column("token")[-1].as_py(), held[-1].column("salt")[-1].as_py()) != (token[0], salt[0]):
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _pairs(matches: int, partners: int | None, heads: bool, percent: int = 0):
    """Task function: candidate pairs of every list.

    Without components (``partners`` None): the nearest neighbour of enough
    collisions on either side. With: up to ``partners`` (0: all) earlier
    members of other components for each member, where this list is that of the first
    pairs, in order, that both have. ``guest`` is 2 for members that visit a split, 1 for
    those that visit others: a visitor meets only members at home, and of two
    that visit each other the greater one is at home. What a set shares is at
    most its size less its own shingles, and two sets differ in at least as
    many shingles as their odd sketches in bits: both bounds refuse pairs whose
    greatest possible similarity is below ``percent``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            token, salt = table.column("token").to_numpy(), table.column("salt").to_numpy()
            new = np.r_[True, (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])]
            start = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            rank = np.arange(len(token)) - start
            size = np.diff(np.r_[np.flatnonzero(new), len(token)])[np.cumsum(new) - 1]
            comp = table.column("comp").to_numpy() if partners is not None else None
            guest = table.column("guest").to_numpy() if partners is not None else None
            size_of, own = (table.column(c).to_numpy() for c in ("size", "own")) if partners is not None else (None, None)
            live = size > 1
            if heads:
                live |= table.column("splits").to_numpy() > 1  # alone in its split, but not in its list
            if partners is not None:
                low, high = np.minimum.reduceat(comp, np.flatnonzero(new)), np.maximum.reduceat(comp, np.flatnonzero(new))
                live &= (low != high)[np.cumsum(new) - 1]  # a list within one component is settled
            at = np.flatnonzero(live)
            if not len(at):
                continue
            node = table.column("node").to_numpy()
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(token), COORDINATES)
            if partners is not None:
                chain = table.column("chain").to_numpy()
                low, order = (table.column(c).combine_chunks().flatten().to_numpy().reshape(len(token), -1) for c in ("low", "ord"))
                sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(token), -1)
            before, after = np.zeros(len(token), np.int64), np.zeros(len(token), np.int64)
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            lag = 0
            while True:
                lag += 1
                at = at[rank[at] >= lag]
                if partners:
                    at = at[before[at] < partners]
                if not len(at):
                    break
                x, y = at, at - lag
                if partners is None:
                    want = (before[x] == 0) | (after[y] == 0)
                else:
                    most = np.minimum(size_of[x] - own[x], size_of[y] - own[y])
                    visit = np.maximum(guest[x], guest[y]) < 2
                    visit |= (guest[x] == 2) & ((guest[y] == 0) | (guest[y] == 1) & (node[y] > node[x]))
                    visit |= (guest[y] == 2) & ((guest[x] == 0) | (guest[x] == 1) & (node[x] > node[y]))
                    both = size_of[x] + size_of[y]
                    apart = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)
                    near = (100 * most >= percent * (both - most)) & (100 * (both - apart) >= percent * (both + apart))
                    want = (comp[x] != comp[y]) & visit & near
                x, y = x[want], y[want]
                if not len(x):
                    if partners is None and not ((before[at] == 0).any() or (after[live] == 0).any()):
                        break
                    continue
                hit = np.concatenate([(sig[x[i:i + 65536]] == sig[y[i:i + 65536]]).sum(1) for i in range(0, len(x), 65536)]) >= matches
                x, y = x[hit], y[hit]
                if partners is not None and len(x):
                    met = _first_shared(low[x] == low[y], order[x], chain[x])
                    x, y = x[met], y[met]
                before[x] += 1
                after[y] += 1
                if len(x):
                    pairs.append((x, y))
            if pairs:
                x, y = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
                edges = np.unique(np.stack([np.maximum(node[x], node[y]), np.minimum(node[x], node[y])], 1), axis=0)
                none = pa.nulls(len(edges))
                yield pa.record_batch([pa.array(edges[:, 0]), pa.array(edges[:, 1]), none.cast(pa.int64()), none.cast(pa.binary())], ["a", "b", "token", "sig"])
            if heads:
                first = np.flatnonzero(live & (before == 0) & (table.column("splits").to_numpy() > 1))
                if len(first):
                    sigs = pa.array([sig[i].tobytes() for i in first], pa.binary())
                    yield pa.record_batch([pa.array(node[first]), pa.nulls(len(first)).cast(pa.int64()), pa.array(token[first]), sigs], ["a", "b", "token", "sig"])

    return run


def _first_shared(same: np.ndarray, order: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Whether ``chain`` has the bits of the first columns, in ``order``, of those in which two rows are the ``same``."""
    order = order.astype(np.int64)
    shared = np.take_along_axis(same, order, 1)
    first = shared & (shared.cumsum(1) <= np.bitwise_count(chain)[:, None])
    return np.where(first, np.int64(1) << order, 0).sum(1) == chain


def _listed(rows: DataFrame) -> DataFrame:
    return rows.repartition("token", "salt").sortWithinPartitions("token", "salt", "node")


def _first_candidates(postings: DataFrame, hot: DataFrame | None, matches: int, visits: int | None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Pairs ``(a, b)`` of nearest members, the ``node`` of heads, and the tokens (if any) of lists to refine, whose heads are left out.

    Heads meet if a list has up to ``LIST_ROWS`` (``visits`` None: always).
    Other lists are refined if they have more than ``visits`` splits; with
    fewer it costs less that their heads visit every split in later rounds.
    """
    found = _listed(_salted(postings, hot).select("token", "salt", "splits", "node", "sig")).mapInArrow(_pairs(matches, None, hot is not None), _CANDIDATES)
    if hot is None:
        return cut_lineage(found.select("a", "b").distinct()), None, None
    found = cut_lineage(found)
    heads = found.where("b IS NULL").select("token", F.lit(0).alias("salt"), F.lit(1).alias("splits"), F.col("a").alias("node"), "sig")
    few, loose = heads, None
    if visits is not None:
        many = cut_lineage(heads.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > LIST_ROWS).join(hot, "token").select("token", "splits"))
        if many.head(1):
            few = heads.join(_small(many.select("token")), "token", "left_anti")
        if many.where(F.col("splits") > visits).head(1):
            loose = cut_lineage(many.where(F.col("splits") > visits).select("token"))
            heads = heads.join(_small(loose), "token", "left_anti")
    across = _listed(few).mapInArrow(_pairs(matches, None, False), _CANDIDATES)
    pairs = cut_lineage(found.where("b IS NOT NULL").select("a", "b").union(across.select("a", "b")).distinct())
    return pairs, heads.select("node"), loose


def _first_round(classes: DataFrame, matches: int) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame | None, DataFrame | None]:
    """First candidates ``(a, b)``, the ``node`` of all that take part in later rounds, hot lists, loose first lists and what these are refined to.

    A head may be like a member of another split that heads none: it takes
    part with or without a candidate. Lists by ``matches`` coordinates hold
    only candidates of each other and need no refining.
    """
    prefix = COORDINATES - matches + 1
    rows, loose = _posted(classes, prefix), None
    tried, heads, hot, refined = [], [], [], []
    for level in range(matches):
        big = _hot(rows)
        pairs, some, more = _first_candidates(rows, big, matches, None if level + 1 == matches else VISITS if level else 0)
        tried.append(pairs)
        if big is not None:
            heads.append(some)
            hot.append(big if more is None else big.join(_small(more), "token", "left_anti"))
        if level == 0:
            loose = more
        else:
            refined.append(again if more is None else again.join(_small(more), "token", "left_anti"))
        if more is None:
            break
        again = cut_lineage(_refined(rows, more, prefix, level + 1))
        rows = again.join(classes.select("node", "sig", "low", "ord"), "node")

    def whole(parts: list[DataFrame]) -> DataFrame | None:
        return parts[0] if len(parts) == 1 else cut_lineage(reduce(DataFrame.union, parts)) if parts else None

    pairs = cut_lineage(reduce(DataFrame.union, tried).distinct().where("a != b"))
    involved = reduce(DataFrame.union, [pairs.select("a"), pairs.select("b"), *heads]).toDF("node").distinct()
    return pairs, involved, whole(hot), loose, whole(refined)


def _unsettled(nodes: DataFrame, loose: DataFrame | None, refined: DataFrame | None, prefix: int) -> DataFrame:
    """``token, k, chain, node, comp`` of the lists that hold several components; nothing wide is in them."""
    rows = _posted(nodes.select("node", "comp", "low", "ord"), prefix).drop("low", "ord")
    if loose is not None:
        rows = rows.join(_small(loose), "token", "left_anti").unionByName(refined.join(nodes.select("node", "comp"), "node"))
    live = rows.groupBy("token").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least != most").select("token")
    return cut_lineage(rows.join(live, "token", "left_semi"))


def _more_candidates(nodes: DataFrame, hot: DataFrame | None, loose: DataFrame | None, refined: DataFrame | None,
                     matches: int, partners: int, percent: int) -> DataFrame:
    """Pairs of different components in the lists; signatures and sketches of the ``nodes`` join the lists at the end."""
    rows = _salted(_unsettled(nodes, loose, refined, COORDINATES - matches + 1), hot).withColumn("guest", F.lit(0))
    if hot is not None:
        groups = rows.where("splits > 1").groupBy("token", "comp").agg(F.count("*").alias("n"))
        largest = cut_lineage(groups.groupBy("token").agg(F.max(F.struct("n", "comp")).alias("top")).select("token", F.col("top.comp").alias("top")))
        rows = rows.join(_small(largest), "token", "left").withColumn("guest", F.expr("cast(coalesce(comp != top, false) as int)")).drop("top")
        guests = (rows.where("guest = 1").withColumn("other", F.explode(F.expr("sequence(0, splits - 1)"))).where("other != salt")
                  .withColumn("salt", F.col("other")).drop("other").withColumn("guest", F.lit(2)))
        rows = rows.unionByName(guests)
    rows = rows.join(nodes.select("node", "low", "ord", "sig", "size", "own", "sketch"), "node")
    return _listed(rows).mapInArrow(_pairs(matches, partners, False, percent), _CANDIDATES).select("a", "b").distinct()


def shingle_sets(docs: DataFrame, nodes: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``node, shingles`` (packed 64-bit hashes): the full sets of the documents named in ``nodes (node, doc_id, digest)``."""
    def run(batch: pa.RecordBatch, memo: WordHashes = WordHashes()) -> pa.RecordBatch:
        rows = []
        for node, digest, text in zip(batch.column("node").to_pylist(), as_bytes(batch.column("digest")), as_bytes(batch.column("text"))):
            s = shingle_set(text, memo, shingle)
            if len(s) and _digest(s) == digest:  # another text of a repeated id is another class
                rows.append((node, digest, s.tobytes()))
        return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["node", "digest", "shingles"])

    rows = map_batches(nodes.join(docs, "doc_id").select("node", "digest", "text"), run, "node long, digest binary, shingles binary")
    return rows.dropDuplicates(["node"]).drop("digest")


def odd_sketch(shingles: np.ndarray) -> bytes:
    """A bit per hash range: the parity of the shingles in it. A shingle in which two sets differ flips one bit."""
    return np.packbits(np.bincount((shingles % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1).tobytes()


def bounds(sets: DataFrame) -> DataFrame:
    """``node, size, own, sketch``: shingles of each set, those that no other set of ``sets`` has, and its odd sketch."""
    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = as_bytes(batch.column("shingles"))
        sizes = [len(b) // 8 for b in packed]
        return pa.record_batch([pa.array(np.frombuffer(b"".join(packed), np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), sizes))], ["shingle", "node"])

    def sketched(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.frombuffer(b, np.uint64) for b in as_bytes(batch.column("shingles"))]
        return pa.record_batch([batch.column("node"), pa.array([len(r) for r in rows], pa.int64()), pa.array([odd_sketch(r) for r in rows], pa.binary())], ["node", "size", "sketch"])

    single = map_batches(sets, split, "shingle long, node long").groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    each = map_batches(sets, sketched, "node long, size long, sketch binary")
    return each.join(single.groupBy("node").agg(F.count("*").alias("own")), "node", "left").select(
        "node", "size", F.coalesce("own", F.lit(0)).alias("own"), "sketch")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs (a, b)`` those with 100 * intersection >= percent * union."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                keep.append(False)
                continue
            both = np.sort(np.concatenate([x, y]), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(both) - shared))
        return batch.select(["a", "b"]).filter(pa.array(keep))

    rows = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    return map_batches(rows, run, "a long, b long").distinct()


def _contract(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)``, each task's replaced by stars around the smallest node that they connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.get(top, top) != top:
                top = parent[top]
            while parent.get(x, x) != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                parent.setdefault(a, a)
                parent.setdefault(b, b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        rows = [(x, root(x)) for x in parent if root(x) != x]
        for i in range(0, len(rows), 1 << 16):
            yield pa.record_batch([pa.array([r[k] for r in rows[i:i + (1 << 16)]], pa.int64()) for k in (0, 1)], ["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, comp``: smallest node reachable, for the nodes of ``edges (a, b)`` that are not the smallest.

    Tasks of at most ``TASK_EDGES`` edges replace theirs by stars; between
    tasks, large-star and small-star steps alternate until only stars are
    left. The joins are salted, so that a node with many neighbours is no hot key.
    """
    def starred(pairs: DataFrame, least: DataFrame) -> DataFrame:
        salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        return pairs.withColumn("salt", F.expr(f"cast(pmod(xxhash64(v), {_SALTS}) as int)")).join(salted, ["u", "salt"]).drop("salt")

    edges = cut_lineage(edges)
    while True:
        edges = cut_lineage(_contract(edges.coalesce(1 + edges.count() // TASK_EDGES)))
        # done when every node has one edge and no smallest node has an edge of its own
        ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("b", F.lit(0), F.lit(1)))
        per_node = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if not per_node.where("out > 1 OR out > 0 AND into > 0").head(1):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = starred(both.where("v > u"), least).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = starred(down, least).select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = cut_lineage(small.where("a != b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Documents are linked where 100 * intersection >= percent * union of their
    shingle sets; a component takes its smallest doc_id, and only that row is
    kept (of several sets under that id, one). Texts that are null or without
    words have an empty set and stand alone. Rows that repeat a doc_id with
    another text are judged by their own text. Rows with a null doc_id are not
    linked: null component, kept. An empty table gives no rows. Columns other
    than the two named are not read.
    """
    return _judged(id_and_text(docs, id_col, text_col), percent, shingle).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """``near_duplicates`` of ``docs (doc_id, text)`` with the ``digest`` of each row's set, and ``text_hash`` if ``docs`` has it."""
    matches = match_threshold(percent)
    signed = cut_lineage(signatures(docs, shingle))
    linkable = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = cut_lineage(linkable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("low").alias("low"), F.first("sig").alias("sig"))
                          .withColumn("node", F.monotonically_increasing_id()))
    classes = cut_lineage(_ordered(classes))
    tried, involved, hot, loose, refined = _first_round(classes.drop("digest", "doc_id"), matches)
    near = cut_lineage(classes.join(involved, "node"))
    sets = cut_lineage(shingle_sets(docs, near.select("node", "doc_id", "digest"), shingle))
    links = cut_lineage(confirm(tried, sets, percent))
    comps = components(links)
    # a set shares at most what is not its own alone, and a union is no smaller than it: others have no link at all
    able = bounds(sets).where(f"100 * (size - own) >= {percent} * size")
    near = cut_lineage(near.drop("digest", "doc_id").join(able, "node"))
    for partners in (PARTNERS, 0):
        nodes = cut_lineage(near.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
        more = cut_lineage(_more_candidates(nodes, hot, loose, refined, matches, partners, percent).join(tried, ["a", "b"], "left_anti"))
        if not more.head(1):
            if partners:
                continue
            break
        found = cut_lineage(confirm(more, sets, percent))
        tried = tried.unionByName(more)
        if found.head(1):
            comps = components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(found))
    # a component's first class: the smallest doc_id, of several sets under it the smallest digest
    ids = classes.select("node", "doc_id", "digest")
    members = comps.unionByName(comps.select(F.col("comp").alias("node"), "comp").distinct()).join(ids, "node")
    firsts = cut_lineage(members.groupBy("comp").agg(F.min(F.struct("doc_id", "digest")).alias("first")))
    named = cut_lineage(members.join(_small(firsts), "comp").select("digest", F.col("first.doc_id").alias("component_id"), F.col("first.digest").alias("first")))
    named = named.unionByName(ids.join(named, "digest", "left_anti").select("digest", F.col("doc_id").alias("component_id"), F.col("digest").alias("first")))
    rows = signed.drop("low", "sig").join(named, "digest", "left")
    linked = F.col("doc_id").isNotNull()
    kept = ~linked | F.col("digest").isNull() | (F.col("doc_id") == F.col("component_id")) & (F.col("digest") == F.col("first"))
    return rows.withColumn("kept", kept).withColumn("component_id", F.when(linked, F.coalesce("component_id", "doc_id"))).drop("first")


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component; of rows that repeat a doc_id with the same set of shingles one stays, those with a null id all stay."""
    def text_hash(text: str) -> Column:
        return F.coalesce(F.unhex(F.md5(F.col(text).cast("string").cast("binary"))), F.lit(b""))

    judged = cut_lineage(_judged(id_and_text(docs, id_col, text_col).withColumn("text_hash", text_hash("text")), percent))
    found = judged.where("kept AND doc_id IS NOT NULL").groupBy("doc_id", "digest").agg(F.min("text_hash").alias("__hash"))
    found = found.select(F.col("doc_id").alias("__kept"), "__hash")
    named = docs.where(F.col(id_col).isNotNull()).join(found, (F.col(id_col).cast("long") == F.col("__kept")) & (text_hash(text_col) == F.col("__hash"))).dropDuplicates(["__kept", "__hash"])
    return named.drop("__kept", "__hash").unionByName(docs.where(F.col(id_col).isNull()))
