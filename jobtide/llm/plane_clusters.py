"""Centroid clustering on bit planes.

A vector of 64 integers is kept as bit planes: plane k is one 64-bit word
with bit i set where bit k of component i (two's complement) is set. The dot product
of two vectors is the sum, over pairs of planes, of the planes' weights
times the popcount of their AND, so distances are exact integers. Planes
above a vector's highest are copies of its last one (the sign), so vectors
of different widths meet without conversion.

Each round reads the stored planes once, sends the few centroids along, and
sums every cluster's components per task before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

COMPONENTS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SALT = "3"
#: Larger components are set to this bound.
MOST = 1 << 62
#: Up to so many planes a squared distance fits in 64 bits.
_NARROW = 28
_LONG_MAX = (1 << 63) - 1
_SUM = "decimal(38,0)"


def to_planes(values: np.ndarray) -> np.ndarray:
    """Planes (rows x planes, uint64) of integer vectors (rows x 64, int64)."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    n_planes = max(low.bit_length() if low >= 0 else (-low - 1).bit_length(), high.bit_length() if high >= 0 else (-high - 1).bit_length()) + 1
    planes = np.empty((len(values), n_planes), np.uint64)
    for k in range(n_planes):
        bits = ((values >> k) & 1).astype(np.uint8)
        planes[:, k] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return planes


def widen(planes: np.ndarray, n_planes: int) -> np.ndarray:
    """The same vectors on more planes: the sign plane repeats."""
    more = n_planes - planes.shape[1]
    return planes if more <= 0 else np.concatenate([planes, np.repeat(planes[:, -1:], more, axis=1)], axis=1)


def weights(n_planes: int) -> list[int]:
    return [1 << k for k in range(n_planes - 1)] + [-(1 << (n_planes - 1))]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of rows of ``a`` with rows of ``b`` (broadcast), by weighted popcounts of ANDed planes."""
    n_a, n_b = a.shape[-1], b.shape[-1]
    kind = np.int64 if n_a <= _NARROW and n_b <= _NARROW else object
    total = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), kind)
    for wa, k in zip(weights(n_a), range(n_a), strict=True):
        for wb, m in zip(weights(n_b), range(n_b), strict=True):
            total += np.bitwise_count(a[..., k] & b[..., m]).astype(kind) * (wa * wb)
    return total


def distances(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (rows x centroids)."""
    own, theirs = dots(planes, planes), dots(centroids, centroids)
    across = np.stack([dots(planes, c[None, :]) for c in centroids], axis=1)
    return own[:, None] - 2 * across + theirs[None, :]


def column_sums(planes: np.ndarray) -> list[int]:
    """Componentwise sums of the vectors, from the planes' set bits."""
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(len(planes), planes.shape[1], 8), axis=2, bitorder="little")
    per_plane = bits.sum(axis=0, dtype=np.int64)
    return [sum(w * int(n) for w, n in zip(weights(planes.shape[1]), column, strict=True)) for column in per_plane.T]


def usable(vec: Column) -> Column:
    """True for vectors of 64 components, none null or non-finite."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vec) == COMPONENTS) & sound, F.lit(False))


def planes_of(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, planes`` of the usable vectors; a component x becomes floor(1024 * x)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
                with np.errstate(over="ignore"):
                    scaled = np.floor(v * SCALE)
                whole = np.where(np.abs(scaled) < MOST, scaled, 0).astype(np.int64)
                whole = np.where(scaled >= MOST, MOST, np.where(scaled <= -MOST, -MOST, whole))
                planes = to_planes(whole).view(np.int64)
                out = pa.FixedSizeListArray.from_arrays(pa.array(planes.ravel()), planes.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["vec_id", "planes"])

    return rows.mapInArrow(run, "vec_id long, planes array<long>")


def _batch_planes(column: pa.ListArray) -> np.ndarray:
    """Rows of one batch, on as many planes as its widest vector needs."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    most = int(sizes.max())
    if (sizes == most).all():
        return flat.reshape(-1, most)
    starts = np.cumsum(sizes) - sizes
    at = starts[:, None] + np.minimum(np.arange(most)[None, :], sizes[:, None] - 1)
    return flat[at]


def _nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centroid (the first of equal ones) and the squared distance."""
    far = distances(planes, centroids)
    best = np.argmin(far, axis=1)
    return best, far[np.arange(len(far)), best]


def _pack(centroids: list[list[int]]) -> np.ndarray:
    return to_planes(np.array(centroids, dtype=np.int64))


def cluster_sums(packed: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, int, list[int]]]:
    """Cluster -> (vectors, sum of squared distances, componentwise sums), of the vectors assigned to their nearest centroid.

    Every task sums its own vectors, so a handful of rows a task is shuffled and one row a cluster comes back.
    """
    theirs = _pack(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            if batch.num_rows:
                planes = _batch_planes(batch.column(0))
                best, far = _nearest(planes, theirs)
                for c in np.unique(best).tolist():
                    mine = best == c
                    row = found.setdefault(c, [0, 0, [0] * COMPONENTS])
                    row[0] += int(mine.sum())
                    row[1] += sum(far[mine].tolist())
                    row[2] = [x + y for x, y in zip(row[2], column_sums(planes[mine]), strict=True)]
        if found:
            import decimal

            exact = decimal.Context(prec=38).create_decimal
            sums = [[exact(min(n, 10**38 - 1)) for n in (row[0], row[1], *row[2])] for row in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(sums, pa.list_(pa.decimal128(38, 0)))], names=["cluster", "sums"])

    parts = packed.select("planes").mapInArrow(run, f"cluster int, sums array<{_SUM}>")
    added = parts.groupBy("cluster").agg(*[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(COMPONENTS + 2)])
    return {r[0]: (int(r[1]), int(r[2]), [int(x) for x in r[3:]]) for r in added.collect()}


def first_centroids(packed: DataFrame, clusters: int = CLUSTERS, salt: str = SALT) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``salt:vec_id``, in that order; equal ids by their planes, null ids last."""
    order = packed.withColumn("h", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256))
    rows = order.orderBy(F.col("h").asc_nulls_last(), "planes").limit(clusters).select("planes").collect()
    return [column_sums(np.array([r[0]], np.int64).view(np.uint64)) for r in rows]


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Vectors that are null, of another length, or with null or non-finite
    components are left out; fewer vectors than clusters give fewer
    centroids; an empty table gives no rows. Repeated rows count as often
    as they occur and may start several centroids, of which the first wins ties. Null ids are clustered and start
    a centroid only after all others. Components are exact up to 2^62 in magnitude and set to that
    bound beyond; distances and inertias that exceed a long are given as its maximum. Extra columns are not read.
    """
    packed = stored(planes_of(vectors, id_col, vec_col))
    centroids = first_centroids(packed, clusters, salt)
    if not centroids:
        return packed.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(rounds):
        for c, (n, _, sums) in cluster_sums(packed, centroids).items():
            centroids[c] = [s // n for s in sums]
    inertia = {c: far for c, (_, far, _) in cluster_sums(packed, centroids).items()}
    theirs = _pack(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best, far = _nearest(_batch_planes(batch.column(1)), theirs)
                far = np.minimum(far, _LONG_MAX).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])

    assigned = packed.select("vec_id", "planes").mapInArrow(run, "vec_id long, cluster int, distance long")

    def of(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)

    total = min(sum(inertia.values()), _LONG_MAX)
    return assigned.select(
        "vec_id", "cluster", "distance", of([min(inertia.get(c, 0), _LONG_MAX) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"), of([centroid_digest(c) for c in centroids]).alias("centroid_sha256"))
