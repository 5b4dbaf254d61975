"""Centroid clustering of vectors by exact nearest-centroid search.

Equal-average equal-variance search: with ``d`` dimensions, the sums ``sx``, ``sc``
and ``v = sqrt(d * sum((x - mean)^2))`` of a vector and a centroid,

    d * distance >= (sx - sc)^2 + (vx - vc)^2.

Centroids are sorted by their sum.  Each vector starts between the two nearest
sums and scans outward; the first sum too far away ends the scan, since all later
ones are farther, and a deviation too far away passes a centroid over.  What is
left gets its exact integer distance.  The bounds give way by far more than float
arithmetic can err, so no centroid that could be nearest is passed over.

Vectors stay where they are: a task passes on one row per centroid and dimension,
and only those sums meet on the driver.

Defined results: rows whose vector is null, is of another length, or holds a null,
an entry that is not finite or one too large for a distance to be a long, are
left out.  Null ids hash like an empty text; of equal hashes (repeated ids) the
smaller vector starts first.  Repeated rows count each.  With fewer vectors than
centroids there are fewer centroids.  Other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.llm.batches import ENTRY, entry_batch, integer_vectors
from texlode.plans.physical import materialize

# Part by which the bounds give way.
_GIVE = 1e-9
_LONG = (1 << 63) - 1


def _integers(scale: int, d: int):
    # Differences of two entries, squared and summed, fit in a long.
    largest = isqrt((1 << 62) // d) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, entries = integer_vectors(batch.column("embedding"), scale, largest)
            right = lengths == d
            x = entries[np.repeat(right, lengths)]
            edges = pa.array(np.arange(len(x) // d + 1) * d, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows[right])), pa.ListArray.from_arrays(edges, pa.array(x))],
                names=["vec_id", "x"],
            )

    return run


def _spread(x: np.ndarray) -> np.ndarray:
    centred = x - x.mean(axis=1, keepdims=True)
    return np.sqrt(x.shape[1] * (centred * centred).sum(axis=1))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector (of equals the smallest), and the squared distance."""
    n, d = x.shape
    sums = centroids.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, spreads, sorted_centroids = sums[order], _spread(centroids)[order], centroids[order]
    own_sums, own_spreads = x.sum(axis=1), _spread(x)
    best = np.full(n, np.iinfo(np.int64).max)
    label = np.full(n, len(centroids))
    high = np.searchsorted(sums, own_sums)
    low = high - 1
    active = np.arange(n)
    far = np.inf
    while len(active):
        a, b = low[active], high[active]
        left = np.where(a >= 0, own_sums[active] - sums[np.maximum(a, 0)], far)
        right = np.where(b < len(sums), sums[np.minimum(b, len(sums) - 1)] - own_sums[active], far)
        down = left <= right
        gap = np.minimum(left, right)
        # The nearer of both sums is too far: so are all that are left.
        limit = d * best[active].astype(np.float64) + 0.5
        going = np.isfinite(gap) & (gap * gap * (1 - _GIVE) <= limit)
        active, down, gap, limit = active[going], down[going], gap[going], limit[going]
        at = np.where(down, low[active], high[active])
        low[active[down]] -= 1
        high[active[~down]] += 1
        apart = np.abs(own_spreads[active] - spreads[at]) - _GIVE * (own_spreads[active] + spreads[at])
        near = (gap * gap + np.maximum(apart, 0) ** 2) * (1 - _GIVE) <= limit
        rows, at = active[near], at[near]
        difference = x[rows] - sorted_centroids[at]
        distance = (difference * difference).sum(axis=1)
        number = order[at]
        better = (distance < best[rows]) | ((distance == best[rows]) & (number < label[rows]))
        best[rows[better]], label[rows[better]] = distance[better], number[better]
    return label, best


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return np.asarray(batch.column("x").flatten(), dtype=np.int64).reshape(-1, d)


def _sums(centroids: np.ndarray):
    """Number (``j`` = -1) and sums of the vectors nearest to each centroid."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, d + 1), dtype=object)
        for batch in batches:
            x = _matrix(batch, d)
            label, _ = nearest(x, centroids)
            order = np.argsort(label, kind="stable")
            heads = np.flatnonzero(np.diff(label[order], prepend=-1))
            if len(heads):
                own = label[order[heads]]
                total[own, 0] += np.diff(np.append(heads, len(x))).astype(object)
                total[own, 1:] += np.add.reduceat(x[order], heads, axis=0).astype(object)
        used = np.flatnonzero(total[:, 0])
        i = np.repeat(used, d + 1)
        j = np.tile(np.arange(-1, d), len(used))
        yield entry_batch(i, j, total[used].ravel())

    return run


def _assign(centroids: np.ndarray):
    d = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, distance = nearest(_matrix(batch, d), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(label.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1
) -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance)`` of each vector, stored, and the centroids.

    Entries count as ``floor(scale * entry)``.  The first centroids are the ``k``
    vectors with the smallest SHA-256 of ``seed:vec_id``; each round replaces
    them by the floor of the mean of the vectors nearest to them.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    stored = materialize(rows.mapInArrow(_integers(scale, dims), "vec_id bigint, x array<bigint>"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = stored.select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k).collect()
    centroids = [list(r["x"]) for r in first]
    if not centroids:
        return rows.limit(0).selectExpr("vec_id", "0 AS cluster", "0L AS distance"), []
    for _ in range(rounds):
        found = stored.mapInArrow(_sums(np.asarray(centroids)), ENTRY).groupBy("i", "j").agg(F.sum("s").alias("s"))
        sums = {(r["i"], r["j"]): int(r["s"]) for r in found.collect()}
        centroids = [
            [sums[i, j] // sums[i, -1] for j in range(dims)] if (i, -1) in sums else old
            for i, old in enumerate(centroids)
        ]
    out = stored.mapInArrow(_assign(np.asarray(centroids)), "vec_id bigint, cluster int, distance bigint")
    return materialize(out), centroids


def clustered_rows(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1
) -> DataFrame:
    """Each vector with its cluster, the inertia of that cluster and of all, and the centroid's digest.

    An inertia is null where it is larger than a long.
    """
    assigned, centroids = cluster(vectors, k, rounds, dims, scale, seed)
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    long = lambda x: x if x <= _LONG else None
    total = long(sum(int(r["s"]) for r in sums))
    facts = [
        (
            r["cluster"],
            long(int(r["s"])),
            hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest(),
        )
        for r in sums
    ]
    table = assigned.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("bigint").alias("inertia"), "centroid_sha256"
    )
