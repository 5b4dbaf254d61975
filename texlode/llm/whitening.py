"""Whitening of embeddings on the leading components of their covariance.

Entries become integers, so that counts, sums and products are exact however the
rows are dealt out: one pass sums them, one sums the products of entries centred
at the rounded mean, from which the covariance follows as a quotient of integers,
and one projects.  A task passes on one row per entry of its sums; only sums of
the vectors' dimensions meet on the driver, where ``spectrum`` slices them.

Defined results: rows whose vector is null, or holds a null, an entry that is not
finite or one beyond ``LARGEST`` after scaling, are dropped; so are vectors of
another length than the most frequent one (of equals, the longest).  Rows with
null or repeated ids stay and count like any other.  A component without variance
(few rows, equal rows, dimensions that depend on others) has ``explained`` 0 and
null in ``whitened``.  Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.llm.batches import ENTRY, entry_batch, integer_vectors
from texlode.llm.spectrum import leading
from texlode.plans.physical import materialize

# Largest scaled entry that is a number; embeddings are far below.
LARGEST = 1 << 40
_EXACT = 1 << 53
_LONG = (1 << 63) - 1
# A component explains nothing when its eigenvalue is below this part of the trace.
NO_VARIANCE = 1e-13

Rows = Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]


def _vectors(batches: Iterator[pa.RecordBatch], scale: int, offset: int, d: int) -> Rows:
    """Batches with the rows that are kept and their integers."""
    for batch in batches:
        rows, lengths, entries = integer_vectors(batch.column("embedding"), scale, LARGEST)
        right = lengths == d
        yield batch, rows[right], entries[np.repeat(right, lengths)].reshape(right.sum(), d) + offset


def _sums(scale: int, offset: int):
    """Numbers (``j`` = -1) and sums of entries of the vectors of each length ``i``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            _, lengths, entries = integer_vectors(batch.column("embedding"), scale, LARGEST)
            for d in np.unique(lengths).tolist():
                own = lengths == d
                x = entries[np.repeat(own, lengths)].reshape(own.sum(), d) + offset
                sums = np.concatenate(([own.sum()], x.sum(axis=0))).astype(object)
                total[d] = total[d] + sums if d in total else sums
        for d, sums in total.items():
            yield entry_batch(np.full(d + 1, d), np.arange(-1, d), sums)

    return run


def _products(y: np.ndarray) -> np.ndarray:
    """Exact sums of the products of entries; float arithmetic only as far as it is exact."""
    d = y.shape[1]
    most = int(np.abs(y).max(initial=0)) ** 2
    total = np.zeros((d, d), dtype=object)
    step = _EXACT // max(most, 1)
    if not step:
        return total + y.astype(object).T @ y.astype(object)
    for i in range(0, len(y), step):
        part = y[i : i + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _scatter(scale: int, offset: int, centre: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre)
        total = np.zeros((d, d), dtype=object)
        for _, _, x in _vectors(batches, scale, offset, d):
            total = total + _products(x - np.asarray(centre, dtype=np.int64))
        i, j = np.triu_indices(d)
        yield entry_batch(i, j, total[i, j])

    return run


def totals(df: DataFrame, run: Callable) -> dict[tuple[int, int], int]:
    """Exact sums over all tasks; as many rows as the sums have entries."""
    rows = df.mapInArrow(run, ENTRY).groupBy("i", "j").agg(F.sum("s").alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in rows.collect()}


def _project(scale: int, offset: int, n: int, sums: list[int], directions: np.ndarray):
    """Exact deviations, and coordinates on the columns of ``directions``; NaN columns give null."""
    d = len(sums)
    centre = np.asarray([s // n for s in sums], dtype=np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, x in _vectors(batches, scale, offset, d):
            y = x - centre
            # n * x - S, without the large common part.
            bound = n * int(np.abs(y).max(initial=0)) + n
            z = y * n - np.asarray(rest) if bound <= _LONG else y.astype(object) * n - np.asarray(rest, object)
            exact = z if d * bound * bound <= _LONG else z.astype(object)
            deviation = (exact * exact).sum(axis=1)
            centred = y - np.asarray([float(Fraction(r, n)) for r in rest])
            out = centred @ np.nan_to_num(directions)
            missing = np.broadcast_to(np.isnan(directions).any(axis=0), out.shape)
            values = pa.array(out.ravel(), mask=missing.ravel())
            edges = pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array(deviation.tolist(), pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(edges, values),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    return run


def _identity_error(rows: DataFrame, n: int, used: int) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, as it came out."""
    if not used:
        return 0.0

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        column = batch.column("whitened")
        flat = np.asarray(column.flatten().fill_null(0.0), dtype=np.float64)
        return flat.reshape(len(column), -1)[:, :used]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(used)
        for batch in batches:
            total += matrix(batch).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(used)), pa.array(total)], names=["i", "s"])

    found = rows.select("whitened").mapInArrow(sums, "i bigint, s double").groupBy("i").agg(F.sum("s").alias("s"))
    mean = np.zeros(used)
    for r in found.collect():
        mean[r["i"]] = r["s"] / n

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((used, used))
        for batch in batches:
            centred = matrix(batch) - mean
            total += centred.T @ centred
        i, j = np.triu_indices(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "s"]
        )

    found = rows.select("whitened").mapInArrow(products, "i int, j int, s double")
    entries = found.groupBy("i", "j").agg((F.sum("s") / n).alias("v"))
    return entries.agg(F.max(F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]


def whiten(
    vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000
) -> tuple[DataFrame, dict]:
    """Rows ``(vec_id, deviation, whitened)``, stored, and the fit.

    ``deviation`` is the sum over dimensions of ``(n * x - S)^2`` for integers
    ``x = floor(scale * entry) + offset``; ``whitened`` has one coordinate for
    each of at most ``components`` components.  The fit holds ``n``, ``values``,
    ``directions`` (columns), ``explained`` and ``identity_error``.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    sums = materialize(rows.mapInArrow(_sums(scale, offset), ENTRY).groupBy("i", "j").agg(F.sum("s").alias("s")))
    top = sums.filter("j = -1 AND i > 0").orderBy(F.desc("s"), F.desc("i")).first()
    if top is None:
        empty = rows.limit(0).selectExpr("vec_id", "cast(null as decimal(38,0)) deviation", "cast(null as array<double>) whitened")
        return empty, {"n": 0, "values": [], "explained": [], "identity_error": 0.0}
    d, n = top["i"], int(top["s"])
    total = {r["j"]: int(r["s"]) for r in sums.filter(F.col("i") == d).collect()}
    total = [total[j] for j in range(d)]
    centre = [s // n for s in total]
    rest = [s - n * c for s, c in zip(total, centre, strict=True)]
    products = totals(rows, _scatter(scale, offset, centre))
    covariance = np.empty((d, d))
    for (i, j), s in products.items():
        # Quotients of whole numbers: rounded once.
        covariance[i, j] = covariance[j, i] = (n * s - rest[i] * rest[j]) / (n * n)
    trace = sum(Fraction(n * products[i, i] - rest[i] * rest[i], n * n) for i in range(d))
    values, directions = leading(covariance, components)
    real = values > NO_VARIANCE * float(trace)
    scaled = np.where(real, directions / np.sqrt(np.where(real, values, 1.0)), np.nan)
    out = materialize(
        rows.mapInArrow(
            _project(scale, offset, n, total, scaled), "vec_id bigint, deviation decimal(38,0), whitened array<double>"
        )
    )
    fit = {
        "n": n,
        "values": values,
        "directions": directions,
        "explained": [v / float(trace) if r else 0.0 for v, r in zip(values.tolist(), real, strict=True)],
        "identity_error": _identity_error(out, n, int(real.sum())),
    }
    return out, fit


def whitened_rows(vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """One row per vector and component.

    ``deviation`` is null where it is larger than a long.
    """
    rows, fit = whiten(vectors, components, scale, offset)
    explained = F.array(*[F.lit(float(x)) for x in fit["explained"]]) if fit["n"] else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fit["n"]).cast("bigint").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(float(fit["identity_error"])).alias("identity_error"),
    )
