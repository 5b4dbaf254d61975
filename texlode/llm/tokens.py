"""Documents to tokens: round trip, lengths and the exact length histogram.

Defined results: a null text is empty and has no tokens; repeated rows and ties
are rows of their own; columns other than ``doc_id`` and ``text`` are not read;
an empty table gives no rows.  The file of the vocabulary must be there on every
executor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from texlode.llm.byte_bpe import codec, text_passes
from texlode.plans.physical import materialize

# Lengths whose suffix sums one task makes.
LENGTHS_PER_TASK = 1024


def column_texts(column: pa.Array) -> list[str]:
    return [text or "" for text in column.to_pylist()]


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: str):
    """For each pass: the batch, its first row, the token ids and their bounds by row."""
    coder = codec(vocabulary)
    for batch in batches:
        texts = column_texts(batch.column("text"))
        for i, j in text_passes(texts):
            ids, counts = coder.encode(texts[i:j])
            yield batch.slice(i, j - i), texts[i:j], ids, np.append(0, np.cumsum(counts))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token ids of each document (little-endian, 32 bits) and the bytes decoded from them."""

    def run(batches):
        coder = codec(vocabulary)
        for batch, _, ids, bounds in encoded(batches, vocabulary):
            packed = ids.astype("<u4").tobytes()
            offsets = coder.offsets(ids)
            data = coder.decode(ids, offsets)
            at = offsets[bounds].tolist()
            edges = bounds.tolist()
            rows = list(zip(edges, edges[1:], at, at[1:], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.array([packed[4 * i : 4 * j] for i, j, _, _ in rows], pa.binary()),
                    pa.array([data[i:j] for _, _, i, j in rows], pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary"
    )


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``round_trip`` with digests in place of ids and bytes."""

    def run(batches):
        coder = codec(vocabulary)
        for batch, _, ids, bounds in encoded(batches, vocabulary):
            packed = memoryview(ids.astype("<u4").tobytes())
            offsets = coder.offsets(ids)
            data = memoryview(coder.decode(ids, offsets))
            at = offsets[bounds].tolist()
            edges = bounds.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.array([hashlib.sha256(packed[4 * i : 4 * j]).hexdigest() for i, j in zip(edges, edges[1:], strict=False)], pa.string()),
                    pa.array([hashlib.sha256(data[i:j]).hexdigest() for i, j in zip(at, at[1:], strict=False)], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_tokens)``."""

    def run(batches):
        for batch, _, _, bounds in encoded(batches, vocabulary):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds))], names=["doc_id", "n_tokens"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint")


def length_histogram(counts: DataFrame, limits: list[int] = ()) -> DataFrame:
    """One row per encoded length that occurs, with sums over this length and longer ones.

    ``n_docs`` documents have the length, ``docs_from`` it or more; ``tokens_from``
    are theirs.  ``tokens_cut`` is what is left of the whole corpus when each
    document is cut to this length, ``rank_to`` the number of documents up to it.
    Context limits among the lengths get a row even where no document has them,
    unless there are no documents at all.

    A histogram has one row per length, so it is small; its sums are still made in
    ranges of lengths, with one row per range in the sum over ranges.
    """
    exact = counts.groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
    if limits:
        listed = counts.sparkSession.createDataFrame([(n,) for n in limits], "length bigint")
        listed = listed.select("length", F.lit(0).cast("bigint").alias("n_docs"))
        exact = exact.unionByName(listed).groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    # Written once: what follows reads it twice, and the texts are not encoded again.
    exact = materialize(exact)
    exact = exact.withColumn("part", F.floor(F.col("length") / LENGTHS_PER_TASK))
    tokens = F.col("length") * F.col("n_docs")
    parts = exact.groupBy("part").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    every = Window.partitionBy(F.lit(1))
    longer = every.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    above = parts.select(
        "part",
        F.coalesce(F.sum("docs").over(longer), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("tokens").over(longer), F.lit(0)).alias("tokens_above"),
        F.sum("docs").over(every).alias("all_docs"),
        F.sum("tokens").over(every).alias("all_tokens"),
    )
    inside = Window.partitionBy("part").orderBy(F.desc("length"))
    return (
        exact.join(above, "part")
        .withColumn("docs_from", F.col("docs_above") + F.sum("n_docs").over(inside))
        .withColumn("tokens_from", F.col("tokens_above") + F.sum(tokens).over(inside))
        .filter("all_docs > 0")
        .select(
            "length",
            "n_docs",
            "docs_from",
            "tokens_from",
            (F.col("all_tokens") - F.col("tokens_from") + F.col("docs_from") * F.col("length")).alias("tokens_cut"),
            (F.col("all_docs") - F.col("docs_from") + F.col("n_docs")).alias("rank_to"),
        )
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """Smallest length up to which at least each share of all documents goes, in one row."""
    total = histogram.agg(F.max("rank_to").alias("all"))
    ranked = histogram.select("length", "rank_to").join(F.broadcast(total), F.col("rank_to") <= F.col("all"))
    return ranked.agg(
        *[F.min(F.when(F.col("rank_to") >= F.lit(q) * F.col("all"), F.col("length"))).alias(f"q{q:g}") for q in shares]
    )
