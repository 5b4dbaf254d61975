"""Connected components of links between ids, by large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.plans.physical import durable

LINK = "a bigint, b bigint"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the links of a batch by a star per component: never more links than ids."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int, parent=parent) -> int:
            top = x
            while parent[top] != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        ids = np.asarray(list(parent), dtype=np.int64)
        roots = np.asarray([root(x) for x in parent], dtype=np.int64)
        inner = ids != roots
        yield pa.RecordBatch.from_arrays([pa.array(ids[inner]), pa.array(roots[inner])], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every linked id but the smallest of each component.

    The component is the smallest id reachable.  Each round joins every id with
    the smallest among its neighbours; links that no longer change are the result.
    """
    edges = links.select("a", "b").filter("a <> b").mapInArrow(_forest, LINK)
    edges = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        mark = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if mark == before or not mark["n"]:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        edges = durable(small.filter("a <> b").distinct())
