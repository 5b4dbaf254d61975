"""Exact dedup by sorting contents; DataFrame functions only.

Splitters that Spark samples range-partition the contents, an external sort puts
equal ones side by side, and full comparison with the row before finds where a
new content starts.  The sort key opens with the content's first characters and
its digest, so that splitters stay short however long the texts are.

A content with at least one row in ``MAX_HOT`` is dealt over several ranges by a
salt; by counting, there are never more than ``MAX_HOT`` such contents, so their
digests, sizes and kept ids, which a count by digest gives, can be broadcast.

Defined results: a null text equals an empty one; of repeated rows with the id
that stays, one is kept; a null id stays only where a group has no other; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A content is hot when it has at least one row in this many.
MAX_HOT = 1000
# Rows of a hot content that share a range.
RANGE_ROWS = 512
# Characters that open the sort key.
PREFIX_CHARS = 32


def _ranged(docs: DataFrame, content: Column, keep_smallest: bool, carry: list[str]) -> DataFrame:
    """Rows in sorted ranges: ``run`` numbers the contents of a key, ``edge`` marks the row that stays."""
    pick = F.min if keep_smallest else F.max
    carried = F.struct(*[docs[name] for name in carry]).alias("row") if carry else F.lit(None).alias("row")
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), content.alias("content"), carried)
    rows = rows.withColumn("digest", F.sha2(F.col("content"), 256))
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("hot_size"), pick("doc_id").alias("hot_id"))
    n = docs.count()
    hot = counts.filter((F.col("hot_size") * MAX_HOT >= n) & (F.col("hot_size") > RANGE_ROWS))
    hot = hot.withColumn("ranges", F.ceil(F.col("hot_size") / RANGE_ROWS))
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("ranges")), F.lit(-1).cast("bigint"))
    salted = rows.join(F.broadcast(hot), "digest", "left").withColumn("salt", salt).drop("ranges")
    key = ["prefix", "digest", "salt"]
    ranged = salted.withColumn("prefix", F.substring("content", 1, PREFIX_CHARS)).repartitionByRange(*key)
    # Ids that stay come first, nulls last.
    newest = F.col("doc_id").asc_nulls_last() if keep_smallest else F.col("doc_id").desc_nulls_last()
    order = Window.partitionBy(*key).orderBy("content", newest)
    before = F.lag("content").over(order)
    starts = before.isNull() | (before != F.col("content"))
    runs = ranged.withColumn("starts", starts)
    runs = runs.withColumn("run", F.sum(F.col("starts").cast("bigint")).over(order))
    stays = F.col("starts") & ((F.col("salt") < 0) | F.col("doc_id").eqNullSafe(F.col("hot_id")))
    return runs.withColumn("edge", stays)


def exact_groups(docs: DataFrame, normalise: Column | None = None, keep_smallest: bool = True) -> DataFrame:
    """One row per document: ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``normalise`` is the compared content, a string; the text itself if not given.
    """
    content = F.coalesce(docs["text"] if normalise is None else normalise, F.lit(""))
    runs = _ranged(docs, content, keep_smallest, []).drop("content", "row", "starts")
    whole = Window.partitionBy("prefix", "digest", "salt", "run")
    pick = F.min if keep_smallest else F.max
    hot = F.col("salt") >= 0
    keep_id = F.when(hot, F.col("hot_id")).otherwise(pick("doc_id").over(whole))
    return runs.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.when(hot, F.col("hot_size")).otherwise(F.count(F.lit(1)).over(whole)).alias("group_size"),
        F.col("edge").alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, normalise: Column | None = None, keep_smallest: bool = True) -> DataFrame:
    """The rows that stay, with all their columns."""
    content = F.coalesce(docs["text"] if normalise is None else normalise, F.lit(""))
    return _ranged(docs, content, keep_smallest, docs.columns).filter("edge").select("row.*")
