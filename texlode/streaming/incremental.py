"""Streams over growing corpora: incremental dictionaries and running counts.

The data carries no event time, so there is no watermark: the state of a
dictionary stream is the dictionary table itself, and counts keep one row per
batch and package or environment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from texlode.functions import equations, formats
from texlode.operators import dictionary as D
from texlode.operators.extract import classified_equations, inline_equations
from texlode.plans.physical import explode_rows, materialize, path_exists, release

DOCUMENT_SCHEMA = "dir string, file string, doc_name string, text string"
# Parts of a dictionary table by the hash of the key; a batch reads those its own keys fall in.
BUCKETS = 64
DICTIONARY_SCHEMA = "eqid string, eq_key string, eq_text string, eq_number bigint, bucket int, batch bigint"
INLINE_SCHEMA = "eqid string, eq_text string, eq_number bigint, bucket int, batch bigint"
MULTILINE_SCHEMA = "eqid string, sub_ids array<string>, eq_text string, eq_number bigint, bucket int, batch bigint"


def stream_documents(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Documents of Parquet files that are dropped into a folder."""
    return (
        spark.readStream.schema(DOCUMENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


# What fills the cores of a cluster well; a larger batch would not spread any better.
FILES_PER_CORE = 16


def batch_files(spark: SparkSession, path: str, least: int = 4, batches: int = 4) -> int:
    """Files per batch, so that what a batch costs besides its rows is paid few times.

    Some ``batches`` make up a folder, of ``least`` files each at least, until
    one holds ``FILES_PER_CORE`` for each core of the cluster.
    """
    files = len(spark.read.schema(DOCUMENT_SCHEMA).parquet(path).inputFiles())
    return max(least, min(-(-files // batches), FILES_PER_CORE * spark.sparkContext.defaultParallelism))


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def read_dictionary(
    spark: SparkSession, path: str, before: int | None = None, schema: str = DICTIONARY_SCHEMA
) -> DataFrame:
    """Dictionary table; ``before`` leaves out batches from that one on."""
    if not path_exists(spark, path):
        table = spark.createDataFrame([], schema)
    else:
        table = spark.read.schema(schema).parquet(path)
    table = table if before is None else table.filter(F.col("batch") < before)
    return table


def touched_buckets(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The part of a dictionary table that can hold any of the keys; other folders are not read.

    No more numbers than there are buckets come to the driver.
    """
    buckets = [row[0] for row in keys.select(_bucket(key)).distinct().collect()]
    return table.filter(F.col("bucket").isin(buckets)) if buckets else table.limit(0)


def _next_number(table: DataFrame) -> int:
    return table.agg(F.coalesce(F.max("eq_number") + 1, F.lit(0))).scalar()


def _write_batch(rows: DataFrame, key: str, batch: int, path: str) -> None:
    """Rows of a batch stand in folders of its number, which a repeated batch overwrites with the same rows."""
    placed = rows.withColumn("bucket", _bucket(key)).withColumn("batch", F.lit(batch).cast("bigint"))
    # A number of its own keeps the tasks apart, each of which writes a file per bucket.
    tasks = min(BUCKETS, rows.sparkSession.sparkContext.defaultParallelism)
    (
        placed.repartition(tasks, "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "batch")
        .parquet(path)
    )


def append_batch(docs: DataFrame, batch: int, path: str) -> None:
    """Numbers the new equations of one batch and adds them to the table.

    A replay finds the table as it was before the batch, so it changes nothing.
    """
    classified = materialize(classified_equations(docs))
    _append_single(classified, batch, path)
    release(classified)


def _append_single(classified: DataFrame, batch: int, path: str) -> None:
    distinct = materialize(D.distinct_pieces(D.keyed_pieces(classified)))
    prior = read_dictionary(classified.sparkSession, path, before=batch)
    known = touched_buckets(prior, distinct, "eq_key")
    _write_batch(D.added_equations(distinct, known, _next_number(prior)), "eq_key", batch, path)
    release(distinct)


def append_inline_batch(docs: DataFrame, batch: int, path: str) -> None:
    """The same for inline equations."""
    inline = materialize(inline_equations(docs).select("file", "eq_no", "text"))
    prior = read_dictionary(docs.sparkSession, path, batch, INLINE_SCHEMA)
    known = touched_buckets(prior, inline, "text")
    _write_batch(D.new_inline(inline, known, _next_number(prior)), "eq_text", batch, path)
    release(inline)


def append_multiline_batch(docs: DataFrame, batch: int, path: str, single: str) -> None:
    """The same for multi-line equations, whose lines first go to the table ``single``."""
    spark = docs.sparkSession
    classified = materialize(classified_equations(docs))
    _append_single(classified, batch, single)
    multiline = materialize(D.distinct_multiline(classified))
    prior = read_dictionary(spark, path, batch, MULTILINE_SCHEMA)
    known = touched_buckets(prior, multiline, "eq_text")
    lines = explode_rows(
        multiline.select(equations.sub_equations("flat_eq").alias("lines")), "lines", "sub_no", "eq_key", []
    )
    eqs = touched_buckets(read_dictionary(spark, single, before=batch + 1), lines, "eq_key")
    rows = D.added_multiline(multiline, eqs.select("eq_key", "eqid"), known, _next_number(prior))
    _write_batch(rows, "eq_text", batch, path)
    release(classified, multiline)


def compact_dictionary(spark: SparkSession, path: str, target: str, schema: str = DICTIONARY_SCHEMA) -> None:
    """Copies a dictionary table with the rows of all batches in one folder per bucket.

    A stream goes on with the copy: its rows count as earlier than any batch.
    """
    rows = read_dictionary(spark, path, schema=schema).withColumn("batch", F.lit(-1).cast("bigint"))
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket", "batch").parquet(target)


def _each_batch(docs: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dictionary(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the dictionary table up to date with a stream of documents."""
    return _each_batch(docs, lambda rows, batch: append_batch(rows, batch, path), checkpoint)


def stream_inline_dictionary(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return _each_batch(docs, lambda rows, batch: append_inline_batch(rows, batch, path), checkpoint)


def stream_multiline_dictionary(docs: DataFrame, path: str, single: str, checkpoint: str) -> StreamingQuery:
    """Keeps both tables, of multi-line and of single equations, up to date."""
    return _each_batch(docs, lambda rows, batch: append_multiline_batch(rows, batch, path, single), checkpoint)


def running_packages(docs: DataFrame) -> DataFrame:
    names = docs.select(F.explode(formats.package_names("text")).alias("package"))
    return names.groupBy("package").agg(F.count(F.lit(1)).alias("n"))


def running_environments(docs: DataFrame) -> DataFrame:
    return classified_equations(docs).groupBy("env").agg(F.count(F.lit(1)).alias("n"))


def stream_counts(
    docs: DataFrame, counts: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Writes the counts of each batch on their own; a repeated batch overwrites its own.

    What a batch writes follows from its documents, not from all that came before.
    """

    def write(rows: DataFrame, batch: int) -> None:
        counts(rows).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")

    return _each_batch(docs, write, checkpoint)


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts over all batches so far."""
    rows = spark.read.parquet(path)
    keys = [name for name in rows.columns if name not in ("n", "batch")]
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"))
