"""Physical-plan helpers: explode without recomputation, durable cuts, dense ids, filters by key, hot keys."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import weakref

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ``monotonically_increasing_id`` keeps the partition in the bits above this
# one and the row's place in the partition below it.
_ROW_BITS = 33

# A key is hot when it holds at least one row in this many; by counting, there
# are never more hot keys than this.
MAX_HOT_KEYS = 1000

# Opens a join key that stands for "no key"; a Unicode noncharacter.
NO_KEY = "\ufdd3"


def explode_rows(
    df: DataFrame, array: Column | str, position: str, value: str, keep: list[str]
) -> DataFrame:
    """One row per array element with its zero-based position.

    The outer form with a filter on the position gives the rows of a plain
    explode; the plain form lets the optimizer derive a size filter that it
    pushes below the projection, where the regex behind the array runs twice.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return rows.filter(F.col(position).isNotNull())


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that later filters refer to without recomputing it."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffles rows only when the scan has fewer partitions than the cluster has cores.

    A large corpus is read in many splits and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return folder or current
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="texlode-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Writes the rows to the checkpoint folder and reads them from there on.

    Rows, their order and their partitions stay the same when executors are lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """Writes the rows as a Parquet table below the checkpoint folder and reads it back.

    For frames that several later steps use: each step reads only its columns,
    and nothing upstream runs again when executors are lost.
    """
    folder = ensure_checkpoint_dir(df.sparkSession)
    path = own(df.sparkSession, f"{folder.rstrip('/')}/texlode-{uuid.uuid4().hex}")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _tables[table] = path
    return table


# Paths of tables that are still in use.
_tables: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``materialize`` that no later step reads, nor any frame that is not written yet."""
    for table in tables:
        path = _tables.pop(table)
        _written.remove((table.sparkSession, path))
        files, place = hadoop_path(table.sparkSession, path)
        files.delete(place, True)


def new_folder(spark: SparkSession, kind: str) -> str:
    """Name of a new folder below the checkpoint folder, deleted like the tables of ``materialize``."""
    return own(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/texlode-{uuid.uuid4().hex}-{kind}")


def own(spark: SparkSession, path: str) -> str:
    """Has ``drop_materialized`` delete a folder, too."""
    _written.append((spark, path))
    return path


# Folders that are intermediate, until they are dropped.
_written: list[tuple[SparkSession, str]] = []


def hadoop_path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = hadoop_path(spark, path)
    return files.exists(place)


def drop_materialized() -> None:
    """Deletes the tables and folders that are intermediate; frames that read them are of no more use.

    A job calls it when its results are written; at the end of the driver it is
    called for what is left.
    """
    while _written:
        spark, path = _written.pop()
        if spark.sparkContext._jsc is None:
            continue
        # The JVM may be gone at the end of the driver.
        with contextlib.suppress(Py4JError, ConnectionError):
            files, place = hadoop_path(spark, path)
            files.delete(place, True)


atexit.register(drop_materialized)


def dense_ids(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Numbers rows ``0, 1, 2, ...`` in the total order of ``order``.

    Rows are range-partitioned and sorted, then made durable; a row's number is
    the size of all earlier partitions plus its place in its own.  Only the
    partition sizes, one row per partition, meet in one task and are broadcast.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = durable(ranged).withColumn("_place", F.monotonically_increasing_id())
    partition = F.shiftright("_place", _ROW_BITS).alias("_part")
    sizes = fixed.groupBy(partition).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        fixed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + place)
        .drop("_part", "_place", "_offset")
    )


# Bits of the filter of ``narrowed``: at most 2**18 words of 64, some 8 MB when broadcast.
FILTER_BITS = 1 << 24


def narrowed(facts: DataFrame, wanted: DataFrame, key: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``facts`` whose key may stand in ``wanted``, found without a shuffle of ``facts``.

    For few keys among many wide rows: a join that follows settles which rows
    match, but only these rows, and a few by chance, travel to it.  The hashes of
    the wanted keys set bits of a map whose size does not depend on the data, so
    it can be broadcast; with more keys than bits it lets most rows pass, and
    loses none.
    """
    position = F.pmod(F.xxhash64(*key), F.lit(bits))
    word, bit = F.shiftright(position, 6), position.bitwiseAND(F.lit(63)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = wanted.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))
    marked = facts.select(F.struct("*").alias("row"), word.alias("word"), bit.alias("bit"))
    return marked.join(F.broadcast(words), "word").filter(F.getbit("bits", F.col("bit")) == 1).select("row.*")


def hot_limit(spark: SparkSession) -> int:
    """Most hot keys there can be: a few per shuffle partition, so that a colder key never fills one."""
    return max(MAX_HOT_KEYS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(counts: DataFrame, key: str, hits: str) -> DataFrame:
    """Digests of the keys that hold at least one in ``hot_limit`` of all hits."""
    total = counts.agg(F.sum(hits)).scalar()
    return counts.filter(F.col(hits) * hot_limit(counts.sparkSession) >= total).select(
        F.sha2(F.col(key), 256).alias("_digest")
    )


def lookup(facts: DataFrame, dictionary: DataFrame, key: str, hits: str | None = None) -> DataFrame:
    """Left join of facts to a dictionary that has one row per key and short values.

    ``hits`` is the dictionary's count of uses of each key, at least its number
    of facts; without it, facts are counted, so that keys the dictionary lacks
    are known as hot, too.  Hot keys, at most ``hot_limit`` by counting, are joined by
    broadcast of their digest and values.  Their facts, and facts without a key,
    then carry a join key of their own that no dictionary row has, so that the
    shuffle join of all other keys spreads them evenly.
    """
    values = [c for c in dictionary.columns if c not in (key, hits)]
    digest = F.sha2(F.col(key), 256)
    if hits is None:
        counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_hits"))
        counts, hits = materialize(counts), "_hits"
        if counts.isEmpty():
            hits = None
    else:
        counts = dictionary
    empty = F.struct(*[F.lit(None).cast(dictionary.schema[value].dataType).alias(value) for value in values])
    if hits is None:
        hot = facts.limit(0).select(digest.alias("_digest"), empty.alias("_hot"))
    else:
        # A hot key that the dictionary lacks has nulls for values.
        hot = (
            hot_keys(counts, key, hits)
            .join(dictionary.select(digest.alias("_digest"), F.struct(*values).alias("_found")), "_digest", "left")
            .select("_digest", F.coalesce("_found", empty).alias("_hot"))
        )
    tagged = (
        facts.withColumn("_digest", digest)
        .join(F.broadcast(hot), "_digest", "left")
        .drop("_digest")
    )
    apart = F.concat(F.lit(NO_KEY), F.xxhash64(*facts.columns).cast("string"))
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    tagged = tagged.withColumn("_join", F.when(settled, apart).otherwise(F.col(key)))
    other = dictionary.select(F.col(key).alias("_join"), F.struct(*values).alias("_cold"))
    found = F.coalesce("_hot", "_cold")
    return tagged.join(other, "_join", "left").select(
        *facts.columns, *[found[value].alias(value) for value in values]
    )
