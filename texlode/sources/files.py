"""Files below folders, found and read in tasks.

Spark's own readers keep the name of every file in the driver; here the driver
holds the roots only, and the names are rows of a table.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texlode.plans.physical import hadoop_path, materialize

# Names that Spark's readers pass over.
HIDDEN = r"^\.|^_[^=]*$|\._COPYING_$"

# Rows of names in one batch, and bytes of content; a larger file is a batch of its own.
BATCH_NAMES = 10_000
BATCH_BYTES = 1 << 24

# A task reads files of so many bytes, where opening one counts as some bytes, or looks into so many folders.
TASK_BYTES = 1 << 25
OPEN_BYTES = 1 << 14
TASK_FOLDERS = 1_000


def _roots(spark: SparkSession, path: str | list[str]) -> list[str] | None:
    """What the paths or patterns name, in full; None where only Spark's readers can tell."""
    roots = []
    for one in [path] if isinstance(path, str) else path:
        files, place = hadoop_path(spark, one)
        named = [files.makeQualified(found.getPath()).toString() for found in files.globStatus(place) or []]
        if not named:
            return None
        roots += named
    try:
        for root in roots:
            fs.FileSystem.from_uri(_plain(root))
    except (pa.ArrowException, OSError):
        return None
    return roots


def _plain(uri: str) -> str:
    """Local paths may hold signs that URIs may not."""
    return re.sub("^file:/+", "/", uri)


def _name() -> Column:
    return F.substring_index(F.concat_ws("/", "root", "below"), "/", -1)


def _looked_into(folders: DataFrame) -> DataFrame:
    """What stands in folders ``(root, base, below)``, with the size of files; a root may be a file, too."""
    size_of_batch = BATCH_NAMES
    schema = pa.schema([("root", pa.string()), ("base", pa.string()), ("below", pa.string()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = fs.FileSystem.from_uri(row["base"])
                if row["below"] is None and system.get_file_info(place).is_file:
                    found = [system.get_file_info(place)]
                else:
                    place = posixpath.join(place, row["below"] or "")
                    found = system.get_file_info(fs.FileSelector(place))
                for first in range(0, len(found), size_of_batch):
                    part = [x for x in found[first : first + size_of_batch] if x.type in (fs.FileType.File, fs.FileType.Directory)]
                    below = [posixpath.join(row["below"] or "", x.base_name) if x.path != place else None for x in part]
                    columns = [[row["root"]] * len(part), [row["base"]] * len(part), below, [x.size for x in part]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return folders.mapInArrow(run, "root string, base string, below string, size bigint")


def _read(files: DataFrame) -> DataFrame:
    """``(path, content)`` of files ``(root, base, below)``."""
    bytes_of_batch = BATCH_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems: dict[str, tuple[fs.FileSystem, str]] = {}

        def rows(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"]
            )

        for batch in batches:
            paths, contents, held = [], [], 0
            for row in batch.to_pylist():
                if row["base"] not in systems:
                    systems[row["base"]] = fs.FileSystem.from_uri(row["base"])
                system, place = systems[row["base"]]
                if row["below"] is not None:
                    place = posixpath.join(place, row["below"])
                with system.open_input_stream(place, compression=None) as file:
                    content = file.read()
                paths.append(row["root"] if row["below"] is None else posixpath.join(row["root"], row["below"]))
                contents.append(content)
                held += len(content)
                if held >= bytes_of_batch:
                    yield rows(paths, contents)
                    paths, contents, held = [], [], 0
            if paths:
                yield rows(paths, contents)

    return files.mapInArrow(run, "path string, content binary")


def _matching(spark: SparkSession, glob: str) -> Column:
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().toString()
    return F.rlike(_name(), F.lit(rf"(?s)\A(?:{pattern})\z"))


def read_files(
    spark: SparkSession, path: str | list[str], glob: str | None = None, depth: int | None = None, hidden: str = HIDDEN
) -> DataFrame | None:
    """``(path, content)`` of the files in the folders named and ``depth`` levels below, or all levels.

    As in Spark's readers, empty and hidden files are passed over; ``hidden`` says
    which folders are.  Folders are looked into level by level, in tasks; a folder
    is one row of work, so its names, but no others, are in one task.  None for a
    store that only Spark's readers open, and for paths that name nothing.
    """
    roots = _roots(spark, path)
    if roots is None:
        return None
    cores = spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame(
        [(root, _plain(root), None) for root in roots], "root string, base string, below string"
    )
    found, n_files, n_bytes, n_folders, level = [], 0, 0, len(roots), 0
    wanted = ~F.rlike(_name(), F.lit(HIDDEN)) & (F.col("size") > 0)
    if glob:
        wanted &= _matching(spark, glob)
    is_folder, entered = F.col("size").isNull(), ~F.rlike(_name(), F.lit(hidden))
    while n_folders:
        seen = _looked_into(folders.repartition(min(n_folders, max(cores, n_folders // TASK_FOLDERS))))
        seen = materialize(seen.filter(wanted if level == depth else F.when(is_folder, entered).otherwise(wanted)))
        sums = seen.agg(F.count("size"), F.coalesce(F.sum("size"), F.lit(0)), F.count_if(is_folder)).first()
        found.append(seen.filter(~is_folder))
        n_files, n_bytes, n_folders, level = n_files + sums[0], n_bytes + sums[1], sums[2], level + 1
        folders = seen.filter(is_folder).select("root", "base", "below")
    files = found[0]
    for more in found[1:]:
        files = files.union(more)
    tasks = max(cores, (n_bytes + n_files * OPEN_BYTES) // TASK_BYTES)
    return _read(files.select("root", "base", "below").repartition(tasks))
