"""Writers: equation tables, JSON, files and text per document, rejects, listings."""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.functions import formats


def equation_lines(eq_dict: DataFrame, meq_dict: DataFrame | None = None) -> DataFrame:
    """``eqid TAB masked`` for single, ``eqid TAB ids TAB masked`` for multi-line equations."""
    lines = eq_dict.select(F.concat_ws("\t", "eqid", formats.mask("eq_text")).alias("value"))
    if meq_dict is None:
        return lines
    multi = meq_dict.select(
        F.concat_ws("\t", "eqid", F.array_join("sub_ids", ","), formats.mask("eq_text")).alias("value")
    )
    return lines.unionByName(multi)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def equation_document_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat_ws("\t", "eqid", "tex", "mathml", "documents", "dir").alias("value"))


def write_texts(documents: DataFrame, path: str) -> None:
    """Produced texts as Parquet ``(file, doc_name, text)``, one folder per corpus folder."""
    documents.write.mode("overwrite").partitionBy("dir").parquet(path)


def write_files(files: DataFrame, folder: str) -> None:
    """One file per row ``(path, content)`` below a folder that all executors reach.

    Tasks write their own rows.  A file gets its name once it is whole, so a task
    that is lost leaves nothing that a scan would read, and its repetition writes
    the same files again.
    """
    place = re.sub("^file:/+", "/", folder.rstrip("/"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(place)
        made: set[str] = set()
        for batch in batches:
            rows = zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True)
            for path, content in rows:
                target = posixpath.join(root, path)
                parent = posixpath.dirname(target)
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                part = posixpath.join(parent, f".{uuid.uuid4().hex}")
                with system.open_output_stream(part) as out:
                    out.write(content)
                system.move(part, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    files.select("path", "content").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


def write_rejects(rejects: DataFrame, path: str, run: str) -> None:
    """Rejects of one run, by operation; a run that is repeated overwrites its own rows only."""
    (
        rejects.select("op", "file", "reason", "detail", F.lit(run).alias("run"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "op")
        .parquet(path)
    )


def write_categories(categories: DataFrame, path: str) -> None:
    categories.select("file", "category").write.mode("overwrite").csv(path, sep=" ")
