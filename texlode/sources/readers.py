"""Readers of TeX, XHTML, tables of lines and JSON.

Each reader is a scan followed by a frame-to-frame parser, so the same parser
also serves texts that already stand in a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from texlode.functions import cleaning, formats
from texlode.functions import patterns as P
from texlode.functions.columns import let
from texlode.operators.pairing import EQUATION_SCHEMA
from texlode.plans.physical import explode_rows
from texlode.sources.files import read_files

# Fixed value: the ending of a folder of converted documents.
CONVERTED_SUFFIX = "_converted"
SCHEME = r"^(?:\w+:)?/*"
ATOM_CATEGORY = r'(?s)<arxiv:primary_category[^>]*?\sterm="(.*?)"'
SQL_PAIR = r"(?U)(\w+)\s###([^#]+)###"


def _files(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool) -> DataFrame:
    files = read_files(spark, path, glob, None if recursive else 0)
    return _files_by_spark(spark, path, glob, recursive) if files is None else files


def _files_by_spark(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool) -> DataFrame:
    """The same for stores that only Spark opens; the driver holds the names of all files."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "content")


def parse_tex(files: DataFrame) -> DataFrame:
    """``(path, content)`` to documents: latin-1 text, newlines unified, names from the path."""
    return files.select(
        formats.folder_name("path").alias("dir"),
        F.concat_ws("/", formats.folder_name("path"), F.substring_index("path", "/", -1)).alias("file"),
        formats.document_name("path").alias("doc_name"),
        cleaning.decode_latin1("content").alias("text"),
    )


def read_tex(spark: SparkSession, path: str | list[str], glob: str | None = "*.tex") -> DataFrame:
    """Documents of one folder or of several; ``glob=None`` takes every file."""
    return parse_tex(_files(spark, path, glob, recursive=False))


def read_tex_parent(spark: SparkSession, path: str, glob: str | None = "*.tex") -> DataFrame:
    """Documents of all folders below ``path``; folders that start with a dot are skipped."""
    files = read_files(spark, path, glob, depth=1, hidden=r"^\.")
    if files is None:
        files = _files_by_spark(spark, f"{path.rstrip('/')}/[!.]*", glob, recursive=False)
    return parse_tex(files)


def parse_submissions(files: DataFrame, root: str) -> DataFrame:
    """``(path, content)`` below ``root`` to ``(folder, rel_path, text)``."""
    below = F.regexp_extract("path", SCHEME + "(.*)$", 1)
    start = len(re.sub(SCHEME, "", root).rstrip("/")) + 2
    cut = F.substring(below, F.lit(start), F.length("path"))
    return files.select(
        F.substring_index(cut, "/", 1).alias("folder"),
        F.regexp_extract(cut, r"^[^/]+/(.*)$", 1).alias("rel_path"),
        cleaning.decode_latin1("content").alias("text"),
    )


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """Submission folders below ``path``, one per paper, with their TeX files."""
    return parse_submissions(_files(spark, path, "*.[tT][eE][xX]", recursive=True), path)


def parse_xhtml(files: DataFrame) -> DataFrame:
    """Converted documents keyed by folder and name; the folder loses its ``_converted``."""
    return files.select(
        F.regexp_replace(formats.folder_name("path"), CONVERTED_SUFFIX + "$", "").alias("dir"),
        formats.document_name("path").alias("doc_name"),
        cleaning.unify_newlines(F.decode("content", "UTF-8")).alias("xhtml"),
    )


def read_xhtml(spark: SparkSession, path: str) -> DataFrame:
    return parse_xhtml(_files(spark, path, "*.xhtml", recursive=True))


def parse_equation_lines(lines: DataFrame) -> DataFrame:
    """Lines of two columns (single) or three (multi-line) to ``(eqid, sub_ids, eq_text)``."""
    parts = lines.select(F.split("value", "\t", -1).alias("c")).filter(F.size("c").isin(2, 3))
    return parts.select(
        F.col("c")[0].alias("eqid"),
        F.when(F.size("c") == 3, F.split(F.col("c")[1], ",", -1)).alias("sub_ids"),
        formats.unmask(F.element_at("c", -1)).alias("eq_text"),
    )


def read_equation_table(spark: SparkSession, path: str) -> DataFrame:
    return parse_equation_lines(spark.read.text(path))


def parse_equation_json(documents: DataFrame) -> DataFrame:
    """``(json)`` with one array of equation objects per row to one row per object."""
    parsed = documents.select(F.from_json("json", f"array<struct<{_ddl()}>>").alias("items"))
    return explode_rows(parsed, "items", "eq_no", "item", []).select("eq_no", "item.*")


def _ddl() -> str:
    return ", ".join(
        f"{name}: {kind}" for name, kind in (f.strip().split(" ") for f in EQUATION_SCHEMA.split(","))
    )


def read_equation_json(spark: SparkSession, path: str) -> DataFrame:
    """Equation objects of all JSON files below ``path``, one array per file; a file that is no JSON is a row of nulls."""
    text = F.try_validate_utf8(F.col("content").cast("string"))
    documents = _files(spark, path, "*.json", recursive=True).select(
        F.regexp_replace(text, "^\ufeff", "").alias("json")
    )
    kind = f"array<struct<{_ddl()}>>"
    broken = F.from_json(F.lit("[null]"), kind)
    blank = F.coalesce(F.rlike("json", F.lit(r"\A[ \t\r\n]*\z")), F.lit(False))
    # Blank files have no rows; an array with a null in it is broken as a whole.
    items = let(
        F.from_json("json", kind),
        lambda found: F.when(F.exists(found, F.isnull), broken).otherwise(F.coalesce(found, F.when(~blank, broken))),
    )
    return explode_rows(documents.select(items.alias("items")), "items", "eq_no", "item", []).select("item.*")


def parse_category_lines(lines: DataFrame) -> DataFrame:
    """``file category`` lines; the category is cut at its first dot."""
    words = F.split(F.btrim("value", F.lit(P.WHITESPACE)), r"(?U)[\s\x1c-\x1f]+", -1)
    return (
        lines.select(words.alias("w"))
        .filter(F.size("w") >= 2)
        .select(F.col("w")[0].alias("file"), F.substring_index(F.col("w")[1], ".", 1).alias("category"))
    )


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return parse_category_lines(spark.read.text(path))


def parse_bibcode_lines(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_csv(F.btrim("value"), "doc_name string, bibcode string").alias("r")).select("r.*")


def read_bibcodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_name string, bibcode string").csv(path)


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """Lines with exactly one colon to ``(file, message)``."""
    parts = F.split(F.btrim("value", F.lit(P.WHITESPACE)), ":", -1)
    return (
        lines.select(parts.alias("p"))
        .filter(F.size("p") == 2)
        .select(F.col("p")[0].alias("file"), F.col("p")[1].alias("message"))
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_lines(spark.read.text(path))


def read_eqid_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("eqid")).filter("eqid <> ''")


def parse_sql_pairs(texts: DataFrame) -> DataFrame:
    """``name ###equation###`` pairs of each text."""
    names = F.regexp_extract_all("value", F.lit(SQL_PAIR), F.lit(1))
    bodies = F.regexp_extract_all("value", F.lit(SQL_PAIR), F.lit(2))
    zipped = texts.select(F.arrays_zip(names.alias("name"), bodies.alias("equation")).alias("pairs"))
    return explode_rows(zipped, "pairs", "n", "pair", []).select("pair.name", "pair.equation")


def read_sql_dump(spark: SparkSession, path: str) -> DataFrame:
    """A dump is read as rows that end in ``###``, so a large one splits over tasks."""
    rows = spark.read.option("lineSep", "###\n").text(path)
    return parse_sql_pairs(rows.select(F.concat("value", F.lit("###")).alias("value")))


def parse_atom(responses: DataFrame) -> DataFrame:
    """Primary category of each stored response; responses without one drop out."""
    category = F.regexp_extract_all("body", F.lit(ATOM_CATEGORY), F.lit(1))
    rows = responses.select("file", F.explode_outer(F.slice(category, 1, 1)).alias("category"))
    return rows.filter(F.col("category").isNotNull())
