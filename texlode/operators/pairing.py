"""TeX equations against converted XHTML: pairs, MathML, counts per document, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from texlode.functions import equations, formats
from texlode.functions import patterns as P
from texlode.functions.columns import col, find_all, let
from texlode.operators.extract import DOCUMENT_KEY, display_array, text_array, with_clean_body
from texlode.plans.physical import compute_once, durable, explode_rows, lookup

# The fields of an equation object, and the messages of the logs.
EQUATION_SCHEMA = (
    "text string, type string, itemtype string, prevtext string, nexttext string, "
    "file string, index int, pos int, mathml string"
)
MESSAGE_TIMEOUT = " MathML conversion failed - timeout"
MESSAGE_FAILED = " Conversion failed"
MESSAGE_POST_TIMEOUT = " MathML postprocessing failed - timeout"
MESSAGE_NO_BODY = "Missing body"
MESSAGE_COUNTS = "LaTeX/XHTML equation count mismatch"
MESSAGE_NO_XHTML = "missing_xhtml"


def xhtml_tables(xhtml: Column | str) -> Column:
    """MathML of each equation table, '' for a table without any."""
    tables = find_all(F.col(xhtml) if isinstance(xhtml, str) else xhtml, P.XHTML_TABLE)
    return F.transform(tables, lambda t: F.array_join(find_all(t, P.XHTML_MATH), "\n"))


def xhtml_equations(xhtml: DataFrame) -> DataFrame:
    found = xhtml.select("dir", "doc_name", xhtml_tables("xhtml").alias("tables"))
    return explode_rows(found, "tables", "eq_no", "mathml", ["dir", "doc_name"])


def join_xhtml(docs: DataFrame, xhtml: DataFrame) -> DataFrame:
    """Documents with their converted text, null where it is missing."""
    return docs.join(xhtml, ["dir", "doc_name"], "left")


def missing_xhtml(docs: DataFrame, xhtml: DataFrame) -> DataFrame:
    """Names of documents without converted text; only names travel."""
    names = ["dir", "doc_name"]
    return docs.select(*names).join(xhtml.select(*names), names, "left_anti")


def matched_xhtml(docs: DataFrame, xhtml: DataFrame) -> DataFrame:
    names = ["dir", "doc_name"]
    return docs.select(*names).join(xhtml.select(*names), names, "left_semi")


def first_places(body: Column | str, equations: Column | str) -> Column:
    """Where each display equation first stands in a text, as a string, from 0; -1 for nowhere.

    The text is cut once before each place where display math may open.  One that
    holds no second opening stands where a piece begins with it, so pieces are
    compared in place of a search through the text for each equation.  Math in
    dollars is a piece, and the next begins with dollars.  All others are sought.
    """

    def place(eq: Column, t: Column, pieces: Column, cut: Column) -> Column:
        sought = (F.instr(t, eq) - 1).cast("int")

        def at(found: Column) -> Column:
            return F.when(found == 0, -1).otherwise(F.get(cut["starts"], (found - 1).cast("int")))

        in_dollars = let(
            F.array_position(pieces, F.substring(eq, F.lit(1), F.length(eq) - 2)),
            lambda found: F.when(F.startswith(F.get(pieces, found.cast("int")), F.lit("$$")), at(found)).otherwise(sought),
        )
        return let(
            F.size(F.split(eq, P.DISPLAY_OPENS, -1)),
            lambda cuts: F.when(F.startswith(eq, F.lit("$$")), F.when((cuts == 2) & cut["apart"], in_dollars).otherwise(sought))
            .when(cuts == 1, at(F.array_position(cut["opened"], eq)))
            .otherwise(sought),
        )

    def places(t: Column, pieces: Column) -> Column:
        opened = F.transform(pieces, lambda piece: F.regexp_extract(piece, r"\A" + P.DISPLAY_MATH, 0))
        starts = F.aggregate(
            pieces,
            F.array(F.lit(0)),
            lambda sums, piece: F.concat(sums, F.array(F.element_at(sums, -1) + F.length(piece))),
        )
        return let(
            F.struct(
                opened.alias("opened"), starts.alias("starts"), (~F.contains(t, F.lit("$$$"))).alias("apart")
            ),
            lambda cut: F.transform(equations, lambda eq: place(eq, t, pieces, cut)),
        )

    return let(col(body), lambda t: let(F.split(t, P.DISPLAY_OPENS, -1), lambda pieces: places(t, pieces)))


def paired_documents(docs: DataFrame, xhtml: DataFrame) -> DataFrame:
    """One row per document with math: its arrays, its MathML, and what stops it, if anything.

    Both sides shrink to what the pairing needs before the join: of the body, the
    places of its equations.
    """
    tex = compute_once(
        with_clean_body(docs),
        "tex",
        F.struct(display_array().alias("eqs"), text_array().alias("parts")),
    ).select(*DOCUMENT_KEY, "body", "tex.*")
    tex = tex.filter(F.size("eqs") > 0).select(*DOCUMENT_KEY, "eqs", "parts", first_places("body", "eqs").alias("places"))
    converted = xhtml.select("dir", "doc_name", xhtml_tables("xhtml").alias("mathml"))
    joined = tex.join(converted, ["dir", "doc_name"], "left")
    reason = (
        F.when(F.col("mathml").isNull(), MESSAGE_NO_XHTML)
        .when(F.size("eqs") != F.size("mathml"), MESSAGE_COUNTS)
    )
    return joined.withColumn("reason", reason)


def _objects():
    """Equation objects of one paired document, as an array of structs."""

    def build(eq, n):
        first = F.array_position("eqs", eq).cast("int")
        return F.struct(
            eq.alias("text"),
            F.lit("latex").alias("type"),
            F.lit("equation").alias("itemtype"),
            F.get("parts", first - 1).alias("prevtext"),
            F.get("parts", first).alias("nexttext"),
            F.col("file").alias("file"),
            (first * 2 - 1).alias("index"),
            F.get("places", n).alias("pos"),
            F.get("mathml", n).alias("mathml"),
        )

    return F.transform("eqs", build)


def equation_objects(paired: DataFrame) -> DataFrame:
    """The n-th TeX equation with the n-th MathML, where a document has as many of both.

    ``index``, ``pos`` and the context are those of the first equal equation of
    the document; ``eq_no`` is the equation's own place.
    """
    ready = paired.filter(F.col("reason").isNull()).select(_objects().alias("items"))
    return explode_rows(ready, "items", "eq_no", "item", []).select("eq_no", "item.*")


def equation_rows(paired: DataFrame) -> DataFrame:
    """``(file, eq_no, text, mathml)`` of the same equations, without their context."""
    items = F.transform("eqs", lambda eq, n: F.struct(eq.alias("text"), F.get("mathml", n).alias("mathml")))
    ready = paired.filter(F.col("reason").isNull()).select("file", items.alias("items"))
    return explode_rows(ready, "items", "eq_no", "item", ["file"]).select("file", "eq_no", "item.*")


def equations_json(paired: DataFrame) -> DataFrame:
    """One JSON array of equation objects per document, in reading order."""
    ready = paired.filter(F.col("reason").isNull())
    return ready.select("file", F.to_json(_objects()).alias("json"))


def pairing_rejects(paired: DataFrame) -> DataFrame:
    detail = F.when(
        F.col("reason") == MESSAGE_COUNTS,
        F.concat(
            F.lit("LaTeX - "), F.size("eqs").cast("string"),
            F.lit(", XHTML - "), F.size("mathml").cast("string"),
        ),
    ).otherwise("")
    return paired.filter(F.col("reason").isNotNull()).select(
        F.lit("pair").alias("op"), "file", "reason", detail.alias("detail")
    )


def attach_ids(objects: DataFrame, eq_dict: DataFrame, meq_dict: DataFrame) -> DataFrame:
    """Equation objects with the id of their dictionary row, null for a mismatch.

    Multi-line equations are sought by raw text, all others by flat key; one
    join serves both because the dictionary key carries its kind.
    """
    kinded = objects.withColumn("_multi", equations.is_multiline("text")).withColumn(
        "lookup_key",
        F.when(F.col("_multi"), F.concat(F.lit("M"), F.col("text"))).otherwise(
            F.concat(F.lit("S"), equations.flat_form("text"))
        ),
    )
    keys = eq_dict.select(
        F.concat(F.lit("S"), "eq_key").alias("lookup_key"), "eqid", "n_occurrences"
    ).unionByName(
        meq_dict.select(F.concat(F.lit("M"), "eq_text").alias("lookup_key"), "eqid", "n_occurrences")
    )
    return lookup(kinded, keys, "lookup_key", "n_occurrences").drop("_multi", "lookup_key")


def document_counts(identified: DataFrame) -> DataFrame:
    """Occurrences of each equation per document."""
    return (
        identified.filter(F.col("eqid").isNotNull())
        .groupBy("eqid", "file")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def first_mathml(identified: DataFrame) -> DataFrame:
    """First non-empty MathML of each equation in corpus order."""
    filled = identified.filter(F.col("eqid").isNotNull() & (F.col("mathml") != ""))
    return filled.groupBy("eqid").agg(
        F.min(F.struct("file", "eq_no", "mathml"))["mathml"].alias("mathml")
    )


def _line_parts(counted: DataFrame, length: int) -> DataFrame:
    """Adds ``part``: the place of a file, in order, within its equation and folder, by ``length``.

    Places are made per range of files, so that no equation meets in one task.
    """
    order = ["eqid", "dir", "file"]
    ranged = durable(counted.repartitionByRange(*order)).withColumn("_range", F.spark_partition_id())
    keys = ["eqid", "dir", "_range"]
    sizes = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("eqid", "dir").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("file")) - 1
    placed = ranged.withColumn("_place", place).join(offsets, keys)
    part = F.floor((F.col("_offset") + F.col("_place")) / length)
    return placed.withColumn("part", part).drop("_range", "_place", "_offset")


def equation_documents(
    identified: DataFrame, eq_dict: DataFrame, meq_dict: DataFrame, counts_per_line: int = 100_000
) -> DataFrame:
    """Lines of the table: id, masked TeX, masked quoted MathML, ``file:count,..``, folder.

    Every equation has lines of ``counts_per_line`` files, in order, for each
    corpus folder it stands in, so that no line grows with the corpus; ``part``
    numbers them.  One that stands nowhere has an empty folder.
    """
    texts = eq_dict.select("eqid", "eq_text").unionByName(meq_dict.select("eqid", "eq_text"))
    counted = document_counts(identified).withColumn("dir", F.substring_index("file", "/", 1))
    lists = _line_parts(counted, counts_per_line).groupBy("eqid", "dir", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.col("file").alias("key"), F.col("n").alias("value")))).alias("items")
    )
    lines = texts.join(first_mathml(identified), "eqid", "left").join(lists, "eqid", "left")
    return lines.select(
        "eqid",
        formats.mask("eq_text").alias("tex"),
        formats.mask(F.concat(F.lit('"'), F.coalesce("mathml", F.lit("")), F.lit('"'))).alias("mathml"),
        F.coalesce(
            F.array_join(
                F.transform("items", lambda i: F.concat(i["key"], F.lit(":"), i["value"].cast("string"))),
                ",",
            ),
            F.lit(""),
        ).alias("documents"),
        F.coalesce("dir", F.lit("")).alias("dir"),
        F.coalesce("part", F.lit(0)).alias("part"),
    )


def table_errors(xhtml: DataFrame) -> DataFrame:
    """Equation tables per converted document and those that carry an error mark."""
    tables = find_all(F.col("xhtml"), P.XHTML_TABLE)
    marks = F.transform(tables, lambda t: F.contains(t, F.lit(P.XHTML_ERROR)).cast("int"))
    staged = xhtml.select("dir", "doc_name", marks.alias("marks"))
    return staged.select(
        "dir",
        "doc_name",
        F.size("marks").alias("n_tables"),
        F.aggregate("marks", F.lit(0), lambda total, mark: total + mark).alias("n_errors"),
    )


def coverage(xhtml: DataFrame, log: DataFrame, math_docs: DataFrame) -> DataFrame:
    """Equation and document coverage in percent; null instead of a division by zero."""
    tables = table_errors(xhtml).agg(
        F.sum("n_errors").alias("n_errors"), F.sum("n_tables").alias("n_tables")
    )
    failures = log.agg(
        F.count(F.when(F.col("message") == MESSAGE_FAILED, 1)).alias("n_failed"),
        F.count(F.when(F.col("message") == MESSAGE_TIMEOUT, 1)).alias("n_timed_out"),
    )
    documents = math_docs.agg(F.count(F.lit(1)).alias("n_math_docs"))

    def percent(part: Column, whole: Column) -> Column:
        return F.round((F.lit(1) - part / F.nullif(whole, F.lit(0))) * 100, 2)

    # Each frame is one row with its own columns; their union folds into one row.
    rows = tables.unionByName(failures, allowMissingColumns=True).unionByName(
        documents, allowMissingColumns=True
    )
    one = rows.agg(*[F.max(name).alias(name) for name in rows.columns])
    return one.select(
        "n_failed",
        "n_timed_out",
        percent(F.col("n_errors"), F.col("n_tables")).alias("equation_coverage"),
        percent(F.col("n_failed") + F.col("n_timed_out"), F.col("n_math_docs")).alias(
            "document_coverage"
        ),
    )
