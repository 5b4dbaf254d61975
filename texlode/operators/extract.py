"""Documents to equations, segments, inline math and their context.

A document is one row ``(dir, file, doc_name, text)`` with ``file`` unique.
Everything here is local to the row: no operator of this module shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texlode.functions import cleaning, equations
from texlode.functions import patterns as P
from texlode.functions.columns import find_all
from texlode.plans.physical import compute_once, explode_rows

DOCUMENT_KEY = ["dir", "file", "doc_name"]


def with_body(docs: DataFrame) -> DataFrame:
    """Adds ``plain`` (no comments) and ``body`` ('' when the document has none)."""
    return docs.withColumn("plain", cleaning.strip_comments("text")).withColumn(
        "body", cleaning.body_of("plain")
    )


def with_clean_body(docs: DataFrame) -> DataFrame:
    """Adds ``clean``: the body with normalised inline math, escaped dollars parked."""
    return with_body(docs).withColumn("clean", cleaning.normalise_inline_parked("body"))


def display_array(clean: Column | str = "clean") -> Column:
    """Display equations of a cleaned body in reading order."""
    found = find_all(F.col(clean) if isinstance(clean, str) else clean, P.DISPLAY_MATH)
    return F.transform(found, cleaning.unpark_dollars)


def text_array(clean: Column | str = "clean") -> Column:
    """Text between the display equations, one element more than equations."""
    pieces = F.split(clean, P.DISPLAY_MATH, -1)
    return F.transform(pieces, cleaning.unpark_dollars)


def display_equations(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per display equation: key, ``eq_no`` from 0, ``text``."""
    keep = keep or DOCUMENT_KEY
    found = with_clean_body(docs).select(*keep, find_all(F.col("clean"), P.DISPLAY_MATH).alias("eqs"))
    rows = explode_rows(found, "eqs", "eq_no", "text", keep)
    return rows.withColumn("text", cleaning.unpark_dollars("text"))


def classified_equations(docs: DataFrame) -> DataFrame:
    """Display equations with environment, multi-line flag, standard form and key."""
    return (
        display_equations(docs)
        .withColumn("env", equations.environment("text"))
        .withColumn("is_multiline", F.col("env").isin(*P.MULTILINE_ENVIRONMENTS))
        .withColumn("std_eq", equations.standard_form("text"))
        .withColumn("flat_eq", equations.remove_whitespace("std_eq"))
    )


def math_documents(docs: DataFrame) -> DataFrame:
    """Documents with at least one display equation and their number ``n_display``.

    A body needs a backslash, so texts without one are dropped before any regex runs.
    """
    candidates = docs.filter(F.contains("text", F.lit("\\")))
    counted = compute_once(
        with_clean_body(candidates).select(*DOCUMENT_KEY, "clean"),
        "n_display",
        F.regexp_count("clean", F.lit(P.DISPLAY_MATH)),
    )
    return counted.filter(F.col("n_display") > 0).select(*DOCUMENT_KEY, "n_display")


def segments(docs: DataFrame) -> DataFrame:
    """Text and equations of the body interleaved: ``ord``, ``kind``, ``text``.

    Equation *n* stands at ``ord`` 2n + 1; joined in order the segments give the
    cleaned body.
    """
    pairs = with_clean_body(docs).select(
        *DOCUMENT_KEY,
        F.arrays_zip(text_array().alias("part"), display_array().alias("eq")).alias("pairs"),
    )
    rows = explode_rows(pairs, "pairs", "n", "pair", DOCUMENT_KEY)
    both = rows.select(
        *DOCUMENT_KEY,
        F.stack(
            F.lit(2),
            F.col("n") * 2, F.lit("text"), F.col("pair.part"),
            F.col("n") * 2 + 1, F.lit("equation"), F.col("pair.eq"),
        ).alias("ord", "kind", "text"),
    )
    return both.filter(F.col("text").isNotNull())


def segment_equations(segment_rows: DataFrame) -> DataFrame:
    return segment_rows.filter(F.col("kind") == "equation")


def equation_context(docs: DataFrame) -> DataFrame:
    """Each display equation with the text before and after its own place."""
    staged = with_clean_body(docs).select(
        *DOCUMENT_KEY, text_array().alias("parts"), display_array().alias("eqs")
    )
    zipped = staged.select(
        *DOCUMENT_KEY,
        F.transform(
            "eqs",
            lambda eq, n: F.struct(
                eq.alias("text"),
                F.get("parts", n).alias("prevtext"),
                F.get("parts", n + 1).alias("nexttext"),
            ),
        ).alias("items"),
    )
    return explode_rows(zipped, "items", "eq_no", "item", DOCUMENT_KEY).select(
        *DOCUMENT_KEY, "eq_no", "item.*"
    )


def inline_array(clean: Column | str = "clean") -> Column:
    """Inline equations of a cleaned body; one that spans lines is left out."""
    runs = cleaning.inline_runs(clean)
    single = F.flatten(F.transform(runs, lambda run: find_all(run, P.INLINE_ONE)))
    return F.transform(single, cleaning.unpark_dollars)


def inline_segments(docs: DataFrame) -> DataFrame:
    """Text and inline equations of the body interleaved: ``ord``, ``kind``, ``text``.

    Inline math that spans lines is no equation and falls out.
    """
    # Found once per text: within the fold over its parts, the runs would be sought for each of them.
    found = F.struct(
        F.split("clean", P.INLINE_RUN, -1).alias("parts"),
        F.transform(find_all(F.col("clean"), P.INLINE_RUN, 1), lambda run: find_all(run, P.INLINE_ONE)).alias("runs"),
    )
    cut = compute_once(with_clean_body(docs).select(*DOCUMENT_KEY, "clean"), "cut", found).select(*DOCUMENT_KEY, "cut.*")

    def segment(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), cleaning.unpark_dollars(text).alias("text"))

    pieces = F.flatten(
        F.transform(
            "parts",
            lambda part, n: F.concat(
                F.array(segment("text", part)),
                F.coalesce(F.transform(F.get("runs", n), lambda one: segment("equation", one)), F.array().cast(_SEGMENTS)),
            ),
        )
    )
    rows = explode_rows(cut.select(*DOCUMENT_KEY, pieces.alias("pieces")), "pieces", "ord", "piece", DOCUMENT_KEY)
    return rows.select(*DOCUMENT_KEY, "ord", "piece.*")


_SEGMENTS = "array<struct<kind:string,text:string>>"


def inline_equations(docs: DataFrame) -> DataFrame:
    """One row per inline equation ``$..$``: key, ``eq_no`` from 0, ``text``."""
    found = with_clean_body(docs).select(*DOCUMENT_KEY, inline_array().alias("eqs"))
    return explode_rows(found, "eqs", "eq_no", "text", DOCUMENT_KEY)


def sanitized_text(docs: DataFrame) -> DataFrame:
    """Equation-only document: class ``article``, packages, display math; '' without a body."""
    stripped = docs.withColumn(
        "_bare", cleaning.remove_inline_math(cleaning.strip_comments("text"))
    )
    parsed = (
        stripped.withColumn("body", cleaning.document_body("_bare"))
        .withColumn("clean", cleaning.normalise_inline_parked("body"))
        .withColumn("_eqs", display_array())
    )
    whole = F.array_join(
        F.concat(
            F.array(F.concat(cleaning.document_class("_bare"), F.lit("\n"))),
            cleaning.package_statements("_bare", across_lines=True),
            F.array(F.lit("\\begin{document}\n")),
            F.col("_eqs"),
            F.array(F.lit("\\end{document}")),
        ),
        "\n\n",
    )
    framed = F.contains("_bare", F.lit("\\begin{document}")) & F.contains(
        "_bare", F.lit("\\end{document}")
    )
    return parsed.select(*DOCUMENT_KEY, F.when(framed, whole).otherwise("").alias("text"))


def stripped_prose(docs: DataFrame) -> DataFrame:
    """Prose without LaTeX and the number of display equations taken out."""
    parsed = with_clean_body(docs).withColumn("_eqs", display_array())
    return parsed.select(
        *DOCUMENT_KEY,
        cleaning.strip_latex("text", "_eqs").alias("text"),
        F.size("_eqs").alias("n_display"),
    )
