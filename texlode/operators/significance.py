"""Labels, references and the most significant equation of a document.

A label and its references always stand in the same document, so they meet in
arrays of that document's row; nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.functions import cleaning, equations
from texlode.functions import patterns as P
from texlode.functions.columns import let
from texlode.operators.extract import DOCUMENT_KEY, display_array, with_clean_body
from texlode.plans.physical import compute_once, explode_rows


def _with_labels(docs: DataFrame) -> DataFrame:
    """Adds ``eqs``, ``labels`` as ``(label, eq_no)`` and ``refs`` as trimmed keys."""
    found = with_clean_body(docs).withColumn("eqs", display_array())
    marks = F.flatten(
        F.transform(
            "eqs",
            lambda eq, n: F.transform(
                equations.labels(eq), lambda label: F.struct(label.alias("label"), n.alias("eq_no"))
            ),
        )
    )
    return found.withColumn("labels", marks).withColumn("refs", cleaning.references("plain"))


def equation_labels(docs: DataFrame) -> DataFrame:
    found = _with_labels(docs).select("file", "labels")
    return explode_rows(found, "labels", "label_no", "mark", ["file"]).select(
        "file", "mark.eq_no", "label_no", "mark.label"
    )


def equation_references(docs: DataFrame) -> DataFrame:
    """``\\eqref`` first, then ``\\ref``, each in reading order."""
    found = docs.select("file", cleaning.strip_comments("text").alias("plain")).select(
        "file", cleaning.references("plain").alias("refs")
    )
    return explode_rows(found, "refs", "ref_no", "label", ["file"])


def _resolved(docs: DataFrame) -> DataFrame:
    """Adds ``hits``: references with the last equation that bears their label."""
    labelled = _with_labels(docs)
    # ``let`` keeps the labels out of the loop over the references, into which the
    # optimizer would otherwise move the search for them.
    hits = let(
        F.col("labels"),
        lambda labels: F.filter(
            F.transform(
                "refs",
                lambda ref, n: F.struct(
                    n.alias("ref_no"),
                    ref.alias("label"),
                    F.array_max(
                        F.transform(
                            F.filter(labels, lambda mark: mark["label"] == ref),
                            lambda mark: mark["eq_no"],
                        )
                    ).alias("eq_no"),
                ),
            ),
            lambda hit: hit["eq_no"].isNotNull(),
        ),
    )
    return labelled.withColumn("hits", hits)


def label_references(docs: DataFrame) -> DataFrame:
    """Each reference to an equation label with its equation."""
    named = F.transform(
        "hits", lambda hit: hit.withField("text", F.get("eqs", hit["eq_no"]))
    )
    found = _resolved(docs).select("file", named.alias("hits"))
    return explode_rows(found, "hits", "hit_no", "hit", ["file"]).select("file", "hit.*")


def _counted(docs: DataFrame) -> DataFrame:
    """Adds ``counts``: references per equation text, its place and its first reference."""
    texts = F.transform(
        "hits",
        lambda hit: F.struct(
            (F.array_position("eqs", F.get("eqs", hit["eq_no"])) - 1).cast("int").alias("eq_no"),
            hit["ref_no"].alias("ref_no"),
        ),
    )
    staged = _resolved(docs).withColumn("uses", texts)
    counts = F.transform(
        F.array_distinct(F.transform("uses", lambda use: use["eq_no"])),
        lambda eq_no: F.struct(
            F.size(F.filter("uses", lambda use: use["eq_no"] == eq_no)).alias("n"),
            (F.instr("plain", F.get("eqs", eq_no)) - 1).alias("pos"),
            F.array_min(
                F.transform(
                    F.filter("uses", lambda use: use["eq_no"] == eq_no), lambda use: use["ref_no"]
                )
            ).alias("first_ref"),
            eq_no.alias("eq_no"),
        ),
    )
    return staged.withColumn("counts", counts)


def reference_counts(docs: DataFrame) -> DataFrame:
    """Number of references per equation text and document."""
    named = F.transform(
        "counts",
        lambda c: F.struct(F.get("eqs", c["eq_no"]).alias("text"), c["n"].alias("n_refs")),
    )
    found = _counted(docs).select("file", named.alias("counts"))
    return explode_rows(found, "counts", "n_th", "c", ["file"]).select("file", "c.*")


def _best(docs: DataFrame) -> DataFrame:
    """Every document with its chosen equation; ``text`` is null without math."""
    ranked = F.transform(
        "counts",
        lambda c: F.struct(
            (-c["n"]).alias("minus"),
            c["pos"].alias("pos"),
            c["first_ref"].alias("first_ref"),
            c["eq_no"].alias("eq_no"),
        ),
    )
    return compute_once(
        _counted(docs).select(*DOCUMENT_KEY, "eqs", F.array_min(ranked).alias("best")),
        "chosen",
        F.struct(
            F.get("eqs", F.coalesce("best.eq_no", F.lit(0))).alias("text"),
            (-F.col("best.minus")).alias("n_refs"),
        ),
    ).select(*DOCUMENT_KEY, "chosen.*")


def most_significant(docs: DataFrame) -> DataFrame:
    """Most referenced equation per document with math.

    Ties go to the earliest place in the comment-free text, then to the earliest
    reference; without references the first equation stands in, ``n_refs`` null.
    """
    return _best(docs).filter(F.col("text").isNotNull())


def significance_status(docs: DataFrame, bibcodes: DataFrame | None = None) -> DataFrame:
    """Outcome per document; bibcodes, when given, are joined by document name."""
    outcome = (
        F.when(F.col("text").isNull(), "no equations")
        .when(F.length("text") > P.MAX_RENDERED_LENGTH, "MSE too long")
        .when(F.col("n_refs").isNull(), "first equation")
        .otherwise(F.concat(F.col("n_refs").cast("string"), F.lit(" occurrences")))
    )
    # The outcome is settled before the join, so no equation text is shuffled.
    rows = _best(docs).select(*DOCUMENT_KEY, outcome.alias("status"))
    if bibcodes is None:
        return rows.withColumn("bibcode", F.col("doc_name"))
    status = F.when(F.col("bibcode").isNull(), "no bibcode").otherwise(F.col("status"))
    return rows.join(bibcodes, "doc_name", "left").withColumn("status", status)


def with_bibcodes(most: DataFrame, bibcodes: DataFrame) -> DataFrame:
    return most.join(bibcodes, "doc_name")


def without_bibcode(most: DataFrame, bibcodes: DataFrame) -> DataFrame:
    return most.join(bibcodes.select("doc_name"), "doc_name", "left_anti")
