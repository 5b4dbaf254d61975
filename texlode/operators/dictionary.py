"""Corpus-wide dictionaries of distinct equations and their use in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.functions import cleaning, equations
from texlode.functions import patterns as P
from texlode.functions.columns import find_all, let
from texlode.operators.extract import (
    DOCUMENT_KEY,
    display_array,
    text_array,
    with_clean_body,
)
from texlode.plans.physical import dense_ids, explode_rows, lookup

# Opening letters of the three kinds of equation id.
SINGLE_PREFIX = "EQDS"
MULTI_PREFIX = "EQDM"
INLINE_PREFIX = "EQIX"


def _eqid(prefix: str, number: str):
    return F.concat(F.lit(prefix), F.col(number).cast("string"), F.lit("Q"))


def keyed_pieces(classified: DataFrame) -> DataFrame:
    """Single equations and the lines of multi-line ones, each under its key.

    ``std`` is null where the stored form is the key itself, so that it does not
    travel twice.
    """
    lines = F.transform(
        equations.sub_equations("flat_eq"),
        lambda line: F.struct(line.alias("eq_key"), F.lit(None).cast("string").alias("std")),
    )
    single = F.array(
        F.struct(
            F.col("flat_eq").alias("eq_key"),
            F.when(F.col("std_eq") != F.col("flat_eq"), F.col("std_eq")).alias("std"),
        )
    )
    pieces = classified.select(
        "file", "eq_no", F.when(F.col("is_multiline"), lines).otherwise(single).alias("pieces")
    )
    return explode_rows(pieces, "pieces", "sub_no", "piece", ["file", "eq_no"]).select(
        "file", "eq_no", "sub_no", "piece.*"
    )


def distinct_pieces(pieces: DataFrame) -> DataFrame:
    """One row per key; the first occurrence in the corpus supplies the stored text."""
    grouped = pieces.groupBy("eq_key").agg(
        F.min(F.struct("file", "eq_no", "sub_no", "std")).alias("first"),
        F.count(F.lit(1)).alias("n_occurrences"),
    )
    return grouped.select("eq_key", "first.*", "n_occurrences")


def _stored(df: DataFrame):
    return equations.as_equation(F.coalesce(df["std"], df["eq_key"]))


def equation_dictionary(classified: DataFrame) -> DataFrame:
    """``(eqid, eq_key, eq_text, n_occurrences)``, numbered by first occurrence."""
    distinct = distinct_pieces(keyed_pieces(classified))
    numbered = dense_ids(distinct, ["file", "eq_no", "sub_no", "eq_key"], "eq_number")
    return numbered.select(
        _eqid(SINGLE_PREFIX, "eq_number").alias("eqid"),
        "eq_key",
        _stored(numbered).alias("eq_text"),
        "n_occurrences",
        "eq_number",
    )


def distinct_multiline(classified: DataFrame) -> DataFrame:
    """One row per multi-line equation; its first occurrence supplies the lines."""
    return (
        classified.filter(F.col("is_multiline"))
        .groupBy(F.col("text").alias("eq_text"))
        .agg(
            F.min(F.struct("file", "eq_no", "flat_eq")).alias("first"),
            F.count(F.lit(1)).alias("n_occurrences"),
        )
        .select("eq_text", "first.*", "n_occurrences")
    )


def _with_line_ids(numbered: DataFrame, eq_dict: DataFrame, hits: str | None) -> DataFrame:
    """Adds ``sub_ids``, the ids of an equation's lines in order, to rows that have an ``eq_number``."""
    lines = explode_rows(
        numbered.select("eq_number", equations.sub_equations("flat_eq").alias("lines")),
        "lines", "sub_no", "eq_key", ["eq_number"],
    )
    found = lookup(lines, eq_dict.select("eq_key", "eqid", *([hits] if hits else [])), "eq_key", hits)
    ids = found.groupBy("eq_number").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("sub_no", "eqid"))), lambda pair: pair["eqid"]
        ).alias("sub_ids")
    )
    return numbered.join(ids, "eq_number")


def multiline_dictionary(classified: DataFrame, eq_dict: DataFrame) -> DataFrame:
    """``(eqid, sub_ids, eq_text, n_occurrences)``: distinct multi-line equations, ids of their lines in order."""
    numbered = dense_ids(distinct_multiline(classified), ["file", "eq_no"], "eq_number")
    return _with_line_ids(numbered, eq_dict, "n_occurrences").select(
        _eqid(MULTI_PREFIX, "eq_number").alias("eqid"), "sub_ids", "eq_text", "n_occurrences", "eq_number"
    )


def distinct_inline(inline: DataFrame) -> DataFrame:
    """One row per inline equation with its first occurrence."""
    return (
        inline.groupBy(F.col("text").alias("eq_text"))
        .agg(
            F.min(F.struct("file", "eq_no")).alias("first"),
            F.count(F.lit(1)).alias("n_occurrences"),
        )
        .select("eq_text", "first.*", "n_occurrences")
    )


def inline_dictionary(inline: DataFrame) -> DataFrame:
    """``(eqid, eq_text, n_occurrences)``: distinct inline equations, numbered by first occurrence."""
    numbered = dense_ids(distinct_inline(inline), ["file", "eq_no"], "eq_number")
    return numbered.select(
        _eqid(INLINE_PREFIX, "eq_number").alias("eqid"), "eq_text", "n_occurrences", "eq_number"
    )


def _numbered_after(distinct: DataFrame, prior: DataFrame, key: str, order: list[str], start: int | None) -> DataFrame:
    """The rows of ``distinct`` whose key an earlier dictionary lacks, numbered from ``start`` on.

    Without a ``start``, from the earlier dictionary's highest number on.  ``prior``
    may be a part of it that holds all keys in question, if ``start`` is given.
    """
    fresh = distinct.join(prior.select(key), key, "left_anti")
    if start is None:
        start = prior.agg(F.coalesce(F.max("eq_number") + 1, F.lit(0))).scalar()
    else:
        start = F.lit(start)
    return dense_ids(fresh, order, "place").withColumn("eq_number", start + F.col("place"))


def new_equations(classified: DataFrame, prior: DataFrame, start: int | None = None) -> DataFrame:
    """Rows ``(eqid, eq_key, eq_text, eq_number)`` that an earlier dictionary of single equations lacks."""
    return added_equations(distinct_pieces(keyed_pieces(classified)), prior, start)


def added_equations(distinct: DataFrame, prior: DataFrame, start: int | None = None) -> DataFrame:
    """The same from the rows of ``distinct_pieces``."""
    added = _numbered_after(distinct, prior, "eq_key", ["file", "eq_no", "sub_no", "eq_key"], start)
    return added.select(
        _eqid(SINGLE_PREFIX, "eq_number").alias("eqid"), "eq_key", _stored(added).alias("eq_text"), "eq_number"
    )


def new_inline(inline: DataFrame, prior: DataFrame, start: int | None = None) -> DataFrame:
    """Rows ``(eqid, eq_text, eq_number)`` that an earlier dictionary of inline equations lacks."""
    added = _numbered_after(distinct_inline(inline), prior, "eq_text", ["file", "eq_no"], start)
    return added.select(_eqid(INLINE_PREFIX, "eq_number").alias("eqid"), "eq_text", "eq_number")


def new_multiline(
    classified: DataFrame, eq_dict: DataFrame, prior: DataFrame, start: int | None = None
) -> DataFrame:
    """Rows ``(eqid, sub_ids, eq_text, eq_number)`` that an earlier dictionary of multi-line equations lacks.

    ``eq_dict`` has all single equations, those of the new lines, too.
    """
    return added_multiline(distinct_multiline(classified), eq_dict, prior, start)


def added_multiline(distinct: DataFrame, eq_dict: DataFrame, prior: DataFrame, start: int | None = None) -> DataFrame:
    """The same from the rows of ``distinct_multiline``."""
    added = _numbered_after(distinct, prior, "eq_text", ["file", "eq_no"], start)
    return _with_line_ids(added, eq_dict, None).select(
        _eqid(MULTI_PREFIX, "eq_number").alias("eqid"), "sub_ids", "eq_text", "eq_number"
    )


def _extended(prior: DataFrame, added: DataFrame) -> DataFrame:
    kept = prior.select(*added.columns, F.lit(False).alias("is_new"))
    return kept.unionByName(added.withColumn("is_new", F.lit(True)))


def extend_dictionary(classified: DataFrame, prior: DataFrame) -> DataFrame:
    """Adds new equations to an earlier dictionary, whose ids stay as they are.

    Only keys the earlier dictionary lacks are numbered, from its highest number on.
    """
    return _extended(prior, new_equations(classified, prior))


def extend_inline_dictionary(inline: DataFrame, prior: DataFrame) -> DataFrame:
    """Adds new inline equations to an earlier dictionary, whose ids stay as they are."""
    return _extended(prior, new_inline(inline, prior))


def extend_multiline_dictionary(classified: DataFrame, eq_dict: DataFrame, prior: DataFrame) -> DataFrame:
    """Adds new multi-line equations to an earlier dictionary; ``eq_dict`` is the extended one of single equations."""
    return _extended(prior, new_multiline(classified, eq_dict, prior))


def assign_ids(
    classified: DataFrame, eq_dict: DataFrame, meq_dict: DataFrame, complete: bool = True
) -> DataFrame:
    """Each equation with its id: by flat key first, then multi-line by raw text.

    ``complete``: the dictionaries come from these equations, and their counts hold.
    """
    hits = "n_occurrences" if complete else None
    eq_dict, meq_dict = (d if complete else d.drop("n_occurrences") for d in (eq_dict, meq_dict))
    counted = ["n_occurrences"] if complete else []
    facts = classified.withColumnRenamed("flat_eq", "eq_key")
    by_key = lookup(
        facts, eq_dict.select("eq_key", "eqid", *counted), "eq_key", hits
    )
    open_text = F.when(F.col("eqid").isNull(), F.col("text"))
    by_text = lookup(
        by_key.withColumn("eq_text", open_text),
        meq_dict.select("eq_text", F.col("eqid").alias("meqid"), *counted),
        "eq_text",
        hits,
    )
    return by_text.withColumn("eqid", F.coalesce("eqid", "meqid")).drop("eq_text", "meqid")


def enumerated_documents(
    docs: DataFrame, classified: DataFrame, eq_dict: DataFrame, meq_dict: DataFrame
) -> DataFrame:
    """Documents with each display equation replaced by its id.

    Only equation keys travel to the dictionary; the document text is shuffled
    once, by file, to take its ids.
    """
    # Equations are numbered from 0 without gaps, so the n-th id is that of equation n.
    known = (
        assign_ids(classified.select("file", "eq_no", "text", "flat_eq"), eq_dict, meq_dict)
        .groupBy("file")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("eq_no", "eqid"))), lambda pair: pair["eqid"]
            ).alias("ids")
        )
    )
    whole = (
        docs.withColumn("plain", cleaning.strip_comments("text"))
        .withColumn("whole", cleaning.normalise_inline_parked("plain"))
        .withColumn("clean", cleaning.body_of("whole"))
    )
    start = F.instr("whole", F.col("clean"))
    cut = whole.select(
        *DOCUMENT_KEY,
        F.when(F.col("clean") == "", cleaning.unpark_dollars("whole"))
        .otherwise(cleaning.unpark_dollars(F.substring("whole", F.lit(1), start - 1)))
        .alias("head"),
        F.when(F.col("clean") == "", "")
        .otherwise(
            cleaning.unpark_dollars(
                F.substring("whole", start + F.length("clean"), F.length("whole"))
            )
        )
        .alias("tail"),
        text_array().alias("parts"),
        display_array().alias("eqs"),
    )
    filled = cut.join(known, "file", "left")
    middle = F.transform(
        "parts",
        lambda part, n: F.concat(
            part,
            F.coalesce(F.get("ids", n), F.get("eqs", n), F.lit("")),
        ),
    )
    return filled.select(
        *DOCUMENT_KEY,
        F.concat("head", F.array_join(middle, ""), "tail").alias("text"),
        F.coalesce(F.array_size(F.array_compact("ids")), F.lit(0)).alias("n_replaced"),
    )


def unmatched_equations(
    classified: DataFrame, eq_dict: DataFrame, meq_dict: DataFrame
) -> DataFrame:
    """Equations without an id; ``Multiline`` when any layout stands in them."""
    open_rows = assign_ids(classified, eq_dict, meq_dict, complete=False).filter(
        F.col("eqid").isNull()
    )
    return open_rows.select(
        *DOCUMENT_KEY,
        "eq_no",
        F.when(equations.has_layout("text"), "Multiline").otherwise("Single line").alias("reason"),
        "text",
    )


def enumerated_inline_documents(
    docs: DataFrame, inline: DataFrame, inline_dict: DataFrame
) -> DataFrame:
    """Bodies with each inline equation replaced by its id; documents without any are left out.

    Inline math that spans lines has no id and falls out of the text.
    """
    facts = inline.select("file", "eq_no", F.col("text").alias("eq_text"))
    known = (
        lookup(facts, inline_dict.select("eq_text", "eqid", "n_occurrences"), "eq_text", "n_occurrences")
        .groupBy("file")
        .agg(F.transform(
            F.array_sort(F.collect_list(F.struct("eq_no", "eqid"))), lambda pair: pair["eqid"]
        ).alias("ids"))
    )
    cut = with_clean_body(docs).select(
        *DOCUMENT_KEY,
        F.transform(F.split("clean", P.INLINE_RUN, -1), cleaning.unpark_dollars).alias("parts"),
        F.transform(
            find_all(F.col("clean"), P.INLINE_RUN, 1),
            lambda run: F.size(find_all(run, P.INLINE_ONE)),
        ).alias("sizes"),
    )
    filled = cut.join(known, "file")
    # Run n takes the ids from the sum of the earlier runs' sizes on.
    starts = F.aggregate(
        "sizes",
        F.array(F.lit(0)),
        lambda sums, size: F.concat(sums, F.array(F.element_at(sums, -1) + size)),
    )
    middle = let(
        starts,
        lambda firsts: F.transform(
            "parts",
            lambda part, n: F.concat(
                part,
                F.coalesce(
                    F.array_join(F.slice("ids", F.get(firsts, n) + 1, F.get("sizes", n)), ""),
                    F.lit(""),
                ),
            ),
        ),
    )
    return filled.select(
        *DOCUMENT_KEY, F.array_join(middle, "").alias("text"), F.size("ids").alias("n_replaced")
    )


def dictionary_totals(eq_dict: DataFrame, meq_dict: DataFrame, inline_dict: DataFrame) -> DataFrame:
    kinds = (("single", eq_dict), ("multi", meq_dict), ("inline", inline_dict))
    parts = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        for kind, frame in kinds
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
