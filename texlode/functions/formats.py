"""One-line storage formats and path functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texlode.functions import patterns as P
from texlode.functions.columns import col, sub, swap


def mask(text: Column | str) -> Column:
    """One-line form of a text: backslash, newline, tab and CR are escaped."""
    out = swap(col(text), "\\", "\\\\")
    out = swap(out, "\n", "\\n")
    out = swap(out, "\t", "\\t")
    return swap(out, "\r", "\\r")


def unmask(masked: Column | str) -> Column:
    out = swap(col(masked), "\\\\", P.PARKED_BACKSLASHES)
    out = swap(out, "\\n", "\n")
    out = swap(out, "\\t", "\t")
    out = swap(out, "\\r", "\r")
    return swap(out, P.PARKED_BACKSLASHES, "\\")


def counts_to_string(counts: Column | str) -> Column:
    """Map of counts as ``k1:c1,k2:c2``, ordered by key."""
    entries = F.array_sort(F.map_entries(col(counts)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))),
        ",",
    )


def shorten_css_links(xhtml: Column | str) -> Column:
    """Drops the folder of the two converter style sheets from their links."""
    return sub(sub(col(xhtml), P.CSS_LATEXML, "$1$2"), P.CSS_ARTICLE, "$1$2")


def document_name(path: Column | str) -> Column:
    """Base name of a path without its last extension."""
    return F.regexp_extract(col(path), r"([^/]+?)(?:\.[^./]*)?$", 1)


def folder_name(path: Column | str) -> Column:
    """Name of the folder that holds a path, '' for a bare file name."""
    return F.regexp_extract(col(path), r"([^/]+)/[^/]*$", 1)


def package_names(text: Column | str) -> Column:
    """Names listed in ``\\usepackage``; the text may still hold comments."""
    lists = F.regexp_extract_all(col(text), F.lit(P.PACKAGE_NAMES), F.lit(1))
    names = F.flatten(F.transform(lists, lambda one: F.split(one, ",", -1)))
    return F.transform(names, lambda name: F.btrim(name, F.lit(P.WHITESPACE)))
