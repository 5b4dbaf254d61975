"""Functions of a single equation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texlode.functions import patterns as P
from texlode.functions.columns import col, find_all, let, sub


def environment(equation: Column | str) -> Column:
    """Kind of display math, null for anything else."""

    def kind(e: Column) -> Column:
        name = F.regexp_extract(e, P.STARTS_ENVIRONMENT, 1)
        return let(
            name,
            lambda n: F.when(n == "math", F.lit("dmath"))
            .when(n != "", n)
            .when(e.rlike(P.STARTS_BRACKET), F.lit("bracket"))
            .when(e.rlike(P.STARTS_DOLLARS), F.lit("dollarsign")),
        )

    return let(col(equation), kind)


def is_math(equation: Column | str) -> Column:
    return col(equation).rlike(P.DISPLAY_PARTS)


def is_multiline(equation: Column | str) -> Column:
    return col(equation).rlike(P.STARTS_MULTILINE)


def remove_layout(text: Column | str, breaks: bool = False) -> Column:
    out = col(text)
    for pattern in P.LAYOUT:
        out = sub(out, pattern)
    return sub(out, P.LINE_BREAKS) if breaks else out


def has_layout(text: Column | str) -> Column:
    return col(text).rlike(P.ANY_LAYOUT)


def remove_whitespace(text: Column | str) -> Column:
    return F.translate(col(text), P.WHITESPACE, "")


def standard_form(equation: Column | str) -> Column:
    """Math between the delimiters without layout; null when not display math."""
    inner = let(
        col(equation),
        lambda e: F.when(e.rlike(P.DISPLAY_PARTS), sub(e, P.DISPLAY_PARTS, "$2$3$4")),
    )
    return remove_layout(inner)


def flat_form(equation: Column | str) -> Column:
    """The key under which equal equations meet: standard form, no whitespace."""
    return remove_whitespace(standard_form(equation))


def sub_equations(flat: Column | str) -> Column:
    """Pieces of a flat multi-line equation between line breaks, empty ones kept."""
    pieces = F.split(col(flat), P.LINE_BREAKS, -1)
    return F.transform(pieces, lambda piece: remove_whitespace(remove_layout(piece, breaks=True)))


def break_lines(text: Column | str) -> Column:
    """Ensures a newline after each LaTeX line break."""
    return sub(col(text), P.LINE_BREAK_OPEN, "\\\\\\\\\n")


def as_equation(inner: Column | str) -> Column:
    return F.concat(F.lit("\\begin{equation}"), col(inner), F.lit("\\end{equation}"))


def labels(equation: Column | str) -> Column:
    return find_all(col(equation), P.LABEL, 1)
