"""Document-level text functions: comments, body, inline math, prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texlode.functions import patterns as P
from texlode.functions.columns import col, find_all, fold_replace, let, sub, sub_if, swap


def unify_newlines(text: Column | str) -> Column:
    """CR LF and lone CR become LF, as on opening a file in text mode."""
    return sub_if(col(text), "\r", r"\r\n?", "\n")


def decode_latin1(content: Column | str) -> Column:
    return unify_newlines(F.decode(col(content), "ISO-8859-1"))


def strip_comments(text: Column | str) -> Column:
    """Comment lines, comment-joined lines, trailing comments, comment environments."""

    without = let(
        col(text), lambda t: F.when(F.contains(t, F.lit("%")), _without_percents(t)).otherwise(t)
    )
    return drop_comment_environments(without)


def _without_percents(text: Column) -> Column:
    """Comment lines fall out, a line that ends in a percent sign meets the next, trailing comments end at the newline.

    Each step is settled line by line, so that no regex passes over whole texts.
    What follows the last newline holds no comment that ends.
    """

    def whole_lines(lines: Column) -> Column:
        def kept(line: Column, n: Column) -> Column:
            comment = F.startswith(line, F.lit("%")) & (line != "%")
            return ~(comment & (n > 0) & (n < F.size(lines) - 1))

        return F.filter(lines, kept)

    def joined(lines: Column) -> Column:
        def ended(line: Column, n: Column) -> Column:
            open_end = F.endswith(line, F.lit("%")) & ~F.endswith(line, F.lit("\\%"))
            return (
                F.when(n == F.size(lines) - 1, line)
                .when(open_end, F.substring(line, F.lit(1), F.length(line) - 1))
                .otherwise(F.concat(line, F.lit("\n")))
            )

        return F.array_join(F.transform(lines, ended), "")

    def cut(lines: Column) -> Column:
        def before_percent(line: Column, n: Column) -> Column:
            return (
                F.when(~F.contains(line, F.lit("%")) | (n == F.size(lines) - 1), line)
                .when(F.contains(line, F.lit("\\%")), sub(line, P.COMMENT_TAIL))
                .otherwise(F.substring_index(line, "%", 1))
            )

        return F.array_join(F.transform(lines, before_percent), "\n")

    def split(t: Column) -> Column:
        return F.split(t, "\n", -1)

    return let(split(let(let(split(text), whole_lines), joined)), cut)


def drop_comment_environments(text: Column | str) -> Column:
    return sub_if(col(text), "\\begin{comment}", P.COMMENT_ENVIRONMENT)


def join_percent_lines(text: Column | str) -> Column:
    """Removes every percent sign that ends a line, escaped or not."""
    return swap(col(text), "%\n", "")


def body_of(uncommented: Column | str) -> Column:
    """First document body of a comment-free text, '' when there is none."""

    def framed(t: Column) -> Column:
        # Both marks are fixed strings, which a split seeks far faster than a regex that reaches from one to the other.
        after = F.get(F.split(t, P.BODY_BEGIN, 2), F.lit(1))
        return let(
            F.split(after, P.BODY_END, 2),
            lambda parts: F.when(
                F.size(parts) == 2,
                F.concat(F.lit("\\begin{document}"), F.get(parts, F.lit(0)), F.lit("\\end{document}")),
            ).when(t.isNotNull(), ""),
        )

    return let(col(uncommented), framed)


def document_body(text: Column | str) -> Column:
    return body_of(strip_comments(text))


def park_dollars(text: Column | str) -> Column:
    """Escaped dollars give way to one reserved character.

    Pairs of backslashes are parked first, which settles from left to right
    whether the backslash before a dollar escapes it.  A dollar after one
    backslash alone needs no such step.
    """

    def park(t: Column) -> Column:
        t = swap(t, "\\\\", P.PARKED_BACKSLASHES)
        t = swap(t, "\\$", P.PARKED_DOLLAR)
        return swap(t, P.PARKED_BACKSLASHES, "\\\\")

    return let(
        col(text),
        lambda t: F.when(F.contains(t, F.lit("\\\\$")), park(t)).otherwise(swap(t, "\\$", P.PARKED_DOLLAR)),
    )


def unpark_dollars(text: Column | str) -> Column:
    return swap(col(text), P.PARKED_DOLLAR, "\\$")


def remove_inline_math(text: Column | str) -> Column:
    """Text without inline math; an escaped dollar is no delimiter."""
    return unpark_dollars(sub_if(park_dollars(text), "$", P.INLINE_RUN))


def separate_inline(parked: Column | str) -> Column:
    """Puts a blank between adjacent ``$a$$b$`` and around each ``$$..$$``."""

    def in_turn(t: Column, runs: Column) -> Column:
        return fold_replace(t, runs, lambda run: swap(run, "$$", "$ $"))

    def apart(t: Column, runs: Column) -> Column:
        """Pieces between the double dollars that are left when those within runs have a blank."""
        folded = swap(in_turn(t, runs), "$$", P.PARKED_DOUBLE_DOLLAR)
        settled = let(
            _separated(t, runs),
            lambda done: F.when(F.contains(done, F.lit(P.UNSETTLED)), folded).otherwise(done),
        )
        one_pass = (F.size(runs) > FEW_RUNS) & F.forall(runs, lambda run: F.size(F.split(run, r"\$", -1)) == 5)
        return F.split(F.when(one_pass, settled).otherwise(folded), P.PARKED_DOUBLE_DOLLAR, -1)

    def work(t: Column, runs: Column) -> Column:
        tangled = F.contains(t, F.lit("$$$")) | F.contains(t, F.lit("$$^"))
        return F.when(tangled, sub(in_turn(t, runs), P.DOUBLE_DOLLAR, " $1 ")).otherwise(
            let(apart(t, runs), _with_blanks)
        )

    def doubled(t: Column) -> Column:
        return F.array_distinct(F.filter(inline_runs(t), lambda run: F.contains(run, F.lit("$$"))))

    return let(
        col(parked),
        lambda t: F.when(F.contains(t, F.lit("$$")), let(doubled(t), lambda runs: work(t, runs))).otherwise(t),
    )


# So few replacements over a text cost less than a look at each of its double dollars.
FEW_RUNS = 2


def inline_runs(parked: Column | str) -> Column:
    """Runs of inline math of a text with parked dollars."""
    return F.filter(find_all(col(parked), P.NEXT_INLINE_RUN, 1), lambda run: run != "")


def _with_blanks(pieces: Column) -> Column:
    """Puts the double dollars back between the pieces, with blanks around each second piece that they enclose."""
    return F.array_join(
        F.transform(
            pieces,
            lambda x, n: F.when(n % 2 == 0, x)
            .when(n < F.size(pieces) - 1, F.concat(F.lit(" $$"), x, F.lit("$$ ")))
            .otherwise(F.concat(F.lit("$$"), x)),
        ),
        "",
    )


def _separated(text: Column, runs: Column) -> Column:
    """Replaces ``$a$$b$`` by ``$a$ $b$`` wherever it is one of ``runs``, in one pass over a text without ``$$$``.

    Whether it is depends on the last and first part, between dollars, of the
    pieces on both sides of ``$$``.  Where such a piece is itself enclosed in
    ``$$`` on both sides, or two equal runs share a dollar, the order of the
    replacements matters: the result then holds the sign ``UNSETTLED``.  Other
    double dollars stay parked.
    """

    def run_at(pieces: Column, n: Column) -> Column:
        a, b = F.substring_index(F.get(pieces, n), "$", -1), F.substring_index(F.get(pieces, n + 1), "$", 1)
        return F.concat(F.lit("$"), a, F.lit("$$"), b, F.lit("$"))

    def filled(pieces: Column) -> Column:
        def settled(run: Column, left: Column, right: Column, n: Column) -> Column:
            shares = (F.substring_index(right, "$", 2) == right) & (n < F.size(pieces) - 2)
            return (
                F.contains(left, F.lit("$"))
                & F.contains(right, F.lit("$"))
                & ~(shares & (run_at(pieces, n + 1) == run))
            )

        def ended(left: Column, n: Column) -> Column:
            right = F.get(pieces, n + 1)
            sign = let(
                run_at(pieces, n),
                lambda run: F.when(~F.array_contains(runs, run), P.PARKED_DOUBLE_DOLLAR)
                .when(settled(run, left, right, n), "$ $")
                .otherwise(P.UNSETTLED),
            )
            return F.when(n == F.size(pieces) - 1, left).otherwise(F.concat(left, sign))

        return F.array_join(F.transform(pieces, ended), "")

    return let(F.split(swap(text, "$$", P.PARKED_DOUBLE_DOLLAR), P.PARKED_DOUBLE_DOLLAR, -1), filled)


def normalise_inline_parked(uncommented: Column | str) -> Column:
    """Normalised inline math of a comment-free text, escaped dollars parked."""
    return separate_inline(park_dollars(drop_comment_environments(uncommented)))


def normalise_inline(text: Column | str) -> Column:
    return unpark_dollars(normalise_inline_parked(strip_comments(text)))


def package_statements(text: Column | str, across_lines: bool = False) -> Column:
    return find_all(col(text), P.USE_PACKAGE_ANY_LINE if across_lines else P.USE_PACKAGE_ONE_LINE)


def document_class(text: Column | str) -> Column:
    """The class statement with the class replaced by ``article``, default if absent."""
    found = F.regexp_extract(col(text), P.DOCUMENT_CLASS, 0)
    return let(
        found,
        lambda c: F.when(c == "", F.lit("\\documentclass{article}")).otherwise(
            sub(c, r"\{[^\n]*?\}", "{article}")
        ),
    )


def remove_display(text: Column | str, equations: Column | str) -> Column:
    """Takes each of a text's distinct display equations out in turn, literally and everywhere.

    A text with many equations is cut at a sign that stands in none of them, as
    no equation reaches across it.  Each piece loses its own equations in one
    pass, where ``_settled`` says that this is all that can be found in it;
    otherwise it is cut at the next sign, and at last loses all equations in turn.
    """

    def cut(t: Column, eqs: Column, signs: Column, turn: int) -> Column:
        in_turn = fold_replace(t, eqs, lambda _: F.lit(""))
        if turn > CUTS:
            return in_turn

        def piece(x: Column) -> Column:
            return F.when(~x.rlike(P.DISPLAY_EDGE), x).otherwise(
                let(
                    sub(x, P.DISPLAY_MATH),
                    lambda bare: F.when(_settled(x, bare, eqs), bare).otherwise(cut(x, eqs, signs, turn + 1)),
                )
            )

        sign = F.substring(signs, turn, 1)
        pieces = F.transform(F.split(t, F.concat(F.lit("["), sign, F.lit("]")), -1), piece)
        return F.when(sign != "", F.call_function("array_join", pieces, sign)).otherwise(in_turn)

    def whole(both: Column) -> Column:
        t, eqs = both["text"], both["eqs"]
        free = F.call_function("translate", F.lit(P.SELDOM_IN_MATH), F.array_join(eqs, ""), F.lit(""))
        many = F.size(eqs) > FEW_EQUATIONS
        # A text with few equations is not cut at all.
        return let(F.when(many, free).otherwise(""), lambda signs: cut(t, eqs, signs, 1))

    return let(F.struct(col(text).alias("text"), F.array_distinct(col(equations)).alias("eqs")), whole)


# So many replacements cost less than a cut; a piece is cut again at the next sign, so often in all.
FEW_EQUATIONS = 16
CUTS = 3


def _settled(piece: Column, bare: Column, equations: Column) -> Column:
    """Whether ``bare``, a piece without its display math, is what the removal of the equations in turn leaves.

    An equation begins where its kind opens and ends at the first end of that
    kind.  So nothing else can be found, at no turn, when what is taken out are
    equations, when nothing opens within them, when no more than one is in
    dollars, and when nothing that is left, or meets, opens or ends an equation.
    """
    found = find_all(piece, P.DISPLAY_MATH)
    # A bracket opens nothing without one that ends it, as after a line break.
    brackets = F.when(F.contains(piece, F.lit("\\]")), F.regexp_count(piece, F.lit(r"\\\["))).otherwise(0)
    opened = F.regexp_count(piece, F.lit(r"\\begin\{")) + brackets
    in_dollars = F.size(F.filter(found, lambda m: F.startswith(m, F.lit("$$"))))
    return (
        ~bare.rlike(P.DISPLAY_EDGE)
        & (~piece.rlike(P.DOLLAR_PAIRS) | (piece.rlike(P.ONE_DOLLAR_DISPLAY) & (in_dollars == 1)))
        & (opened + in_dollars == F.size(found))
        & F.forall(found, lambda m: F.array_contains(equations, m))
    )


def strip_latex(text: Column | str, equations: Column | str) -> Column:
    """Prose of a document: display math and commands removed."""
    plain = remove_display(text, equations)
    for pattern, replacement in P.STRIP_STEPS:
        plain = sub(plain, pattern, replacement)
    return F.btrim(plain, F.lit(P.WHITESPACE))


def collapse_newlines(text: Column | str) -> Column:
    return sub(col(text), r"\n{3,}", "\n\n")


def references(uncommented: Column | str) -> Column:
    """Trimmed keys of all ``\\eqref``, then of all ``\\ref``."""
    keys = F.concat(find_all(col(uncommented), P.EQREF, 1), find_all(col(uncommented), P.REF, 1))
    return F.transform(keys, lambda key: F.btrim(key, F.lit(P.WHITESPACE)))


def legacy_equation_count(text: Column | str) -> Column:
    """Sum of ten separate pattern counts; overlapping patterns count twice."""
    plain = sub(col(text), P.LEGACY_COMMENT_LINE)
    plain = sub(plain, P.LEGACY_COMMENT_TAIL, "$1")
    plain = sub(plain, P.LEGACY_COMMENT_ENVIRONMENT)

    def total(t: Column) -> Column:
        counts = [F.regexp_count(t, F.lit(pattern)) for pattern in P.LEGACY_MATH]
        return sum(counts[1:], counts[0])

    return let(plain, total)
