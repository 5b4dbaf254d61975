import pytest
from pyspark.sql import functions as F

from texlode.functions import cleaning, equations, formats, macros

COMMENTS = [
    ("a\n% line\nb\n", "a\nb\n"),
    ("b % tail\nc", "b \nc"),
    ("c \\% d\ne", "c \\% d\ne"),
    ("e%\nf", "ef"),
    ("end % no newline", "end % no newline"),
    ("a\n% one\n% two\nb", "a\nb"),
    ("x\\begin{comment}\ny\n\\end{comment}z", "xz"),
    ("\\begin{comment}a\\begin{comment}b\\end{comment}c\\end{comment}", "c\\end{comment}"),
    ("plain", "plain"),
]


@pytest.mark.parametrize("text,expected", COMMENTS)
def test_strip_comments(one, text, expected):
    assert one(cleaning.strip_comments, text) == expected


def test_join_percent_lines_takes_escaped_signs_too(one):
    assert one(cleaning.join_percent_lines, "a\\%\nb%\nc") == "a\\bc"


def test_body_is_the_first_document(one):
    text = "x\\begin{document}a\\end{document}b\\begin{document}c\\end{document}"
    assert one(cleaning.document_body, text) == "\\begin{document}a\\end{document}"
    assert one(cleaning.document_body, "\\begin{document} no end") == ""


INLINE = [
    ("q $a$$b$ y", "q $a$ $b$ y"),
    ("q $a$$b$$c$ y", "q $a$ $b$ $c$ y"),
    ("y $$z$$ w", "y  $$z$$  w"),
    ("it costs \\$5 and \\$6 or $x$ now", "it costs \\$5 and \\$6 or $x$ now"),
    ("a \\\\$x$$y$ b", "a \\\\$x$ $y$ b"),
    ("$a$$b$ at the start", "$a$$b$ at the start"),
    ("at the end $a$$b$", "at the end $a$$b$"),
]


@pytest.mark.parametrize("text,expected", INLINE[:5])
def test_normalise_inline(one, text, expected):
    assert one(cleaning.normalise_inline, text) == expected


def test_inline_runs_need_a_neighbour_on_both_sides(one):
    assert one(cleaning.remove_inline_math, "x $a$ b $c$ d $e$") == "x  b  d $e$"
    assert one(cleaning.remove_inline_math, "x \\$5 $c$ d") == "x \\$5  d"


KINDS = [
    ("\\begin{equation*}x\\end{equation}", "equation", False),
    ("\\begin{multline}x\\end{multline*}", "multline", True),
    ("\\begin{gather}x\\end{gather}", "gather", True),
    ("\\begin{align}x\\end{align}", "align", True),
    ("\\begin{flalign*}x\\end{flalign*}", "flalign", True),
    ("\\begin{math}x\\end{math}", "dmath", False),
    ("\\begin{eqnarray}x\\end{eqnarray}", "eqnarray", True),
    ("\\[x\\]", "bracket", False),
    ("$$x$$", "dollarsign", False),
    ("$$^x$$", None, False),
    ("\\begin{align}x\\end{gather}", None, False),
    ("text", None, False),
]


@pytest.mark.parametrize("text,kind,multi", KINDS)
def test_environment(one, text, kind, multi):
    assert one(equations.environment, text) == kind
    assert one(equations.is_multiline, text) is multi
    assert one(equations.is_math, text) is (kind is not None)


def test_standard_form(one):
    text = "\\begin{align*}\\label{a}x &= 1 \\nonumber\\\\ y\\hspace{2pt}z \\times \\quad w\\end{align}"
    assert one(equations.standard_form, text) == "x = 1 \\\\ yz   w"
    assert one(equations.flat_form, text) == "x=1\\\\yzw"
    assert one(lambda t: equations.sub_equations(equations.flat_form(t)), text) == ["x=1", "yzw"]
    assert one(equations.flat_form, "no math") is None


LAYOUT = [
    ("a \\nonumberx b", "a \\nonumberx b"),
    ("a\\tag 1", "a 1"),
    ("a \\& b & c", "a \\& b  c"),
    ("\\times\\timesx", "\\timesx"),
    ("\\lefteqn{x}\\righteqn y\\qedhere", "{x} y"),
    ("\\quad\\qquad\\quadx", "x"),
    ("\\hspace{}x}y", "y"),
    ("\\label{a}b\\label{c}", "b"),
    ("\\label{\\hspace{1}x}y", "y"),
]


@pytest.mark.parametrize("text,expected", LAYOUT)
def test_remove_layout(one, text, expected):
    assert one(equations.remove_layout, text) == expected


def test_remove_layout_with_breaks(one):
    assert one(lambda t: equations.remove_layout(t, breaks=True), "a\\\\\\\\b\\\\c") == "abc"


def test_empty_lines_of_an_equation_are_kept(one):
    pieces = one(lambda t: equations.sub_equations(equations.flat_form(t)), "\\begin{align}a\\\\ \\\\\\end{align}")
    assert pieces == ["a", ""]


def test_whitespace_is_unicode(one):
    assert one(equations.remove_whitespace, "a\xa0b\x85c\u2003d\x1ce \t\n") == "abcde"


def test_break_lines(one):
    assert one(equations.break_lines, "a\\\\b\\\\\nc") == "a\\\\\nb\\\\\nc"


def test_mask(one):
    assert one(formats.mask, "a\\b\n\tc\r") == "a\\\\b\\n\\tc\\r"


def test_mask_round_trip(spark):
    texts = ["\\n", "\\\\n\n", "tab\t'q' \"d\"", "é\\t", "\\", "\\\\\\", "", "\r\n\\r"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    back = frame.select("text", formats.unmask(formats.mask("text")).alias("back")).collect()
    assert all(row.text == row.back for row in back)


def test_names(one):
    assert one(formats.document_name, "file:/a/b/paper.v1.tex") == "paper.v1"
    assert one(formats.document_name, "plain") == "plain"
    assert one(formats.folder_name, "file:/a/b/paper.tex") == "b"


def test_package_names_keep_commented_ones(one):
    text = "\\usepackage[a]{x, y}\n%\\usepackage{z}\n\\usepackage{}"
    assert one(formats.package_names, text) == ["x", "y", "z", ""]


def test_counts_to_string(spark):
    frame = spark.createDataFrame([({"b": 2, "a": 1},)], "m map<string,bigint>")
    assert frame.select(formats.counts_to_string("m")).first()[0] == "a:1,b:2"


def test_css_links(one):
    text = '<link href="../css/LaTeXML.css"/>\n<link href="a/b/ltx-article.css"/>'
    assert one(formats.shorten_css_links, text) == '<link href="LaTeXML.css"/>\n<link href="ltx-article.css"/>'


def test_legacy_count_counts_overlaps(one):
    # One equation, one bracket, and the dollars once as a pair, twice as single ones.
    text = "a \\begin{equation}x\\end{equation} \\[y\\] $$z$$ % $no$\n"
    assert one(cleaning.legacy_equation_count, text) == 5


def test_strip_latex(one):
    text = (
        "\\section*{Intro} See \\textbf{bold} \\cite[p. 1]{a}[x] ().\n\\def\\x{1}\n"
        "\\begin{picture}a\nb\\end{picture}$$q$$\n\n\n\nend é"
    )
    out = one(lambda t: cleaning.strip_latex(t, F.array(F.lit("$$q$$"))), text)
    assert out == "Intro See   .end é"


UNWRAP = [
    ("{\\begin{align}}x{ \\end{align} }", "\\begin{align}x\\end{align}"),
    ("{{{$$}}}y{$}", "$$y$"),
    ("{\\[}z{\\]}", "\\[z\\]"),
    ("\\{$}", "\\{$}"),
    ("{\\alpha}", "{\\alpha}"),
]


@pytest.mark.parametrize("text,expected", UNWRAP)
def test_unwrap_delimiters(one, text, expected):
    assert one(macros.unwrap_delimiters, text) == expected


def test_unwrap_definitions(one):
    assert one(macros.unwrap_definitions, "{{\\newcommand*}}{\\def}") == "\\newcommand*\\def"


@pytest.mark.parametrize("text,left", [("{a{b}", 1), ("}}{", 1), ("{}", 0), ("", 0), ("}{}", 0)])
def test_unmatched_openings(one, text, left):
    assert one(lambda t: macros.unmatched_openings(t, "{", "}"), text) == left


def test_decode_latin1(spark):
    frame = spark.createDataFrame([(bytearray(b"a\r\nb\rc\xe9\x85\n"),)], "content binary")
    assert frame.select(cleaning.decode_latin1("content")).first()[0] == "a\nb\nc\xe9\x85\n"


def test_long_texts_do_not_deepen_the_stack(one):
    many = "x " + "$a$" * 20_000 + " y"
    out = one(cleaning.normalise_inline, many)
    assert out == "x " + " ".join(["$a$"] * 20_000) + " y"
    braces = "\\cmd" + "{a}" * 20_000 + " end"
    assert one(lambda t: cleaning.strip_latex(t, F.array().cast("array<string>")), braces) == "end"
    long_equation = "\\begin{equation}" + "x + {y} " * 250_000 + "\\end{equation}"
    assert one(lambda t: F.length(equations.flat_form(t)), long_equation) == 250_000 * 5
