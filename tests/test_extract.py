import random
import time

from pyspark.sql import functions as F

from conftest import body
from texlode.functions import cleaning
from texlode.functions.columns import fold_replace
from texlode.operators import extract as X


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy("file", *[c for c in columns if c in ("eq_no", "ord")]).collect()]


def test_display_equations_in_reading_order(docs_of):
    text = body("a \\[x\\] b \\\\[2pt] $$y$$ \\begin{align*}z\\end{align} \\begin{equation}w\\end{equation}")
    found = rows(X.display_equations(docs_of(text)), "eq_no", "text")
    assert found == [
        (0, "\\[x\\]"), (1, "$$y$$"), (2, "\\begin{align*}z\\end{align}"),
        (3, "\\begin{equation}w\\end{equation}"),
    ]


def test_only_the_body_counts(docs_of):
    docs = docs_of("$$a$$" + body("$$b$$") + "$$c$$", "\\begin{document}$$d$$", "no tex")
    assert rows(X.display_equations(docs), "file", "text") == [("d/000.tex", "$$b$$")]
    assert rows(X.math_documents(docs), "file", "n_display") == [("d/000.tex", 1)]


def test_escaped_dollars_do_not_open_math(docs_of):
    docs = docs_of(body("cost \\$5 $$y\\$$$ and \\$6 $i$ x"))
    assert rows(X.display_equations(docs), "text") == [("$$y\\$$$",)]
    assert rows(X.inline_equations(docs), "text") == [("$i$",)]


def test_segments_join_to_the_cleaned_body(docs_of):
    text = body("a % note\n$p$$q$ $$x$$ mid \\[y\\]end")
    docs = docs_of(text)
    parts = rows(X.segments(docs), "ord", "kind", "text")
    assert [p[1] for p in parts] == ["text", "equation", "text", "equation", "text"]
    cleaned = docs.select(cleaning.unpark_dollars(cleaning.normalise_inline_parked(
        cleaning.document_body("text")))).first()[0]
    assert "".join(p[2] for p in parts) == cleaned
    assert X.segment_equations(X.segments(docs)).count() == 2


def test_context_is_that_of_the_own_place(docs_of):
    docs = docs_of(body("a\\[x\\]b\\[x\\]c"))
    found = rows(X.equation_context(docs), "eq_no", "prevtext", "nexttext")
    assert found == [(0, "\\begin{document}a", "b"), (1, "b", "c\\end{document}")]


def test_inline_math_over_lines_is_left_out(docs_of):
    docs = docs_of(body("a $x\ny$ b $z$ c"))
    assert rows(X.inline_equations(docs), "eq_no", "text") == [(0, "$z$")]


def test_sanitized_text(docs_of):
    full = "\\documentclass[12pt]{revtex}\n\\usepackage{a,\nb}\n" + body("text $i$ and $$x$$ \\[y\\]")
    bare = body("$$x$$")
    out = [r[0] for r in rows(X.sanitized_text(docs_of(full, bare, "none")), "text")]
    assert out[0] == (
        "\\documentclass[12pt]{article}\n\n\n\\usepackage{a,\nb}\n\n\\begin{document}\n\n\n$$x$$\n\n\\[y\\]\n\n\\end{document}"
    )
    assert out[1] == "\\documentclass{article}\n\n\n\\begin{document}\n\n\n$$x$$\n\n\\end{document}"
    assert out[2] == ""


def test_regex_runs_once_per_document(docs_of):
    plan = X.display_equations(docs_of(body("$$x$$")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2  # inline runs, display math


PIECES = (
    "$$ a = b $$", "$$ b_1 $$", "$$", "$", "$$$", "\\[ c \\]", "\\[", "\\]", "\\\\[2pt]", "\\begin{align} x \\\\[1pt] y \\end{align}",
    "\\begin{equation*} z \\end{equation*}", "\\begin{math}", "\\end{math}", "\\end{align}", "\\begin{comment}", "\\end{comment}",
    "\\begin{gather} $$ q $$ \\end{gather}", "%", "\n", ", ", ". ", ", and. ", "\\$", "\\", "[", "]", "begin{align}", "word", "$x$", "$x$$y$", " ",
)


def test_display_math_is_taken_out_as_in_turn(spark, docs_of, monkeypatch):
    monkeypatch.setattr(cleaning, "FEW_EQUATIONS", 0)
    draw = random.Random(5)
    docs = docs_of("", "no math", None, *[
        body("".join(draw.choice(PIECES) + draw.choice(("", " ", ", ", "\n")) for _ in range(draw.choice((6, 20, 60))))) for _ in range(600)
    ])
    arrays = X.with_clean_body(docs).select("text", X.display_array().alias("eqs"))
    in_turn = fold_replace(F.col("text"), F.array_distinct("eqs"), lambda _: F.lit(""))
    rows = arrays.select(cleaning.remove_display("text", "eqs").alias("got"), in_turn.alias("due"), "text").collect()
    assert [r.got for r in rows] == [r.due for r in rows]
    assert sum(r.due != r.text for r in rows if r.text) > 300


def test_many_equations_of_a_long_text_are_taken_out_in_one_pass(docs_of):
    n = 12_000
    prose = "plain words of prose " * 20
    docs = docs_of(body("".join(f"{prose}$$ a_{i} = b $$ and, " for i in range(n))))
    start = time.perf_counter()
    row = X.stripped_prose(docs).first()
    assert row.n_display == n and row.text == (f"{prose} and, " * n).strip()
    assert time.perf_counter() - start < 25
