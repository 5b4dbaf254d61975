"""Steps that settle a text in one pass, against the plain steps in turn."""

import random
import re
import time

from conftest import body
from pyspark.sql import functions as F
from texlode.functions import cleaning
from texlode.functions import patterns as P
from texlode.operators import pairing


def _texts(tokens, n=1500, most=14, seed=3):
    draw = random.Random(seed)
    return ["", "\n", "%", "$$"] + ["".join(draw.choice(tokens) for _ in range(draw.randint(1, most))) for _ in range(n)]


def _values(spark, texts, build):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    return [r[0] for r in frame.select("n", build("text").alias("out")).orderBy("n").select("out").collect()]


def test_comments_leave_line_by_line_as_in_three_passes(spark):
    def in_turn(t):
        t = re.sub(r"(?<=\n)%[^\n]+\n", "", t)
        t = re.sub(r"(?<!\\)%\n", "", t)
        return re.sub(r"(?<!\\)%[^\n]*\n", "\n", t)

    texts = _texts(["%", "%", "\\%", "\\", "\n", "\n", "a", "%\n", "\r", "\n%b"])
    assert _values(spark, texts, cleaning.strip_comments) == [in_turn(t) for t in texts]
    assert _values(spark, [None], cleaning.strip_comments) == [None]


def test_body_reaches_from_the_first_begin_to_the_next_end(spark):
    def found(t):
        m = re.search(r"(?s)\\begin\{document\}.*?\\end\{document\}", t)
        return m.group() if m else ""

    texts = _texts(["\\begin{document}", "\\end{document}", "a\n", "\\begin{", "document}"], most=7)
    assert _values(spark, texts, cleaning.body_of) == [found(t) for t in texts]
    assert _values(spark, [None], cleaning.body_of) == [None]


def _separated(t):
    runs = [r for r in dict.fromkeys(re.findall(P.INLINE_RUN, t)) if "$$" in r]
    for run in runs:
        t = t.replace(run, run.replace("$$", "$ $"))
    return re.sub(P.DOUBLE_DOLLAR, r" \1 ", t)


def test_inline_math_is_separated_as_run_after_run(spark):
    tokens = ["$", "$$", "$$", "a", "b ", "$a$$b$ ", "x $b$$a$", "\n", "^", "$a$", " $a$$b$$a$ ", "$b$$b$"]
    few = [",", " $a$$b$ ", " $b$$a$ ", " $c$$a$,", " $a$$c$", " $$ a $$ ", "$$ x", " $y$ ", "$a$$a$"]
    texts = _texts(tokens) + _texts(few, most=30)
    assert _values(spark, texts, cleaning.separate_inline) == [_separated(t) for t in texts]
    assert _values(spark, texts, lambda t: F.array_join(cleaning.inline_runs(t), "|")) == [
        "|".join(re.findall(P.INLINE_RUN, t)) for t in texts
    ]


def test_many_runs_are_not_sought_through_the_text_each(spark):
    text = " ".join(f"some words $x_{{{n}}}$$r$, and" for n in range(16_000))
    start = time.perf_counter()
    out = _values(spark, [text], cleaning.separate_inline)[0]
    assert time.perf_counter() - start < 10
    assert out == text.replace("$$", "$ $")


def _first_places(spark, rows):
    frame = spark.createDataFrame([(n, t, e) for n, (t, e) in enumerate(rows)], "n int, body string, eqs array<string>")
    out = frame.select("n", pairing.first_places("body", "eqs").alias("out")).orderBy("n")
    return [r["out"] for r in out.collect()]


def test_equations_stand_where_a_search_finds_them(spark):
    tokens = [
        "\\begin{equation}", "\\end{equation}", "\\begin{align*}x\\end{align*}", "\\[", "\\]", "\\\\[2pt]", "$$", "$", "a", "é ",
        "$$ a $$", "\\[ a \\]", "\\begin{math}a\\end{math}", "\\\\[ a \\]", "\\begin{x}",
    ]
    texts = _texts(tokens, most=16)
    # Equations of the text and of others, so that some stand within others and some nowhere.
    found = [[m.group() for m in re.finditer(P.DISPLAY_MATH, t)] for t in texts]
    rows = [(t, one + other) for t, one, other in zip(texts, found, found[1:] + found[:1])]
    assert _first_places(spark, rows) == [[t.find(e) for e in eqs] for t, eqs in rows]


def test_equations_are_not_sought_through_the_body_each(spark, docs_of):
    prose = "some words of prose " * 60
    parts = [f"{prose}\\[ x_{{{n}}} \\] and \\begin{{math}}y_{{{n}}}\\end{{math}} or $$ z_{n} $$ " for n in range(2_000)]
    text = body("".join(parts))
    eqs = re.findall(r"\\\[.*?\\\]|\\begin\{math\}.*?\\end\{math\}|\$\$.*?\$\$", text)
    start = time.perf_counter()
    got = _first_places(spark, [(text, eqs)])[0]
    assert time.perf_counter() - start < 15
    assert got == [m.start() for m in re.finditer(r"\\\[|\\begin\{math\}|\$\$ z", text)]
    # Bodies do not travel to the join.
    xhtml = spark.createDataFrame([("d", "000", "<table><math>x</math></table>")], "dir string, doc_name string, xhtml string")
    assert "body" not in pairing.paired_documents(docs_of(body("a \\[ b \\]")), xhtml).columns
