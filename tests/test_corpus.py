"""The derived corpus and what its queries cost."""

import random
import re
import time

from conftest import body
from texlode.operators import extract as X
from texlode.queries import corpus
from texlode.queries.tables import Corpus


def _in_turn(spark, frame, ends):
    column = corpus._in_turn(corpus.SPARK, "prose", ends)
    return [r[0] for r in frame.selectExpr("n", f"{column} AS text").orderBy("n").select("text").collect()]


def test_words_rewritten_at_once_are_those_rewritten_in_turn(spark):
    draw = random.Random(7)
    words = ("as", "bn", "e", "ce", "at", "ed", "gr", "by", "al", "th", "qa", "Zs", "x1", "é", "")
    signs = (". ", ", ", " ", ".", ",", "  ", "\n", "\\%, ", "\\$. ")
    texts = ["", None, " as. bn. cs, dt, ee. foo", " as. is. bs. ", "as. bn.", " b. as. c, ds, "] + [
        " " + "".join(draw.choice(words) + draw.choice(signs) for _ in range(40)) for _ in range(300)
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, prose string")
    sentences = {f"{letter}.": tex for letter, tex, _ in corpus._SENTENCES}
    clauses = {f"{letter},": tex for letter, tex in corpus._CLAUSES}
    for ends in (sentences, sentences | clauses, {f"{a}.": t for a, t in corpus._SUBMISSION_SENTENCES}):
        column = corpus._rewritten(corpus.SPARK, "prose", ends)
        # One pass over the text; the passes in turn see adjoining words only.
        assert len(re.findall(r"regexp_replace\(prose", column)) == 1
        got = [r[0] for r in frame.selectExpr("n", f"{column} AS text").orderBy("n").select("text").collect()]
        assert got == _in_turn(spark, frame, ends)


def test_names_are_read_without_deriving_texts(spark, tmp_path):
    rows = [(n, f"text as. {n}", "en", "web") for n in (1, 2, 2, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    c = Corpus(spark, str(tmp_path))
    plan = c.names._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
    assert sorted(map(str, c.names.collect())) == sorted(map(str, c.tex.select("dir", "file", "doc_name").collect()))


def test_runs_of_inline_math_are_sought_once(spark, docs_of):
    found = X.inline_segments(docs_of(body("a $x$ b $y$$z$ c")))
    assert [(r.kind, r.text) for r in found.orderBy("ord").collect() if r.kind == "equation"] == [
        ("equation", "$x$"), ("equation", "$y$"), ("equation", "$z$"),
    ]
    start = time.perf_counter()
    long = docs_of(body("some words $x$ " * 12_000))
    assert X.inline_segments(long).filter("kind = 'equation'").count() == 12_000
    assert time.perf_counter() - start < 60
