"""Pairing with XHTML, significance, profiles."""

import json

from conftest import body
from texlode.operators import dictionary as D
from texlode.operators import extract as X
from texlode.operators import pairing as P
from texlode.operators import profile as R
from texlode.operators import significance as S


def table(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


TEX = (
    body("a $$x$$ b \\[y\\] c $$x$$ d"),
    body("$$x$$"),
    body("\\begin{align}p\\\\q\\end{align}$$z$$"),
    body("no math"),
)
XHTML = {
    "000": "<table><math>1</math></table><table></table><table><math>3</math>,<math>4</math></table>",
    "001": "<table><math>1</math></table><table>ltx_ERROR</table>",
    "003": "<p/>",
}


def xhtml(spark):
    rows = [("d", name, text) for name, text in XHTML.items()]
    return spark.createDataFrame(rows, "dir string, doc_name string, xhtml string")


def test_pairs_and_rejects(spark, docs_of):
    paired = P.paired_documents(docs_of(*TEX), xhtml(spark))
    objects = P.equation_objects(paired)
    start = "\\begin{document}"
    assert table(objects, "eq_no", "text", "prevtext", "nexttext", "index", "pos", "mathml") == [
        (0, "$$x$$", start + "a  ", "  b ", 1, len(start) + 2, "<math>1</math>"),
        (1, "\\[y\\]", "  b ", " c  ", 3, len(start) + 10, ""),
        # An equal equation has the place and context of the first one.
        (2, "$$x$$", start + "a  ", "  b ", 1, len(start) + 2, "<math>3</math>\n<math>4</math>"),
    ]
    assert table(P.pairing_rejects(paired), "file", "reason", "detail") == [
        ("d/001.tex", "LaTeX/XHTML equation count mismatch", "LaTeX - 1, XHTML - 2"),
        ("d/002.tex", "missing_xhtml", ""),
    ]
    items = json.loads(P.equations_json(paired).first()["json"])
    assert [i["mathml"] for i in items] == ["<math>1</math>", "", "<math>3</math>\n<math>4</math>"]
    assert items[0]["itemtype"] == "equation" and items[0]["type"] == "latex"


def test_equation_document_table(spark, docs_of):
    docs = docs_of(*TEX[:1])
    classified = X.classified_equations(docs)
    eqs = D.equation_dictionary(classified)
    meqs = D.multiline_dictionary(classified, eqs)
    found = P.attach_ids(P.equation_objects(P.paired_documents(docs, xhtml(spark))), eqs, meqs)
    lines = table(P.equation_documents(found, eqs, meqs), "eqid", "mathml", "documents")
    assert lines == [
        ("EQDS0Q", '"<math>1</math>"', "d/000.tex:2"), ("EQDS1Q", '""', "d/000.tex:1"),
    ]
    split = P.equation_documents(found, eqs, meqs, counts_per_line=1)
    assert table(split, "eqid", "documents") == [("EQDS0Q", "d/000.tex:2"), ("EQDS1Q", "d/000.tex:1")]


def test_many_documents_of_one_equation_take_several_lines(spark, docs_of):
    docs = docs_of(*[body("$$x$$")] * 30)
    rows = [("d", f"{i:03d}", "<table><math>m</math></table>") for i in range(30)]
    converted = spark.createDataFrame(rows, "dir string, doc_name string, xhtml string")
    classified = X.classified_equations(docs)
    eqs = D.equation_dictionary(classified)
    meqs = D.multiline_dictionary(classified, eqs)
    found = P.attach_ids(P.equation_objects(P.paired_documents(docs, converted)), eqs, meqs)
    lines = P.equation_documents(found, eqs, meqs, counts_per_line=10).collect()
    assert len(lines) == 3
    assert sorted(d for line in lines for d in line.documents.split(",")) == [
        f"d/{i:03d}.tex:1" for i in range(30)
    ]


def test_lines_of_one_equation_and_folder_are_full_and_in_order(spark):
    schema = "eqid string, file string, eq_no int, mathml string"
    found = spark.createDataFrame([("E", f"d/{i:04d}.tex", 0, "") for i in range(1000)], schema)
    eqs = spark.createDataFrame([("E", "x")], "eqid string, eq_text string")
    lines = P.equation_documents(found, eqs, eqs.limit(0), counts_per_line=300).orderBy("part").collect()
    assert [line.part for line in lines] == [0, 1, 2, 3]
    assert [line.documents.count(",") + 1 for line in lines] == [300, 300, 300, 100]
    assert ",".join(line.documents for line in lines) == ",".join(f"d/{i:04d}.tex:1" for i in range(1000))


def test_missing_and_matched_names(spark, docs_of):
    docs = docs_of(*TEX)
    assert table(P.missing_xhtml(docs, xhtml(spark)), "doc_name") == [("002",)]
    assert table(P.matched_xhtml(docs, xhtml(spark)), "doc_name") == [("000",), ("001",), ("003",)]


def test_coverage(spark, docs_of):
    log = spark.createDataFrame(
        [("a", P.MESSAGE_FAILED), ("b", P.MESSAGE_TIMEOUT), ("c", P.MESSAGE_POST_TIMEOUT)],
        "file string, message string",
    )
    docs = docs_of(*TEX)
    row = P.coverage(xhtml(spark), log, X.math_documents(docs)).first()
    assert tuple(row) == (1, 1, 80.0, 33.33)
    none = P.coverage(xhtml(spark).limit(0), log, X.math_documents(docs).limit(0)).first()
    assert none.equation_coverage is None and none.document_coverage is None


def test_most_significant(docs_of):
    docs = docs_of(
        # Two references each; the later one in the text loses.
        body("$$\\label{b}q$$ $$\\label{a}p$$ \\ref{a}\\ref{ a }\\ref{b}\\eqref{b}"),
        # A label given twice names the last equation.
        body("$$\\label{a}one$$ $$\\label{a}two$$ \\ref{a}"),
        body("$$first$$ $$second$$ \\ref{nothing}"),
        body("no math \\ref{a}"),
        body("$$\\label{x}u$$ $$\\label{x}v$$ $$\\label{y}w$$ \\ref{x}\\ref{y}\\ref{y}"),
    )
    best = table(S.most_significant(docs), "file", "text", "n_refs")
    assert best == [
        ("d/000.tex", "$$\\label{b}q$$", 2),
        ("d/001.tex", "$$\\label{a}two$$", 1),
        ("d/002.tex", "$$first$$", None),
        ("d/004.tex", "$$\\label{y}w$$", 2),
    ]


def test_significance_status(spark, docs_of):
    head = "\\begin{equation}"
    tail = "\\end{equation}"
    fits = head + "x" * (1500 - len(head + tail)) + tail
    docs = docs_of(body(fits), body(fits.replace("x", "xx", 1)), body("none"), body("$$\\label{a}$$\\ref{a}"), body("$$z$$"))
    codes = spark.createDataFrame([(f"00{i}", f"code{i}") for i in range(4)], "doc_name string, bibcode string")
    assert table(S.significance_status(docs, codes), "status") == [
        ("1 occurrences",), ("MSE too long",), ("first equation",), ("no bibcode",), ("no equations",),
    ]
    assert table(S.without_bibcode(S.most_significant(docs), codes), "doc_name") == [("004",)]


def test_label_references(docs_of):
    docs = docs_of(body("$$\\label{a}p$$ \\ref{a}\\eqref{ a } \\ref{zz}"))
    assert table(S.equation_references(docs), "ref_no", "label") == [(0, "a"), (1, "a"), (2, "zz")]
    assert table(S.label_references(docs), "ref_no", "label", "eq_no") == [(0, "a", 0), (1, "a", 0)]
    assert table(S.reference_counts(docs), "n_refs") == [(2,)]


def test_profiles(spark, docs_of):
    docs = docs_of(
        "\\usepackage{a,b}" + body("$$x$$"), "\\usepackage[o]{b}" + body("plain"), "nothing"
    )
    assert table(R.package_frequency(docs), "package", "n") == [("a", 1), ("b", 2)]
    assert [tuple(r) for r in R.top_packages(docs, 1).collect()] == [("b", 2)]
    assert table(R.mathless_documents(docs), "file") == [("d/001.tex",)]
    stats = R.corpus_statistics(R.legacy_counts(docs)).first()
    # The double dollars count once as a pair and twice as single ones.
    assert tuple(stats) == (2, 1, 3.0, 3)
    empty = R.corpus_statistics(R.legacy_counts(docs).filter("n_legacy = 0")).first()
    assert empty.mean_equations is None
    rejects = R.bodyless(docs)
    assert table(rejects, "file") == [("d/002.tex",)]
    assert table(R.reject_summary(rejects), "op", "reason", "n") == [("body", "Missing body", 1)]
    assert table(R.quarantined(docs, rejects), "file") == [("d/002.tex",)]
    assert table(R.pending(docs, rejects), "file") == [("d/000.tex",), ("d/001.tex",)]
    lists = spark.createDataFrame([("d/000.tex", "math"), ("gone.tex", "hep")], "file string, category string")
    assert table(R.category_mismatches(docs, lists), "file", "reason") == [
        ("d/001.tex", "no category"), ("d/002.tex", "no category"), ("gone.tex", "no file"),
    ]
