import pytest
from pyspark.sql import functions as F

from conftest import body
from texlode.operators import dictionary as D
from texlode.operators import extract as X
from texlode.operators import profile as R
from texlode.plans.physical import dense_ids, lookup, narrowed

TEXTS = (
    body("\\begin{equation} b = 1 \\nonumber\\end{equation} $$a$$ and $p$ or $q$ x"),
    body("\\begin{align}a &\\\\ c\\end{align} \\[ b=1 \\] $q$ \\begin{align}a\\end{align} x"),
    body("$$d$$ then \\begin{align}a &\\\\ c\\end{align} $p$ x"),
)


def table(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_first_occurrence_names_and_numbers(docs_of):
    eqs = D.equation_dictionary(X.classified_equations(docs_of(*TEXTS)))
    assert table(eqs, "eqid", "eq_key", "eq_text", "n_occurrences") == [
        ("EQDS0Q", "b=1", "\\begin{equation} b = 1 \\end{equation}", 2),
        ("EQDS1Q", "a", "\\begin{equation}a\\end{equation}", 4),
        ("EQDS2Q", "c", "\\begin{equation}c\\end{equation}", 2),
        ("EQDS3Q", "d", "\\begin{equation}d\\end{equation}", 1),
    ]


def test_multiline_rows_list_their_lines(docs_of):
    classified = X.classified_equations(docs_of(*TEXTS))
    meqs = D.multiline_dictionary(classified, D.equation_dictionary(classified))
    assert table(meqs, "eqid", "sub_ids", "n_occurrences") == [
        ("EQDM0Q", ["EQDS1Q", "EQDS2Q"], 2), ("EQDM1Q", ["EQDS1Q"], 1),
    ]


def test_inline_dictionary(docs_of):
    inline = D.inline_dictionary(X.inline_equations(docs_of(*TEXTS)))
    assert table(inline, "eqid", "eq_text", "n_occurrences") == [
        ("EQIX0Q", "$p$", 2), ("EQIX1Q", "$q$", 2),
    ]


def test_documents_take_ids(docs_of):
    docs = docs_of(*TEXTS, "no body", body("none"))
    classified = X.classified_equations(docs)
    eqs = D.equation_dictionary(classified)
    meqs = D.multiline_dictionary(classified, eqs)
    out = dict(table(D.enumerated_documents(docs, classified, eqs, meqs), "file", "text"))
    assert out["d/000.tex"] == body("EQDS0Q  EQDS1Q  and $p$ or $q$ x")
    # One line only: its flat key is that of a single equation.
    assert out["d/001.tex"] == body("EQDM0Q EQDS0Q $q$ EQDS1Q x")
    assert out["d/003.tex"] == "no body"
    assert out["d/004.tex"] == body("none")
    assert D.unmatched_equations(classified, eqs, meqs).count() == 0


def test_equation_inside_another_does_not_corrupt(docs_of):
    docs = docs_of(body("\\begin{equation}$$x$$ y\\end{equation} $$x$$ z"))
    classified = X.classified_equations(docs)
    eqs = D.equation_dictionary(classified)
    out = D.enumerated_documents(docs, classified, eqs, D.multiline_dictionary(classified, eqs)).first()
    assert "EQDS0Q" in out.text and "EQDS1Q" in out.text and "\\begin{equation}" not in out.text


def test_inline_documents(docs_of):
    docs = docs_of(*TEXTS, body("a $x\ny$ b $p$ c"), body("none"))
    inline = X.inline_equations(docs)
    found = D.enumerated_inline_documents(docs, inline, D.inline_dictionary(inline))
    out = dict(table(found, "file", "text"))
    assert out["d/000.tex"].endswith("and EQIX0Q or EQIX1Q x\\end{document}")
    assert out["d/003.tex"] == body("a  b EQIX0Q c")
    assert "d/004.tex" not in out


def test_resume_keeps_old_ids(docs_of):
    docs = docs_of(*TEXTS)
    classified = X.classified_equations(docs)
    prior = D.equation_dictionary(classified.filter("file = 'd/001.tex'"))
    before = dict(table(prior, "eq_key", "eqid"))
    both = D.extend_dictionary(classified, prior)
    after = dict(table(both, "eq_key", "eqid"))
    assert all(after[k] == v for k, v in before.items())
    assert sorted(after) == ["a", "b=1", "c", "d"]
    assert sorted(int(v[4:-1]) for v in after.values()) == [0, 1, 2, 3]
    assert table(both.filter("is_new"), "eq_key") == [("d",)]


def test_unmatched_are_classed(docs_of):
    docs = docs_of(body("\\begin{align}u &= v\\end{align} $$w$$"))
    classified = X.classified_equations(docs)
    empty = D.equation_dictionary(classified.limit(0))
    found = D.unmatched_equations(classified, empty, D.multiline_dictionary(classified.limit(0), empty))
    assert table(found, "eq_no", "reason") == [(0, "Multiline"), (1, "Single line")]


@pytest.mark.parametrize("partitions", [1, 64])
def test_ids_do_not_depend_on_partitions(docs_of, partitions):
    docs = docs_of(*[body(f"$$x_{i % 13}$$ $$y_{i % 7}$$") for i in range(60)]).repartition(partitions)
    eqs = D.equation_dictionary(X.classified_equations(docs))
    keys = [k for _, k in sorted((int(e[4:-1]), k) for e, k in table(eqs, "eqid", "eq_key"))]
    expected = []
    for i in range(60):
        for key in (f"x_{i % 13}", f"y_{i % 7}"):
            if key not in expected:
                expected.append(key)
    assert keys == expected


def test_dense_ids_are_dense(spark):
    frame = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("v")).repartition(16)
    got = dense_ids(frame, ["v"], "n").collect()
    assert [r.n for r in sorted(got, key=lambda r: r.v)] == list(range(10_000))


def test_lookup_with_a_hot_key_and_nulls(spark):
    facts = spark.range(9_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 2500)).alias("k"),
    )
    keys = facts.groupBy("k").count().filter("k is not null and k <> 'k1'").withColumn("v", F.upper("k"))
    out = lookup(facts, keys, "k", "count")
    assert out.count() == 9_000
    wrong = out.filter(
        ~F.col("v").eqNullSafe(F.when(F.col("k") != "k1", F.upper("k")))
    )
    assert wrong.count() == 0


def test_listed_equations_ignore_case(docs_of, spark):
    eqs = D.equation_dictionary(X.classified_equations(docs_of(*TEXTS)))
    allowed = spark.createDataFrame([("eqds1q",), ("EQDS3Q",), ("eqds3q",)], "eqid string")
    assert table(R.listed_equations(eqs, allowed), "eqid") == [("EQDS1Q",), ("EQDS3Q",)]


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 24])
def test_filter_by_key_loses_no_row(spark, bits):
    facts = spark.range(20_000).select(
        F.concat(F.lit("k"), "id").alias("name"), (F.col("id") % 7).cast("int").alias("no"), F.lit("x").alias("_bits")
    ).withColumn("no", F.when(F.col("no") > 0, F.col("no")))
    wanted = facts.filter("name like 'k1_' or name = 'k777'").select("name", "no")
    found = narrowed(facts, wanted, ["name", "no"], bits)
    assert found.columns == facts.columns and found.exceptAll(facts).isEmpty()
    assert wanted.exceptAll(found.select("name", "no")).isEmpty()
    # Eleven keys: at most eleven bits of the map are set.
    assert found.count() < 20_000 * 11 / bits * 1.5 + 12
    assert narrowed(facts, wanted.limit(0), ["name", "no"], bits).isEmpty()


def test_filter_by_key_stands_below_the_exchange(spark):
    facts = spark.range(1000).withColumn("text", F.lit("long"))
    wanted = spark.range(3)
    joined = narrowed(facts, wanted, ["id"]).join(wanted.hint("shuffle_merge"), "id", "left_semi")
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
