"""Corpus profiles: packages, categories, equation statistics, failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.functions import cleaning, formats
from texlode.functions import patterns as P
from texlode.operators.extract import DOCUMENT_KEY, with_body
from texlode.plans.physical import compute_once, explode_rows, materialize, narrowed


def packages(docs: DataFrame) -> DataFrame:
    """Packages named by each document; comments count, as in the text."""
    found = docs.select("file", formats.package_names("text").alias("names"))
    return explode_rows(found, "names", "package_no", "package", ["file"])


def package_frequency(docs: DataFrame) -> DataFrame:
    return packages(docs).groupBy("package").agg(F.count(F.lit(1)).alias("n"))


def top_packages(docs: DataFrame, limit: int = P.TOP_PACKAGES) -> DataFrame:
    return package_frequency(docs).orderBy(F.desc("n"), "package").limit(limit)


def legacy_counts(docs: DataFrame) -> DataFrame:
    return compute_once(docs, "n_legacy", cleaning.legacy_equation_count("text")).select(
        *DOCUMENT_KEY, "text", "n_legacy"
    )


def mathless_documents(docs: DataFrame) -> DataFrame:
    """Documents that begin a body but hold no math at all."""
    return (
        legacy_counts(docs)
        .filter((F.col("n_legacy") == 0) & F.contains("text", F.lit("\\begin{document}")))
        .select(*DOCUMENT_KEY)
    )


def corpus_statistics(legacy: DataFrame) -> DataFrame:
    n = F.col("n_legacy")
    return legacy.agg(
        F.count(F.when(n == 0, 1)).alias("n_without"),
        F.count(F.when(n > 0, 1)).alias("n_with"),
        F.avg(F.when(n > 0, n)).alias("mean_equations"),
        F.sum(n).alias("n_equations"),
    )


def equations_by_category(legacy: DataFrame, categories: DataFrame) -> DataFrame:
    """Documents and equations per category; a document without category keeps null."""
    joined = legacy.select("file", "n_legacy").join(categories, "file", "left")
    return joined.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_legacy").alias("n_equations")
    )


def category_mismatches(docs: DataFrame, categories: DataFrame) -> DataFrame:
    """Files that stand in only one of the corpus and the category list."""
    left = docs.select("file", F.lit(True).alias("in_corpus"))
    right = categories.select("file", F.lit(True).alias("in_list"))
    both = left.join(right, "file", "full")
    return both.filter(F.col("in_corpus").isNull() | F.col("in_list").isNull()).select(
        "file", F.when(F.col("in_list").isNull(), "no category").otherwise("no file").alias("reason")
    )


def bodyless(docs: DataFrame, op: str = "body", reason: str = "Missing body") -> DataFrame:
    """Reject rows of documents without a body."""
    checked = compute_once(with_body(docs).select("file", "body"), "found", F.col("body") != "")
    return checked.filter(~F.col("found")).select(
        F.lit(op).alias("op"), "file", F.lit(reason).alias("reason"), F.lit("").alias("detail")
    )


def reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("op", "reason").agg(F.count(F.lit(1)).alias("n"))


def quarantined(docs: DataFrame, rejects: DataFrame) -> DataFrame:
    """Documents named by a reject row, each once; only their texts travel."""
    names = materialize(rejects.select("file").distinct())
    return narrowed(docs, names, ["file"]).join(names, "file", "left_semi")


def pending(docs: DataFrame, finished: DataFrame) -> DataFrame:
    """Documents whose output does not exist yet."""
    return docs.join(finished.select("file"), "file", "left_anti")


def listed_equations(dictionary: DataFrame, allowed: DataFrame) -> DataFrame:
    """Dictionary rows whose id stands in a list, letter case aside."""
    wanted = allowed.select(F.lower("eqid").alias("_id"))
    return dictionary.join(wanted, F.lower(dictionary["eqid"]) == wanted["_id"], "left_semi")
