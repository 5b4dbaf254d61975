"""Registered queries: one per operator, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texlode.functions import cleaning, equations, formats, macros
from texlode.functions.patterns import MAX_RENDERED_LENGTH
from texlode.operators import dictionary as D
from texlode.operators import extract as X
from texlode.operators import macros as M
from texlode.operators import pairing as P
from texlode.operators import profile as R
from texlode.operators import significance as S
from texlode.operators import submissions as U
from texlode.plans.physical import materialize, new_folder
from texlode.queries.tables import Corpus, plain_types
from texlode.sources import readers, writers
from texlode.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Corpus], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain_types(build(Corpus(spark, folder)))

        run.__name__ = name
        run.__doc__ = build.__doc__
        run.build = build
        QUERIES[name] = run
        return build

    return register


# --- Sources ---------------------------------------------------------------


def _tex_files(docs: DataFrame, path: Column | None = None) -> DataFrame:
    """Texts as files: latin-1 bytes with CR LF line ends under a path."""
    return docs.select(
        F.concat(F.lit("file:/corpus/"), "file").alias("path") if path is None else path,
        F.encode(F.replace("text", F.lit("\n"), F.lit("\r\n")), "ISO-8859-1").alias("content"),
    )


@query("scan_tex")
def scan_tex(c):
    return readers.parse_tex(_tex_files(c.tex))


@query("scan_parent")
def scan_parent(c):
    docs = readers.parse_tex(_tex_files(c.tex))
    return docs.groupBy("dir").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).alias("n_chars")
    )


@query("scan_xhtml")
def scan_xhtml(c):
    files = c.xhtml.select(
        F.concat(F.lit("file:/out/"), "dir", F.lit("_converted/"), "doc_name", F.lit(".xhtml")).alias("path"),
        F.encode("xhtml", "UTF-8").alias("content"),
    )
    return readers.parse_xhtml(files)


@query("file_categories")
def file_categories(c):
    return readers.parse_category_lines(c.category_lines)


@query("log_failures")
def log_failures(c):
    return readers.parse_log_lines(c.log_lines)


@query("sql_pairs")
def sql_pairs(c):
    return readers.parse_sql_pairs(c.sql_dump)


@query("atom_category")
def atom_category(c):
    return readers.parse_atom(c.atom)


# --- Text functions --------------------------------------------------------


@query("strip_comments")
def strip_comments(c):
    return c.tex.select("file", cleaning.strip_comments("text").alias("text"))


@query("join_pct_lines")
def join_pct_lines(c):
    return c.tex.select("file", cleaning.join_percent_lines("text").alias("text"))


@query("doc_body")
def doc_body(c):
    return c.tex.select("file", cleaning.document_body("text").alias("body"))


@query("remove_inline")
def remove_inline(c):
    return c.tex.select(
        "file", cleaning.remove_inline_math("text").alias("text"),
    )


@query("clean_inline")
def clean_inline(c):
    return c.tex.select("file", cleaning.normalise_inline("text").alias("text"))


@query("enforce_newlines")
def enforce_newlines(c):
    return c.tex.select("file", equations.break_lines("text").alias("text"))


@query("package_stmts")
def package_stmts(c):
    plain = c.tex.select("file", cleaning.strip_comments("text").alias("plain"))
    return plain.select("file", F.array_join(cleaning.package_statements("plain"), "\n").alias("packages"))


@query("mask_roundtrip")
def mask_roundtrip(c):
    return c.tex.select("file", formats.mask("text").alias("masked")).select(
        "file", "masked", formats.unmask("masked").alias("text")
    )


@query("css_href")
def css_href(c):
    return c.xhtml.select("dir", "doc_name", formats.shorten_css_links("xhtml").alias("xhtml"))


@query("doc_name")
def doc_name(c):
    return c.table("pages").select("page_id", "url", formats.document_name("url").alias("name"))


@query("sanitized_docs")
def sanitized_docs(c):
    return X.sanitized_text(c.tex).select("file", "text")


@query("strip_latex")
def strip_latex(c):
    return X.stripped_prose(c.tex).select("file", "text", "n_display")


@query("strip_latex_totals")
def strip_latex_totals(c):
    return X.display_equations(c.tex).agg(F.count(F.lit(1)).alias("n_equations"))


# --- Equations -------------------------------------------------------------


@query("math_docs")
def math_docs(c):
    return X.math_documents(c.tex).select("file", "n_display")


@query("display_equations")
def display_equations(c):
    return X.display_equations(c.tex).select("file", "eq_no", "text")


@query("doc_segments")
def doc_segments(c):
    return X.segments(c.tex).select("file", "ord", "kind", "text")


@query("inline_segments")
def inline_segments(c):
    return X.inline_segments(c.tex).select("file", "ord", "kind", "text")


@query("eq_context")
def eq_context(c):
    return X.equation_context(c.tex).select("file", "eq_no", "text", "prevtext", "nexttext")


@query("inline_equations")
def inline_equations(c):
    return X.inline_equations(c.tex).select("file", "eq_no", "text")


@query("eq_env_counts")
def eq_env_counts(c):
    found = X.display_equations(c.tex).select(
        equations.environment("text").alias("env"),
        equations.is_multiline("text").alias("is_multiline"),
        equations.is_math("text").alias("is_math"),
    )
    return found.groupBy("env", "is_multiline", "is_math").agg(F.count(F.lit(1)).alias("n"))


@query("std_eq")
def std_eq(c):
    return X.display_equations(c.tex).select("file", "eq_no", equations.standard_form("text").alias("std_eq"))


@query("sanitize_eq")
def sanitize_eq(c):
    return X.display_equations(c.tex).select(
        "file", "eq_no", equations.remove_layout("text", breaks=True).alias("text")
    )


@query("flat_eq")
def flat_eq(c):
    return X.display_equations(c.tex).select("file", "eq_no", equations.flat_form("text").alias("flat_eq"))


@query("sub_equations")
def sub_equations(c):
    pieces = D.keyed_pieces(X.classified_equations(c.tex).filter("is_multiline"))
    return pieces.select("file", "eq_no", "sub_no", "eq_key")


# --- Dictionaries ----------------------------------------------------------


@query("eq_dict")
def eq_dict(c):
    return D.equation_dictionary(X.classified_equations(c.tex)).select(
        "eqid", "eq_key", "eq_text", "n_occurrences"
    )


def _dictionaries(c: Corpus, classified: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both dictionaries from one extraction, which is written once and read twice."""
    if classified is None:
        classified = materialize(X.classified_equations(c.tex))
    eqs = materialize(D.equation_dictionary(classified))
    return eqs, materialize(D.multiline_dictionary(classified, eqs))


def _in_english(c: Corpus) -> DataFrame:
    name = F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    return c.documents.filter("lang = 'en'").select(name.alias("doc_name"))


@query("meq_dict")
def meq_dict(c):
    _, meqs = _dictionaries(c)
    return meqs.select("eqid", F.array_join("sub_ids", ",").alias("sub_ids"), "eq_text")


@query("inline_dict")
def inline_dict(c):
    return D.inline_dictionary(X.inline_equations(c.tex)).select("eqid", "eq_text", "n_occurrences")


@query("resume_ids")
def resume_ids(c):
    """Dictionary of the English documents, extended by the whole corpus."""
    c.store("tex")
    classified = materialize(X.classified_equations(c.tex))
    prior = materialize(D.equation_dictionary(classified.join(_in_english(c), "doc_name", "left_semi")))
    return D.extend_dictionary(classified, prior).select("eqid", "eq_key", "is_new")


@query("resume_inline_ids")
def resume_inline_ids(c):
    """Inline dictionary of the English documents, extended by the whole corpus."""
    inline = materialize(X.inline_equations(c.tex))
    prior = materialize(D.inline_dictionary(inline.join(_in_english(c), "doc_name", "left_semi")))
    return D.extend_inline_dictionary(inline, prior).select("eqid", "eq_text", "is_new")


@query("resume_meq_ids")
def resume_meq_ids(c):
    """Multi-line dictionary of the English documents, extended by the whole corpus."""
    classified = materialize(X.classified_equations(c.tex))
    english = classified.join(_in_english(c), "doc_name", "left_semi")
    eqs, meqs = _dictionaries(c, english)
    eqs = materialize(D.extend_dictionary(classified, eqs))
    extended = D.extend_multiline_dictionary(classified, eqs, meqs)
    return extended.select("eqid", F.array_join("sub_ids", ",").alias("sub_ids"), "eq_text", "is_new")


@query("enumerated_docs")
def enumerated_docs(c):
    c.store("tex")
    classified = materialize(X.classified_equations(c.tex))
    return D.enumerated_documents(c.store("tex"), classified, *_dictionaries(c, classified)).select(
        "file", "text", "n_replaced"
    )


@query("unmatched_equations")
def unmatched_equations(c):
    """Equations of the corpus that the dictionaries of the English documents lack."""
    c.store("tex")
    classified = materialize(X.classified_equations(c.tex))
    english = classified.join(_in_english(c), "doc_name", "left_semi")
    found = D.unmatched_equations(classified, *_dictionaries(c, english))
    return found.select("file", "eq_no", "reason", "text")


@query("enumerated_inline_docs")
def enumerated_inline_docs(c):
    c.store("tex")
    inline = materialize(X.inline_equations(c.tex))
    found = D.enumerated_inline_documents(c.tex, inline, materialize(D.inline_dictionary(inline)))
    return found.select("file", "text", "n_replaced")


@query("dict_totals")
def dict_totals(c):
    c.store("tex")
    return D.dictionary_totals(*_dictionaries(c), D.inline_dictionary(X.inline_equations(c.tex)))


@query("eqid_subset")
def eqid_subset(c):
    return R.listed_equations(D.equation_dictionary(X.classified_equations(c.tex)), c.eqid_list).select("eqid", "eq_text")


@query("write_eq_tsv")
def write_eq_tsv(c):
    return writers.equation_lines(*_dictionaries(c))


def _place(c: Corpus) -> str:
    """A new folder below the checkpoint folder, for what a query writes and reads again."""
    return new_folder(c.spark, "written")


@query("write_inline_tsv")
def write_inline_tsv(c):
    path = _place(c)
    writers.write_lines(writers.equation_lines(D.inline_dictionary(X.inline_equations(c.tex))), path)
    return c.spark.read.text(path)


@query("write_texts")
def write_texts(c):
    path = _place(c)
    writers.write_texts(c.tex, path)
    return c.spark.read.parquet(path).select("dir", "file", "doc_name", "text")


@query("write_categories")
def write_categories(c):
    path = _place(c)
    writers.write_categories(readers.parse_category_lines(c.category_lines), path)
    return readers.parse_category_lines(c.spark.read.text(path))


@query("read_eq_tsv")
def read_eq_tsv(c):
    rows = readers.parse_equation_lines(writers.equation_lines(*_dictionaries(c)))
    return rows.select("eqid", F.coalesce(F.array_join("sub_ids", ","), F.lit("")).alias("sub_ids"), "eq_text")


# --- Pairing ---------------------------------------------------------------


def _paired(c: Corpus) -> DataFrame:
    return P.paired_documents(c.tex, c.xhtml)


def _objects(c: Corpus) -> DataFrame:
    return P.equation_objects(_paired(c))


@query("xhtml_equations")
def xhtml_equations(c):
    return P.xhtml_equations(c.xhtml)


@query("tex_xhtml_join")
def tex_xhtml_join(c):
    sizes = c.xhtml.select("dir", "doc_name", F.length("xhtml").alias("chars"))
    return P.join_xhtml(c.names, sizes).select(
        "file", F.col("chars").isNotNull().alias("converted"), F.coalesce("chars", F.lit(0)).alias("xhtml_chars")
    )


@query("xhtml_missing")
def xhtml_missing(c):
    return P.missing_xhtml(c.names, c.xhtml)


@query("equation_objects")
def equation_objects(c):
    return _objects(c)


@query("eq_count_mismatch")
def eq_count_mismatch(c):
    rejects = P.pairing_rejects(_paired(c))
    return rejects.filter(F.col("reason") == P.MESSAGE_COUNTS)


@query("equations_json")
def equations_json(c):
    return P.equations_json(_paired(c))


@query("read_eq_json")
def read_eq_json(c):
    return readers.parse_equation_json(P.equations_json(_paired(c)).select("json")).select(
        "file", "eq_no", "text", "prevtext", "index", "pos", "mathml"
    )


def _identified(c: Corpus):
    eqs, meqs = _dictionaries(c)
    rows = P.attach_ids(P.equation_rows(_paired(c)), eqs, meqs)
    return materialize(rows.select("file", "eq_no", "eqid", "mathml")), eqs, meqs


@query("eq_docs")
def eq_docs(c):
    """Counts need no MathML and no context, so ids and files are all that is stored."""
    c.store("tex")
    rows = P.equation_rows(_paired(c)).select("file", "text")
    return P.document_counts(P.attach_ids(rows, *_dictionaries(c)))


@query("eq_mathml")
def eq_mathml(c):
    c.store("tex")
    return P.first_mathml(_identified(c)[0])


@query("eq_doc_tsv")
def eq_doc_tsv(c):
    c.store("tex")
    return writers.equation_document_lines(P.equation_documents(*_identified(c)))


@query("coverage")
def coverage(c):
    c.store("tex")
    return P.coverage(c.xhtml, readers.parse_log_lines(c.log_lines), X.math_documents(c.tex))


# --- Significance ----------------------------------------------------------


@query("eq_labels")
def eq_labels(c):
    return S.equation_labels(c.tex)


@query("eq_refs")
def eq_refs(c):
    return S.equation_references(c.tex)


@query("label_refs")
def label_refs(c):
    return S.label_references(c.tex)


@query("eq_ref_counts")
def eq_ref_counts(c):
    return S.reference_counts(c.tex)


@query("mse")
def mse(c):
    return S.most_significant(c.tex).select("file", "text", F.coalesce("n_refs", F.lit(0)).alias("n_refs"))


@query("mse_too_long")
def mse_too_long(c):
    found = S.most_significant(c.tex).select("file", F.length("text").alias("n_chars"))
    return found.filter(F.col("n_chars") > MAX_RENDERED_LENGTH)


@query("mse_bibcode")
def mse_bibcode(c):
    codes = readers.parse_bibcode_lines(c.bibcode_lines)
    return S.with_bibcodes(S.most_significant(c.tex), codes).select("file", "bibcode", "text")


@query("mse_status")
def mse_status(c):
    c.store("tex")
    codes = readers.parse_bibcode_lines(c.bibcode_lines)
    return S.significance_status(c.tex, codes).select("file", "status")


# --- Profiles and rejects --------------------------------------------------


@query("packages")
def packages(c):
    return R.packages(c.tex)


@query("package_freq")
def package_freq(c):
    return R.package_frequency(c.tex)


@query("package_top50")
def package_top50(c):
    return R.top_packages(c.tex)


@query("legacy_eq_counts")
def legacy_eq_counts(c):
    return R.legacy_counts(c.tex).select("file", "n_legacy")


@query("mathless_docs")
def mathless_docs(c):
    return R.mathless_documents(c.tex).select("file")


@query("corpus_eq_stats")
def corpus_eq_stats(c):
    return R.corpus_statistics(R.legacy_counts(c.tex))


@query("eqs_by_category")
def eqs_by_category(c):
    return R.equations_by_category(R.legacy_counts(c.tex), readers.parse_category_lines(c.category_lines))


@query("category_mismatch")
def category_mismatch(c):
    return R.category_mismatches(c.tex, readers.parse_category_lines(c.category_lines))


@query("reject_no_body")
def reject_no_body(c):
    return R.bodyless(c.tex)


def _rejects(c: Corpus) -> DataFrame:
    log = readers.parse_log_lines(c.log_lines).select(
        F.lit("convert").alias("op"), "file", F.btrim("message").alias("reason"), F.lit("").alias("detail")
    )
    pairs = P.pairing_rejects(_paired(c))
    return R.bodyless(c.tex).unionByName(pairs).unionByName(log)


@query("rejects_summary")
def rejects_summary(c):
    c.store("tex")
    return R.reject_summary(_rejects(c))


@query("quarantine_docs")
def quarantine_docs(c):
    """Equation-only form of each document that failed to pair."""
    c.store("tex")
    failed = P.pairing_rejects(_paired(c)).filter(F.col("reason") == P.MESSAGE_COUNTS)
    return X.sanitized_text(R.quarantined(c.tex, failed)).select("file", "text")


@query("pending_docs")
def pending_docs(c):
    done = c.xhtml.select(F.concat("dir", F.lit("/"), "doc_name", F.lit(".tex")).alias("file"))
    return R.pending(c.tex, done).select("file", "doc_name")


# --- Submissions and macros ------------------------------------------------


def _wrapped(text: str):
    """TeX text with braces put around some of its math delimiters."""
    out = F.replace(F.col(text), F.lit("\\begin{math}"), F.lit("{ {\\begin{math}} }"))
    out = F.replace(out, F.lit("\\[ "), F.lit("{\\[ } "))
    return F.replace(out, F.lit("$$ "), F.lit("{{$$}} "))


@query("unwrap_groups")
def unwrap_groups(c):
    wrapped = c.tex.select("file", _wrapped("text").alias("wrapped"))
    return wrapped.select(
        "file", F.length("wrapped").alias("n_wrapped"), macros.unwrap_delimiters("wrapped").alias("text")
    )


@query("unbalanced_docs")
def unbalanced_docs(c):
    found = c.tex.select(
        "file",
        macros.unmatched_openings("text", "{", "}").alias("open_braces"),
        macros.unmatched_openings("text", "[", "]").alias("open_brackets"),
    )
    return found.filter("open_braces > 0 OR open_brackets > 0")


@query("brace_groups")
def brace_groups(c):
    return U.brace_groups(c.tex).select(
        "file", "open_pos", F.coalesce("close_pos", F.lit(-1)).alias("close_pos"), "depth"
    )


@query("bracket_groups")
def bracket_groups(c):
    """The same of square brackets."""
    return U.brace_groups(c.tex, opening="[", closing="]").select(
        "file", "open_pos", F.coalesce("close_pos", F.lit(-1)).alias("close_pos"), "depth"
    )


@query("main_files")
def main_files(c):
    return U.main_files(c.submissions)


@query("input_edges")
def input_edges(c):
    return U.input_edges(U.main_texts(c.submissions))


@query("missing_inputs")
def missing_inputs(c):
    return U.missing_inputs(c.store("submissions"))


@query("expand_inputs")
def expand_inputs(c):
    return U.expanded_inputs(c.store("submissions"))


def _expanded(c: Corpus) -> DataFrame:
    """Main texts with inputs, stored because each macro step reads them."""
    if "inputs" not in c.stored:
        c.stored["inputs"] = materialize(U.expanded_inputs(c.store("submissions")))
    return c.stored["inputs"]


@query("macro_kind_counts")
def macro_kind_counts(c):
    return M.kind_counts(_expanded(c))


@query("macro_defs")
def macro_defs(c):
    return M.macro_table(_expanded(c))


@query("math_operators")
def math_operators(c):
    return M.math_operators(M.macro_table(_expanded(c)))


@query("macro_usage")
def macro_usage(c):
    docs = _expanded(c)
    return M.macro_usage(docs, M.macro_table(docs))


@query("macro_deps")
def macro_deps(c):
    return M.dependency_closure(M.dependencies(M.macro_table(_expanded(c))))


@query("expand_macros")
def expand_macros(c):
    return M.expand_documents(_expanded(c)).select("folder", "status", "text")


@query("quarantine_submissions")
def quarantine_submissions(c):
    return M.quarantined_submissions(_expanded(c), M.expand_documents(_expanded(c)))


@query("macro_outcomes")
def macro_outcomes(c):
    files = c.store("submissions")
    unfound = U.without_main_file(files, U.main_files(files))
    ends = M.outcomes(M.expand_documents(_expanded(c)), unfound)
    return ends.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# --- Streams ---------------------------------------------------------------


def _stream(c: Corpus) -> tuple[DataFrame, str]:
    """The corpus as a stream of Parquet files, and a folder for what it leaves."""
    folder = new_folder(c.spark, "stream")
    path = f"{folder}/documents"
    c.tex.write.parquet(path)
    return incremental.stream_documents(c.spark, path, incremental.batch_files(c.spark, path)), folder


@query("stream_packages")
def stream_packages(c):
    docs, folder = _stream(c)
    incremental.stream_counts(
        docs, incremental.running_packages, f"{folder}/out", f"{folder}/progress"
    ).awaitTermination()
    return incremental.latest_counts(c.spark, f"{folder}/out")


@query("stream_environments")
def stream_environments(c):
    docs, folder = _stream(c)
    incremental.stream_counts(
        docs, incremental.running_environments, f"{folder}/out", f"{folder}/progress"
    ).awaitTermination()
    return incremental.latest_counts(c.spark, f"{folder}/out")


@query("stream_eq_keys")
def stream_eq_keys(c):
    """Keys of the dictionary that grew batch by batch; its ids depend on the arrival order."""
    docs, folder = _stream(c)
    incremental.stream_dictionary(docs, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return incremental.read_dictionary(c.spark, f"{folder}/out").select("eq_key")


def _numbers(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("eqid").alias("n_ids"), F.max("eq_number").alias("last")
    )


@query("stream_eq_ids")
def stream_eq_ids(c):
    """Numbers of the dictionary that grew batch by batch: each once, none left out."""
    docs, folder = _stream(c)
    incremental.stream_dictionary(docs, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return _numbers(incremental.read_dictionary(c.spark, f"{folder}/out"))


@query("stream_inline_ids")
def stream_inline_ids(c):
    """The same of inline equations."""
    docs, folder = _stream(c)
    incremental.stream_inline_dictionary(docs, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return _numbers(incremental.read_dictionary(c.spark, f"{folder}/out", schema=incremental.INLINE_SCHEMA))


@query("stream_meq_ids")
def stream_meq_ids(c):
    """Multi-line equations of the dictionary that grew batch by batch, with the keys that their lines' ids name."""
    docs, folder = _stream(c)
    incremental.stream_multiline_dictionary(
        docs, f"{folder}/out", f"{folder}/single", f"{folder}/progress"
    ).awaitTermination()
    meqs = incremental.read_dictionary(c.spark, f"{folder}/out", schema=incremental.MULTILINE_SCHEMA)
    lines = meqs.select("eq_text", F.posexplode("sub_ids").alias("sub_no", "eqid"))
    eqs = incremental.read_dictionary(c.spark, f"{folder}/single").select("eqid", "eq_key")
    return lines.join(eqs, "eqid").select("eq_text", "sub_no", "eq_key")


# --- Files -----------------------------------------------------------------


def _laid_out(c: Corpus, files: DataFrame, kind: str) -> str:
    """Writes ``(path, content)`` as files below a folder of the shared store."""
    folder = new_folder(c.spark, kind)
    writers.write_files(files, folder)
    return folder


@query("scan_folder")
def scan_folder(c):
    """All files of the corpus, whatever their ending, written to folders and scanned from them."""
    named = F.concat_ws("/", "dir", F.concat("doc_name", F.lit(".txt"))).alias("path")
    folder = _laid_out(c, _tex_files(c.tex, named), "folder")
    return readers.read_tex_parent(c.spark, folder, glob=None).select("dir", "file", "text")


@query("scan_submissions")
def scan_submissions(c):
    """Submission folders, written as files and scanned with all folders below them."""
    named = F.concat_ws("/", "folder", F.lit("src"), "rel_path").alias("path")
    return readers.read_submissions(c.spark, _laid_out(c, _tex_files(c.submissions, named), "submissions"))


@query("read_eq_json_files")
def read_eq_json_files(c):
    """Equation objects of JSON files, one array each."""
    c.store("tex")
    arrays = P.equations_json(_paired(c))
    named = arrays.select(F.concat("file", F.lit(".json")).alias("path"), F.encode("json", "UTF-8").alias("content"))
    return readers.read_equation_json(c.spark, _laid_out(c, named, "json")).select(
        "file", "text", "prevtext", "index", "pos", "mathml"
    )


@query("rejects_table")
def rejects_table(c):
    """Rejects of two runs, the first of which was repeated."""
    c.store("tex")
    folder = new_folder(c.spark, "rejects")
    for run in ("one", "two", "one"):
        writers.write_rejects(_rejects(c), folder, run)
    return c.spark.read.parquet(folder).select("run", "op", "file", "reason", "detail")
