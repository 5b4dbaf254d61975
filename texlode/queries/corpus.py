"""A LaTeX corpus derived from the given tables, as SQL text for Spark and for DuckDB.

Every derived text holds the whole text of its document: sentence and clause
ends turn into equations, inline math, comments and references that carry the
word before them, so the number and variety of equations grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

GROUP = "«1»"


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def lit(self, text: str) -> str:
        if self.spark:
            return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return "'" + text.replace("'", "''") + "'"

    def rewrite(self, value: str, pattern: str, template: str) -> str:
        """Global regex replacement; ``«1»`` in the template is the first group."""
        out = template.replace("\\", "\\\\")
        if self.spark:
            out = out.replace("$", "\\$").replace(GROUP, "$1")
            return f"regexp_replace({value}, {self.lit(pattern)}, {self.lit(out)})"
        out = out.replace(GROUP, "\\1")
        return f"regexp_replace({value}, {self.lit(pattern)}, {self.lit(out)}, 'g')"

    def cat(self, *parts: str) -> str:
        return "concat(" + ", ".join(parts) + ")"

    def when(self, condition: str, text: str, otherwise: str = "") -> str:
        return f"CASE WHEN {condition} THEN {self.lit(text)} ELSE {self.lit(otherwise)} END"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")

# Sentence ends by their last letter: TeX, and the converted XHTML in its place.
_SENTENCES = (
    ("s", "«1»s \\begin{equation}\\label{eq:«1»} x_{«1»} = 1 \\nonumber \\end{equation} ",
     '<table><tr><math id="s">«1»</math></tr></table>'),
    ("n", "\n\\begin{align*}\\label{eq:«1»n} «1» &= a \\\\ b &= 2 \\times c_{«1»}\\end{align*}\n",
     '<table><math>«1»</math> and\n<math>c</math></table>\n'),
    ("e", "«1» $$ «1» = y $$ ", '<table class="d"><math>«1»\n</math></table>'),
    ("t", "so \\[ \\frac{«1»}{2} \\quad \\] ", "<table><math>«1»/2</math></table>"),
    ("d", "\\begin{eqnarray} u &=& «1» \\\\ \\\\ v &=& w \\nonumber \\end{eqnarray} ",
     "<table><td><math>u</math></td><td><math>v</math></td></table>"),
    ("r", "as \\begin{gather} p_{«1»} \\\\[2pt] q \\hspace{1cm} \\end{gather} ",
     "<table>no conversion of «1»</table>"),
    ("y", "\\begin{math} «1» \\in A \\end{math} ", "<table><math>in</math></table>"),
)

# Clause ends by their last letter.
_CLAUSES = (
    ("n", "$«1»_{n}$, "),
    ("r", "$«1»$$r$, "),
    ("t", "costs \\$5 «1»t, "),
    ("d", "«1»d % remark about «1»\n"),
    ("y", "«1»y\n% line about «1»\n"),
    ("l", "5\\% of «1»l, "),
    ("h", "«1»h%\n"),
    ("e", "see \\ref{eq:«1»}, "),
    ("s", "by \\eqref{ eq:«1» }, "),
)


# What prose keeps: as ranges, and sign by sign, which Java looks up in one table.
_KEPT = "a-zA-ZÀ-ÿ0-9 .,%$&\n"
_KEPT_SIGNS = "".join(chr(c) for c in range(256) if chr(c).isascii() and chr(c).isalnum() or c >= 0xC0) + " .,%$&\n"


def _prose(d: Dialect) -> str:
    """The whole text with TeX specials escaped and other signs turned to blanks."""
    text = d.rewrite("text", f"[^{_KEPT_SIGNS if d.spark else _KEPT}]+", " ")
    for sign in "%$&":
        text = f"replace({text}, {d.lit(sign)}, {d.lit(chr(92) + sign)})"
    return text


def _in_turn(d: Dialect, text: str, ends: dict[str, str]) -> str:
    """Rewrites words with each end, letter and sign, in one pass per end."""
    for end, template in ends.items():
        text = d.rewrite(text, f" ([a-z]+){end.replace('.', chr(92) + '.')} ", " " + template)
    return text


def _at_once(d: Dialect, text: str, ends: dict[str, str]) -> str:
    """The same in one pass over the text.

    The words with such signs are cut out, between bars, which prose never holds,
    and filled in by their end.  Those that follow one another share a blank, so
    what becomes of one depends on the other: they are rewritten in turn.
    """
    signs = "".join(sorted({end[1] for end in ends}))
    pattern = f" (?:[a-z]{{2,}}+[{signs}] )++"
    pieces = f"split(regexp_replace({text}, {d.lit(pattern)}, '|$0|'), {d.lit(chr(92) + '|')}, -1)"

    def filled(template: str) -> str:
        parts = [d.lit(part) for part in (" " + template).split(GROUP)]
        return d.cat(*[item for part in parts for item in ("substring(x, 2, length(x) - 4)", part)][1:])

    # The place of an end among all, each two characters long, is that of its template; 0 is for none.
    place = f"(instr({d.lit(''.join(ends))}, substring(x, -3, 2)) + 1) div 2"
    one = f"elt(1 + {place}, x, {', '.join(filled(template) for template in ends.values())})"
    cut = f"IF(instr(substring(x, 2), ' ') = length(x) - 1, {one}, {_in_turn_where_found(d, 'x', ends)})"
    return f"array_join(transform({pieces}, (x, i) -> IF(i % 2 = 0, x, {cut})), '')"


def _in_turn_where_found(d: Dialect, text: str, ends: dict[str, str]) -> str:
    """``_in_turn`` for short texts: an end that does not stand in a text costs it no regex."""
    for n, (end, template) in enumerate(ends.items()):
        rewritten = _in_turn(d, f"x{n}", {end: template})
        text = f"transform(array({text}), x{n} -> IF(contains(x{n}, {d.lit(end + ' ')}), {rewritten}, x{n}))[0]"
    return text


def _rewritten(d: Dialect, text: str, ends: dict[str, str]) -> str:
    return _at_once(d, text, ends) if d.spark else _in_turn(d, text, ends)


def _tex_prose(d: Dialect) -> str:
    sentences = {f"{letter}.": tex for letter, tex, _ in _SENTENCES}
    return _rewritten(d, _prose(d), sentences | {f"{letter},": tex for letter, tex in _CLAUSES})


def _xhtml_prose(d: Dialect) -> str:
    return _rewritten(d, _prose(d), {f"{letter}.": xhtml for letter, _, xhtml in _SENTENCES})


def _number(d: Dialect, expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def document_columns(d: Dialect) -> str:
    name = f"concat('d', lpad({_number(d, 'doc_id')}, 12, '0'))"
    return (
        f"source AS dir, concat(source, '/', {name}, '.tex') AS file, {name} AS doc_name"
    )


def tex_text(d: Dialect) -> str:
    seven, eleven = _number(d, "doc_id % 7"), _number(d, "doc_id % 11")
    preamble = [
        d.when("doc_id % 7 = 3", "", "\\documentclass[12pt]{report}\n"),
        d.lit("\\usepackage{amsmath, graphicx}\n"),
        d.when("doc_id % 4 = 0", "\\usepackage[utf8]{inputenc}\n"),
        d.lit("\\usepackage["), "lang", d.lit("]{babel}\n% \\usepackage{old}\n\\usepackage{style"),
        _number(d, "doc_id % 97"), d.lit("}\n\\begin{document}\n\\section*{About "), "source", d.lit("}\n"),
    ]
    hidden = d.when(
        "doc_id % 6 = 0",
        "\\begin{comment}\n\\begin{equation} hidden \\end{equation}\n\\end{comment}\n",
    )
    stray = d.when("doc_id % 17 = 3", "{\\bf open\n", "") + " || " + d.when("doc_id % 17 = 5", "} closed\n", "")
    long_sum = f"CASE WHEN doc_id % 41 = 0 THEN repeat({d.lit('+ k')}, 600) ELSE '' END"
    closing = [
        d.lit("\n\\begin{equation}\\label{eq:a} x_{"), seven, d.lit("} = {"), eleven, d.lit("}"),
        long_sum, d.lit("\\end{equation}\nBy \\ref{eq:a} and \\eqref{eq:a}\n"),
        f"CASE WHEN doc_id % 5 = 0 THEN concat({d.lit('$$ x_{')}, {seven}, {d.lit('}  =  {')}, "
        f"{eleven}, {d.lit('} & $$ twice\n')}) ELSE '' END",
        d.lit("\\begin{thebibliography}{9}\\bibitem{x} A (book) \\end{thebibliography}\n"),
        d.when("doc_id % 50 = 49", "", "\\end{document}\n"),
    ]
    # Some documents are prose only.
    prose = f"CASE WHEN doc_id % 29 = 1 THEN {_prose(d)} ELSE {_tex_prose(d)} END"
    tail = f"CASE WHEN doc_id % 29 = 1 THEN {d.lit(chr(10) + chr(92) + 'end{document}' + chr(10))} ELSE {d.cat(*closing)} END"
    return d.cat(*preamble, hidden, stray, prose, tail)


def tex_sql(d: Dialect) -> str:
    return f"SELECT {document_columns(d)}, {tex_text(d)} AS text FROM documents"


def xhtml_text(d: Dialect) -> str:
    last = [
        f"CASE WHEN doc_id % 19 = 5 THEN '' WHEN doc_id % 23 = 7 THEN "
        f"{d.lit('<table><span class=' + chr(34) + 'ltx_ERROR' + chr(34) + '/></table>')} "
        f"ELSE {d.lit('<table><math>x</math></table>')} END",
        d.when("doc_id % 5 = 0", "<table><math>x again</math></table>"),
    ]
    prose = f"CASE WHEN doc_id % 29 = 1 THEN {_prose(d)} ELSE {d.cat(_xhtml_prose(d), *last)} END"
    link = '<html><link href="../../css/LaTeXML.css"/>\n<link href="x/ltx-article.css"/><p>'
    return d.cat(d.lit(link), prose, d.lit("</p></html>"))


def xhtml_sql(d: Dialect) -> str:
    """Converted documents; those in Spanish were never converted."""
    return (
        f"SELECT dir, doc_name, xhtml FROM (SELECT {document_columns(d)}, lang, "
        f"{xhtml_text(d)} AS xhtml FROM documents) WHERE lang <> 'es'"
    )


def log_sql(d: Dialect) -> str:
    return (
        f"SELECT CASE WHEN doc_id % 13 = 0 THEN concat(file, ': MathML conversion failed - timeout') "
        f"WHEN doc_id % 11 = 0 THEN concat(file, ': Conversion failed') "
        f"WHEN doc_id % 7 = 0 THEN concat(file, ': MathML postprocessing failed - timeout') "
        f"WHEN doc_id % 5 = 0 THEN concat('TIME (hh:mm:ss): 0:0', {_number(d, 'doc_id')}) "
        f"ELSE concat(file, ' done') END AS value "
        f"FROM (SELECT doc_id, {document_columns(d)} FROM documents)"
    )


def categories_sql(d: Dialect) -> str:
    """Lines ``file category``; only labelled documents have one."""
    return (
        f"SELECT concat(file, ' ', CASE WHEN toxic = 1 THEN 'hep-ph' WHEN quality = 1 THEN 'math.AG' "
        f"ELSE 'cs.LG' END, ' ') AS value "
        f"FROM (SELECT doc_id, {document_columns(d)} FROM documents) named JOIN labels USING (doc_id)"
    )


def bibcodes_sql(d: Dialect) -> str:
    return (
        f"SELECT concat(doc_name, ',2015', lpad({_number(d, 'doc_id')}, 9, '.'), "
        f"{_number(d, 'quality')}) AS value "
        f"FROM (SELECT doc_id, {document_columns(d)} FROM documents) named JOIN labels USING (doc_id)"
    )


def atom_sql(d: Dialect) -> str:
    head = d.lit(
        '<feed>\n<entry><title>x</title><arxiv:primary_category '
        'xmlns:arxiv="http://arxiv.org/schemas/atom" term="'
    )
    tail = d.lit('" scheme="http://arxiv.org/schemas/atom"/></entry>\n</feed>')
    return (
        f"SELECT file, CASE WHEN lang = 'de' THEN '<feed/>' ELSE {d.cat(head, 'lang', d.lit('.'), 'dir', tail)} END AS body "
        f"FROM (SELECT lang, {document_columns(d)} FROM documents)"
    )


def sql_dump_sql(d: Dialect) -> str:
    value = d.cat(
        "doc_name", d.lit(" ###x_{"), "lang", d.lit("} = 1\n###, y"), "dir", d.lit("\t###\\frac{1}{"),
        _number(d, "doc_id"), d.lit("}### # bad"),
    )
    return f"SELECT {value} AS value FROM (SELECT doc_id, lang, {document_columns(d)} FROM documents)"


def eqid_list_sql(d: Dialect) -> str:
    return f"SELECT concat('eqds', {_number(d, 'doc_id * 3')}, 'Q') AS eqid FROM documents"


# Macros of every submission, and their expansion as plain text.
_SUBMISSION_SENTENCES = (
    ("s", "\\foo{«1»} and \\rank A "),
    ("n", "$\\pair(«1»,b)$ "),
    ("e", "\\opt{«1»} or \\opt[j]{«1»} "),
    ("t", "\\bar{} «1» \\half "),
    ("d", "\\barred\\isundefined{\\foo} «1» "),
    ("r", "\\begin{equation} \\two{«1»}{q} \\end{equation} "),
)

MACRO_PREAMBLE = (
    "\\documentclass{article}\n"
    "\\newcommand{\\foo}[1]{f(#1)}\n"
    "\\newcommand*{\\two}[2]{\\foo{#2}-#1}\n"
    "\\newcommand{\\opt}[2][k]{#1+#2}\n"
    "\\def\\bar{\\foo{b}}\n"
    "\\def\\pair(#1,#2){<#1|#2>}\n"
    "\\renewcommand\\half{\\frac{1}{2}}\n"
    "\\DeclareMathOperator{\\rank}{rank}\n"
    "\\DeclareMathOperator*{\\argmax}{arg\\,max}\n"
    "\\newcommand{\\barred}{\\bar\\half}\n"
)


def submission_prose(d: Dialect) -> str:
    return _rewritten(d, _prose(d), {f"{letter}.": tex for letter, tex in _SUBMISSION_SENTENCES})


def submissions_sql(d: Dialect) -> str:
    """Files ``(folder, rel_path, text)``: a main file, its input, and an unused file."""
    loop = d.when("doc_id % 31 = 2", "\\def\\ping{\\pong}\n\\def\\pong{\\ping}\n")
    self_ref = d.when("doc_id % 37 = 3", "\\def\\selfy{a \\selfy}\n\\newcommand{\\me}{b \\me c}\n")
    again = d.when("doc_id % 10 = 4", "\\renewcommand{\\foo}[1]{g(#1)}\n")
    main = d.cat(
        d.lit(MACRO_PREAMBLE), loop, self_ref, again,
        d.lit("\\begin{document}\n\\input{part}\nmid \\input sec% note\n"),
        d.when("doc_id % 9 = 4", "\\input{lost}\n"),
        d.when("doc_id % 31 = 2", "\\ping\n"),
        d.when("doc_id % 37 = 3", "\\selfy and \\me\n"),
        d.when("doc_id % 43 = 6", "", "\\end{document}\n"),
    )
    part = d.cat(submission_prose(d), d.lit("\n\\input{deeper}\n"))
    sec = d.cat(d.lit("Section of "), "source", d.lit(" \\rank{}\n"))
    base = f"SELECT doc_id, source, text, {document_columns(d)} FROM documents"
    return (
        f"SELECT doc_name AS folder, 'main.tex' AS rel_path, {main} AS text FROM ({base}) "
        f"UNION ALL SELECT doc_name, 'part.tex', {part} FROM ({base}) "
        f"UNION ALL SELECT doc_name, 'sec.tex', {sec} FROM ({base}) "
        f"UNION ALL SELECT doc_name, 'a_cover.txt', {d.lit(chr(92) + 'begin{document}' + chr(92) + 'end{document}')} FROM ({base})"
    )
