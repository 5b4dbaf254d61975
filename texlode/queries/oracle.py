"""The registered queries in DuckDB SQL.

The SQL is written apart from the Spark operators: RE2 has no look-around, so
escaped characters are parked, pairs are split by position, and dictionaries
and rankings use plain window functions.
"""

from __future__ import annotations

from texlode.queries import corpus as C

D = C.DUCKDB

PERCENT, DOLLAR, BREAK, BRACKET, AMPERSAND = (f"chr({n})" for n in (64977, 64976, 64978, 64980, 64981))
ENVS = "equation|multline|gather|align|flalign|math|eqnarray"
DISPLAY = "(?s)" + "|".join(
    [rf"\\begin\{{{env}\*?\}}.*?\\end\{{{env}\*?\}}" for env in ENVS.split("|")]
    + [r"\\\[.*?\\\]", r"\$\$[^^].*?\$\$"]
)


def uncommented(x: str) -> str:
    x = rf"replace({x}, '\%', {PERCENT})"
    x = rf"regexp_replace({x}, '(?m)^%[^\n]+\n', '', 'g')"
    x = f"replace({x}, '%' || chr(10), '')"
    x = rf"regexp_replace({x}, '%[^\n]*\n', chr(10), 'g')"
    x = rf"replace({x}, {PERCENT}, '\%')"
    return rf"regexp_replace({x}, '(?s)\\begin\{{comment\}}.*?\\end\{{comment\}}', '', 'g')"


def body(x: str) -> str:
    return rf"regexp_extract({x}, '(?s)\\begin\{{document\}}.*?\\end\{{document\}}')"


def parked(x: str) -> str:
    return rf"replace(replace(replace({x}, '\\', {BREAK}), '\$', {DOLLAR}), {BREAK}, '\\')"


def unparked(x: str) -> str:
    return rf"replace({x}, {DOLLAR}, '\$')"


def separated(x: str) -> str:
    runs = (
        rf"list_filter(regexp_extract_all({x}, '(?s)\$\$[^^].*?\$\$|\$[^$]+\$(?:\$[^$]+\$)*'), "
        f"lambda r: NOT starts_with(r, '$$') AND contains(r, '$$'))"
    )
    x = f"list_reduce(list_prepend({x}, {runs}), lambda a, r: replace(a, r, replace(r, '$$', '$ $')))"
    return rf"regexp_replace({x}, '(?s)(\$\$[^^].*?\$\$)', ' \1 ', 'g')"


def lifted(x: str) -> str:
    """Takes back the two parked signs of a piece of cleaned text."""
    return rf"replace({unparked(x)}, {BRACKET}, '\\[')"


def inner(e: str) -> str:
    return (
        rf"CASE WHEN starts_with({e}, '\begin') THEN regexp_extract({e}, "
        rf"'(?s)^\\begin\{{[a-z]+\*?\}}(.*)\\end\{{[a-z]+\*?\}}$', 1) "
        f"ELSE substr({e}, 3, length({e}) - 4) END"
    )


def no_layout(x: str) -> str:
    x = rf"regexp_replace({x}, '\\(nonumber|tag)([^A-Za-z@*]|$)', '\2', 'g')"
    x = rf"replace(replace(replace({x}, '\&', {AMPERSAND}), '&', ''), {AMPERSAND}, '\&')"
    x = rf"regexp_replace({x}, '\\hspace\{{[^\n]+?\}}', '', 'g')"
    x = rf"regexp_replace({x}, '\\(times|lefteqn|righteqn|qedhere)([^A-Za-z@*]|$)', '\2', 'g')"
    x = rf"regexp_replace({x}, '\\label\{{[^\n]+?\}}', '', 'g')"
    return rf"regexp_replace({x}, '\\q?quad', '', 'g')"


def squeezed(x: str) -> str:
    return rf"regexp_replace({x}, '\s', '', 'g')"


ENV_KIND = (
    "CASE "
    + " ".join(
        rf"WHEN starts_with(text, '\begin{{{env}') THEN '{'dmath' if env == 'math' else env}'"
        for env in ENVS.split("|")
    )
    + r" WHEN starts_with(text, '\[') THEN 'bracket' ELSE 'dollarsign' END"
)


def cte(name: str, sql: str) -> str:
    return f"{name} AS MATERIALIZED ({sql})"


TEX = cte("tex", C.tex_sql(D))
PLAIN = cte("plain", f"SELECT *, {uncommented('text')} AS plain FROM tex")
BODY = cte("bodies", f"SELECT *, {body('plain')} AS body FROM plain")
_CLEAN1 = cte("parked", f"SELECT *, {parked('body')} AS p FROM bodies")
CLEAN = _CLEAN1 + ", " + cte(
    "clean", rf"SELECT * EXCLUDE (p), replace({separated('p')}, '\\[', {BRACKET}) AS c FROM parked"
)
ARRAYS = cte(
    "arrays",
    f"SELECT *, list_transform(regexp_extract_all(c, '{DISPLAY}'), lambda e: {lifted('e')}) AS eqs, "
    f"list_transform(regexp_split_to_array(c, '{DISPLAY}'), lambda e: {lifted('e')}) AS parts FROM clean",
)
EQUATIONS = cte(
    "equations",
    "SELECT dir, file, doc_name, unnest(eqs) AS text, generate_subscripts(eqs, 1) - 1 AS eq_no FROM arrays",
)
CLASSIFIED = cte(
    "kinds", f"SELECT *, {ENV_KIND} AS env, {inner('text')} AS inside FROM equations"
) + ", " + cte(
    "standard",
    f"SELECT *, env IN ('multline', 'gather', 'align', 'flalign', 'eqnarray') AS multi, "
    f"{no_layout('inside')} AS std_eq FROM kinds",
) + ", " + cte("classified", f"SELECT *, {squeezed('std_eq')} AS flat_eq FROM standard")
LINES = cte(
    "sublists",
    r"SELECT *, regexp_split_to_array(flat_eq, '(?:\\\\)+') AS subs FROM classified WHERE multi",
) + ", " + cte(
    "lines",
    f"SELECT file, eq_no, text, generate_subscripts(subs, 1) - 1 AS sub_no, unnest(subs) AS raw FROM sublists",
) + ", " + cte(
    "sublines", f"SELECT file, eq_no, text, sub_no, {squeezed(no_layout('raw'))} AS eq_key FROM lines"
)


def dictionary(name: str, classified: str = "classified", sublines: str = "sublines") -> str:
    pieces = (
        f"SELECT file, eq_no, 0 AS sub_no, flat_eq AS eq_key, std_eq AS std FROM {classified} WHERE NOT multi "
        f"UNION ALL SELECT file, eq_no, sub_no, eq_key, eq_key FROM {sublines}"
    )
    ranked = (
        "SELECT *, row_number() OVER (PARTITION BY eq_key ORDER BY file, eq_no, sub_no) AS nth, "
        f"count(*) OVER (PARTITION BY eq_key) AS n_occurrences FROM ({pieces})"
    )
    return cte(
        name,
        "SELECT 'EQDS' || (row_number() OVER (ORDER BY file, eq_no, sub_no) - 1) || 'Q' AS eqid, eq_key, "
        r"'\begin{equation}' || std || '\end{equation}' AS eq_text, n_occurrences, "
        "row_number() OVER (ORDER BY file, eq_no, sub_no) - 1 AS eq_number "
        f"FROM ({ranked}) WHERE nth = 1",
    )


def multi_dictionary(name: str, eqs: str, sublines: str = "sublines") -> str:
    firsts = f"SELECT text, min((file, eq_no)) AS first FROM {sublines} GROUP BY text"
    numbered = (
        "SELECT text, first, 'EQDM' || (row_number() OVER (ORDER BY first) - 1) || 'Q' AS eqid "
        f"FROM ({firsts})"
    )
    return cte(
        name,
        "SELECT m.eqid, string_agg(e.eqid, ',' ORDER BY s.sub_no) AS sub_ids, m.text AS eq_text "
        f"FROM ({numbered}) m JOIN {sublines} s ON (s.file, s.eq_no) = m.first "
        f"JOIN {eqs} e ON e.eq_key = s.eq_key GROUP BY m.eqid, m.text",
    )


# Inline math: display math is cut out by the first alternatives of the pattern.
INLINE = cte(
    "inlines",
    "SELECT dir, file, doc_name, c, list_filter(regexp_extract_all(c, '(?s)"
    r"\$\$.*?\$\$|\$[^$]+\$'), lambda r: NOT starts_with(r, '$$') AND NOT contains(r, chr(10))) AS raw "
    "FROM clean",
) + ", " + cte(
    "inline_rows",
    f"SELECT file, generate_subscripts(raw, 1) - 1 AS eq_no, {unparked('unnest(raw)')} AS text FROM inlines",
)
INLINE_DICT = cte(
    "inline_dict",
    "SELECT 'EQIX' || (row_number() OVER (ORDER BY first) - 1) || 'Q' AS eqid, text AS eq_text, n_occurrences "
    "FROM (SELECT text, min((file, eq_no)) AS first, count(*) AS n_occurrences FROM inline_rows GROUP BY text)",
)

XHTML = cte("xhtml", C.xhtml_sql(D))
XTABLES = cte(
    "xtables",
    "SELECT dir, doc_name, xhtml, list_transform(regexp_extract_all(xhtml, '(?s)<table.*?</table>'), "
    "lambda t: array_to_string(regexp_extract_all(t, '(?s)<math.*?</math>'), chr(10))) AS mathml FROM xhtml",
)
LOG = cte("log_lines", C.log_sql(D)) + ", " + cte(
    "log",
    "SELECT split_part(value, ':', 1) AS file, split_part(value, ':', 2) AS message FROM log_lines "
    "WHERE length(value) - length(replace(value, ':', '')) = 1",
)
CATEGORIES = cte("category_lines", C.categories_sql(D)) + ", " + cte(
    "categories",
    r"SELECT regexp_extract(value, '^(\S+)', 1) AS file, regexp_extract(value, '^\S+ ([^ .]+)', 1) AS category FROM category_lines",
)
BIBCODES = cte("bibcode_lines", C.bibcodes_sql(D)) + ", " + cte(
    "bibcodes", "SELECT split_part(value, ',', 1) AS doc_name, split_part(value, ',', 2) AS bibcode FROM bibcode_lines"
)
PAIRED = cte(
    "paired",
    "SELECT a.*, x.mathml, CASE WHEN x.doc_name IS NULL THEN 'missing_xhtml' "
    "WHEN len(eqs) <> len(mathml) THEN 'LaTeX/XHTML equation count mismatch' END AS reason "
    "FROM arrays a LEFT JOIN xtables x USING (dir, doc_name) WHERE len(eqs) > 0",
)
OBJECTS = cte(
    "numbered", "SELECT *, unnest(range(len(eqs))) AS eq_no FROM paired WHERE reason IS NULL"
) + ", " + cte(
    "objects",
    "SELECT file, eq_no, eqs[eq_no + 1] AS text, 'latex' AS type, 'equation' AS itemtype, "
    "parts[list_position(eqs, eqs[eq_no + 1])] AS prevtext, "
    "parts[list_position(eqs, eqs[eq_no + 1]) + 1] AS nexttext, "
    "CAST(2 * list_position(eqs, eqs[eq_no + 1]) - 1 AS BIGINT) AS index, "
    "CAST(instr(body, eqs[eq_no + 1]) - 1 AS BIGINT) AS pos, mathml[eq_no + 1] AS mathml FROM numbered",
)
IDENTIFIED = cte(
    "identified",
    "SELECT o.*, coalesce(d.eqid, m.eqid) AS eqid FROM objects o "
    "JOIN classified k ON k.file = o.file AND k.eq_no = o.eq_no "
    "LEFT JOIN eq_dict d ON NOT k.multi AND d.eq_key = k.flat_eq "
    "LEFT JOIN meq_dict m ON k.multi AND m.eq_text = o.text",
)

# Labels and references.
LABELS = cte(
    "label_lists",
    r"SELECT file, eq_no, text, regexp_extract_all(text, '\\label\{([^\n]*?)\}', 1) AS found FROM equations",
) + ", " + cte(
    "labels_of",
    "SELECT file, eq_no, text, generate_subscripts(found, 1) - 1 AS nth, unnest(found) AS label FROM label_lists",
)
REFS = cte(
    "ref_lists",
    r"SELECT file, list_concat(regexp_extract_all(plain, '\\eqref\{([^\n]*?)\}', 1), "
    r"regexp_extract_all(plain, '\\ref\{([^\n]*?)\}', 1)) AS found FROM plain",
) + ", " + cte(
    "refs",
    "SELECT file, generate_subscripts(found, 1) - 1 AS ref_no, trim(unnest(found)) AS label FROM ref_lists",
)
LABEL_REFS = cte(
    "label_refs",
    "SELECT r.file, r.ref_no, r.label, l.eq_no, l.text FROM refs r JOIN labels_of l "
    "ON l.file = r.file AND l.label = r.label WHERE NOT EXISTS (SELECT 1 FROM labels_of later "
    "WHERE later.file = l.file AND later.label = l.label AND later.eq_no > l.eq_no)",
)
MSE = cte(
    "ref_counts",
    "SELECT file, text, count(*) AS n_refs, min(ref_no) AS first_ref FROM label_refs GROUP BY file, text",
) + ", " + cte(
    "mse",
    "SELECT file, doc_name, text, n_refs FROM (SELECT e.file, e.doc_name, e.text, coalesce(c.n_refs, 0) AS n_refs, "
    "row_number() OVER (PARTITION BY e.file ORDER BY coalesce(c.n_refs, 0) DESC, "
    "CASE WHEN c.n_refs IS NULL THEN 0 ELSE instr(p.plain, e.text) END, coalesce(c.first_ref, 0), e.eq_no) AS nth "
    "FROM equations e JOIN plain p USING (file) LEFT JOIN ref_counts c ON c.file = e.file AND c.text = e.text) "
    "WHERE nth = 1",
)

LEGACY_TEXT = cte(
    "legacy_text",
    "SELECT dir, file, doc_name, text, regexp_replace(regexp_replace(regexp_replace(text, "
    r"'(?m)^%[^\n]*', '', 'g'), '([^\\])%[^\n]*', '\1', 'g'), "
    r"'\\begin\{comment\}[^\n]*?\\end\{comment\}', '', 'g') AS t FROM tex",
)
_LEGACY = [
    rf"\\begin\{{{env}\}}.*?\\end\{{{env}\}}" for env in ("equation", "multline", "gather", "align")
] + [
    r"\\begin\{flalign\*\}.*?\\end\{flalign\*\}", r"\\begin\{math\}.*?\\end\{math\}",
    r"[^\\]\\\[.*?\\\]", r"\$\$[^^].*?\$\$", r"[^\\]\$.*?\$", r"\\\(.*?\\\)",
]
LEGACY = LEGACY_TEXT + ", " + cte(
    "legacy",
    "SELECT dir, file, doc_name, text, "
    + " + ".join(f"len(regexp_extract_all(t, '(?s){p}'))" for p in _LEGACY)
    + " AS n_legacy FROM legacy_text",
)
PACKAGES = cte(
    "package_lists",
    r"SELECT file, flatten(list_transform(regexp_extract_all(text, "
    r"'\\usepackage(?:\[[^\n]*?\])*\{([^\n]*?)\}', 1), lambda s: string_split(s, ','))) AS found FROM tex",
) + ", " + cte(
    "packages",
    "SELECT file, generate_subscripts(found, 1) - 1 AS package_no, trim(unnest(found)) AS package FROM package_lists",
)
SANITIZED = cte(
    "bare", rf"SELECT dir, file, doc_name, {uncommented('text')} AS t FROM tex"
) + ", " + cte(
    "bare_parked", f"SELECT *, {parked('t')} AS p FROM bare"
) + ", " + cte(
    "sanitized",
    "SELECT a.file, CASE WHEN contains(p.t, '\\begin{document}') AND contains(p.t, '\\end{document}') THEN "
    "array_to_string(list_concat(list_concat([CASE WHEN regexp_matches(p.t, '\\\\documentclass') THEN "
    "'\\documentclass[12pt]{article}' ELSE '\\documentclass{article}' END || chr(10)], "
    "regexp_extract_all(p.t, '(?s)\\\\usepackage(?:\\[.*?\\])?\\{.*?\\}')), "
    "list_concat(['\\begin{document}' || chr(10)], list_concat(a.eqs, ['\\end{document}']))), chr(10) || chr(10)) "
    "ELSE '' END AS text FROM arrays a JOIN bare_parked p USING (file)",
)

_BASE = [TEX, PLAIN, BODY, CLEAN, ARRAYS]
_EQ = _BASE + [EQUATIONS]
_KINDS = _EQ + [CLASSIFIED]
_DICT = _KINDS + [LINES, dictionary("eq_dict")]
_MEQ = _DICT + [multi_dictionary("meq_dict", "eq_dict")]
_ENGLISH = _KINDS + [
    LINES,
    cte("english", f"SELECT file FROM (SELECT lang, {C.document_columns(D)} FROM documents) WHERE lang = 'en'"),
    cte("classified_en", "SELECT * FROM classified WHERE file IN (SELECT file FROM english)"),
    cte("sublines_en", "SELECT * FROM sublines WHERE file IN (SELECT file FROM english)"),
    dictionary("eq_dict_en", "classified_en", "sublines_en"),
]
_PAIRED = _BASE + [XHTML, XTABLES, PAIRED]
_IDENTIFIED = _MEQ + [XHTML, XTABLES, PAIRED, OBJECTS, IDENTIFIED]
_INLINE = _BASE[:4] + [INLINE]
_REFS = _EQ + [LABELS, REFS, LABEL_REFS, MSE]

ORACLE: dict[str, str] = {}


def oracle(name: str, ctes: list[str], select: str) -> None:
    ORACLE[name] = f"WITH {', '.join(ctes)} {select}" if ctes else select


oracle("scan_tex", [TEX], "SELECT dir, file, doc_name, text FROM tex")
oracle("scan_parent", [TEX], "SELECT dir, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM tex GROUP BY dir")
oracle("scan_xhtml", [XHTML], "SELECT dir, doc_name, xhtml FROM xhtml")
oracle("file_categories", [CATEGORIES], "SELECT file, category FROM categories")
oracle("log_failures", [LOG], "SELECT file, message FROM log")
oracle(
    "sql_pairs",
    [cte("dump", f"SELECT lang, doc_id, {C.document_columns(D)} FROM documents")],
    r"SELECT doc_name AS name, 'x_{' || lang || '} = 1' || chr(10) AS equation FROM dump "
    r"UNION ALL SELECT 'y' || dir, '\frac{1}{' || doc_id || '}' FROM dump",
)
oracle(
    "atom_category", [cte("dump", f"SELECT lang, {C.document_columns(D)} FROM documents")],
    "SELECT file, lang || '.' || dir AS category FROM dump WHERE lang <> 'de'",
)
oracle("strip_comments", [TEX], f"SELECT file, {uncommented('text')} AS text FROM tex")
oracle("join_pct_lines", [TEX], "SELECT file, array_to_string(string_split(text, '%' || chr(10)), '') AS text FROM tex")
oracle("doc_body", [TEX, PLAIN], f"SELECT file, {body('plain')} AS body FROM plain")
oracle(
    "remove_inline", [TEX, cte("p", f"SELECT file, {parked('text')} AS p FROM tex")],
    "SELECT file, "
    + unparked(r"regexp_replace(p, '(?s)(\$\$[^^].*?\$\$)|\$[^$]+\$(?:\$[^$]+\$)*', '\1', 'g')")
    + " AS text FROM p",
)
oracle(
    "clean_inline",
    [TEX, PLAIN, cte("p", f"SELECT file, {parked('plain')} AS p FROM plain")],
    f"SELECT file, {unparked(separated('p'))} AS text FROM p",
)
oracle(
    "enforce_newlines", [TEX],
    rf"SELECT file, replace(replace(replace(text, '\\' || chr(10), {BREAK}), '\\', '\\' || chr(10)), {BREAK}, '\\' || chr(10)) AS text FROM tex",
)
oracle(
    "package_stmts", [TEX, PLAIN],
    r"SELECT file, array_to_string(regexp_extract_all(plain, '\\usepackage(?:\[[^\n]*?\])?\{[^\n]*?\}'), chr(10)) AS packages FROM plain",
)
oracle(
    "mask_roundtrip", [TEX],
    r"SELECT file, replace(replace(replace(replace(text, '\', '\\'), chr(10), '\n'), chr(9), '\t'), chr(13), '\r') AS masked, text FROM tex",
)
oracle(
    "css_href", [XHTML],
    "SELECT dir, doc_name, replace(replace(xhtml, '../../css/LaTeXML.css', 'LaTeXML.css'), 'x/ltx-article.css', 'ltx-article.css') AS xhtml FROM xhtml",
)
oracle(
    "doc_name", [cte("base", "SELECT page_id, url, string_split(url, '/')[-1] AS b FROM pages")],
    "SELECT page_id, url, CASE WHEN strpos(b, '.') > 1 THEN left(b, length(b) - strpos(reverse(b), '.')) ELSE b END AS name FROM base",
)
oracle("sanitized_docs", _BASE + [SANITIZED], "SELECT file, text FROM sanitized")
oracle("strip_latex_totals", _BASE, "SELECT CAST(sum(len(eqs)) AS BIGINT) AS n_equations FROM arrays")
oracle("math_docs", _BASE, "SELECT file, len(eqs) AS n_display FROM arrays WHERE len(eqs) > 0")
oracle("display_equations", _EQ, "SELECT file, eq_no, text FROM equations")
oracle(
    "doc_segments", _BASE,
    "SELECT file, 2 * (generate_subscripts(parts, 1) - 1) AS ord, 'text' AS kind, unnest(parts) AS text FROM arrays "
    "UNION ALL SELECT file, 2 * generate_subscripts(eqs, 1) - 1, 'equation', unnest(eqs) FROM arrays",
)
oracle(
    "eq_context", _BASE + [cte("n", "SELECT *, unnest(range(len(eqs))) AS eq_no FROM arrays")],
    "SELECT file, eq_no, eqs[eq_no + 1] AS text, parts[eq_no + 1] AS prevtext, parts[eq_no + 2] AS nexttext FROM n",
)
oracle("inline_equations", _INLINE, "SELECT file, eq_no, text FROM inline_rows")
oracle(
    "eq_env_counts", _KINDS,
    "SELECT env, multi AS is_multiline, true AS is_math, count(*) AS n FROM classified GROUP BY env, multi",
)
oracle("std_eq", _KINDS, "SELECT file, eq_no, std_eq FROM classified")
oracle(
    "sanitize_eq", _EQ,
    rf"SELECT file, eq_no, regexp_replace({no_layout('text')}, '(?:\\\\)+', '', 'g') AS text FROM equations",
)
oracle("flat_eq", _KINDS, "SELECT file, eq_no, flat_eq FROM classified")
oracle("sub_equations", _KINDS + [LINES], "SELECT file, eq_no, sub_no, eq_key FROM sublines")
oracle("eq_dict", _DICT, "SELECT eqid, eq_key, eq_text, n_occurrences FROM eq_dict")
oracle("meq_dict", _MEQ, "SELECT eqid, sub_ids, eq_text FROM meq_dict")
oracle("inline_dict", _INLINE + [INLINE_DICT], "SELECT eqid, eq_text, n_occurrences FROM inline_dict")
oracle(
    "resume_ids",
    _ENGLISH + [dictionary("eq_dict")],
    "SELECT eqid, eq_key, false AS is_new FROM eq_dict_en UNION ALL "
    "SELECT 'EQDS' || ((SELECT count(*) FROM eq_dict_en) + row_number() OVER (ORDER BY eq_number) - 1) || 'Q', eq_key, true "
    "FROM eq_dict WHERE eq_key NOT IN (SELECT eq_key FROM eq_dict_en)",
)
_RESUMED = [
    cte("eq_dict_ext",
        "SELECT eqid, eq_key, eq_number FROM eq_dict_en UNION ALL SELECT "
        "'EQDS' || ((SELECT count(*) FROM eq_dict_en) + row_number() OVER (ORDER BY eq_number) - 1) || 'Q', eq_key, "
        "(SELECT count(*) FROM eq_dict_en) + row_number() OVER (ORDER BY eq_number) - 1 "
        "FROM eq_dict WHERE eq_key NOT IN (SELECT eq_key FROM eq_dict_en)"),
    multi_dictionary("meq_dict_en", "eq_dict_en", "sublines_en"),
    multi_dictionary("meq_dict_all", "eq_dict_ext"),
]
oracle(
    "resume_meq_ids",
    _ENGLISH + [dictionary("eq_dict"), *_RESUMED],
    "SELECT eqid, sub_ids, eq_text, false AS is_new FROM meq_dict_en UNION ALL "
    "SELECT 'EQDM' || ((SELECT count(*) FROM meq_dict_en) + "
    "row_number() OVER (ORDER BY CAST(regexp_extract(eqid, '[0-9]+') AS BIGINT)) - 1) || 'Q', sub_ids, eq_text, true "
    "FROM meq_dict_all WHERE eq_text NOT IN (SELECT eq_text FROM meq_dict_en)",
)
oracle(
    "resume_inline_ids",
    _INLINE + [
        _ENGLISH[len(_KINDS) + 1],
        cte("inline_en",
            "SELECT text, min((file, eq_no)) AS first FROM inline_rows JOIN english USING (file) GROUP BY text"),
        cte("inline_new",
            "SELECT r.text, min((r.file, r.eq_no)) AS first FROM inline_rows r LEFT JOIN inline_en e ON e.text = r.text "
            "WHERE e.text IS NULL GROUP BY r.text"),
        cte("known", "SELECT row_number() OVER (ORDER BY first) - 1 AS n, text FROM inline_en"),
        cte("start", "SELECT count(*) AS s FROM inline_en"),
        cte("added", "SELECT s + row_number() OVER (ORDER BY first) - 1 AS n, text FROM inline_new CROSS JOIN start"),
    ],
    "SELECT 'EQIX' || n || 'Q' AS eqid, text AS eq_text, false AS is_new FROM known UNION ALL "
    "SELECT 'EQIX' || n || 'Q', text, true FROM added",
)
_ASSIGNED = cte(
    "assigned",
    "SELECT k.*, coalesce(d.eqid, m.eqid) AS eqid FROM classified k LEFT JOIN eq_dict d ON d.eq_key = k.flat_eq "
    "LEFT JOIN meq_dict m ON m.eq_text = k.text",
)
oracle(
    "enumerated_docs",
    _MEQ + [
        _ASSIGNED,
        cte("ids", "SELECT file, list(eqid ORDER BY eq_no) AS ids FROM assigned GROUP BY file"),
        cte("whole0", f"SELECT file, {parked('plain')} AS p FROM plain"),
        cte("whole", f"SELECT file, {separated('p')} AS w FROM whole0"),
        cte("cut", f"SELECT file, w, {body('w')} AS b FROM whole"),
        cte("filled",
            "SELECT c.file, c.w, c.b, i.ids, a.parts FROM cut c JOIN arrays a USING (file) LEFT JOIN ids i USING (file)"),
    ],
    "SELECT file, CASE WHEN b = '' THEN " + unparked("w") + " ELSE " + unparked("left(w, strpos(w, b) - 1)")
    + " || array_to_string(list_transform(range(len(parts)), lambda n: parts[n + 1] || coalesce(ids[n + 1], '')), '') || "
    + unparked("substr(w, strpos(w, b) + length(b))") + " END AS text, coalesce(len(ids), 0) AS n_replaced FROM filled",
)
oracle(
    "unmatched_equations",
    _ENGLISH + [
        multi_dictionary("meq_dict_en", "eq_dict_en", "sublines_en"),
    ],
    "SELECT file, eq_no, CASE WHEN text <> " + no_layout("text") + " THEN 'Multiline' ELSE 'Single line' END AS reason, text "
    "FROM classified k WHERE NOT EXISTS (SELECT 1 FROM eq_dict_en d WHERE d.eq_key = k.flat_eq) "
    "AND NOT EXISTS (SELECT 1 FROM meq_dict_en m WHERE m.eq_text = k.text)",
)
oracle(
    "enumerated_inline_docs",
    _INLINE + [
        INLINE_DICT,
        cte("ids",
            "SELECT r.file, list(d.eqid ORDER BY r.eq_no) AS ids FROM inline_rows r JOIN inline_dict d ON d.eq_text = r.text GROUP BY r.file"),
        cte("masked",
            rf"SELECT file, regexp_replace(c, '(?s)(\$\$.*?\$\$)|\$[^$]+\$', chr(64985) || '\1' || chr(64985), 'g') AS m FROM clean"),
        cte("pieces", "SELECT file, string_split(m, chr(64985)) AS ps FROM masked"),
        # Odd pieces are display math when not empty, else the place of an inline equation.
        cte("places",
            "SELECT file, n, ps[n] AS p, n % 2 = 0 AND ps[n] = '' AS is_inline FROM "
            "(SELECT file, ps, unnest(range(1, len(ps) + 1)) AS n FROM pieces)"),
        cte("ranked",
            "SELECT *, sum(CASE WHEN is_inline THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY n) AS nth FROM places"),
    ],
    "SELECT file, string_agg(CASE WHEN is_inline THEN ids[CAST(nth AS BIGINT)] ELSE " + lifted("p")
    + " END, '' ORDER BY n) AS text, len(any_value(ids)) AS n_replaced FROM ranked JOIN ids USING (file) GROUP BY file",
)
oracle(
    "dict_totals", _MEQ + [INLINE, INLINE_DICT],
    "SELECT 'single' AS kind, count(*) AS n FROM eq_dict UNION ALL SELECT 'multi', count(DISTINCT text) FROM classified WHERE multi "
    "UNION ALL SELECT 'inline', count(DISTINCT text) FROM inline_rows",
)
oracle(
    "eqid_subset", _DICT,
    "SELECT eqid, eq_text FROM eq_dict WHERE eq_number % 3 = 0 AND eq_number / 3 IN (SELECT doc_id FROM documents)",
)
_MASKED = r"replace(replace(replace(replace({0}, '\', '\\'), chr(10), '\n'), chr(9), '\t'), chr(13), '\r')"
oracle(
    "write_eq_tsv", _MEQ,
    "SELECT eqid || chr(9) || " + _MASKED.format("eq_text") + " AS value FROM eq_dict UNION ALL "
    "SELECT eqid || chr(9) || sub_ids || chr(9) || " + _MASKED.format("eq_text") + " FROM meq_dict",
)
oracle(
    "write_inline_tsv", _INLINE + [INLINE_DICT],
    "SELECT eqid || chr(9) || " + _MASKED.format("eq_text") + " AS value FROM inline_dict",
)
oracle("write_texts", [TEX], "SELECT dir, file, doc_name, text FROM tex")
oracle("write_categories", [CATEGORIES], "SELECT file, category FROM categories")
oracle(
    "inline_segments",
    _INLINE + [
        # Between two marks: display math, a third mark, inline math; one of both is empty.
        cte("marked",
            rf"SELECT file, regexp_replace(c, '(?s)(\$\$.*?\$\$)|(\$[^$]+\$)', "
            r"chr(64985) || '\1' || chr(64986) || '\2' || chr(64985), 'g') AS m FROM clean"),
        cte("bits", "SELECT file, string_split(m, chr(64985)) AS ps FROM marked"),
        cte("places",
            "SELECT file, n, n % 2 = 0 AND starts_with(ps[n], chr(64986)) AS is_inline, replace(ps[n], chr(64986), '') AS p "
            "FROM (SELECT file, ps, unnest(range(1, len(ps) + 1)) AS n FROM bits)"),
        cte("ranked",
            "SELECT *, is_inline AND NOT contains(p, chr(10)) AS single, "
            "sum(is_inline::INT) OVER (PARTITION BY file ORDER BY n) AS k, "
            "sum((is_inline AND NOT contains(p, chr(10)))::INT) OVER (PARTITION BY file ORDER BY n) AS s FROM places"),
    ],
    "SELECT file, CAST(k + s AS BIGINT) AS ord, 'text' AS kind, " + lifted("string_agg(p, '' ORDER BY n)")
    + " AS text FROM ranked WHERE NOT is_inline GROUP BY file, k, s UNION ALL "
    "SELECT file, CAST(k + s - 1 AS BIGINT), 'equation', " + lifted("p") + " FROM ranked WHERE single",
)
oracle(
    "read_eq_tsv", _MEQ,
    "SELECT eqid, '' AS sub_ids, eq_text FROM eq_dict UNION ALL SELECT eqid, sub_ids, eq_text FROM meq_dict",
)
oracle(
    "xhtml_equations", [XHTML, XTABLES],
    "SELECT dir, doc_name, generate_subscripts(mathml, 1) - 1 AS eq_no, unnest(mathml) AS mathml FROM xtables",
)
oracle(
    "tex_xhtml_join", [TEX, XHTML],
    "SELECT t.file, x.xhtml IS NOT NULL AS converted, coalesce(length(x.xhtml), 0) AS xhtml_chars "
    "FROM tex t LEFT JOIN xhtml x USING (dir, doc_name)",
)
oracle("xhtml_missing", [TEX, XHTML], "SELECT dir, doc_name FROM tex EXCEPT SELECT dir, doc_name FROM xhtml")
oracle(
    "equation_objects", _PAIRED + [OBJECTS],
    "SELECT file, eq_no, text, type, itemtype, prevtext, nexttext, index, pos, mathml FROM objects",
)
_MISMATCH = (
    "SELECT 'pair' AS op, file, reason, CASE WHEN reason = 'missing_xhtml' THEN '' ELSE "
    "'LaTeX - ' || len(eqs) || ', XHTML - ' || len(mathml) END AS detail FROM paired WHERE reason IS NOT NULL"
)
oracle("eq_count_mismatch", _PAIRED, f"SELECT * FROM ({_MISMATCH}) WHERE reason <> 'missing_xhtml'")
oracle(
    "read_eq_json", _PAIRED + [OBJECTS],
    "SELECT file, eq_no, text, prevtext, index, pos, mathml FROM objects",
)
oracle(
    "eq_docs", _IDENTIFIED,
    "SELECT eqid, file, count(*) AS n FROM identified WHERE eqid IS NOT NULL GROUP BY eqid, file",
)
oracle(
    "eq_mathml", _IDENTIFIED,
    "SELECT eqid, arg_min(mathml, (file, eq_no)) AS mathml FROM identified WHERE eqid IS NOT NULL AND mathml <> '' GROUP BY eqid",
)
oracle(
    "eq_doc_tsv",
    _IDENTIFIED + [
        cte("per_file", "SELECT eqid, file, count(*) AS n FROM identified GROUP BY eqid, file"),
        cte("counts", "SELECT eqid, split_part(file, '/', 1) AS dir, string_agg(file || ':' || n, ',' ORDER BY file) AS documents FROM per_file GROUP BY ALL"),
        cte("firsts", "SELECT eqid, arg_min(mathml, (file, eq_no)) AS mathml FROM identified WHERE mathml <> '' GROUP BY eqid"),
        cte("texts", "SELECT eqid, eq_text FROM eq_dict UNION ALL SELECT eqid, eq_text FROM meq_dict"),
    ],
    "SELECT eqid || chr(9) || " + _MASKED.format("eq_text") + " || chr(9) || "
    + _MASKED.format("'\"' || coalesce(mathml, '') || '\"'")
    + " || chr(9) || coalesce(documents, '') || chr(9) || coalesce(dir, '') AS value FROM texts LEFT JOIN firsts USING (eqid) LEFT JOIN counts USING (eqid)",
)
oracle(
    "coverage",
    _BASE + [
        XHTML, LOG,
        cte("t", "SELECT unnest(regexp_extract_all(xhtml, '(?s)<table.*?</table>')) AS tab FROM xhtml"),
        cte("e", "SELECT count(*) FILTER (contains(tab, 'ltx_ERROR')) AS bad, count(*) AS total FROM t"),
        cte("f",
            "SELECT count(*) FILTER (message = ' Conversion failed') AS n_failed, "
            "count(*) FILTER (message = ' MathML conversion failed - timeout') AS n_timed_out FROM log"),
        cte("m", "SELECT count(*) AS docs FROM arrays WHERE len(eqs) > 0"),
    ],
    "SELECT n_failed, n_timed_out, round((1 - bad / total) * 100, 2) AS equation_coverage, "
    "round((1 - (n_failed + n_timed_out) / docs) * 100, 2) AS document_coverage FROM e, f, m",
)
oracle("eq_labels", _EQ + [LABELS], "SELECT file, eq_no, nth + CAST(sum(1) OVER (PARTITION BY file ORDER BY eq_no, nth) - 1 - nth AS BIGINT) AS label_no, label FROM labels_of")
oracle("eq_refs", _EQ + [REFS], "SELECT file, ref_no, label FROM refs")
oracle("label_refs", _EQ + [LABELS, REFS, LABEL_REFS], "SELECT file, ref_no, label, eq_no, text FROM label_refs")
oracle("eq_ref_counts", _REFS, "SELECT file, text, n_refs FROM ref_counts")
oracle("mse", _REFS, "SELECT file, text, n_refs FROM mse")
oracle("mse_too_long", _REFS, "SELECT file, length(text) AS n_chars FROM mse WHERE length(text) > 1500")
oracle("mse_bibcode", _REFS + [BIBCODES], "SELECT file, bibcode, text FROM mse JOIN bibcodes USING (doc_name)")
oracle(
    "mse_status", _REFS + [BIBCODES],
    "SELECT t.file, CASE WHEN bibcode IS NULL THEN 'no bibcode' WHEN m.text IS NULL THEN 'no equations' "
    "WHEN length(m.text) > 1500 THEN 'MSE too long' WHEN n_refs = 0 THEN 'first equation' "
    "ELSE n_refs || ' occurrences' END AS status FROM tex t LEFT JOIN bibcodes b ON b.doc_name = t.doc_name "
    "LEFT JOIN mse m ON m.file = t.file",
)
oracle("packages", [TEX, PACKAGES], "SELECT file, package_no, package FROM packages")
oracle("package_freq", [TEX, PACKAGES], "SELECT package, count(*) AS n FROM packages GROUP BY package")
oracle("package_top50", [TEX, PACKAGES], "SELECT package, count(*) AS n FROM packages GROUP BY package ORDER BY n DESC, package LIMIT 50")
oracle("legacy_eq_counts", [TEX, LEGACY], "SELECT file, n_legacy FROM legacy")
oracle("mathless_docs", [TEX, LEGACY], r"SELECT file FROM legacy WHERE n_legacy = 0 AND contains(text, '\begin{document}')")
oracle(
    "corpus_eq_stats", [TEX, LEGACY],
    "SELECT count(*) FILTER (n_legacy = 0) AS n_without, count(*) FILTER (n_legacy > 0) AS n_with, "
    "avg(n_legacy) FILTER (n_legacy > 0) AS mean_equations, CAST(sum(n_legacy) AS BIGINT) AS n_equations FROM legacy",
)
oracle(
    "eqs_by_category", [TEX, LEGACY, CATEGORIES],
    "SELECT category, count(*) AS n_docs, CAST(sum(n_legacy) AS BIGINT) AS n_equations FROM legacy LEFT JOIN categories USING (file) GROUP BY category",
)
oracle(
    "category_mismatch", [TEX, CATEGORIES],
    "SELECT coalesce(t.file, c.file) AS file, CASE WHEN c.file IS NULL THEN 'no category' ELSE 'no file' END AS reason "
    "FROM tex t FULL JOIN categories c ON c.file = t.file WHERE t.file IS NULL OR c.file IS NULL",
)
_NO_BODY = "SELECT 'body' AS op, file, 'Missing body' AS reason, '' AS detail FROM bodies WHERE body = ''"
oracle("reject_no_body", _BASE, _NO_BODY)
oracle(
    "rejects_summary", _PAIRED + [LOG],
    f"SELECT op, reason, count(*) AS n FROM ({_NO_BODY} UNION ALL {_MISMATCH} UNION ALL "
    "SELECT 'convert', file, trim(message), '' FROM log) GROUP BY op, reason",
)
oracle(
    "quarantine_docs", _PAIRED + [SANITIZED],
    "SELECT file, text FROM sanitized WHERE file IN (SELECT file FROM paired WHERE reason LIKE 'LaTeX%')",
)
oracle("pending_docs", [TEX, XHTML], "SELECT file, doc_name FROM tex WHERE doc_name NOT IN (SELECT doc_name FROM xhtml)")

# --- Prose, JSON ------------------------------------------------------------


def _stripped(x: str) -> str:
    steps = (
        (r"\\begin\{title\}([^\n]+?)\\end\{title\}", r"\1"),
        (r"(?s)\\begin\{picture\}.+?\\end\{picture\}", ""),
        (r"\\def[^\n]+", ""),
        (r"\\section\*?\{([^\n]+?)\}", r"\1"),
        (
            r"\\def[^\n]+|\\@ifundefined[^\n]+|\\begin\{thebibliography\}(?s:.+?)\\end\{thebibliography\}"
            r"|\\begin\{eqnarray\*?\}(?s:.+?)\\end\{eqnarray\*?\}"
            r"|\\[0-9A-Za-zÀ-ÿ_@]+(?:\[[^\n]+?\])?(?:\{[^\n]+?\})*|\[[^\n]+?\](?:\{[^\n]+?\})?|\{cm\}",
            "",
        ),
        (r"[{}]", ""), (r"\(\)", ""), (r"\\", ""), (r"\n{3,}", ""), (r"^\s+|\s+$", ""),
    )
    for pattern, new in steps:
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return x


oracle(
    "strip_latex",
    _BASE + [cte("bare_text",
                 "SELECT file, len(eqs) AS n_display, list_reduce(list_prepend(text, eqs), "
                 "lambda a, e: replace(a, e, '')) AS t FROM arrays")],
    f"SELECT file, {_stripped('t')} AS text, n_display FROM bare_text",
)
oracle(
    "equations_json", _PAIRED + [OBJECTS],
    "SELECT file, CAST(to_json(list({'text': text, 'type': type, 'itemtype': itemtype, 'prevtext': prevtext, "
    "'nexttext': nexttext, 'file': file, 'index': index, 'pos': pos, 'mathml': mathml} ORDER BY eq_no)) AS VARCHAR) AS json "
    "FROM objects GROUP BY file",
)

# --- Submissions and macros -------------------------------------------------

oracle(
    "unwrap_groups", [TEX],
    r"SELECT file, length(replace(replace(replace(text, '\begin{math}', '{ {\begin{math}} }'), '\[ ', '{\[ } '), '$$ ', '{{$$}} ')) "
    "AS n_wrapped, text FROM tex",
)


def _open(marks: str, opening: str) -> str:
    """Openings left open: the last running sum above the lowest one."""
    return (
        f"SELECT file, arg_max(s, n) - least(0, min(s)) AS left_open FROM (SELECT file, n, "
        f"sum(CASE WHEN m = '{opening}' THEN 1 ELSE -1 END) OVER (PARTITION BY file ORDER BY n) AS s FROM "
        f"(SELECT file, unnest(found) AS m, generate_subscripts(found, 1) AS n FROM "
        f"(SELECT file, regexp_extract_all(text, '{marks}') AS found FROM tex))) GROUP BY file"
    )


oracle(
    "unbalanced_docs",
    [TEX, cte("braces", _open(r"[{}]", "{")), cte("brackets", _open(r"[\[\]]", "["))],
    "SELECT * FROM (SELECT t.file, CAST(coalesce(a.left_open, 0) AS BIGINT) AS open_braces, "
    "CAST(coalesce(b.left_open, 0) AS BIGINT) AS open_brackets FROM tex t LEFT JOIN braces a USING (file) "
    "LEFT JOIN brackets b USING (file)) WHERE open_braces > 0 OR open_brackets > 0",
)
oracle(
    "brace_groups",
    [
        TEX,
        cte("signs",
            r"SELECT file, string_split(regexp_replace(text, '(?s)\\[\\{}]', '  ', 'g'), '') AS cs FROM tex"),
        cte("marks",
            "SELECT * FROM (SELECT file, unnest(cs) AS ch, generate_subscripts(cs, 1) - 1 AS pos FROM signs) WHERE ch IN ('{', '}')"),
        cte("sums",
            "SELECT *, CAST(sum(CASE WHEN ch = '{' THEN 1 ELSE -1 END) OVER (PARTITION BY file ORDER BY pos) AS BIGINT) AS s FROM marks"),
        cte("levels", "SELECT *, CASE WHEN ch = '{' THEN s ELSE s + 1 END AS depth FROM sums"),
        cte("closed",
            "SELECT *, min(CASE WHEN ch = '}' THEN pos END) OVER (PARTITION BY file, depth ORDER BY pos "
            "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS close_pos FROM levels"),
    ],
    "SELECT file, pos AS open_pos, coalesce(close_pos, -1) AS close_pos, depth FROM closed WHERE ch = '{'",
)
oracle(
    "bracket_groups",
    [
        TEX,
        cte("signs",
            r"SELECT file, string_split(regexp_replace(text, '(?s)\\[\\\[\]]', '  ', 'g'), '') AS cs FROM tex"),
        cte("marks",
            "SELECT * FROM (SELECT file, unnest(cs) AS ch, generate_subscripts(cs, 1) - 1 AS pos FROM signs) WHERE ch IN ('[', ']')"),
        cte("sums",
            "SELECT *, CAST(sum(CASE WHEN ch = '[' THEN 1 ELSE -1 END) OVER (PARTITION BY file ORDER BY pos) AS BIGINT) AS s FROM marks"),
        cte("levels", "SELECT *, CASE WHEN ch = '[' THEN s ELSE s + 1 END AS depth FROM sums"),
        cte("closed",
            "SELECT *, min(CASE WHEN ch = ']' THEN pos END) OVER (PARTITION BY file, depth ORDER BY pos "
            "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS close_pos FROM levels"),
    ],
    "SELECT file, pos AS open_pos, coalesce(close_pos, -1) AS close_pos, depth FROM closed WHERE ch = '['",
)

SUBMISSIONS = cte("files", C.submissions_sql(D)) + ", " + cte(
    "mains",
    rf"SELECT folder, CAST(substr(folder, 2) AS BIGINT) AS d, {uncommented('text || chr(10)')} AS plain FROM files "
    r"WHERE rel_path = 'main.tex' AND contains(text, '\end{document}')",
)
INPUTS = cte(
    "inputs",
    "SELECT m.folder, m.d, " + uncommented(
        r"replace(replace(replace(m.plain, '\input{part}', p.text), '\input sec', chr(10) || s.text), '\input{lost}', '')"
    ) + " AS text FROM mains m JOIN files p ON p.folder = m.folder AND p.rel_path = 'part.tex' "
    "JOIN files s ON s.folder = m.folder AND s.rel_path = 'sec.tex'",
)
_DEFINED = (
    (r"\foo", "CASE WHEN d % 10 = 4 THEN 'renewcommand' ELSE 'newcommand' END", "", 1, "", "",
     "CASE WHEN d % 10 = 4 THEN '{g(#1)}' ELSE '{f(#1)}' END", "true"),
    (r"\two", "'newcommand'", "*", 2, "", "", r"'{\foo{#2}-#1}'", "true"),
    (r"\opt", "'newcommand'", "", 2, "[k]", "", "'{#1+#2}'", "true"),
    (r"\bar", "'def'", "", 0, "", "", r"'{\foo{b}}'", "true"),
    (r"\pair", "'def'", "", 2, "", "(#1,#2)", "'{<#1|#2>}'", "true"),
    (r"\half", "'renewcommand'", "", 0, "", "", r"'{\frac{1}{2}}'", "true"),
    (r"\rank", "'DeclareMathOperator'", "", 0, "", "", r"'\operatorname{rank}'", "true"),
    (r"\argmax", "'DeclareMathOperator'", "*", 0, "", "", r"'\operatorname*{arg\,max}'", "true"),
    (r"\barred", "'newcommand'", "", 0, "", "", r"'{\bar\half}'", "true"),
    (r"\ping", "'def'", "", 0, "", "", r"'{\pong}'", "d % 31 = 2"),
    (r"\pong", "'def'", "", 0, "", "", r"'{\ping}'", "d % 31 = 2"),
    (r"\selfy", "'def'", "", 0, "", "", "''", "d % 37 = 3"),
    (r"\me", "'newcommand'", "", 0, "", "", "'{b  c}'", "d % 37 = 3"),
)
MACROS = cte(
    "macros",
    " UNION ALL ".join(
        f"SELECT folder, d, {kind} AS kind, '{star}' AS star, '{name}' AS name, CAST({n} AS BIGINT) AS n_args, "
        f"'{default}' AS default_arg, '{params}' AS params, {body_} AS body FROM mains WHERE {condition}"
        for name, kind, star, n, default, params, body_, condition in _DEFINED
    ),
)
oracle(
    "main_files", [SUBMISSIONS], "SELECT folder, 'main.tex' AS rel_path FROM mains",
)
_EDGES = cte(
    "edges",
    "SELECT folder, 0 AS n, 'part.tex' AS target FROM mains UNION ALL SELECT folder, 1, 'sec.tex' FROM mains "
    "UNION ALL SELECT folder, 2, 'lost.tex' FROM mains WHERE d % 9 = 4",
)
oracle("input_edges", [SUBMISSIONS, _EDGES], "SELECT folder, CAST(n AS BIGINT) AS n, target FROM edges")
oracle(
    "missing_inputs", [SUBMISSIONS, _EDGES],
    "SELECT folder, target, CAST(n AS BIGINT) AS n FROM edges WHERE (folder, target) NOT IN (SELECT (folder, rel_path) FROM files)",
)
oracle("expand_inputs", [SUBMISSIONS, INPUTS], "SELECT folder, 'main.tex' AS rel_path, text FROM inputs")
oracle(
    "macro_kind_counts", [SUBMISSIONS, MACROS],
    "SELECT kind, star, CAST(sum(n) AS BIGINT) AS n FROM (SELECT kind, star, count(*) AS n FROM macros GROUP BY kind, star "
    "UNION ALL SELECT 'newcommand', '', count(*) FROM macros WHERE name = '\\foo' AND kind = 'renewcommand') GROUP BY kind, star",
)
oracle(
    "macro_defs", [SUBMISSIONS, MACROS],
    "SELECT folder, kind, star, name, n_args, default_arg, params, body FROM macros",
)
oracle(
    "math_operators", [SUBMISSIONS, MACROS],
    "SELECT folder, name, body AS expansion FROM macros WHERE kind = 'DeclareMathOperator'",
)
oracle(
    "macro_usage",
    [
        SUBMISSIONS, INPUTS, MACROS,
        cte("tokens",
            "SELECT folder, unnest(regexp_extract_all(substr(text, strpos(text, '\\begin{document}')), "
            r"'(?s)\\(?:[A-Za-z@*]+|.)')) AS name FROM inputs"),
    ],
    "SELECT t.folder, t.name, count(*) AS n_uses FROM tokens t JOIN macros m ON m.folder = t.folder AND m.name = t.name "
    "GROUP BY t.folder, t.name",
)
oracle(
    "macro_deps",
    [
        SUBMISSIONS, MACROS,
        cte("edges",
            "SELECT a.folder, a.name, b.name AS depends_on FROM macros a JOIN macros b ON a.folder = b.folder "
            "WHERE regexp_matches(a.body, replace(b.name, '\\', '\\\\') || '([^A-Za-z@*]|$)')"),
        "RECURSIVE_closure",
    ],
    "SELECT folder, name, depends_on FROM closure",
)
ORACLE["macro_deps"] = ORACLE["macro_deps"].replace("WITH ", "WITH RECURSIVE ", 1).replace(
    "RECURSIVE_closure",
    "closure AS (SELECT folder, name, depends_on FROM edges UNION "
    "SELECT c.folder, c.name, e.depends_on FROM closure c JOIN edges e ON e.folder = c.folder AND e.name = c.depends_on)",
)


def _expansion(x: str) -> str:
    mark = "chr(64990)"
    x = rf"replace({x}, '\isundefined{{\foo}}', {mark})"
    for old, new in (
        (r"\barred", r"{\bar\half}"), (r"\bar", r"{\foo{b}}"), (r"\half", r"{\frac{1}{2}}"),
        (r"\rank", r"\operatorname{rank}"), (r"\selfy", ""), (r"\me" + "\n", "{b  c}\n"),
    ):
        x = f"replace({x}, '{old}', '{new}')"
    x = rf"regexp_replace({x}, '\\pair\(([^,]*),([^)]*)\)', '{{<\1|\2>}}', 'g')"
    x = rf"regexp_replace({x}, '\\two(\{{[^{{}}]*\}})(\{{[^{{}}]*\}})', '{{\\foo{{\2}}-\1}}', 'g')"
    x = rf"regexp_replace({x}, '\\opt\[([^\]]*)\](\{{[^{{}}]*\}})', '{{\1+\2}}', 'g')"
    x = rf"regexp_replace({x}, '\\opt(\{{[^{{}}]*\}})', '{{k+\1}}', 'g')"
    x = (
        rf"regexp_replace({x}, '\\foo(\{{\{{[^{{}}]*\}}\}}|\{{[^{{}}]*\}})', "
        r"CASE WHEN d % 10 = 4 THEN '{g(\1)}' ELSE '{f(\1)}' END, 'g')"
    )
    return rf"replace({x}, {mark}, '\isundefined{{\foo}}')"


EXPANDED = cte(
    "bodies_only",
    r"SELECT folder, d, '\documentclass{article}' || chr(10) || chr(10) || substr(text, strpos(text, '\begin{document}')) AS text FROM inputs",
) + ", " + cte(
    "expanded",
    "SELECT folder, CASE WHEN d % 31 = 2 THEN 'not converged' ELSE 'complete' END AS status, "
    r"regexp_replace(CASE WHEN d % 31 = 2 THEN text ELSE " + _expansion("text")
    + r" END, '\n{3,}', chr(10) || chr(10), 'g') AS text FROM bodies_only",
)
oracle("expand_macros", [SUBMISSIONS, INPUTS, EXPANDED], "SELECT folder, status, text FROM expanded")
oracle(
    "quarantine_submissions", [SUBMISSIONS, INPUTS, EXPANDED],
    "SELECT folder, e.status, i.text FROM inputs i JOIN expanded e USING (folder) WHERE e.status <> 'complete'",
)
oracle(
    "macro_outcomes", [SUBMISSIONS, INPUTS, EXPANDED],
    "SELECT status, count(*) AS n FROM (SELECT status FROM expanded UNION ALL SELECT 'no main file' FROM "
    "(SELECT folder FROM files EXCEPT SELECT folder FROM mains)) GROUP BY status",
)

oracle("stream_packages", [TEX, PACKAGES], "SELECT package, count(*) AS n FROM packages GROUP BY package")
oracle("stream_eq_keys", _DICT, "SELECT eq_key FROM eq_dict")
oracle(
    "stream_eq_ids", _DICT,
    "SELECT count(*) AS n, count(*) AS n_ids, count(*) - 1 AS last FROM eq_dict",
)
oracle("stream_environments", _KINDS, "SELECT env, count(*) AS n FROM classified GROUP BY env")
oracle(
    "stream_inline_ids", _INLINE,
    "SELECT count(DISTINCT text) AS n, count(DISTINCT text) AS n_ids, count(DISTINCT text) - 1 AS last FROM inline_rows",
)
oracle(
    "stream_meq_ids", _KINDS + [LINES],
    "SELECT DISTINCT text AS eq_text, sub_no, eq_key FROM sublines",
)
oracle("scan_folder", [TEX], "SELECT dir, replace(file, '.tex', '.txt') AS file, text FROM tex")
oracle(
    "scan_submissions", [SUBMISSIONS],
    "SELECT folder, 'src/' || rel_path AS rel_path, text FROM files WHERE rel_path LIKE '%.tex'",
)
oracle(
    "read_eq_json_files", _PAIRED + [OBJECTS],
    "SELECT file, text, prevtext, index, pos, mathml FROM objects",
)
oracle(
    "rejects_table", _PAIRED + [LOG],
    f"SELECT run, op, file, reason, detail FROM ({_NO_BODY} UNION ALL {_MISMATCH} UNION ALL "
    "SELECT 'convert', file, trim(message), '' FROM log) CROSS JOIN (VALUES ('one'), ('two')) runs(run)",
)
