"""Regular expressions of the LaTeX dialect, written for ``java.util.regex``.

Rules kept throughout:

* literal braces are escaped, ``(?s)`` stands once at the front;
* loops over groups are possessive, so a long run never deepens the JVM stack;
* a pattern opens with the character it needs, and looks back after it, so that
  the search passes over other characters at the cost of one comparison;
* ``[^\\n]`` is used where "any character of one line" is meant (Java's ``.``
  also stops at CR, U+0085, U+2028 and U+2029).
"""

# --- Fixed values: names that define the recognised LaTeX ------------------
DISPLAY_ENVIRONMENTS = ("equation", "multline", "gather", "align", "flalign", "math", "eqnarray")
MULTILINE_ENVIRONMENTS = ("multline", "gather", "align", "flalign", "eqnarray")
LAYOUT_WORDS_EARLY = ("nonumber", "tag")
LAYOUT_WORDS_LATE = ("times", "lefteqn", "righteqn", "qedhere")
MACRO_LETTERS = "A-Za-z@*"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
MAX_RENDERED_LENGTH = 1500
TOP_PACKAGES = 50

# Unicode noncharacters are reserved for internal use by a program, so they
# never stand in a text: they hold the place of an escaped character.
PARKED_DOLLAR = "\ufdd0"
PARKED_PERCENT = "\ufdd1"
PARKED_BACKSLASHES = "\ufdd2"
PARKED_DOUBLE_DOLLAR = "\ufdd4"
# Marks a place that one pass over a text cannot settle.
UNSETTLED = "\ufdd5"

_any_env = "|".join(DISPLAY_ENVIRONMENTS)
_multi_env = "|".join(MULTILINE_ENVIRONMENTS)

# --- Fixed values: the patterns that define what is found and removed --------

# Comments.
COMMENT_TAIL = r"%(?<!\\%)[^\n]*+"
COMMENT_ENVIRONMENT = r"(?s)\\begin\{comment\}.*?\\end\{comment\}"

# Document frame.
BODY = r"(?s)\\begin\{document\}.*?\\end\{document\}"
BODY_BEGIN, BODY_END = r"\\begin\{document\}", r"\\end\{document\}"
DOCUMENT_CLASS = r"\\documentclass(?:\[[^\n]*?\])?\{[^\n]*?\}"
USE_PACKAGE_ANY_LINE = r"(?s)\\usepackage(?:\[.*?\])?\{.*?\}"
USE_PACKAGE_ONE_LINE = r"\\usepackage(?:\[[^\n]*?\])?\{[^\n]*?\}"
PACKAGE_NAMES = r"\\usepackage(?:\[[^\n]*?\])*\{([^\n]*?)\}"

# Math.  Display math is one of seven environments (star optional at either
# end), ``\[..\]`` not preceded by a backslash, or ``$$..$$`` not opening with ^.
DISPLAY_MATH = (
    r"(?s)[\\$](?:(?<=\\)(?:begin\{(" + _any_env + r")\*?\}.*?\\end\{\1\*?\}"
    r"|\[(?<!\\\\\[).*?\\\])"
    r"|(?<=\$)\$[^\^].*?\$\$)"
)
# Cuts a text before each place where display math may open.
DISPLAY_OPENS = r"(?=[\\$])(?=\\begin\{|\\\[|\$\$)"
DISPLAY_PARTS = (
    r"(?s)^(?:\\begin\{(" + _any_env + r")\*?\}(.*?)\\end\{\1\*?\}"
    r"|\\\[(.*?)\\\]"
    r"|\$\$([^\^].*?)\$\$).*$"
)
STARTS_ENVIRONMENT = r"(?s)^\\begin\{(" + _any_env + r")\*?\}.*?\\end\{\1\*?\}"
STARTS_MULTILINE = r"(?s)^\\begin\{(" + _multi_env + r")\*?\}.*?\\end\{\1\*?\}"
STARTS_BRACKET = r"(?s)^\\\[.*?\\\]"
STARTS_DOLLARS = r"(?s)^\$\$[^\^].*?\$\$"
DOUBLE_DOLLAR = r"(?s)(\$\$[^\^].*?\$\$)"
INLINE_RUN = r"(\$(?<=[^$]\$)[^$]++\$(?:\$[^$]++\$)*+)(?=[^$])"
# Goes from dollar to dollar, with an empty group where none opens a run: faster than a search at each character.
NEXT_INLINE_RUN = r"[^$]*(?:" + INLINE_RUN + r"|\$|\z)"
INLINE_ONE = r"\$[^\n]+?\$"

# What opens or ends display math, wherever it stands, and two pairs of dollars.
DISPLAY_EDGE = r"\\[\[\]]|\\(?:begin|end)\{|(?s)\$\$.+\$\$"
DOLLAR_PAIRS = r"(?s)\$\$.+\$\$"
ONE_DOLLAR_DISPLAY = r"^[^$]*+\$\$[^$^][^$]*+\$\$[^$]*+$"
# Signs that seldom stand in an equation; none is special in a character class.
SELDOM_IN_MATH = ",.\n;:?!%\""

# Layout removed from an equation, in the order it is removed.
_no_letter = r"(?![" + MACRO_LETTERS + r"])"
LAYOUT = (
    r"\\(?:" + "|".join(LAYOUT_WORDS_EARLY) + r")" + _no_letter,
    r"(?<!\\)&",
    r"\\hspace\{[^\n]+?\}",
    r"\\(?:" + "|".join(LAYOUT_WORDS_LATE) + r")" + _no_letter,
    r"\\label\{[^\n]+?\}",
    r"\\q?quad",
)
ANY_LAYOUT = "|".join(LAYOUT)
LINE_BREAKS = r"(?:\\\\)++"
LINE_BREAK_OPEN = r"\\\\(?!\n)"

# Keys and references.
LABEL = r"\\label\{([^\n]*?)\}"
EQREF = r"\\eqref\{([^\n]*?)\}"
REF = r"\\ref\{([^\n]*?)\}"

# Converted documents.
XHTML_TABLE = r"(?s)<table.*?</table>"
XHTML_MATH = r"(?s)<math.*?</math>"
XHTML_ERROR = "ltx_ERROR"
CSS_LATEXML = r'(href=")[^\n]*?(LaTeXML\.css")'
CSS_ARTICLE = r'(href=")[^\n]*?(ltx-article\.css")'

# Prose stripping, in order: (pattern, replacement).
STRIP_STEPS = (
    (r"\\begin\{title\}([^\n]+?)\\end\{title\}", "$1"),
    (r"(?s)\\begin\{picture\}.+?\\end\{picture\}", ""),
    (r"\\def[^\n]+", ""),
    (r"\\section\*?\{([^\n]+?)\}", "$1"),
    (
        r"\\def[^\n]+"
        r"|\\@ifundefined[^\n]+"
        r"|\\begin\{thebibliography\}(?s:.+?)\\end\{thebibliography\}"
        r"|\\begin\{eqnarray\*?\}(?s:.+?)\\end\{eqnarray\*?\}"
        r"|(?U)\\[\w@]+(?:\[[^\n]+?\])?(?:\{[^\n]+?\})*+"
        r"|\[[^\n]+?\](?:\{[^\n]+?\})?"
        r"|\{cm\}",
        "",
    ),
    (r"[{}]", ""),
    (r"\(\)", ""),
    (r"\\", ""),
    (r"\n{3,}", ""),
)

# Older equation counter: ten patterns, each counted on its own.
LEGACY_COMMENT_LINE = r"(?md)^%[^\n]*"
LEGACY_COMMENT_TAIL = r"([^\\])%[^\n]*"
LEGACY_COMMENT_ENVIRONMENT = r"\\begin\{comment\}[^\n]*?\\end\{comment\}"
LEGACY_MATH = (
    r"(?s)\\begin\{equation\}.*?\\end\{equation\}",
    r"(?s)\\begin\{multline\}.*?\\end\{multline\}",
    r"(?s)\\begin\{gather\}.*?\\end\{gather\}",
    r"(?s)\\begin\{align\}.*?\\end\{align\}",
    r"(?s)\\begin\{flalign\*\}.*?\\end\{flalign\*\}",
    r"(?s)\\begin\{math\}.*?\\end\{math\}",
    r"(?s)[^\\]\\\[.*?\\\]",
    r"(?s)\$\$[^\^].*?\$\$",
    r"(?s)[^\\]\$.*?\$",
    r"(?s)\\\(.*?\\\)",
)

# Submissions and macros.
INPUT_TARGET = r"\\input\s*\{\s*([^\s\\]+)\}|\\input(?![A-Za-z@])\s*([^\s\\]+)"
GROUPED_DELIMITER = (
    r"(?<!\\)\{\s*((?:\\begin|\\end|\\\[|\\\])(?:\{[" + MACRO_LETTERS + r"]+\})?|\${1,2})(?<!\\)\s*\}"
)
GROUPED_DEFINITION = (
    r"(?<!\\)\{\s*(\\(?:(?:re)?newcommand\*?|g?def|DeclareMathOperator\*?))(?<!\\)\s*\}"
)
IS_UNDEFINED = r"\\isundefined\s*\{\s*\\[" + MACRO_LETTERS + r"]*\s*\}"
MACRO_NAME_END = _no_letter
