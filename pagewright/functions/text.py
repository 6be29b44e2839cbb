"""Text-cleaning Column expressions (page cleaning, hyphen repair, article cleaning).

Every function takes and returns a ``pyspark.sql.Column`` so it compiles into
the surrounding projection: no Python runs per row.  Line-level logic uses
``split`` + higher-order ``filter``/``transform`` on the array of one page or
one article; that array never spans more than one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.regex import DIGIT, SPLITLINES, STRIP, WORD, WS

# ---------------------------------------------------------------------------
# header/footer line patterns, matched at the start of the
# stripped line, case-sensitive (written here in Python notation; ``to_portable``
# spells out the classes).
# ---------------------------------------------------------------------------
HEADER_FOOTER_PATTERNS = [
    r"^Page\s+\d+(\s+of\s+\d+)?$",
    r"^\d+$",
    r"^[A-Za-z]+\s+\d+$",
    r"^Vol\.\s*\d+,?\s*No\.\s*\d+",
    r"^https?://",
    r"^www\.",
    r"^[A-Za-z]+\s+\d{4}$",
    r"^Copyright",
    r"^doi:",
    r"^ISSN",
    r"^Received:.*Accepted:",
]
HEADER_LINES = 2
FOOTER_LINES = 2
MIN_LINES_FOR_HEADER_FOOTER = 5

# Substrings (of the lower-cased line) that mark a header/footer
# line in the article cleaner.
KEYWORD_LINE_MARKERS = ["journal", "copyright", "doi", "accepted", "received"]

# Citation and page-marker patterns of the article cleaner.
CITATION_PATTERN_PY = r"\(\d+\)|\d+\s?"
PAGE_MARKER_PATTERN_PY = r"Page\s+\d+(\s+of\s+\d+)?"          # case-insensitive
# Corrected-mode citation pattern: bracketed numbers only.
BRACKET_CITATION_PATTERN_PY = r"\(\d+\)|\[\d+\]"


def to_portable(py_pattern: str) -> str:
    """Rewrite a Python-notation pattern with explicit Unicode classes.

    ``^``/``$`` at the ends become ``\\A``/``\\z`` (the patterns are applied to a
    single stripped line), ``.*`` may not cross a newline, and ``\\s``/``\\d``
    become the explicit sets of :mod:`pagewright.functions.regex`.
    """
    p = py_pattern
    if p.startswith("^"):
        p = r"\A" + p[1:]
    if p.endswith("$"):
        p = p[:-1] + r"\z"
    p = p.replace(".*", r"[^\n]*")
    p = p.replace(r"\s", WS).replace(r"\d", DIGIT)
    return p


HEADER_FOOTER_RE = "|".join(f"(?:{to_portable(p)})" for p in HEADER_FOOTER_PATTERNS)
HYPHEN_NEWLINE_RE = rf"({WORD}+)-{WS}*\n{WS}*({WORD}+)"
HYPHEN_SPACE_RE = rf"({WORD}+)-{WS}+({WORD}+)"
CITATION_RE = to_portable(CITATION_PATTERN_PY)
BRACKET_CITATION_RE = to_portable(BRACKET_CITATION_PATTERN_PY)
PAGE_MARKER_RE = "(?i)" + to_portable(PAGE_MARKER_PATTERN_PY)
KEYWORD_LINE_RE = "|".join(KEYWORD_LINE_MARKERS)
MULTI_WS_RE = f"{WS}{{2,}}"
ANY_WS_RUN_RE = f"{WS}+"


def strip(col: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col, STRIP, "")


def collapse_ws(col: Column) -> Column:
    """``re.sub(r'\\s+', ' ', x).strip()``."""
    return strip(F.regexp_replace(col, ANY_WS_RUN_RE, " "))


def fix_hyphenation(col: Column) -> Column:
    """Join words broken by a hyphen: first across a newline, then on one line."""
    joined = F.regexp_replace(col, HYPHEN_NEWLINE_RE, "$1$2")
    return F.regexp_replace(joined, HYPHEN_SPACE_RE, "$1$2")


def is_header_footer_line(stripped: Column) -> Column:
    return stripped.rlike(HEADER_FOOTER_RE)


def remove_header_footer(col: Column) -> Column:
    """Drop blank lines, and header/footer lines among the first two and last two.

    Pages of four lines or fewer are returned unchanged.  Kept lines are not
    stripped.
    """
    lines = F.split(col, "\n", -1)
    n = F.size(lines)

    def keep(line: Column, i: Column) -> Column:
        s = strip(line)
        edge = (i < HEADER_LINES) | (i >= n - FOOTER_LINES)
        return (s != "") & ~(edge & is_header_footer_line(s))

    return F.when(n < MIN_LINES_FOR_HEADER_FOOTER, col).otherwise(
        F.array_join(F.filter(lines, keep), "\n"))


def remove_linebreaks(col: Column) -> Column:
    """Newlines to spaces, then strip."""
    return strip(F.translate(col, "\n", " "))


def remove_citations(col: Column, corrected: bool = False) -> Column:
    """Reference form deletes every digit run (and one following space);
    the corrected form deletes bracketed numbers only."""
    return F.regexp_replace(col, BRACKET_CITATION_RE if corrected else CITATION_RE, "")


def is_keyword_line(col: Column) -> Column:
    """True when the lower-cased line contains a header/footer keyword."""
    return F.lower(col).rlike(KEYWORD_LINE_RE)


def split_lines(col: Column) -> Column:
    """Python ``str.splitlines()`` (a trailing empty element may remain)."""
    return F.split(col, SPLITLINES, -1)


def keyword_line_filter(col: Column) -> Column:
    """Keep stripped non-empty lines without header/footer keywords, joined by newline."""
    lines = F.transform(split_lines(col), strip)
    kept = F.filter(lines, lambda x: (x != "") & ~is_keyword_line(x))
    return F.array_join(kept, "\n")


def clean_article(col: Column, lowercase: bool = False, citations: bool = True,
                  corrected_citations: bool = False) -> Column:
    """The article cleaner: citations, line filter, page markers, join, collapse."""
    t = remove_citations(col, corrected_citations) if citations else col
    lines = F.transform(split_lines(t), strip)
    lines = F.filter(lines, lambda x: (x != "") & ~is_keyword_line(x))
    lines = F.transform(lines, lambda x: F.regexp_replace(x, PAGE_MARKER_RE, ""))
    t = F.regexp_replace(F.array_join(lines, " "), MULTI_WS_RE, " ")
    if lowercase:
        t = F.lower(t)
    return strip(t)
