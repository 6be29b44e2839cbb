"""Bibliographic metadata heuristics as Column expressions.

Each field tries a list of patterns in order; the first pattern that matches
anywhere in the article decides the field (``coalesce`` over ``nullif`` of the
extracted group keeps that short-circuit per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.regex import DIGIT, NOT_DIGIT, NOT_WORD, NOT_WS, WORD, WS, WS_SET
from pagewright.functions.text import collapse_ws, strip

D = DIGIT
NAME = "[A-Za-z][A-Za-z]+ [A-Za-z][A-Za-z]+"          # two words, any case
NAME_NUM = NAME + f"(?:{WS}*{D}+)?"
AND_SEP = "(?:,? [Aa][Nn][Dd] |,? & )"
# ---------------------------------------------------------------------------
# Metadata patterns (portable spelling of the reference rules).
# ---------------------------------------------------------------------------
DOI_PATTERNS = [
    rf"(?:doi|DOI)[:.]?{WS}*([0-9.]+/{NOT_WS}+)",
    rf"(?:https?://)?(?:dx\.)?doi\.org/([0-9.]+/{NOT_WS}+)",
]
TITLE_SKIP_AFFILIATION = "(?i)@|university|institute|department|school"
TITLE_STOP_ABSTRACT = r"(?i)\Aabstract"
TITLE_SKIP_NOT_TITLE = "(?i)received|accepted|published|copyright|doi"
TITLE_MIN_LENGTH = 10
TITLE_PARAGRAPHS = 5
TRAILING_PUNCT = r"[.,;:]\z"


AUTHOR_PATTERNS = [
    (rf"(?:\A|\n)({NAME}(?:,{WS}*{NAME})*{AND_SEP}{NAME})", 1),
    (rf"(?:\A|\n)({NAME_NUM}(?:,{WS}*{NAME_NUM})*)", 1),
    (rf"(?i)(?:authors?|by)[:;]?{WS}*([^.]+)", 1),
]
# Java recurses once per repetition of a group that it may have to give back, so a
# line of thousands of names would exhaust the task stack.  Spark uses an equivalent
# spelling with possessive groups, which are matched in a loop.  In the first pattern a
# further name is taken unless the last "and" name can stand here and cannot stand
# after that name; that is where giving back would end.
_LAST = f"{AND_SEP}{NAME}"
AUTHOR_PATTERNS_SPARK = [
    (rf"(?:\A|\n)({NAME}(?:(?!{_LAST}),{WS}*{NAME}|,{WS}*{NAME}(?={_LAST}))*+{_LAST})", 1),
    (rf"(?:\A|\n)({NAME_NUM}(?:,{WS}*{NAME_NUM})*+)", 1),
    AUTHOR_PATTERNS[2],
]


JOURNAL_PATTERNS = [
    (rf"(?i)(?:journal|published in)[:;]?{WS}*([^.]+)", 1),
    (rf"[A-Za-z][A-Za-z{WS_SET}]+,{WS}+[Vv][Oo][Ll](?:[Uu][Mm][Ee])?\.?{WS}+{D}+", 0),
    (rf"[A-Za-z][A-Za-z{WS_SET}]+,{WS}+{D}+{WS}*\({D}+\)", 0),
]
# Java backtracking tries every start inside a letter/space run and rescans the
# run each time (quadratic).  Spark uses this equivalent spelling: start only at
# the beginning of a run (lookbehind) and take the run possessively; the leftmost
# match and its text are unchanged because the run class excludes the comma.
_RUN = f"[A-Za-z{WS_SET}]"
JOURNAL_PATTERNS_SPARK = [
    JOURNAL_PATTERNS[0],
    (rf"(?<!{_RUN}){WS}*+([A-Za-z]{_RUN}++,{WS}+[Vv][Oo][Ll](?:[Uu][Mm][Ee])?\.?{WS}+{D}+)", 1),
    (rf"(?<!{_RUN}){WS}*+([A-Za-z]{_RUN}++,{WS}+{D}+{WS}*\({D}+\))", 1),
]
_DATE_KEY = "(?i)(?:published|date|received|accepted)[:;]?" + WS + "*"
DATE_PATTERNS = [
    _DATE_KEY + rf"({D}{{4}}[-/]{D}{{1,2}}[-/]{D}{{1,2}})",
    _DATE_KEY + rf"({WORD}+ {D}{{1,2}},? {D}{{4}})",
    _DATE_KEY + rf"({WORD}+ {D}{{4}})",
    rf"(?i)(?:©|\(c\)|(?:\A|{NOT_WORD})copyright(?:{NOT_WORD}|\z))(?:{WS}*{D}{{4}})?{NOT_DIGIT}*({D}{{4}})",
]
DATE_YMD = rf"\A{D}{{4}}[-/]{D}{{1,2}}[-/]{D}{{1,2}}"
DATE_MDY = rf"\A[A-Za-z]+ {D}{{1,2}},? {D}{{4}}"
DATE_MDY_PARTS = rf"([A-Za-z]+) ({D}{{1,2}}),? ({D}{{4}})"
DATE_MY = rf"\A[A-Za-z]+ {D}{{4}}"
DATE_MY_PARTS = rf"([A-Za-z]+) ({D}{{4}})"
DATE_Y = rf"\A{D}{{4}}"
# English month names to two-digit numbers; anything else is 01.
MONTHS = ["january", "february", "march", "april", "may", "june", "july",
          "august", "september", "october", "november", "december"]


def _first_group(text: Column, patterns: list[tuple[str, int]]) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, g), F.lit(""))
                        for p, g in patterns])


def doi(text: Column) -> Column:
    return F.coalesce(_first_group(text, [(p, 1) for p in DOI_PATTERNS]), F.lit(""))


def paragraphs(text: Column) -> Column:
    """Stripped non-empty blocks separated by a blank line."""
    return F.filter(F.transform(F.split(text, "\n\n", -1), strip), lambda p: p != "")


def title(text: Column) -> Column:
    """First title-like paragraph among the first five, else the first line."""
    first = F.slice(paragraphs(text), 1, TITLE_PARAGRAPHS)
    status = F.transform(first, lambda p: (
        F.when(F.length(p) < TITLE_MIN_LENGTH, 0)
        .when(p.rlike(TITLE_SKIP_AFFILIATION), 0)
        .when(p.rlike(TITLE_STOP_ABSTRACT), 2)
        .when(p.rlike(TITLE_SKIP_NOT_TITLE), 0)
        .otherwise(1)))
    take = F.array_position(status, 1)
    stop = F.array_position(status, 2)
    cand = F.when((take > 0) & ((stop == 0) | (take < stop)), F.element_at(first, take.cast("int")))
    tidy = strip(F.regexp_replace(collapse_ws(cand), TRAILING_PUNCT, ""))
    fallback = strip(F.element_at(F.split(text, "\n", -1), 1))
    return F.when(cand.isNotNull(), tidy).otherwise(fallback)


def authors(text: Column) -> Column:
    return F.coalesce(collapse_ws(_first_group(text, AUTHOR_PATTERNS_SPARK)), F.lit(""))


def journal(text: Column) -> Column:
    return F.coalesce(collapse_ws(_first_group(text, JOURNAL_PATTERNS_SPARK)), F.lit(""))


def _month_number(name: Column) -> Column:
    m = F.lower(name)
    expr = F.lit("01")
    for i, month in reversed(list(enumerate(MONTHS, start=1))):
        expr = F.when(m == month, F.lit(f"{i:02d}")).otherwise(expr)
    return expr


def parse_date_string(s: Column) -> Column:
    """Normalise a matched date string; NULL when no rule applies."""
    return (
        F.when(s.rlike(DATE_YMD), F.translate(s, "/", "-"))
        .when(s.rlike(DATE_MDY), F.concat_ws(
            "-", F.regexp_extract(s, DATE_MDY_PARTS, 3),
            _month_number(F.regexp_extract(s, DATE_MDY_PARTS, 1)),
            F.lpad(F.regexp_extract(s, DATE_MDY_PARTS, 2), 2, "0")))
        .when(s.rlike(DATE_MY), F.concat_ws(
            "-", F.regexp_extract(s, DATE_MY_PARTS, 2),
            _month_number(F.regexp_extract(s, DATE_MY_PARTS, 1)), F.lit("01")))
        .when(s.rlike(DATE_Y), F.concat(s, F.lit("-01-01"))))


def publication_date(text: Column, default: Column | None = None) -> Column:
    """First date pattern that matches decides; unparsable keeps the default."""
    if default is None:
        default = F.date_format(F.current_date(), "yyyy-MM-dd")
    found = F.lit(None).cast("string")
    for p in reversed(DATE_PATTERNS):
        found = F.when(text.rlike(p), strip(F.regexp_extract(text, p, 1))).otherwise(found)
    return F.coalesce(parse_date_string(found), default)


def metadata_struct(text: Column, default_date: Column | None = None) -> Column:
    return F.struct(
        title(text).alias("title"),
        authors(text).alias("authors"),
        journal(text).alias("journal"),
        publication_date(text, default_date).alias("publication_date"),
        doi(text).alias("doi"),
    )
