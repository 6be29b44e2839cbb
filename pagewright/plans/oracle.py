"""DuckDB spellings of the Column functions, used to build oracle SQL.

These mirror :mod:`pagewright.functions` one for one, using the same fixed
pattern constants, so the oracle checks the Spark plan rather than a second
copy of the rules.  (DuckDB: RE2 regexes, ``\\1`` group references, 1-based
lambda indexes.)
"""

from __future__ import annotations

from pagewright.functions import metadata as M
from pagewright.functions import text as T
from pagewright.functions.regex import SPLITLINES, STRIP


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP)}, '', 'g')"


def collapse_ws(x: str) -> str:
    return strip(f"regexp_replace({x}, {q(T.ANY_WS_RUN_RE)}, ' ', 'g')")


def fix_hyphenation(x: str) -> str:
    inner = f"regexp_replace({x}, {q(T.HYPHEN_NEWLINE_RE)}, '\\1\\2', 'g')"
    return f"regexp_replace({inner}, {q(T.HYPHEN_SPACE_RE)}, '\\1\\2', 'g')"


def remove_header_footer(x: str) -> str:
    lines = f"string_split({x}, chr(10))"
    n = f"len({lines})"
    keep = (f"lambda l, i: {strip('l')} <> '' AND NOT ((i - 1 < {T.HEADER_LINES} OR "
            f"i - 1 >= {n} - {T.FOOTER_LINES}) AND regexp_matches({strip('l')}, {q(T.HEADER_FOOTER_RE)}))")
    return (f"(CASE WHEN {n} < {T.MIN_LINES_FOR_HEADER_FOOTER} THEN {x} "
            f"ELSE array_to_string(list_filter({lines}, {keep}), chr(10)) END)")


def remove_linebreaks(x: str) -> str:
    return strip(f"replace({x}, chr(10), ' ')")


def remove_citations(x: str, corrected: bool = False) -> str:
    pat = T.BRACKET_CITATION_RE if corrected else T.CITATION_RE
    return f"regexp_replace({x}, {q(pat)}, '', 'g')"


def is_keyword_line(x: str) -> str:
    return f"regexp_matches(lower({x}), {q(T.KEYWORD_LINE_RE)})"


def split_lines(x: str) -> str:
    return f"regexp_split_to_array({x}, {q(SPLITLINES)})"


def keyword_line_filter(x: str) -> str:
    lines = f"list_transform({split_lines(x)}, lambda l: {strip('l')})"
    return f"array_to_string(list_filter({lines}, lambda l: l <> '' AND NOT {is_keyword_line('l')}), chr(10))"


def clean_article(x: str, lowercase: bool = False, citations: bool = True,
                  corrected_citations: bool = False) -> str:
    t = remove_citations(x, corrected_citations) if citations else x
    lines = f"list_transform({split_lines(t)}, lambda l: {strip('l')})"
    lines = f"list_filter({lines}, lambda l: l <> '' AND NOT {is_keyword_line('l')})"
    lines = f"list_transform({lines}, lambda l: regexp_replace(l, {q(T.PAGE_MARKER_RE)}, '', 'g'))"
    t = f"regexp_replace(array_to_string({lines}, ' '), {q(T.MULTI_WS_RE)}, ' ', 'g')"
    if lowercase:
        t = f"lower({t})"
    return strip(t)


def clean_page_text(x: str, flatten: bool) -> str:
    t = fix_hyphenation(remove_header_footer(x))
    return remove_linebreaks(t) if flatten else t


# ---- metadata -------------------------------------------------------------

def _extract(x: str, pat: str, g: int) -> str:
    return f"nullif(regexp_extract({x}, {q(pat)}, {g}), '')"


def _first_group(x: str, patterns: list[tuple[str, int]]) -> str:
    return "coalesce(" + ", ".join(_extract(x, p, g) for p, g in patterns) + ")"


def doi(x: str) -> str:
    return f"coalesce({_first_group(x, [(p, 1) for p in M.DOI_PATTERNS])}, '')"


def title(x: str) -> str:
    paras = f"list_filter(list_transform(string_split({x}, chr(10) || chr(10)), lambda p: {strip('p')}), lambda p: p <> '')"
    first = f"{paras}[1:{M.TITLE_PARAGRAPHS}]"
    status = (f"list_transform({first}, lambda p: CASE WHEN length(p) < {M.TITLE_MIN_LENGTH} THEN 0 "
              f"WHEN regexp_matches(p, {q(M.TITLE_SKIP_AFFILIATION)}) THEN 0 "
              f"WHEN regexp_matches(p, {q(M.TITLE_STOP_ABSTRACT)}) THEN 2 "
              f"WHEN regexp_matches(p, {q(M.TITLE_SKIP_NOT_TITLE)}) THEN 0 ELSE 1 END)")
    take = f"coalesce(list_position({status}, 1), 0)"
    stop = f"coalesce(list_position({status}, 2), 0)"
    cand = f"(CASE WHEN {take} > 0 AND ({stop} = 0 OR {take} < {stop}) THEN {first}[{take}] END)"
    tidy = strip(f"regexp_replace({collapse_ws(cand)}, {q(M.TRAILING_PUNCT)}, '')")
    fallback = strip(f"string_split({x}, chr(10))[1]")
    return f"(CASE WHEN {cand} IS NOT NULL THEN {tidy} ELSE {fallback} END)"


def authors(x: str) -> str:
    return f"coalesce({collapse_ws(_first_group(x, M.AUTHOR_PATTERNS))}, '')"


def journal(x: str) -> str:
    return f"coalesce({collapse_ws(_first_group(x, M.JOURNAL_PATTERNS))}, '')"


def _month_number(x: str) -> str:
    whens = " ".join(f"WHEN {q(m)} THEN '{i:02d}'" for i, m in enumerate(M.MONTHS, start=1))
    return f"(CASE lower({x}) {whens} ELSE '01' END)"


def parse_date_string(s: str) -> str:
    def part(p, g):
        return f"regexp_extract({s}, {q(p)}, {g})"
    return (f"(CASE WHEN regexp_matches({s}, {q(M.DATE_YMD)}) THEN replace({s}, '/', '-') "
            f"WHEN regexp_matches({s}, {q(M.DATE_MDY)}) THEN {part(M.DATE_MDY_PARTS, 3)} || '-' || "
            f"{_month_number(part(M.DATE_MDY_PARTS, 1))} || '-' || lpad({part(M.DATE_MDY_PARTS, 2)}, 2, '0') "
            f"WHEN regexp_matches({s}, {q(M.DATE_MY)}) THEN {part(M.DATE_MY_PARTS, 2)} || '-' || "
            f"{_month_number(part(M.DATE_MY_PARTS, 1))} || '-01' "
            f"WHEN regexp_matches({s}, {q(M.DATE_Y)}) THEN {s} || '-01-01' END)")


def publication_date(x: str, default_sql: str) -> str:
    found = "CASE " + " ".join(
        f"WHEN regexp_matches({x}, {q(p)}) THEN {strip(f'regexp_extract({x}, {q(p)}, 1)')}"
        for p in M.DATE_PATTERNS) + " END"
    return f"coalesce({parse_date_string('(' + found + ')')}, {default_sql})"


# ---- extraction chain ---------------------------------------------------------

from pagewright.operators import aliases as _AL  # noqa: E402
from pagewright.operators import relations as _RL  # noqa: E402
from pagewright.operators import tokens as _TK  # noqa: E402
from pagewright.sources import vocab as _V  # noqa: E402

def _longest_phrase() -> int:
    """Tokens of the longest fixed phrase."""
    import regex

    from pagewright.functions.regex import to_python
    token = regex.compile(to_python(_TK.TOKEN_RE))
    names = [r[1] for r in _V.BUILTIN_PATTERNS + _V.PLURAL_PATTERNS] + [
        r[0] for rows in (_V.SEED_SYMPTOMS, _V.SEED_PROTEINS, _V.SEED_BRAIN_REGIONS, _V.SEED_ACRONYMS) for r in rows]
    return max(len(token.findall(n)) for n in names)


# n-grams up to the longest fixed phrase and the phrases of the tables, which are shorter;
# the oracle stops with an error at a longer one, so it is never incomplete unseen
ORACLE_MAX_N = max(6, _longest_phrase())


def acronym_type(x: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({x}), {q(w)})" for w in words) + f" THEN {q(label)}"
        for label, words in _V.ACRONYM_TYPE_RULES)
    return f"(CASE {whens} ELSE {q(_V.ACRONYM_DEFAULT_TYPE)} END)"


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)


def vocabulary_entries_sql(extra_sql: str | None = None) -> str:
    """(label, name, source) rows, as :func:`pagewright.sources.vocab.vocabulary_entries`."""
    parts = [f"SELECT label, name, 'builtin' AS source FROM ({_values(_V.BUILTIN_PATTERNS + _V.PLURAL_PATTERNS)}) t(label, name)",
             f"SELECT 'SYMPTOM', name, 'symptoms' FROM ({_values([(n,) for n, _ in _V.SEED_SYMPTOMS])}) t(name)",
             f"SELECT 'PROTEIN', name, 'proteins' FROM ({_values([(n,) for n, _, _ in _V.SEED_PROTEINS])}) t(name)",
             f"SELECT 'BRAIN_REGION', name, 'brain_regions' FROM "
             f"({_values([(n,) for n, _ in _V.SEED_BRAIN_REGIONS])}) t(name)",
             f"SELECT {acronym_type('full_form')}, acronym, 'acronyms' FROM "
             f"({_values([(a, f) for a, f, _ in _V.SEED_ACRONYMS])}) t(acronym, full_form) "
             f"WHERE full_form IS NOT NULL AND full_form <> ''"]
    if extra_sql:
        parts.append(f"SELECT label, name, 'extra' FROM ({extra_sql}) x")
    body = " UNION ALL ".join(parts)
    return f"SELECT * FROM ({body}) u WHERE name IS NOT NULL AND length(name) > 1"


def gazetteer_ctes(extra_sql: str | None = None, entries_sql: str | None = None) -> list[str]:
    prio = "CASE source " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in _V.SOURCE_PRIORITY.items()) + " ELSE 99 END"
    raw = f"regexp_extract_all(name, {q(_TK.TOKEN_RE)}, 0)"
    toks = f"list_transform({raw}, lambda x: lower(x))"
    exact = "(source IN (" + ", ".join(q(x) for x in _V.EXACT_CASE_SOURCES) + "))" if _V.EXACT_CASE_SOURCES else "false"
    return [
        f"vocab_entries AS ({entries_sql or vocabulary_entries_sql(extra_sql)})",
        f"gz0 AS (SELECT label, name, source, {prio} AS priority, {exact} AS exact, "
        f"array_to_string({toks}, ' ') AS key, "
        f"CASE WHEN {exact} THEN array_to_string({raw}, ' ') END AS ekey, "
        f"len({toks}) AS n FROM vocab_entries)",
        "gz AS (SELECT key, label, exact, ekey, min(priority) AS priority, arg_min(source, priority) AS source, "
        "arg_min(name, struct_pack(p := priority, s := source, n := name)) AS name, "
        "string_split(key, ' ')[1] AS first, "
        f"CASE WHEN len(string_split(key, ' ')) > {ORACLE_MAX_N} THEN error('a phrase is longer than the n-grams') "
        "ELSE len(string_split(key, ' ')) END AS n_tokens "
        "FROM gz0 WHERE n > 0 GROUP BY key, label, exact, ekey)",
    ]


def token_ctes(docs: str) -> list[str]:
    arr = f"regexp_extract_all(text, {q(_TK.PIECE_RE)}, 0)"
    return [
        f"pieces AS (SELECT doc_id, unnest({arr}) AS piece, unnest(range(len({arr}))) AS pos FROM {docs})",
        f"toks AS (SELECT * FROM (SELECT doc_id, pos, regexp_extract(piece, {q(_TK.TOKEN_AT_START_RE)}, 0) AS token, "
        "CAST(coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM pieces) p WHERE token <> '')",
    ]


def greedy_ctes() -> list[str]:
    """The greedy over candidates ``m``, as it is told: within an island, best first, each is kept
    unless it overlaps one kept before (``kept``)."""
    place = "PARTITION BY doc_id ORDER BY start, en, priority, label"
    return [
        f"isl0 AS (SELECT *, max(en) OVER ({place} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM m)",
        f"isl AS (SELECT *, sum(CASE WHEN before IS NULL OR start >= before THEN 1 ELSE 0 END) OVER ({place} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM isl0)",
        "rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY n_tokens DESC, start, priority, label) AS r FROM isl)",
        "gr AS (SELECT doc_id, island, r, true AS keep, [struct_pack(s := start, e := en)] AS took FROM rk WHERE r = 1 "
        "UNION ALL SELECT doc_id, island, r, NOT clash, CASE WHEN clash THEN took ELSE list_append(took, struct_pack(s := start, e := en)) END "
        "FROM (SELECT k.doc_id, k.island, k.r, k.start, k.en, gr.took, "
        "len(list_filter(gr.took, lambda x: x.s < k.en AND k.start < x.e)) > 0 AS clash "
        "FROM gr JOIN rk k ON k.doc_id = gr.doc_id AND k.island = gr.island AND k.r = gr.r + 1) z)",
        "kept AS (SELECT rk.* FROM rk JOIN gr ON gr.doc_id = rk.doc_id AND gr.island = rk.island AND gr.r = rk.r WHERE gr.keep)"]


def match_ctes(docs: str, context_chars: int = 50, blockers: str | None = None) -> list[str]:
    """Candidates (m), kept spans (kept), mentions with text (ments), first occurrences (ents);
    ``blockers`` (doc_id, start, en): spans that no candidate may overlap."""
    leads = ", ".join(f"lead(lower(token), {k}) OVER w AS n{k}, lead(start + length(token), {k}) OVER w AS e{k}, "
                      f"lead(token, {k}) OVER w AS t{k}" for k in range(1, ORACLE_MAX_N))
    grams = ["SELECT doc_id, pos, start, 1 AS n_tokens, norm AS key, token AS ekey, en FROM t"]
    for k in range(2, ORACLE_MAX_N + 1):
        key = "norm || " + " || ".join(f"' ' || n{j}" for j in range(1, k))
        ekey = "token || " + " || ".join(f"' ' || t{j}" for j in range(1, k))
        grams.append(f"SELECT doc_id, pos, start, {k}, {key}, {ekey}, e{k - 1} FROM t WHERE n{k - 1} IS NOT NULL")
    free = (f" WHERE NOT EXISTS (SELECT 1 FROM {blockers} b WHERE b.doc_id = c.doc_id AND b.start < c.en AND c.start < b.en)"
            if blockers else "")
    lo = f"greatest(k.start - {context_chars}, 0)"
    hi = f"least(k.en + {context_chars}, length(d.text))"
    return [
        f"t AS (SELECT doc_id, pos, token, lower(token) AS norm, start, start + length(token) AS en, {leads} "
        "FROM toks WINDOW w AS (PARTITION BY doc_id ORDER BY pos))",
        "cand AS (" + " UNION ALL ".join(grams) + ")",
        "m AS (SELECT c.doc_id, c.pos AS tok_start, c.pos + c.n_tokens AS tok_end, c.n_tokens, c.start, "
        "c.en, g.label, g.source, g.priority FROM cand c JOIN gz g "
        f"ON c.key = g.key AND (NOT g.exact OR c.ekey = g.ekey){free})",
        *greedy_ctes(),
        f"ments AS (SELECT k.doc_id, k.label, k.source, k.start, k.en, "
        f"substring(d.text, k.start + 1, k.en - k.start) AS text, "
        f"CASE WHEN {hi} > {lo} THEN substring(d.text, {lo} + 1, {hi} - {lo}) ELSE '' END AS context "
        f"FROM kept k JOIN {docs} d ON k.doc_id = d.doc_id)",
        "ents AS (SELECT doc_id, label, arg_min(text, start) AS text, min(start) AS start, "
        "arg_min(en, start) AS en, arg_min(context, start) AS context, arg_min(source, start) AS source "
        "FROM ments GROUP BY doc_id, label, lower(text))",
    ]


def alias_ctes(docs: str) -> list[str]:
    t1 = f"regexp_extract_all(text, {q(_AL.ALIAS_RE)}, 1)"
    t2 = f"regexp_extract_all(text, {q(_AL.ALIAS_RE)}, 2)"
    return [
        f"al0 AS (SELECT doc_id, unnest({t1}) AS term, unnest({t2}) AS alias, "
        f"unnest(range(len({t1}))) AS pos FROM {docs} WHERE instr(text, '(') > 0)",
        f"als AS (SELECT doc_id, {strip('term')} AS term, arg_max({strip('alias')}, pos) AS alias "
        f"FROM al0 GROUP BY doc_id, {strip('term')})",
    ]


def pair_ctes(docs: str, max_gap: int = 200, ctx: int = 20) -> list[str]:
    first = ("(a.start < b.start OR (a.start = b.start AND (a.label < b.label OR "
             "(a.label = b.label AND a.en < b.en))))")
    between = "CASE WHEN b.start > a.en THEN substring(d.text, a.en + 1, b.start - a.en) ELSE '' END"
    lo = f"greatest(a.start - {ctx}, 0)"
    hi = f"least(b.en + {ctx}, length(d.text))"
    return [
        f"prs AS (SELECT a.doc_id, a.label AS e1_label, a.text AS e1_text, a.start AS e1_start, a.en AS e1_end, "
        f"b.label AS e2_label, b.text AS e2_text, b.start AS e2_start, b.en AS e2_end, "
        f"{between} AS between_text, "
        f"CASE WHEN {hi} > {lo} THEN substring(d.text, {lo} + 1, {hi} - {lo}) ELSE '' END AS context "
        f"FROM ents a JOIN ents b ON a.doc_id = b.doc_id AND {first} AND b.start - a.en <= {max_gap} "
        f"JOIN {docs} d ON d.doc_id = a.doc_id)",
    ]


def rule_score_sql(t1: str, t2: str, between: str) -> tuple[str, str]:
    def pair(x, y):
        return f"(({t1} = {q(x)} AND {t2} = {q(y)}) OR ({t1} = {q(y)} AND {t2} = {q(x)}))"
    R = _RL.RULES
    rel = (f"(CASE WHEN {pair('DISEASE', 'BIOMARKER')} THEN {q(R[0][0])} "
           f"WHEN {pair('PROTEIN', 'BIOMARKER')} AND regexp_matches({between}, {q(_RL.COPULA_CUE)}) "
           f"THEN {q(R[1][0])} "
           f"WHEN {pair('PROTEIN', 'BRAIN_REGION')} AND regexp_matches({between}, {q(_RL.LOCATION_CUE)}) "
           f"THEN {q(R[2][0])} ELSE {q(R[3][0])} END)")
    conf = f"(CASE {rel} " + " ".join(f"WHEN {q(r)} THEN CAST({c} AS DOUBLE)" for r, c in R[:3]) + \
        f" ELSE CAST({R[3][1]} AS DOUBLE) END)"
    return rel, conf


def trim_alias_term(term: str, alias: str) -> str:
    from pagewright.functions.regex import WS
    words = f"regexp_split_to_array({term}, {q(WS + '+')})"
    n = f"length({alias})"
    last = f"list_slice({words}, len({words}) - {n} + 1, len({words}))"
    initials = f"array_to_string(list_transform({last}, lambda w: upper(substring(w, 1, 1))), '')"
    return (f"(CASE WHEN len({words}) >= {n} AND {initials} = upper({alias}) "
            f"THEN array_to_string({last}, ' ') ELSE {term} END)")
