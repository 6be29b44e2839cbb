"""Portable regular-expression building blocks.

Spark runs Java regular expressions and the DuckDB oracle runs RE2; the
reference semantics are Python's ``re`` with Unicode classes.  Shorthand
classes (``\\w``, ``\\s``, ``\\d``, ``\\b``) mean different things in the three,
so every pattern here spells its classes out with code points and Unicode
properties that both Java and RE2 read the same way.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Character sets that must equal Python's str semantics.
# ---------------------------------------------------------------------------

# Python str.isspace() / re "\s": tab, LF, VT, FF, CR, FS, GS, RS, US, space,
# NEL, NBSP, ogham space, en quad .. hair space, LS, PS, narrow NBSP,
# medium math space, ideographic space.
WS_SET = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
          r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Python str.splitlines() boundaries (CRLF handled as one boundary).
LINE_BREAK_SET = r"\n\r\x{0B}\x{0C}\x{1C}\x{1D}\x{1E}\x{85}\x{2028}\x{2029}"
# Python re "\w" for str patterns: letters, numbers, underscore.
WORD_SET = r"\p{L}\p{N}_"
# Python re "\d" for str patterns: decimal digits.
DIGIT_SET = r"\p{Nd}"

# The characters of WS_SET, for functions that trim.
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

WS = f"[{WS_SET}]"
NOT_WS = f"[^{WS_SET}]"
WORD = f"[{WORD_SET}]"
NOT_WORD = f"[^{WORD_SET}]"
DIGIT = f"[{DIGIT_SET}]"
NOT_DIGIT = f"[^{DIGIT_SET}]"

SPLITLINES = rf"\r\n|[{LINE_BREAK_SET}]"
STRIP = rf"\A{WS}+|{WS}+\z"


def to_python(pattern: str) -> str:
    """The same pattern for Python's ``regex`` module (``\\x{HHHH}`` -> ``\\uHHHH``)."""
    import re
    return re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: "\\u%04x" % int(m.group(1), 16), pattern)
