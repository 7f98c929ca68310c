"""Column expressions over the text of SQL scripts.

Rules: a line comment counts only when ``--`` is at the start of a line; block
comments are removed up to the nearest end mark, line comments first; the
statement separator is ``;`` wherever it stands, also between quotes.

With regard to quotes the rules are those of SQL: text between quotes (``'``, ``"`` and
backticks; a backslash takes the next character with it, but between backticks) stays as it is, a
line comment starts at any ``--`` and goes to the end of the line, hints are no comments, and
``;`` separates only outside of all these. A quote or block comment that is never closed goes on to
the end of the script.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a comment, a separator and a blank is.
LINE_COMMENT = r"(?m)^--.*$"
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
BLANKS = "".join(map(chr, range(0x21)))
SEPARATOR = ";"
# Parts that are read as one. Each loop keeps what it has taken, so a script is read once.
QUOTED_PART = (
    r"'[^'\\]*+(?:\\.[^'\\]*+)*+(?:'|\z|\\\z)"
    r'|"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\z|\\\z)'
    r"|`[^`]*+(?:`|\z)"
)
HINT_PART = r"/\*\+(?:[^*]++|\*(?!/))*+(?:\*/|\z)"
COMMENT_PART = r"--[^\n]*+|/\*(?!\+)(?:[^*]++|\*(?!/))*+(?:\*/|\z)"
COMMENT_OR_PART = rf"(?s)({QUOTED_PART}|{HINT_PART})|{COMMENT_PART}"
STATEMENT_PART = rf"""(?s)(?:[^;'"`/\-]++|{QUOTED_PART}|{HINT_PART}|{COMMENT_PART}|[/\-])++"""
PREVIEW_LENGTH = 100


def normalize_line_ends(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip_line_comments(text: Column) -> Column:
    return F.regexp_replace(text, LINE_COMMENT, "")


def strip_block_comments(text: Column) -> Column:
    return F.regexp_replace(text, BLOCK_COMMENT, "")


def strip_comments(text: Column) -> Column:
    return strip_block_comments(strip_line_comments(text))


def trim_blanks(text: Column) -> Column:
    """Drop every leading and trailing character up to U+0020."""
    return F.btrim(text, F.lit(BLANKS))


def statements(text: Column, quotes: bool = False) -> Column:
    """Array of the non-empty statements of a script, in order; with regard to ``quotes`` or not."""
    script = normalize_line_ends(text)
    if quotes:
        pieces = F.regexp_extract_all(script, F.lit(STATEMENT_PART), 0)
        pieces = F.transform(pieces, lambda piece: F.regexp_replace(piece, COMMENT_OR_PART, "$1"))
    else:
        pieces = F.split(strip_comments(script), SEPARATOR)
    return F.filter(F.transform(pieces, trim_blanks), lambda piece: piece != "")


def preview(statement: Column) -> Column:
    """First 100 characters, with an ellipsis where something was cut."""
    return F.when(
        F.length(statement) > PREVIEW_LENGTH,
        F.concat(F.substring(statement, 1, PREVIEW_LENGTH), F.lit("...")),
    ).otherwise(statement)
