"""String cleaning functions (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layercake.functions._util import ColumnOrName, col, trim_spaces

# Runs of whitespace squeezed by `squeeze_spaces`: space, tab, LF, FF, CR.
# Vertical tab is left alone on purpose: the SQL engines that define the
# semantics we follow do not treat it as whitespace in `\s`.
WHITESPACE_RUN = "[ \t\n\f\r]+"


def squeeze_spaces(c: ColumnOrName) -> Column:
    """trim (space characters, no tabs) then collapse each whitespace run into one space."""
    return F.regexp_replace(trim_spaces(c), WHITESPACE_RUN, " ")


# Small letters whose capital is one character, though their full upper
# case is two: sharp s, and Greek vowels with an iota below.
_CAPITALS = {
    0xDF: 0x1E9E, 0x1FB3: 0x1FBC, 0x1FC3: 0x1FCC, 0x1FF3: 0x1FFC,
    **{small: small + 8 for first in (0x1F80, 0x1F90, 0x1FA0) for small in range(first, first + 8)},
}
_SMALL, _CAPITAL = "".join(map(chr, _CAPITALS)), "".join(map(chr, _CAPITALS.values()))


def _word_case(word: Column) -> Column:
    """First character upper case, the rest lower case, character by character: one
    character never becomes two, and a capital sigma becomes the plain small one also
    at the end of a word."""
    first = F.translate(F.left(word, F.lit(1)), _SMALL, _CAPITAL)
    upper = F.upper(first)
    rest = F.lower(F.translate(F.substr(word, F.lit(2)), "\u03a3\u0130", "\u03c3i"))
    return F.concat(F.when(F.length(upper) > 1, first).otherwise(upper), rest)


def title_case(c: ColumnOrName) -> Column:
    """Trim, squeeze whitespace, capitalise every space-separated word (first
    character upper case, the rest lower case; see ``_word_case``).

    An empty result becomes NULL (callers add their own default with coalesce).
    A tab-only value is *not* empty: trim keeps the tab, the squeeze turns it into
    one space, so the result is ' '. Letters that got a case with Unicode 16 follow the
    Java runtime.
    """
    words = F.split(squeeze_spaces(c), " ")
    return F.nullif(F.array_join(F.transform(words, _word_case), " "), F.lit(""))


def split_composite_key(
    c: ColumnOrName, prefix_len: int = 5, sep: str = "-", repl: str = "_"
) -> tuple[Column, Column]:
    """Split 'AB-CD-rest' into ('AB_CD', 'rest').

    The head is the first ``prefix_len`` characters with ``sep`` replaced by
    ``repl``; the tail starts after the separator that follows the head
    (1-based position ``prefix_len + 2``). Short inputs give '' as tail.
    """
    c = col(c)
    head = F.replace(F.substring(c, 1, prefix_len), F.lit(sep), F.lit(repl))
    tail = F.substr(c, F.lit(prefix_len + 2))
    return head, tail


def strip_prefix(c: ColumnOrName, prefix: str) -> Column:
    """Drop a case-sensitive literal prefix when present."""
    c = col(c)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def strip_chars(c: ColumnOrName, chars: str = "-") -> Column:
    """Remove every occurrence of the literal ``chars``."""
    return F.replace(col(c), F.lit(chars), F.lit(""))
