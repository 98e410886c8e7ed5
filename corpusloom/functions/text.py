"""String expressions with Python semantics, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character for which Python's str.isspace() is true.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def str_strip(c: Column | str) -> Column:
    """Python ``str.strip()``. ``trim`` alone only removes U+0020, and an anchored
    regex would walk the whole text; ``btrim`` with a set looks at the edges only."""
    return F.btrim(as_column(c), F.lit(PYTHON_WHITESPACE))


def quote_regex(literal: str) -> str:
    """Java regex matching ``literal`` verbatim."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_once(c: Column | str, marker: str) -> Column:
    """Python ``str.split(marker, maxsplit=1)`` as an array of one or two strings."""
    return F.split(as_column(c), quote_regex(marker), 2)


def python_text(c: Column | str) -> Column:
    """Text of a value inside an f-string: null prints as ``None``."""
    return F.coalesce(as_column(c).cast("string"), F.lit("None"))


def globs_to_regex(patterns: list[str]) -> str:
    """One unanchored regex for several file globs; only ``.`` and ``*`` are special."""
    return "|".join(p.replace(".", "\\.").replace("*", ".*") for p in patterns)
