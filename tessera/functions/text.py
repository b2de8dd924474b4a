"""String clean-up helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what an empty extraction renders as.
NO_TEXT = "No text detected."


# Fixed value: the characters of Python's ``str.isspace`` (Java's ``\s`` has only the ASCII ones).
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
          "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
BLANK_CLASS = "[" + "".join(f"\\x{{{ord(b):x}}}" for b in BLANKS) + "]"
INLINE_CLASS = "[" + "".join(f"\\x{{{ord(b):x}}}" for b in BLANKS if b != "\n") + "]"


def strip_all(c: Column) -> Column:
    """Python ``str.strip()``: remove every kind of whitespace at both ends."""
    return F.trim(c, F.lit(BLANKS))


def title_case(c: Column) -> Column:
    """Python ``str.title()``: upper-case a letter that follows a non-letter,
    lower-case the others (``o'neil-x`` -> ``O'Neil-X``), unlike ``initcap``
    which only looks at spaces."""
    tokens = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    cap = F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2)))))
    return F.when(c.isNull(), None).otherwise(F.array_join(cap, ""))


def normalize_text(c: Column) -> Column:
    """Line ends to ``\n``; runs of spaces/tabs to one space; each line
    stripped; consecutive blank lines reduced to one; whole text stripped;
    empty result becomes ``No text detected.``

    No pattern repeats a group, so the depth of the matcher does not grow
    with the text. Each intermediate value is referenced once, so nothing is
    evaluated twice."""
    s = F.when(F.instr(c, "\r") > 0, F.regexp_replace(c, r"\r\n?", "\n")).otherwise(c)
    s = F.regexp_replace(s, r"[ \t]+", " ")
    s = F.regexp_replace(s, f"{INLINE_CLASS}*+\n{INLINE_CLASS}*+", "\n")  # each line stripped
    s = F.regexp_replace(s, r"\n{3,}", "\n\n")
    s = F.trim(s, F.lit(BLANKS))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(NO_TEXT))


def split_join(c: Column, sep: str = " ", joiner: str = "-") -> Column:
    """Split at the literal ``sep`` and join again."""
    return F.replace(c, F.lit(sep), F.lit(joiner))


def safe_filename(c: Column) -> Column:
    """Keep the last path element and replace unsafe characters by ``_``."""
    base = F.regexp_extract(c, r"([^/\\]*)$", 1)
    return F.regexp_replace(base, r"[^A-Za-z0-9._-]", "_")


def file_suffix(c: Column) -> Column:
    """Lower-case extension including the dot, '' when none."""
    return F.lower(F.regexp_extract(c, r"(\.[^./\\]+)$", 1))
