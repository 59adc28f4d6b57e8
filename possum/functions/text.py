"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the characters a Python ``str.strip()`` removes
# (tab, LF, VT, FF, CR, FS, GS, RS, US, space, NEL, NBSP, OGHAM SPACE MARK,
#  EN QUAD .. HAIR SPACE, LINE SEP, PARAGRAPH SEP, NNBSP, MMSP, IDEOGRAPHIC SPACE)
UNICODE_SPACE = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A"
                 "\\u2028\\u2029\\u202F\\u205F\\u3000]")


def ustrip(col: Column | str) -> Column:
    """Trim all Unicode whitespace on both ends (``trim`` removes spaces only)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.regexp_replace(c, f"^{UNICODE_SPACE}+", ""),
                            f"{UNICODE_SPACE}+$", "")


def or_empty(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def plus(*cols: Column) -> Column:
    """SQL ``a + b`` on strings: null when any part is null (unlike concat_ws)."""
    return F.concat(*cols)
