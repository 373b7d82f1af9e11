"""String expressions with Python's idea of white space, as plain Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 white-space characters of str.strip, as a regex class (fixed values).
PYWS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Characters that take no room and separate nothing: soft hyphen, zero-width marks, BOM.
INVISIBLE = r"[\u00ad\u200b-\u200f\u2060\ufeff]"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    return F.regexp_replace(col(c), f"^{PYWS}+|{PYWS}+$", "")


def py_ws(c: str | Column) -> Column:
    return F.regexp_replace(col(c), f"{PYWS}+", " ")


def collapse(c: str | Column) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return py_strip(py_ws(c))


def non_blank(c: str | Column) -> Column:
    """The stripped text, NULL if nothing is left."""
    return F.nullif(py_strip(c), F.lit(""))


def first_text(*cs: str | Column) -> Column:
    """The first of the columns that is neither null nor blank, stripped."""
    return F.coalesce(*[non_blank(c) for c in cs])


def sha_key(*cs: str | Column) -> Column:
    """sha256 in hex over the parts joined with '|'; NULL if a part is NULL."""
    parts = [col(cs[0])]
    for c in cs[1:]:
        parts += [F.lit("|"), col(c)]
    return F.sha2(F.concat(*parts), 256)
