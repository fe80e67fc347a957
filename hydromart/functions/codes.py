"""Code and label normalisation as JVM column expressions (FN-01..08, FN-13..17)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: ColumnOrName) -> Column:
    """FN-01: trimmed text."""
    return F.trim(_col(c).cast("string"))


def pad_code(c: ColumnOrName, width: int = 5) -> Column:
    """FN-02: ``lpad(trim(cast(x as string)), width, '0')``; longer values are truncated."""
    return F.lpad(clean(c), width, "0")


def department_code(c: ColumnOrName) -> Column:
    """FN-03: Corsican departments stay upper-case and unpadded, others are padded to 2."""
    up = F.upper(clean(c))
    return F.when(up.isin("2A", "2B"), up).otherwise(pad_code(c, 2))


def safe_cast(c: ColumnOrName, type_name: str) -> Column:
    """FN-04: NULL instead of an error when the value does not parse.

    Fractions round half away from zero on the way to an integer type, and a date needs all its
    parts, like in the warehouse.
    """
    x = _col(c)
    if type_name in ("bigint", "long", "int", "integer", "smallint", "tinyint"):
        return F.round(x.try_cast("decimal(38,9)")).try_cast(type_name)
    if type_name == "date":
        whole = F.trim(x.cast("string")).rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$")
        return F.when(whole, x.try_cast("date"))
    return x.try_cast(type_name)


def int_text(c: ColumnOrName, width: int | None = None) -> Column:
    """FN-05: a float department (e.g. ``37.0``) as integer text, optionally padded."""
    text = safe_cast(c, "bigint").cast("string")
    return F.lpad(text, width, "0") if width else text


def first_present(*cols: ColumnOrName) -> Column:
    """FN-06: coalesce of alternative location schemas."""
    return F.coalesce(*[_col(c) for c in cols])


# Single-character accent folding is derived from Unicode itself: every character from U+00C0 on
# whose canonical decomposition is one base character plus combining marks maps to that character
# (letters like U+212B included). ``translate`` then runs inside codegen.
_FOLD_FIRST, _FOLD_LAST = 0x00C0, 0x1FFFF


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    src, dst = [], []
    for ch in map(chr, range(_FOLD_FIRST, _FOLD_LAST + 1)):
        if not unicodedata.decomposition(ch) or unicodedata.decomposition(ch).startswith("<"):
            continue
        base = "".join(x for x in unicodedata.normalize("NFD", ch) if not unicodedata.category(x).startswith("M"))
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_marks(c: ColumnOrName) -> Column:
    """Remove diacritics: fold precomposed letters, then drop any remaining ``\\p{M}``."""
    src, dst = _fold_table()
    return F.regexp_replace(F.translate(_col(c), src, dst), r"\p{M}", "")


def place_key(c: ColumnOrName) -> Column:
    """FN-07: accent-free, lower-case name without apostrophes, spaces or hyphens.

    ``Saint-Chély-d'Apcher`` -> ``saintchelydapcher``. Precomposed letters are folded first;
    lower-casing then cannot create a combining mark, so the remaining marks and the
    separators are removed in one regex pass.
    """
    src, dst = _fold_table()
    return F.regexp_replace(F.lower(F.translate(_col(c), src, dst)), r"[\p{M}' \-]", "")


def identity_hash(*parts: ColumnOrName, null_as_empty: bool = False) -> Column:
    """FN-08: ``md5`` hex of the parts joined by ``|`` (NULL if a part is NULL, like CONCAT).

    ``null_as_empty`` reproduces the weather variant that coalesces a missing code to ''.
    """
    cols = []
    for i, p in enumerate(parts):
        v = _col(p).cast("string")
        if null_as_empty:
            v = F.coalesce(v, F.lit(""))
        if i:
            cols.append(F.lit("|"))
        cols.append(v)
    return F.md5(F.concat(*cols))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """FN-12: NULL when the denominator is 0 or NULL."""
    return F.try_divide(_col(num), _col(den))


def bool_to_int(c: ColumnOrName) -> Column:
    """FN-15."""
    return _col(c).cast("int")


def distinct_from(a: ColumnOrName, b: ColumnOrName) -> Column:
    """FN-16: ``a IS DISTINCT FROM b`` (NULL-safe inequality)."""
    return ~_col(a).eqNullSafe(_col(b))


def is_blank(c: ColumnOrName) -> Column:
    """NULL or only whitespace."""
    return _col(c).isNull() | (clean(c) == "")


def valid_label_row(code: ColumnOrName, header_value: str) -> Column:
    """FN-17: keep rows with a code that is neither NULL, blank, nor the header copied as data."""
    return ~is_blank(code) & (clean(code) != header_value)
