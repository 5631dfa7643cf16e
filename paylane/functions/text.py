"""Text expressions. An empty string is a missing value throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin-1 letters and the plain letters they are written as.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
UNACCENTED = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"

# Fixed value: a structured identity code is a 1, five capitals and a number.
STRUCTURED_CODE = r"^1\p{Lu}{5}.+"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def blank(width: int) -> Column:
    return F.lit(" " * width)


def pad(c: Column, width: int) -> Column:
    """Right-pad or cut to ``width``; a missing value stays missing."""
    return F.rpad(blank_to_null(c), width, " ")


def text_head(c: Column, n: int) -> Column:
    return blank_to_null(F.substring(c, 1, n))


def text_tail(c: Column, n: int) -> Column:
    """What follows the first ``n`` characters."""
    return blank_to_null(F.substr(c, F.lit(n + 1)))


def tidy_upper(c: Column) -> Column:
    return blank_to_null(F.upper(F.trim(c)))


def unquote(c: Column) -> Column:
    """Double quotes become spaces, so that a quoted field cannot be broken."""
    return F.translate(c, '"', " ")


def clean_text(c: Column) -> Column:
    """Plain ASCII on one line: accents dropped, other characters ``?``, line ends to spaces."""
    plain = F.regexp_replace(F.translate(c, ACCENTED, UNACCENTED), r"[^\x00-\x7F]", "?")
    return blank_to_null(F.translate(plain, "\r\n", "  "))


def decode(c: Column, *pairs, default: Column) -> Column:
    """Match ``c`` against (value, result) pairs; a missing value matches a missing ``c``."""
    result = None
    for value, outcome in zip(pairs[::2], pairs[1::2]):
        test = c.isNull() if value is None else c == F.lit(value)
        result = F.when(test, outcome) if result is None else result.when(test, outcome)
    return result.otherwise(default)


def part_k(parts: Column, k: int) -> Column:
    """The ``k``-th part, counted from 1, if a further part follows it and it is not empty."""
    return F.when(F.size(parts) > k, blank_to_null(F.get(parts, F.lit(k - 1))))


def field_k(c: Column, k: int) -> Column:
    """The ``k``-th ``#`` field, counted from 1, if a further ``#`` closes it and it is not empty."""
    return part_k(F.split(c, "#"), k)


def first_field_is_one(c: Column) -> Column:
    """Whether the closed first ``#`` field is the number 1, leading zeros allowed."""
    return F.coalesce(c.rlike("^0*1#"), F.lit(False))


def has_structured_code(c: Column) -> Column:
    return F.coalesce(c.rlike(STRUCTURED_CODE), F.lit(False))


def code_part(code: Column, position: int, fallback: Column) -> Column:
    """Two letters of a structured code at ``position``; ``XX`` and unstructured codes give the fallback in capitals."""
    letters = F.substring(code, position, 2)
    return F.when(has_structured_code(code) & (letters != "XX"), letters).otherwise(F.upper(fallback))
