"""Output layouts: one text line per row. A row that stands for several (``copies``) gives a line that does.

A missing field prints as nothing, so in a fixed-width line it shortens the line; ``pad_nulls`` keeps the columns aligned.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pad


class Field(NamedTuple):
    name: str
    value: Column
    width: int | None = None


def blanks(*fields: tuple[str, int]) -> list[Field]:
    """Fields that the layout reserves and always leaves blank."""
    return [Field(name, F.lit(" " * width)) for name, width in fields]


def reserved(prefix: str, lo: int, hi: int, dtype: str = "string") -> list[Column]:
    """Numbered slots without a value: ``prefix_01`` and so on."""
    return [F.lit(None).cast(dtype).alias(f"{prefix}_{n:02d}") for n in range(lo, hi + 1)]


def counted(df: DataFrame) -> list[str]:
    return [c for c in ("copies",) if c in df.columns]


def printed(field: Field, pad_nulls: bool = False) -> Column:
    text = field.value if field.width is None else pad(field.value, field.width)
    return F.coalesce(text, F.lit(" " * (field.width or 0))) if pad_nulls else text


def fixed_width(df: DataFrame, layout: list[Field], keys: tuple[str, ...] = (), pad_nulls: bool = False) -> DataFrame:
    """``line`` from the fields in layout order, plus the printed fields named in ``keys`` for sorting."""
    texts = {field.name: printed(field, pad_nulls) for field in layout}
    return df.select(*[texts[k].alias(k) for k in keys], F.concat_ws("", *texts.values()).alias("line"), *counted(df))


def quoted_pipe(df: DataFrame, text_cols: list[str], num_cols: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """``line`` of quoted text fields and bare number fields, each closed by ``|`` but the last."""
    parts: list[Column] = []
    for name in text_cols:
        parts += [F.lit('"'), F.col(name), F.lit('"|')]
    for name in num_cols:
        parts += [F.col(name).cast("string"), F.lit("|")]
    if num_cols:
        parts.pop()
    else:
        parts[-1] = F.lit('"')
    return df.select(*keys, F.concat_ws("", *parts).alias("line"), *counted(df))
