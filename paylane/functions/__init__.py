"""Column-to-column expressions. All of them are built-in Spark expressions, so they stay inside generated code."""

from .dates import (
    clock_text,
    day_of_week_from_saturday,
    day_text,
    duration_text,
    in_window,
    lag_seconds,
    sentinel_date,
    week_of_month,
)
from .keys import account_key, customer_key, short_transfer_id
from .money import money_text, padded_id, scale
from .rules import (
    cash_flag,
    changed_in_window,
    gender_letter,
    is_settled,
    party_type,
    reclassify,
    settled_flag,
    volume_class,
)
from .text import (
    blank,
    blank_to_null,
    clean_text,
    code_part,
    decode,
    field_k,
    first_field_is_one,
    has_structured_code,
    pad,
    part_k,
    text_head,
    text_tail,
    tidy_upper,
    unquote,
)

__all__ = [name for name in dir() if not name.startswith("_")]
