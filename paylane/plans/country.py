"""Country extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import padded_id
from ..operators.layout import Field, fixed_width

ORDER = ["code"]


def extract_country(t: dict[str, DataFrame]) -> DataFrame:
    """Active countries. A missing field prints as nothing."""
    active = t["country"].where(F.col("status") == "Y")
    layout = [
        Field("number", padded_id(F.col("id"))),
        Field("code", F.col("country_iso"), 3),
        Field("description", F.col("description"), 128),
    ]
    return fixed_width(active, layout, keys=("code",))
