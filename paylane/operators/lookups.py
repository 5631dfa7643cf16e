"""Small reference tables.

No join here is hinted: reference tables are small enough for Catalyst to broadcast by their measured size, and
one that has grown past the threshold is joined by shuffle instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null

# Fixed value: minor units per currency unit where no preference is set.
DEFAULT_FACTOR = 100


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], cols: dict[str, str], unique: bool = False) -> DataFrame:
    """Left-join columns of ``dim``. ``on`` maps columns of ``df`` to keys of ``dim``, ``cols`` maps its columns to new names.

    Duplicate keys multiply rows, as any join does; with ``unique`` a used duplicate is an error.
    """
    keys = {f"_key_{i}": k for i, k in enumerate(on.values())}
    values = {f"_value_{i}": c for i, c in enumerate(cols.values())}
    if unique:
        found = [F.max(c).alias(v) for v, c in zip(values, cols)]
        right = dim.groupBy(*[F.col(k).alias(name) for name, k in keys.items()]).agg(F.count(F.lit(1)).alias("_n"), *found)
    else:
        right = dim.selectExpr(*[f"{k} as {name}" for name, k in keys.items()], *[f"{c} as {v}" for v, c in zip(values, cols)])
    test = F.expr(" and ".join(f"{left} = {name}" for left, name in zip(on, keys)))
    taken = []
    for v, new in zip(values, cols.values()):
        guarded = f"case when _n > 1 then raise_error('more than one {new} for one key') else {v} end"
        taken.append(f"{guarded if unique else v} as {new}")
    helpers = ", ".join([*keys, *values, *(["_n"] if unique else [])])
    return df.join(right, test, "left").selectExpr(f"* except ({helpers})", *taken)


def scalar(df: DataFrame, value: Column) -> Column:
    """One value of a whole table as a scalar subquery; an aggregate keeps it to one row."""
    return df.agg(F.max(value)).scalar()


def only(df: DataFrame, value: Column, what: str) -> Column:
    """One value of a table that may hold one row at most, as a scalar subquery; a second row is an error, none is null."""
    error = F.raise_error(F.lit(f"more than one {what}"))
    return df.agg(F.when(F.count(F.lit(1)) > 1, error).otherwise(F.max(value))).scalar()


def env_value(t: dict[str, DataFrame], key: str) -> Column:
    """The setting as the report prints it: the greatest, if it is given twice."""
    return scalar(t["env_param"].where(F.col("param_key") == key), F.col("param_val_text"))


def env_setting(t: dict[str, DataFrame], key: str) -> Column:
    """The setting as transfers use it: it must not be given twice."""
    return only(t["env_param"].where(F.col("param_key") == key), F.col("param_val_text"), key)


def currency_factor(t: dict[str, DataFrame]) -> Column:
    given = t["system_preference"].where(F.col("preference_code") == "CURRENCY_FACTOR")
    factor = only(given, F.col("default_value").cast("decimal(20,6)"), "CURRENCY_FACTOR")
    return F.coalesce(factor, F.lit(DEFAULT_FACTOR).cast("decimal(20,6)"))


def with_params(df: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Add the run-wide settings: ``factor``, ``local_currency`` and ``home_country``."""
    return df.withColumns(
        {
            "factor": currency_factor(t),
            "local_currency": env_setting(t, "CURRENCY_CODE"),
            "home_country": env_setting(t, "COMPLIANCE_INSTITUTE"),
        }
    )


def valid_country(df: DataFrame, country: DataFrame, col: str, flag: str) -> DataFrame:
    """Whether ``col`` is the code of an active country."""
    active = country.where(F.col("status") == "Y").select(F.col("country_iso").alias("_code")).distinct()
    joined = df.join(active, F.col(col) == F.col("_code"), "left")
    return joined.selectExpr("* except (_code)", f"_code is not null as {flag}")


def last_two(c: Column) -> Column:
    return blank_to_null(F.right(c, F.lit(2)))
