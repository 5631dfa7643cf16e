import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paylane.session import prepare  # noqa: E402
from paylane.sources.tables import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)


def coerce(value, kind):
    if isinstance(value, str) and kind == "timestamp_ntz":
        return datetime.fromisoformat(value)
    if value is not None and kind.startswith("decimal"):
        return Decimal(str(value))
    return value


@pytest.fixture(scope="session")
def make(spark):
    """One source table from rows given as dicts; columns left out are missing."""

    def build(table, rows):
        schema = SCHEMAS[table]
        data = [tuple(coerce(row.get(c), kind) for c, kind in schema.items()) for row in rows]
        return spark.createDataFrame(data, ", ".join(f"{c} {kind}" for c, kind in schema.items()))

    return build


@pytest.fixture(scope="session")
def tables(make):
    """All source tables, empty but for the given ones and one plain set of settings."""

    def build(**given):
        settings = {
            "env_param": [
                {"param_key": "CURRENCY_CODE", "param_val_text": "XOF"},
                {"param_key": "COMPLIANCE_INSTITUTE", "param_val_text": "CI"},
            ],
            "service_type": [{"service_type": "P2P", "is_financial": "Y"}, {"service_type": "BILL", "is_financial": "N"},
                             {"service_type": "ROLLBACK", "is_financial": "N"}],
            "category": [{"category_code": "SUBS", "category_type": "SUBS", "domain_code": "D1"}],
        }
        return {name: make(name, given.get(name, settings.get(name, []))) for name in SCHEMAS}

    return build
