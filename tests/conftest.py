import datetime as dt
import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratamart import contracts
from stratamart.session import tune

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("stratamart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def day(text):
    return None if text is None else dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def headers(spark):
    """Build order headers from (order_id, customer_id, date, amount, payment)."""

    def build(*rows):
        typed = [
            (o, c, day(d), None if a is None else Decimal(str(a)), p) for o, c, d, a, p in rows
        ]
        return spark.createDataFrame(typed, contracts.ORDERS_HEADER)

    return build


@pytest.fixture(scope="session")
def details(spark):
    """Build lines from (order_id, line_id, product_id, units, amount, promo, category)."""

    def build(*rows):
        typed = [
            (o, n, p, q, None if a is None else Decimal(str(a)), f, k)
            for o, n, p, q, a, f, k in rows
        ]
        return spark.createDataFrame(typed, contracts.ORDERS_DETAIL)

    return build


@pytest.fixture(scope="session")
def people(spark):
    """Build customers from (customer_id, channel, state)."""

    def build(*rows):
        return spark.createDataFrame(
            [(c, f"name {c}", channel, state) for c, channel, state in rows], contracts.CUSTOMERS
        )

    return build


def values(df, *columns):
    """Rows of the given columns as a sorted list, NULLs last."""
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda row: [(v is None, v if v is not None else 0) for v in row])


def final_plan(df):
    """The executed plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
