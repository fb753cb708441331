import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.schema import TRANSACTION  # noqa: E402
from tillflow.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_tx(spark):
    """Transactions from dicts; what a dict leaves out has a plain value."""
    plain = dict(
        transaction_id=1, date=dt.date(2024, 1, 1), day_of_week="Mon", store_id="S001",
        region="North", product_id="P0001", category="Toys", units_sold=1,
        unit_price=Decimal("1.00"), promotion_flag=0, discount_pct=0,
        sales_amount=Decimal("1.00"),
    )

    def make(*rows):
        return spark.createDataFrame(
            [tuple({**plain, **row}[name] for name in TRANSACTION.fieldNames()) for row in rows],
            TRANSACTION,
        )
    return make


@pytest.fixture(scope="session")
def make_daily(spark):
    """A daily series of (date text, revenue)."""
    def make(*rows):
        return spark.createDataFrame(
            [(dt.date.fromisoformat(d), Decimal(str(r))) for d, r in rows],
            "date date, daily_revenue decimal(28,2)",
        )
    return make


@pytest.fixture(scope="session")
def make_predictions(spark):
    """A prediction table of (date text, actual, predicted)."""
    def make(*rows):
        from tillflow.schema import PREDICTION
        full = []
        for d, actual, predicted in rows:
            date = dt.date.fromisoformat(d)
            number = date.isoweekday() % 7 + 1
            full.append((date, float(actual), float(predicted), number,
                         int(number in (1, 7)), int(date.month in (11, 12))))
        return spark.createDataFrame(full, PREDICTION)
    return make


def days(start, n):
    first = dt.date.fromisoformat(start)
    return [(first + dt.timedelta(i)).isoformat() for i in range(n)]
