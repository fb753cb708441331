import datetime as dt
import json
from decimal import Decimal

import pytest

from tillflow.functions import codec
from tillflow.schema import MESSAGE, TRANSACTION


def messages(spark, *bodies):
    rows = [(None, None if b is None else bytearray(b, "utf-8")) for b in bodies]
    return spark.createDataFrame(rows, MESSAGE)


GOOD = json.dumps({
    "transaction_id": 1, "date": "2024-01-01", "day_of_week": "Mon", "store_id": "S001",
    "region": "North", "product_id": "P0001", "category": "Toys", "units_sold": 2,
    "unit_price": 9.99, "promotion_flag": 0, "discount_pct": 0, "sales_amount": 19.98,
})
LONG_ID = '{"transaction_id": 3000000000, "extra": [1, 2], "sales_amount": 1}'
BROKEN = ["notjson", '{"transaction_id": 2, "units_sold": "many"}', '{"k": 1}', None]


@pytest.fixture(scope="module")
def mixed(spark):
    return messages(spark, GOOD, *BROKEN, LONG_ID)


def test_decode_keeps_the_readable_rows(mixed):
    rows = {r.transaction_id: r for r in codec.decode(mixed).collect()}
    assert set(rows) == {1, 3000000000}
    assert rows[1].date == dt.date(2024, 1, 1) and rows[1].sales_amount == Decimal("19.98")
    assert rows[3000000000].sales_amount == Decimal("1.00") and rows[3000000000].region is None


def test_dead_letters_are_the_rest(mixed):
    dead = [r.value and bytes(r.value).decode() for r in codec.dead_letters(mixed).collect()]
    assert sorted(map(str, dead)) == sorted(map(str, BROKEN))


def test_permissive_keeps_every_row(mixed):
    found = codec.decode(mixed, permissive=True)
    assert found.columns == TRANSACTION.fieldNames()
    rows = found.collect()
    assert len(rows) == 6
    assert sorted(r.transaction_id for r in rows if r.transaction_id is not None) == [1, 2, 3000000000]


@pytest.mark.parametrize("permissive", [True, False])
def test_columns_of_the_message_can_be_carried(spark, permissive):
    df = messages(spark, GOOD).selectExpr("value", "'sales' as topic", "3 as partition", "42L as offset")
    row = codec.decode(df, permissive, ("topic", "partition", "offset")).first()
    assert (row.topic, row.partition, row.offset, row.transaction_id) == ("sales", 3, 42, 1)


def test_encode_writes_plain_json(make_tx):
    row = codec.encode(make_tx(dict(region=None, unit_price=Decimal("2.50")))).first()
    body = json.loads(bytes(row.value).decode())
    assert row.key is None
    assert body["date"] == "2024-01-01" and body["unit_price"] == 2.5
    assert body["region"] is None and list(body) == TRANSACTION.fieldNames()


def test_encode_with_a_key(make_tx):
    row = codec.encode(make_tx(dict(store_id="S007")), key="store_id").first()
    assert bytes(row.key) == b"S007"


def test_round_trip(make_tx):
    tx = make_tx(dict(transaction_id=1), dict(transaction_id=2, date=None, region=None), dict(transaction_id=3))
    back = codec.decode(codec.encode(tx))
    assert back.dtypes == tx.dtypes
    assert sorted(back.collect(), key=str) == sorted(tx.collect(), key=str)


def test_messages_are_parsed_once(spark, mixed):
    for df in (codec.decode(mixed), codec.decode(mixed, permissive=True)):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    condition = codec.dead_letters(mixed)._jdf.queryExecution().optimizedPlan().toString()
    assert condition.count("from_json") == 1
