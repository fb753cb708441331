"""Column layouts shared by the batch and the streaming path."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("units_sold", T.IntegerType()),
    T.StructField("unit_price", MONEY),
    T.StructField("promotion_flag", T.IntegerType()),
    T.StructField("discount_pct", T.IntegerType()),
    T.StructField("sales_amount", MONEY),
])

#: The order tables, as written. Naming their columns saves a look into the files
#: for every scan.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}

#: One message of a topic: the payload is the UTF-8 JSON of a transaction.
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])

#: The same with where a message stands in its topic and its time, as a broker hands it out.
COORDINATED = T.StructType(MESSAGE.fields + [
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

PREDICTION = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("actual_revenue", T.DoubleType()),
    T.StructField("predicted_revenue", T.DoubleType()),
    T.StructField("day_of_week_num", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("is_holiday_season", T.IntegerType()),
])

LIVE_TOTALS = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("total_revenue", T.DecimalType(28, 2)),
    T.StructField("total_units_sold", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])

LIVE_RAW = T.StructType(TRANSACTION.fields + [
    T.StructField("received_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])

# The model's inputs, in the order of its feature vector. The four
# roll-up columns are known only when the day is over, so the model explains a
# day rather than forecasting it from the evening before; KNOWN_AHEAD is the
# part that is known then.
FEATURES = [
    "day_of_week_num",
    "month_num",
    "is_weekend",
    "is_holiday_season",
    "promo_rate",
    "avg_discount_pct",
    "transaction_count",
    "daily_units_sold",
    "prev_day_revenue",
    "rolling_7day_avg_revenue",
]
SAME_DAY = ["promo_rate", "avg_discount_pct", "transaction_count", "daily_units_sold"]
KNOWN_AHEAD = [name for name in FEATURES if name not in SAME_DAY]
LABEL = "daily_revenue"
