import pytest
from pyspark.sql import functions as F

from tillflow.operators.keys import _placed, surrogate_key
from tillflow.operators.lookups import lookup


@pytest.mark.parametrize("rows, parts", [(0, 3), (1, 3), (1000, 7)])
def test_keys_are_contiguous_and_in_order(spark, rows, parts):
    df = spark.range(rows, numPartitions=parts).select((F.lit(rows) - F.col("id")).alias("v"))
    found = surrogate_key(df, "v").orderBy("v").collect()
    assert [r.transaction_id for r in found] == list(range(1, rows + 1))


def test_keys_go_on_from_a_start_and_take_equal_sort_keys(spark):
    df = spark.range(300).select(F.lit(7).alias("v"), "id")
    found = surrogate_key(df, "v", name="n", start=501).collect()
    assert sorted(r.n for r in found) == list(range(501, 801))
    assert len({r.id for r in found}) == 300


def test_a_key_that_is_most_of_the_rows_is_spread_by_more_columns(spark):
    df = spark.range(20000, numPartitions=4).select(F.least(F.col("id"), F.lit(5)).alias("v"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = df.repartitionByRange(4, "v", "id").select(F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
        found = surrogate_key(df, "v", "id", name="n").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 10000
    assert [r.id for r in found] == list(range(20000))


def test_copies_are_spread_over_partitions(spark):
    copies = spark.range(20000, numPartitions=4).select(F.when(F.col("id") < 100, F.col("id")).otherwise(50).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in _placed(copies, ("v",), True).groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 10000
    found = surrogate_key(copies, "v", name="n", copies=True)
    assert found.columns == ["n", "v"]
    rows = found.orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 20001))
    assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_lookup_keeps_facts_without_a_match(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "key int, x string")
    dimension = spark.createDataFrame([(1, "one")], "key int, name string")
    found = {r.x: r.name for r in lookup(facts, dimension, "key").collect()}
    assert found == {"a": "one", "b": None, "c": None}


def test_a_key_with_a_third_of_the_facts_is_split(spark):
    """Neither side is broadcast, and the hot partition is shared by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("key"),
            F.xxhash64("id").alias("x"),
        )
        dimension = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("name"))
        found = lookup(facts, dimension, "key").where("name = 2 * key").select("key", "x", "name")
        counts = found.collect()
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(counts) == 300_000
    assert "skew=true" in text and "skewed" in text
