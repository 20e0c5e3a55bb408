import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chainlake.plans import activity, pricing
from conftest import listed

DAY = 86400
T0 = 1672531200  # midnight


def quotes(spark, rows):
    return spark.createDataFrame(rows, "id long, rank long, open double, close double, timestamp long")


def at(seconds):
    return datetime(2023, 1, 1) + timedelta(seconds=seconds)


def test_bounds_are_strict(spark):
    prices = quotes(spark, [(1, 1, 2.0, 4.0, T0 + DAY)])
    tx = spark.createDataFrame([(i, at(s)) for i, s in enumerate([0, 1, DAY - 1, DAY, DAY + 1])],
                               "i int, block_timestamp timestamp")
    for basis, value in (("open", 2.0), ("close", 4.0), ("mean", 3.0)):
        got = pricing.with_interval_price(tx, prices, 1, basis=basis)
        assert listed(got, "i", "price") == [(0, None), (1, value), (2, value), (3, None), (4, None)]
    with pytest.raises(ValueError):
        pricing.with_interval_price(tx, prices, 1, basis="low")


def test_bucketed_join_equals_the_literal_range_join(spark):
    rng = random.Random(5)
    # Quotes at any second, some less than a day apart, so rows can match several.
    prices = quotes(spark, [(rng.randint(1, 3), 1, float(i), 0.0, T0 + rng.randint(-DAY, 6 * DAY)) for i in range(60)])
    stamps = [rng.randint(-DAY, 6 * DAY) for _ in range(150)] + [0, DAY, DAY - 1, 2 * DAY + 1]
    tx = spark.createDataFrame([(i, rng.choice([1, 2, 3, None]), at(s)) for i, s in enumerate(stamps)],
                               "i int, pid long, block_timestamp timestamp")
    got = pricing.with_interval_price(tx, prices, "pid")
    p = prices.select(F.col("id").alias("_id"), F.timestamp_seconds("timestamp").alias("_e"), F.col("open").alias("price"))
    literal = tx.join(p, (F.col("pid") == F.col("_id")) & (F.col("block_timestamp") < F.col("_e"))
                      & (F.col("block_timestamp") > F.col("_e") - F.expr("interval 1 day")), "left")
    assert listed(got, "i", "price") == listed(literal, "i", "price")
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_native_leg_is_not_a_nested_loop(spark):
    prices = quotes(spark, [(1, 1, 2.0, 4.0, T0 + DAY)])
    tx = spark.createDataFrame([(1, at(5))], "i int, block_timestamp timestamp")
    plan = pricing.with_interval_price(tx, prices, 1)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_transactions_stay_where_they_are_for_native_prices(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prices = quotes(spark, [(1, 1, 2.0, 4.0, T0 + DAY)])
        tx = spark.createDataFrame([(1, at(5))], "i int, block_timestamp timestamp")
        for priced in (pricing.with_interval_price(tx, prices, 1), pricing.with_daily_price(tx, prices, 1)):
            plan = priced._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
            # The one shuffle is that of the quotes, into one row per day.
            assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(_day")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_volume_keeps_null_roles_apart(spark):
    rows = spark.createDataFrame([("a", "b", None, 1.0), ("a", None, "t", 2.0), ("b", "a", "t", None)],
                                 "from_address string, to_address string, token_contract string, volume double")
    assert listed(activity.address_volume(rows)) == sorted([
        ("a", 3.0), ("b", None), ("b", 1.0), (None, 2.0), ("a", None), (None, 1.0), ("t", 2.0)], key=repr)
    assert listed(activity.address_volume(rows, exclude_null=True)) == sorted(
        [("a", 3.0), ("b", None), ("b", 1.0), ("a", None), ("t", 2.0)], key=repr)


def test_wallets_exclude_contracts_and_burns(spark):
    zero = "0x" + "0" * 40
    rows = spark.createDataFrame([("a", "c"), ("a", "c"), ("b", "c"), ("k", "c"), (zero, "c"), ("a", zero), ("a", None)],
                                 "from_address string, to_address string")
    known = spark.createDataFrame([("k",), ("k",)], "address string")
    assert listed(activity.unique_active_wallets(rows, known)) == [("c", 2)]


def test_block_range_edges(spark):
    blocks = spark.createDataFrame([(i, at(10 * i)) for i in range(1, 6)], "number long, timestamp timestamp")
    found = lambda a, b: listed(activity.block_range(blocks, T0 + a, T0 + b))[0]
    assert found(20, 35) == (2, 3)
    assert found(0, 35) == (0, 3)      # starts before the first block
    assert found(10, 35) == (0, 3)     # block 1 brings block 0 along
    for bad in ((20, 51), (21, 29)):
        with pytest.raises(Exception):
            found(*bad)
    with pytest.raises(ValueError):
        activity.block_range(blocks, 5, 4)


def test_running_stats_do_not_depend_on_the_split(spark):
    rows = spark.createDataFrame([("a", "b", 1, 10, 2), ("b", "a", 2, 10, 3), ("a", None, 3, 5, 1)],
                                 "from_address string, to_address string, block_number long, receipt_gas_used long, gas_price long")
    whole = activity.address_stats(rows)
    for cut in (0, 1, 2, 3):
        state = activity.address_stats(rows.where(F.col("block_number") <= cut))
        assert listed(activity.cumulative_stats(state, rows.where(F.col("block_number") > cut))) == listed(whole)


@pytest.mark.parametrize("rows", [0, 200_000])
def test_token_facts_meet_the_rows_once(spark, rows):
    rng = random.Random(8)
    prices = quotes(spark, [(rng.randint(1, 4), 1, float(i), 0.0, T0 + rng.randint(-DAY, 4 * DAY)) for i in range(60)])
    names = ["0xAa", "0xaa", "0xbb", "0xCc", "0xdd", "0xee", None]
    # A token listed twice, one without decimals, one without any row, ids under two spellings, an id of no address.
    tokens = spark.createDataFrame([("0xaa", 6), ("0xBB", 18), ("0xbb", 18), ("0xcc", None), (None, 3)],
                                   "address string, decimals int")
    ids = spark.createDataFrame([("0xAa", 1), ("0xaa", 2), ("0xaa", 3), ("0xbb", 2), ("0xcc", 3), ("0xdd", 4), (None, 1)],
                                "eth string, id long")
    moved = spark.createDataFrame(
        [(f"0x{i}", rng.choice([*names, "0xbb", "0xbb", "0xbb"]), at(rng.randint(-DAY, 4 * DAY))) for i in range(200)],
        "transaction_hash string, token_address string, tx_timestamp timestamp")
    found = pricing.with_token_facts(moved, pricing.token_facts(tokens, ids, "eth"), rows=rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The rows meet the token once; the other join is between the two tables of tokens.
    assert plan.count("Join LeftOuter") == 1 and plan.count("Join FullOuter") == 1
    assert ("_salt" in plan) == (rows == 0)
    found = pricing.with_interval_price(found, prices, "price_id", "tx_timestamp", rows=rows)
    scale = tokens.select(F.lower("address").alias("_t"), "decimals")
    plain = pricing.with_price_id(moved.join(scale, F.lower("token_address") == F.col("_t"), "left"), ids, "eth")
    p = prices.select(F.col("id").alias("_id"), F.timestamp_seconds("timestamp").alias("_e"), F.col("open").alias("price"))
    literal = plain.join(p, (F.col("price_id") == F.col("_id")) & (F.col("tx_timestamp") < F.col("_e"))
                         & (F.col("tx_timestamp") > F.col("_e") - F.expr("interval 1 day")), "left")
    same = ["transaction_hash", "token_address", "decimals", "price_id", "price"]
    assert listed(found, *same) == listed(literal, *same)


def test_native_quotes_of_very_many_days_leave_the_rows_where_they_are(spark):
    prices = spark.range(210_000).select(F.lit(1).cast("long").alias("id"), F.lit(1).cast("long").alias("rank"),
                                         F.col("id").cast("double").alias("open"), F.lit(0.0).alias("close"),
                                         (F.lit(T0) + (F.col("id") + 1) * DAY).alias("timestamp"))
    tx = spark.createDataFrame([("a", at(5)), ("b", at(DAY)), ("c", at(3 * DAY + 1)), ("d", at(-1)), ("e", None)],
                               "hash string, block_timestamp timestamp")
    for found in (pricing.with_interval_price(tx, prices, 1), pricing.with_daily_price(tx, prices, 1, basis="open")):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" not in plan and "broadcast" in plan
    # A quote at midnight is listed once, under the day it covers, and a time on its bound meets nothing.
    assert listed(pricing.with_interval_price(tx, prices, 1), "hash", "price") == [
        ("a", 0.0), ("b", None), ("c", 3.0), ("d", None), ("e", None)]
