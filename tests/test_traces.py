import random

import pytest
from pyspark.sql import functions as F

from chainlake.operators import derive, quality
from chainlake.registry.adapters import ONE_PASS, VIEWS, Tables
from chainlake.registry.rows_q import raw_traces
from chainlake.sources import payloads
from conftest import listed

SCHEMA = ("transaction_hash string, trace_address array<int>, error string, trace_type string, block_number int,"
          "reward_type string, from_address string, to_address string, value decimal(38,0), output string")


def trace(tx, path, error=None, kind="call", block=1, **more):
    row = {"reward_type": None, "from_address": None, "to_address": None, "value": None, "output": None, **more}
    return (tx, path, error, kind, block, row["reward_type"], row["from_address"], row["to_address"], row["value"],
            row["output"])


def random_tree(rng, tx):
    rows, todo = [], [[]]
    while todo:
        path = todo.pop()
        error = rng.choice([None, None, None, "", "bad"])
        rows.append(trace(tx, path, error))
        if len(path) < 6:
            todo += [path + [i] for i in range(rng.choice([0, 1, 2, 3]))]
    return rows


def expected_status(rows):
    failed = {(r[0], tuple(r[1])) for r in rows if r[2]}
    return {
        (r[0], tuple(r[1])): 0 if any((r[0], tuple(r[1][:n])) in failed for n in range(len(r[1]) + 1)) else 1
        for r in rows
    }


def test_status_follows_failed_ancestors(spark):
    rng = random.Random(3)
    rows = [r for i in range(12) for r in random_tree(rng, f"0x{i}")]
    # One transaction with a third of all rows below a failed root.
    hub = [trace("0xhub", [], "bad")] + [trace("0xhub", [i]) for i in range(len(rows) // 2)]
    rows += hub
    got = derive.trace_status(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.transaction_hash, tuple(r.trace_address)): r.status for r in got} == expected_status(rows)
    assert len(got) == len(rows)


def test_status_of_deep_and_wide_trees(spark):
    # A chain of 1000 calls that fails in the middle, siblings of a failed call, a repeated path.
    deep = [trace("0xd", [0] * n, "bad" if n == 500 else None) for n in range(1001)]
    wide = [trace("0xw", []), trace("0xw", [0], "bad"), trace("0xw", [1]), trace("0xw", [10]), trace("0xw", [2**31 - 2])]
    wide += [trace("0xw", [0, i, i % 7]) for i in range(3000)] + [trace("0xw", [0])]
    nested = [trace("0xn", p, "bad" if p in ([0], [0, 1], [2, 0]) else None)
              for p in ([], [0], [0, 0], [0, 1], [0, 1, 5], [0, 2], [1], [2], [2, 0], [2, 0, 0], [2, 1], [3])]
    rows = deep + wide + nested
    frame = spark.createDataFrame(rows, SCHEMA)
    found = derive.trace_status(frame)
    got = listed(found, "transaction_hash", "trace_address", "error", "status")
    want = expected_status(rows)
    want[("0xw", (0,))] = None
    for tx, path, error, status in got:
        expected = want[(tx, tuple(path))]
        assert status == (0 if error else 1) if expected is None else status == expected
    assert len(got) == len(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_block_scoped_traces_stand_alone(spark):
    rows = [trace(None, [], None, "reward"), trace("", [], "bad", "reward"), trace("0x1", [], None)]
    got = derive.trace_status(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.status for r in got.collect()) == [0, 1, 1]


def test_missing_parent(spark):
    rows = [trace("0x1", []), trace("0x1", [0, 1]), trace("0x1", [0]), trace("0x2", [3, 0]), trace("0x2", [])]
    found = derive.orphan_traces(spark.createDataFrame(rows, SCHEMA))
    assert listed(found, "transaction_hash", "trace_address") == [("0x2", [3, 0])]


def test_trace_ids(spark):
    rows = [trace("0x1", [0, 2]), trace("0x1", []), trace(None, [], kind="reward", reward_type="uncle", to_address="b"),
            trace(None, [], kind="reward", reward_type="block", to_address="z"),
            trace(None, [], kind="reward", reward_type="uncle", to_address="a"),
            trace(None, [], kind="reward", block=2, reward_type="block", to_address="a")]
    got = derive.number_traces(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.trace_id for r in got.collect()) == [
        "call_0x1_", "call_0x1_0_2", "reward_1_0", "reward_1_1", "reward_1_2", "reward_2_0"]


def test_contracts_come_from_successful_creations(spark):
    code = "0x63" + "70a08231" + "5b"
    rows = [trace("0x1", [], kind="create", to_address="0xc1", output=code),
            trace("0x2", [], "bad", kind="create", to_address="0xc2", output=code),
            trace("0x3", [], kind="create", to_address="", output=code),
            trace("0x4", [], kind="call", to_address="0xc4", output=code)]
    rated = derive.trace_status(spark.createDataFrame(rows, SCHEMA))
    assert listed(derive.contracts_from_traces(rated), "address", "function_sighashes") == [("0xc1", ["0x70a08231"])]


def test_seed_traces_respect_the_range(spark):
    base = spark.createDataFrame([trace("0x1", [], block=5)], SCHEMA)
    genesis = spark.createDataFrame([("0xg", 10)], "address string, value long")
    forks = spark.createDataFrame([("0xa", "0xb", 3)], "from_address string, to_address string, value long")
    both = derive.with_seed_traces(base, genesis, forks, 100, 0, 200)
    assert listed(both, "trace_type", "block_number", "status") == [("call", 5, None), ("daofork", 100, 1), ("genesis", 0, 1)]
    later = derive.with_seed_traces(base, genesis, forks, 100, 1, 99)
    assert later.count() == 1


def test_count_checks(spark):
    a, b = spark.range(3), spark.range(2)
    quality.assert_same_count(a, a)
    with pytest.raises(ValueError):
        quality.assert_same_count(a, b)
    left, seen_left = quality.counted(a, "left")
    right, seen_right = quality.counted(b, "right")
    left.write.format("noop").mode("overwrite").save()
    right.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError):
        quality.assert_observed(seen_left, seen_right)


def test_rules_name_every_problem(spark):
    rows = spark.createDataFrame(
        [("ETH", "block", "0000000001", "0000000009"), ("??", "thing", "0000000009", "0000000001")],
        "chain_key string, type string, start_block string, end_block string")
    found = quality.invalid_rows(rows).collect()
    assert [sorted(r.problems) for r in found] == [["reversed range", "unknown chain", "unknown entity type"]]


def test_the_view_of_calls_reads_a_transaction_once(spark):
    tx = spark.createDataFrame(
        [(1, "0xa", 0, "0xaa1", "0xcc1", 5, 21000, 7, 1), (1, "0xb", 1, "0xaa2", None, 0, 80000, 7, 0),
         (2, "0xc", 0, None, "0xcc1", None, 50000, None, None), (None, None, None, "0xaa1", "0xcc2", 1, None, 3, 1),
         (1, "0xa", 0, "0xaa1", "0xcc1", 5, 21000, 7, 1)],
        "block_number long, hash string, transaction_index long, from_address string, to_address string, "
        "cents long, gas long, receipt_gas_used long, receipt_status int") \
        .selectExpr("*", "cast(cents as decimal(38,0)) as value", "timestamp '2023-01-01' as block_timestamp", "'0xh' as block_hash")
    one, three = (spark.sql(views["trace_rows"], transactions=tx) for views in (ONE_PASS, VIEWS))
    assert one.dtypes == three.dtypes
    assert sorted(map(str, one.collect())) == sorted(map(str, three.collect()))
    assert "Union" not in one._jdf.queryExecution().optimizedPlan().toString()


def test_counting_calls_reads_no_column_of_a_transaction(spark, tmp_path):
    spark.createDataFrame(
        [(1, "0xa", 0, "0xaa1", "0xcc1", 5, 21000, 7, 1), (1, "0xb", 1, None, None, 0, None, 7, 0)],
        "block_number long, hash string, transaction_index long, from_address string, to_address string, "
        "cents long, gas long, receipt_gas_used long, receipt_status int") \
        .selectExpr("*", "cast(cents as decimal(38,0)) as value", "timestamp '2023-01-01' as block_timestamp",
                    "'0xh' as block_hash").write.parquet(f"{tmp_path}/tx")
    calls = spark.sql(ONE_PASS["trace_rows"], transactions=spark.read.parquet(f"{tmp_path}/tx")).groupBy().count()
    assert "ReadSchema: struct<>" in calls._jdf.queryExecution().executedPlan().toString()
    assert calls.first()[0] == 6


def test_payloads_of_traces_are_made_behind_one_shuffle_of_transactions(spark, tmp_path):
    """Quantities cover created contracts and failures; two lines are the same, one has no part and so no hash."""
    lines = [(o, 3, 4, n, float(5 * n + 20 * (o % 2)), 9.5, 0.0, 0.01, "R" if n == 2 else "N", "O") for o in (1, 2) for n in (1, 2, 3)]
    lines += [lines[0], (1, None, 4, 4, 1.0, 9.5, 0.0, 0.01, "N", "O"), (2, 3, 4, 5, 50.0, 9.5, 0.0, 0.01, "A", "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7), (2, 8)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    t = Tables(spark, str(tmp_path))
    docs = raw_traces(t)
    assert docs.count() == t.transactions.select("hash").distinct().count() == 8
    assert "Generate" not in docs._jdf.queryExecution().executedPlan().toString()
    got = payloads.parse_traces(docs).select(
        "transaction_hash", F.array_join(F.col("trace_address").cast("array<string>"), ","), "block_number", "transaction_index",
        "from_address", "to_address", "trace_type", "call_type", "subtraces", "output", "error", F.col("value").cast("long"))
    want = t.trace_rows.select(
        "transaction_hash", "path", "block_number", "transaction_index", "from_address", "to_address", "trace_type", "call_type",
        "subtraces", "output", F.nullif("error", F.lit("")), F.col("gas_used").cast("long"))
    assert listed(got) == listed(want) and got.count() == 3 * len(lines)
    assert [r.n for r in docs.selectExpr("size(from_json(value, 'struct<result:array<string>>').result) as n").collect()].count(6) == 1
