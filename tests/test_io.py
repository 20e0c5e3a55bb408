import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake import schemas
from chainlake.operators import rows
from chainlake.plans import serving
from chainlake.sinks import writers
from chainlake.sources import tables
from conftest import listed


def logs(spark, n=50):
    base = datetime(2023, 1, 1)
    data = [(i, f"0x{i}", 0, "0xA", "0x", ["t"], i, base.replace(day=1 + i % 3, hour=i % 24), "0xb") for i in range(n)]
    return spark.createDataFrame(data, "log_index int, transaction_hash string, transaction_index int, address string,"
                                       "data string, topics array<string>, block_number int, block_timestamp timestamp,"
                                       "block_hash string")


def test_entity_round_trip_by_day_and_hour(spark, tmp_path):
    df = logs(spark)
    writers.write_entity(df, str(tmp_path / "d"), "log")
    found = tables.read_entity(spark, str(tmp_path / "d"), "log", "2023-01-02", "2023-01-03")
    assert found.count() == df.where("day(block_timestamp) in (2, 3)").count()
    assert [f.name for f in found.schema.fields][:-1] == schemas.LOG.names
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    writers.write_entity(df, str(tmp_path / "h"), "log", by_hour=True)
    by_hour = tables.read_entity(spark, str(tmp_path / "h"), "log", "2023-01-01", "2023-01-01", by_hour=True)
    assert listed(by_hour.select("hour").distinct()) == listed(df.where("day(block_timestamp) = 1").select(F.hour("block_timestamp")).distinct())


def test_rewriting_a_day_leaves_the_others(spark, tmp_path):
    base = str(tmp_path)
    writers.write_entity(logs(spark), base, "log")
    fewer = logs(spark).where("day(block_timestamp) = 2").limit(1)
    writers.write_entity(fewer, base, "log")
    counts = dict(listed(tables.read_entity(spark, base, "log").groupBy(F.dayofmonth("date")).count()))
    assert counts == {1: 17, 2: 1, 3: 16}


def test_corrupt_files_are_skipped_only_on_request(spark, tmp_path):
    base = str(tmp_path)
    writers.write_entity(logs(spark), base, "log")
    day = os.path.join(base, "logs", "date=2023-01-02")
    with open(os.path.join(day, "part-bad.parquet"), "wb") as f:
        f.write(b"not parquet")
    assert tables.read_entity(spark, base, "log", skip_corrupt=True).count() == 50
    with pytest.raises(Exception):
        tables.read_entity(spark, base, "log").select(F.max("address")).collect()


def test_block_range_folders(spark, tmp_path):
    df = logs(spark).select("log_index", "block_number")
    placed = tables.assign_partitions(df, "block_number", batch=20, first=0, last=49)
    assert listed(placed.select("start_block", "end_block").distinct()) == [
        ("0000000000", "0000000019"), ("0000000020", "0000000039"), ("0000000040", "0000000049")]
    placed.write.partitionBy("start_block", "end_block").option("header", True).csv(str(tmp_path / "logs"))
    kind = T.StructType.fromDDL("log_index int, block_number int")
    found = tables.read_block_range_csv(spark, str(tmp_path), "log", 40, kind)
    assert sorted(r.block_number for r in found.collect()) == list(range(40, 50))
    for bad in ((5, 4), (-1, 4)):
        with pytest.raises(ValueError):
            tables.assign_partitions(df, "block_number", batch=20, first=bad[0], last=bad[1])


def test_export_labels_and_files(spark, tmp_path):
    assert [writers.range_label("2023-01-01", e) for e in ("2023-01-01", "2023-01-02", "2023-01-07", "2023-01-08")] == [
        "date", "week", "week", "month"]
    with pytest.raises(ValueError):
        writers.range_label("2023-01-02", "2023-01-01")
    path = writers.export_csv(spark.range(100).repartition(5), str(tmp_path), "volume", "2023-01-01", "2023-01-01", True)
    assert path.endswith("/volume/date/start=2023-01-01_end=2023-01-01")
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


def test_item_files_by_suffix(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "a.json").write_text(json.dumps({"x": "1", "y": "2"}) + "\n")
    assert listed(tables.read_items(spark, str(tmp_path / "a.csv"))) == listed(tables.read_items(spark, str(tmp_path / "a.json")))
    with pytest.raises(ValueError):
        tables.read_items(spark, str(tmp_path / "a.txt"))


def test_price_files(spark, tmp_path):
    (tmp_path / "start=2023-01-01_end=2023-01-01.csv").write_text("1,2,3.5,4.5,1672531200\n")
    assert listed(tables.read_price_history(spark, str(tmp_path), "2023-01-01")) == [(1, 2, 3.5, 4.5, 1672531200)]


def test_contracts_below_any_folder(spark, tmp_path):
    row = spark.createDataFrame([("0xa", "0x")], "address string, bytecode string")
    for part in ("start_block=1", "start_block=2"):
        schemas.conform(row, "contract").write.parquet(str(tmp_path / "contracts" / part))
    assert tables.read_contracts(spark, str(tmp_path)).count() == 2


def test_priced_rows_read_back_typed(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("1", "a", "2.5")], "block_number string, from_address string, volume string").write.option(
        "header", True).csv(path)
    back = tables.read_pre_tx(spark, path)
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["decimal(38,0)", "string", "double"]


def test_table_sinks(spark):
    spark.sql("drop table if exists t_append")
    spark.createDataFrame([(1, "a")], "x int, y string").write.saveAsTable("t_append")
    writers.append_by_name(spark.createDataFrame([("b", 2)], "y string, x int"), "t_append")
    assert listed(spark.table("t_append")) == [(1, "a"), (2, "b")]
    writers.replace_table(spark.createDataFrame([(9, "z")], "x int, y string"), "t_append")
    assert listed(spark.table("t_append")) == [(9, "z")]


def test_partition_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = [("a", 1, "2023-01-01"), ("b", 2, "2023-01-01"), ("c", 3, "2023-01-02")]
    kind = "k string, v int, date string"
    spark.createDataFrame(rows_, kind).write.partitionBy("date").parquet(path)
    untouched = os.listdir(os.path.join(path, "date=2023-01-02"))
    writers.upsert_partitions(path, spark.createDataFrame([("b", 20, "2023-01-01"), ("d", 4, "2023-01-01")], kind), ["k"])
    back = spark.read.schema(kind).parquet(path)
    assert listed(back, "k", "v") == [("a", 1), ("b", 20), ("c", 3), ("d", 4)]
    assert os.listdir(os.path.join(path, "date=2023-01-02")) == untouched


def test_fan_out_computes_once(spark, tmp_path):
    hits = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            hits.add(len(batch))
            yield batch

    df = spark.range(10).mapInPandas(count, "id long")
    sinks = [lambda d, n=n: d.write.parquet(str(tmp_path / n)) for n in ("a", "b")]
    writers.fan_out(df, sinks)
    writers.append_escrow_values(spark.range(3), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 13 and hits.value == 10


def bundle_inputs(spark):
    blocks = spark.createDataFrame([(1, "b1"), (2, "b2"), (3, "b3")], "number long, hash string")
    tx = spark.createDataFrame([(1, i, f"h{i:03d}") for i in range(95)] + [(2, 0, "x"), (9, 0, "lost")],
                               "block_number long, transaction_index long, hash string")
    item = spark.createDataFrame([(2, 0, "x")], "block_number long, log_index long, transaction_hash string")
    return blocks, tx, item


def test_bundles_split_a_big_block(spark):
    blocks, tx, item = bundle_inputs(spark)
    docs = writers.block_bundles(blocks, tx, item, item, part_rows=10).collect()
    found = sorted(t.hash for d in docs for t in d.transactions if d.block_number == 1)
    assert found == [f"h{i:03d}" for i in range(95)]
    assert len([d for d in docs if d.block_number == 1]) == 10 and max(len(d.transactions) for d in docs) < 40
    by_number = {d.block_number: d for d in docs}
    assert set(by_number) == {1, 2, 3} and by_number[3].transactions == [] and by_number[3].block.hash == "b3"
    whole = writers.block_bundles(blocks, tx, item, item).where("block_number = 1").collect()
    assert [t.transaction_index for t in whole[0].transactions] == list(range(95))


def test_bundles_need_one_block_per_number(spark):
    blocks, tx, item = bundle_inputs(spark)
    with pytest.raises(Exception, match="more than one block"):
        writers.block_bundles(blocks.union(blocks), tx, item, item).collect()


def test_converters_chain(spark):
    df = spark.createDataFrame([(5, 1672531200, "x", None)], "n int, block_timestamp long, s string, m long")
    out = rows.convert(df, [rows.EPOCH_TO_TEXT, rows.INT_TO_DECIMAL])
    assert [str(v) for v in out.first()] == ["5", "2023-01-01 00:00:00", "x", "None"]
    assert out.schema["n"].dataType == T.DecimalType(38, 0)
    assert rows.convert(df, [rows.int_to_text("n")]).schema["m"].dataType == T.LongType()


def test_needed_entities():
    close = rows.entity_closure
    assert close(["token"]) == {"block", "token", "contract", "trace"}
    assert close(["token_transfer"]) == {"block", "token_transfer", "log", "receipt", "transaction"}
    assert close(["transaction"]) == {"block", "transaction", "receipt"}
    assert close(["log"]) == {"block", "log", "transaction"}
    assert close([]) == {"block"}
    with pytest.raises(ValueError):
        close(["nonsense"])


def test_kafka_rows(spark):
    df = spark.createDataFrame([(1, None)], "number int, hash string")
    row = writers.to_kafka_rows(df, "block").first()
    assert (row.topic, row.key, json.loads(row.value)) == ("blocks", None, {"type": "block", "number": 1, "hash": None})


def test_not_in_list_drops_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "address string")
    assert listed(rows.exclude_addresses(df, ["a"])) == [("b",)]


def test_lookups_are_not_cut(spark):
    rows = spark.range(1200).selectExpr("'a' address", "id * 1.0d reputation_score", "date_add(date'2020-01-01', cast(id as int)) date")
    assert serving.score_series(rows, ["A"]).count() == 1200
    assert serving.score_series(rows, ["A"], most=7).count() == 7


def test_chains_and_case():
    assert serving.chain_prefix("MATIC") == "matic" and serving.chain_prefix("nope") == "eth"
    assert serving.fold_addresses(["0xAB"], "eth") == ["0xab"] and serving.fold_addresses(["rAB"], "xrp") == ["rAB"]
    with pytest.raises(ValueError):
        serving.fold_addresses([])


def test_ranking_arguments_are_checked(spark):
    df = spark.createDataFrame([("a", "0")], "address string, identity string")
    for bad in ({"sort": "address; drop"}, {"order": "sideways"}, {"take": 5}, {"take": 500}):
        with pytest.raises(ValueError):
            serving.rank_addresses(df, df, df, **bad)


def test_bundles_move_each_item_once(spark):
    blocks, tx, item = bundle_inputs(spark)
    plan = writers.block_bundles(blocks, tx, item, item)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "ObjectHash" not in plan


@pytest.mark.parametrize("part_rows", [None, 10])
def test_items_without_a_number_meet_no_block(spark, part_rows):
    blocks, tx, item = bundle_inputs(spark)
    blocks = blocks.withColumn("number", F.when(F.col("number") != 3, F.col("number")))
    tx = tx.withColumn("block_number", F.when(F.col("block_number") != 1, F.col("block_number")))
    docs = writers.block_bundles(blocks, tx, item, item, part_rows=part_rows).collect()
    assert {d.block_number for d in docs} == {1, 2, None}
    assert [len(d.transactions) for d in docs if d.block_number is None] == [0]
    assert sum(len(d.transactions) for d in docs if d.block_number == 1) == 0
