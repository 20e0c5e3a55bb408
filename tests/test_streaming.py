import json
import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo

from chainlake.plans import entities
from chainlake.registry import stream_q
from chainlake.operators import derive, joins
from chainlake.sources import payloads
from chainlake.streaming import blocks as st
from chainlake.streaming.entities import entity_sink, read_stored, unsettled_blocks
from chainlake.streaming.pairing import BlockPairing, pair_blocks
from chainlake.streaming.runs import complete_runs, read_runs, run_sink
from conftest import listed

KIND = "number long, hash string"


def land(spark, path, first, last):
    spark.createDataFrame([(i, f"h{i}") for i in range(first, last + 1)], KIND).coalesce(1).write.mode("append").parquet(path)


def test_blocks_wait_for_the_lag_across_restarts(spark, tmp_path):
    src, out, state, check = (str(tmp_path / n) for n in ("src", "out", "state", "check"))
    schema = spark.createDataFrame([], KIND).schema

    def cycle():
        step = st.hold_back(st.batch_sink(out), state, lag=5)
        st.run_incremental(st.stream_blocks(spark, src, schema, max_files=1), step, check).awaitTermination()
        return sorted(r.number for r in spark.read.schema(schema).parquet(out).collect())

    land(spark, src, 1, 10)
    assert cycle() == list(range(1, 6))
    land(spark, src, 11, 12)
    land(spark, src, 13, 20)
    assert cycle() == list(range(1, 16))
    assert cycle() == list(range(1, 16))
    assert len(list((tmp_path / "state" / "held").iterdir())) <= 2
    spark.createDataFrame([(None, "odd")], KIND).coalesce(1).write.mode("append").parquet(src)
    assert cycle() == list(range(1, 16))
    assert [r.hash for r in spark.read.schema(schema).parquet(f"{state}/quarantine").collect()] == ["odd"]


def test_a_broken_state_is_an_error(spark, tmp_path):
    state = tmp_path / "state"
    (state / "held" / "0").mkdir(parents=True)
    (state / "held" / "0" / "part-0.parquet").write_text("not parquet")
    rows = spark.createDataFrame([(1, "a")], KIND)
    with pytest.raises(Exception, match="(?i)parquet"):
        st.hold_back(st.batch_sink(str(tmp_path / "out")), str(state), lag=0)(rows, 1)


def test_a_start_after_a_gap_is_refused(spark):
    table = spark.createDataFrame([(15, "a")], KIND)
    st.check_start(table, 16)
    st.check_start(table.limit(0), 3)
    with pytest.raises(ValueError):
        st.check_start(table, 17)


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    sink = st.batch_sink(str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, "a")], KIND)
    sink(rows, 0)
    sink(rows, 0)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


@pytest.mark.parametrize("max_files", [1, 100])
def test_late_items_are_kept_and_repeats_dropped(spark, tmp_path, max_files):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    t0 = datetime(2023, 1, 1)
    kind = "item_id string, block_timestamp timestamp"
    for k in reversed(range(4)):  # files go back in time, by weeks
        rows = [(f"i{20 * k + i % 20}", t0 + timedelta(days=7 * k, hours=i % 20)) for i in range(30)]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(src)
    stream = st.stream_blocks(spark, src, spark.createDataFrame([], kind).schema, max_files=max_files)
    sink = st.unique_sink(out, ["item_id"])
    rows = stream.withColumn("day", F.to_date("block_timestamp"))
    st.run_incremental(rows, sink, str(tmp_path / "c")).awaitTermination()
    found = lambda: sorted(int(r.item_id[1:]) for r in read_runs(spark, out, rows.schema).collect())
    assert found() == list(range(80))
    # A batch that runs twice replaces itself.
    last = spark.createDataFrame([("i3", t0), ("i99", t0), ("i99", t0)], kind).withColumn("day", F.to_date("block_timestamp"))
    sink(last, 9)
    sink(last, 9)
    assert found() == [*range(80), 99]


def test_a_batch_of_many_days_is_stored_in_few_files(spark, tmp_path, monkeypatch):
    out, kind = str(tmp_path / "out"), "item_id string, day date"
    day = lambda first, n: spark.range(first, first + n).selectExpr(
        "cast(id as string) as item_id", "date_add(date '2023-01-01', cast(id as int)) as day")
    sink = st.unique_sink(out, ["item_id"])
    for at, batch in enumerate([day(0, 60), day(40, 60), day(0, 70), day(200, 10)]):
        if at == 2:
            monkeypatch.setattr(st, "MANY_DAYS", 5)  # the days are not listed any more
        sink(batch.unionByName(batch).unionByName(spark.createDataFrame([("x", None)], kind)), at)
    assert sorted(r.item_id for r in read_runs(spark, out, batch.schema).collect()) == sorted(
        [*map(str, range(100)), *map(str, range(200, 210)), "x"])
    assert len(list((tmp_path / "out").rglob("*.parquet"))) < 40


def test_stored_runs_stay_few(spark, tmp_path):
    """Fifty batches of partial sums, some of them tried twice, some dying before they tidy up."""
    path = str(tmp_path / "sums")
    add = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    sink, files = run_sink(path, merge=add), []
    schema = "k long, n long"
    for at in range(50):
        if at % 7 == 3:
            sink(spark.createDataFrame([(999, 999)], schema).coalesce(1), at)  # a try that is repeated
        sink(spark.createDataFrame([(at % 5, at), (5, 1)], schema).coalesce(1), at)
        if at == 20:
            # A merged run is there, and a part of it has not been deleted yet; another was cut off.
            shutil.copytree(f"{path}/run-20-20", f"{path}/run-2-2")
            shutil.copytree(f"{path}/run-20-20", f"{path}/run-0-40")
            os.remove(f"{path}/run-0-40/_SUCCESS")
        files.append(len(list((tmp_path / "sums").glob("run-*/part-*"))))
    assert max(files[25:]) <= 10 and len(complete_runs(spark, path)) <= 7
    got = dict(map(tuple, add(read_runs(spark, path, spark.createDataFrame([], schema).schema)).collect()))
    assert got == {k: sum(range(k, 50, 5)) for k in range(5)} | {5: 50}


PAIRS = "kind string, number string, value string"


def paired(spark, src, out, check, keep_ms=3_600_000):
    """Run the pairing over what has landed."""
    stream = st.stream_blocks(spark, src, spark.createDataFrame([], PAIRS).schema, max_files=1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        query = st.run_incremental(pair_blocks(stream, keep_ms=keep_ms), st.batch_sink(out), check)
        assert query.awaitTermination(200)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return query


def test_records_meet_their_block_whenever_it_comes(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    batches = [[("receipt", "1", "a"), ("receipt", "2", "b"), ("block", "2", "B2")], [("block", "3", "B3")],
               [("block", "1", "B1"), ("receipt", "3", "c"), ("block", "1", "again")], [("receipt", "1", "d")],
               [("receipt", "9", "never"), ("receipt", None, "numberless")]]
    want = [[("block", "2", "B2", True, True), ("receipt", "2", "b", True, True)], [("block", "3", "B3", True, True)],
            [("block", "1", "B1", True, True), ("block", "3", "B3", True, False), ("receipt", "1", "a", True, True),
             ("receipt", "3", "c", True, True)], [("block", "1", "B1", True, False), ("receipt", "1", "d", True, True)], []]
    for part in (batches[:3], batches[3:]):
        for rows in part:
            spark.createDataFrame(rows, PAIRS).coalesce(1).write.mode("append").parquet(src)
        # The second run goes on from the state in the checkpoint.
        paired(spark, src, out, check)
    folders = sorted(int(p.name[9:]) for p in (tmp_path / "out").iterdir())
    got = [sorted(map(tuple, spark.read.parquet(f"{out}/batch_id={at}").collect())) for at in folders]
    assert [rows for rows in got if rows] == want[:4]


def test_state_stays_flat_and_what_never_pairs_comes_out(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    for n in range(20):
        rows = [("block", str(5 * n + i), f"B{5 * n + i}") for i in range(4)]
        rows += [("receipt", str(5 * n + i), f"r{5 * n + i}") for i in range(5)]  # one of five has no block
        spark.createDataFrame(rows, PAIRS).coalesce(1).write.mode("append").parquet(src)
    progress = paired(spark, src, out, check, keep_ms=1).recentProgress
    held = [p.stateOperators[0].numRowsTotal for p in progress if p.numInputRows]
    assert len(held) == 20 and max(held[3:]) <= max(held[:3])
    for _ in range(2):
        spark.createDataFrame([("block", "1000", "B")], PAIRS).coalesce(1).write.mode("append").parquet(src)
    paired(spark, src, out, check, keep_ms=1)
    rows = spark.read.parquet(out).collect()
    assert sorted(int(r.number) for r in rows if r.kind == "receipt" and r.paired) == [n for n in range(100) if n % 5 < 4]
    assert sorted(int(r.number) for r in rows if not r.paired) == list(range(4, 100, 5))
    assert sorted(int(r.number) for r in rows if r.kind == "block" and r.new) == [n for n in range(100) if n % 5 < 4] + [1000]


def test_each_batch_builds_its_entities(spark, tmp_path):
    """Raw blocks and receipts, landed in two files, become entities per micro-batch."""
    word = lambda v: "0x" + format(v, "064x")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")

    def landed(n):
        tx = {"hash": f"0xt{n}", "nonce": "0x0", "blockHash": f"0xb{n}", "blockNumber": hex(n), "transactionIndex": "0x0",
              "from": "0xA", "to": "0xB", "value": "0x1", "gas": "0x5", "gasPrice": "0x2", "input": "0x"}
        block = {"number": hex(n), "hash": f"0xb{n}", "timestamp": hex(1000 + n), "transactions": [tx]}
        log = {"logIndex": "0x0", "transactionHash": f"0xt{n}", "transactionIndex": "0x0", "blockHash": f"0xb{n}",
               "blockNumber": hex(n), "address": "0xTT", "data": word(n), "topics": [derive.TRANSFER_TOPIC, word(1), word(2)]}
        receipt = {"transactionHash": f"0xt{n}", "transactionIndex": "0x0", "blockHash": f"0xb{n}", "blockNumber": hex(n),
                   "gasUsed": "0x3", "status": "0x1", "logs": [log]}
        return [("block", json.dumps({"result": block})), ("receipt", json.dumps({"result": receipt}))]

    for n in (16, 17):
        spark.createDataFrame(landed(n), "kind string, value string").coalesce(1).write.mode("append").parquet(src)

    def step(batch, batch_id):
        raw_blocks, raw_receipts = (batch.where(F.col("kind") == k) for k in ("block", "receipt"))
        built = entities.build_entities(
            ["block", "transaction", "log", "token_transfer"], payloads.parse_blocks(raw_blocks),
            payloads.parse_block_transactions(raw_blocks), payloads.parse_receipts(raw_receipts),
            payloads.parse_receipt_logs(raw_receipts))
        for name, df in built.items():
            df.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")

    schema = spark.createDataFrame([], "kind string, value string").schema
    st.run_incremental(st.stream_blocks(spark, src, schema, max_files=1), step, str(tmp_path / "c")).awaitTermination()
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert listed(read("token_transfer"), "item_id", "value", "block_hash", "item_timestamp") == [
        ("token_transfer_0xt16_0", "16", "0xb16", "1970-01-01T00:16:56Z"),
        ("token_transfer_0xt17_0", "17", "0xb17", "1970-01-01T00:16:57Z")]
    assert listed(read("transaction"), "item_id", "receipt_status") == [("transaction_0xt16", 1), ("transaction_0xt17", 1)]
    assert read("block").count() == 2 and read("log").count() == 2


def test_trace_entities(spark):
    selectors = "".join("63" + s for s in ("18160ddd", "70a08231", "a9059cbb", "23b872dd", "095ea7b3", "dd62ed3e"))
    code = "0x" + selectors + "5b"
    traces = spark.createDataFrame([
        (0, 1, "0xt", [], "create", None, "0xa", "0xC1", None, None, code),
        (1, 1, "0xt", [0], "call", None, "0xa", "0xb", None, "bad", "0x"),
        (2, 1, None, [], "reward", "block", None, "0xm", None, None, None),
    ], "position int, block_number int, transaction_hash string, trace_address array<int>, trace_type string,"
       "reward_type string, from_address string, to_address string, value decimal(38,0), error string, output string")
    blocks = spark.createDataFrame([(1, "0xb1", datetime(2023, 1, 1))], "number int, hash string, timestamp timestamp")
    calls = spark.createDataFrame([("0xC1", "SYM", "Name", "6", "100", 1)],
                                  "address string, symbol string, name string, decimals string, total_supply string, block_number int")
    built = entities.build_entities(["trace", "contract", "token"], blocks, traces=traces, token_calls=calls)
    assert set(built) == {"trace", "contract", "token"}
    assert listed(built["trace"], "trace_index", "trace_id", "status") == [
        (0, "create_0xt_", 1), (1, "call_0xt_0", 0), (2, "reward_1_0", 1)]
    assert listed(built["contract"], "address", "is_erc20", "is_erc721", "item_id") == [("0xC1", True, False, "contract_1_0xC1")]
    assert listed(built["token"], "symbol", "item_id", "block_hash") == [("SYM", "token_1_0xc1", "0xb1")]


def test_missing_partners_are_errors(spark):
    blocks = spark.createDataFrame([(1, "0xb1", datetime(2023, 1, 1))], "number int, hash string, timestamp timestamp")
    logs = spark.createDataFrame([(1, 0), (2, 0)], "block_number int, log_index int")
    assert joins.with_block(logs.where("block_number = 1"), blocks).first().block_hash == "0xb1"
    with pytest.raises(Exception, match="no block with number 2"):
        joins.with_block(logs, blocks).collect()
    tx = spark.createDataFrame([("0xa",), ("0xb",)], "hash string")
    fields = ["cumulative_gas_used", "gas_used", "contract_address", "root", "status", "effective_gas_price"]
    receipts = spark.createDataFrame([("0xa", *[None] * 6)], "transaction_hash string, " + ", ".join(f"{f} string" for f in fields))
    assert joins.enrich_transactions(tx.where("hash = '0xa'"), receipts).count() == 1
    with pytest.raises(Exception, match="no receipt of 0xb"):
        joins.enrich_transactions(tx, receipts).select("receipt_status").collect()
    with pytest.raises(Exception, match="no receipt of 0xb"):
        joins.enrich_transactions(tx, receipts).collect()
    lost = spark.createDataFrame([("0xt", [0, 1], "call", None)], "transaction_hash string, trace_address array<int>, trace_type string, error string")
    with pytest.raises(ValueError, match="no parent"):
        entities.build_entities(["trace"], blocks, traces=lost)


def test_tokens_without_metadata_stay(spark):
    selectors = "".join("63" + s for s in ("18160ddd", "70a08231", "a9059cbb", "23b872dd", "095ea7b3", "dd62ed3e"))
    traces = spark.createDataFrame([(0, 1, "0xt", [], "create", None, "0xa", "0xC1", None, None, "0x" + selectors + "5b")],
        "position int, block_number int, transaction_hash string, trace_address array<int>, trace_type string,"
        "reward_type string, from_address string, to_address string, value decimal(38,0), error string, output string")
    blocks = spark.createDataFrame([(1, "0xb1", datetime(2023, 1, 1))], "number int, hash string, timestamp timestamp")
    calls = spark.createDataFrame([], "address string, symbol string, name string, decimals string, total_supply string, block_number int")
    built = entities.build_entities(["token"], blocks, traces=traces, token_calls=calls)
    assert listed(built["token"], "address", "symbol", "block_hash") == [("0xc1", None, "0xb1")]


def test_kinds_come_out_once_whenever_their_parts_arrive(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))

    def block(n, *hashes):
        txs = [{"hash": h, "blockNumber": hex(n), "blockHash": f"0xb{n}", "from": "0xA", "transactionIndex": hex(i)}
               for i, h in enumerate(hashes)]
        return "block", hex(n), json.dumps({"result": {"number": hex(n), "hash": f"0xb{n}", "timestamp": hex(n), "transactions": txs}})

    def receipt(n, tx, gas):
        log = {"logIndex": "0x0", "transactionHash": tx, "blockNumber": hex(n), "address": "0xT", "data": "0x", "topics": []}
        return "receipt", hex(n), json.dumps({"result": {"transactionHash": tx, "blockNumber": hex(n), "gasUsed": hex(gas), "logs": [log]}})

    # A receipt ahead of its block, one behind it, a block without transactions, a receipt that never comes.
    batches = [[receipt(1, "0xs", 5), block(2, "0xv", "0xw")], [block(1, "0xs", "0xt"), receipt(2, "0xv", 7)],
               [receipt(1, "0xt", 6), block(3)]]
    for rows in batches:
        spark.createDataFrame(rows, PAIRS).coalesce(1).write.mode("append").parquet(src)
    stream = pair_blocks(st.stream_blocks(spark, src, spark.createDataFrame([], PAIRS).schema, max_files=1))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        st.run_incremental(stream, entity_sink(out, ["block", "transaction", "log"]), check).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    stored = lambda kind, *cols: listed(read_stored(spark, out, kind), *cols)
    assert stored("block", "item_id", F.col("transaction_count").cast("int")) == [
        ("block_0xb1", 2), ("block_0xb2", 2), ("block_0xb3", 0)]
    assert stored("transaction", "item_id", F.col("receipt_gas_used").cast("int"), "item_timestamp") == [
        ("transaction_0xs", 5, "1970-01-01T00:00:01Z"), ("transaction_0xt", 6, "1970-01-01T00:00:01Z"),
        ("transaction_0xv", 7, "1970-01-01T00:00:02Z")]
    assert stored("log", "item_id", "block_hash") == [
        ("log_0xs_0", "0xb1"), ("log_0xt_0", "0xb1"), ("log_0xv_0", "0xb2")]
    assert [(int(r.number), r.stored) for r in unsettled_blocks(spark, out).collect()] == [(2, 1)]
    # A batch that runs again replaces itself, and what never met its block is kept as it is.
    lost = spark.createDataFrame([(*receipt(9, "0xz", 1), False, True)], PAIRS + ", paired boolean, new boolean")
    for _ in range(2):
        entity_sink(out, ["block", "transaction", "log"])(lost, 7)
    assert [r.number for r in spark.read.parquet(f"{out}/unpaired").collect()] == ["0x9"]
    assert len(stored("transaction", "item_id")) == 3


class Calls:
    """State of one key, held in memory; it counts the calls that would go to the JVM."""

    def __init__(self):
        self.rows, self.timers, self.n = [], [], 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.n += 1
        return iter(list(self.rows))

    def put(self, rows):
        self.n, self.rows = self.n + 1, list(rows)

    def appendList(self, rows):
        self.n, self.rows = self.n + 1, self.rows + rows

    def clear(self):
        self.n, self.rows = self.n + 1, []

    def registerTimer(self, at):
        if at not in self.timers:
            self.n += 1
            self.timers.append(at)


def test_numbers_of_a_key_share_the_calls_to_its_state(spark):
    pairing = BlockPairing(T.StructType.fromDDL(PAIRS), "kind", "number", keep_ms=10)
    state = Calls()
    pairing.init(state)
    batch = lambda rows, at: [tuple(r) for r in pairing.handleInputRows(
        ("1",), iter([(*r, "1", None, at) for r in rows]), None)]
    numbers = [f"1{k}" for k in range(10)]
    assert batch([("receipt", n, f"r{n}") for n in numbers], 5) == [] and state.n <= 3
    got = batch([("block", n, f"B{n}") for n in numbers[:9]], 9)
    assert sorted(got) == sorted([("block", n, f"B{n}", True, True) for n in numbers[:9]]
                                 + [("receipt", n, f"r{n}", True, True) for n in numbers[:9]])
    assert state.n <= 6
    assert batch([("receipt", "13", "late"), ("block", "1x", "Bx")], 12) == [
        ("block", "13", "B13", True, False), ("receipt", "13", "late", True, True), ("block", "1x", "Bx", True, True)]
    # A number goes when its own time is over; what still waits comes out, and younger numbers stay.
    assert state.timers == [15, 22]
    gone = pairing.handleExpiredTimer(("1",), None, ExpiredTimerInfo(15))
    assert [tuple(r) for r in gone] == [("receipt", "19", "r19", False, False)]
    assert [r[:2] for r in state.rows] == [("block", "1x")]


def test_the_state_only_grows_by_what_is_new(spark):
    """Nothing that is held is written again when a block comes, and no record comes out twice for that."""
    pairing = BlockPairing(T.StructType.fromDDL(PAIRS), "kind", "number", keep_ms=10)
    state, written = Calls(), []
    append, put = state.appendList, state.put
    state.appendList = lambda rows: written.extend(rows) or append(rows)
    state.put = lambda rows: written.extend(rows) or put(rows)
    pairing.init(state)
    batch = lambda rows, at: [tuple(r)[:3] for r in pairing.handleInputRows(
        ("1",), iter([(*r, "1", None, at) for r in rows]), None)]
    assert batch([("receipt", "11", "a"), ("receipt", "12", "b")], 1) == []
    assert sorted(batch([("block", "11", "B")], 2)) == [("block", "11", "B"), ("receipt", "11", "a")]
    assert batch([("receipt", "11", "c")], 3) == [("block", "11", "B"), ("receipt", "11", "c")]
    assert batch([("receipt", "12", "d")], 4) == []
    assert sorted(batch([("block", "12", "C")], 5)) == [("block", "12", "C"), ("receipt", "12", "b"), ("receipt", "12", "d")]
    assert [r[2] for r in written] == ["a", "b", "B", "d", "C"]
    assert list(pairing.handleExpiredTimer(("1",), None, ExpiredTimerInfo(11))) == [] and state.rows == []


def test_payloads_of_a_batch_are_read_once_for_all_kinds(spark, tmp_path, monkeypatch):
    block = {"number": "0x1", "hash": "0xb", "timestamp": "0x5", "transactions": [{"hash": "0xt", "blockNumber": "0x1"}]}
    log = {"logIndex": "0x0", "transactionHash": "0xt", "blockNumber": "0x1", "address": "0xT", "data": "0x", "topics": []}
    receipt = {"transactionHash": "0xt", "blockNumber": "0x1", "logs": [log]}
    call = {"action": {"from": "0xa", "to": "0xb"}, "blockNumber": 1, "traceAddress": [], "transactionHash": "0xt", "type": "call"}
    docs = {"block": {"result": block}, "receipt": {"result": receipt}, "trace": {"result": [call]}}
    rows = [(kind, "0x1", json.dumps(doc), True, True) for kind, doc in docs.items()]
    plans, sink = {}, st.batch_sink
    monkeypatch.setattr("chainlake.streaming.entities.batch_sink", lambda path: lambda df, at: (
        plans.update({os.path.basename(path): df._jdf.queryExecution().optimizedPlan().toString()}), sink(path)(df, at)))
    calls = spark.createDataFrame([], "address string, symbol string, name string, decimals string, total_supply string, block_number int")
    batch = spark.createDataFrame(rows, PAIRS + ", paired boolean, new boolean")
    entity_sink(str(tmp_path), ["block", "transaction", "log", "token_transfer", "trace", "contract", "token"], calls)(batch, 0)
    assert [len(listed(read_stored(spark, str(tmp_path), k), "item_id")) for k in ("block", "transaction", "log", "trace")] == [1] * 4
    # Logs, traces and the heads of blocks come out of held tables.
    read = {name: plan[:plan.index("InMemoryRelation")].count("from_json") for name, plan in plans.items() if name in ("log", "trace")}
    assert read == {"log": 0, "trace": 0}


def test_late_files_are_as_many_as_asked_for(spark, monkeypatch):
    class Given:
        pass

    t = Given()
    t.spark = spark
    df = spark.range(0, 1000, 1, 9).selectExpr("id", "timestamp_seconds(id * 3600) as ts")
    files = lambda path: sorted((r.low, r.high) for r in spark.read.parquet(path).groupBy(
        F.input_file_name()).agg(F.min("id").alias("low"), F.max("id").alias("high")).collect())
    assert files(stream_q.late_first(t, df, "ts")) == [(0, 249), (250, 499), (500, 749), (750, 999)]
    monkeypatch.setattr(stream_q, "FILE_ROWS", 100)
    path = stream_q.late_first(t, df, "ts")
    assert 8 <= len(files(path)) <= 12 and spark.read.parquet(path).distinct().count() == 1000
