import json

from pyspark.sql import functions as F

from chainlake.operators import derive
from chainlake.sources import imports, payloads
from conftest import listed


def lines(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")


BLOCK = {"number": "0x10", "hash": "0xb1", "parentHash": "0xb0", "nonce": "0x1", "miner": "0xABCD",
         "difficulty": "0x5", "totalDifficulty": "0x64", "size": "0x200", "extraData": "0x",
         "gasLimit": "0x1388", "gasUsed": "0x0", "timestamp": "0x5", "transactions": []}


def test_blocks_with_and_without_transactions(spark):
    tx = {"hash": "0xt1", "nonce": "0x2", "blockHash": "0xb1", "blockNumber": "0x10", "transactionIndex": "0x0",
          "from": "0xAA", "to": None, "value": "0xde0b6b3a7640000", "gas": "0x5208", "gasPrice": "0x3b9aca00",
          "input": "0x"}
    full = {**BLOCK, "transactions": [tx, "0xonlyhash"]}
    genesis = {**BLOCK, "number": "0x0", "totalDifficulty": None}
    raw = lines(spark, {"result": full}, {"result": genesis})
    got = listed(payloads.parse_blocks(raw), "number", "miner", "total_difficulty", "transaction_count")
    assert [(n, m, int(d), c) for n, m, d, c in got] == [(0, "0xabcd", 0, 0), (16, "0xabcd", 100, 2)]
    found = payloads.parse_block_transactions(raw).collect()
    assert len(found) == 1
    row = found[0]
    assert (row.hash, row.from_address, row.to_address, int(row.value), int(row.gas)) == (
        "0xt1", "0xaa", None, 10**18, 21000)
    assert row.block_timestamp.timestamp() == 5


def test_receipts_and_logs(spark):
    log = {"logIndex": "0x1", "transactionHash": "0xt", "transactionIndex": "0x0", "blockHash": "0xb",
           "blockNumber": "0x2", "address": "0xABc", "data": "0x", "topics": ["0x1", "0x2"]}
    receipt = {"transactionHash": "0xt", "transactionIndex": "0x0", "blockHash": "0xb", "blockNumber": "0x2",
               "cumulativeGasUsed": "0x10", "gasUsed": "0x8", "contractAddress": "0xABC", "status": "0x1",
               "effectiveGasPrice": "0x7", "logs": [log]}
    raw = lines(spark, {"result": receipt})
    assert listed(payloads.parse_receipts(raw), "contract_address", "status", "root") == [("0xabc", 1, None)]
    # Log addresses keep their case.
    assert listed(payloads.parse_receipt_logs(raw), "address", "log_index", "topics") == [("0xABc", 1, ["0x1", "0x2"])]
    assert listed(payloads.parse_logs(lines(spark, {"result": [log]})), "block_number", "topics") == [(2, ["0x1", "0x2"])]


def test_traces_by_type(spark):
    common = {"blockNumber": 7, "subtraces": 0, "traceAddress": [], "transactionHash": "0xt", "transactionPosition": 0}
    raw = lines(spark, {"result": [
        {**common, "type": "call", "action": {"from": "0xA", "to": "0xB", "value": "0x1", "gas": "0x2",
                                              "callType": "call", "input": "0x11"},
         "result": {"gasUsed": "0x1", "output": "0x22"}, "subtraces": 2},
        {**common, "type": "create", "action": {"from": "0xA", "value": "0x0", "gas": "0x9", "init": "0x33"},
         "result": {"address": "0xCcC", "code": "0x44", "gasUsed": "0x3"}, "traceAddress": [0]},
        {**common, "type": "suicide", "action": {"address": "0xD", "refundAddress": "0xE", "balance": "0xff"},
         "traceAddress": [1]},
        {"blockNumber": 7, "type": "reward", "action": {"author": "0xF", "value": "0x4", "rewardType": "block"},
         "subtraces": 0, "traceAddress": []},
        {**common, "type": "call", "action": {"from": "0xA", "to": "0xB", "gas": "0x1"}, "error": "Reverted",
         "traceAddress": [2]},
    ]}, {"result": []})
    got = payloads.parse_traces(raw).orderBy("position").collect()
    assert [r.trace_type for r in got] == ["call", "create", "suicide", "reward", "call"]
    assert [(r.from_address, r.to_address) for r in got] == [
        ("0xa", "0xb"), ("0xa", "0xCcC"), ("0xd", "0xe"), (None, "0xf"), ("0xa", "0xb")]
    assert [int(r.value) for r in got] == [1, 0, 255, 4, 0]
    assert [int(r.gas_used) for r in got] == [1, 3, 0, 0, 0]
    assert [(r.input, r.output) for r in got[:2]] == [("0x11", "0x22"), ("0x33", "0x44")]
    assert [r.reward_type for r in got] == [None, None, None, "block", None]
    assert got[4].error == "Reverted" and got[3].transaction_hash is None


def _walk(node, path, out):
    calls = node.get("calls", [])
    out.append((path, len(calls), node["from"].lower()))
    for i, child in enumerate(calls):
        _walk(child, path + [i], out)


def test_call_trees_of_any_shape(spark):
    deep = {"type": "CALL", "from": "0xA0", "to": "0xB", "gas": "0x1", "gasUsed": "0x1", "value": "0x1"}
    node = deep
    for i in range(1, 9):
        child = {"type": ["DELEGATECALL", "CREATE", "SELFDESTRUCT", "STATICCALL"][i % 4], "from": f"0xA{i}", "to": "0xB"}
        node["calls"] = [child] if i % 3 else [child, {"type": "CALL", "from": "0xF", "to": "0xB", "error": "bad"}]
        node = child
    flat = {"type": "CALL", "from": "0xC", "to": "0xD", "error": "out of gas"}
    raw = lines(spark, {"block_number": 5, "transaction_traces": [deep, flat]})
    got = payloads.flatten_call_tree(raw)
    want = []
    _walk(deep, [], want)
    rows = listed(got.where("transaction_index = 0"), "trace_address", "subtraces", "from_address")
    assert rows == sorted(want, key=repr)
    kinds = {(r.trace_type, r.call_type) for r in got.collect()}
    assert kinds == {("call", "call"), ("call", "delegatecall"), ("call", "staticcall"), ("create", None), ("suicide", None)}
    assert listed(got.where("transaction_index = 1"), "error", "subtraces") == [("out of gas", 0)]


def test_too_deep_a_tree_is_an_error(spark):
    import pytest

    node = tree = {"type": "CALL", "from": "0x1"}
    for _ in range(3):
        node["calls"] = [{"type": "CALL", "from": "0x1"}]
        node = node["calls"][0]
    raw = lines(spark, {"block_number": 1, "transaction_traces": [tree]})
    with pytest.raises(Exception, match="deeper than 2"):
        payloads.flatten_call_tree(raw, max_depth=2).collect()
    assert payloads.flatten_call_tree(raw, max_depth=3).count() == 4


def test_log_rows_with_blank_topics(spark):
    rows = spark.createDataFrame([("a,b",), (" ",), ("",), (None,)], "topics string")
    assert [r[0] for r in payloads.logs_from_rows(rows).collect()] == [["a", "b"], [], [], None]


def test_token_transfer_of_a_256_bit_value(spark):
    word = lambda v: "0x" + format(v, "064x")
    big = 2**256 - 1000
    logs = spark.createDataFrame([
        ("0xTOKEN", word(big), [derive.TRANSFER_TOPIC, word(1), word(2)], "0xt", 0, 1),
        ("0xTOKEN", "0x", [derive.TRANSFER_TOPIC.upper(), word(1), word(2), word(3)], "0xt", 1, 1),
        ("0xTOKEN", "0x", [derive.TRANSFER_TOPIC], "0xt", 2, 1),
        ("0xTOKEN", "0x", [], "0xt", 3, 1),
    ], "address string, data string, topics array<string>, transaction_hash string, log_index int, block_number int")
    got = listed(derive.transfers_from_logs(logs), "log_index", "token_address", "to_address", "value", "value_dec")
    assert got[0] == (0, "0xtoken", "0x" + "0" * 39 + "2", str(big), None)
    assert got[1][3] == "3" and len(got) == 2
    assert listed(derive.odd_transfers(logs), "log_index") == [(2,)]


# --- imports -----------------------------------------------------------------


def test_reputation_file(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    heads = list(imports.REPUTATION_HEADERS)
    row = dict.fromkeys(heads, "")
    one = {**row, "Address": "0xAB", "Rank": "3", "Contract": "Yes", "Reputation": "1.5", "Date": "2023-01-02",
           "Block": "9", "Total Volume": "2.5", "UAW": "4", "Total Txn": "7"}
    two = {**row, "Address": "0xCD", "Contract": "No"}
    with open(path, "w") as f:
        f.write(",".join(heads) + "\n")
        for r in (one, two):
            f.write(",".join(r[h] for h in heads) + "\n")
    got = {r.address: r for r in imports.read_reputation_csv(spark, path, "eth").collect()}
    assert got["0xab"].is_contract is True and got["0xab"].rank == 3 and str(got["0xab"].date) == "2023-01-02"
    other = got["0xcd"]
    assert other.is_contract is False and other.reputation_score == 0 and other.total_txn == 0
    assert (other.block, other.date, other.total_volume, other.uaw) == (None, None, None, None)
    assert {r.address for r in imports.read_reputation_csv(spark, path, "trx").collect()} == {"0xAB", "0xCD"}


def record(i, **fields):
    return {"recordId": f"r{i}", "createdAt": "2023-01-02T03:04:05.000Z", "updatedAt": 1672628645000, "fields": fields}


def test_label_records(spark):
    raw = lines(
        spark,
        record(1, address="0x1", identity="a", category="DeFi", project=["p1"], project_name=["One", "Two"], note="n"),
        record(2, address="0x2", identity="b", project_name=["Unknown"]),
        record(3, address="0x3", identity="c", project_name=["Unnamed"]),
        record(4, address="0x4", identity="d"),
        record(5, address="0x5", identity="e", project_name=["Five"]),
    )
    records = imports.label_records(raw)
    got = imports.contract_labels(records)
    assert listed(got, "id", "project_id", "project_name", "note", "safety") == [
        ("r1", "p1", "One", "n", ""), ("r5", None, "Five", "", "")]
    assert listed(got, "created_at", "updated_at")[0] == ("2023-01-02 03:04:05", "2023-01-02 03:04:05")
    people = imports.eoa_labels(records)
    assert people.count() == 5 and listed(people, "category", "is_contract", "project_id")[0] == ("", False, None)
    assert listed(imports.flat_labels(records, "eoa"))[0] == ("0x1", "a")
    assert listed(imports.flat_labels(records, "contract"))[3] == ("0x4", "d", "", "", "", "")


def test_price_payloads(spark):
    quote = {"open": 1.5, "close": 2.5, "timestamp": "2023-01-02T23:59:59.999Z"}
    raw = lines(spark, {"id": 1027, "rank": 2, "data": {"quotes": [{"quote": quote}]}})
    assert listed(imports.price_quotes(raw)) == [(1027, 2, 1.5, 2.5, 1672703999)]
    ranked = lines(spark, {"data": [{"id": 1, "rank": 1, "name": "B", "symbol": "b", "slug": "bb", "is_active": 1}]})
    assert listed(imports.ranked_tokens(ranked)) == [(1, 1, "B", "b", "bb", 1)]


# --- marketplace -------------------------------------------------------------


def test_listings_and_shop_products(spark):
    word = lambda v: "0x" + format(v, "064x")
    markets = [("0xM0", "000", 10), ("0xM1", "001", 20)]
    logs = spark.createDataFrame([
        (12, 0, "0xm0", word(77), [derive.LISTING_CREATED, word(1), word(5)]),
        (25, 1, "0xM1", word(78), [derive.LISTING_UPDATED, word(1), word(6)]),
        (25, 2, "0xM0", word(78), [derive.LISTING_UPDATED, word(1), word(6)]),   # old contract, new era
        (5, 3, "0xM0", word(78), [derive.LISTING_CREATED, word(1), word(6)]),    # before the first era
        (12, 4, "0xM0", word(78), [derive.LISTING_CREATED, word(1)]),            # too few topics
        (12, 5, "0xM0", word(78), ["0xother", word(1), word(6)]),
    ], "block_number int, log_index int, address string, data string, topics array<string>")
    events = derive.listing_events(logs, markets)
    got = listed(events, "log_index", "listing_id", "ipfs_hash")
    assert [(a, b) for a, b, _ in got] == [(0, "1-000-5"), (1, "1-001-6")]
    ipfs = {a: h for a, _, h in got}
    listing = {"listingType": "unit", "category": "c", "title": "T", "price": {"amount": "3", "currency": "X"},
               "shopIpfsHash": "QmShop"}
    product = {"id": "p1", "externalId": "9", "title": "Shirt", "description": "D", "price": 10, "image": "i",
               "variants": [{"id": "v1", "title": "Red", "price": 11, "option1": "red"}]}
    docs = spark.createDataFrame([
        (ipfs[0], json.dumps(listing)), (ipfs[1], json.dumps({"title": "bare"})),
        ("QmShop/index.html", '<html><link rel="data-dir" href="data"></html>'),
        ("QmShop/data/products.json", json.dumps([{"id": "p1"}, {"id": ""}, {"title": "no id"}, {"id": "gone"}])),
        ("QmShop/data/p1/data.json", json.dumps(product)),
    ], "path string, body string")
    rows = derive.listings(events, docs)
    assert listed(rows, "log_index", "title", "price", "currency", "language") == [
        (0, "T", "3", "X", ""), (1, "bare", "", "", "")]
    items = derive.shop_products(rows.where("shop_hash is not null"), docs)
    assert listed(items, "product_id", "external_id", "parent_external_id", "title", "price", "option1", "currency") == [
        ("1-000-5-p1", "9", None, "Shirt", 10, None, "fiat-USD"),
        ("1-000-5-v1", None, "9", "Red", 11, "red", "fiat-USD")]
    assert {r.ipfs_path for r in items.collect()} == {"QmShop/data/p1"}


def test_shop_dir_is_null_without_the_link(spark):
    pages = spark.createDataFrame([('<link rel="data-dir" href="x/y">',), ("<p>",)], "html string")
    assert [r.data_dir for r in derive.shop_data_dir(pages).collect()] == ["x/y", None]


def test_token_metadata_prefers_the_first_usable_result(spark):
    calls = spark.createDataFrame([
        ("0xA", None, "UP", b"low\x00\x00", "n\u0000ame", "300", "5", "7", 1),
        ("0xB", None, None, b"alt\x00", None, None, "bad", "7", 1),
        ("0xC", None, None, b"\xff\xff", None, None, None, None, 1),
    ], "address string, symbol string, SYMBOL_upper string, symbol_bytes32 binary, name string, decimals string,"
       "DECIMALS_upper string, total_supply string, block_number int")
    got = {r.address: r for r in derive.resolve_token_metadata(calls).collect()}
    assert (got["0xa"].symbol, got["0xa"].name, int(got["0xa"].decimals)) == ("UP", "name", 300)
    assert (got["0xb"].symbol, got["0xb"].decimals) == ("alt", None)
    assert got["0xc"].symbol is None


def test_a_thousand_levels_in_one_pass(spark):
    node = {"type": "CALL", "from": "0xA1000", "to": "0xB", "input": 'with "quotes" } and {'}
    for n in range(999, -1, -1):
        node = {"type": "CALL", "from": f"0xA{n}", "to": "0xB", "calls": [{"type": "CREATE", "from": "0xF"}, node]}
    raw = lines(spark, {"block_number": 1, "transaction_traces": [node, "no call", None, {"type": "CALL", "calls": None}]})
    found = payloads.flatten_call_tree(raw)
    group, tracker = "one pass", spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    rows = found.collect()
    assert len(tracker.getJobIdsForGroup(group)) <= 2
    tree = {tuple(r.trace_address): r for r in rows if r.transaction_index == 0}
    assert len(tree) == 2001 and len(rows) == 2004
    assert all(tree[(1,) * n].from_address == f"0xa{n}" and tree[(1,) * n].subtraces == 2 for n in range(1000))
    assert tree[(1,) * 1000].input == 'with "quotes" } and {'


def test_call_trees_nest_behind_the_shuffle(spark):
    from chainlake.registry.adapters import Tables
    from chainlake.registry.rows_q import call_trees

    plan = call_trees(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    # The nesting stands in the line of the aggregate, not below it, where rows are made that move.
    at = next(i for i, line in enumerate(plan.splitlines()) if "Aggregate [" in line)
    assert "STATICCALL" in plan and all("STATICCALL" not in line for line in plan.splitlines()[at + 1:])


def test_receipts_are_made_behind_the_join_of_lines(spark, tmp_path):
    """Some lines are the same, one has no part and so no hash, one no order; both tables have a column that nobody asks for."""
    from chainlake.registry.adapters import Tables
    from chainlake.registry.rows_q import raw_receipts

    lines = [(o, 3, 4, n, float(n), 9.5, 0.0, 0.01, "R", "O", 0) for o in (1, 2) for n in range(1, 8)]
    lines += [lines[0], (1, None, 4, 4, 1.0, 9.5, 0.0, 0.01, "N", "O", 0), (3, 3, 4, 1, 1.0, 9.5, 0.0, 0.01, "A", "F", 0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, i int"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, 0), (2, 8, 0)], "o_orderkey long, o_custkey long, i int").write.parquet(f"{tmp_path}/orders.parquet")
    t = Tables(spark, str(tmp_path))
    docs = raw_receipts(t)
    moved = docs._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert not any(name in moved for name in ("AS logs", "AS data", "topics", "block_hash"))
    met = t.receipts.alias("r").join(t.logs.alias("l"), "transaction_hash")
    cols = ["log_index", "block_number", "address", "data", "topics", "block_hash"]
    want = listed(met, "transaction_hash", *[f"l.{c}" for c in cols])
    assert len(want) == 13 + 2 * 2 and listed(payloads.parse_receipt_logs(docs), "transaction_hash", *cols) == want
    cols = ["transaction_index", "block_hash", "block_number", "contract_address", "status"]
    amounts = [F.col(c).cast("long") for c in ("cumulative_gas_used", "gas_used", "effective_gas_price")]
    assert listed(payloads.parse_receipts(docs), "transaction_hash", *cols, *amounts) == listed(
        met, "transaction_hash", *[f"r.{c}" for c in cols], *amounts)


def test_content_ids_of_listings_are_computed_once(spark):
    from chainlake.functions import hexes

    sides = spark.createDataFrame([("0x" + f"{n:064x}", n) for n in (5, 6, 6)] + [("0xz", 7), (None, 8)], "data string, n int")
    events = sides.select(F.col("n").alias("block_number"), F.lit(0).alias("log_index"), F.lit("1").alias("listing_id"),
                          hexes.base58("data").alias("ipfs_hash"))
    docs = sides.where("n <> 5").distinct().select(hexes.base58("data").alias("path"), F.lit('{"title": "a"}').alias("body"))
    found = derive.listings(events, docs)
    assert listed(found, "block_number", "title") == [(6, "a"), (6, "a")]
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
