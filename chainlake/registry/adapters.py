"""Chain-shaped views over the given tables.

Each view is one SELECT in the dialect Spark and DuckDB share, so a query and
its check start from the same rows. `{name}` refers to a table or another view.
Orders play blocks, line items play transactions, logs and transfers, customers
and suppliers play wallets and contracts, parts play tokens.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.operators.derive import TRANSFER_TOPIC
from chainlake.session import path_exists

EPOCH = 1668729600  # 2022-11-18 00:00:00 UTC
BLOCK_TIME = 3600
FIRST = 15993000
APPROVAL_TOPIC = "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _hex(expr: str, width: int) -> str:
    return f"lpad(lower(hex(cast({expr} as bigint))), {width}, '0')"


def _address(tag: str, expr: str) -> str:
    return f"concat('0x{tag}', {_hex(expr, 38)})"


def _word(tag: str, expr: str) -> str:
    """Address as the digits of a 256-bit word."""
    return f"concat('{'0' * 24}{tag}', {_hex(expr, 38)})"


def _time(expr: str) -> str:
    return f"timestamp '2022-11-18 00:00:00' + ({expr}) * interval '1' second"


# Every column that tells line items apart, since (order, line) does not.
TX_HASH = ("concat('0x', " + ", ".join(_hex(c, 16) for c in (
    "l_orderkey * 8 + l_linenumber", "l_partkey * 100 + l_quantity",
    "l_suppkey * 10000 + round(l_tax * 100) * 100 + round(l_discount * 100)",
    "round(l_extendedprice * 100)")) + ")")
BLOCK_HASH = f"concat('0x', {_hex('l_orderkey', 64)})"
SENDER = (f"case when l_linenumber = 5 and l_quantity = 50 "
          f"then '0x0000000000000000000000000000000000000000' "
          f"when l_linestatus = 'O' and l_linenumber = 7 then {_address('cc', 'l_suppkey')} "
          f"else {_address('aa', 'o_custkey')} end")
RECEIVER = (f"case when l_linenumber = 1 and l_quantity <= 2 then null "
            f"when l_linenumber = 6 and l_quantity = 49 "
            f"then '0x000000000000000000000000000000000000dead' "
            f"when l_returnflag = 'A' and l_linenumber <= 3 then {_address('aa', 'l_partkey')} "
            f"else {_address('cc', 'l_suppkey')} end")
# Amounts: cents as an exact integer, then scaled by appending zeros.
CENTS = "cast(round(l_extendedprice * 100) as bigint)"
TOKEN = _address("ee", "l_partkey")
TOKEN_CASED = (f"case when l_tax = 0 then concat('0x', upper(substr({TOKEN}, 3))) else {TOKEN} end")
TAX = "cast(round(l_tax * 100) as bigint)"
QTY = "cast(l_quantity as bigint)"
TRANSFER_TO = _address("cc", "l_suppkey")


def _snapshot(at: int) -> str:
    top = "(select max(o_orderkey) from {orders})"
    number = [f"{FIRST} + least(7247, {top} - 30)", f"{FIRST} + floor({top} / 2)", f"{FIRST} + {top}"][at]
    x = f"case when cents <= 0 then 0 else (cents * {at + 3} + k * 7919) % 100000 end"
    return f"""
      select address, contract, k, cents, {x} as x, cast({number} as bigint) as snapshot_block_number,
        {at} as i
      from wallets"""


VIEWS = {
    "blocks": f"""
      select cast({FIRST} + o_orderkey as bigint) as number,
        concat('0x', {_hex('o_orderkey', 64)}) as hash,
        concat('0x', {_hex('greatest(o_orderkey - 1, 0)', 64)}) as parent_hash,
        concat('0x', {_hex('o_custkey', 16)}) as nonce, {_address('bb', 'o_custkey')} as miner,
        cast(o_custkey * 1000003 as bigint) as difficulty,
        cast(500 + o_custkey as bigint) as size,
        cast(30000000 as bigint) as gas_limit,
        cast(round(o_totalprice) as bigint) as gas_used,
        {_time(f'o_orderkey * {BLOCK_TIME}')} as timestamp,
        cast({EPOCH} + o_orderkey * {BLOCK_TIME} as bigint) as epoch,
        o_orderpriority as extra_data
      from {{orders}}""",
    "transactions": f"""
      select {TX_HASH} as hash, l_partkey % 1000 as nonce,
        cast(l_linenumber - 1 as bigint) as transaction_index,
        {SENDER} as from_address, {RECEIVER} as to_address,
        cast(concat(cast({CENTS} as string), '00000000000000') as decimal(38,0)) as value,
        21000 + {QTY} * 1000 as gas, ({TAX} + 1) * 1000000000 as gas_price,
        concat('0x', {_hex('l_partkey * 1048573', 16)}) as input,
        {_time(f'l_orderkey * {BLOCK_TIME}')} as block_timestamp,
        cast({FIRST} + l_orderkey as bigint) as block_number, {BLOCK_HASH} as block_hash,
        21000 + {QTY} * 700 as receipt_gas_used,
        case when l_returnflag = 'R' then 0 else 1 end as receipt_status
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "receipts": f"""
      select {TX_HASH} as transaction_hash, cast(l_linenumber - 1 as bigint) as transaction_index,
        {BLOCK_HASH} as block_hash, cast({FIRST} + l_orderkey as bigint) as block_number,
        (21000 + {QTY} * 700) * l_linenumber as cumulative_gas_used,
        21000 + {QTY} * 700 as gas_used,
        case when l_linenumber = 1 and l_quantity <= 2 then {_address('cc', 'l_suppkey')} end
          as contract_address,
        cast(null as string) as root, case when l_returnflag = 'R' then 0 else 1 end as status,
        ({TAX} + 1) * 1000000000 as effective_gas_price
      from {{lineitem}}""",
    "token_transfers": f"""
      select {TOKEN_CASED} as token_address, {_address('aa', 'o_custkey')} as from_address,
        {TRANSFER_TO} as to_address,
        concat(cast({CENTS} as string), '00000000000') as value,
        {TX_HASH} as transaction_hash, cast(l_linenumber - 1 as bigint) as log_index,
        cast({FIRST} + l_orderkey as bigint) as block_number,
        {_time(f'l_orderkey * {BLOCK_TIME}')} as block_timestamp, {BLOCK_HASH} as block_hash
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    # Lines 1-3 indexed transfers, 4 un-indexed, 5 four topics, 6 odd, 7 another event.
    "log_rows": f"""
      select cast(l_linenumber - 1 as bigint) as log_index, {TX_HASH} as transaction_hash,
        cast(l_linenumber - 1 as bigint) as transaction_index, {TOKEN_CASED} as address,
        case l_linenumber
          when 4 then concat('0x', {_word('aa', 'o_custkey')},
                             {_word('cc', 'l_suppkey')}, {_hex(f'{CENTS} * 100000000000', 64)})
          when 5 then '0x'
          else concat('0x', {_hex(f'{CENTS} * 100000000000', 64)}) end as data,
        case l_linenumber
          when 4 then '{TRANSFER_TOPIC}'
          when 5 then concat('{TRANSFER_TOPIC},0x', {_word('aa', 'o_custkey')}, ',0x',
                             {_word('cc', 'l_suppkey')}, ',0x', {_hex(CENTS, 64)})
          when 6 then concat('{TRANSFER_TOPIC},0x', {_word('aa', 'o_custkey')})
          else concat(case when l_linenumber = 7 then '{APPROVAL_TOPIC}'
                           when l_quantity = 3 then upper('{TRANSFER_TOPIC}')
                           else '{TRANSFER_TOPIC}' end,
                      ',0x', {_word('aa', 'o_custkey')}, ',0x', {_word('cc', 'l_suppkey')})
          end as topics_text,
        cast({FIRST} + l_orderkey as bigint) as block_number,
        {_time(f'l_orderkey * {BLOCK_TIME}')} as block_timestamp, {BLOCK_HASH} as block_hash,
        l_linenumber as line, o_custkey as wallet, l_suppkey as receiver, {CENTS} as cents
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "logs": """
      select log_index, transaction_hash, transaction_index, address, data,
        split(topics_text, ',') as topics, block_number, block_timestamp, block_hash
      from {log_rows}""",
    "tokens": f"""
      select case when p_type = 'ECONOMY' then concat('0x', upper(substr({_address('ee', 'p_partkey')}, 3)))
                  else {_address('ee', 'p_partkey')} end as address,
        p_brand as symbol, p_name as name, cast(15 + p_size % 4 as bigint) as decimals,
        cast(concat(cast(cast(round(p_retailprice * 100) as bigint) as string), '000000000000000000')
          as decimal(38,0)) as total_supply,
        cast({FIRST} + p_partkey as bigint) as block_number
      from {{part}} where p_size > 3""",
    "price_history": f"""
      select cast(l_linenumber as bigint) as id, cast(l_linenumber as bigint) as rank,
        min(l_extendedprice / l_quantity) as open, max(l_extendedprice / l_quantity) as close,
        {EPOCH} + (cast(floor(l_orderkey / 24) as bigint) + 1) * 86400 as timestamp
      from {{lineitem}} group by l_linenumber, cast(floor(l_orderkey / 24) as bigint)""",
    "price_ids": f"""
      select cast(1 + p_size % 7 as bigint) as id, {_address('ee', 'p_partkey')} as eth,
        {_address('dd', 'p_partkey')} as bsc from {{part}}
      union all
      select cast(1 + (p_size + 3) % 7 as bigint) as id, {_address('ee', 'p_partkey')} as eth,
        cast(null as string) as bsc from {{part}} where p_size > 25""",
    "contracts": f"""
      select {_address('cc', 's_suppkey')} as address,
        concat('0x6080604052', case
          when s_acctbal > 5000 then '6318160ddd146370a08231146323b872dd1463a9059cbb1463095ea7b31463dd62ed3e14'
          when s_acctbal > 2000 then '6370a08231146323b872dd1463095ea7b314636352211e14'
          when s_acctbal > 500 then '6370a08231146318160ddd14' else '' end,
          '5b63deadbeef', {_hex('s_suppkey', 8)}) as bytecode,
        case when s_acctbal > 5000 then '0x095ea7b3,0x18160ddd,0x23b872dd,0x70a08231,0xa9059cbb,0xdd62ed3e'
          when s_acctbal > 2000 then '0x095ea7b3,0x23b872dd,0x6352211e,0x70a08231'
          when s_acctbal > 500 then '0x18160ddd,0x70a08231' else '' end as selectors,
        s_acctbal > 5000 as is_erc20, s_acctbal > 2000 and s_acctbal <= 5000 as is_erc721,
        cast({FIRST} + s_suppkey as bigint) as block_number
      from {{supplier}}""",
    # Events as logs: a month of them, whatever the scale.
    "event_logs": f"""
      select event_id as log_index, concat('0x', {_hex('event_id', 64)}) as transaction_hash,
        user_id as transaction_index, {_address('aa', 'user_id')} as address, props as data,
        split(event_type, ',') as topics, cast({FIRST} + event_id as bigint) as block_number,
        cast(ts as timestamp) as block_timestamp, event_type as block_hash
      from {{events}}""",
    # Three nodes per transaction: the call, its child, and the child's child.
    "trace_rows": f"""
      select block_number, transaction_hash, transaction_index, from_address, to_address, value,
        '0x' as input, output, trace_type, call_type, cast(null as string) as reward_type,
        gas, gas_used, subtraces, path, error, block_timestamp, block_hash from (
      select block_number, hash as transaction_hash, transaction_index, from_address, to_address, value,
        '0x' as output, 'call' as trace_type, 'call' as call_type, gas, receipt_gas_used as gas_used,
        1 as subtraces, '' as path, case when gas >= 70000 then 'out of gas' end as error,
        block_timestamp, block_hash from {{transactions}}
      union all
      select block_number, hash, transaction_index, to_address,
        case when to_address is null or gas >= 50000 then concat('0xdc', substr(from_address, 5))
             else from_address end,
        value, concat('0x6080604052', '6370a08231146318160ddd14', '5b'),
        case when to_address is null or gas >= 50000 then 'create' else 'call' end,
        case when to_address is null or gas >= 50000 then null else 'delegatecall' end,
        gas, receipt_gas_used, 1, '0', case when receipt_status = 0 then 'reverted' end,
        block_timestamp, block_hash from {{transactions}}
      union all
      select block_number, hash, transaction_index, from_address, to_address, cast(0 as decimal(38,0)),
        '0x', 'call', 'staticcall', gas, receipt_gas_used, 0, '0,0', '', block_timestamp, block_hash
      from {{transactions}}) calls""",
    "reward_rows": f"""
      select number as block_number, miner as to_address, 'reward' as trace_type,
        'block' as reward_type, cast(2000000000000000000 as decimal(38,0)) as value,
        timestamp as block_timestamp, hash as block_hash from {{blocks}}
      union all
      select number, concat('0xab', substr(miner, 5)), 'reward', 'uncle',
        cast(1750000000000000000 as decimal(38,0)), timestamp, hash from {{blocks}}
      where extra_data = '1-URGENT'""",
    "scores": f"""
      with wallets as (
        select {_address('aa', 'c_custkey')} as address, false as contract, c_custkey as k,
          cast(round(c_acctbal * 100) as bigint) as cents from {{customer}}
        union all
        select {_address('cc', 's_suppkey')}, true, s_suppkey,
          cast(round(s_acctbal * 100) as bigint) from {{supplier}}),
      spread as ({_snapshot(0)} union all {_snapshot(1)} union all {_snapshot(2)})
      select address, contract, 1 + cast(floor((100000 - x) / 1e1) as bigint) as rank,
        x / 1.25e2 as reputation_score, x / 1e2 as reputation_score_log_scale,
        k % 97 + i as total_transfer, (k * 31) % 89 + i as total_receive,
        (k * 13) % 41 as in_degree, (k * 17) % 43 as out_degree,
        ((abs(cents) * 7) % 1000003) / 1e2 as total_volume,
        ((k * 7907) % 100003) / 1e3 as total_gas_spent, snapshot_block_number,
        {_time(f'(snapshot_block_number - {FIRST}) * {BLOCK_TIME}')} as snapshot_block_timestamp
      from spread""",
    "label_contract": f"""
      select case when s_acctbal > 7000 then concat('0x', upper(substr({_address('cc', 's_suppkey')}, 3)))
                  else {_address('cc', 's_suppkey')} end as address,
        case when s_acctbal < 0 then 'Unknown contract' else s_name end as identity,
        case when s_acctbal < 500 then null when s_acctbal < 1000 then ''
             when s_nationkey < 5 then 'DeFi' when s_nationkey < 10 then 'NFT'
             when s_nationkey < 15 then 'SocialFi' when s_nationkey < 20 then 'GameFi'
             else 'L2s' end as category,
        concat('project-', cast(s_nationkey as string)) as project_id,
        concat('Project ', cast(s_nationkey as string)) as project_name, 2 as version
      from {{supplier}}
      union all
      select {_address('cc', 's_suppkey')}, concat(s_name, ' old'), 'DeFi',
        concat('project-', cast(s_nationkey as string)),
        concat('Project ', cast(s_nationkey as string)), 1
      from {{supplier}} where s_acctbal between 5000 and 6000""",
    "label_eoa": f"""
      select {_address('aa', 'c_custkey')} as address,
        case when c_mktsegment = 'HOUSEHOLD' then 'Unknown wallet' else c_name end as identity
      from {{customer}} where c_acctbal > 2000""",
    # Serving tables: dated rows per address, the newest of them, and labels with projects.
    "reputations": """
      select address, contract as is_contract, cast(snapshot_block_timestamp as date) as date,
        rank, reputation_score, total_transfer + total_receive as total_txn, total_volume,
        total_gas_spent, in_degree + out_degree as degree, in_degree, out_degree,
        in_degree % 7 as uaw
      from {scores}""",
    "top_reputations": """
      select r.address, r.rank, r.date, r.reputation_score, r.total_txn, r.total_volume,
        r.total_gas_spent, r.is_contract, r.degree
      from {reputations} r join (select address, max(date) as date from {reputations} group by address) m
        on r.address = m.address and r.date = m.date
      where r.date = (select max(date) from {reputations})""",
    "service_labels": """
      select address, identity, category, project_id, project_name, version, true as is_contract
      from {label_contract}
      union all
      select address, identity, '', null, null, 1, false from {label_eoa}""",
    "escrows": f"""
      select concat('project-', cast(s_nationkey as string)) as project_id,
        concat('Project ', cast(s_nationkey as string)) as project_name,
        {_address('cc', 's_suppkey')} as address,
        case when s_acctbal < 2000 then 'NATIVE_TOKEN'
             when s_acctbal > 8000 then concat('0x', upper(substr({_address('ee', 's_suppkey')}, 3)))
             else {_address('ee', 's_suppkey')} end as token_address
      from {{supplier}}""",
    "balances": f"""
      select address, token_address, concat(cast(k as string), '000000000000') as balance from (
        select address, token_address, 1000 + row_key as k from (
          select {_address('cc', 's_suppkey')} as address,
            case when s_acctbal < 2000 then 'NATIVE_TOKEN'
                 when s_acctbal > 8000 then concat('0x', upper(substr({_address('ee', 's_suppkey')}, 3)))
                 else {_address('ee', 's_suppkey')} end as token_address,
            s_suppkey * 37 as row_key, s_acctbal
          from {{supplier}}) named
        where s_acctbal < 9000) held""",
}

# A transaction's calls, number 0 to 2, from its columns: as rows and as elements of a list.
CALLS = {
    "block_number": "t.block_number", "transaction_hash": "t.hash", "transaction_index": "t.transaction_index",
    "from_address": "case when call = 1 then t.to_address else t.from_address end",
    "to_address": """case when call <> 1 then t.to_address
      when t.to_address is null or t.gas >= 50000 then concat('0xdc', substr(t.from_address, 5)) else t.from_address end""",
    "value": "case when call < 2 then t.value else cast(0 as decimal(38,0)) end", "input": "'0x'",
    "output": "case when call = 1 then concat('0x6080604052', '6370a08231146318160ddd14', '5b') else '0x' end",
    "trace_type": "case when call = 1 and (t.to_address is null or t.gas >= 50000) then 'create' else 'call' end",
    "call_type": """case when call = 0 then 'call' when call = 2 then 'staticcall'
      when t.to_address is null or t.gas >= 50000 then null else 'delegatecall' end""",
    "reward_type": "cast(null as string)", "gas": "t.gas", "gas_used": "t.receipt_gas_used",
    "subtraces": "case when call = 2 then 0 else 1 end", "path": "case call when 0 then '' when 1 then '0' else '0,0' end",
    "error": """case when call = 2 then '' when call = 1 then case when t.receipt_status = 0 then 'reverted' end
      when t.gas >= 70000 then 'out of gas' end""",
    "block_timestamp": "t.block_timestamp", "block_hash": "t.block_hash",
}

# The same rows where Spark reads them: each transaction is read once and repeated for its three calls. Only the call's
# number comes out of the generator, so columns that nobody asks for are gone before the join of `transactions`.
ONE_PASS = {
    "trace_rows": "select " + ", ".join(f"{text} as {name}" for name, text in CALLS.items())
                  + " from {transactions} t lateral view explode(array(0, 1, 2)) c as call",
}


def calls_of(txs: str, names: list[str]) -> str:
    """Rows of `trace_rows`, of these columns, as a list made from a list of transactions."""
    call = "named_struct(" + ", ".join(f"'{name}', {CALLS[name]}" for name in names) + ")"
    return f"flatten(transform({txs}, t -> transform(array(0, 1, 2), call -> {call})))"


# Folder of the given tables to a folder holding some views as stored tables.
LANDED: dict[str, str] = {}

_NAME = re.compile(r"\{(\w+)\}")
_SELECT = re.compile(r"\s*select (.*)\s+from (\{lineitem\}.*)", re.S)
_READ: dict = {}


class Tables:
    """The given tables of one scale, and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder, self._made = spark, folder.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            stored = LANDED.get(self._folder)
            if stored and name in VIEWS and path_exists(self.spark, f"{stored}/{name}"):
                self._made[name] = self._read(f"{stored}/{name}")
            elif name in VIEWS:
                text = ONE_PASS.get(name, VIEWS[name])
                parts = {n: getattr(self, n) for n in set(_NAME.findall(text))}
                self._made[name] = self.spark.sql(text, **parts)
            elif name in BASE:
                self._made[name] = self._read(f"{self._folder}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._made[name]

    def unmade(self, name: str, key: str) -> DataFrame:
        """Rows that a view of tables alone is made from: the view's column `key` as `_key`, the tables' columns as `name__column`.

        A table's numbers are a fraction of the texts a view makes of them, so these rows move and `make` follows.
        """
        made, source = _SELECT.fullmatch(VIEWS[name]).groups()
        tables = {n: getattr(self, n) for n in _NAME.findall(source)}
        used = set(re.findall(r"\w+", made))
        own = [c for table in tables.values() for c in table.columns if c in used]
        rows = self.spark.sql(f"select {', '.join(own)}, {made} from {source}", **tables)
        return rows.select(F.col(key).alias("_key"), *[F.col(c).alias(f"{name}__{c}") for c in own])

    def make(self, name: str, df: DataFrame) -> DataFrame:
        """`df` with the columns of a view, as `name__column`, in place of the columns of `unmade`."""
        made, _ = _SELECT.fullmatch(VIEWS[name]).groups()
        own, rest = f"{name}__", [c for c in df.columns if not c.startswith(f"{name}__")]
        raw = df.select(*rest, *[F.col(c).alias(c.removeprefix(own)) for c in df.columns if c.startswith(own)])
        rows = self.spark.sql(f"select *, {made} from {{raw}}", raw=raw)
        return rows.select(*rest, *[F.col(c).alias(f"{own}{c}") for c in rows.columns if c not in raw.columns])

    def _read(self, path: str) -> DataFrame:
        # Schemas are read once per session, not once per query.
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _READ:
            _READ[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_READ[key]).parquet(path)


def land(spark: SparkSession, folder: str, target: str, names: list[str], files: int = 8) -> None:
    """Store views as tables of several files, as a chain's tables would be."""
    LANDED[folder.rstrip("/")] = target
    for name in names:  # a later view reads those stored before it
        getattr(Tables(spark, folder), name).repartition(files).write.parquet(f"{target}/{name}")


def needed(text: str) -> list[str]:
    """Views a SQL text refers to, dependencies first."""
    found: list[str] = []

    def visit(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in VIEWS and name not in found:
                visit(VIEWS[name])
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def plain(text: str) -> str:
    return _NAME.sub(r"\1", text)


def oracle(text: str) -> str:
    """SQL text with the views it uses as leading CTEs."""
    ctes = [f"{name} AS ({plain(VIEWS[name])})" for name in needed(text)]
    body = plain(text).strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
