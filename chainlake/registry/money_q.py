"""Pricing, volumes, statistics, numbering and derived entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.functions import bytecode, scalars
from chainlake.operators import derive, joins, latest, quality, ranking, rows
from chainlake.plans import activity, pricing
from chainlake.registry.adapters import EPOCH, FIRST
from chainlake.registry.base import query, rounded
from chainlake.registry.rows_q import IDS, INTERVAL
from chainlake.sinks import writers

# --- priced transactions -----------------------------------------------------

PRE_TX_SQL = f"""
    select t.block_number, t.from_address, t.to_address, t.gas, t.receipt_gas_used as gas_used,
      t.gas_price, cast(t.value as string) as value, null as token_transfer, null as token_contract,
      cast(cast(t.value as string) as double) / 1e18 * p.open as volume,
      cast(t.receipt_gas_used * t.gas_price as double) / 1e18 as gas_spent,
      cast(t.receipt_gas_used * t.gas_price as double) / 1e18 * p.open as gas_spent_usd
    from {{transactions}} t
    left join (select * from {{price_history}} where id = 1) p on {INTERVAL.format(p='p')}
    union all
    select m.block_number, m.from_address, m.to_address, t.gas, t.receipt_gas_used, t.gas_price, null,
      m.value, m.token_address,
      cast(m.value as double) / pow(10.0, k.decimals) * p.open,
      cast(t.receipt_gas_used * t.gas_price as double) / 1e18,
      cast(t.receipt_gas_used * t.gas_price as double) / 1e18 * n.open
    from {{token_transfers}} m left join {{transactions}} t on m.transaction_hash = t.hash
    left join {{tokens}} k on lower(m.token_address) = lower(k.address)
    left join {IDS} i on m.token_address = i.eth
    left join {{price_history}} p on i.id = p.id and {INTERVAL.format(p='p').replace('(block_number', '(t.block_number')}
    left join (select * from {{price_history}} where id = 1) n
      on {INTERVAL.format(p='n').replace('(block_number', '(t.block_number')}"""


def priced(t):
    return pricing.pre_tx(t.transactions, t.token_transfers, t.tokens, t.price_ids, t.price_history, "eth", 1)


def shown(df):
    return df.withColumn("value", F.col("value").cast("string"))


@query("v01_pre_tx", PRE_TX_SQL)
def _(t):
    return shown(priced(t))


@query("v02_pre_tx_split", PRE_TX_SQL)
def _(t):
    return shown(pricing.pre_tx_split(t.transactions, t.receipts, t.token_transfers, t.tokens, t.price_ids,
                                      t.price_history, "eth", 1))


@query("v01_pre_tx_text", f"""
    with v as ({PRE_TX_SQL})
    select token_contract, count(*) as n, count(volume) as priced, round(sum(volume), 0) as volume
    from v group by 1""")
def _(t):
    text = pricing.pre_tx_text(priced(t))
    summed = text.groupBy("token_contract").agg(
        F.count(F.lit(1)).alias("n"), F.count("volume").alias("priced"),
        F.sum(F.col("volume").cast("double")).alias("volume"))
    return rounded(summed, 0, "volume")


@query("v03_pre_tx_daily", f"""
    with days as (select id, (open + close) / 2 as price, cast(make_timestamp(timestamp * 1000000) as date) as day
      from {{price_history}}),
    moved as (
      select transaction_hash, block_number, address, cast(cents * 100000000000 as double) as amount,
        concat('0x', right(split(topics_text, ',')[2], 40)) as from_address,
        concat('0x', right(split(topics_text, ',')[3], 40)) as to_address,
        cast(block_timestamp as date) as day
      from {{log_rows}} where len(split(topics_text, ',')) = 3
        and split(topics_text, ',')[1] = '0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef'
        and cast(block_timestamp as date) between date '2022-12-01' and date '2023-12-31')
    select hash as tx_hash, block_number, from_address, to_address, gas, receipt_gas_used as gas_used, gas_price,
      cast(value as string) as value, null as token_transfer, null as token_address,
      cast(cast(value as string) as double) / 1e18 * price as volume,
      cast(receipt_gas_used * gas_price as double) / 1e18 as gas_spent,
      cast(receipt_gas_used * gas_price as double) / 1e18 * price as gas_spent_usd
    from {{transactions}} left join days on id = 1 and day = cast(block_timestamp as date)
    where cast(block_timestamp as date) between date '2022-12-01' and date '2023-12-31'
    union all
    select transaction_hash, m.block_number, from_address, to_address, null, null, null, null, amount, m.address,
      amount / pow(10.0, k.decimals) * price, null, null
    from moved m left join {{tokens}} k on lower(m.address) = lower(k.address)
    left join {IDS} i on m.address = i.eth
    left join days d on d.id = i.id and d.day = m.day""")
def _(t):
    return shown(pricing.pre_tx_daily(t.transactions, t.logs, t.tokens, t.price_ids, t.price_history, "eth", 1,
                                      "2022-12-01", "2023-12-31"))


VOLUME_SQL = f"""
    with v as ({PRE_TX_SQL})
    select from_address as address, round(sum(volume), 2) as volume from v group by 1
    union all select to_address, round(sum(volume), 2) from v group by 1
    union all select token_contract, round(sum(volume), 2) from v group by 1"""


@query("v04_tx_volume", VOLUME_SQL)
def _(t):
    return rounded(activity.address_volume(priced(t)), 2, "volume")


@query("a01_address_volume", """
    with v as (select from_address, to_address, cast(cast(value as string) as double) / 1e18 as volume from {transactions})
    select from_address as address, round(sum(volume), 6) as volume from v group by 1
    union all select to_address, round(sum(volume), 6) from v group by 1
    union all select null, round(sum(volume), 6) from v""")
def _(t):
    legs = t.transactions.select("from_address", "to_address", F.lit(None).cast("string").alias("token_contract"),
                                 scalars.to_units(F.col("value")).alias("volume"))
    return rounded(activity.address_volume(legs), 6, "volume")


NO_BURN = "('0x0000000000000000000000000000000000000000', '0x000000000000000000000000000000000000dead')"
UAW_SQL = f"""
    with p as (select from_address, to_address from {{transactions}}
               union all select from_address, to_address from {{token_transfers}}),
    pairs as (select distinct from_address, to_address from p
      where from_address not in {NO_BURN} and to_address not in {NO_BURN})
    select to_address as address, count(*) as uaw from pairs
    where not exists (select 1 from {{contracts}} where address = from_address) group by 1"""


@query("v05_uaw", UAW_SQL)
def _(t):
    return activity.unique_active_wallets(activity.movements(t.transactions, t.token_transfers), t.contracts)


@query("a02_unique_active_wallets", UAW_SQL.replace(
    "union all select from_address, to_address from {token_transfers}", ""))
def _(t):
    return activity.unique_active_wallets(t.transactions, t.contracts)


# --- aggregates --------------------------------------------------------------


@query("a06_distinct_count", """
    select category, count(distinct project_id) as projects from {label_contract} group by 1""")
def _(t):
    return t.label_contract.groupBy("category").agg(F.count_distinct("project_id").alias("projects"))


@query("a13_gas_and_counts", """
    select from_address as address, cast(sum(gas * gas_price) as string) as total_gas, count(*) as total_transfer,
      null as total_receive from {transactions} group by 1
    union all select to_address, null, null, count(*) from {transactions} group by 1""")
def _(t):
    from chainlake.plans.graph import gas_and_counts

    fee = F.col("gas").cast("decimal(38,0)") * F.col("gas_price").cast("decimal(38,0)")
    sent, received = gas_and_counts(t.transactions.withColumn("gas_used", fee))
    sent = sent.withColumn("total_gas", F.col("total_gas").cast("string"))
    return rows.union_aligned(sent, received)


@query("a15_block_bounds", "select min(block_number) as block_min, max(block_number) as block_max from {transactions}")
def _(t):
    return activity.block_bounds(t.transactions)


@query("a16_max_block_on", """
    select max(number) as number from {blocks} where cast(timestamp as date) = date '2022-12-31'""")
def _(t):
    return activity.max_block_on(t.blocks, "2022-12-31")


@query("a17_block_range", f"""
    select (select min(number) from {{blocks}} where epoch >= {EPOCH} + 3 * 86400) as start_block,
      (select max(number) from {{blocks}} where epoch <= {EPOCH} + 9 * 86400 - 1) as end_block""")
def _(t):
    return activity.block_range(t.blocks, EPOCH + 3 * 86400, EPOCH + 9 * 86400 - 1)


@query("a17_block_range_before_first", f"""
    select cast(0 as bigint) as start_block,
      (select max(number) from {{blocks}} where epoch <= {EPOCH} + 86399) as end_block""")
def _(t):
    return activity.block_range(t.blocks, EPOCH - 86400, EPOCH + 86399)


STATS_SQL = """
    with s as (
      select from_address as address, 1 as sent, receipt_gas_used * gas_price as fee, block_number from {transactions}
      union all select to_address, 0, 0, block_number from {transactions})
    select address, cast(sum(sent) as bigint) as total_transfer, cast(sum(1 - sent) as bigint) as total_receive,
      cast(sum(fee) as string) as total_gas, min(block_number) as first_block, max(block_number) as last_block
    from s where address is not null group by 1"""


@query("a21_cumulative_stats", STATS_SQL)
def _(t):
    tx = t.transactions
    middle = tx.agg((F.min("block_number") + F.max("block_number")) / 2).scalar()
    state = activity.address_stats(tx.where(F.col("block_number") <= middle))
    merged = activity.cumulative_stats(state, tx.where(F.col("block_number") > middle))
    return merged.withColumn("total_gas", F.col("total_gas").cast("string"))


# --- numbering ---------------------------------------------------------------


@query("w01_last_transaction", """
    select hash, from_address, to_address, block_number from (
      select *, row_number() over (partition by from_address, to_address
        order by block_number desc, transaction_index desc, hash desc) as rn from {transactions}) where rn = 1""")
def _(t):
    return ranking.last_transaction(t.transactions).select("hash", "from_address", "to_address", "block_number")


@query("w02_one_per_key", """
    select address, identity from (select *, row_number() over (partition by address order by identity) as rn
      from {label_contract}) where rn = 1""")
def _(t):
    return latest.one_per_key(t.label_contract.select("address", "identity"), ["address"], [F.col("identity").asc()])


@query("w04_add_rank", """
    select address, reputation_score,
      row_number() over (order by total_volume desc, address, snapshot_block_number) as rank from {scores}""")
def _(t):
    slim = t.scores.select("address", "reputation_score", "total_volume", "snapshot_block_number")
    order = [F.col("total_volume").desc(), F.col("address").asc(), F.col("snapshot_block_number").asc()]
    return ranking.add_rank(slim, order).select("address", "reputation_score", "rank")


@query("w04_add_rank_within", """
    select address, snapshot_block_number,
      row_number() over (partition by snapshot_block_number order by total_volume desc, address) as rank
    from {scores}""")
def _(t):
    slim = t.scores.select("address", "total_volume", "snapshot_block_number")
    order = [F.col("total_volume").desc(), F.col("address").asc()]
    return ranking.add_rank(slim, order, ["snapshot_block_number"]).drop("total_volume")


@query("w07_block_trace_index", """
    select block_number, to_address, reward_type,
      row_number() over (partition by block_number, trace_type order by reward_type, to_address, value) - 1
        as type_index from {reward_rows}""")
def _(t):
    loose = t.reward_rows.withColumns({"transaction_hash": F.lit(None).cast("string"),
                                       "from_address": F.lit(None).cast("string")})
    return derive.block_trace_index(loose).select("block_number", "to_address", "reward_type", "type_index")


@query("w08_arrival_index", """
    select transaction_hash, path,
      row_number() over (partition by block_number order by transaction_index, transaction_hash, path) - 1
        as trace_index from {trace_rows}""")
def _(t):
    place = F.struct("transaction_index", "transaction_hash", "path")
    landed = t.trace_rows.select("block_number", "transaction_hash", "path", place.alias("position"),
                                 F.col("path").alias("trace_id"))
    return derive.arrival_index(landed).select("transaction_hash", "path", "trace_index")


@query("o01_ordered", "select block_number, transaction_index, hash from {transactions}")
def _(t):
    return ranking.ordered(t.transactions.select("block_number", "transaction_index", "hash"), "transaction")


@query("o07_capped", """
    select address, reputation_score from {reputations}
    where date = (select max(date) from {reputations}) order by rank, address limit 1000""")
def _(t):
    newest = t.reputations.where(F.col("date") == t.reputations.agg(F.max("date")).scalar())
    return ranking.capped(newest, [F.col("rank").asc(), F.col("address").asc()], 1000).select("address", "reputation_score")


@query("o08_sorted_by", """
    select category, count(*) as n from {label_contract} group by 1 order by n desc""")
def _(t):
    return ranking.sorted_by(t.label_contract.groupBy("category").agg(F.count(F.lit(1)).alias("n")), "n")


# --- derived entities --------------------------------------------------------

TRANSFERS_SQL = f"""
    select lower(address) as token_address,
      concat('0x', right(lower(concat('0xaa', lpad(lower(hex(wallet)), 38, '0'))), 40)) as from_address,
      concat('0xcc', lpad(lower(hex(receiver)), 38, '0')) as to_address,
      cast(case when line = 5 then cents else cents * 100000000000 end as string) as value,
      transaction_hash, log_index, block_number from {{log_rows}} where line <= 5"""


@query("x01_transfers_from_logs", TRANSFERS_SQL)
def _(t):
    return derive.transfers_from_logs(t.logs).select(
        "token_address", "from_address", "to_address", "value", "transaction_hash", "log_index", "block_number")


@query("x01_transfers_decimal", TRANSFERS_SQL)
def _(t):
    # The exact decimal instead of the text: no Python in this plan.
    return derive.transfers_from_logs(t.logs).select(
        "token_address", "from_address", "to_address", F.col("value_dec").cast("string").alias("value"),
        "transaction_hash", "log_index", "block_number")


@query("x02_transfers_strict", f"""
    select block_number, concat('0xaa', lpad(lower(hex(wallet)), 38, '0')) as from_address,
      concat('0xcc', lpad(lower(hex(receiver)), 38, '0')) as to_address,
      cast(cents * 100000000000 as double) as token_transfer, address as token_address, transaction_hash
    from {{log_rows}} where line <= 3
      and split(topics_text, ',')[1] = '0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef'""")
def _(t):
    return derive.transfers_strict(t.logs).drop("block_timestamp")


TOKENS_AT = ["0xee00000000000000000000000000000000000001", "0xEE0000000000000000000000000000000000002A"]


@query("x03_transfers_for", f"""
    select transaction_hash, lower(address) as token_address from {{log_rows}}
    where line <= 5 and block_number between {FIRST} and {FIRST} + 9000
      and lower(address) in ('{TOKENS_AT[0].lower()}', '{TOKENS_AT[1].lower()}')""")
def _(t):
    found = derive.transfers_for(t.logs, TOKENS_AT, FIRST, FIRST + 9000)
    return found.select("transaction_hash", "token_address")


def typed_traces(t):
    path = F.when(F.col("path") == "", F.array().cast("array<int>")).otherwise(
        F.split("path", ",").cast("array<int>"))
    return t.trace_rows.withColumn("trace_address", path)


# Three calls a transaction, each inside the one before: a trace fails with any that starts its path.
TRACE_STATUS_SQL = """
    select transaction_hash, path, trace_type, to_address,
      case when coalesce(max(case when path = '' then error end) over same, '') <> ''
        or path <> '' and coalesce(max(case when path = '0' then error end) over same, '') <> ''
        or coalesce(error, '') <> '' then 0 else 1 end as status
    from {trace_rows} window same as (partition by transaction_hash)"""


@query("x10_trace_status", TRACE_STATUS_SQL)
def _(t):
    return derive.trace_status(typed_traces(t)).select("transaction_hash", "path", "trace_type", "to_address", "status")


CONTRACTS_SQL = f"""
    with s as ({TRACE_STATUS_SQL})
    select to_address as address, '0x18160ddd,0x70a08231' as selectors, false as is_erc20, false as is_erc721 from s
    where trace_type = 'create' and to_address <> '' and status = 1"""


@query("x04_contracts_from_traces", CONTRACTS_SQL)
def _(t):
    found = derive.contracts_from_traces(derive.trace_status(typed_traces(t)))
    return found.select("address", F.array_join("function_sighashes", ",").alias("selectors"), "is_erc20", "is_erc721")


INTERFACES_SQL = "select address, selectors, is_erc20, is_erc721 from {contracts}"


@query("x05_contracts_from_code", INTERFACES_SQL)
def _(t):
    landed = t.contracts.select("address", F.col("bytecode").alias("code"), "block_number")
    found = derive.contracts_from_code(landed)
    return found.select("address", F.array_join("function_sighashes", ",").alias("selectors"), "is_erc20", "is_erc721")


@query("x06_classify_interfaces", INTERFACES_SQL)
def _(t):
    listed = t.contracts.select("address", "selectors", F.split("selectors", ",").alias("_s"))
    return listed.select("address", "selectors", bytecode.is_erc20(F.col("_s")).alias("is_erc20"),
                         bytecode.is_erc721(F.col("_s")).alias("is_erc721"))


@query("u01_sighashes", "select address, selectors from {contracts}")
def _(t):
    return t.contracts.select("address", F.array_join(bytecode.sighashes("bytecode"), ",").alias("selectors"))


@query("x07_token_candidates", "select address from {contracts} where is_erc20 or is_erc721")
def _(t):
    return derive.token_candidates(t.contracts).select("address")


@query("x08_resolve_token_metadata", """
    select lower(address) as address, case when decimals > 16 then symbol else name end as symbol, name,
      cast(decimals as string) as decimals from {tokens}""")
def _(t):
    calls = t.tokens.select(
        "address", F.when(F.col("decimals") > 16, F.col("symbol")).alias("symbol"),
        F.encode(F.concat("name", F.lit("\u0000")), "utf-8").alias("symbol_bytes32"),
        F.concat("name", F.lit("\u0000")).alias("name"), F.lit(None).cast("string").alias("decimals"),
        F.col("decimals").cast("string").alias("DECIMALS_upper"), "total_supply", "block_number")
    found = derive.resolve_token_metadata(calls)
    return found.select("address", "symbol", "name", F.col("decimals").cast("string").alias("decimals"))


@query("f14_trace_id", """
    select transaction_hash, path,
      concat(trace_type, '_', transaction_hash, '_', replace(path, ',', '_')) as trace_id from {trace_rows}""")
def _(t):
    return typed_traces(t).select("transaction_hash", "path", scalars.trace_id().alias("trace_id"))


@query("x11_number_traces", """
    select transaction_hash, path, concat(trace_type, '_', transaction_hash, '_', replace(path, ',', '_')) as trace_id
    from {trace_rows}
    union all
    select null, null, concat(trace_type, '_', cast(block_number as string), '_', cast(
      row_number() over (partition by block_number, trace_type order by reward_type, to_address, value) - 1 as string))
    from {reward_rows}""")
def _(t):
    calls = typed_traces(t).select("block_number", "transaction_hash", "path", "trace_type", "reward_type",
                                   "from_address", "to_address", "value", "trace_address")
    both = rows.union_aligned(calls, t.reward_rows.select("block_number", "trace_type", "reward_type", "to_address", "value"))
    return derive.number_traces(both).select("transaction_hash", "path", "trace_id")


@query("x12_with_seed_traces", f"""
    select block_number, to_address, cast(value as string) as value, trace_type from {{reward_rows}}
    union all select 0, address, cast(1000 as string), 'genesis' from {{contracts}}
    union all select {FIRST}, address, cast(7 as string), 'daofork' from {{contracts}} where is_erc20""")
def _(t):
    whole = t.reward_rows.withColumn("from_address", F.lit(None).cast("string"))
    genesis = t.contracts.select("address", F.lit(1000).alias("value"))
    forks = t.contracts.where("is_erc20").select(F.lit("0x00").alias("from_address"),
                                                 F.col("address").alias("to_address"), F.lit(7).alias("value"))
    whole = whole.withColumn("status", F.lit(1))
    found = derive.with_seed_traces(whole, genesis, forks, FIRST, 0, 10 * FIRST)
    return found.select("block_number", "to_address", F.col("value").cast("string").alias("value"), "trace_type")


@query("x16_shop_data_dir", """
    select page_id, nullif(regexp_extract(html, '<link rel="data-dir" href="(.+?)"', 1), '') as data_dir from {pages}""")
def _(t):
    return derive.shop_data_dir(t.pages.select("page_id", "html")).select("page_id", "data_dir")


@query("x17_address_dictionary", """
    select address, row_number() over (order by address) as id from (
      select from_address as address from {transactions} union select to_address from {transactions})
    where address is not null""")
def _(t):
    ends = t.transactions.select(F.explode(F.array("from_address", "to_address")).alias("address"))
    return derive.address_dictionary(ends)


@query("x17_address_dictionary_extended", """
    with old as (select address, row_number() over (order by address) as id from
      (select distinct from_address as address from {transactions} where from_address is not null)),
    fresh as (select distinct to_address as address from {transactions} where to_address is not null
      and to_address not in (select address from old))
    select address, id from old union all
    select address, row_number() over (order by address) + (select max(id) from old) from fresh""")
def _(t):
    old = derive.address_dictionary(t.transactions.select(F.col("from_address").alias("address")))
    return derive.address_dictionary(t.transactions.select(F.col("to_address").alias("address")), old)


DAYS_SQL = {"blocks": "cast(trunc((block_number - lo - 90) / 28800.0) as int)",
            "days": "cast(trunc((block_number - lo) / 28800.0 - 90) as int)"}


@query("x18_block_weights", f"""
    with b as (select distinct block_number, (select min(block_number) from {{transactions}}) as lo from {{transactions}})
    select block_number, {DAYS_SQL['days']} as block_date,
      round(1.0 / (1.0 + exp(-{DAYS_SQL['days']} / 64.0)), 12) as age_weight from b""")
def _(t):
    return rounded(derive.block_weights(t.transactions, "days"), 12, "age_weight")


@query("f09_age_weight", f"""
    select number, round(1.0 / (1.0 + exp(-((number - {FIRST}) / 1000.0) / 64.0)), 12) as weight from {{blocks}}""")
def _(t):
    age = (F.col("number") - FIRST) / F.lit(1000.0)
    return rounded(t.blocks.select("number", scalars.age_weight(age).alias("weight")), 12, "weight")


@query("f10_block_age", f"""
    with b as (select number as block_number, {FIRST} as lo from {{blocks}})
    select block_number, {DAYS_SQL['blocks']} as blocks_form, {DAYS_SQL['days']} as days_form from b""")
def _(t):
    age = lambda mode: scalars.block_age(F.col("number"), F.lit(FIRST), mode)
    return t.blocks.select(F.col("number").alias("block_number"), age("blocks").alias("blocks_form"),
                           age("days").alias("days_form"))


@query("f11_minmax", """
    select address, snapshot_block_number, round((total_volume - (select min(total_volume) from {scores}))
      / ((select max(total_volume) from {scores}) - (select min(total_volume) from {scores})), 12) as scaled
    from {scores}""")
def _(t):
    found = ranking.minmax(t.scores.select("address", "snapshot_block_number", "total_volume"), "total_volume", "scaled")
    return rounded(found.drop("total_volume"), 12, "scaled")


@query("x19_flag_contracts", """
    select a.address, c.address is not null as contract from (
      select from_address as address from {transactions} union select to_address from {transactions}) a
    left join {contracts} c on a.address = c.address""")
def _(t):
    ends = t.transactions.select(F.explode(F.array("from_address", "to_address")).alias("address")).distinct()
    return joins.flag_contracts(ends, t.contracts)


# --- quality -----------------------------------------------------------------


@query("q02_duplicate_blocks", """
    select block_number as number, count(*) as n from {transactions} group by 1 having count(*) > 1""")
def _(t):
    return writers.duplicate_blocks(t.transactions.select(F.col("block_number").alias("number")))


@query("q03_odd_transfers", "select transaction_hash, log_index from {log_rows} where line = 6")
def _(t):
    return derive.odd_transfers(t.logs).select("transaction_hash", "log_index")


@query("q04_orphan_traces", """
    select transaction_hash, path from (
      select transaction_hash, path,
        count(case when path = '0' and trace_type = 'call' then 1 end) over (partition by transaction_hash) as parents
      from {trace_rows}) where path = '0,0' and parents = 0""")
def _(t):
    kept = typed_traces(t).where("not (path = '0' and trace_type = 'create')")
    return derive.orphan_traces(kept).select("transaction_hash", "path")


@query("q05_invalid_rows", """
    select from_address, n, 'bad sender' as problem from (
      select from_address, count(*) as n from {transactions} group by 1) where from_address like '0xcc%'""")
def _(t):
    rules = {"bad sender": (["from_address"], F.col("from_address").startswith("0xcc"))}
    found = quality.invalid_rows(t.transactions, rules)
    return found.groupBy("from_address", F.get("problems", F.lit(0)).alias("problem")).agg(F.count(F.lit(1)).alias("n"))


@query("q06_unknown_category", """
    select coalesce(nullif(category, ''), 'Unknown') as category, count(*) as n from {label_contract} group by 1""")
def _(t):
    name = scalars.or_unknown(F.col("category"), blank=True).alias("category")
    return t.label_contract.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
