"""Dashboards and the aggregates behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.plans import dashboards as d
from chainlake.registry.base import query, rounded
from chainlake.registry.rows_q import BIN_BAND, EOA_BAND

LAST = "snapshot_block_number = (select max(snapshot_block_number) from {scores})"
M = d.MEASURES


def stats_sql(fn: str, digits: int) -> str:
    return ", ".join(f"round({fn}({m}), {digits}) as {m}" for m in M)


def overview_sql(fn: str, digits: int) -> str:
    groups = [(1, "All addresses", "true"), (2, "Contracts", "contract"), (3, "EOAs", "not contract"),
              (4, "EOA*s", "not contract and reputation_score_log_scale < 500 and reputation_score_log_scale > 0")]
    return " union all ".join(
        f"select {i} as id, '{name}' as categories, {stats_sql(fn, digits)} from {{scores}} where {LAST} and {cond}"
        for i, name, cond in groups)


@query("b01_overview_var", overview_sql("var_samp", 4))
def _(t):
    return rounded(d.overview(t.scores, "var"), 4, *M)


@query("b02_overview_mean", overview_sql("avg", 6))
def _(t):
    return rounded(d.overview(t.scores, "mean"), 6, *M)


@query("a03_category_moments", f"""
    select category, round(avg(reputation_score), 6) as mean, round(var_samp(reputation_score), 4) as var
    from {{scores}} s join {{label_contract}} l on s.address = l.address where {LAST} group by 1""")
def _(t):
    from chainlake.operators.joins import join_project

    found = join_project(d.latest(t.scores), t.label_contract, ("address", "address"), ["reputation_score"], ["category"])
    out = found.groupBy("category").agg(d.STATS["mean"]("reputation_score").alias("mean"),
                                        d.STATS["var"]("reputation_score").alias("var"))
    return rounded(rounded(out, 6, "mean"), 4, "var")


TOPIC = "'0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef'"
METRIC_SQL = f"""
    with s as (select * from {{scores}} where {LAST}),
    top as (select max(snapshot_block_number) as b from s),
    r as (
    select 'Total blocks' as categories, cast(max(snapshot_block_number) - 15993179 + 1 as double) as value from s
    union all select 'Total transactions', cast(
      (select count(*) from {{transactions}}, top where block_number between 15993179 and top.b)
      + (select count(*) from {{log_rows}}, top where block_number between 15993179 and top.b
          and len(split(topics_text, ',')) = 3 and split(topics_text, ',')[1] = {TOPIC}) as double)
    union all select 'Total gas spent (ETH)', sum(total_gas_spent) from s
    union all select 'Total address', count(*) from s
    union all select 'Total contracts', count(*) from s where contract
    union all select 'Total contracts with zero-GRS', count(*) from s where contract and reputation_score = 0
    union all select 'Total EOAs', count(*) from s where not contract
    union all select 'Total EOAs with zero-GRS', count(*) from s where not contract and reputation_score = 0
    union all select 'Average GRS (Contract Group)', sum(reputation_score) / count(*) from s where contract
    union all select 'Average GRS (EOA Group)', sum(reputation_score) / count(*) from s where not contract
    union all select 'Average GRS (Non-zero EOA Group)', sum(reputation_score) / count(*) from s
      where not contract and reputation_score <> 0
    union all select 'Variance (Contract Group)', var_samp(reputation_score) from s where contract
    union all select 'Variance (EOA Group)', var_samp(reputation_score) from s where not contract)
    select categories, round(value, 4) as value from r"""


@query("b03_key_metrics", METRIC_SQL)
def _(t):
    return rounded(d.key_metrics(t.scores, t.transactions, t.logs), 4, "value")


@query("a04_key_metrics_spread", METRIC_SQL + " where categories like 'Average%' or categories like 'Variance%'")
def _(t):
    found = d.key_metrics(t.scores, t.transactions, t.logs)
    found = found.where(F.col("categories").like("Average%") | F.col("categories").like("Variance%"))
    return rounded(found, 4, "value")


@query("d08_metric_rows", f"""
    select 'rows' as categories, cast(count(*) as double) as value from {{scores}} where {LAST}
    union all select 'best', max(reputation_score) from {{scores}} where {LAST}""")
def _(t):
    one = d.latest(t.scores).agg(F.count(F.lit(1)).cast("double").alias("rows"), F.max("reputation_score").alias("best"))
    return one.unpivot([], ["rows", "best"], "categories", "value")


@query("a22_group_mean", f"""
    select round(sum(reputation_score) / count(*), 9) as mean from {{scores}}
    where {LAST} and not contract and reputation_score <> 0""")
def _(t):
    rows = d.latest(t.scores).where(~F.col("contract") & (F.col("reputation_score") != 0))
    mean = F.try_divide(F.sum("reputation_score"), F.count(F.lit(1)))
    return rows.agg(F.round(mean, 9).alias("mean"))


def histogram_sql(col: str, where: str = "true") -> str:
    return f"""select cast(floor({col} / 5) * 5 as int) as bin_floor, round(log10(count(*)), 9) as log_count
      from {{scores}} where {LAST} and {where} group by 1"""


def _histogram(name: str, col: str, where: str = "true", contract: bool | None = None):
    @query(name, histogram_sql(col, where))
    def _(t):
        return rounded(d.log_histogram(t.scores, col, contract=contract), 9, "log_count")


_histogram("a05_log_histogram", "total_volume")
_histogram("b04_rs_all", "reputation_score")
_histogram("b05_rs_all_log", "reputation_score_log_scale")
_histogram("b06_rs_contract_log", "reputation_score_log_scale", "contract", True)
_histogram("b07_rs_eoa", "reputation_score", "not contract", False)
_histogram("b08_rs_eoa_log", "reputation_score_log_scale", "not contract", False)

GROUPS_SQL = f"""
    with s as (select * from {{scores}} where {LAST}),
    g as (select 'Non-zero EOAs' as groups, count(*) as n, sum(reputation_score) as v from s
            where not contract and reputation_score <> 0
          union all select 'Zero EOAs', count(*), 0 from s where not contract and reputation_score = 0
          union all select 'Contracts', count(*), sum(reputation_score) from s where contract)
    select groups, n as num_of_addresses, round(n * 100.0 / (select count(*) from s), 2) as num_of_addresses_percentage,
      round(v, 4) as total_reputation_score,
      round(v * 100.0 / (select sum(reputation_score) from s), 2) as total_reputation_score_percentage from g"""


@query("b09_main_groups", GROUPS_SQL)
def _(t):
    return rounded(d.main_groups(t.scores), 4, "total_reputation_score")


SHARE_SQL = """
    with c as (select category, count(*) as n from {label_contract} group by 1)
    select category, n, round(n * 100.0 / (select sum(n) from c), 4) as share from c"""


def _share(t):
    counts = t.label_contract.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return d.with_share(counts, "n", "share", 4)


query("a07_share_of_total", SHARE_SQL)(_share)


@query("a08_share_by_subquery", f"""
    with s as (select * from {{scores}} where {LAST})
    select {EOA_BAND} as band, round(count(*) * 100.0 / (select count(*) from s), 4) as share from s group by 1""")
def _(t):
    from chainlake.functions.scalars import eoa_band

    last = d.latest(t.scores)
    total = last.agg(F.count(F.lit(1))).scalar()
    share = F.round(F.count(F.lit(1)) * F.lit(100.0) / F.any_value("_all"), 4)
    band = eoa_band(F.col("reputation_score_log_scale")).alias("band")
    return last.withColumn("_all", total).groupBy(band).agg(share.alias("share"))


@query("w05_with_total", """
    select project_id, count(*) as n, cast(sum(count(*)) over () as bigint) as total
    from {label_contract} group by 1""")
def _(t):
    counts = t.label_contract.groupBy("project_id").agg(F.count(F.lit(1)).alias("n"))
    return d.with_total(counts, "n", "total")


CATEGORY_SQL = f"""
    with s as (select * from {{scores}} where {LAST}),
    owned as (select s.address, s.reputation_score, coalesce(nullif(l.category, ''), 'Unknown') as category
      from s left join {{label_contract}} l on lower(s.address) = lower(l.address) where s.contract),
    once as (select * from (select *, row_number() over (partition by address order by category) as rn from owned)
      where rn = 1),
    totals as (select category, sum(reputation_score) as trep, count(distinct address) as noa from once group by 1),
    callers as (select et.from_address, coalesce(nullif(l.category, ''), 'Unknown') as category,
        max(s.reputation_score) as rs
      from {{transactions}} et join {{label_contract}} l on lower(et.to_address) = lower(l.address)
      join s on et.from_address = s.address and not s.contract and s.reputation_score < 651.3227399106263
      where cast(et.block_timestamp as date) >= date '2023-01-01' group by 1, 2)
    select t.category as contract_categories, uaws, round(avg_rs, 6) as avg_rs,
      round(trep, 4) as total_reputation_score, cast(noa as int) as num_of_addresses,
      round(trep * 100 / (select sum(trep) from totals), 6) as total_reputation_score_percentage,
      round(noa * 100.0 / (select sum(noa) from totals), 6) as num_of_addresses_percentage
    from totals t join (select category, count(distinct from_address) as uaws, avg(rs) as avg_rs
      from callers group by 1) c on c.category = t.category"""


@query("b10_contract_categories", CATEGORY_SQL)
def _(t):
    found = d.contract_categories(t.scores, t.label_contract, t.transactions)
    found = rounded(found, 6, "avg_rs", "total_reputation_score_percentage", "num_of_addresses_percentage")
    return rounded(found, 4, "total_reputation_score")


CONTRACT_BAND = """case when reputation_score_log_scale > 680 then '5. Excellent'
      when reputation_score_log_scale > 300 then '4. High' when reputation_score_log_scale > 100 then '3. Medium'
      when reputation_score_log_scale > 0 then '2. Low' else '1. Zero-GRS' end"""
IN_RANGE = """contract and snapshot_block_number = (select max(number) from {blocks}
      where cast(timestamp as date) between date '2022-11-18' and date '2023-09-15')"""


@query("b11_contract_bands_mean", f"""
    select {CONTRACT_BAND} as partition, {', '.join(f'round(sum({m}) / count(*), 3) as {m}' for m in M)}
    from {{scores}} where {IN_RANGE} group by 1""")
def _(t):
    return d.contract_bands(t.scores, t.blocks, "mean")


@query("a11_band_means", f"""
    select {CONTRACT_BAND} as partition, {', '.join(f'round(sum({m}) / count(*), 3) as {m}' for m in M)}
    from {{scores}} where {IN_RANGE} group by 1""")
def _(t):
    return d.contract_bands(t.scores, t.blocks, "mean")


@query("b12_contract_bands_var", f"""
    select {CONTRACT_BAND} as partition, {stats_sql('var_samp', 4)} from {{scores}} where {IN_RANGE} group by 1""")
def _(t):
    return rounded(d.contract_bands(t.scores, t.blocks, "var"), 4, *M)


PROFILE = ", ".join(f"top.{c}" for c in d.PROFILE)


def leaders_sql(labels: str, cond: str, limit: float) -> str:
    return f"""
    with s as (select * from {{scores}} where {LAST}),
    top as (select s.*, l.identity from s join {{{labels}}} l on l.address = s.address where {cond}
      order by s.rank, s.address, l.identity limit 10),
    calls as (select distinct et.to_address, et.from_address, s.reputation_score as rs
      from {{transactions}} et join s on et.from_address = s.address and not s.contract and s.reputation_score <= {limit}
      where et.to_address in (select address from top)
        and et.block_number between 15993179 and (select max(snapshot_block_number) from s)),
    u as (select top.address, count(c.from_address) as uaw, avg(c.rs) as average_rs
      from calls c join top on top.address = c.to_address group by 1)
    select top.rank, top.address, top.identity, {PROFILE}, u.uaw, round(u.average_rs, 6) as average_rs
    from u join top on u.address = top.address"""


@query("b13_top10_contract_uaw", leaders_sql("label_contract", "s.contract", 500))
def _(t):
    found = d.top10_with_uaw(t.scores, t.label_contract, t.transactions, True, d.CALLER_LIMIT)
    return rounded(found, 6, "average_rs")


@query("b19_top10_highest_uaw", leaders_sql("label_eoa", "not s.contract", 651.3227399106263))
def _(t):
    found = d.top10_with_uaw(t.scores, t.label_eoa, t.transactions, False, d.HIGHEST_SCORE)
    return rounded(found, 6, "average_rs")


@query("a10_callers_of", f"""
    with s as (select * from {{scores}} where {LAST})
    select et.to_address, count(distinct et.from_address) as callers, round(avg(distinct s.reputation_score), 6) as mean
    from {{transactions}} et join s on et.from_address = s.address and not s.contract and s.reputation_score <= 500
    where et.to_address in (select address from {{contracts}} where is_erc20)
      and et.block_number between 15993179 and (select max(snapshot_block_number) from s) group by 1""")
def _(t):
    found = d.callers_of(t.contracts.where("is_erc20"), t.transactions, t.scores, 500)
    out = found.groupBy("to_address").agg(F.count(F.lit(1)).alias("callers"), F.avg(F.col("RS")).alias("_m"),
                                          F.sum_distinct("RS").alias("_s"), F.count_distinct("RS").alias("_n"))
    return out.select("to_address", "callers", F.round(F.col("_s") / F.col("_n"), 6).alias("mean"))


@query("o03_top_labelled", f"""
    select s.rank, s.address, l.identity from {{scores}} s join {{label_eoa}} l on l.address = s.address
    where {LAST} and not contract order by s.rank, s.address, l.identity limit 10""")
def _(t):
    return d.top_labelled(t.scores, t.label_eoa, False).select("rank", "address", "identity")


@query("b14_nonzero_overview", f"""
    with s as (select * from {{scores}} where {LAST} and not contract and reputation_score > 0)
    select 'Average Score' as categories, {stats_sql('avg', 4)} from s
    union all select 'Variance', {stats_sql('var_samp', 4)} from s""")
def _(t):
    return rounded(d.nonzero_overview(t.scores), 4, *M)


@query("b15_eoa_histogram", f"""
    with b as (select cast(floor(reputation_score_log_scale / 2) * 2 as int) as bin, count(*) as n from {{scores}}
      where {LAST} and not contract and reputation_score > 0 group by 1)
    select bin as bin_floor, round(log10(n), 9) as count_log, {BIN_BAND.format(b='bin')} as bin_category from b""")
def _(t):
    return rounded(d.eoa_histogram(t.scores), 9, "count_log")


@query("b16_eoa_distribution", f"""
    with s as (select * from {{scores}} where {LAST} and not contract and reputation_score > 0)
    select {EOA_BAND} as partition, count(*) as num_of_eoa,
      round(count(*) * 100.0 / (select count(*) from s), 4) as num_of_eoa_percentage,
      round(sum(reputation_score), 2) as reputation_value,
      round(sum(reputation_score) * 100.0 / (select sum(reputation_score) from s), 2) as reputation_value_percentage
    from s group by 1""")
def _(t):
    return d.eoa_distribution(t.scores)


@query("b17_eoa_bands_mean", f"""
    select {EOA_BAND} as partition, {stats_sql('avg', 4)} from {{scores}} where {LAST} and not contract group by 1""")
def _(t):
    return rounded(d.eoa_bands(t.scores, "mean"), 4, *M)


@query("b18_eoa_bands_var", f"""
    select {EOA_BAND} as partition, {stats_sql('var_samp', 4)} from {{scores}} where {LAST} and not contract group by 1""")
def _(t):
    return rounded(d.eoa_bands(t.scores, "var"), 4, *M)


def _band(name: str, low: float, high: float, identity: bool = True, hide: bool = False, low_open: bool = False):
    named = "coalesce(l.identity, 'Unknown') as identity," if identity else ""
    hidden = "and s.address not in (" + ", ".join(f"'{a}'" for a in d.HIDDEN_EOAS) + ")" if hide else ""
    cols = ", ".join(f"s.{c}" for c in d.PROFILE)

    @query(name, f"""
        select s.rank, s.address, {named} {cols} from {{scores}} s left join {{label_eoa}} l on l.address = s.address
        where {LAST} and not contract and reputation_score > 0 {hidden}
          and reputation_score_log_scale < {high} and reputation_score_log_scale {'>' if low_open else '>='} {low}
        order by s.rank, s.address, coalesce(l.identity, 'Unknown') limit 10""")
    def _(t):
        return d.top_in_band(t.scores, t.label_eoa, low, high, d.HIDDEN_EOAS if hide else None, identity,
                             low_open=low_open)


_band("b20_top10_high", 300, 500, hide=True)
_band("b21_top10_experience", 150, 300)
_band("b22_top10_medium", 50, 150, identity=False)
_band("b23_top10_low", 25, 50, identity=False)
_band("b24_top10_lowest", 0, 25, identity=False, low_open=True)
_band("o02_top_in_band", 300, 500)


def _history(name: str, labels: str, limit: int):
    @query(name, f"""
        select l.address, l.identity, s.rank as grank, s.snapshot_block_timestamp as time
        from (select * from {{{labels}}} where identity not like 'Unknow%') l
        left join (select * from {{scores}} where rank < {limit}) s on l.address = s.address where rank > 0""")
    def _(t):
        return d.rank_history(getattr(t, labels), t.scores, limit)


_history("b25_historical_eoa", "label_eoa", 50)
_history("b26_historical_contract", "label_contract", 30)

DAILY_SQL = f"""
    with s as (select address, reputation_score, reputation_score_log_scale from {{scores}} where {LAST} and not contract),
    per as (select l.category, et.from_address as address, cast(et.block_timestamp as date) as transaction_date,
        count(et.hash) as n, avg(s1.reputation_score) as a1, avg(s2.reputation_score) as a2
      from {{transactions}} et join {{label_contract}} l on et.to_address = l.address
      join s s1 on et.from_address = s1.address {{join}}
      where cast(et.block_timestamp as date) >= date '2023-01-01' and {{cond}} group by 1, 2, 3)
    select {{cols}} transaction_date, count(address) as uaw, cast(sum(n) as bigint) as transactions,
      round(avg(a1), 6) as average_rs, round(avg(a2), 6) as average_rs_excluded_highest from per group by {{cols}} transaction_date"""
CAPPED = "join (select * from s where reputation_score_log_scale < 500) s2 on et.from_address = s2.address"


def daily_sql(cond: str, join: str = CAPPED, cols: str = "") -> str:
    return DAILY_SQL.replace("{join}", join).replace("{cond}", cond).replace("{cols}", cols)


def _daily(name: str, category: str):
    @query(name, daily_sql(f"l.category = '{category}'"))
    def _(t):
        found = d.uaw_category_daily(t.transactions, t.label_contract, t.scores, category)
        return rounded(found, 6, "average_rs", "average_rs_excluded_highest")


for _id, _category in zip(range(27, 32), d.CATEGORIES):
    _daily(f"b{_id}_uaw_daily_{_category.lower()}", _category)

IN_FIVE = "l.category in ('DeFi', 'NFT', 'SocialFi', 'GameFi', 'L2s')"


@query("j20_category_activity", daily_sql(IN_FIVE, cols="category,"))
def _(t):
    found = d.uaw_category_daily(t.transactions, t.label_contract, t.scores)
    return rounded(found, 6, "average_rs", "average_rs_excluded_highest")


@query("j20_category_activity_uncapped", daily_sql(IN_FIVE, "left " + CAPPED, "category,"))
def _(t):
    found = d.uaw_category_daily(t.transactions, t.label_contract, t.scores, literal=False)
    return rounded(found, 6, "average_rs", "average_rs_excluded_highest")


@query("a09_daily_category", """
    select category, from_address, cast(block_timestamp as date) as transaction_date, count(hash) as transaction_count
    from {transactions} join {label_contract} on to_address = address
    where cast(block_timestamp as date) >= date '2023-01-01'
      and category in ('DeFi', 'NFT', 'SocialFi', 'GameFi', 'L2s') group by 1, 2, 3""")
def _(t):
    return d.category_calls(t.transactions, t.label_contract)
