"""Serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.operators.ranking import SORT_FIELDS, sorting_table
from chainlake.plans import serving as s
from chainlake.registry.base import query, rounded

NEWEST = "date = (select max(date) from {reputations})"
COLS = "address, rank, date, reputation_score, total_txn, total_volume, total_gas_spent, is_contract, degree"
SORTING = "select distinct " + COLS + " from (" + " union all ".join(
    f"select * from (select {COLS} from {{top_reputations}} order by {f} {o}, address limit 100)"
    for f in SORT_FIELDS for o in ("asc", "desc")) + ")"


@query("o04_sorting_table", SORTING)
def _(t):
    return sorting_table(t.top_reputations)


@query("r06_sorting_table", SORTING)
def _(t):
    return sorting_table(t.top_reputations)


def addresses_sql(sort: str, take: int, extra: str = "") -> str:
    return f"""
    with sorting as ({SORTING}), r as (select * from sorting order by {sort} {extra}, address limit {take})
    select r.rank, r.address, l.identity, r.is_contract, r.reputation_score, r.total_txn, r.total_gas_spent,
      r.degree, r.total_volume from r left join {{service_labels}} l on r.address = l.address"""


@query("r01_rank_addresses", addresses_sql("reputation_score desc", 50))
def _(t):
    return s.rank_addresses(t.top_reputations, sorting_table(t.top_reputations), t.service_labels)


@query("o05_rank_addresses_by_type", addresses_sql("is_contract asc", 20, ", reputation_score desc"))
def _(t):
    return s.rank_addresses(t.top_reputations, sorting_table(t.top_reputations), t.service_labels,
                            sort="is_contract", order="ASC", take=20)


ONE = "0xaa00000000000000000000000000000000000005"


@query("r01_rank_one_address", f"""
    select r.rank, r.address, l.identity, r.is_contract, r.reputation_score, r.total_txn, r.total_gas_spent,
      r.degree, r.total_volume from {{top_reputations}} r left join {{service_labels}} l on r.address = l.address
    where r.address = '{ONE}'""")
def _(t):
    return s.rank_addresses(t.top_reputations, t.top_reputations, t.service_labels, address=ONE)


PROJECTS = """
    detail as (select l.project_id, l.project_name, l.category as project_category, count(l.identity) as total_contract,
        sum(r.reputation_score) as total_grs, sum(r.total_txn) as total_txn, sum(r.total_gas_spent) as total_gas,
        sum(r.degree) as total_degree, sum(r.total_volume) as total_tx_volume
      from {top_reputations} r join {service_labels} l on r.address = l.address
      where l.project_id is not null group by 1, 2, 3),
    rolled as (select project_id, project_name, project_category, total_contract, total_grs, total_txn, total_gas,
        total_degree, total_tx_volume, 0 as lvl from detail
      union all select project_id, project_name, 'All', sum(total_contract), sum(total_grs), sum(total_txn),
        sum(total_gas), sum(total_degree), sum(total_tx_volume), 1 from detail group by 1, 2)"""
SHOWN = """project_id, project_name, project_category, cast(total_contract as bigint) as total_contract,
      round(total_grs, 4) as total_grs, cast(total_txn as bigint) as total_txn, round(total_gas, 4) as total_gas,
      cast(total_degree as bigint) as total_degree, round(total_tx_volume, 4) as total_tx_volume"""


def _projects(t):
    return s.project_rollup(t.top_reputations, t.service_labels)


def shown(df):
    return rounded(df, 4, "total_grs", "total_gas", "total_tx_volume")


@query("a12_project_rollup", f"with {PROJECTS.strip()} select {SHOWN} from rolled")
def _(t):
    return shown(_projects(t)).drop("_level")


RANKED = f"""with {PROJECTS.strip()}
    select row_number() over (partition by lvl order by total_grs desc, project_id, project_name,
      project_category nulls first) as rank, {SHOWN} from rolled"""


@query("w03_ranked_rollup", RANKED)
def _(t):
    return shown(s.ranked_rollup(_projects(t))).drop("_level")


@query("r07_project_table", RANKED)
def _(t):
    return shown(s.project_table(t.top_reputations, t.service_labels)).drop("updated_at")


def page_sql(cond: str, sort: str, take: int, offset: int) -> str:
    return f"""with {PROJECTS.strip()},
    chosen as (select row_number() over (order by {sort}, project_id, project_name) as rank, * from rolled where {cond})
    select rank, {SHOWN} from chosen order by rank limit {take} offset {offset}"""


@query("r02_rank_projects", page_sql("project_category = 'All'", "total_grs desc", 50, 0))
def _(t):
    return shown(s.rank_projects(_projects(t)))


@query("o06_rank_projects_page", page_sql("project_category = 'All'", "total_txn asc", 10, 10))
def _(t):
    return shown(s.rank_projects(_projects(t), sort="total_txn", order="ASC", page=2, take=10))


@query("r02_rank_projects_filtered", page_sql(
    "project_category = 'DeFi' and project_name ilike '%ect 1%'", "total_gas desc", 50, 0))
def _(t):
    return shown(s.rank_projects(_projects(t), category="DeFi", keyword="ect 1", sort="total_gas"))


@query("r02_rank_projects_by_id", page_sql(
    "project_category = 'All' and project_id in ('project-3', 'project-7')", "total_grs desc", 50, 0))
def _(t):
    return shown(s.rank_projects(_projects(t), ids=["project-3", "project-7"]))


@query("a20_project_count", f"""with {PROJECTS.strip()}
    select count(distinct project_id) as total_project from rolled
    where project_category = 'NFT' and project_name ilike '%project%'""")
def _(t):
    return s.project_count(_projects(t), "NFT", "project")


@query("o06_page_meta", f"""with {PROJECTS.strip()}, c as (
      select count(distinct project_id) as n from rolled where project_id is not null)
    select 2 as page, 10 as take, n as total_count, cast(ceil(n / 10.0) as bigint) as page_count,
      n > 20 as has_next_page from c""")
def _(t):
    return s.page_meta(_projects(t), page=2, take=10)


@query("a19_result_meta", """
    select max(date) as last_calculated_at, (select count(*) from {top_reputations}) as total_addresses from {reputations}""")
def _(t):
    return s.result_meta(t.reputations, t.top_reputations)


THREE = ["0xAA00000000000000000000000000000000000007", "0xaa00000000000000000000000000000000000064",
         "0xcc00000000000000000000000000000000000003"]
LISTED = ", ".join(f"'{a.lower()}'" for a in THREE)


def _series(name: str, measure: str, sql: str):
    @query(name, f"select address, reputation_score, date {sql} from {{reputations}} where address in ({LISTED})")
    def _(t):
        return s.score_series(t.reputations, THREE, measure)


_series("r03_score_series", "TotalReputationScore", "")
_series("r03_degree_series", "TotalDegree", ", degree")
_series("r03_txn_series", "TotalTxn", ", total_txn")
_series("r03_gas_series", "TotalGasSpent", ", total_gas_spent")
_series("r03_uaw_series", "UniqueActiveWallet", ", uaw as unique_active_wallet")


@query("r04_latest_score", f"""
    select address, reputation_score, date from {{top_reputations}} where address in ({LISTED})""")
def _(t):
    return s.latest_score(t.top_reputations, THREE)


def _rolled(name: str, frame: str):
    @query(name, f"""
        select address, period, reputation_score from (
          select address, cast(date_trunc('{frame}', date) as date) as period, reputation_score,
            row_number() over (partition by address, date_trunc('{frame}', date) order by date desc) as rn
          from {{reputations}}) where rn = 1""")
    def _(t):
        return s.roll_up_series(t.reputations, frame)


for _frame in ("week", "month", "year"):
    _rolled(f"r09_roll_up_{_frame}", _frame)


@query("r08_for_chain", f"select address, reputation_score from {{top_reputations}} where not is_contract")
def _(t):
    tagged = t.top_reputations.withColumn("chain", F.when(F.col("is_contract"), "bnb").otherwise("eth"))
    return s.for_chain(tagged, "ETH").select("address", "reputation_score")
