"""Ranking and time-series queries, and the tables they are served from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.operators.joins import labelled_scores
from chainlake.operators.latest import latest_by
from chainlake.operators.ranking import add_rank

# Chains and the folders or column values they map to.
CHAINS = {"ETH": "eth", "BNB": "bnb", "ARB": "arb", "MATIC": "matic", "TRX": "trx",
          "XRP": "xrp", "AURORA": "aurora", "BASE": "base", "NEO": "neo"}
CASE_SENSITIVE = {"trx", "xrp", "neo"}
MIN_TAKE, DEFAULT_TAKE, MAX_TAKE = 10, 50, 100
ADDRESS_SORTS = ["reputation_score", "total_txn", "total_volume", "total_gas_spent",
                 "is_contract", "degree"]
PROJECT_SORTS = ["total_grs", "total_txn", "total_gas", "total_degree", "total_tx_volume",
                 "total_contract"]
MEASURES = {
    "TotalReputationScore": ("reputation_score", "reputation_score"),
    "TotalDegree": ("degree", "degree"),
    "TotalTxn": ("total_txn", "total_txn"),
    "TotalGasSpent": ("total_gas_spent", "total_gas_spent"),
    "UniqueActiveWallet": ("uaw", "unique_active_wallet"),
}


def chain_prefix(chain_key: str) -> str:
    """Chain value of a key; an unknown key means Ethereum."""
    return CHAINS.get(chain_key, "eth")


def for_chain(df: DataFrame, chain_key: str) -> DataFrame:
    """One table serves all chains: its rows carry the chain."""
    return df.where(F.col("chain") == chain_prefix(chain_key))


def fold_addresses(addresses: list[str], chain: str = "eth") -> list[str]:
    if not addresses:
        raise ValueError("at least one address is required")
    return list(addresses) if chain in CASE_SENSITIVE else [a.lower() for a in addresses]


def _directed(name: str, order: str):
    if order.upper() not in ("ASC", "DESC"):
        raise ValueError(f"order must be ASC or DESC, not {order!r}")
    return F.col(name).desc() if order.upper() == "DESC" else F.col(name).asc()


def result_meta(reputations: DataFrame, top: DataFrame) -> DataFrame:
    """Last calculated date and address count, one row."""
    return reputations.agg(F.max("date").alias("last_calculated_at")).withColumn(
        "total_addresses", top.agg(F.count(F.lit(1))).scalar()
    )


def rank_addresses(top: DataFrame, sorting: DataFrame, labels: DataFrame, address: str | None = None,
                   sort: str = "reputation_score", order: str = "DESC",
                   take: int = DEFAULT_TAKE) -> DataFrame:
    """Best addresses by a column, from the sorting table; one address, from the full one."""
    if sort not in ADDRESS_SORTS:
        raise ValueError(f"unknown sort {sort!r}")
    if not MIN_TAKE <= take <= MAX_TAKE:
        raise ValueError(f"take must be from {MIN_TAKE} to {MAX_TAKE}, not {take}")
    rows = top.where(F.col("address") == address) if address else sorting
    keys = [_directed(sort, order)]
    if sort == "is_contract":
        keys.append(F.col("reputation_score").desc())
    rows = rows.orderBy(*keys, F.col("address").asc()).limit(take)
    named = labels.select("address", "identity")
    return rows.join(named, "address", "left").select(
        "rank", "address", "identity", "is_contract", "reputation_score", "total_txn",
        "total_gas_spent", "degree", "total_volume",
    )


def _chosen_projects(projects: DataFrame, keyword: str | None, ids: list[str] | None) -> DataFrame:
    if keyword:
        projects = projects.where(F.col("project_name").ilike(f"%{keyword}%"))
    if ids:
        projects = projects.where(F.col("project_id").isin(ids))
    return projects


def rank_projects(projects: DataFrame, category: str = "All", keyword: str | None = None,
                  ids: list[str] | None = None, sort: str = "total_grs", order: str = "DESC",
                  page: int = 1, take: int = DEFAULT_TAKE) -> DataFrame:
    """One page of projects; positions are counted on the page, from its offset."""
    if sort not in PROJECT_SORTS:
        raise ValueError(f"unknown sort {sort!r}")
    offset = (page - 1) * take
    keys = [_directed(sort, order), F.col("project_id").asc(), F.col("project_name").asc()]
    rows = _chosen_projects(projects, keyword, ids).where(F.col("project_category") == category)
    shown = rows.orderBy(*keys).offset(offset).limit(take)
    # The window runs over one page, never over the table.
    place = F.row_number().over(W.orderBy(*keys)) + offset
    return shown.select(
        place.cast("bigint").alias("rank"), "project_id", "project_name", "project_category",
        "total_contract", "total_grs", "total_txn", "total_gas", "total_degree", "total_tx_volume",
    )


def project_count(projects: DataFrame, category: str = "All", keyword: str | None = None,
                  ids: list[str] | None = None) -> DataFrame:
    rows = _chosen_projects(projects, keyword, ids).where("project_id is not null")
    if category != "All":
        rows = rows.where(F.col("project_category") == category)
    return rows.agg(F.count_distinct("project_id").alias("total_project"))


def page_meta(projects: DataFrame, page: int = 1, take: int = DEFAULT_TAKE, **chosen) -> DataFrame:
    """Total, page count and whether a next page exists."""
    total = F.col("total_project")
    return project_count(projects, **chosen).select(
        F.lit(page).alias("page"), F.lit(take).alias("take"), total.alias("total_count"),
        F.ceil(total / take).cast("bigint").alias("page_count"),
        (total > (page - 1) * take + take).alias("has_next_page"),
    )


def score_series(reputations: DataFrame, addresses: list[str], measure: str | None = None,
                 chain: str = "eth", most: int | None = None) -> DataFrame:
    """Score and one more measure of given addresses over time; `most` rows if the caller says so."""
    rows = reputations.where(F.col("address").isin(fold_addresses(addresses, chain)))
    cols = ["address", "reputation_score", "date"]
    source, name = MEASURES.get(measure, ("reputation_score", "reputation_score"))
    extra = [] if name in cols else [F.col(source).alias(name)]
    found = rows.select(*cols, *extra).orderBy("address", "date")
    return found if most is None else found.limit(most)


def latest_score(top: DataFrame, addresses: list[str], chain: str = "eth", most: int | None = None) -> DataFrame:
    """Newest score of each given address; `most` rows if the caller says so."""
    rows = top.where(F.col("address").isin(fold_addresses(addresses, chain)))
    newest = latest_by(rows.select("address", "reputation_score", "date"), ["address"], "date")
    found = newest.orderBy("address")
    return found if most is None else found.limit(most)


def roll_up_series(series: DataFrame, frame: str) -> DataFrame:
    """Last score of each address in each week, month or year."""
    if frame not in ("week", "month", "year"):
        raise ValueError(f"unknown time frame {frame!r}")
    return series.groupBy("address", F.to_date(F.date_trunc(frame, "date")).alias("period")).agg(
        F.max_by("reputation_score", "date").alias("reputation_score")
    )


TOTALS = [("total_grs", "reputation_score"), ("total_txn", "total_txn"),
          ("total_gas", "total_gas_spent"), ("total_degree", "degree"),
          ("total_tx_volume", "total_volume")]


def project_rollup(top: DataFrame, labels: DataFrame) -> DataFrame:
    """Totals per (project, category) and, as category 'All', per project."""
    rows = labelled_scores(top, labels).where("project_id is not null")
    # Categories are summed first, so the grouping sets expand only the small result.
    detail = rows.groupBy("project_id", "project_name", F.col("category").alias("_category")).agg(
        F.count("identity").alias("total_contract"),
        *[F.sum(source).alias(name) for name, source in TOTALS],
    )
    names = ["total_contract", *[name for name, _ in TOTALS]]
    return detail.groupingSets(
        [["project_id", "project_name", "_category"], ["project_id", "project_name"]],
        "project_id", "project_name", "_category",
    ).agg(
        F.grouping("_category").alias("_all"), *[F.sum(n).alias(n) for n in names]
    ).select(
        "project_id", "project_name",
        F.when(F.col("_all") == 1, "All").otherwise(F.col("_category")).alias("project_category"),
        *names, F.col("_all").cast("int").alias("_level"),
    )


def ranked_rollup(rollup: DataFrame) -> DataFrame:
    """Rank by total score, separately for category rows and 'All' rows."""
    order = [F.col("total_grs").desc(), F.col("project_id").asc(), F.col("project_name").asc(),
             F.col("project_category").asc_nulls_first()]
    return add_rank(rollup, order, ["_level"])


def project_table(top: DataFrame, labels: DataFrame) -> DataFrame:
    """The served project table with its refresh time."""
    return ranked_rollup(project_rollup(top, labels)).drop("_level").withColumn(
        "updated_at", F.current_timestamp()
    )

