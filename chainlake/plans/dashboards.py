"""Dashboard result tables over reputation snapshots, labels and transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.functions import scalars
from chainlake.operators import derive
from chainlake.operators.joins import join_ci, rank_history  # noqa: F401  (B25, B26)
from chainlake.operators.latest import one_per_key
from chainlake.session import small

# Measures, first block, score limits, and hidden addresses.
MEASURES = ["reputation_score", "total_transfer", "total_receive", "in_degree", "out_degree",
            "total_volume", "total_gas_spent"]
FIRST_BLOCK = 15993179
HIGHEST_SCORE = 651.3227399106263
CALLER_LIMIT = 500
LOG_LIMIT = 500
HIDDEN_EOAS = [
    "0xce99861f0244d6478a309e2c2565fdaaaa8b0bfb",
    "0xf2e2237b74f0615bb18f265254cc2fbb1a229574",
    "0xfe1ab53b234fcf9a5252e0b73631a143797d9c3b",
    "0x1c70d0a86475cc707b48aa79f112857e7957274f",
    "0xa3728dfd8b471e5ead8b6f08cc37d139b23fe5a9",
]
CATEGORIES = ["DeFi", "NFT", "SocialFi", "GameFi", "L2s"]
SINCE = "2023-01-01"

STATS = {"mean": F.avg, "var": F.var_samp}


def last_snapshot(scores: DataFrame) -> Column:
    return scores.agg(F.max("snapshot_block_number")).scalar()


def latest(scores: DataFrame) -> DataFrame:
    """Rows of the newest snapshot; the bound is a scalar subquery, run once."""
    return scores.where(F.col("snapshot_block_number") == last_snapshot(scores))


def since(tx: DataFrame, day: str = SINCE) -> DataFrame:
    return tx.where(F.col("block_timestamp") >= F.lit(day).cast("timestamp"))


def _is_contract() -> Column:
    return F.col("contract")


def _is_eoa() -> Column:
    return ~F.col("contract")


def _stats(stat: str, names=MEASURES) -> list[Column]:
    return [STATS[stat](F.col(m).cast("double")).alias(m) for m in names]


# --- B01, B02, B14 -----------------------------------------------------------

def overview(scores: DataFrame, stat: str) -> DataFrame:
    """One statistic of seven measures for all, contracts, EOAs and mid-range EOAs.

    Each row counts for one to three groups; one scan feeds all four.
    """
    log = F.col("reputation_score_log_scale")
    group = lambda i, name: F.struct(F.lit(i).alias("id"), F.lit(name).alias("categories"))
    groups = F.filter(
        F.array(
            group(1, "All addresses"),
            F.when(_is_contract(), group(2, "Contracts")),
            F.when(_is_eoa(), group(3, "EOAs")),
            F.when(_is_eoa() & (log < LOG_LIMIT) & (log > 0), group(4, "EOA*s")),
        ),
        lambda g: g.isNotNull(),
    )
    return (
        latest(scores).select(F.explode(groups).alias("_g"), *MEASURES)
        .select("_g.*", *MEASURES).groupBy("id", "categories").agg(*_stats(stat))
    )


def nonzero_overview(scores: DataFrame) -> DataFrame:
    """Mean row and variance row of EOAs with a positive score, from one aggregate."""
    rows = latest(scores).where(_is_eoa() & (F.col("reputation_score") > 0))
    both = rows.agg(*[
        STATS[stat](F.col(m).cast("double")).alias(f"{stat}_{m}") for stat in STATS for m in MEASURES
    ])
    line = lambda name, stat: F.struct(
        F.lit(name).alias("categories"), *[F.col(f"{stat}_{m}").alias(m) for m in MEASURES]
    )
    return both.select(
        F.explode(F.array(line("Average Score", "mean"), line("Variance", "var"))).alias("_r")
    ).select("_r.*")


# --- B03 ---------------------------------------------------------------------

def key_metrics(scores: DataFrame, tx: DataFrame, logs: DataFrame) -> DataFrame:
    """Thirteen labelled figures; the score figures share one conditional aggregate."""
    score = F.col("reputation_score")
    count = lambda cond: F.count(F.when(cond, 1)).cast("double")
    mean = lambda cond: F.try_divide(
        F.sum(F.when(cond, score)), F.count(F.when(cond, 1))
    )
    var = lambda cond: F.var_samp(F.when(cond, score))
    top = last_snapshot(scores)
    window = F.col("block_number").between(F.lit(FIRST_BLOCK), top)
    tx_count = tx.where(window).agg(F.count(F.lit(1))).scalar()
    topics = F.col("topics")
    transfer = (F.size(topics) == 3) & (F.get(topics, F.lit(0)) == derive.TRANSFER_TOPIC)
    log_count = logs.where(window & transfer).agg(F.count(F.lit(1))).scalar()
    contract, eoa = _is_contract(), _is_eoa()
    figures = [
        ("Total blocks", (F.max("snapshot_block_number") - FIRST_BLOCK + 1).cast("double")),
        ("Total gas spent (ETH)", F.sum("total_gas_spent")),
        ("Total address", F.count(F.lit(1)).cast("double")),
        ("Total contracts", count(contract)),
        ("Total contracts with zero-GRS", count(contract & (score == 0))),
        ("Total EOAs", count(eoa)),
        ("Total EOAs with zero-GRS", count(eoa & (score == 0))),
        ("Average GRS (Contract Group)", mean(contract)),
        ("Average GRS (EOA Group)", mean(eoa)),
        ("Average GRS (Non-zero EOA Group)", mean(eoa & (score != 0))),
        ("Variance (Contract Group)", var(contract)),
        ("Variance (EOA Group)", var(eoa)),
    ]
    one = latest(scores).agg(*[expr.alias(f"m{i}") for i, (_, expr) in enumerate(figures)])
    one = one.withColumn("mt", (tx_count + log_count).cast("double"))
    line = lambda name, col: F.struct(F.lit(name).alias("categories"), F.col(col).alias("value"))
    lines = [line(name, f"m{i}") for i, (name, _) in enumerate(figures)]
    lines.insert(1, line("Total transactions", "mt"))
    return one.select(F.explode(F.array(*lines)).alias("_r")).select("_r.*")


# --- B04-B08, B15 ------------------------------------------------------------

def log_histogram(scores: DataFrame, col: str, width: int = 5, contract: bool | None = None,
                  where: Column | None = None) -> DataFrame:
    """log10 of the row count per bin of `width`."""
    rows = latest(scores)
    if contract is not None:
        rows = rows.where(_is_contract() if contract else _is_eoa())
    if where is not None:
        rows = rows.where(where)
    edge = scalars.bin_floor(F.col(col), width).alias("bin_floor")
    return rows.groupBy(edge).agg(F.log10(F.count(F.lit(1))).alias("log_count"))


def eoa_histogram(scores: DataFrame) -> DataFrame:
    """Bins of 2 on the log score of positive EOAs, with the band of each bin."""
    bins = log_histogram(scores, "reputation_score_log_scale", 2, contract=False,
                         where=F.col("reputation_score") > 0)
    return bins.select(
        "bin_floor", scalars.bin_band(F.col("bin_floor")).alias("bin_category"),
        F.col("log_count").alias("count_log"),
    )


# --- B09, B16 ----------------------------------------------------------------

def with_total(df: DataFrame, col: str, out: str) -> DataFrame:
    """Column total beside each row of a grouped result.

    The total is a subquery of its own, so groups in any number stay where they are.
    """
    return df.withColumn(out, df.agg(F.sum(col)).scalar())


def with_share(df: DataFrame, col: str, out: str, digits: int | None = None) -> DataFrame:
    """Percentage of the column total of a grouped result."""
    share = F.col(col) * F.lit(100.0) / F.col("_total")
    return with_total(df, col, "_total").withColumn(
        out, F.round(share, digits) if digits is not None else share
    ).drop("_total")


def main_groups(scores: DataFrame) -> DataFrame:
    """Address counts and score sums of non-zero EOAs, zero EOAs and contracts."""
    score = F.col("reputation_score")
    name = (
        F.when(_is_contract(), "Contracts").when(score != 0, "Non-zero EOAs").otherwise("Zero EOAs")
    )
    groups = latest(scores).groupBy(name.alias("groups")).agg(
        F.count(F.lit(1)).alias("num_of_addresses"), F.sum(score).alias("total_reputation_score")
    )
    out = with_share(groups, "num_of_addresses", "num_of_addresses_percentage", 2)
    share = scalars.div10(F.col("total_reputation_score") * 100, F.col("_all"))
    out = with_total(out, "total_reputation_score", "_all")
    return out.withColumn("total_reputation_score_percentage", F.round(share, 2)).drop("_all")


def eoa_distribution(scores: DataFrame) -> DataFrame:
    """Count and score share of positive EOAs per band."""
    rows = latest(scores).where(_is_eoa() & (F.col("reputation_score") > 0))
    bands = rows.groupBy(
        scalars.eoa_band(F.col("reputation_score_log_scale")).alias("partition")
    ).agg(F.count(F.lit(1)).alias("num_of_eoa"), F.sum("reputation_score").alias("_sum"))
    bands = with_share(bands, "num_of_eoa", "num_of_eoa_percentage", 4)
    bands = with_share(bands, "_sum", "reputation_value_percentage", 2)
    return bands.withColumn("reputation_value", F.round("_sum", 2)).drop("_sum")


# --- B11, B12, B17, B18 ------------------------------------------------------

def snapshot_between(blocks: DataFrame, first: str, last: str) -> Column:
    """Highest block number between two days, both included."""
    at = F.col("timestamp")
    inside = (at >= F.lit(first).cast("timestamp")) & (
        at < F.lit(last).cast("timestamp") + F.expr("interval 1 day")
    )
    return blocks.where(inside).agg(F.max("number")).scalar()


def contract_bands(scores: DataFrame, blocks: DataFrame, stat: str,
                   first: str = "2022-11-18", last: str = "2023-09-15") -> DataFrame:
    """Statistic of seven measures per contract band, of the snapshot ending the range."""
    rows = scores.where(
        (F.col("snapshot_block_number") == snapshot_between(blocks, first, last)) & _is_contract()
    )
    band = scalars.contract_band(F.col("reputation_score_log_scale")).alias("partition")
    out = rows.groupBy(band).agg(*_stats(stat))
    if stat == "mean":
        return out.select("partition", *[F.round(m, 3).alias(m) for m in MEASURES])
    return out


def eoa_bands(scores: DataFrame, stat: str) -> DataFrame:
    """Statistic of seven measures per EOA band; zero scores count as lowest."""
    band = scalars.eoa_band(F.col("reputation_score_log_scale")).alias("partition")
    return latest(scores).where(_is_eoa()).groupBy(band).agg(*_stats(stat))


# --- B10 ---------------------------------------------------------------------

def contract_categories(scores: DataFrame, labels: DataFrame, tx: DataFrame,
                        day: str = SINCE, limit: float = HIGHEST_SCORE) -> DataFrame:
    """Score totals, shares, callers and mean caller score per contract category."""
    category = scalars.or_unknown(F.col("category"), blank=True)
    owned = join_ci(
        latest(scores).where(_is_contract()).select("address", "reputation_score"),
        labels, "address", "address", "left", ["category"],
    ).withColumn("category", category)
    owned = one_per_key(owned, ["address"], [F.col("category").asc()])
    totals = owned.groupBy("category").agg(
        F.sum("reputation_score").alias("total_reputation_score"),
        F.count_distinct("address").cast("int").alias("num_of_addresses"),
    )
    totals = with_share(totals, "total_reputation_score", "total_reputation_score_percentage")
    totals = with_share(totals, "num_of_addresses", "num_of_addresses_percentage")
    # Distinct pairs first: joins and counts then see each caller and contract once.
    # Calls to addresses without label go before anything is shuffled by caller.
    known = labels.select(F.lower("address").alias("to_address")).distinct()
    calls = since(tx, day).select("from_address", F.lower("to_address").alias("to_address"))
    pairs = calls.join(small(known), "to_address", "left_semi").distinct()
    callers = (
        join_ci(pairs, labels, "to_address", "address", "inner", ["category"])
        .select("from_address", category.alias("category")).distinct()
        .join(_caller_scores(scores, F.col("reputation_score") < limit), "from_address")
    )
    active = callers.groupBy("category").agg(
        F.count(F.lit(1)).alias("uaws"), F.avg("RS").alias("avg_rs")
    )
    return active.join(totals, "category").withColumnRenamed("category", "contract_categories")


def _caller_scores(scores: DataFrame, cond: Column) -> DataFrame:
    """Newest score per EOA meeting `cond`, keyed as a transaction sender."""
    return latest(scores).where(_is_eoa() & cond).groupBy(
        F.col("address").alias("from_address")
    ).agg(F.max("reputation_score").alias("RS"))


# --- B13, B19 ----------------------------------------------------------------

PROFILE = ["reputation_score", "in_degree", "out_degree", "total_transfer", "total_receive",
           "total_volume", "total_gas_spent"]


def top_labelled(scores: DataFrame, labels: DataFrame, contract: bool, n: int = 10) -> DataFrame:
    """First `n` labelled addresses by rank."""
    kind = _is_contract() if contract else _is_eoa()
    named = latest(scores).where(kind).join(labels.select("address", "identity"), "address")
    order = [F.col("rank").asc(), F.col("address").asc(), F.col("identity").asc()]
    return named.orderBy(*order).limit(n)


def callers_of(targets: DataFrame, tx: DataFrame, scores: DataFrame, limit: float,
               first_block: int = FIRST_BLOCK) -> DataFrame:
    """Distinct (target, caller, score) in the block window of the newest snapshot."""
    window = F.col("block_number").between(F.lit(first_block), last_snapshot(scores))
    called = tx.where(window).join(
        targets.select(F.col("address").alias("to_address")).distinct(), "to_address", "left_semi"
    )
    pairs = called.select("to_address", "from_address").distinct()
    known = latest(scores).where(_is_eoa() & (F.col("reputation_score") <= limit)).select(
        F.col("address").alias("from_address"), F.col("reputation_score").alias("RS")
    )
    return pairs.join(known, "from_address").distinct()


def top10_with_uaw(scores: DataFrame, labels: DataFrame, tx: DataFrame, contract: bool,
                   limit: float) -> DataFrame:
    """Labelled leaders with their distinct EOA callers and mean caller score."""
    top = top_labelled(scores, labels, contract)
    active = callers_of(top, tx, scores, limit).groupBy(F.col("to_address").alias("address")).agg(
        F.count(F.lit(1)).alias("_n"), F.avg("RS").alias("average_rs")
    )
    # An address listed twice meets itself: counts double per extra label, as published.
    listed = top.groupBy("address").agg(F.count(F.lit(1)).alias("_times"))
    active = active.join(listed, "address").select(
        "address", (F.col("_n") * F.col("_times")).alias("uaw"), "average_rs"
    )
    return top.join(active, "address").select(
        "rank", "address", "identity", *PROFILE, "uaw", "average_rs"
    )


# --- B20-B24 -----------------------------------------------------------------

def top_in_band(scores: DataFrame, labels: DataFrame, low: float, high: float,
                exclude: list[str] | None = None, identity: bool = True, n: int = 10,
                low_open: bool = False) -> DataFrame:
    """First `n` positive EOAs by rank with a log score in [low, high)."""
    log = F.col("reputation_score_log_scale")
    rows = latest(scores).where(
        _is_eoa() & (F.col("reputation_score") > 0) & (log < high)
        & ((log > low) if low_open else (log >= low))
    )
    if exclude:
        rows = rows.where(~F.col("address").isin(exclude))
    # The label join can only multiply rows, so n addresses are enough to join.
    order = [F.col("rank").asc(), F.col("address").asc()]
    rows = rows.orderBy(*order).limit(n)
    named = rows.join(labels.select("address", "identity"), "address", "left")
    named = named.withColumn("identity", scalars.or_unknown(F.col("identity")))
    cols = ["rank", "address", *(["identity"] if identity else []), *PROFILE]
    return named.orderBy(*order, F.col("identity").asc()).limit(n).select(*cols)


# --- B27-B31 -----------------------------------------------------------------

def category_calls(tx: DataFrame, labels: DataFrame, category: str | None = None,
                   day: str = SINCE) -> DataFrame:
    """Transactions per (category, sender, day).

    Calls of targets outside the categories go first. Calls are counted per target before the
    labels are met, so a hub contract or sender is a handful of rows per day by then. A target labelled twice counts twice.
    """
    named = labels.where(F.col("category") == category) if category else labels.where(
        F.col("category").isin(CATEGORIES))
    known = small(named.select(F.col("address").alias("to_address")).distinct())
    calls = since(tx, day).join(known, "to_address", "left_semi").groupBy(
        "from_address", "to_address", F.to_date("block_timestamp").alias("transaction_date")
    ).agg(F.count(F.col("hash")).alias("_n"))
    targets = named.groupBy(F.col("address").alias("to_address"), "category").agg(
        F.count(F.lit(1)).alias("_labels"))
    return calls.join(targets, "to_address").groupBy(
        "category", "from_address", "transaction_date"
    ).agg(F.sum(F.col("_n") * F.col("_labels")).alias("transaction_count"))


def uaw_category_daily(tx: DataFrame, labels: DataFrame, scores: DataFrame,
                       category: str | None = None, literal: bool = True) -> DataFrame:
    """Daily wallets, transactions and mean scores of one category, or of all five.

    The literal form keeps only senders under the cap, which makes both averages
    equal. `literal=False` keeps every sender and leaves those above the cap out
    of the second average only.
    """
    capped = F.col("reputation_score_log_scale") < LOG_LIMIT
    known = latest(scores).where(_is_eoa())
    known = known.where(capped) if literal else known
    known = known.select(
        F.col("address").alias("from_address"), F.col("reputation_score").alias("_all"),
        F.when(capped, F.col("reputation_score")).alias("_capped"),
    )
    calls = category_calls(tx, labels, category).join(known, "from_address")
    daily = calls.groupBy("category", "transaction_date").agg(
        F.count(F.lit(1)).alias("uaw"), F.sum("transaction_count").alias("transactions"),
        F.avg("_all").alias("average_rs"), F.avg("_capped").alias("average_rs_excluded_highest"),
    )
    return daily.drop("category") if category else daily
