"""Enrichment and lookup joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.functions import scalars

# Receipt columns carried onto a transaction.
RECEIPT_FIELDS = ["cumulative_gas_used", "gas_used", "contract_address", "root", "status",
                  "effective_gas_price"]


def join_project(
    left: DataFrame, right: DataFrame, on: tuple[str, str],
    left_cols: list, right_cols: list, how: str = "inner",
) -> DataFrame:
    """Keyed join with a projection per side; a column is a name or (name, new name)."""

    def picked(side: str, cols: list) -> list[Column]:
        pairs = [c if isinstance(c, tuple) else (c, c) for c in cols]
        return [F.col(f"{side}.{old}").alias(new) for old, new in pairs]

    same = F.col(f"l.{on[0]}") == F.col(f"r.{on[1]}")
    return (
        left.alias("l").join(right.alias("r"), same, how)
        .select(*picked("l", left_cols), *picked("r", right_cols))
    )


def _receipted(tx: DataFrame, receipts: DataFrame, how: str) -> DataFrame:
    fields = [(name, f"receipt_{name}") for name in RECEIPT_FIELDS]
    own = [c for c in tx.columns if not c.startswith("receipt_")]
    return join_project(tx, receipts, ("hash", "transaction_hash"), own, fields, how)


def _or_error(found: Column, value: Column, what: str, key: Column) -> Column:
    """`value` where the partner was found; else an error that names the key, never a lost row."""
    missing = F.raise_error(F.concat(F.lit(f"{what} "), F.coalesce(key.cast("string"), F.lit("NULL"))))
    return F.when(found, value).otherwise(missing)


def enrich_transactions(tx: DataFrame, receipts: DataFrame) -> DataFrame:
    """Add the receipt's fields; a transaction without receipt is an error when the row is read."""
    tagged = receipts.withColumn("contract_address", F.struct("contract_address"))
    met = left_receipts(tx, tagged)
    # A receipt always gives the struct, whatever it holds.
    held = F.col("receipt_contract_address")
    value = lambda c: held["contract_address"] if c == "receipt_contract_address" else F.col(c)
    return met.withColumns({c: _or_error(held.isNotNull(), value(c), "no receipt of", F.col("hash"))
                            for c in met.columns if c.startswith("receipt_")})


def left_receipts(tx: DataFrame, receipts: DataFrame) -> DataFrame:
    return _receipted(tx, receipts, "left")


def with_block(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add time and hash of the block to items carrying its number (logs, transfers, traces, contracts, tokens).

    An item whose block is not there is an error when the row is read. Both added columns carry the
    check, so a plan that needs only one of them has it too.
    """
    own = [c for c in items.columns if c not in ("block_timestamp", "block_hash")]
    known = blocks.select(F.col("number").alias("_number"), "timestamp", "hash")
    met = items.alias("i").join(known.alias("b"), F.col("i.block_number") == F.col("b._number"), "left")
    checked = lambda c: _or_error(
        F.col("b._number").isNotNull(), F.col(f"b.{c}"), "no block with number", F.col("i.block_number"))
    return met.select(*[F.col(f"i.{c}") for c in own], checked("timestamp").alias("block_timestamp"),
                      checked("hash").alias("block_hash"))


def join_ci(left: DataFrame, right: DataFrame, lcol: str, rcol: str, how: str = "inner",
            right_cols: list | None = None) -> DataFrame:
    """Case-insensitive equi join: both keys are folded once, so it stays a hash join."""
    cols = right_cols if right_cols is not None else [c for c in right.columns if c != rcol]
    keyed = right.select(F.lower(rcol).alias("_ci"), *cols)
    return left.withColumn("_ci", F.lower(lcol)).join(keyed, "_ci", how).drop("_ci")


def senders_not_contracts(pairs: DataFrame, contracts: DataFrame) -> DataFrame:
    known = contracts.select(F.col("address").alias("from_address"))
    return pairs.join(known, "from_address", "left_anti")


def tokens_without_metadata(transfers: DataFrame, tokens: DataFrame) -> DataFrame:
    """Distinct transfer tokens the metadata table does not know, ignoring case."""
    seen = transfers.select("token_address").distinct()
    known = tokens.where(F.col("address").isNotNull()).select(F.lower("address").alias("_ci"))
    return seen.join(known, F.lower("token_address") == F.col("_ci"), "left_anti")


def calls_to(tx: DataFrame, targets: DataFrame, col: str = "address") -> DataFrame:
    return tx.join(
        targets.select(F.col(col).alias("to_address")), "to_address", "left_semi"
    )


def with_identity(df: DataFrame, labels: DataFrame, how: str = "left") -> DataFrame:
    return df.join(labels.select("address", "identity"), "address", how)


def labelled_scores(top: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the labels of their address (inner)."""
    cols = ["address", "project_id", "project_name", "category", "identity"]
    return top.join(labels.select(*cols), "address")


def with_weights(vertices: DataFrame, weights: DataFrame) -> DataFrame:
    return vertices.join(weights, "id", "left").fillna(0.0, ["weight"])


def combine_metrics(base: DataFrame, *metrics: DataFrame) -> DataFrame:
    """Left joins on `address`; all share one key, so `base` is shuffled once."""
    for metric in metrics:
        base = base.join(metric, "address", "left")
    return base


def compare_scores(a: DataFrame, b: DataFrame) -> DataFrame:
    """Addresses present in both rankings with both positions."""
    left = a.select("address", F.col("rank").alias("rank_a"), F.col("score").alias("score_a"))
    right = b.select("address", F.col("rank").alias("rank_b"), F.col("score").alias("score_b"))
    return left.join(right, "address")


def rank_history(labels: DataFrame, scores: DataFrame, max_rank: int) -> DataFrame:
    """Rank of known labelled addresses in every snapshot, better than `max_rank`."""
    named = labels.where(~F.col("identity").like("Unknow%")).select("address", "identity")
    ranked = scores.where((F.col("rank") > 0) & (F.col("rank") < max_rank))
    return named.join(ranked, "address").select(
        "address", "identity", F.col("rank").alias("grank"),
        F.col("snapshot_block_timestamp").alias("time"),
    )


def flag_contracts(addresses: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add `contract`: whether the address is a known contract."""
    known = contracts.select("address").distinct().withColumn("_known", F.lit(True))
    return (
        addresses.join(known, "address", "left")
        .withColumn("contract", F.coalesce("_known", F.lit(False)))
        .drop("_known")
    )


def price_escrows(escrows: DataFrame, prices: DataFrame, fold_case: bool = False) -> DataFrame:
    """Escrow rows with decimals (folded key, default 18) and price (default 0).

    The published form looks the price up by the address as written, so a
    checksum-cased address gets 0; `fold_case=True` uses the folded key for both.
    """
    known = prices.select(
        F.col("address").alias("_known"), F.col("decimals").alias("_decimals"),
        F.col("price").alias("_price"),
    )
    key = F.lower("token_address")
    out = escrows.join(known, key == F.col("_known"), "left")
    same = F.lit(True) if fold_case else (F.col("token_address") == F.col("_known"))
    price = F.when(same, F.col("_price"))
    return out.select(
        *escrows.columns,
        F.coalesce("_decimals", F.lit(scalars.NATIVE_DECIMALS)).cast("bigint").alias("decimals"),
        F.coalesce(price, F.lit(0.0)).alias("price"),
    )
