"""Priced transactions and transfers, token prices, escrow values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.functions import scalars
from chainlake.operators import derive
from chainlake.operators.joins import left_receipts, price_escrows
from chainlake.operators.latest import one_price_id
from chainlake.operators.rows import union_aligned

DAY = 86400
DAY_LISTS = 2_500_000  # lists of quotes by day that go to every task: a quarter of a GB


def basis_price(basis: str) -> Column:
    """Price of a quote: its open, its close, or the mean of both."""
    if basis == "mean":
        return (F.col("open") + F.col("close")) / 2
    if basis not in ("open", "close"):
        raise ValueError(f"unknown price basis {basis!r}")
    return F.col(basis)


def _seconds(ts: str) -> Column:
    return F.col(ts).cast("double")


def _meet(df: DataFrame, side: DataFrame, on: dict[str, Column], rows: int = 200_000, spread: int = 4) -> DataFrame:
    """Left join of `df` on `side`, by the columns of `side` that `on` names and their values in `df`.

    `side` goes to every task, and `df` does not move, if it is counted to have at most `rows` rows. Beyond
    that its rows are repeated `spread` times and the rows of a key are dealt over as many places, so
    what everybody moves, or what has no key, is not one task's work; AQE splits such a place further.
    """
    keys = dict(on)
    if side.limit(rows + 1).count() <= rows:
        side = F.broadcast(side)
    else:
        side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        dealt = [name for name, kind in df.dtypes if "map<" not in kind]
        keys["_salt"] = F.pmod(F.xxhash64(*dealt), F.lit(spread)).cast("int")
    return df.join(side, [value == F.col(name) for name, value in keys.items()], "left").drop(*keys)


def _by_day(df: DataFrame, quotes: DataFrame, on: dict[str, Column], out: str, keep, **size) -> DataFrame:
    """Left join of `df` on quotes, which become one row per key of `on` with its quotes in a list.

    `quotes` has the columns of `on`, `_end` and `out`. `keep` says which quotes of the list hold for a row.
    As in any left join, a row with no quote stays once, with null.
    """
    lists = quotes.groupBy(*on).agg(F.collect_list(F.struct("_end", out)).alias("_quotes"))
    # A list by day alone is some 100 bytes, and the rows that meet it are all transactions, or all transfers.
    size.setdefault("rows", DAY_LISTS if len(on) == 1 else 200_000)
    met = _meet(df, lists, on, **size)
    fits = F.filter("_quotes", keep)
    return met.withColumn("_quote", F.explode_outer(fits)).withColumn(out, F.col("_quote")[out]) \
        .drop("_quotes", "_quote")


def with_interval_price(
    df: DataFrame, prices: DataFrame, id_col: str | int, ts: str = "block_timestamp",
    basis: str = "open", out: str = "price", **size,
) -> DataFrame:
    """Left join on the quote whose day-long interval strictly contains `ts`.

    A quote at time p covers (p - 1 day, p), hence at most two calendar days, and
    one if p is midnight. It is listed under each of them, so rows meet the list of an id and day and the
    two strict bounds only filter it. Rows on a bound match nothing, and two
    quotes less than a day apart both match. `size` goes to `_meet`.
    """
    quotes = prices
    if isinstance(id_col, int):
        quotes = quotes.where(F.col("id") == id_col)
    end = F.col("timestamp")
    quotes = quotes.select(
        F.col("id").alias("_id"), end.alias("_end"), basis_price(basis).alias(out),
        F.explode(F.array_distinct(F.array(
            F.floor((end - DAY) / DAY).cast("bigint"), (F.ceil(end / DAY) - 1).cast("bigint")
        ))).alias("_day"),
    )
    seconds = _seconds(ts)
    day = F.floor(seconds / DAY).cast("bigint")
    on = {"_day": day} if isinstance(id_col, int) else {"_id": F.col(id_col), "_day": day}
    return _by_day(df, quotes, on, out, lambda q: (seconds < q["_end"]) & (seconds > q["_end"] - DAY), **size)


def with_daily_price(
    df: DataFrame, prices: DataFrame, id_col: str | int, ts: str = "block_timestamp",
    basis: str = "mean", out: str = "price",
) -> DataFrame:
    """Left join on the quotes of the same calendar day."""
    quotes = prices
    if isinstance(id_col, int):
        quotes = quotes.where(F.col("id") == id_col)
    quotes = quotes.select(
        F.col("id").alias("_id"), F.to_date(F.timestamp_seconds("timestamp")).alias("_day"),
        basis_price(basis).alias(out),
    )
    on = {"_day": F.to_date(ts)} if isinstance(id_col, int) else {"_id": F.col(id_col), "_day": F.to_date(ts)}
    return _by_day(df, quotes.withColumn("_end", F.lit(0)), on, out, lambda q: F.lit(True))


def with_transaction(transfers: DataFrame, tx: DataFrame) -> DataFrame:
    """Left join of transfers on the gas columns and time of their transaction."""
    context = tx.select(
        F.col("hash").alias("transaction_hash"), "gas", "receipt_gas_used", "gas_price",
        F.col("block_timestamp").alias("tx_timestamp"),
    )
    return transfers.join(context, "transaction_hash", "left")


def token_facts(tokens: DataFrame, ids: DataFrame, chain: str) -> DataFrame:
    """_token, decimals, _ids: what is known of a token, by its address without case.

    Price ids go by the address as written, so the ids of all spellings are listed with theirs.
    """
    scale = tokens.select(F.lower("address").alias("_token"), "decimals")
    named = one_price_id(ids, chain).groupBy(F.lower("address").alias("_token")) \
        .agg(F.collect_list(F.struct("address", "id")).alias("_ids"))
    return scale.join(named, "_token", "full")


def with_token_facts(df: DataFrame, facts: DataFrame, **size) -> DataFrame:
    """Left join on `token_facts`: adds decimals (ignoring case) and price_id (of the address as written)."""
    met = _meet(df, facts, {"_token": F.lower("token_address")}, **size)
    same = F.filter("_ids", lambda x: x["address"] == F.col("token_address"))
    return met.withColumn("price_id", F.get(same, F.lit(0))["id"]).drop("_ids")


def with_price_id(df: DataFrame, ids: DataFrame, chain: str) -> DataFrame:
    known = one_price_id(ids, chain).select(
        F.col("address").alias("token_address"), F.col("id").alias("price_id")
    )
    return df.join(known, "token_address", "left")


# Columns of the priced table.
PRE_TX = ["block_number", "from_address", "to_address", "gas", "gas_used", "gas_price", "value",
          "token_transfer", "token_contract", "volume", "gas_spent", "gas_spent_usd"]


def _native_leg(tx: DataFrame, prices: DataFrame, native_id: int) -> DataFrame:
    priced = with_interval_price(tx, prices, native_id)
    fee = scalars.gas_cost(F.col("receipt_gas_used"), F.col("gas_price"))
    return priced.select(
        "block_number", "from_address", "to_address", "gas",
        F.col("receipt_gas_used").alias("gas_used"), "gas_price", "value",
        F.lit(None).cast("string").alias("token_transfer"),
        F.lit(None).cast("string").alias("token_contract"),
        (scalars.to_units(F.col("value")) * F.col("price")).alias("volume"),
        fee.alias("gas_spent"), (fee * F.col("price")).alias("gas_spent_usd"),
    )


def _token_leg(tx, transfers, tokens, ids, prices, chain, native_id) -> DataFrame:
    moved = transfers.select(
        "block_number", "from_address", "to_address", "token_address", "value", "transaction_hash"
    )
    moved = with_token_facts(with_transaction(moved, tx), token_facts(tokens, ids, chain))
    moved = with_interval_price(moved, prices, "price_id", "tx_timestamp")
    moved = with_interval_price(moved, prices, native_id, "tx_timestamp", out="native_price")
    fee = scalars.gas_cost(F.col("receipt_gas_used"), F.col("gas_price"))
    units = scalars.to_units(F.col("value"), F.col("decimals"))
    return moved.select(
        "block_number", "from_address", "to_address", "gas",
        F.col("receipt_gas_used").alias("gas_used"), "gas_price",
        F.lit(None).cast("decimal(38,0)").alias("value"),
        F.col("value").alias("token_transfer"), F.col("token_address").alias("token_contract"),
        (units * F.col("price")).alias("volume"),
        fee.alias("gas_spent"), (fee * F.col("native_price")).alias("gas_spent_usd"),
    )


def pre_tx(
    tx: DataFrame, transfers: DataFrame, tokens: DataFrame, ids: DataFrame, prices: DataFrame,
    chain: str, native_id: int,
) -> DataFrame:
    """Native and token movements with USD volume and fee, twelve typed columns."""
    return union_aligned(
        _native_leg(tx, prices, native_id),
        _token_leg(tx, transfers, tokens, ids, prices, chain, native_id),
    )


def pre_tx_split(tx, receipts, transfers, tokens, ids, prices, chain, native_id) -> DataFrame:
    """The same with receipts in a table of their own."""
    bare = tx.select(
        "hash", "block_number", "from_address", "to_address", "value", "gas", "gas_price",
        "block_timestamp",
    )
    return pre_tx(left_receipts(bare, receipts), transfers, tokens, ids, prices, chain, native_id)


def pre_tx_text(priced: DataFrame, digits: int = 10) -> DataFrame:
    """Export form: the three amounts as fixed-point text."""
    for name in ("volume", "gas_spent", "gas_spent_usd"):
        priced = priced.withColumn(name, scalars.fixed_text(F.col(name), digits))
    return priced


def pre_tx_daily(
    tx: DataFrame, logs: DataFrame, tokens: DataFrame, ids: DataFrame, prices: DataFrame,
    chain: str, native_id: int, first_day: str, last_day: str,
) -> DataFrame:
    """Priced by the day's mean; transfers decoded from logs, fees on native rows only."""
    inside = F.to_date("block_timestamp").between(F.lit(first_day).cast("date"),
                                                  F.lit(last_day).cast("date"))
    fee = scalars.gas_cost(F.col("receipt_gas_used"), F.col("gas_price"))
    native = with_daily_price(tx.where(inside), prices, native_id).select(
        F.col("hash").alias("tx_hash"), "block_number", "from_address", "to_address", "gas",
        F.col("receipt_gas_used").alias("gas_used"), "gas_price", "value",
        (scalars.to_units(F.col("value")) * F.col("price")).alias("volume"),
        fee.alias("gas_spent"), (fee * F.col("price")).alias("gas_spent_usd"),
    )
    # One id per address keeps the row count; the raw map may list an address twice.
    moved = with_token_facts(derive.transfers_strict(logs.where(inside)), token_facts(tokens, ids, chain))
    units = scalars.to_units(F.col("token_transfer"), F.col("decimals"))
    token = with_daily_price(moved, prices, "price_id").select(
        F.col("transaction_hash").alias("tx_hash"), "block_number", "from_address", "to_address",
        "token_transfer", "token_address", (units * F.col("price")).alias("volume"),
    )
    return union_aligned(native, token)


# --- price lookups -----------------------------------------------------------

def _quotes_on(prices: DataFrame, day: str, price_id: int | None = None) -> DataFrame:
    """Quotes of one day; the bounds are literals on the epoch column, so scans can skip."""
    start = F.unix_timestamp(F.lit(day).cast("timestamp"))
    found = prices.where((F.col("timestamp") >= start) & (F.col("timestamp") < start + DAY))
    return found if price_id is None else found.where(F.col("id") == price_id)


def token_prices(
    prices: DataFrame, ids: DataFrame, tokens: DataFrame, addresses: DataFrame, day: str,
    chain: str = "eth",
) -> DataFrame:
    """Close price and decimals of the given token addresses on a day."""
    wanted = addresses.select(F.col("token_address").alias("address")).distinct()
    mapped = ids.select("id", F.col(chain).alias("address")).join(wanted, "address", "left_semi")
    return (
        _quotes_on(prices, day).join(mapped, "id")
        .join(tokens.select("address", "decimals"), "address")
        .select("id", "timestamp", F.col("close").alias("price"), "address", "decimals")
    )


def native_price(prices: DataFrame, price_id: int, day: str) -> DataFrame:
    """The native quote of a day, one row."""
    return (
        _quotes_on(prices, day, price_id)
        .select("id", "timestamp", F.col("close").alias("price"),
                F.lit("NATIVE_TOKEN").alias("address"), F.lit(18).alias("decimals"))
        .orderBy("timestamp").limit(1)
    )


def split_escrows(escrows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token rows, native rows) of the escrow dimension."""
    native = F.col("token_address") == "NATIVE_TOKEN"
    return escrows.where(~native), escrows.where(native)


def escrow_values(
    escrows: DataFrame, balances: DataFrame, prices: DataFrame, native: DataFrame,
    fold_case: bool = False,
) -> DataFrame:
    """Balance in units and price of every escrow row on the day of `native`.

    A token row without a balance keeps its place with balance 0 and price 0.
    """
    tokens, natives = split_escrows(escrows)
    held = balances.select("address", "token_address", "balance")
    rate = native.select("price").scalar()
    when = native.select("timestamp").scalar()
    priced = price_escrows(tokens, prices, fold_case).join(held, ["address", "token_address"], "left")
    units = scalars.to_units(F.col("balance"), F.col("decimals"))
    token_rows = priced.select(
        "project_id", "address", "token_address", F.coalesce(units, F.lit(0.0)).alias("balance"),
        F.when(F.col("balance").isNull(), 0.0).otherwise(F.col("price")).alias("price"),
    )
    native_rows = natives.join(held, ["address", "token_address"]).select(
        "project_id", "address", "token_address",
        scalars.to_units(F.col("balance")).alias("balance"),
        F.coalesce(rate, F.lit(0.0)).alias("price"),
    )
    return token_rows.unionByName(native_rows).withColumn("date", when)
