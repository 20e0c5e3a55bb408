"""Column expressions: units, bands, bins, ids, text and age weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NATIVE_DECIMALS = 18


# --- amounts -----------------------------------------------------------------

def to_units(value: Column, decimals: Column | int = NATIVE_DECIMALS) -> Column:
    """Raw integer amount to token units; NULL decimals give NULL."""
    power = F.lit(decimals) if isinstance(decimals, int) else decimals
    return value.cast("double") / F.pow(F.lit(10.0), power.cast("double"))


def gas_cost(used: Column, price: Column) -> Column:
    """Fee in native units; NULL where the exact product leaves 38 digits."""
    product = F.try_multiply(used.cast("decimal(38,0)"), price.cast("decimal(38,0)"))
    return to_units(product)


def div10(x: Column, y: Column) -> Column:
    """Division kept to ten fractional digits (cut, not rounded)."""
    ratio = F.try_divide(x.cast("double"), y.cast("double"))
    return F.floor(ratio * F.lit(10.0**10)) / F.lit(10.0**10)


def fixed_text(col: Column, digits: int = 10) -> Column:
    """Plain text with a fixed number of fractional digits, no separators."""
    return F.regexp_replace(F.format_number(col, digits), ",", "")


# --- bands and bins ----------------------------------------------------------

# Band names and lower bounds (exclusive) on the log scale.
CONTRACT_BANDS = [(680, "5. Excellent"), (300, "4. High"), (100, "3. Medium"), (0, "2. Low")]
CONTRACT_REST = "1. Zero-GRS"
EOA_BANDS = [(500, "6. Highest"), (300, "5. High"), (150, "4. Experience"),
             (50, "3. Medium"), (25, "2. Low")]
EOA_REST = "1. Lowest"


def _banded(col: Column, bands, rest: str) -> Column:
    out = None
    for bound, name in bands:
        out = F.when(col > bound, name) if out is None else out.when(col > bound, name)
    return out.otherwise(rest)


def contract_band(col: Column) -> Column:
    return _banded(col, CONTRACT_BANDS, CONTRACT_REST)


def eoa_band(col: Column) -> Column:
    return _banded(col, EOA_BANDS, EOA_REST)


def bin_floor(col: Column, width: int) -> Column:
    return (F.floor(col / F.lit(width)) * width).cast("int")


def bin_band(edge: Column) -> Column:
    """Band of a bin edge. Edge 25 itself falls to the last branch, as published."""
    return (
        F.when(edge < 25, "1. Lowest")
        .when((edge > 25) & (edge < 50), "2. Low")
        .when((edge >= 50) & (edge < 150), "3. Medium")
        .when((edge >= 150) & (edge < 300), "4. Experience")
        .when((edge >= 300) & (edge < 500), "5. High")
        .otherwise("6. Highest")
    )


# --- text --------------------------------------------------------------------

def or_unknown(col: Column, blank: bool = False) -> Column:
    """NULL (and, if asked, blank text) to 'Unknown'."""
    return F.coalesce(F.nullif(col, F.lit("")) if blank else col, F.lit("Unknown"))


def clean_text(col: Column) -> Column:
    """Text without NUL characters."""
    return F.translate(col, "\u0000", "")


def bytes_text(col: Column) -> Column:
    """Binary to UTF-8 text, NULL where the bytes are not valid UTF-8."""
    return clean_text(F.try_validate_utf8(col.cast("string")))


def doc_field(json: Column, path: str, default: str = "") -> Column:
    return F.coalesce(F.get_json_object(json, path), F.lit(default))


# --- time --------------------------------------------------------------------

def day(ts: Column) -> Column:
    return F.to_date(ts)


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_text(col: Column) -> Column:
    return F.date_format(F.timestamp_seconds(col), "yyyy-MM-dd HH:mm:ss")


def iso_text(col: Column) -> Column:
    """ISO-8601 instant (or epoch milliseconds as text) to `yyyy-MM-dd HH:mm:ss`."""
    instant = F.coalesce(
        F.try_to_timestamp(col),
        F.timestamp_millis(col.try_cast("bigint")),
    )
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss")


# --- ids ---------------------------------------------------------------------

# The parts of each item id, after the entity name.
ID_PARTS = {
    "block": ["hash"],
    "transaction": ["hash"],
    "log": ["transaction_hash", "log_index"],
    "token_transfer": ["transaction_hash", "log_index"],
    "trace": ["trace_id"],
    "contract": ["block_number", "address"],
    "token": ["block_number", "address"],
}


def item_id(entity: str) -> Column:
    """`entity_part[_part]`, NULL where a part is missing."""
    # concat, unlike concat_ws, is NULL as soon as one part is.
    pieces = [F.lit(entity)]
    for part in ID_PARTS[entity]:
        pieces += [F.lit("_"), F.col(part).cast("string")]
    return F.concat(*pieces)


def item_timestamp(entity: str) -> Column:
    return rfc3339(F.col("timestamp" if entity == "block" else "block_timestamp"))


def trace_id(index: Column | None = None) -> Column:
    """Id of a transaction-scoped trace, or of a block-scoped one given its index."""
    path = F.array_join(F.col("trace_address").cast("array<string>"), "_")
    scoped = F.concat(
        F.col("trace_type"), F.lit("_"), F.col("transaction_hash"), F.lit("_"),
        F.coalesce(path, F.lit("")),
    )
    if index is None:
        return scoped
    numbered = F.concat_ws(
        "_", F.col("trace_type"), F.col("block_number").cast("string"), index.cast("string")
    )
    return F.when(in_transaction(), scoped).otherwise(numbered)


def in_transaction() -> Column:
    return F.coalesce(F.length("transaction_hash") > 0, F.lit(False))


def pad_block(col: Column, width: int = 10) -> Column:
    """Zero-padded block number; a longer number stays whole."""
    text = col.cast("bigint").cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


# --- age ---------------------------------------------------------------------

# Blocks per day and the activation offset.
BLOCKS_PER_DAY = 28800
ACTIVATION = 90


def block_age(number: Column, first: Column, mode: str = "blocks") -> Column:
    """Age in whole days, cut towards zero. The offset is 90 blocks or 90 days."""
    gap = (number - first).cast("double")
    if mode == "blocks":
        days = (gap - ACTIVATION) / BLOCKS_PER_DAY
    elif mode == "days":
        days = gap / BLOCKS_PER_DAY - ACTIVATION
    else:
        raise ValueError(f"mode must be 'blocks' or 'days', not {mode!r}")
    return days.cast("int")


def age_weight(days: Column, a: float = 1.0, b: float = 1 / 64) -> Column:
    return F.lit(a) / (F.lit(1.0) + F.exp(F.lit(-b) * days))
