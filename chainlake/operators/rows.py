"""Row-level operators: filters, projections, converters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.functions import scalars

# Addresses nobody owns.
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"
DEAD_ADDRESS = "0x000000000000000000000000000000000000dead"
BURN = [ZERO_ADDRESS, DEAD_ADDRESS]


def prune(df: DataFrame, *cols: str) -> DataFrame:
    """Leave wide columns out; on Parquet they are then never read."""
    return df.drop(*cols)


def filter_items(df: DataFrame, expr: str) -> DataFrame:
    return df.where(F.expr(expr))


def extract_field(df: DataFrame, field: str) -> DataFrame:
    return df.select(field)


def distinct_field(df: DataFrame, field: str) -> DataFrame:
    return df.select(field).distinct()


def distinct_of(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def exclude_burn(df: DataFrame, sides=("from_address", "to_address")) -> DataFrame:
    """Drop rows with a burn (or NULL) address on any of the sides."""
    for side in sides:
        df = df.where(F.col(side).isNotNull() & ~F.lower(side).isin(BURN))
    return df


def drop_self_loops(df: DataFrame) -> DataFrame:
    return df.where(F.col("from_address") != F.col("to_address"))


def drop_null_endpoints(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["from_address", "to_address"])


def exclude_addresses(df: DataFrame, addresses: Iterable[str], col: str = "address") -> DataFrame:
    return df.where(~F.col(col).isin(list(addresses)))


def known_identity(labels: DataFrame) -> DataFrame:
    return labels.where(~F.col("identity").like("Unknow%"))


def keyword_filter(df: DataFrame, col: str, keyword: str) -> DataFrame:
    return df.where(F.col(col).ilike(f"%{keyword}%"))


def in_list(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def union_aligned(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column one side lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def list_to_columns(df: DataFrame, field: str, prefix: str, fill: int = 4) -> DataFrame:
    """Array to `prefix0 … prefixN`; missing elements are NULL."""
    rest = [c for c in df.columns if c != field]
    return df.select(
        *rest, *[F.get(F.col(field), F.lit(i)).alias(f"{prefix}{i}") for i in range(fill)]
    )


INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _decimal_to_int(field, col: Column) -> Column:
    return col.cast("bigint") if isinstance(field.dataType, T.DecimalType) else col


def _int_to_decimal(field, col: Column) -> Column:
    return col.cast("decimal(38,0)") if isinstance(field.dataType, INTEGRAL) else col


def _epoch_to_text(field, col: Column) -> Column:
    timed = field.name.endswith("timestamp") and isinstance(field.dataType, INTEGRAL)
    return scalars.epoch_text(col) if timed else col


def int_to_text(*names: str):
    """Rule: integers to text, limited to `names` when any are given."""

    def rule(field, col: Column) -> Column:
        chosen = not names or field.name in names
        return col.cast("string") if chosen and isinstance(field.dataType, INTEGRAL) else col

    return rule


DECIMAL_TO_INT, INT_TO_DECIMAL, EPOCH_TO_TEXT = _decimal_to_int, _int_to_decimal, _epoch_to_text


def convert(df: DataFrame, rules: list) -> DataFrame:
    """Apply converter rules left to right, each over all columns, by type and name."""
    for rule in rules:
        df = df.select(*[rule(f, F.col(f.name)).alias(f.name) for f in df.schema.fields])
    return df


# What has to be computed before an entity can be derived.
NEEDS = {
    "token": ["contract"],
    "contract": ["trace"],
    "trace": [],
    "token_transfer": ["log", "receipt"],
    "log": ["transaction"],
    "transaction": [],
    "receipt": [],
    "block": [],
}


def entity_closure(wanted: Iterable[str]) -> set[str]:
    """Entities to compute for the wanted ones.

    Blocks always belong to them, and transactions asked for by name bring
    their receipts.
    """
    wanted = list(wanted)
    todo, found = ["block", *wanted], set()
    if "transaction" in wanted:
        todo.append("receipt")
    while todo:
        name = todo.pop()
        if name not in NEEDS:
            raise ValueError(f"unknown entity type {name!r}")
        if name not in found:
            found.add(name)
            todo += NEEDS[name]
    return found
