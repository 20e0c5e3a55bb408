"""Checks on row counts and rule-based quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chainlake.plans.serving import CHAINS
from chainlake.schemas import ENTITIES


def assert_same_count(before: DataFrame, after: DataFrame, what: str = "rows") -> None:
    """Raise when an enrichment lost or multiplied rows."""
    old, new = before.count(), after.count()
    if old != new:
        raise ValueError(f"the number of {what} is wrong: {old} before, {new} after")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Frame that counts its rows while some other action runs over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def assert_observed(before: Observation, after: Observation, what: str = "rows") -> None:
    """Compare two counts taken along the way; costs no job of its own."""
    old, new = before.get["rows"], after.get["rows"]
    if old != new:
        raise ValueError(f"the number of {what} is wrong: {old} before, {new} after")




def default_rules() -> dict[str, tuple[list[str], Column]]:
    hash_form, address_form = "^0x[0-9a-fA-F]{64}$", "^0x[0-9a-fA-F]{40}$"
    return {
        "unknown chain": (["chain_key"], ~F.col("chain_key").isin(list(CHAINS))),
        "unknown entity type": (["type"], ~F.col("type").isin(list(ENTITIES))),
        "reversed range": (["start_block", "end_block"],
                           F.col("start_block").cast("bigint") > F.col("end_block").cast("bigint")),
        "negative block": (["block_number"], F.col("block_number") < 0),
        "bad hash": (["hash"], ~F.col("hash").rlike(hash_form)),
        "bad sender": (["from_address"], ~F.col("from_address").rlike(address_form)),
        "bad receiver": (["to_address"], ~F.col("to_address").rlike(address_form)),
    }


def invalid_rows(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Rows breaking a rule, with the names of all rules they break."""
    rules = rules or default_rules()
    usable = {n: c for n, (cols, c) in rules.items() if set(cols) <= set(df.columns)}
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in usable.items()]))
    return df.withColumn("problems", broken).where(F.size("problems") > 0)
