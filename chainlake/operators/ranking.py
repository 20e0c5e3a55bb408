"""Numbering, ranking, top-k and paging without a single-task sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake import schemas
from chainlake.session import discard, settle

_LOCAL = (1 << 33) - 1  # low bits of monotonically_increasing_id: row within partition
BLOCK_ROWS = 1_000_000  # rows of a block that one task sorts


def add_rank(
    df: DataFrame,
    order: list[Column],
    within: list[str] | None = None,
    name: str = "rank",
    group_rows: int = 0,
) -> DataFrame:
    """1-based position in `order`, over the whole set or within groups.

    Rows are spread over many tasks (`_spread_rank`), so a group may have any size. Where there are many groups,
    `group_rows` lets those of at most that many rows meet whole in one shuffle, which moves and stores much less;
    groups are counted first, and bigger ones are spread. `order` has to end in a unique column.
    """
    if not within or not group_rows:
        return _spread_rank(df, order, list(within or []), name)
    big = settle(df.groupBy(*within).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > group_rows).select(*within))
    none_big = big.isEmpty()
    placed = F.row_number().over(W.partitionBy(*within).orderBy(*order)).cast("bigint")
    if none_big:
        discard(big)
        return df.withColumn(name, placed)
    # Few by their size: all rows divided by `group_rows` at most.
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in within])
    part = lambda how: df.alias("l").join(F.broadcast(big).alias("r"), same, how)
    return part("left_anti").withColumn(name, placed).unionByName(_spread_rank(part("left_semi"), order, within, name))


def _spread_rank(df: DataFrame, order: list[Column], within: list[str], name: str) -> DataFrame:
    """Position by sorted ranges: rows are range-partitioned on (group, order) and numbered locally.

    Each partition then needs only the size of those before it, and a group its first position.
    """
    sort = [*[F.col(c) for c in within], *order]
    placed = settle(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33).alias("_part")
    # One row per partition, so this window stays small whatever the data.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    )
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_skip") + F.col("_at").bitwiseAND(_LOCAL) + 1)
        .drop("_part", "_skip", "_at")
    )
    if not within:
        return numbered
    starts = numbered.groupBy(*within).agg(F.min(name).alias("_start"))
    same = reduce(
        lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in within]
    )
    kept = [F.col(f"l.{c}") for c in df.columns]
    return (
        numbered.alias("l")
        .join(starts.alias("r"), same)
        .select(*kept, (F.col(f"l.{name}") - F.col("_start") + 1).alias(name))
    )


def last_transaction(edges: DataFrame) -> DataFrame:
    """Newest transaction of each ordered address pair."""
    from chainlake.operators.latest import one_per_key

    order = [F.col("block_number").desc(), F.col("transaction_index").desc(), F.col("hash").desc()]
    return one_per_key(edges, ["from_address", "to_address"], order)


def ordered(df: DataFrame, entity: str) -> DataFrame:
    """Output order of an entity inside each written file."""
    return df.sortWithinPartitions(*schemas.ORDER[entity])


def sorted_by(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.col(col).desc())


def capped(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


# The fields the sorting table covers.
SORT_FIELDS = ["reputation_score", "total_txn", "total_volume", "total_gas_spent",
               "is_contract", "degree"]
SORT_COLUMNS = ["address", "rank", "date", *SORT_FIELDS]


def sorting_table(top: DataFrame, n: int = 100) -> DataFrame:
    """Distinct union of the first and last `n` rows by each sort field.

    One scan: each row competes in all twelve orders, and a group limit keeps `n`
    rows per order and task ahead of the shuffle.
    """
    top = top.select(*SORT_COLUMNS)
    entries = []
    for field in SORT_FIELDS:
        value = F.col(field).cast("double")
        entries.append(F.struct(F.lit(f"{field} up").alias("_end"), value.alias("_key")))
        entries.append(F.struct(F.lit(f"{field} down").alias("_end"), (-value).alias("_key")))
    lines = top.select("*", F.explode(F.array(*entries)).alias("_e")).select(*SORT_COLUMNS, "_e.*")
    place = F.row_number().over(
        W.partitionBy("_end").orderBy(F.col("_key").asc_nulls_last(), F.col("address").asc())
    )
    kept = lines.withColumn("_place", place).where(F.col("_place") <= n)
    return kept.select(*SORT_COLUMNS).distinct()


def minmax(df: DataFrame, col: str, out: str) -> DataFrame:
    """Scale a column to [0, 1]; a column without spread becomes 0."""
    low, high = df.agg(F.min(col)).scalar(), df.agg(F.max(col)).scalar()
    scaled = F.try_divide(F.col(col) - low, high - low)
    return df.withColumn(out, F.when(F.col(col).isNotNull(), F.coalesce(scaled, F.lit(0.0))))
