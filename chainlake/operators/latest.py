"""Newest version of a key, compaction, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in `order`.

    Spark turns `row_number = 1` into a group limit ahead of the shuffle, so a
    hot key travels as one row per task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_by(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Newest row of each key; ties broken by the remaining columns."""
    rest = [f.name for f in df.schema.fields if f.name not in (*keys, version)]
    order = [F.col(version).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]
    return one_per_key(df, keys, order)


def latest_scores(reputations: DataFrame) -> DataFrame:
    """All rows on each address's newest date (ties stay)."""
    newest = reputations.groupBy("address").agg(F.max("date").alias("date"))
    return reputations.join(newest, ["address", "date"])


def compact(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Full-row de-duplication, or one row per key in a fixed order."""
    if keys is None:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys]
    return one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in rest])


def one_price_id(ids: DataFrame, chain: str) -> DataFrame:
    """One price id per chain address: the lowest."""
    return (
        ids.where(F.col(chain).isNotNull())
        .groupBy(F.col(chain).alias("address"))
        .agg(F.min("id").alias("id"))
    )


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `batch` replace rows of `target` with the same keys."""
    fresh = compact(batch, keys)
    kept = target.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)
