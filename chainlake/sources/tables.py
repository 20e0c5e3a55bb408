"""Readers of stored entities and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake import schemas
from chainlake.operators.latest import latest_by


def _with(schema: T.StructType, *extra: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, t, True) for n, t in extra]])


def reader(spark: SparkSession, schema: T.StructType | None = None, skip_corrupt: bool = False):
    """DataFrameReader; `skip_corrupt` leaves unreadable files out, for this read only."""
    out = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return out.schema(schema) if schema is not None else out


def read_entity(spark: SparkSession, base: str, entity: str, start: str | None = None,
                end: str | None = None, by_hour: bool = False, skip_corrupt: bool = False) -> DataFrame:
    """Entity rows of a range of days, both included.

    `date` (and `hour`) are partition columns, so the bounds choose folders
    before any file is opened.
    """
    extra = [("date", T.DateType())] + ([("hour", T.IntegerType())] if by_hour else [])
    path = f"{base}/{schemas.FOLDERS[entity]}"
    df = reader(spark, _with(schemas.ENTITIES[entity], *extra), skip_corrupt).parquet(path)
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    return df


def read_block_range_csv(spark: SparkSession, base: str, entity: str, start_block: int,
                         schema: T.StructType, skip_corrupt: bool = False) -> DataFrame:
    """CSV rows under `start_block=…/end_block=…` of one zero-padded start."""
    path = f"{base}/{schemas.FOLDERS[entity]}"
    folders = ("start_block", T.StringType()), ("end_block", T.StringType())
    df = reader(spark, _with(schema, *folders), skip_corrupt).option("header", True).csv(path)
    return df.where(F.col("start_block").cast("bigint") == start_block)


def read_token_metadata(spark: SparkSession, path: str) -> DataFrame:
    return reader(spark, schemas.TOKEN_METADATA).option("header", True).csv(path)


def read_price_history(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Header-less quotes; `day` picks the file of that day below `path`."""
    where = path if day is None else f"{path}/start={day}_end={day}.csv"
    return reader(spark, schemas.PRICE_HISTORY).option("header", False).csv(where)


def read_price_ids(spark: SparkSession, path: str) -> DataFrame:
    """Map of price id to one address column per chain; only the id is typed."""
    df = spark.read.option("header", True).csv(path)
    return df.withColumn("id", F.col("id").try_cast("bigint"))


def read_pre_tx(spark: SparkSession, path: str) -> DataFrame:
    """Exported priced rows, all text in the file, typed again here."""
    df = spark.read.option("header", True).csv(path)
    numbers = {"block_number": "decimal(38,0)", "gas": "decimal(38,0)", "gas_used": "decimal(38,0)",
               "gas_price": "decimal(38,0)", "value": "decimal(38,0)", "volume": "double",
               "gas_spent": "double", "gas_spent_usd": "double"}
    return df.select(*[
        F.col(c).try_cast(numbers[c]).alias(c) if c in numbers else F.col(c) for c in df.columns
    ])


def read_contracts(spark: SparkSession, base: str, skip_corrupt: bool = False) -> DataFrame:
    """Contracts of all partitions under `base`, with the fixed schema."""
    return reader(spark, schemas.CONTRACT, skip_corrupt).option(
        "recursiveFileLookup", True).parquet(f"{base}/contracts")


def read_items(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV or JSON lines, by suffix."""
    if path.endswith(".csv"):
        return reader(spark, schema).option("header", True).csv(path)
    if path.endswith(".json"):
        return reader(spark, schema).json(path)
    raise ValueError(f"expected a .csv or .json path, not {path!r}")


def read_latest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Table read with only the newest version of each key."""
    return latest_by(df, keys, version)


# --- partition columns -------------------------------------------------------

def check_range(start, end) -> None:
    if start < 0 or end < start:
        raise ValueError("a block range has to start at 0 or later and end at its start or later")


def assign_partitions(df: DataFrame, col: str, batch: int | None = None, by_hour: bool = False,
                      first: int = 0, last: int | None = None) -> DataFrame:
    """Add the partition columns of each row.

    A time column gives `date` (and `hour`); with `batch`, a block column gives
    the zero-padded bounds of its range, the last one ending at `last`.
    """
    from chainlake.functions.scalars import pad_block

    if batch is None:
        df = df.withColumn("date", F.to_date(col))
        return df.withColumn("hour", F.hour(col)) if by_hour else df
    check_range(first, last if last is not None else first)
    number = F.col(col).cast("bigint")
    start = number - F.pmod(number - first, F.lit(batch))
    end = start + (batch - 1)
    if last is not None:
        end = F.least(end, F.lit(last))
    return df.withColumn("start_block", pad_block(start)).withColumn("end_block", pad_block(end))
