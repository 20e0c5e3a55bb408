"""Writers: entity datasets, exports, tables, bundles, fan-out."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake import schemas
from chainlake.operators.latest import upsert
from chainlake.sources.tables import assign_partitions


def write_entity(df: DataFrame, base: str, entity: str, by_hour: bool = False) -> None:
    """Conformed Parquet under `date=…[/hour=…]`; only the dates present are replaced.

    Rebalancing gathers each date into few files and still splits a date too big
    for one task.
    """
    clock = "timestamp" if entity == "block" else "block_timestamp"
    cols = ["date", "hour"] if by_hour else ["date"]
    rows = assign_partitions(schemas.conform(df, entity), clock, by_hour=by_hour)
    (
        rows.hint("rebalance", *cols).sortWithinPartitions(*cols, *schemas.ORDER[entity])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols).option("compression", "snappy")
        .parquet(f"{base}/{schemas.FOLDERS[entity]}")
    )


def range_label(start: str, end: str) -> str:
    """Folder of an export by its number of days."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    if days < 1:
        raise ValueError("the end of a range must not be before its start")
    return "date" if days == 1 else "week" if days <= 7 else "month"


def export_path(base: str, name: str, start: str, end: str) -> str:
    return f"{base}/{name}/{range_label(start, end)}/start={start}_end={end}"


def export_csv(df: DataFrame, base: str, name: str, start: str, end: str,
               single_file: bool = False) -> str:
    """Header CSV in the export layout. One file is an option for small results only."""
    path = export_path(base, name, start, end)
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def flat_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Chosen columns with lists joined by commas."""
    cols = cols or df.columns
    return df.select(*[
        F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
        if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c)
        for c in cols
    ])


def export_entity_csv(df: DataFrame, path: str, cols: list[str] | None = None) -> None:
    flat_rows(df, cols).write.mode("overwrite").option("header", True).csv(path)


def json_rows(df: DataFrame) -> DataFrame:
    """Decimals as text, so no reader rounds them."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def export_json_lines(df: DataFrame, path: str) -> None:
    json_rows(df).write.mode("overwrite").json(path)


# Topic of each entity.
TOPICS = {"block": "blocks", "transaction": "transactions", "log": "logs",
          "token_transfer": "token_transfers", "trace": "traces", "contract": "contracts",
          "token": "tokens"}


def to_kafka_rows(df: DataFrame, entity: str, key: str | None = None) -> DataFrame:
    """Rows for the Kafka writer: topic, key and JSON value."""
    value = F.to_json(F.struct(F.lit(entity).alias("type"), *[F.col(c) for c in df.columns]),
                      {"ignoreNullFields": "false"})
    name = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.lit(TOPICS[entity]).alias("topic"), name.alias("key"), value.alias("value"))


def write_kafka(df: DataFrame, entity: str, servers: str, key: str | None = None) -> None:
    rows = to_kafka_rows(df, entity, key)
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def upsert_partitions(target_path: str, batch: DataFrame, keys: list[str], partition: str = "date") -> None:
    """Upsert a Parquet dataset, rewriting only the partitions the batch touches.

    `keys` have to include the partition column or determine it.
    """
    spark = batch.sparkSession
    target = spark.read.schema(batch.schema).parquet(target_path)
    touched = batch.select(partition).distinct()
    current = target.join(touched, partition, "left_semi")
    from chainlake.session import settle

    merged = settle(upsert(current, batch, keys))
    (
        merged.hint("rebalance", partition).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(target_path)
    )


def append_by_name(df: DataFrame, table: str) -> None:
    """Append in the table's own column order."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").saveAsTable(table)


def replace_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Truncate and load over JDBC, keeping the target's definition."""
    df.write.jdbc(url, table, mode="overwrite", properties={"truncate": "true", **properties})


def append_escrow_values(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_query_csv(df: DataFrame, path: str) -> None:
    """Header-less CSV of a query result."""
    df.write.mode("overwrite").csv(path)


def fan_out(df: DataFrame, sinks: Iterable[Callable[[DataFrame], None]]) -> None:
    """Several sinks from one computation of `df`."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()


# --- block bundles -----------------------------------------------------------

def duplicate_blocks(blocks: DataFrame) -> DataFrame:
    """Numbers that more than one block row carries."""
    return blocks.groupBy("number").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _items(df: DataFrame, name: str, order: list[str], part_rows: int | None) -> DataFrame:
    """`block_number`, `part` and each item as a struct; blocks are cut into parts of about `part_rows` items if that is given."""
    df = df.where("block_number is not null")
    lead = F.struct(*order, *[c for c in df.columns if c not in (*order, "block_number")])
    if part_rows is None:
        return df.select("block_number", F.lit(0).alias("part"), lead.alias(name))
    sizes = df.groupBy("block_number").agg(
        F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("_parts")
    ).where("_parts > 1")
    part = F.coalesce(F.pmod(F.xxhash64(*order), F.col("_parts")), F.lit(0)).cast("int")
    return df.join(sizes, "block_number", "left").select("block_number", part.alias("part"), lead.alias(name))


def block_bundles(blocks: DataFrame, tx: DataFrame, logs: DataFrame, transfers: DataFrame,
                  traces: DataFrame | None = None, part_rows: int | None = None) -> DataFrame:
    """One nested document per block; a block number has to be unique.

    A block's gas limit bounds its lists. With `part_rows`, a document holds about that many
    items per list and a block beyond that continues in documents with `part` 1, 2, …; nothing
    is left out either way. Items of all kinds, and without parts the blocks too, meet in one shuffle.
    """
    lists = [("transactions", tx, ["transaction_index", "hash"]),
             ("logs", logs, ["log_index", "transaction_hash"]),
             ("token_transfers", transfers, ["log_index", "transaction_hash"])]
    if traces is not None:
        lists.append(("traces", traces, ["trace_index", "trace_id"]))
    items, kind = None, blocks.schema["number"].dataType
    for name, df, order in lists:
        part = _items(df, name, order, part_rows)
        items = part if items is None else items.unionByName(part, allowMissingColumns=True)
    listed = [F.sort_array(F.collect_list(name)).alias(name) for name, _, _ in lists]
    own = blocks.select(F.col("number").alias("block_number"), F.struct(*blocks.columns).alias("block"))
    found = [F.count("block").alias("_n"), F.first("block", ignorenulls=True).alias("block")]
    # Dealt and sorted once, lists need no table of groups: nothing is sorted ahead of the shuffle or twice after it.
    blocks.sparkSession.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    dealt = lambda df, *keys: df.repartition(*keys).sortWithinPartitions(*keys).groupBy(*keys)
    if part_rows is None:
        both = items.unionByName(own.withColumn("part", F.lit(0)), allowMissingColumns=True)
        bundles = dealt(both, "block_number").agg(*found, *listed).where("_n > 0").withColumn("part", F.lit(0))
    else:
        docs = dealt(items, "block_number", "part").agg(*listed)
        bundles = own.groupBy("block_number").agg(*found).join(docs, "block_number", "left")
    block = F.when(F.col("_n") == 1, F.col("block")).otherwise(F.raise_error(
        F.concat(F.lit("more than one block with number "), F.col("block_number").cast("string"))))
    filled = [F.coalesce(name, F.array().cast(bundles.schema[name].dataType)).alias(name) for name, _, _ in lists]
    return bundles.select(F.col("block_number").cast(kind).alias("block_number"),
                          F.coalesce("part", F.lit(0)).alias("part"), block.alias("block"), *filled)
