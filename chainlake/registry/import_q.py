"""Imports, further sources and sinks, marketplace documents, and guards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chainlake.functions import hexes
from chainlake.operators import derive, joins, quality
from chainlake.registry.base import query
from chainlake.registry.rows_q import scratch
from chainlake.session import settle
from chainlake.sinks import writers
from chainlake.sources import imports, tables

# --- sources -----------------------------------------------------------------


@query("s02_read_entity_by_hour", """
    select cast(log_index as bigint) as log_index, address, cast(block_timestamp as date) as date,
      cast(extract(hour from block_timestamp) as int) as hour
    from {event_logs} where cast(block_timestamp as date) between date '2024-01-03' and date '2024-01-09'""")
def _(t):
    base = scratch(t)
    writers.write_entity(t.event_logs, base, "log", by_hour=True)
    found = tables.read_entity(t.spark, base, "log", "2024-01-03", "2024-01-09", by_hour=True)
    return found.select(F.col("log_index").cast("bigint").alias("log_index"), "address", "date", "hour")


@query("s03_read_block_range_csv", """
    select number, hash, miner, lpad(cast(number - (number - 15993000) % 500 as varchar), 10, '0') as start_block
    from {blocks} where number - (number - 15993000) % 500 = 15993500""")
def _(t):
    base = scratch(t)
    rows = t.blocks.select("number", "hash", "miner")
    placed = tables.assign_partitions(rows, "number", batch=500, first=15993000)
    placed.write.partitionBy("start_block", "end_block").option("header", True).csv(f"{base}/blocks")
    return tables.read_block_range_csv(t.spark, base, "block", 15993500, rows.schema).drop("end_block")


@query("s07_skip_corrupt", """
    select cast(log_index as bigint) as log_index, address, cast(block_timestamp as date) as date from {event_logs}""")
def _(t):
    base = scratch(t)
    writers.write_entity(t.event_logs, base, "log")
    # Lines of text where Parquet is expected, one file per task.
    t.event_logs.select("address").write.mode("append").text(f"{base}/logs/date=2024-01-05")
    found = tables.read_entity(t.spark, base, "log", skip_corrupt=True)
    return found.select(F.col("log_index").cast("bigint").alias("log_index"), "address", "date")


@query("s08_read_contracts", "select address, bytecode, is_erc20, is_erc721, block_number from {contracts}")
def _(t):
    base = scratch(t)
    rows = t.contracts.select("address", "bytecode", "is_erc20", "is_erc721", "block_number")
    rows.withColumn("kind", F.pmod("block_number", F.lit(3))).write.partitionBy("kind").parquet(f"{base}/contracts")
    return tables.read_contracts(t.spark, base).select(
        "address", "bytecode", "is_erc20", "is_erc721", F.col("block_number").cast("bigint").alias("block_number"))


@query("s21_daily_price_file", """
    select id, rank, open, close, timestamp from {price_history}
    where timestamp >= 1672531200 and timestamp < 1672531200 + 86400""")
def _(t):
    path = scratch(t)
    days = t.price_history.withColumn("day", F.to_date(F.timestamp_seconds("timestamp")))
    for day in ("2022-12-31", "2023-01-01"):
        writers.export_query_csv(days.where(F.col("day") == day).drop("day"), f"{path}/start={day}_end={day}.csv")
    return tables.read_price_history(t.spark, path, "2023-01-01")


# --- imports -----------------------------------------------------------------


@query("s17_reputation_csv", """
    select 'eth' as chain, lower(address) as address, rank, is_contract, date, reputation_score, total_txn,
      case when rank % 5 = 0 then null else total_volume end as total_volume,
      case when rank % 7 = 0 then 0 else degree end as degree, uaw
    from {reputations}""")
def _(t):
    path = scratch(t)
    given = {"Address": F.upper("address"), "Rank": F.col("rank"), "Date": F.col("date"),
             "Contract": F.when(F.col("is_contract"), "Yes").otherwise("No"),
             "Reputation": F.col("reputation_score"), "Total Txn": F.col("total_txn"),
             "Total Gas Spent": F.col("total_gas_spent"), "In Degree": F.col("in_degree"),
             "Total Volume": F.when(F.col("rank") % 5 != 0, F.col("total_volume")),
             "Degree": F.when(F.col("rank") % 7 != 0, F.col("degree")),
             "Out Degree": F.col("out_degree"), "UAW": F.col("uaw")}
    cells = [given.get(h, F.lit("")).cast("string").alias(h) for h in imports.REPUTATION_HEADERS]
    t.reputations.select(*cells).write.option("header", True).csv(path)
    return imports.read_reputation_csv(t.spark, path, "eth").select(
        "chain", "address", "rank", "is_contract", "date", "reputation_score", "total_txn", "total_volume",
        "degree", "uaw")


def label_payload(t):
    """Contract labels as the label service sends them, one record per line."""
    named = F.when(F.col("version") == 2, F.array(F.lit("Unnamed"))).otherwise(F.array("project_name", F.lit("other")))
    fields = F.struct("address", "identity", "category", F.col("version").cast("string").alias("version"),
                      F.array("project_id").alias("project"), named.alias("project_name"))
    record = F.struct(F.concat(F.lit("rec"), F.substring("address", 3, 40)).alias("recordId"),
                      F.lit("2023-05-01T10:00:00.000Z").alias("createdAt"), fields.alias("fields"))
    return t.label_contract.select(F.to_json(record).alias("value"))


@query("s18_contract_labels", """
    select concat('rec', substr(address, 3, 40)) as id, address, identity, category, true as is_contract, '' as note,
      cast(version as varchar) as version, project_id, project_name
    from {label_contract} where version <> 2 and project_name not in ('Unknown', 'Unnamed')""")
def _(t):
    found = imports.contract_labels(imports.label_records(label_payload(t)))
    return found.select("id", "address", "identity", "category", "is_contract", "note", "version", "project_id",
                        "project_name")


@query("s19_eoa_labels", """
    select concat('rec', substr(address, 3, 40)) as id, address, identity, '' as category, false as is_contract,
      '' as version, cast(null as varchar) as project_id
    from {label_contract}""")
def _(t):
    found = imports.eoa_labels(imports.label_records(label_payload(t)))
    return found.select("id", "address", "identity", "category", "is_contract", "version", "project_id")


@query("s20_flat_labels", """
    select address, identity, coalesce(category, '') as category, cast(version as varchar) as version, '' as safety,
      case when version = 2 then 'Unnamed' else concat(project_name, ',other') end as project_name
    from {label_contract}""")
def _(t):
    return imports.flat_labels(imports.label_records(label_payload(t)), "contract")


@query("s22_price_quotes", "select id, rank, open, close, timestamp from {price_history}")
def _(t):
    quote = F.struct(F.struct("open", "close", F.date_format(
        F.timestamp_millis(F.col("timestamp") * 1000 + 987), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp")).alias("quote"))
    raw = t.price_history.groupBy("id", "rank").agg(F.collect_list(quote).alias("quotes")).select(
        F.to_json(F.struct("id", "rank", F.struct("quotes").alias("data"))).alias("value"))
    return imports.price_quotes(raw)


@query("s23_ranked_tokens", """
    select p_partkey as id, p_size as rank, p_name as name, p_brand as symbol, lower(p_brand) as slug, 1 as is_active
    from part""")
def _(t):
    token = F.struct(F.col("p_partkey").alias("id"), F.col("p_size").alias("rank"), F.col("p_name").alias("name"),
                     F.col("p_brand").alias("symbol"), F.lower("p_brand").alias("slug"), F.lit(1).alias("is_active"))
    raw = t.part.groupBy(F.pmod("p_partkey", F.lit(20))).agg(F.collect_list(token).alias("data")).select(
        F.to_json(F.struct("data")).alias("value"))
    return imports.ranked_tokens(raw)


# --- sinks -------------------------------------------------------------------


def _through_table(t, rows, fill):
    """What a table of the catalog holds after `fill(name)`; the table goes again."""
    name = f"chainlake_{uuid.uuid4().hex}"
    rows.limit(0).write.saveAsTable(name)
    try:
        fill(name)
        return settle(t.spark.table(name))
    finally:
        t.spark.sql(f"DROP TABLE {name}")


@query("k08_append_by_name", "select number, hash, miner from {blocks} union all select number, hash, miner from {blocks}")
def _(t):
    rows = t.blocks.select("number", "hash", "miner")

    def fill(name):
        writers.append_by_name(rows, name)
        writers.append_by_name(rows.select("miner", "number", "hash"), name)

    return _through_table(t, rows, fill)


@query("k09_replace_table", "select number, hash from {blocks} where number % 2 = 0")
def _(t):
    rows = t.blocks.select("number", "hash")

    def fill(name):
        writers.append_by_name(rows, name)
        writers.replace_table(rows.where("number % 2 = 0"), name)

    return _through_table(t, rows, fill)


@query("k13_fan_out", """
    select number, hash, 'rows' as sink from {blocks}
    union all select number, hash, 'json' from {blocks} where number % 3 = 0""")
def _(t):
    rows, base = t.blocks.select("number", "hash"), scratch(t)
    writers.fan_out(rows, [lambda df: df.write.parquet(f"{base}/rows"),
                           lambda df: writers.export_json_lines(df.where("number % 3 = 0"), f"{base}/json")])
    return t.spark.read.parquet(f"{base}/rows").withColumn("sink", F.lit("rows")).unionByName(
        t.spark.read.schema(rows.schema).json(f"{base}/json").withColumn("sink", F.lit("json")))


@query("k14_append_values", "select id, open, timestamp from {price_history} where rank <= 50 "
                            "union all select id, open, timestamp from {price_history} where rank > 50")
def _(t):
    path = scratch(t)
    rows = t.price_history.select("id", "open", "timestamp", "rank")
    for part in (rows.where("rank <= 50"), rows.where("rank > 50")):
        writers.append_escrow_values(part.drop("rank"), path)
    return t.spark.read.parquet(path)


@query("k15_export_query_csv", "select number, hash, miner from {blocks}")
def _(t):
    path, rows = scratch(t), t.blocks.select("number", "hash", "miner")
    writers.export_query_csv(rows, path)
    return t.spark.read.schema(rows.schema).csv(path)


# --- marketplace -------------------------------------------------------------

MARKETS = [("0xAA00", "000", 15993000), ("0xBB00", "001", 15993400)]


def market_logs(t):
    """Listing events: one per log line, of both contracts, and some of neither."""
    index = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("cents")), 64, "0"))
    topics = F.array(F.when(F.col("line") % 2 == 0, derive.LISTING_CREATED).otherwise(derive.LISTING_UPDATED),
                     F.lit("0x0"), index)
    owner = F.element_at(F.array(*map(F.lit, ("0xaa00", "0xBB00", "0xcc00"))), F.pmod("wallet", F.lit(3)).cast("int") + 1)
    return t.log_rows.select("block_number", "log_index", owner.alias("address"), topics.alias("topics"),
                             F.concat(F.lit("0x"), F.sha2(F.col("cents").cast("string"), 256)).alias("data"), "cents")


MARKET_SQL = """
    from {log_rows} where (wallet % 3 = 0 and block_number >= 15993000 and block_number < 15993400)
      or (wallet % 3 = 1 and block_number >= 15993400)"""


@query("x13_listing_events", f"""
    select block_number, log_index,
      concat('1-', case when wallet % 3 = 0 then '000' else '001' end, '-', cast(cents as varchar)) as listing_id
    {MARKET_SQL}""")
def _(t):
    return derive.listing_events(market_logs(t), MARKETS).select("block_number", "log_index", "listing_id")


def listing_docs(t):
    """One landed document per content hash."""
    doc = F.struct(F.lit("unit").alias("listingType"), F.concat(F.lit("cat"), F.pmod("cents", F.lit(5))).alias("category"),
                   F.concat(F.lit("Title "), "cents").alias("title"),
                   F.struct(F.col("cents").cast("string").alias("amount"), F.lit("USD").alias("currency")).alias("price"),
                   F.concat(F.lit("shop"), F.pmod("cents", F.lit(40))).alias("shopIpfsHash"))
    known = market_logs(t).select("data", "cents").distinct()
    return known.select(hexes.base58("data").alias("path"), F.to_json(doc).alias("body"))


@query("x14_listings", f"""
    select block_number, log_index, 'unit' as listing_type, concat('cat', cast(cents % 5 as varchar)) as category,
      concat('Title ', cast(cents as varchar)) as title, cast(cents as varchar) as price, 'USD' as currency,
      concat('shop', cast(cents % 40 as varchar)) as shop_hash
    {MARKET_SQL}""")
def _(t):
    found = derive.listings(derive.listing_events(market_logs(t), MARKETS), listing_docs(t))
    return found.select("block_number", "log_index", "listing_type", "category", "title", "price", "currency", "shop_hash")


@query("x15_shop_products", """
    select s_suppkey as block_number, concat('L', cast(s_suppkey as varchar), '-', cast(p_partkey as varchar)) as product_id,
      cast(null as varchar) as parent_external_id, p_name as title, p_brand as description, p_size as price,
      'fiat-USD' as currency, cast(null as varchar) as option1
    from part join supplier on p_partkey % (select count(*) from supplier) = s_suppkey
    union all
    select s_suppkey, concat('L', cast(s_suppkey as varchar), '-', cast(p_partkey as varchar), 'v', cast(n as varchar)),
      concat('ext', cast(p_partkey as varchar)), concat('variant ', cast(n as varchar)), p_brand, p_size + n,
      'fiat-USD', concat('option ', cast(n as varchar))
    from part join supplier on p_partkey % (select count(*) from supplier) = s_suppkey, (select 1 as n union all select 2) v""")
def _(t):
    count = t.supplier.count()
    shop = F.concat(F.lit("Qm"), F.col("s_suppkey").cast("string"))
    shops = t.supplier.select(F.col("s_suppkey").alias("block_number"), F.lit(0).alias("log_index"),
                              F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("listing_id"), shop.alias("shop_hash"))
    page = F.lit('<html><link rel="data-dir" href="data"></html>')
    index = t.supplier.select(F.concat(shop, F.lit("/index.html")).alias("path"), page.alias("body"))
    part = t.part.withColumn("s_suppkey", F.pmod("p_partkey", F.lit(count)))
    number = F.col("p_partkey").cast("string")
    lists = part.groupBy("s_suppkey").agg(F.to_json(F.collect_list(F.struct(number.alias("id")))).alias("body")) \
        .select(F.concat(shop, F.lit("/data/products.json")).alias("path"), "body")
    variant = lambda n: F.struct(
        F.concat(number, F.lit(f"v{n}")).alias("id"), F.lit(f"variant {n}").alias("title"),
        (F.col("p_size") + n).alias("price"), F.lit(f"option {n}").alias("option1"))
    detail = F.struct(number.alias("id"), F.concat(F.lit("ext"), number).alias("externalId"), F.col("p_name").alias("title"),
                      F.col("p_brand").alias("description"), F.col("p_size").alias("price"),
                      F.array(variant(1), variant(2)).alias("variants"))
    files = part.select(F.concat(shop, F.lit("/data/"), number, F.lit("/data.json")).alias("path"),
                        F.to_json(detail).alias("body"))
    found = derive.shop_products(shops, index.unionByName(lists).unionByName(files))
    return found.select("block_number", "product_id", "parent_external_id", "title", "description", "price", "currency",
                        "option1")


# Long division by 58^5, seven hex digits at a time; limbs are low first, behind the carry.
_LETTERS = " || ".join(f"substr('{hexes.ALPHABET58}', CAST(l // {58**k} % 58 + 1 AS INTEGER), 1)" for k in range(4, -1, -1))
CONTENT_ID_SQL = f"""
    with digests as (select sha256(cast(p_partkey as varchar)) as d from part),
    pieces as (select d, list_transform(range(0, 10), lambda i:
      [cast('0x' || substr(lpad('1220' || d, 70, '0'), cast(7 * i + 1 as integer), 7) as bigint)]) as p from digests),
    limbs as (select d, list_reduce(list_concat([[0, 0, 0, 0, 0, 0, 0, 0, 0, 0]], p), lambda n, x:
      list_reduce(list_concat([[x[1]]], list_transform(n, lambda l: [l])), lambda s, l: list_concat(
        [(l[1] * {16**7} + s[1]) // {58**5}], s[2:], [(l[1] * {16**7} + s[1]) % {58**5}]))[2:]) as n from pieces)
    select concat('0x', d) as digest,
      ltrim(array_to_string(list_transform(list_reverse(n), lambda l: {_LETTERS}), ''), '1') as code from limbs"""


@query("u03_content_id", CONTENT_ID_SQL)
def _(t):
    digest = F.concat(F.lit("0x"), F.sha2(F.col("p_partkey").cast("string"), 256))
    code = hexes.base58("digest")
    return t.part.select(digest.alias("digest")).withColumn("code", code)


# --- guards ------------------------------------------------------------------


@query("q01_row_count", """
    select l.log_index, l.transaction_hash, b.hash as block_hash from {log_rows} l
    join {blocks} b on l.block_number = b.number""")
def _(t):
    rows = t.log_rows.drop("block_hash", "block_timestamp")
    found = joins.with_block(rows, t.blocks)
    quality.assert_same_count(rows, found, "logs")
    return found.select("log_index", "transaction_hash", "block_hash")
