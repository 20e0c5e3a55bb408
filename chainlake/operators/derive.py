"""Entities derived from logs, traces and landed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.functions import bytecode, hexes, scalars
from chainlake.operators.ranking import BLOCK_ROWS, add_rank
from chainlake.session import settle

# Fixed value: signature of the token transfer event.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"

# Marketplace events.
LISTING_CREATED = "0xec3d306143145322b45d2788d826e3b7b9ad062f16e1ec59a5eaba214f96ee3c"
LISTING_UPDATED = "0x470503ad37642fff73a57bac35e69733b6b38281a893f39b50c285aad1f040e0"


# --- token transfers ---------------------------------------------------------

def _transfer_events(logs: DataFrame) -> DataFrame:
    return logs.where(F.lower(hexes.item(F.col("topics"), 1)) == TRANSFER_TOPIC)


def _parts() -> Column:
    """Number of topics and data words together."""
    return F.size("topics") + hexes.word_count(F.col("data"))


def _part(index: int) -> Column:
    """1-based part of an event: a topic, or a data word past the last topic.

    Sliced straight from the row, without building an array of all parts.
    """
    beyond = F.lit(index - 1) - F.size("topics")
    return F.when(beyond < 0, hexes.item(F.col("topics"), index)).otherwise(
        hexes.word_at(F.col("data"), beyond))


def transfers_from_logs(logs: DataFrame) -> DataFrame:
    """Transfers of all logs whose topics and data words are four in total.

    `value` is the exact text; `value_dec` and `value_dbl` never leave the JVM,
    and a query that selects only those skips the text conversion.
    """
    context = [c for c in ("block_timestamp", "block_hash") if c in logs.columns]
    return _transfer_events(logs).where(_parts() == 4).select(
        F.lower("address").alias("token_address"),
        hexes.word_address(_part(2)).alias("from_address"),
        hexes.word_address(_part(3)).alias("to_address"),
        _part(4).alias("_raw"), "transaction_hash", "log_index", "block_number", *context,
    ).select(
        "token_address", "from_address", "to_address", hexes.hex_text("_raw").alias("value"),
        hexes.hex_dec(F.col("_raw")).alias("value_dec"), hexes.hex_dbl(F.col("_raw")).alias("value_dbl"),
        "transaction_hash", "log_index", "block_number", *context,
    )


def odd_transfers(logs: DataFrame) -> DataFrame:
    """Transfer events the extractor skips: not four parts."""
    return _transfer_events(logs).where(_parts() != 4)


def transfers_strict(logs: DataFrame) -> DataFrame:
    """SQL form: exactly three topics, signature as written, value from the data."""
    topic = lambda i: hexes.item(F.col("topics"), i)
    return logs.where((F.size("topics") == 3) & (topic(1) == TRANSFER_TOPIC)).select(
        "block_number",
        F.concat(F.lit("0x"), F.right(topic(2), F.lit(40))).alias("from_address"),
        F.concat(F.lit("0x"), F.right(topic(3), F.lit(40))).alias("to_address"),
        hexes.hex_dbl(F.col("data")).alias("token_transfer"),
        F.col("address").alias("token_address"), "transaction_hash", "block_timestamp",
    )


def transfers_for(logs: DataFrame, tokens: list[str], first: int, last: int) -> DataFrame:
    """Transfers of given tokens in a block range."""
    wanted = [t.lower() for t in tokens]
    near = logs.where(F.col("block_number").between(first, last))
    if wanted:
        near = near.where(F.lower("address").isin(wanted))
    return transfers_from_logs(near)


# --- contracts and tokens ----------------------------------------------------

def classify_interfaces(contracts: DataFrame) -> DataFrame:
    """Add selectors and the two interface flags from `bytecode`."""
    return (
        contracts.withColumn("function_sighashes", bytecode.sighashes("bytecode"))
        .withColumn("is_erc20", bytecode.is_erc20(F.col("function_sighashes")))
        .withColumn("is_erc721", bytecode.is_erc721(F.col("function_sighashes")))
    )


def contracts_from_traces(traces: DataFrame) -> DataFrame:
    created = traces.where(
        (F.col("trace_type") == "create") & (F.length("to_address") > 0) & (F.col("status") == 1)
    )
    return classify_interfaces(
        created.select(F.col("to_address").alias("address"), F.col("output").alias("bytecode"),
                       "block_number")
    )


def contracts_from_code(code: DataFrame) -> DataFrame:
    """Landed (address, code) rows to contracts."""
    return classify_interfaces(
        code.select(F.lower("address").alias("address"), F.col("code").alias("bytecode"),
                    *[c for c in ("block_number",) if c in code.columns])
    )


def token_candidates(contracts: DataFrame) -> DataFrame:
    return contracts.where(F.col("is_erc20") | F.col("is_erc721"))


# Landed call results in order of preference.
SYMBOL_CALLS = ["symbol", "SYMBOL_upper", "symbol_bytes32", "SYMBOL_upper_bytes32"]
NAME_CALLS = ["name", "NAME_upper", "name_bytes32", "NAME_upper_bytes32"]
DECIMAL_CALLS = ["decimals", "DECIMALS_upper"]


def resolve_token_metadata(calls: DataFrame) -> DataFrame:
    """First usable call result per field; text is cleaned of NUL characters."""

    def first(names: list[str]) -> Column:
        return F.coalesce(*[
            (scalars.bytes_text(F.col(n)) if n.endswith("bytes32") else scalars.clean_text(F.col(n)))
            for n in names if n in calls.columns
        ])

    decimals = F.coalesce(*[F.col(n).try_cast("decimal(20,0)") for n in DECIMAL_CALLS
                            if n in calls.columns])
    return calls.select(
        F.lower("address").alias("address"), first(SYMBOL_CALLS).alias("symbol"),
        first(NAME_CALLS).alias("name"), decimals.alias("decimals"),
        F.col("total_supply"), "block_number",
    )


# --- traces ------------------------------------------------------------------

def _path_text(path: Column) -> Column:
    return F.array_join(path.cast("array<string>"), ",")


def trace_status(traces: DataFrame) -> DataFrame:
    """Status 0 for a trace that failed or has a failed ancestor, else 1.

    Paths in ascending order list a transaction's traces depth first, so what lies below a failed trace
    is the run that follows it, up to its path with the greatest number appended. Such runs nest or stay
    apart: a trace lies in one if the furthest end among the failed traces ahead of it is not behind it.
    One shuffle and one sorted run a transaction, whatever the depth. A trace outside transactions (no
    hash) stands alone; these are dealt by block and receiver.
    """
    failed = F.coalesce(F.length("error") > 0, F.lit(False))
    path = F.coalesce(F.col("trace_address").cast("array<int>"), F.array().cast("array<int>"))
    scoped = scalars.in_transaction()
    run = W.partitionBy("_tx", "_loose").orderBy(F.col("_path").asc(), F.col("_failed").asc())
    furthest = F.max(F.when(F.col("_failed"), F.concat("_path", F.array(F.lit(2**31 - 1))))).over(
        run.rowsBetween(W.unboundedPreceding, -1))
    loose = F.when(~scoped, F.xxhash64("block_number", "to_address"))
    return (
        traces.withColumns({"_tx": F.when(scoped, F.col("transaction_hash")), "_loose": loose,
                            "_path": path, "_failed": failed})
        .withColumn("_end", furthest)
        .withColumn("status", F.when(F.col("_failed"), 0)
                    .when(F.col("_tx").isNotNull() & (F.col("_end") >= F.col("_path")), 0).otherwise(1))
        .drop("_tx", "_loose", "_path", "_failed", "_end")
    )


def orphan_traces(traces: DataFrame) -> DataFrame:
    """Traces whose parent path is missing in their transaction."""
    scoped = scalars.in_transaction()
    path = F.col("trace_address")
    known = traces.where(scoped).select(
        "transaction_hash", _path_text(path).alias("_parent")
    )
    return (
        traces.where(scoped & (F.size(path) > 0))
        .withColumn("_parent", _path_text(F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))))
        .join(known, ["transaction_hash", "_parent"], "left_anti")
        .drop("_parent")
    )


def block_trace_index(traces: DataFrame) -> DataFrame:
    """Add `type_index`: 0-based position among the block-scoped traces of one type.

    Rows tied on every listed column are interchangeable.
    """
    order = [F.col(c).asc_nulls_first() for c in ("reward_type", "from_address", "to_address", "value")]
    loose = traces.where(~scalars.in_transaction())
    ranked = add_rank(loose, order, ["block_number", "trace_type"], "_n", BLOCK_ROWS)
    return ranked.withColumn("type_index", F.col("_n") - 1).drop("_n")


def number_traces(traces: DataFrame) -> DataFrame:
    """Add `trace_id`: by path inside a transaction, else by position in the block."""
    inside = traces.where(scalars.in_transaction()).withColumn("trace_id", scalars.trace_id())
    loose = block_trace_index(traces)
    loose = loose.withColumn("trace_id", scalars.trace_id(F.col("type_index"))).drop("type_index")
    return inside.unionByName(loose)


def arrival_index(traces: DataFrame, position: str = "position") -> DataFrame:
    """Add `trace_index`: 0-based place within the block in order of arrival."""
    order = [F.col(position).asc(), F.col("trace_id").asc_nulls_first()]
    ranked = add_rank(traces, order, ["block_number"], "_n", BLOCK_ROWS)
    return ranked.withColumn("trace_index", F.col("_n") - 1).drop("_n")


def with_seed_traces(traces: DataFrame, genesis: DataFrame, forks: DataFrame,
                     fork_block: int, first: int, last: int) -> DataFrame:
    """Append allocation rows (block 0) and state changes (fork block) in the range.

    `genesis` holds (address, value), `forks` (from_address, to_address, value).
    """
    allocated = genesis.select(
        F.lit(0).alias("block_number"), F.col("address").alias("to_address"), "value",
        F.lit("genesis").alias("trace_type"), F.lit(1).alias("status"),
    )
    moved = forks.select(
        F.lit(fork_block).alias("block_number"), "from_address", "to_address", "value",
        F.lit("daofork").alias("trace_type"), F.lit(1).alias("status"),
    )
    seeds = allocated.unionByName(moved, allowMissingColumns=True)
    seeds = seeds.where(F.col("block_number").between(first, last))
    kinds = {f.name: f.dataType for f in traces.schema.fields}
    typed = [F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in seeds.columns]
    return traces.unionByName(seeds.select(*typed), allowMissingColumns=True)


# --- marketplace -------------------------------------------------------------

def listing_events(logs: DataFrame, markets: list[tuple[str, str, int]]) -> DataFrame:
    """Listing events of the marketplace contracts.

    `markets` lists (address, version, first block) in block order; a contract
    counts from its first block to the next one's.
    """
    number, owner = F.col("block_number"), F.lower("address")
    version, here = F.lit(None).cast("string"), F.lit(False)
    for at, (address, label, first) in enumerate(markets):
        in_era = (number >= first) & (owner == address.lower())
        if at + 1 < len(markets):
            in_era &= number < markets[at + 1][2]
        version = F.when(in_era, F.lit(label)).otherwise(version)
        here |= in_era
    topic = lambda i: hexes.item(F.col("topics"), i)
    listing = F.concat_ws("-", F.lit("1"), version, hexes.hex_text(topic(3)))
    return logs.where(
        here & topic(1).isin(LISTING_CREATED, LISTING_UPDATED) & (F.size("topics") >= 3)
    ).select(
        "block_number", "log_index", listing.alias("listing_id"),
        hexes.base58("data").alias("ipfs_hash"),
    )


# Listing column and its place in the document.
LISTING_FIELDS = [
    ("listing_type", "$.listingType"), ("category", "$.category"),
    ("subcategory", "$.subCategory"), ("language", "$.language"), ("title", "$.title"),
    ("description", "$.description"), ("price", "$.price.amount"),
    ("currency", "$.price.currency"),
]


def listings(events: DataFrame, docs: DataFrame) -> DataFrame:
    """Listing rows from landed documents (`path`, `body`) keyed by content hash.

    A content id costs more than all else here, and a join would compute it for its null filter and again
    for its rows, so both sides are written once.
    """
    held = settle(docs.select(F.col("path").alias("ipfs_hash"), "body"))
    found = settle(events).join(held, "ipfs_hash")
    return found.select(
        "block_number", "log_index", "listing_id", "ipfs_hash",
        *[scalars.doc_field(F.col("body"), path).alias(name) for name, path in LISTING_FIELDS],
        F.get_json_object("body", "$.shopIpfsHash").alias("shop_hash"),
    )


def shop_data_dir(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add `data_dir`: the directory named by the data-dir link, NULL without one."""
    found = F.regexp_extract(F.col(html), '<link rel="data-dir" href="(.+?)"', 1)
    return pages.withColumn("data_dir", F.nullif(found, F.lit("")))


VARIANT = "struct<id:string,externalId:string,title:string,price:bigint,image:string," \
          "option1:string,option2:string,option3:string>"
DETAIL = f"struct<id:string,externalId:string,title:string,description:string,price:bigint," \
         f"currency:string,image:string,variants:array<{VARIANT}>>"


def shop_products(shops: DataFrame, docs: DataFrame) -> DataFrame:
    """Products and variants of shops.

    `shops` carries block_number, log_index, listing_id and shop_hash; `docs`
    holds the landed files as (path, body).
    """
    index = shop_data_dir(
        docs.where(F.col("path").endswith("/index.html")).select(
            F.regexp_replace("path", "/index.html$", "").alias("shop_hash"), F.col("body").alias("html")
        )
    ).drop("html")
    base = shops.join(index, "shop_hash").withColumn(
        "_base", F.concat_ws("/", "shop_hash", "data_dir")
    )
    files = docs.select(F.col("path").alias("_file"), F.col("body").alias("_body"))
    entries = (
        base.join(files, F.concat("_base", F.lit("/products.json")) == F.col("_file"))
        .withColumn("_entry", F.explode(F.from_json("_body", "array<struct<id:string>>")))
        .drop("_file", "_body")
        .withColumn("_id", F.nullif("_entry.id", F.lit("")))
        .where("_id is not null")
        .withColumn("ipfs_path", F.concat_ws("/", "_base", "_id"))
    )
    detail = (
        entries.join(files, F.concat("ipfs_path", F.lit("/data.json")) == F.col("_file"))
        .withColumn("_d", F.from_json("_body", DETAIL)).where("_d is not null")
    )
    shared = ["block_number", "log_index", "listing_id"]
    currency = F.coalesce("_d.currency", F.lit("fiat-USD")).alias("currency")
    outer = F.nullif("_d.externalId", F.lit(""))
    products = detail.select(
        *shared, F.concat_ws("-", "listing_id", "_id").alias("product_id"), "ipfs_path",
        outer.alias("external_id"), F.lit(None).cast("string").alias("parent_external_id"),
        F.col("_d.title"), F.col("_d.description"), F.col("_d.price"), currency,
        *[F.lit(None).cast("string").alias(f"option{i}") for i in (1, 2, 3)], F.col("_d.image"),
    )
    variants = detail.withColumn("_v", F.explode("_d.variants")).select(
        *shared, F.concat_ws("-", "listing_id", "_v.id").alias("product_id"), "ipfs_path",
        F.nullif("_v.externalId", F.lit("")).alias("external_id"), outer.alias("parent_external_id"),
        F.col("_v.title"), F.col("_d.description"), F.col("_v.price"), currency,
        *[F.col(f"_v.option{i}") for i in (1, 2, 3)], F.col("_v.image"),
    )
    return products.unionByName(variants)


# --- address dictionary ------------------------------------------------------

def address_dictionary(addresses: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Dense ids for distinct addresses; known addresses keep theirs."""
    fresh = addresses.select("address").where("address is not null").distinct()
    if existing is None:
        return add_rank(fresh, [F.col("address")], name="id").select("address", "id")
    fresh = fresh.join(existing.select("address"), "address", "left_anti")
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    added = add_rank(fresh, [F.col("address")], name="id")
    return existing.select("address", "id").unionByName(
        added.select("address", (F.col("id") + top).alias("id"))
    )


def block_weights(blocks: DataFrame, mode: str = "blocks") -> DataFrame:
    """Age weight of each distinct block number."""
    first = blocks.agg(F.min("block_number")).scalar()
    days = scalars.block_age(F.col("block_number"), first, mode)
    return blocks.select("block_number").distinct().select(
        "block_number", days.alias("block_date"), scalars.age_weight(days).alias("age_weight")
    )
