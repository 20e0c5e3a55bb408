"""Label, reputation and price imports from landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.functions.scalars import iso_text
from chainlake.plans.serving import CASE_SENSITIVE

# Headers of the reputation file and the columns they become.
REPUTATION_HEADERS = {
    "Address": "address", "Rank": "rank", "Identity": None, "Block": "block", "Date": "date",
    "Contract": "is_contract", "Reputation": "reputation_score", "Total Txn": "total_txn",
    "Total Transfer": "total_transfer", "Total Receive": "total_receive",
    "Total Gas Spent": "total_gas_spent", "Total Volume": "total_volume", "Degree": "degree",
    "In Degree": "in_degree", "Out Degree": "out_degree", "UAW": "uaw",
}
NULL_IF_BLANK = {"block", "date", "total_volume", "uaw"}


def read_reputation_csv(spark: SparkSession, path: str, chain: str) -> DataFrame:
    """Reputation rows of one chain.

    Blank optional numbers are NULL, other blank numbers 0, as is the flag of a
    blank `Contract` cell NULL. Chains with case-sensitive addresses keep theirs.
    """
    schema = ", ".join(f"`{h}` string" for h in REPUTATION_HEADERS)
    return reputation_rows(spark.read.option("header", True).schema(schema).csv(path), chain)


def reputation_rows(df: DataFrame, chain: str) -> DataFrame:
    from chainlake.schemas import REPUTATION

    header = {name: h for h, name in REPUTATION_HEADERS.items() if name}

    def typed(field) -> Column:
        cell = F.nullif(F.trim(F.col(f"`{header[field.name]}`")), F.lit(""))
        if field.name == "address":
            return cell if chain in CASE_SENSITIVE else F.lower(cell)
        if field.name == "is_contract":
            return cell == "Yes"
        value = cell.try_cast(field.dataType)
        blank = cell.isNull() & F.lit(field.name not in NULL_IF_BLANK)
        return F.when(blank, F.lit(0).cast(field.dataType)).otherwise(value) \
            if field.name not in NULL_IF_BLANK else value

    cols = [typed(f).alias(f.name) for f in REPUTATION.fields]
    return df.select(F.lit(chain).alias("chain"), *cols)


FIELDS_TYPE = ("struct<address:string,identity:string,category:string,explorer_tagname:string,"
               "explorer_contractname:string,crawled_oklink:string,note:string,safety:string,"
               "version:string,project:array<string>,project_name:array<string>>")
RECORD_TYPE = f"struct<recordId:string,createdAt:string,updatedAt:string,fields:{FIELDS_TYPE}>"


def label_records(raw: DataFrame) -> DataFrame:
    """Label payload lines (column `value`) to typed records."""
    return raw.select(F.from_json("value", RECORD_TYPE).alias("r")).select("r.*")


def _label_columns(contract: bool) -> list[Column]:
    f = lambda name: F.col(f"fields.{name}")
    text = lambda name: F.coalesce(f(name), F.lit(""))
    blank, none = F.lit(""), F.lit(None).cast("string")
    first = lambda name: F.get(f(name), F.lit(0))
    return [
        F.col("recordId").alias("id"), f("address").alias("address"), f("identity").alias("identity"),
        (f("category") if contract else blank).alias("category"),
        F.lit(contract).alias("is_contract"), iso_text(F.col("createdAt")).alias("created_at"),
        iso_text(F.col("updatedAt")).alias("updated_at"),
        f("explorer_tagname").alias("explorer_tagname"),
        (f("explorer_contractname") if contract else blank).alias("explorer_contractname"),
        text("crawled_oklink").alias("crawled_oklink"), text("note").alias("note"),
        (text("safety") if contract else blank).alias("safety"),
        (text("version") if contract else blank).alias("version"),
        (first("project") if contract else none).alias("project_id"),
        (first("project_name") if contract else none).alias("project_name"),
    ]


def contract_labels(records: DataFrame) -> DataFrame:
    """Contract labels with a known project."""
    project = F.get("fields.project_name", F.lit(0))
    named = F.col("fields.project_name").isNotNull()
    known = ~F.coalesce(project, F.lit("")).isin("Unknown", "Unnamed")
    return records.where(named & known).select(*_label_columns(True))


def eoa_labels(records: DataFrame) -> DataFrame:
    return records.select(*_label_columns(False))


# Columns of the flat label tables.
FLAT = {"contract": ["address", "identity", "category", "version", "safety", "project_name"],
        "eoa": ["address", "identity"]}


def flat_labels(records: DataFrame, kind: str) -> DataFrame:
    """Flat label rows; missing cells are blank."""

    def cell(name: str) -> Column:
        value = F.col(f"fields.{name}")
        value = F.array_join(value, ",") if name == "project_name" else value
        return F.coalesce(value, F.lit("")).alias(name)

    return records.select(*[cell(n) for n in FLAT[kind]])


QUOTES_TYPE = ("struct<id:bigint,rank:bigint,data:struct<quotes:array<struct<quote:struct<"
               "open:double,close:double,timestamp:string>>>>>")


def price_quotes(raw: DataFrame) -> DataFrame:
    """Landed quote payloads with their id and rank to price history rows."""
    opened = raw.select(F.from_json("value", QUOTES_TYPE).alias("p")).select(
        "p.id", "p.rank", F.explode("p.data.quotes").alias("q"))
    return opened.select(
        "id", "rank", F.col("q.quote.open").alias("open"), F.col("q.quote.close").alias("close"),
        F.floor(F.unix_millis(F.to_timestamp("q.quote.timestamp")) / 1000).cast("bigint").alias("timestamp"),
    )


def ranked_tokens(raw: DataFrame) -> DataFrame:
    """Ranked token list payload to rows."""
    kind = ("struct<data:array<struct<id:bigint,rank:bigint,name:string,symbol:string,slug:string,"
            "is_active:int>>>")
    return raw.select(F.explode(F.from_json("value", kind)["data"]).alias("t")).select("t.*")
