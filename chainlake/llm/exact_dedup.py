"""Exact dedup (operator 11): heavy digests apart, the rest by an ordinary shuffle. JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.session import settle

# Most digests a frequency summary follows, and so most rows that are ever broadcast.
CAPACITY = 4096


def normalized(text: Column) -> Column:
    """Text with each run of blanks, tabs and line ends as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def heavy_hitters(df: DataFrame, col: str, capacity: int = CAPACITY) -> DataFrame:
    """At most `capacity` values of `col` (text) that a Misra-Gries summary finds frequent.

    Spark's `approx_top_k` is such a summary: counters that are taken down together when they run
    out, built per task and merged. Any value of more than some 3.5 / capacity of all rows is in it;
    what else it holds is up to the rows, so its answer is a proposal and has to be counted.
    """
    top = df.agg(F.expr(f"approx_top_k(`{col}`, {capacity}, {capacity})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias(col))


def _first(*cols: str) -> Column:
    """Struct whose least value names the row that stays: ids before null ids, then the mark."""
    return F.struct(F.col(cols[0]).isNull().alias("no_id"), *cols)


def verified(df: DataFrame, proposed: DataFrame) -> DataFrame:
    """sha, first, n of the proposed digests that do stand for two rows or more: an exact count.

    Counts combine within each task, so a digest of a third of all rows moves as one row a task.
    """
    met = df.join(F.broadcast(proposed), "sha")
    counted = met.groupBy("sha").agg(F.min(_first("doc_id", "mark")).alias("first"),
                                     F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1")


def mark_duplicates(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when `normalized` makes them identical (told apart by their SHA-256). Of equal
    texts the row with the smallest id stays; null ids come last, and among rows that share the
    smallest id exactly one stays. A group of null ids only keeps one row, with keep_id null. A null
    text is an empty one. Repeated rows are copies of each other. Extra columns are ignored, whatever
    their names; an empty table gives no rows.

    Whole texts are read once, for their digests. Digests proven frequent send their keeper to every
    task (at most `capacity` rows) and their rows are settled in place; all others meet in one
    shuffle of (id, digest), sorted, so a group is never held whole.
    """
    fps = settle(docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalized(F.col(text_col)), 256).alias("sha"))
                 .withColumn("mark", F.monotonically_increasing_id()))
    winners = settle(verified(fps, heavy_hitters(fps, "sha", capacity)))
    heavy = fps.join(F.broadcast(winners), "sha")
    group = W.partitionBy("sha")
    rest = fps.join(F.broadcast(winners.select("sha")), "sha", "left_anti").select(
        "sha", "doc_id", "mark", F.min(_first("doc_id", "mark")).over(group).alias("first"),
        F.count(F.lit(1)).over(group).alias("n"))
    return heavy.unionByName(rest).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("mark") == F.col("first.mark")).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns and whole texts, that `mark_duplicates` keeps.

    Rows of a frequent digest whose id is not its keeper's go before anything is shuffled. What is
    left is reduced per digest within each task first. Rows equal in normalized text and id are
    told apart by a hash of all columns but maps and variants.
    """
    spare = "_" * (1 + max(map(len, docs.columns)))  # no column of docs is called like this
    sha, row, best = f"{spare}s", f"{spare}r", f"{spare}b"
    hashed = docs.withColumn(sha, F.sha2(normalized(F.col(text_col)), 256))
    first = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"))
    met = hashed.select(F.col(sha).alias("sha"), first.alias("first"))
    winners = settle(met.join(F.broadcast(heavy_hitters(met, "sha", capacity)), "sha")
                     .groupBy("sha").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    known = winners.select(F.col("sha").alias(sha), F.col("first").alias(best))
    left = hashed.join(F.broadcast(known), sha, "left").where(F.col(best).isNull() | (F.col(best) == first))
    plain = [f.name for f in docs.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    order = F.struct(first, F.xxhash64(*plain))
    kept = left.groupBy(sha).agg(F.min_by(F.struct(*docs.columns), order).alias(row))
    return kept.select(f"{row}.*")
