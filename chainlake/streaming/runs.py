"""What batches have stored, merged into fewer and longer runs as batches come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chainlake.session import child_names, delete_path, path_exists

Step = Callable[[DataFrame, int], None]
Change = Callable[[DataFrame], DataFrame]


def _folder(path: str, first: int, last: int) -> str:
    return f"{path}/run-{first}-{last}"


def complete_runs(spark: SparkSession, path: str, before: int | None = None) -> list[tuple[int, int]]:
    """(first, last) batch of the runs to read, in order.

    A run counts once it is written to its end, and one inside a longer one does not count: it has been
    merged and only waits to be deleted. `before` leaves out runs that reach that batch.
    """
    found = []
    for name in child_names(spark, path):
        head, _, rest = name.partition("-")
        first, _, last = rest.partition("-")
        if head == "run" and first.isdigit() and last.isdigit() and path_exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append((int(first), int(last)))
    kept: list[tuple[int, int]] = []
    for first, last in sorted(found, key=lambda r: (r[0], -r[1])):
        if (before is None or last < before) and (not kept or last > kept[-1][1]):
            kept.append((first, last))
    return kept


def read_runs(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All rows stored under `path` by batches (before `before`)."""
    out = spark.createDataFrame([], schema)
    for run in complete_runs(spark, path, before):
        out = out.unionByName(spark.read.schema(schema).parquet(_folder(path, *run)).select(*schema.names))
    return out


def merge_runs(spark: SparkSession, path: str, batch_id: int, schema: T.StructType,
               merge: Change = lambda rows: rows, by: list[str] | None = None) -> None:
    """Merge the runs before a batch, and delete what is merged and what an earlier try of the batch left.

    Runs grow as carries do in counting: ahead of batch n, the runs of the last 2^k batches become one, where
    2^k is the greatest power of two that divides n. So n batches leave about log2(n) runs and a row
    is written again log2(n) times. Only batches before n are merged, which can never be repeated. A merged
    run counts from the moment it is whole, and what it holds goes after that, so a job that dies anywhere in
    between leaves every row readable once.
    """
    for first, last in complete_runs(spark, path):
        if first >= batch_id:
            delete_path(spark, _folder(path, first, last))
    span = batch_id & -batch_id
    old = [r for r in complete_runs(spark, path, batch_id) if r[0] >= batch_id - span]
    if len(old) > 1:
        whole = (old[0][0], old[-1][1])
        parts = None
        for run in old:
            part = spark.read.schema(schema).parquet(_folder(path, *run)).select(*schema.names)
            parts = part if parts is None else parts.unionByName(part)
        _write(merge(parts).hint("rebalance", *(by or [])), _folder(path, *whole), by)
    kept = complete_runs(spark, path, batch_id)
    for name in child_names(spark, path):
        ends = [int(x) for x in name.split("-")[1:] if x.isdigit()]
        if len(ends) == 2 and any(a <= ends[0] and ends[1] <= b and (a, b) != tuple(ends) for a, b in kept):
            delete_path(spark, f"{path}/{name}")


def store_run(rows: DataFrame, path: str, batch_id: int, merge: Change = lambda rows: rows,
              by: list[str] | None = None) -> None:
    """Store the rows of a batch as a run of its own, once the runs before it are merged.

    Rows that come from `read_runs` of the same path need `merge_runs` ahead of the reading.
    """
    merge_runs(rows.sparkSession, path, batch_id, rows.schema, merge, by)
    _write(rows, _folder(path, batch_id, batch_id), by)


def _write(rows: DataFrame, folder: str, by: list[str] | None) -> None:
    """Rows of a value of `by` lie together, so readers skip the pages of others; a folder a value could be too many."""
    rows = rows.sortWithinPartitions(*by) if by else rows
    rows.write.mode("overwrite").parquet(folder)


def run_sink(path: str, prepare: Change = lambda batch: batch, merge: Change = lambda rows: rows) -> Step:
    """Store the prepared rows of each batch; `merge` reduces rows of several batches to the same columns."""

    def run(batch: DataFrame, batch_id: int) -> None:
        store_run(prepare(batch), path, batch_id, merge)

    return run
