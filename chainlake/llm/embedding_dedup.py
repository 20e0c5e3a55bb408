"""Embedding near-duplicates (operator 10): exact metric range join over pivots."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.components import components
from chainlake.llm.local_graph import merge
from chainlake.session import discard, settle


def usable(col: str):
    """Whether a vector can link: no null, not-a-number or infinite component, not all zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(col, number) & F.exists(col, lambda x: x != 0), F.lit(False))


def unit_rows(column) -> np.ndarray:
    """An Arrow list column of equal lengths as unit rows in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # First by the largest component: squares of very small or large ones stay in range.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def choose_pivots(vectors: DataFrame, most: int, rows_per_pivot: int) -> dict:
    """Up to `most` pivots spread over groups by their size: {group: unit rows}.

    A bounded draw by hash, of all rows alike. A group that has none gets one cell; a pivot only
    says where work is done, never what links.
    """
    count = min(most, -(-vectors.count() // rows_per_pivot))
    drawn = (vectors.select("group", "vector", F.xxhash64("key").alias("h"))
             .orderBy("h").limit(count).toArrow())
    rows: dict = {}
    for group, vector in zip(drawn["group"].to_pylist(), drawn["vector"].to_pylist()):
        rows.setdefault(group, []).append(vector)
    out = {}
    for group, found in rows.items():
        got = np.array(found, np.float64)
        got = got / np.abs(got).max(axis=1, keepdims=True)
        out[group] = np.unique(got / np.linalg.norm(got, axis=1, keepdims=True), axis=0)
    return out


def near_cells(unit: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Owner cell of each vector, and a mask of all cells it must be in, its owner among them.

    With w owned by pivot j and d(v, w) <= radius, the triangle inequality gives
    d(v, j) <= d(v, owner) + 2 radius. Since the owner is the nearest pivot, v is also within
    `radius` of the plane halfway between the two pivots.
    """
    cos = unit @ pivots.T
    own = cos.argmax(axis=1)
    best = cos[np.arange(len(unit)), own][:, None]
    far = np.sqrt(np.maximum(0, 2 - 2 * cos))
    near = np.sqrt(np.maximum(0, 2 - 2 * best))
    between = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))[own]
    slack = 1e-7
    mask = (far <= near + 2 * radius + slack) & (best - cos <= radius * between + slack)
    mask[np.arange(len(unit)), own] = True
    return own, mask


def near_duplicates(rows: DataFrame, least_cosine: float = 0.98, most_pivots: int = 2048,
                    rows_per_pivot: int = 1000, block_rows: int = 4000, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    Two vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least `least_cosine`. Equal vectors of a label are one row with a weight
    before anything is compared. Each distinct vector is owned by the cell of its nearest pivot
    and copied to the cells across whose boundary a link can reach; every owner meets all it can
    link to in its own cell, so cells join on their own and every link is counted at both ends.
    A cell beyond `block_rows` members is cut into blocks that meet pairwise. Links are not
    listed: a block gives a count per vector and at most one row per member towards components.

    Vectors that are null, empty, zero, or hold a null or non-finite component, and rows without
    a label, link with nothing and are their own component. Vectors of different lengths do not
    link. Repeated rows count as vectors of their own: each links to the others. component_id
    ignores null ids; kept is null for a null id. Extra columns are ignored.
    """
    import pyarrow as pa

    spark = rows.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * least_cosine)))
    named = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"),
                        F.col(label_col).alias("label"))
    good = F.col("label").isNotNull() & usable("vector")
    group = F.concat_ws(":", F.size("vector"), F.col("label").cast("string"))
    valid = named.where(good).select("vec_id", "vector", group.alias("group"))
    distinct = settle(valid.groupBy("group", "vector").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
        .withColumn("key", F.monotonically_increasing_id()))
    pivots = spark.sparkContext.broadcast(choose_pivots(distinct, most_pivots, rows_per_pivot))

    def assign(batches):
        for batch in batches:
            groups = np.array(batch.column("group").to_pylist(), object)
            row, cell, owned = [], [], []
            for name in set(groups):
                at = np.flatnonzero(groups == name)
                if name not in pivots.value:
                    row.append(at), cell.append(np.zeros(len(at), int)), owned.append(np.ones(len(at), bool))
                    continue
                for some in np.array_split(at, -(-len(at) // 1000)):
                    unit = unit_rows(batch.column("vector").take(pa.array(some)))
                    own, mask = near_cells(unit, pivots.value[name], radius)
                    r, c = np.nonzero(mask)
                    row.append(some[r]), cell.append(c), owned.append(own[r] == c)
            if row:
                picked = batch.select(["group", "key", "weight", "vector"]).take(pa.array(np.concatenate(row)))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(np.concatenate(cell)), pa.array(np.concatenate(owned))],
                    names=["group", "key", "weight", "vector", "cell", "owned"])

    vector = valid.schema["vector"].dataType.simpleString()
    cells = settle(distinct.select("group", "key", "weight", "vector").mapInArrow(
        assign, f"group string, key long, weight long, vector {vector}, cell long, owned boolean"))
    sizes = settle(cells.groupBy("group", "cell").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")))
    # A member is asked about (if owned) in its block's row and answers in its block's column.
    own_block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    roles = F.concat(
        F.transform(F.when(F.col("owned"), every).otherwise(F.array().cast("array<int>")),
                    lambda b: F.struct(own_block.alias("x"), b.alias("y"), F.lit(True).alias("asks"))),
        F.transform(every, lambda b: F.struct(b.alias("x"), own_block.alias("y"), F.lit(False).alias("asks"))))
    met = (cells.join(sizes, ["group", "cell"]).withColumn("role", F.explode(roles))
           .select("group", "cell", "role.x", "role.y", "role.asks", "key", "weight", "vector"))

    def join(table):
        ask = table.filter(table["asks"])
        answer = table.filter(pa.compute.invert(table["asks"]))
        ours, theirs = ask["key"].to_numpy(), answer["key"].to_numpy()
        counts = np.zeros(len(ours), np.int64)
        both = np.unique(np.concatenate([ours, theirs]))
        label = np.arange(len(both))
        if len(ours) and len(theirs):
            weight = answer["weight"].to_numpy()
            there, here = np.searchsorted(both, theirs), np.searchsorted(both, ours)
            all_theirs = unit_rows(answer["vector"].combine_chunks())
            all_ours = unit_rows(ask["vector"].combine_chunks())
            for s in range(0, len(ours), 256):
                close = all_ours[s:s + 256] @ all_theirs.T >= least_cosine
                close &= ours[s:s + 256, None] != theirs[None, :]
                counts[s:s + 256] = close @ weight
                a, b = np.nonzero(close)
                merge(label, here[s + a], there[b])
        tied = np.flatnonzero(label != np.arange(len(both)))
        linked = counts > 0
        return pa.table({
            "key": np.concatenate([ours[linked], both[tied]]),
            "other": pa.array(np.concatenate([np.zeros(linked.sum(), np.int64), both[label[tied]]]),
                              mask=np.concatenate([np.ones(linked.sum(), bool), np.zeros(len(tied), bool)])),
            "n": np.concatenate([counts[linked], np.zeros(len(tied), np.int64)])})

    found = settle(met.groupBy("group", "cell", "x", "y").applyInArrow(join, "key long, other long, n long"))
    counts = found.where("other is null").groupBy("key").agg(F.sum("n").alias("n"))
    roots = components(found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b")))
    judged = settle(distinct.select("group", "vector", "weight", "least", "key")
                    .join(counts, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
                    .withColumn("root", F.coalesce("root", "key"))
                    .withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("weight") - 1))
    names = judged.groupBy("root").agg(F.min("least").alias("component_id"))
    judged_all = settle(judged.join(names, "root").select("group", "vector", "n_links", "component_id"))
    discard(cells, found)
    linked = valid.join(judged_all, ["group", "vector"]).select("vec_id", "n_links", "component_id")
    alone = named.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                      F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
