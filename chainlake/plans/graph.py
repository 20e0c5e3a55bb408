"""Reputation over the transaction graph: preparation, PageRank, agreement."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.functions import scalars
from chainlake.operators import rows
from chainlake.operators.joins import combine_metrics, with_weights
from chainlake.operators.ranking import add_rank, last_transaction
from chainlake.session import discard, settle, small

# Out-edges of one source that share a task before the source is split.
EDGES_PER_SLICE = 1_000_000


# --- preparation -------------------------------------------------------------

def prepare_edges(tx: DataFrame, sides=("from_address",), mode: str = "blocks") -> DataFrame:
    """Newest transaction of each pair with its age weight; loops and burns left out."""
    fee = F.try_multiply(F.col("gas").cast("decimal(38,0)"), F.col("gas_price").cast("decimal(38,0)"))
    slim = tx.select("hash", "block_number", "transaction_index", "from_address", "to_address",
                     fee.cast("decimal(38,0)").alias("gas_used"))
    clean = rows.exclude_burn(rows.drop_null_endpoints(rows.drop_self_loops(slim)), sides)
    # Everything after this reads the pairs several times, so they are written once.
    edges = settle(last_transaction(clean))
    first = edges.agg(F.min("block_number")).scalar()
    days = scalars.block_age(F.col("block_number"), first, mode)
    return edges.withColumn("block_date", days).withColumn("age_weight", scalars.age_weight(days))


def graph_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("from_address").alias("src"), F.col("to_address").alias("dst"),
                        F.col("age_weight").alias("weight"))


def vertices(edges: DataFrame) -> DataFrame:
    ends = F.explode(F.array("src", "dst"))
    return edges.select(ends.alias("id")).distinct()


def personalisation(edges: DataFrame) -> DataFrame:
    """Received weight of each vertex over the total."""
    total = edges.agg(F.sum("weight")).scalar()
    return edges.groupBy(F.col("dst").alias("id")).agg(
        (F.sum("weight")).alias("weight")
    ).select("id", (F.col("weight") / total).alias("weight"))


def weighted_vertices(edges: DataFrame) -> DataFrame:
    return with_weights(vertices(edges), personalisation(edges))


def degrees(edges: DataFrame, fill_missing: bool = False) -> DataFrame:
    """In-, out- and total degree per vertex.

    The published total is 0 where one side is missing; `fill_missing=True`
    adds the present side instead.
    """
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("o")),
    )).alias("_e")).select("_e.*")
    counts = ends.groupBy("id").agg(
        F.sum(1 - F.col("o")).alias("in_degree"), F.sum("o").alias("out_degree")
    )
    total = F.col("in_degree") + F.col("out_degree")
    if not fill_missing:
        total = F.when((F.col("in_degree") > 0) & (F.col("out_degree") > 0), total).otherwise(0)
    return counts.withColumn("total_degree", total)


def gas_and_counts(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gas and sent count by sender, received count by receiver)."""
    sent = edges.groupBy(F.col("from_address").alias("address")).agg(
        F.sum("gas_used").cast("decimal(38,0)").alias("total_gas"),
        F.count(F.lit(1)).alias("total_transfer"),
    )
    received = edges.groupBy(F.col("to_address").alias("address")).agg(
        F.count(F.lit(1)).alias("total_receive")
    )
    return sent, received


def graph_size(edges: DataFrame) -> DataFrame:
    return vertices(edges).agg(F.count(F.lit(1)).alias("num_vertices")).withColumn(
        "num_edges", edges.agg(F.count(F.lit(1))).scalar()
    )


def repeat_weight(tx: DataFrame, mode: str = "blocks", of_count=None) -> DataFrame:
    """One edge per pair, its age weight multiplied by a function of the repeats."""
    of_count = of_count or (lambda n: n.cast("double"))
    clean = rows.drop_null_endpoints(rows.drop_self_loops(tx))
    pairs = clean.groupBy(F.col("from_address").alias("src"), F.col("to_address").alias("dst")).agg(
        F.count(F.lit(1)).alias("repeats"), F.max("block_number").alias("block_number")
    )
    first = clean.agg(F.min("block_number")).scalar()
    days = scalars.block_age(F.col("block_number"), first, mode)
    return pairs.withColumn("weight", scalars.age_weight(days) * of_count(F.col("repeats")))


# --- PageRank ----------------------------------------------------------------

def pagerank(
    edges: DataFrame, alpha: float = 0.85, personal: DataFrame | None = None,
    weighted: bool = True, max_iter: int = 100, tol: float | None = 1e-6,
    edges_per_slice: int = EDGES_PER_SLICE,
) -> DataFrame:
    """Power iteration over `edges(src, dst, weight)`; returns `id, score` of sum 1.

    `personal(id, weight)` steers jumps and dangling mass (uniform if absent). It
    stops when the total change drops below N * tol, or after `max_iter` rounds.

    Edges stay partitioned by source for the whole loop. A source with more than
    `edges_per_slice` out-edges is split over several slices, and only its rank
    is repeated, once per slice. Sums by target combine ahead of the shuffle. The
    ranks are written to the shared folder every round, so plans stay short and a
    lost executor costs at most one round.
    """
    count, nodes, held, kept_tables = _walkable(edges, personal, weighted, edges_per_slice)
    if count == 0:
        return nodes
    ranks = settle(nodes.withColumn("score", F.lit(1.0 / count)))
    try:
        for _ in range(max_iter):
            # A scalar subquery over the table of the round before: one job per round.
            dangling = ranks.where("total is null").agg(
                F.coalesce(F.sum("score"), F.lit(0.0))).scalar()
            shares = ranks.where("total is not null").select(
                F.col("id").alias("src"), (F.col("score") / F.col("total")).alias("share"),
                F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
            )
            gained = (
                held.join(shares, ["src", "slice"])
                .groupBy(F.col("dst").alias("id"))
                .agg(F.sum(F.col("share") * F.col("weight")).alias("gain"))
            )
            gain = F.coalesce("gain", F.lit(0.0)) + dangling * F.col("jump")
            last, ranks = ranks, settle(
                ranks.withColumnRenamed("score", "before").join(gained, "id", "left").select(
                    "id", "jump", "total", "slices", "before",
                    (F.lit(alpha) * gain + F.lit(1.0 - alpha) * F.col("jump")).alias("score"),
                )
            )
            discard(last)
            kept = ranks
            if tol is not None:
                moved = ranks.agg(F.sum(F.abs(F.col("score") - F.col("before")))).first()[0]
                if moved < count * tol:
                    break
            ranks = ranks.drop("before")
            ranks._settled_at = kept._settled_at
    finally:
        held.unpersist()
        discard(*kept_tables)
    return ranks.select("id", "score")


def _walkable(edges: DataFrame, personal: DataFrame | None, weighted: bool, edges_per_slice: int):
    """(vertex count, vertices `id, jump, total, slices`, edges dealt by source and slice, tables to delete).

    Without vertices the second is the empty result and the rest is None.
    """
    spark = edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    weight = F.col("weight") if weighted else F.lit(1.0)
    edges = settle(edges.select("src", "dst", weight.alias("weight")))
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("_n"))
    out = settle(out.select(
        F.col("src").alias("id"), "total",
        F.ceil(F.col("_n") / edges_per_slice).cast("int").alias("slices"),
    ))
    nodes = vertices(edges)
    count = nodes.count()
    if count == 0:
        return 0, spark.createDataFrame([], "id string, score double"), None, None
    jump = F.lit(1.0 / count)
    if personal is not None:
        nodes = nodes.join(personal.select("id", F.col("weight").alias("_p")), "id", "left")
        jump = F.coalesce("_p", F.lit(0.0))
    nodes = settle(
        nodes.join(out, "id", "left").select("id", jump.alias("jump"), "total", "slices")
    )
    # The slice of an edge follows from its target, so a retried task agrees with itself.
    wide = out.where("slices > 1").select(F.col("id").alias("src"), "slices")
    sliced = (
        edges.join(wide, "src", "left")
        .withColumn("slice", F.coalesce(F.pmod(F.xxhash64("dst"), F.col("slices")), F.lit(0)).cast("int"))
        .drop("slices")
    )
    # Kept in the order of the join, so no round sorts the edges again; once counted, the first round knows
    # how they lie and does not move them either.
    held = sliced.repartition(parts, "src", "slice").sortWithinPartitions("src", "slice").persist()
    held.count()
    return count, nodes, held, (edges, out, nodes)


def pagerank_push(
    edges: DataFrame, alpha: float = 0.85, personal: DataFrame | None = None,
    weighted: bool = True, tol: float = 1e-6, max_iter: int = 1000,
    edges_per_slice: int = EDGES_PER_SLICE,
) -> DataFrame:
    """`pagerank` to convergence, moving only what still changes; returns `id, score` of sum 1.

    Every vertex has a score and a residual that has not been passed on yet. A round passes on, along
    the out-edges, the residuals above a threshold and leaves the others, so the traffic falls with the
    vertices that are still unsettled. Scores only grow, and what is left bounds the error: the absolute
    errors of all scores sum to at most `tol`. Mass that ends in vertices without out-edges would return
    along the jumps, which scales all scores alike; so it is left out and the sum set to 1 in the end.

    `personal(id, weight)` must sum to 1 over the vertices. Not settled after `max_iter` rounds is an error.
    """
    count, nodes, held, kept_tables = _walkable(edges, personal, weighted, edges_per_slice)
    if count == 0:
        return nodes
    # What stays below it adds up to an error of tol / 2 beside a sum of at least 1 - alpha.
    least = tol * (1.0 - alpha) ** 2 / (2.0 * count)
    state = settle(nodes.select("id", "total", "slices", F.lit(0.0).alias("score"),
                                (F.lit(1.0 - alpha) * F.col("jump")).alias("residual")))
    moves = F.col("residual") > least
    try:
        for _ in range(max_iter):
            if state.where(moves).isEmpty():
                break
            shares = state.where(moves & F.col("total").isNotNull()).select(
                F.col("id").alias("src"), (F.lit(alpha) * F.col("residual") / F.col("total")).alias("share"),
                F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
            )
            # Once few vertices move, they go to the edges and no edge is sorted.
            gained = (
                held.join(small(shares), ["src", "slice"])
                .groupBy(F.col("dst").alias("id"))
                .agg(F.sum(F.col("share") * F.col("weight")).alias("gain"))
            )
            last, state = state, settle(
                state.join(gained, "id", "left").select(
                    "id", "total", "slices",
                    (F.col("score") + F.when(moves, F.col("residual")).otherwise(0.0)).alias("score"),
                    (F.when(moves, 0.0).otherwise(F.col("residual"))
                     + F.coalesce("gain", F.lit(0.0))).alias("residual"),
                )
            )
            discard(last)
        else:
            raise RuntimeError(f"residuals above {least} after {max_iter} rounds")
    finally:
        held.unpersist()
        discard(*kept_tables)
    return state.select("id", (F.col("score") / state.agg(F.sum("score")).scalar()).alias("score"))


def scaled_ranking(scores: DataFrame, scale: float = 1e6) -> DataFrame:
    """Score times `scale` with its position, best first."""
    scaled = scores.select(F.col("id").alias("address"), (F.col("score") * scale).alias("score"))
    return add_rank(scaled, [F.col("score").desc(), F.col("address").asc()])


def reputation_table(scores: DataFrame, edges: DataFrame) -> DataFrame:
    """Score, gas, counts and degrees per address; missing values are 0."""
    sent, received = gas_and_counts(edges)
    shape = degrees(graph_edges(edges)).withColumnRenamed("id", "address")
    base = scores.select(F.col("id").alias("address"), F.col("score").alias("reputation_score"))
    merged = combine_metrics(base, sent, received, shape).fillna(0)
    score = F.when(F.col("reputation_score") == F.lit(float("-inf")), 0.0)
    return merged.withColumn("reputation_score", score.otherwise(F.col("reputation_score")))


# --- agreement of two rankings -----------------------------------------------

DIGIT = 4  # bits of a position compared per step of the inversion count


def inversions(placed: DataFrame, n: int, cell: int = 200_000) -> DataFrame:
    """`swaps`: pairs of rows that x and y order differently, where each numbers the n rows from 1.

    Two rows are told apart by the first digit in which their y positions differ. Per digit, rows that
    agree before it form a block, and walking a block along x, each row has swapped with those passed
    before it whose digit is greater. A block is cut along x into cells of some `cell` rows; inside a cell
    a running count per digit does the walk, and between cells the counts of the cells before do. Only
    occupied cells exist, every row is in one per digit, and no pair is ever listed.
    """
    base = 1 << DIGIT
    steps = max(1, math.ceil(max(n - 1, 1).bit_length() / DIGIT))
    options = [F.struct(F.lit(k).alias("step"), F.lit(base ** (steps - 1 - k)).cast("bigint").alias("unit"),
                        # Cells of a block of this size, spread evenly, hold `cell` rows.
                        F.lit(max(1, cell * n // min(n, base ** (steps - k)))).cast("bigint").alias("wide"))
               for k in range(steps)]
    div = lambda a, b: F.call_function("div", a, b)
    at = placed.select((F.col("x") - 1).alias("x"), (F.col("y") - 1).alias("y"), F.explode(F.array(*options)).alias("o"))
    rows = at.select("x", F.col("o.step").alias("step"), div(F.col("y"), F.col("o.unit") * base).alias("block"),
                     (div(F.col("y"), F.col("o.unit")) % base).alias("digit"),
                     div(F.col("x"), F.col("o.wide")).alias("cell"))
    walk = W.partitionBy("step", "block", "cell").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)
    own, exact = F.col("digit"), lambda c: c.cast("decimal(38,0)")
    seen = F.array(*[F.count(F.when(own == d, 1)).over(walk) for d in range(base)])
    # Ahead of a row: everything seen of greater digits.
    ahead = F.aggregate(F.slice(F.col("seen"), own.cast("int") + 2, base), F.lit(0).cast("bigint"), lambda a, c: a + c)
    inside = rows.withColumn("seen", seen).withColumn("ahead", ahead)
    cells = inside.groupBy("step", "block", "cell").agg(
        F.sum(exact(F.col("ahead"))).alias("swaps"), *[F.count(F.when(own == d, 1)).alias(f"c{d}") for d in range(base)])
    before = W.partitionBy("step", "block").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    passed = cells.withColumns({f"p{d}": exact(F.coalesce(F.sum(f"c{d}").over(before), F.lit(0))) for d in range(1, base)})
    greater, between = F.lit(0).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")
    for d in range(base - 2, -1, -1):
        greater = (greater + F.col(f"p{d + 1}")).cast("decimal(19,0)")
        between = between + greater * F.col(f"c{d}").cast("decimal(19,0)")
    return passed.select((F.col("swaps") + between).cast("decimal(38,0)").alias("swaps"))


def kendall_tau(pairs: DataFrame, a: str = "rank_a", b: str = "rank_b", key: str = "address",
                top: int | None = None, strip: int = 200_000) -> DataFrame:
    """Tau-b of two columns as one row `n, tau`.

    Both columns become positions 1..n, and the pairs they order differently are counted by `inversions`
    in cells of some `strip` rows.
    """
    if top is not None:
        pairs = pairs.orderBy(F.col(a).asc(), F.col(key).asc()).limit(top)
    base = pairs.select(F.col(key).alias("k"), F.col(a).alias("a"), F.col(b).alias("b"))
    placed = add_rank(base, [F.col("a").asc(), F.col("b").asc(), F.col("k").asc()], name="x")
    placed = add_rank(placed, [F.col("b").asc(), F.col("x").asc()], name="y")
    placed = settle(placed)
    n = placed.count()
    if n < 2:
        return placed.sparkSession.range(1).select(
            F.lit(n).cast("bigint").alias("n"), F.lit(None).cast("double").alias("tau")
        )

    def tied(*cols: str):
        groups = placed.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("c"))
        return groups.agg(F.coalesce(F.sum(F.col("c") * (F.col("c") - 1) / 2), F.lit(0.0))).scalar()

    all_pairs = n * (n - 1) / 2.0
    swaps = inversions(placed, n, strip).agg(F.sum("swaps").cast("double").alias("d"))
    sums = swaps.select("d", tied("a").alias("t1"), tied("b").alias("t2"), tied("a", "b").alias("t3"))
    agree = F.lit(all_pairs) - F.col("t1") - F.col("t2") + F.col("t3") - F.col("d")
    scale = F.sqrt((F.lit(all_pairs) - F.col("t1")) * (F.lit(all_pairs) - F.col("t2")))
    return sums.select(F.lit(n).cast("bigint").alias("n"),
                       F.try_divide(agree - F.col("d"), scale).alias("tau"))


def rankings_agree(pairs: DataFrame, threshold: float = 0.9, **kwargs) -> DataFrame:
    return kendall_tau(pairs, **kwargs).withColumn("accepted", F.col("tau") > threshold)
