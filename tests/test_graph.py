import random
from decimal import Decimal
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainlake.operators import derive, ranking
from chainlake.operators.latest import compact, latest_by, one_per_key, upsert
from chainlake.plans import activity, graph
from conftest import listed


def dense_rank(edges, alpha, personal=None, rounds=200):
    """The same iteration with a matrix."""
    ids = sorted({v for s, d, _ in edges for v in (s, d)})
    at = {v: i for i, v in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for s, d, x in edges:
        w[at[s], at[d]] += x
    p = np.full(len(ids), 1 / len(ids)) if personal is None else np.array([personal.get(v, 0.0) for v in ids])
    out = w.sum(axis=1)
    x = np.full(len(ids), 1 / len(ids))
    for _ in range(rounds):
        flow = (x / np.where(out > 0, out, 1) * (out > 0)) @ w
        x = alpha * (flow + x[out == 0].sum() * p) + (1 - alpha) * p
    return dict(zip(ids, x))


def random_edges(seed=1, n=25, m=120):
    rng = random.Random(seed)
    hub = [("hub", f"v{i}", 1.0 + i % 3) for i in range(n)]  # one source, a good share of all edges
    return hub + [(f"v{rng.randrange(n)}", f"v{rng.randrange(n // 2)}", rng.random() + 0.1) for _ in range(m)]


@pytest.mark.parametrize("slice_rows", [1_000_000, 2])
def test_weighted_personalised_rank(spark, slice_rows):
    rows = random_edges()
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    personal = {r.id: r.weight for r in graph.personalisation(edges).collect()}
    got = graph.pagerank(edges, 0.5, graph.personalisation(edges), tol=1e-12, max_iter=100, edges_per_slice=slice_rows)
    want = dense_rank(rows, 0.5, personal)
    found = {r.id: r.score for r in got.collect()}
    assert found.keys() == want.keys()
    assert max(abs(found[k] - want[k]) for k in want) < 1e-10
    assert abs(sum(found.values()) - 1) < 1e-9


def test_uniform_rank_stops_on_tolerance(spark):
    rows = [(s, d, 5.0) for s, d, _ in random_edges(2)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    got = {r.id: r.score for r in graph.pagerank(edges, weighted=False, tol=1e-6).collect()}
    want = dense_rank([(s, d, 1.0) for s, d, _ in rows], 0.85)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-4


@pytest.mark.parametrize("slice_rows, personal", [(1_000_000, True), (2, False)])
def test_push_reaches_the_dense_rank(spark, slice_rows, personal):
    rows = random_edges(3)
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    start = graph.personalisation(edges) if personal else None
    want = dense_rank(rows, 0.6, {r.id: r.weight for r in start.collect()} if personal else None)
    for tol in (1e-1, 1e-5):
        got = graph.pagerank_push(edges, 0.6, start, tol=tol, edges_per_slice=slice_rows)
        found = {r.id: r.score for r in got.collect()}
        assert found.keys() == want.keys()
        assert sum(abs(found[k] - want[k]) for k in want) <= tol
        assert abs(sum(found.values()) - 1) < 1e-9


def test_push_moves_only_what_is_unsettled(spark, monkeypatch):
    # A long chain beside a ring: the chain settles link by link, the ring goes on.
    rows = [(f"c{i}", f"c{i + 1}", 1.0) for i in range(12)] + [("r0", "r1", 1.0), ("r1", "r0", 1.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    start = spark.createDataFrame([("c0", 0.5), ("r0", 0.5)], "id string, weight double")
    sent = []
    monkeypatch.setattr(graph, "small", lambda df: sent.append(df.count()) or df)
    got = {r.id: r.score for r in graph.pagerank_push(edges, 0.5, start, tol=1e-3).collect()}
    want = dense_rank(rows, 0.5, {"c0": 0.5, "r0": 0.5})
    assert sum(abs(got[k] - want[k]) for k in want) <= 1e-3
    assert max(sent) <= 2 and len(sent) < 25
    with pytest.raises(RuntimeError):
        graph.pagerank_push(edges, 0.5, start, tol=1e-9, max_iter=3)
    assert graph.pagerank_push(edges.limit(0)).count() == 0


def test_edges_keep_the_last_transaction_per_pair(spark):
    zero = "0x" + "0" * 40
    rows = spark.createDataFrame([
        ("h1", 100, 0, "a", "b", 1, 1), ("h2", 300, 0, "a", "b", 1, 1), ("h3", 300, 1, "a", "b", 2, 2),
        ("h4", 100, 0, "a", "a", 1, 1), ("h5", 100, 0, zero, "a", 1, 1), ("h6", 100, 0, "b", None, 1, 1),
        ("h7", 28800 + 390, 0, "b", zero, 1, 1),
    ], "hash string, block_number long, transaction_index long, from_address string, to_address string, gas long, gas_price long")
    got = graph.prepare_edges(rows)
    assert listed(got, "hash", "block_date") == [("h3", 0), ("h7", 1)]
    assert listed(graph.prepare_edges(rows, sides=("from_address", "to_address")), "hash") == [("h3",)]


def test_degrees_with_a_missing_side(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 1.0)], "src string, dst string, weight double")
    assert listed(graph.degrees(edges)) == [("a", 0, 2, 0), ("b", 1, 1, 2), ("c", 2, 0, 0)]
    assert listed(graph.degrees(edges, fill_missing=True)) == [("a", 0, 2, 2), ("b", 1, 1, 2), ("c", 2, 0, 2)]


def brute_tau(rows):
    agree = swap = t1 = t2 = 0
    for (_, a1, b1), (_, a2, b2) in combinations(rows, 2):
        s = np.sign(a1 - a2) * np.sign(b1 - b2)
        agree, swap = agree + (s > 0), swap + (s < 0)
        t1, t2 = t1 + (a1 == a2), t2 + (b1 == b2)
    n0 = len(rows) * (len(rows) - 1) / 2
    return (agree - swap) / np.sqrt((n0 - t1) * (n0 - t2))


@pytest.mark.parametrize("values,strip", [(1000, 7), (12, 9), (1000, 500), (40, 1)])
def test_tau_with_ties_and_strips(spark, values, strip):
    rng = random.Random(values + strip)
    rows = [(f"k{i}", rng.randrange(values), rng.randrange(values)) for i in range(90)]
    pairs = spark.createDataFrame(rows, "address string, rank_a long, rank_b long")
    got = graph.kendall_tau(pairs, strip=strip).first()
    assert got.n == 90 and abs(got.tau - brute_tau(rows)) < 1e-12


def test_inversions_of_larger_permutations(spark):
    import random

    rng = random.Random(5)
    n = 3000
    for order in (rng.sample(range(n), n), [(i * 7919) % n for i in range(n)], list(range(n)), list(range(n))[::-1]):
        placed = spark.createDataFrame([(i + 1, y + 1) for i, y in enumerate(order)], "x long, y long")
        want = sum(sum(a > b for a in order[:i]) for i, b in enumerate(order)) if n <= 3000 else None
        for cell in (10, 700):
            found = graph.inversions(placed, n, cell)
            assert int(found.agg(F.sum("swaps")).first()[0]) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Join" not in plan


def test_overflowing_fees_are_null(spark):
    big = 10**30
    rows = [("0x1", 1, 0, "0xa", "0xb", big, big), ("0x2", 2, 0, "0xa", "0xb", 2, 3), ("0x3", 3, 0, "0xb", "0xc", 5, 7)]
    tx = spark.createDataFrame([(*r[:5], Decimal(r[5]), Decimal(r[6]), Decimal(r[5])) for r in rows],
                               "hash string, block_number long, transaction_index int, from_address string, "
                               "to_address string, receipt_gas_used decimal(38,0), gas_price decimal(38,0), gas decimal(38,0)")
    stats = {r.address: r.total_gas for r in activity.address_stats(tx).collect()}
    assert stats == {"0xa": 6, "0xb": 35, "0xc": 0}
    edges = {r.from_address: r.gas_used for r in graph.prepare_edges(tx.where("hash <> '0x2'")).collect()}
    assert edges == {"0xa": None, "0xb": 35}


def test_tau_of_equal_and_reversed_rankings(spark):
    rows = [(f"k{i:02d}", i, -i) for i in range(30)]
    pairs = spark.createDataFrame(rows, "address string, rank_a long, rank_b long")
    same = pairs.withColumn("rank_b", F.col("rank_a"))
    assert graph.rankings_agree(same, strip=4).first()["accepted"]
    assert graph.kendall_tau(pairs, strip=4).first().tau == -1.0
    assert graph.kendall_tau(pairs, top=1).first().tau is None


# --- numbering ---------------------------------------------------------------


def test_rank_spreads_one_hot_group(spark):
    rng = random.Random(9)
    # A third of all rows in one group, and a third of the rest without a group.
    rows = [(rng.choice(["hot", None, f"g{i % 40}"]), rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = ranking.add_rank(df, [F.col("v").desc(), F.col("i").asc()], ["g"])
    want, seen = {}, {}
    for g, v, i in sorted(rows, key=lambda r: (-r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert {r.i: r["rank"] for r in got.collect()} == want
    whole = ranking.add_rank(df, [F.col("v").asc(), F.col("i").asc()])
    assert [r.i for r in whole.orderBy("rank").collect()] == [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert sorted(r["rank"] for r in whole.collect()) == list(range(1, 3001))


def test_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v int")
    assert ranking.add_rank(empty, [F.col("v").asc()], ["g"]).count() == 0


def test_small_groups_are_numbered_without_storing_their_rows(spark, monkeypatch):
    rows = [(g, i * 7 % 11, i) for g, n in (("a", 4), ("b", 30), (None, 25), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(5)
    want = {(g, i): sum((v2, i2) <= (v, i) for g2, v2, i2 in rows if g2 == g) for g, v, i in rows}
    stored, settle = [], ranking.settle
    monkeypatch.setattr(ranking, "settle", lambda x: stored.append(x.select("*")) or settle(x))
    order = [F.col("v").asc(), F.col("i").asc()]
    for most in (1000, 20, 1):
        got = ranking.add_rank(df, order, ["g"], "n", group_rows=most)
        assert got.columns == ["g", "v", "i", "n"] and dict(got.dtypes)["n"] == "bigint"
        assert {(r.g, r.i): r.n for r in got.collect()} == want
        # Of whole rows, only those of groups beyond the bound are stored on the way.
        kept = sum(x.count() for x in stored if "v" in x.columns)
        assert kept == sum(n for n in (4, 30, 25, 1) if n > most)
        stored.clear()


def test_traces_of_blocks_are_numbered_in_one_shuffle(spark, monkeypatch):
    stored, settle = [], ranking.settle
    monkeypatch.setattr(ranking, "settle", lambda x: stored.append(x.columns) or settle(x))
    traces = spark.createDataFrame([(1, 2, "b"), (1, 0, "a"), (2, 5, "c")], "block_number int, position int, trace_id string")
    assert listed(derive.arrival_index(traces), "trace_id", "trace_index") == [("a", 0), ("b", 1), ("c", 0)]
    assert all("position" not in columns for columns in stored)


def test_top_row_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = one_per_key(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert listed(one_per_key(df, ["k"], [F.col("v").desc()])) == [(0, 999), (1, 997), (2, 998)]


def test_versions_and_upsert(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, v int, t string")
    assert listed(latest_by(old, ["k"], "v")) == [("a", 2, "y"), ("b", 1, "z")]
    new = spark.createDataFrame([("b", 9, "n"), ("c", 1, "m"), ("c", 1, "m")], "k string, v int, t string")
    assert listed(upsert(latest_by(old, ["k"], "v"), new, ["k"])) == [("a", 2, "y"), ("b", 9, "n"), ("c", 1, "m")]
    assert compact(new).count() == 2


def test_sorting_table_against_sorted_lists(spark):
    rng = random.Random(4)
    rows = [(f"a{i:03d}", i, "2023-01-01", rng.randrange(9) / 1.0, rng.randrange(99), rng.random(), rng.random(),
             bool(rng.randrange(2)), rng.randrange(5)) for i in range(300)]
    df = spark.createDataFrame(rows, "address string, rank int, date string, reputation_score double, total_txn long,"
                                     "total_volume double, total_gas_spent double, is_contract boolean, degree long")
    want = set()
    for field in ranking.SORT_FIELDS:
        at = df.columns.index(field)
        want |= {r[0] for r in sorted(rows, key=lambda r: (r[at], r[0]))[:20]}
        want |= {r[0] for r in sorted(rows, key=lambda r: (-r[at], r[0]))[:20]}
    assert {r.address for r in ranking.sorting_table(df, 20).collect()} == want


def test_no_round_sorts_the_edges_again(spark):
    edges = spark.createDataFrame(random_edges(), "src string, dst string, weight double")
    _, nodes, held, _ = graph._walkable(edges, None, True, 2)
    try:
        shares = nodes.select(F.col("id").alias("src"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        plan = held.join(shares.hint("merge"), ["src", "slice"])._jdf.queryExecution().executedPlan().toString()
        edges_side = plan.split("SortMergeJoin")[1].split("InMemoryTableScan")[0]
        assert "Sort [" not in edges_side and "Exchange" not in edges_side
    finally:
        held.unpersist()
