"""Graph preparation, PageRank with fixed rounds, agreement of rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.operators import joins, ranking
from chainlake.plans import graph
from chainlake.registry.base import query, rounded

ZERO = "'0x0000000000000000000000000000000000000000'"
DEAD = "'0x000000000000000000000000000000000000dead'"

EDGES_CTE = f"""
    pairs as (
      select * from (select hash, block_number, transaction_index, from_address, to_address,
          gas * gas_price as gas_used, row_number() over (partition by from_address, to_address
            order by block_number desc, transaction_index desc, hash desc) as rn
        from {{transactions}}
        where from_address <> to_address and from_address not in ({ZERO}, {DEAD})) where rn = 1),
    aged as (select *, cast(trunc((block_number - (select min(block_number) from pairs)) / 28800.0 - 90) as int)
      as block_date from pairs),
    edges as (select from_address as src, to_address as dst, hash, block_date, gas_used,
      1.0 / (1.0 + exp(-block_date / 64.0)) as weight from aged)"""
VERTEX_CTE = """
    ids as (select src as id from edges union select dst from edges)"""


def edges(t):
    return graph.prepare_edges(t.transactions, mode="days")


@query("g01_prepare_edges", f"""
    with {EDGES_CTE.strip()}
    select hash, src as from_address, dst as to_address, block_date, round(weight, 12) as age_weight from edges""")
def _(t):
    return rounded(edges(t).select("hash", "from_address", "to_address", "block_date", "age_weight"), 12, "age_weight")


@query("d05_vertices", f"with {EDGES_CTE.strip()}, {VERTEX_CTE.strip()} select id from ids")
def _(t):
    return graph.vertices(graph.graph_edges(edges(t)))


@query("a18_personalisation", f"""
    with {EDGES_CTE.strip()}
    select dst as id, round(sum(weight) / (select sum(weight) from edges), 12) as weight from edges group by 1""")
def _(t):
    return rounded(graph.personalisation(graph.graph_edges(edges(t))), 12, "weight")


@query("g02_weighted_vertices", f"""
    with {EDGES_CTE.strip()}, {VERTEX_CTE.strip()},
    p as (select dst as id, sum(weight) / (select sum(weight) from edges) as weight from edges group by 1)
    select ids.id, round(coalesce(weight, 0.0), 12) as weight from ids left join p on ids.id = p.id""")
def _(t):
    return rounded(graph.weighted_vertices(graph.graph_edges(edges(t))), 12, "weight")


@query("j23_with_weights", f"""
    with {EDGES_CTE.strip()}, {VERTEX_CTE.strip()},
    p as (select dst as id, cast(count(*) as double) as weight from edges group by 1)
    select ids.id, coalesce(weight, 0.0) as weight from ids left join p on ids.id = p.id""")
def _(t):
    e = graph.graph_edges(edges(t))
    weights = e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return joins.with_weights(graph.vertices(e), weights)


DEGREE_CTE = """
    deg as (select id, cast(sum(i) as bigint) as in_degree, cast(sum(o) as bigint) as out_degree from (
      select src as id, 0 as i, 1 as o from edges union all select dst, 1, 0 from edges) group by 1)"""


@query("a14_degrees", f"""
    with {EDGES_CTE.strip()}, {DEGREE_CTE.strip()}
    select id, in_degree, out_degree,
      case when in_degree > 0 and out_degree > 0 then in_degree + out_degree else 0 end as total_degree from deg""")
def _(t):
    return graph.degrees(graph.graph_edges(edges(t)))


@query("g03_degrees_filled", f"""
    with {EDGES_CTE.strip()}, {DEGREE_CTE.strip()}
    select id, in_degree, out_degree, in_degree + out_degree as total_degree from deg""")
def _(t):
    return graph.degrees(graph.graph_edges(edges(t)), fill_missing=True)


@query("g09_graph_size", f"""
    with {EDGES_CTE.strip()}, {VERTEX_CTE.strip()}
    select (select count(*) from ids) as num_vertices, (select count(*) from edges) as num_edges""")
def _(t):
    return graph.graph_size(graph.graph_edges(edges(t)))


@query("g10_repeat_weight", """
    with clean as (select * from {transactions} where from_address <> to_address),
    pairs as (select from_address as src, to_address as dst, count(*) as repeats, max(block_number) as block_number
      from clean group by 1, 2),
    aged as (select *, cast(trunc((block_number - (select min(block_number) from clean) - 90) / 28800.0) as int) as d from pairs)
    select src, dst, repeats, round(repeats / (1.0 + exp(-d / 64.0)), 12) as weight from aged""")
def _(t):
    return rounded(graph.repeat_weight(t.transactions), 12, "weight").drop("block_number")


def rank_sql(alpha: float, weight: str, personal: bool, rounds: int) -> str:
    """The same power iteration, one CTE per round."""
    jump = ("select dst as id, sum(weight) / (select sum(weight) from edges) as j from edges group by 1"
            if personal else "select id, 1.0 / (select count(*) from ids) as j from ids")
    text = f"""with {EDGES_CTE.strip()}, {VERTEX_CTE.strip()},
    jumps as ({jump}),
    outs as (select src as id, sum({weight}) as total from edges group by 1),
    nodes as (select ids.id, coalesce(j, 0.0) as j, total from ids left join jumps on jumps.id = ids.id
      left join outs on outs.id = ids.id),
    r0 as (select id, j, total, 1.0 / (select count(*) from ids) as score from nodes)"""
    for i in range(1, rounds + 1):
        p = f"r{i - 1}"
        text += f""",
    r{i} as (select n.id, n.j, n.total,
      {alpha} * (coalesce(g.gain, 0.0) + coalesce((select sum(score) from {p} where total is null), 0.0) * n.j)
        + {1 - alpha} * n.j as score
      from {p} n left join (select e.dst as id, sum(s.score / s.total * {weight}) as gain
        from edges e join {p} s on s.id = e.src group by 1) g on g.id = n.id)"""
    return text


@query("g04_pagerank", rank_sql(0.85, "1.0", False, 5) + """
    select id, round(score * (select count(*) from ids), 8) as score from r5""")
def _(t):
    e = graph.graph_edges(edges(t))
    scores = graph.pagerank(e, alpha=0.85, weighted=False, max_iter=5, tol=None)
    count = graph.vertices(e).agg(F.count(F.lit(1))).scalar()
    return scores.select("id", F.round(F.col("score") * count, 8).alias("score"))


@query("g05_pagerank_personalised", rank_sql(0.5, "weight", True, 5) + """
    select id, round(score, 10) as score from r5""")
def _(t):
    e = graph.graph_edges(edges(t))
    scores = graph.pagerank(e, alpha=0.5, personal=graph.personalisation(e), max_iter=5, tol=None)
    return rounded(scores, 10, "score")


@query("g05_pagerank_converged", f"""
    with {EDGES_CTE.strip()},
    jumps as (select dst as id, sum(weight) / (select sum(weight) from edges) as j from edges group by 1),
    steps as (select src, dst, weight / sum(weight) over (partition by src) as share from edges),
    walks as (with recursive r as (
      select 0 as round, id, 0.5 * j as part from jumps
      union all
      select r.round + 1, s.dst, sum(0.5 * r.part * s.share) from r join steps s on s.src = r.id
      where r.round < 60 group by 1, 2) select * from r),
    ids as (select src as id from edges union select dst from edges)
    select ids.id, round(coalesce(sum(part), 0.0) / (select sum(part) from walks), 8) as score
    from ids left join walks on walks.id = ids.id group by 1""")
def _(t):
    e = graph.graph_edges(edges(t))
    scores = graph.pagerank_push(e, alpha=0.5, personal=graph.personalisation(e), tol=1e-10)
    return rounded(scores, 8, "score")


@query("g06_scaled_ranking", """
    select address, reputation_score * 1000000 as score,
      row_number() over (order by reputation_score desc, address) as rank from (
      select address, max(reputation_score) as reputation_score from {scores} group by 1)""")
def _(t):
    best = t.scores.groupBy(F.col("address").alias("id")).agg(F.max("reputation_score").alias("score"))
    return graph.scaled_ranking(best)


@query("w06_global_ranking", """
    select address, row_number() over (order by total_volume desc, address) as rank from (
      select address, max(total_volume) as total_volume from {scores} group by 1)""")
def _(t):
    best = t.scores.groupBy("address").agg(F.max("total_volume").alias("v"))
    return ranking.add_rank(best, [F.col("v").desc(), F.col("address").asc()]).select("address", "rank")


METRICS_SQL = f"""
    with {EDGES_CTE.strip()}, {VERTEX_CTE.strip()}, {DEGREE_CTE.strip()},
    sent as (select src as id, sum(gas_used) as total_gas, count(*) as n from edges group by 1),
    got as (select dst as id, count(*) as n from edges group by 1)
    select ids.id as address, cast(coalesce(sent.total_gas, 0) as string) as total_gas,
      coalesce(sent.n, 0) as total_transfer, coalesce(got.n, 0) as total_receive, in_degree, out_degree
    from ids left join sent on sent.id = ids.id left join got on got.id = ids.id left join deg on deg.id = ids.id"""


@query("g07_reputation_table", METRICS_SQL)
def _(t):
    e = edges(t)
    scores = graph.vertices(graph.graph_edges(e)).withColumn("score", F.lit(0.5))
    return graph.reputation_table(scores, e).select(
        "address", F.col("total_gas").cast("string").alias("total_gas"), "total_transfer", "total_receive",
        "in_degree", "out_degree")


@query("j24_combine_metrics", METRICS_SQL)
def _(t):
    e = edges(t)
    sent, received = graph.gas_and_counts(e)
    shape = graph.degrees(graph.graph_edges(e)).withColumnRenamed("id", "address").drop("total_degree")
    base = graph.vertices(graph.graph_edges(e)).withColumnRenamed("id", "address")
    merged = joins.combine_metrics(base, sent, received, shape).fillna(0)
    return merged.withColumn("total_gas", F.col("total_gas").cast("string"))


RANKS_CTE = """
    last as (select * from {scores} where snapshot_block_number = (select max(snapshot_block_number) from {scores})),
    a as (select address, rank as rank_a from last),
    b as (select address, row_number() over (order by total_volume desc, address) as rank_b from last)"""


def two_rankings(t):
    last = t.scores.where(F.col("snapshot_block_number") == t.scores.agg(F.max("snapshot_block_number")).scalar())
    a = last.select("address", "rank", F.col("reputation_score").alias("score"))
    slim = last.select("address", F.col("total_volume").alias("score"))
    b = ranking.add_rank(slim, [F.col("score").desc(), F.col("address").asc()])
    return joins.compare_scores(a, b)


@query("j27_compare_scores", f"""
    with {RANKS_CTE.strip()} select a.address, rank_a, rank_b from a join b on a.address = b.address""")
def _(t):
    return two_rankings(t).select("address", "rank_a", "rank_b")


TAU_SQL = """
    with {ctes}, m as (select a.address, rank_a, rank_b from a join b on a.address = b.address {top}),
    s as (select count(*) as pairs,
        sum(sign(x.rank_a - y.rank_a) * sign(x.rank_b - y.rank_b)) as agree,
        sum(case when x.rank_a = y.rank_a then 1 else 0 end) as t1,
        sum(case when x.rank_b = y.rank_b then 1 else 0 end) as t2
      from m x join m y on x.address < y.address)
    select (select count(*) from m) as n,
      round(agree / sqrt(cast(pairs - t1 as double) * (pairs - t2)), 12) as tau{more} from s"""


@query("g08_kendall_tau", TAU_SQL.replace("{ctes}", RANKS_CTE.strip()).replace("{top}", "").replace("{more}", ""))
def _(t):
    return rounded(graph.kendall_tau(two_rankings(t)), 12, "tau")


@query("g08_kendall_tau_top100", TAU_SQL.replace("{ctes}", RANKS_CTE.strip())
       .replace("{top}", "order by rank_a, a.address limit 100").replace("{more}", ""))
def _(t):
    return rounded(graph.kendall_tau(two_rankings(t), top=100), 12, "tau")


@query("q07_rankings_agree", TAU_SQL.replace("{ctes}", RANKS_CTE.strip()).replace("{top}", "").replace(
    "{more}", ", agree / sqrt(cast(pairs - t1 as double) * (pairs - t2)) > 0.9 as accepted"))
def _(t):
    # A strip far below the default, so that the strip grid is at work here too.
    return rounded(graph.rankings_agree(two_rankings(t), strip=100), 12, "tau")
