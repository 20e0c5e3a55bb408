"""Merkle dataset manifest (operator 12): nested-interval labels and bucketed containment joins.

Every node of a tree is labelled with the interval [lo, hi) of leaf ranks it covers. An ancestor of a
leaf is a node whose interval holds the leaf's rank, and the siblings met on the way up are what
remains of the parent's interval without the node's own. Levels are taken a band at a time: a node
and all its ancestors inside a band fall into one bucket of ranks, so one join a band attaches them.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.operators.ranking import add_rank
from chainlake.session import settle, small

PATH = "array<struct<before:string,after:string>>"
ALL = ""  # the tree above all groups; group names are never empty


def field(col: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value."""
    text = col.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*cols: Column) -> Column:
    """SHA-256 (lowercase hex) of the given fields, in order."""
    return F.sha2(F.concat(*map(field, cols)), 256)


def _hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _climb(lo: np.ndarray, hi: np.ndarray, digest: list[str], arity: int, steps: int | None) -> list[tuple]:
    """(lo, hi, digest) of every level above the given one: `steps` levels, or up to a single node."""
    levels = []
    while len(digest) > 1 if steps is None else len(levels) < steps:
        digest = [_hash(*digest[i:i + arity]) for i in range(0, len(digest), arity)]
        lo, hi = lo[::arity], np.append(hi[arity - 1:-1:arity], hi[-1])
        levels.append((lo, hi, digest))
    return levels


def _ways(levels: list[tuple]) -> list[list[tuple[str, str]]]:
    """For each node of the lowest level, the digests before and after it at each step up."""
    lo, _, digest = levels[0]
    out: list[list[tuple[str, str]]] = [[] for _ in digest]
    for (los, his, digests), (parent_los, parent_his, _) in zip(levels, levels[1:]):
        own = np.searchsorted(los, lo, "right") - 1
        parent = np.searchsorted(parent_los, los, "right") - 1
        # What the parent covers before and after the node's own interval.
        first = np.searchsorted(los, parent_los[parent], "left")
        last = np.searchsorted(los, parent_his[parent], "left")
        ends = [("".join(digests[a:i]), "".join(digests[i + 1:b])) for i, (a, b) in enumerate(zip(first, last))]
        for way, i in zip(out, own.tolist()):
            way.append(ends[i])
    return out


@dataclass
class Forest:
    """Trees over ranked members: per band the members (grp, lo, n, digest, ...) and the nodes above them."""

    arity: int
    band: int
    members: list[DataFrame]
    nodes: list[DataFrame]

    def width(self, tier: int) -> int:
        return self.arity ** (self.band * tier)

    def bucket(self, tier: int, at: str = "lo") -> Column:
        """Bucket of a rank in a band: the node at the band's top that covers it."""
        return F.call_function("div", F.col(at), F.lit(self.width(tier + 1))).alias("bucket")

    def tops(self) -> DataFrame:
        """(grp, digest) of the last node of every tree."""
        found = [n.where(F.col("top") & (F.col("n") <= self.width(t + 1))) for t, n in enumerate(self.nodes)]
        found += [self.members[0].where("n = 1")]
        tops = found[0].select("grp", "digest")
        for f in found[1:]:
            tops = tops.unionByName(f.select("grp", "digest"))
        return tops


def grow(members: DataFrame, arity: int, band: int) -> Forest:
    """Trees over members (grp, lo = rank from 0, n = size of the group, digest), a band at a time.

    A task holds the `arity ** band` members of one bucket. Each band is a table in the shared folder.
    """
    import pyarrow as pa

    forest = Forest(arity, band, [members], [])
    most = members.agg(F.max("n")).first()[0] or 0

    def up(tier: int, width: int, above: int):
        def run(table: pa.Table) -> pa.Table:
            got = table.sort_by("lo")
            lo, n = got["lo"].to_numpy(), got["n"][0].as_py()
            hi = np.minimum(lo + width, n)
            whole = n <= above
            levels = _climb(lo, hi, got["digest"].to_pylist(), arity, None if whole else band)
            cols = [(step, *node, i == len(levels)) for i, (los, his, ds) in enumerate(levels, 1)
                    for step, node in ((i, x) for x in zip(los.tolist(), his.tolist(), ds))]
            level, lo, hi, digest, top = map(list, zip(*cols)) if cols else ([], [], [], [], [])
            return pa.table({"grp": pa.array([got["grp"][0].as_py()] * len(cols), pa.string()),
                             "level": pa.array([tier * band + x for x in level], pa.int32()),
                             "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64()),
                             "n": pa.array([n] * len(cols), pa.int64()), "digest": pa.array(digest, pa.string()),
                             "top": pa.array(top, pa.bool_())})
        return run

    schema = "grp string, level int, lo long, hi long, n long, digest string, top boolean"
    tier = 0
    while most > forest.width(tier):
        open_ = forest.members[tier].where(F.col("n") > 1).select("grp", "lo", "n", "digest", forest.bucket(tier))
        run = up(tier, forest.width(tier), forest.width(tier + 1))
        nodes = settle(open_.groupBy("grp", "bucket").applyInArrow(run, schema))
        forest.nodes.append(nodes)
        tier += 1
        forest.members.append(nodes.where(F.col("top") & (F.col("n") > forest.width(tier)))
                              .select("grp", "lo", "n", "digest"))
    return forest


def _join_bands(forest: Forest, tier: int, upper: DataFrame, finish, schema: str, keep: list[str]) -> DataFrame:
    """`finish(member columns, way up)` of every member of a band, from its bucket's nodes and its way above."""
    import pyarrow as pa

    members = forest.members[tier].select("grp", "lo", "n", "digest", *keep, forest.bucket(tier))
    empty = F.lit(None)
    above = upper.select("grp", "bucket", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("lo"),
                         F.lit(0).cast("long").alias("hi"), empty.cast("string").alias("digest"), "path",
                         "subroot", "root")
    if tier < len(forest.nodes):
        own = forest.nodes[tier].select(
            "grp", forest.bucket(tier), "level", "lo", "hi", "digest", empty.cast(PATH).alias("path"),
            empty.cast("string").alias("subroot"), empty.cast("string").alias("root"))
        above = above.unionByName(own)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.sort_by("lo"), right.sort_by([("level", "ascending"), ("lo", "ascending")])
        level = right["level"].to_numpy()
        top = right.slice(0, 1).to_pylist()[0]
        after = [(p["before"], p["after"]) for p in top["path"]]
        lo = left["lo"].to_numpy()
        levels = [(lo, lo + 1, left["digest"].to_pylist())]
        for x in np.unique(level[level >= 0]):
            part = right.slice(int(np.searchsorted(level, x)), int((level == x).sum()))
            levels.append((part["lo"].to_numpy(), part["hi"].to_numpy(), part["digest"].to_pylist()))
        return finish(left, [way + after for way in _ways(levels)], top["subroot"], top["root"])

    # Both sides can stem from one table: other names keep the keys apart.
    above = above.withColumnsRenamed({"grp": "at_grp", "bucket": "at_bucket"})
    return members.groupBy("grp", "bucket").cogroup(above.groupBy("at_grp", "at_bucket")).applyInArrow(run, schema)


def _descend(forest: Forest, crowns: DataFrame, last, schema: str, keep: list[str]) -> DataFrame:
    """Hand ways down from the trees' last nodes (crowns: grp, path, subroot, root) to the lowest members.

    A band of bucket size 256 is one join; what is handed on between bands is one way a bucket.
    """
    import pyarrow as pa

    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def middle(left, ways, subroot, root):
        path = [[{"before": a, "after": b} for a, b in way] for way in ways]
        n = len(path)
        return pa.table({"grp": left["grp"], "lo": left["lo"], "path": pa.array(path, kind),
                         "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string())})

    passed = None
    for tier in range(max(len(forest.nodes), 1) - 1, -1, -1):
        # Trees that end within this band get their way from the crown, others from the band above.
        low, high = (0 if tier == 0 else forest.width(tier)), forest.width(tier + 1)
        ending = forest.members[tier].where((F.col("lo") == 0) & (F.col("n") > low) & (F.col("n") <= high))
        upper = crowns.join(ending.select("grp"), "grp", "left_semi").select(
            "grp", F.lit(0).cast("long").alias("bucket"), "path", "subroot", "root")
        if passed is not None:
            upper = upper.unionByName(passed.select("grp", forest.bucket(tier), "path", "subroot", "root"))
        if tier == 0:
            return _join_bands(forest, 0, upper, last, schema, keep)
        passed = settle(_join_bands(forest, tier, upper, middle,
                                    f"grp string, lo long, path {PATH}, subroot string, root string", []))


def manifest(docs: DataFrame, fields: list[str], group_col: str = "lang", id_col: str = "doc_id", arity: int = 2,
             band: int = 8, shown: Column | None = None, paths: bool = False) -> DataFrame:
    """Leaf, roots and proof of every row: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is `leaf_digest` of `fields`. Leaves of one `group_col` value ascend by id (null ids first,
    then by leaf); every `arity` consecutive nodes, or the fewer that are left, become one by hashing, up
    to the group's subroot; subroots, null first, then by UTF-8 bytes, become the root likewise.
    proof_sha256 hashes the siblings from leaf to root. `shown` is the leaf somebody shows for a row (null:
    its own); folded_root is what it folds up to with the original siblings, and verified whether that is
    the root. With `paths` the proof itself comes along (array of the digests before and after, by level).

    Repeated rows are leaves of their own. Null and empty texts give different leaves. Extra columns are
    ignored, whatever their names; an empty table gives no rows. `nodes(...)` gives the stored trees.

    Ranks come from a range shuffle, so a group of any size spreads; a task holds one bucket of
    `arity ** band` leaves, the nodes above it and one way up.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    forest, crown_forest, crowns = _plant(docs, fields, group_col, id_col, arity, band, shown)
    list_kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def last(left, ways, subroot, root):
        proof, folded = [], []
        for way, leaf, claim in zip(ways, left["digest"].to_pylist(), left["shown"].to_pylist()):
            proof.append(_hash(*[x for pair in way for x in pair]))
            digest = leaf if claim is None else claim
            for before, after in way:
                digest = _hash(before, digest, after)
            folded.append(digest)
        n = len(proof)
        cols = {"id": left["id"], "leaf": left["digest"], "subroot": pa.array([subroot] * n, pa.string()),
                "root": pa.array([root] * n, pa.string()), "proof_sha256": pa.array(proof, pa.string()),
                "folded_root": pa.array(folded, pa.string())}
        if paths:
            cols["path"] = pa.array([[{"before": a, "after": b} for a, b in way] for way in ways], list_kind)
        return pa.table(cols)

    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    found = _descend(forest, crowns, last, schema + (f", path {PATH}" if paths else ""), ["id", "shown"])
    found = found.withColumn("verified", F.col("folded_root") == F.col("root"))
    return found.withColumnRenamed("id", id_col)


def _plant(docs, fields, group_col, id_col, arity, band, shown):
    """The groups' trees, the tree over them, and every group's way to the root."""
    import pyarrow as pa

    group = F.when(F.col(group_col).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(group_col).cast("string")))
    leaves = settle(docs.select(
        group.alias("grp"), F.col(id_col).alias("id"), leaf_digest(*[F.col(c) for c in fields]).alias("digest"),
        (F.lit(None).cast("string") if shown is None else shown).alias("shown"),
    ).withColumn("mark", F.monotonically_increasing_id()))
    order = [F.col("id").asc_nulls_first(), F.col("digest"), F.col("mark")]
    ranked = add_rank(leaves, order, ["grp"], "rank")
    sizes = settle(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    members = settle(ranked.join(small(sizes), "grp").select(
        "grp", (F.col("rank") - 1).alias("lo"), "n", "digest", "id", "shown"))
    forest = grow(members, arity, band)
    tops = settle(forest.tops())
    # "-" sorts before "=", so the null group comes first; the rest in byte order.
    placed = add_rank(tops, [F.col("grp")], name="rank")
    top_members = settle(placed.select(F.lit(ALL).alias("grp"), (F.col("rank") - 1).alias("lo"),
                                       F.lit(tops.count()).cast("long").alias("n"), "digest",
                                       F.col("grp").alias("name")))
    crown_forest = grow(top_members, arity, band)
    root = crown_forest.tops().select("grp", F.array().cast(PATH).alias("path"), F.col("digest").alias("subroot"),
                                      F.col("digest").alias("root"))

    def crown(left, ways, _, root):
        path = [[{"before": a, "after": b} for a, b in way] for way in ways]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table({"grp": left["name"], "path": pa.array(path, kind), "subroot": left["digest"],
                         "root": pa.array([root] * len(path), pa.string())})

    crowns = settle(_descend(crown_forest, root, crown, f"grp string, path {PATH}, subroot string, root string",
                             ["name"]))
    return forest, crown_forest, crowns


def nodes(docs: DataFrame, fields: list[str], group_col: str = "lang", id_col: str = "doc_id", arity: int = 2,
          band: int = 8) -> DataFrame:
    """The stored trees: grp, level, lo, hi, digest of every node.

    A group's name is `-` for null and `=` with the value otherwise, the tree above all groups is "". Level 0
    are the leaves; [lo, hi) are the ranks of the leaves (of the groups, in the upper tree) a node covers.
    An empty table gives no rows.
    """
    forest, crown_forest, _ = _plant(docs, fields, group_col, id_col, arity, band, None)
    out = None
    for trees in (forest, crown_forest):
        leaves = trees.members[0].select("grp", F.lit(0).alias("level"), "lo", (F.col("lo") + 1).alias("hi"), "digest")
        for table in (leaves, *trees.nodes):
            part = table.select("grp", "level", "lo", "hi", "digest")
            out = part if out is None else out.unionByName(part)
    return out
