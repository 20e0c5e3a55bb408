from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import ODD, documents

from chainlake.llm.merkle import leaf_digest, manifest, nodes

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)])


def tree(leaves, arity):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + arity]) for i in range(0, len(last), arity)])
    return levels


def way(levels, at, arity):
    out = []
    for level in levels[:-1]:
        first = at - at % arity
        out.append((level[first:at], level[at + 1:first + arity]))
        at //= arity
    return out


def plain(rows, arity):
    """Proof rows by a plain tree per language."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]], arity)
    top = tree([trees[g][-1][0] for g in names], arity)
    out = []
    for at, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            steps = way(trees[g], i, arity) + way(top, at, arity)
            own = leaf(r)
            node = own
            i_d, n = r["doc_id"], r["n_chars"]
            if i_d is not None and crc32(str(i_d).encode()) % 7 == 0 and n is not None:
                node = leaf(r | {"n_chars": n + 1})
            for before, after in steps:
                node = digest(*before, node, *after)
            proof = digest(*[x for b, a in steps for x in b + a])
            out.append((i_d, own, trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def table(spark, sizes):
    texts = [ODD[i % len(ODD)] for i in range(sum(sizes.values()))]
    langs = [g for g, n in sizes.items() for _ in range(n)]
    ids = list(range(len(texts)))[::-1]
    ids[3:6] = [None, 9, 9]
    return documents(spark, texts, langs, ids=ids)


@pytest.mark.parametrize("sizes, arity, band", [
    ({"en": 23, None: 9, "é": 1, "": 2, "-": 4, "=": 3}, 2, 2),
    ({"a": 28, "b": 1, "c": 10}, 3, 2), ({"x": 1, "y": 300}, 2, 8)])
def test_against_plain_trees(spark, sizes, arity, band):
    docs = table(spark, sizes)
    docs = docs.unionByName(docs.where("doc_id = 5")).withColumn("digest", F.lit(1)).withColumn("shown", F.lit("x"))
    tampered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_digest(*tampered))
    got = manifest(docs, FIELDS, arity=arity, band=band, shown=shown)
    assert sorted(map(tuple, got.collect()), key=repr) == plain([r.asDict() for r in docs.collect()], arity)


def test_paths_fold_up_to_the_root(spark):
    docs = table(spark, {"en": 21, "de": 4})
    for r in manifest(docs, FIELDS, paths=True, band=2).collect():
        node = r.leaf
        for step in r.path:
            node = digest(step.before, node, step.after)
        assert node == r.root and r.verified


def test_nodes_nest(spark):
    rows = nodes(table(spark, {"en": 21, "de": 4, None: 1}), FIELDS, band=2).collect()
    known = {(r.grp, r.level, r.lo): r for r in rows}
    assert len(known) == len(rows) and {r.grp for r in rows} == {"=en", "=de", "-", ""}
    assert sum(r.level == 0 for r in rows) == 26 + 3
    for r in rows:
        under = [c for c in rows if c.grp == r.grp and c.level == r.level - 1 and r.lo <= c.lo and c.hi <= r.hi]
        if r.level:
            assert r.digest == digest(*[c.digest for c in sorted(under, key=lambda c: c.lo)])


def test_empty(spark):
    assert manifest(documents(spark, []), FIELDS).count() == 0
    assert nodes(documents(spark, []), FIELDS).count() == 0
