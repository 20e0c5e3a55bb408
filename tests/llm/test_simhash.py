import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.helpers import ODD, documents

from chainlake.llm.components import components
from chainlake.llm.local_graph import merge
from chainlake.llm.queries import QUERIES
from chainlake.llm.simhash import fingerprint_links, near_duplicates, one_of_each, shingle_hashes, trie_join


def plain_fingerprint(text, size=3):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_sets(keys, linked):
    parent = list(range(len(keys)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(keys))]


def near(a, b, budget=3):
    return bin(a ^ b).count("1") <= budget


def clustered(n, seed):
    """Fingerprints in loose and dense clusters, with links across all blocks."""
    rng = np.random.default_rng(seed)
    keys = set()
    while len(keys) < n:
        base = int(rng.integers(0, 1 << 62)) * 4
        for _ in range(int(rng.integers(1, 30))):
            keys.add(base)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                base ^= 1 << int(b)
    return sorted(keys)[:n]


def same_sets(got, want):
    a, b = defaultdict(set), defaultdict(set)
    for i, (x, y) in enumerate(zip(got, want)):
        a[x].add(i), b[y].add(i)
    return sorted(map(sorted, a.values())) == sorted(map(sorted, b.values()))


def test_merge_keeps_sets_flat():
    rng = np.random.default_rng(0)
    label = np.arange(300)
    links = []
    for _ in range(20):
        a, b = rng.integers(0, 300, (2, 8))
        links += list(zip(a, b))
        merge(label, a, b)
        assert (label[label] == label).all()
    joined = {tuple(sorted(x)) for x in links}
    assert label.tolist() == plain_sets(range(300), lambda i, j: (min(i, j), max(i, j)) in joined)


@pytest.mark.parametrize("budget", [0, 1, 3])
def test_trie_against_all_pairs(budget):
    keys = np.array(clustered(400, 5), np.uint64)
    label = trie_join(np.zeros(len(keys), np.int64), keys, 0, budget, chunk=500)
    assert label.tolist() == plain_sets(keys.tolist(), lambda a, b: near(a, b, budget))
    dense = np.arange(600, dtype=np.uint64)
    assert set(trie_join(np.zeros(600, np.int64), dense, 0, 3, chunk=64)) == {0}


@pytest.mark.parametrize("cell_rows", [3, 100_000])
def test_links_and_components(spark, cell_rows):
    keys = clustered(500, 9)
    signed = np.array(keys, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(k,) for k in signed], "fp long")
    links = fingerprint_links(table, cell_rows=cell_rows)
    root = {r.node: r.root for r in components(links).collect()}
    assert same_sets([root.get(k, k) for k in signed], plain_sets(keys, near))


def test_long_chain_in_few_rounds(spark):
    links = spark.range(3000).selectExpr("id a", "id + 1 b")
    assert components(links).select("root").distinct().count() == 1
    assert components(links.limit(0)).count() == 0


def test_documents(spark):
    base = "one two three four five six seven eight nine ten eleven twelve".split() * 9
    texts = ODD + [" ".join(base)] * 4 + [" ".join(base[:-1])] + ["Word word", "wOrd  WORD", "É é x", "solo"]
    ids = list(range(len(texts) - 2)) + [7, None]
    docs = documents(spark, texts, ids=ids).withColumnRenamed("lang", "fp").withColumnRenamed("source", "root")
    got = near_duplicates(docs).collect()
    want = [plain_fingerprint(t) for t in texts]
    sets = plain_sets(want, near)
    least = {s: min(i for i, t in zip(ids, sets) if t == s and i is not None) for s in set(sets)
             if any(i is not None for i, t in zip(ids, sets) if t == s)}
    rows = sorted(((i, f"{w:016x}", least.get(s)) for i, w, s in zip(ids, want, sets)), key=repr)
    assert sorted((tuple(r)[:3] for r in got), key=repr) == rows
    groups = {}
    for r in got:
        if r.keeper:
            groups.setdefault(sets[want.index(int(r.fingerprint, 16))], set()).add((r.doc_id, r.mark))
    assert sorted(map(len, groups.values())) == [1] * len(set(sets))
    assert all((r.doc_id == r.component_id) for r in got if r.keeper)
    left = one_of_each(docs.withColumn("extra", F.lit(1)))
    assert left.columns == [*docs.columns, "extra"]
    # A set of null ids only keeps its text: nothing is lost for having no id.
    nameless = [None] * len(set(sets).difference(least))
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([*least.values(), *nameless], key=repr)
    assert near_duplicates(documents(spark, [])).count() == 0
    assert len(shingle_hashes("a b c d", 3)) == 2


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = [plain_fingerprint(d.text) for d in docs]
    sets = plain_sets(want, near)
    least = defaultdict(lambda: 1 << 60)
    for d, s in zip(docs, sets):
        least[s] = min(least[s], d.doc_id)
    got = QUERIES["op5_simhash_near_dedup"](spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted((d.doc_id, f"{w:016x}", least[s]) for d, w, s in zip(docs, want, sets))
