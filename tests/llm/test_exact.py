import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import ODD, documents

from chainlake.llm import exact_dedup
from chainlake.llm.exact_dedup import deduplicate, heavy_hitters, mark_duplicates


def plain(ids, texts):
    """(doc_id, keep_id, group_size, kept, sha) of each row, by a dictionary of whole texts."""
    groups = defaultdict(list)
    for i, t in zip(ids, texts):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for text, members in groups.items():
        members.sort(key=lambda i: (i is None, i))
        out += [(i, members[0], len(members), at == 0, sha256(text.encode()).hexdigest())
                for at, i in enumerate(members)]
    return sorted(out, key=repr)


def table(spark):
    texts = ODD + ["one  copy", "one copy", "one\tcopy", "other", None, ""] + ["hot text"] * 400 + ["tie"] * 3
    texts += [f"pair {i // 2}" for i in range(300)] + ["long " * 200_000, "long\n" * 200_000]
    ids = list(range(len(texts)))
    at = texts.index("tie")
    ids[at:at + 3] = [7, 7, None]
    ids[at + 3:at + 5] = [None, None]
    return ids, texts, documents(spark, texts, ids=ids)


@pytest.mark.parametrize("capacity", [8, exact_dedup.CAPACITY])
def test_against_dictionary(spark, capacity):
    ids, texts, docs = table(spark)
    docs = docs.withColumnsRenamed({"lang": "sha", "source": "first", "n_chars": "mark"})
    got = mark_duplicates(docs, capacity)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(ids, texts)


def test_heavy_digests_are_found(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("x"))
    assert "hot" in {r.x for r in heavy_hitters(rows, "x", 64).collect()}


def test_a_hot_group_is_not_shuffled(spark):
    _, _, docs = table(spark)
    plan = mark_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan


def test_kept_rows_are_whole(spark):
    ids, texts, docs = table(spark)
    extra = docs.withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id"))).withColumn("__s", F.lit(1))
    left = deduplicate(extra.unionByName(extra.where("doc_id = 5")))
    assert left.columns == extra.columns
    want = sorted((r[0] for r in plain(ids, texts) if r[3]), key=repr)
    rows = left.collect()
    assert sorted((r.doc_id for r in rows), key=repr) == want
    assert all(r.text in texts and r.tags == {"a": r.doc_id} for r in rows)


def test_empty(spark):
    assert mark_duplicates(documents(spark, [])).count() == 0
    assert deduplicate(documents(spark, [])).count() == 0
