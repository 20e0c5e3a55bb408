from collections import defaultdict

import corpus_pipeline
import pytest
from tests.llm.helpers import documents
from tests.llm.test_simhash import near, plain_fingerprint, plain_sets
from tokenizers import Tokenizer

from chainlake.llm.queries import bpe_50k
from chainlake.session import settle

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
PASSAGE = "Which of the following rivers crosses the old town before it reaches the northern harbour of the island"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = [d.text for d in given] + ["", None, "1234 !!", given[3].text, given[3].text,
                                       f"A note. {PASSAGE} Yes.", f'Here token = "{HEX}" was set and used by the tool.']
    langs = [d.lang for d in given] + [None] * 7
    docs = documents(spark, texts, langs)
    docs.unionByName(docs.where("doc_id = 5")).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(0, PASSAGE)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, texts


def test_stages_against_plain_versions(spark, folder):
    base, texts = folder
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, base))
        if name != "packing":
            assert docs.columns == columns
        after[name] = docs.collect()
    ids = {k: [r.doc_id for r in v] for k, v in after.items()}
    n = len(texts)
    told = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    assert sorted(ids["language"]) == sorted([*told, 5])
    sets = plain_sets([plain_fingerprint(texts[i]) for i in told], near)
    least = defaultdict(lambda: n)
    for i, s in zip(told, sets):
        least[s] = min(least[s], i)
    assert sorted(ids["near_duplicates"]) == sorted(least.values())
    assert sorted(ids["decontamination"]) == sorted(i for i in least.values() if PASSAGE not in texts[i])
    assert n - 2 not in ids["decontamination"] and sorted(ids["secrets"]) == sorted(ids["decontamination"])
    clean = {r.doc_id: r for r in after["secrets"]}
    assert HEX not in clean[n - 1].text and "[SECRET]" in clean[n - 1].text
    same = [i for i, r in clean.items() if r.text == texts[i]]
    assert len(same) > 0.9 * len(clean) and all(r.n_chars == len(r.text) for r in clean.values())
    tok = Tokenizer.from_file(bpe_50k())
    total = defaultdict(int)
    for r in after["packing"]:
        total[r.doc_id] += r.length
    assert total == {i: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in clean.items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, base).collect())) == sorted(map(tuple, after["packing"]))


def test_empty_tables(spark, tmp_path):
    base = str(tmp_path)
    documents(spark, []).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    assert corpus_pipeline.run(spark, base).count() == 0
