import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import ODD, documents
from tokenizers import Tokenizer

from chainlake.llm.packing import best_fit, pack
from chainlake.llm.queries import bpe_50k
from chainlake.llm.token_counts import count_tokens
from chainlake.llm.words import WordEncoder, sent_tokens, whole_tokens


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(bpe_50k())


@pytest.fixture(scope="module")
def proven():
    return whole_tokens(bpe_50k())


def want(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def noise(n, seed):
    rng = random.Random(seed)
    marks = [" ", "  ", "\n", "\t", "a", "the", "é", "'s", "!", "7", "日", " ", "<|endoftext|>", "ß", "\x1c"]
    return ["".join(rng.choices(marks, k=rng.randint(0, 40))) for _ in range(n)]


def test_proven_strings_are_one_token(tok, proven):
    assert len(proven) > 40_000
    assert all(want(tok, s) == [i] for s, i in list(proven.items())[::997])


def test_ids_equal_the_library(tok, proven):
    words = ["Straße", "naïve.", "x\ny", "ab.\ncd!", "a.\n\nb", "it's", "word))", "(word", "ﬁne", "\x00a", "a\x01", "don't."]
    texts = [t or "" for t in ODD] + noise(3000, 1) + [" ".join(words), *words, *[f"a {w} b" for w in words]]
    coder = WordEncoder(bpe_50k(), proven)
    for at in (0, 7):
        got = coder.encode(pa.array(texts)[at:])
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == [want(tok, t) for t in texts[at:]]
    assert coder.counts(pa.array(texts)).tolist() == [len(want(tok, t)) for t in texts]
    assert coder.encode(pa.array([], pa.string())) == [] and len(coder.counts(pa.array([], pa.string()))) == 0


def test_whole_texts_of_the_given_table(spark, tok, proven):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["".join(texts)[:1_500_000], "word " * 300_000, "x" * 20_000 + " y"]
    got = WordEncoder(bpe_50k(), proven).encode(pa.array(texts))
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [want(tok, t) for t in texts]


def test_counts(spark, tok):
    texts = ODD + noise(50, 2)
    docs = documents(spark, texts).withColumnsRenamed({"lang": "n_tokens", "source": "over_limit"})
    got = {r.doc_id: r for r in count_tokens(docs, bpe_50k(), 100).collect()}
    for i, t in enumerate(texts):
        n = len(want(tok, t))
        assert got[i][1:] == (len((t or "").encode()), n, n > 100)
    assert count_tokens(documents(spark, []), bpe_50k()).count() == 0


def test_best_fit_against_plain_search():
    rng = np.random.default_rng(3)
    lengths = -np.sort(-rng.integers(1, 65, 2000))
    number, offset = best_fit(lengths, 64)
    room = []
    for need, n, o in zip(lengths, number, offset):
        fits = [c for c in room if c >= need]
        if not fits:
            room.append(64)
            fits = [64]
        assert room[n] == min(fits) and o == 64 - room[n]
        room[n] -= need
    assert len(room) <= 1.02 * lengths.sum() / 64 + 1


@pytest.mark.parametrize("shard_rows", [7, 60_000])
def test_packing_is_a_partition(spark, tok, shard_rows):
    texts = ODD + noise(60, 4) + ["same text here"] * 9
    ids = list(range(len(texts) - 3)) + [0, 0, None]
    docs = documents(spark, texts, ids=ids).withColumnRenamed("lang", "offset")
    rows = pack(docs, bpe_50k(), window=256, shard_rows=shard_rows, keep_ids=True).collect()
    whole = defaultdict(list)
    windows = defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length and crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        whole[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    for i, t in zip(ids, texts):
        if i not in (0, None):
            ordered = sorted(whole[i])
            assert [x for p in ordered for x in p[1]] == want(tok, t) + [1]
            assert {p[2] for p in ordered} == {len(want(tok, t)) + 1}
    assert len(whole[0]) == 3 and sum(r.length for r in rows) == sum(len(want(tok, t)) + 1 for t in texts)
    assert pack(documents(spark, []), bpe_50k()).count() == 0


def test_only_remainders_are_dealt(spark):
    docs = documents(spark, ["many words here " * 20_000] * 6 + ["tail"] * 3)
    docs = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    rows = pack(docs, bpe_50k(), window=128, shard_rows=2).collect()
    full = [r for r in rows if r.length == 128]
    assert len(full) > 2000 and len({r.sequence_id for r in full}) == len(full)
    assert {r.sequence_id for r in full}.isdisjoint(r.sequence_id for r in rows if r.length < 128)
    assert len({r.sequence_id >> 40 for r in rows if r.length < 128}) >= 3


def test_the_driver_never_loads_the_library(spark, proven, monkeypatch):
    import tokenizers

    docs = documents(spark, ["the house of 12 wolves", None, "x"])
    monkeypatch.setattr(tokenizers, "Tokenizer", None)
    assert sent_tokens(spark, bpe_50k()).value == proven
    assert count_tokens(docs, bpe_50k()).count() == 3
    assert pack(docs, bpe_50k()).count() == 3
