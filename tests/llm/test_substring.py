import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from tests.llm.helpers import ODD, documents

from chainlake.llm.fm_index import FMIndex, repeated_windows
from chainlake.llm.substring_dedup import anchored_runs, remove_repeats, repeated_spans


def plain(texts, window):
    """(n_words, n_removed, kept) of each text, by counting all windows."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), sha256(kept).hexdigest()))
    return out


def corpus(seed, window, docs=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "日本"]
    passages = [rng.choices(vocab, k=rng.randint(window - 3, 3 * window)) for _ in range(6)]
    texts = []
    for _ in range(docs):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.4 else rng.choices(vocab, k=rng.randint(1, window))
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in words))
    periodic = " ".join(["a", "b", "c"] * window)
    return texts + [texts[0], texts[0], "same " * (window + 5), periodic, "x " * window, "x " * (window - 1)]


def test_backward_search_counts():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 5, 400), 0)
    index = FMIndex(text, 16)
    for _ in range(200):
        pattern = rng.integers(1, 5, rng.integers(1, 9))
        low, high = np.array([0]), np.array([len(text)])
        for c in pattern[::-1]:
            low, high = index.step(np.array([c]), low, high)
        want = sum((text[i:i + len(pattern)] == pattern).all() for i in range(len(text) - len(pattern)))
        assert high[0] - low[0] == want


@pytest.mark.parametrize("seed", range(25))
def test_repeated_windows(seed):
    rng = np.random.default_rng(seed)
    window, kinds = int(rng.integers(2, 9)), int(rng.integers(1, 6))
    pieces = {tuple(rng.integers(1, kinds + 1, rng.integers(window - 1, window + 25))) for _ in range(30)}
    pieces = [np.array(p, np.int64) for p in pieces]
    weights = rng.choice([1, 1, 1, 2], len(pieces))
    seen = Counter()
    for p, w in zip(pieces, weights):
        seen.update({tuple(p[i:i + window]): 0 for i in range(len(p) - window + 1)})
        for i in range(len(p) - window + 1):
            seen[tuple(p[i:i + window])] += int(w)
    for p, got in zip(pieces, repeated_windows(pieces, weights, window)):
        assert got.tolist() == [seen[tuple(p[i:i + window])] > 1 for i in range(len(p) - window + 1)]


def test_runs_hold_every_window_once_and_agree_on_keys():
    texts = [t.encode() for t in corpus(3, 10)]
    doc, start, count, key = anchored_runs(texts, 10, 4)
    keys = {}
    places = []
    for d, s, c, k in zip(doc, start, count, key):
        words = texts[d].split()
        assert c <= 7
        for i in range(s, s + c):
            places.append((d, i))
            assert keys.setdefault(tuple(words[i:i + 10]), k) == k
    assert sorted(places) == [(d, i) for d, t in enumerate(texts) for i in range(len(t.split()) - 9)]


@pytest.mark.parametrize("seed, window, gram", [(0, 12, 5), (1, 35, 12)])
def test_against_all_windows(spark, seed, window, gram):
    texts = corpus(seed, window) + ODD
    ids = list(range(len(texts) - 3)) + [1, None, 3]
    docs = documents(spark, texts, ids=ids).withColumnsRenamed({"lang": "mark", "source": "key"})
    got = remove_repeats(docs, window, gram).collect()
    want = [(i, *p) for i, p in zip(ids, plain(texts, window))]
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert sum(s["to"] - s["from"] for s in r.spans) == r.n_removed
        assert sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    assert remove_repeats(documents(spark, [])).count() == 0


def test_crowded_keys_and_small_shards(spark):
    from chainlake.llm.substring_dedup import candidate_segments
    from pyspark.sql import functions as F

    texts = corpus(7, 12) * 2
    rows = documents(spark, texts).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    segments = candidate_segments(rows, 12, 5)
    sets = [sorted({(r.key, r.seg, i) for r in repeated_spans(segments, 12, *limits).collect()
                    for i in range(r["from"], r["to"])}) for limits in ((10 ** 6, 10 ** 6), (50, 10 ** 6), (200, 0))]
    assert sets[0] and sets[0] == sets[1] == sets[2]


def test_a_window_of_many_segments_is_one_row(spark, monkeypatch):
    from chainlake.llm import substring_dedup
    from pyspark.sql import functions as F

    rng = random.Random(5)
    passage = [f"p{i}" for i in range(20)]
    texts = [" ".join([f"a{rng.random()}", *passage, f"b{i}"]) for i in range(300)]
    rows = documents(spark, texts).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    segments = substring_dedup.candidate_segments(rows, 12, 5)
    assert segments.select("key", "seg").distinct().count() > 300
    tables, settle = [], substring_dedup.settle
    monkeypatch.setattr(substring_dedup, "settle", lambda df: tables.append(df) or settle(df))
    got = {(r.key, r.seg, i) for r in repeated_spans(segments, 12, 10 ** 6, 0).collect() for i in range(r["from"], r["to"])}
    monkeypatch.undo()
    want = {(r.key, r.seg, i) for r in repeated_spans(segments, 12).collect() for i in range(r["from"], r["to"])}
    assert got and got == want
    plan = tables[2]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression") < plan.index("Aggregate [digest")
