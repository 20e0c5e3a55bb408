import random

import numpy as np
import pytest
from tests.llm.helpers import ODD, documents

from chainlake.llm.decontaminate import ItemIndex, clean, gram_hashes, leaks, normal_form

ITEMS = "item_id long, text string, doc_id long"


def distance(item, codes):
    """Least edits that turn `item` into any stretch of `codes`, by the full table."""
    row = np.zeros(len(codes) + 1, int)
    for i, c in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        for j in range(len(codes)):
            new[j + 1] = min(row[j] + (codes[j] != c), row[j + 1] + 1, new[j] + 1)
        row = new
    return row.min()


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.random()
        text = text[:at] + (rng.choice("qxz ") if kind < 0.66 else "") + text[at + (kind > 0.33):]
    return text


def test_normal_form():
    codes, at = normal_form("  A--b, Çİ!\n")
    assert "".join(map(chr, codes)) == "a b çİ" and at.tolist() == [2, 3, 5, 6, 8, 9]


@pytest.mark.parametrize("q", range(1, 13))
def test_grams_by_content(q):
    rng = np.random.default_rng(q)
    codes = rng.integers(0, 2, 300).astype(np.uint32)
    hashes = gram_hashes(codes, q)
    assert len(hashes) == 301 - q and len(gram_hashes(codes[:q - 1], q)) == 0
    by_content = {}
    for i, h in enumerate(hashes):
        assert by_content.setdefault(codes[i:i + q].tobytes(), h) == h
    assert len(set(by_content.values())) == len(by_content)


@pytest.mark.parametrize("rate", [0.0, 0.08, 0.2])
def test_search_against_full_tables(rate):
    rng = random.Random(int(100 * rate))
    words = ["one", "two", "three", "ab", "ba", "aba", "x"]
    say = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, say(rng.randint(1, 14))) for i in range(12)]
    index = ItemIndex(items, rate, 4)
    texts = []
    for _ in range(60):
        part = edited(rng, rng.choice(items)[1] + " ", rng.randint(0, 9)) if rng.random() < 0.7 else ""
        texts.append(say(rng.randint(0, 6)) + " " + part + say(rng.randint(0, 6)))
    found = {(d, i): (e, a, b) for d, i, e, a, b in index.search(texts)}
    best = {}
    for d, i, e, a, b in index.search(texts):
        best[d, i] = min(e, best.get((d, i), e))
    for d, text in enumerate(texts):
        codes, _ = normal_form(text)
        for number, item in enumerate(index.ids):
            want = distance(index.codes[number], codes)
            if want <= index.budget[number]:
                assert best[d, item] == want
                e, a, b = found[d, item]
                # A stretch may start or end with a space, which is not a letter of its own here.
                assert e <= distance(index.codes[number], normal_form(text[a:b])[0]) <= e + 2
            else:
                assert (d, item) not in best


def test_tables(spark):
    passage = "The quick brown fox jumps over the lazy dog and runs far away from the barking hounds"
    texts = ODD + ["Intro. " + passage.upper() + "! End", passage.replace("lazy", "lzy"), "brown fox " * 40, passage[:40]]
    n = len(ODD)
    items = spark.createDataFrame([(1, passage, 5), (2, "short", 5), (3, None, 5), (4, "", 5), (1, passage, 5),
                                   (5, "another passage that nobody has ever copied anywhere", 5)], ITEMS)
    docs = documents(spark, texts + [texts[n]]).withColumnRenamed("lang", "item_id")
    for block in (10, 10 ** 6):
        got = sorted(map(tuple, leaks(docs, items, block_chars=block).collect()))
        assert got == [(n, 1, 0, 7, 7 + len(passage))] * 2 + [(n + 1, 1, 1, 0, len(passage) - 1)] * 2 \
            + [(n + 4, 1, 0, 7, 7 + len(passage))] * 2
        left = clean(docs, items, block_chars=block)
        assert left.columns == docs.columns
        assert sorted(r.doc_id for r in left.collect()) == [i for i in range(n + 4) if i not in (n, n + 1)]
    none = items.limit(0)
    assert leaks(docs, none).count() == 0 and clean(docs, none).count() == len(texts) + 1
    assert leaks(documents(spark, []), items).count() == 0
