import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import ODD, documents

from chainlake.llm.collocations import collocations, count_windows, phrase_counts, split_words

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(texts, langs, longest):
    f, n = defaultdict(Counter), Counter()
    for text, lang in zip(texts, langs):
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    return f, n


def plain(texts, langs, longest, least, top, share):
    f, n = plain_counts(texts, langs, longest)
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            score, k, l, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= share * a
                         and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), " ".join(p), l, r))
        out += [(lang, i, p, -a, l, r, n[lang], -s) for i, (s, a, _, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def corpus():
    texts = [*ODD, "x y z", "New York city, new york; New\tYork!\nnew york city", "a a a a a a a", "à la carte ÀB àb",
             "\x1c odd\x1cword ﻿mark \u0085 end", "﻿ first", '"quoted" words \\ here']
    texts += ["the quick brown fox jumps over the lazy dog. the quick brown fox"] * 7 + ["hot pair " * 3000] * 5
    texts += [f"common word {i % 11} then {i % 3} more of {i % 5} common word" for i in range(300)]
    langs = [["en", "de", None, "und", "a b"][i % 5] for i in range(len(texts))]
    return texts, langs


@pytest.mark.parametrize("longest, least, top", [(3, 3, 2000), (4, 2, 5), (2, 5, 50)])
def test_against_plain_counts(spark, longest, least, top):
    texts, langs = corpus()
    docs = documents(spark, texts, langs).withColumnsRenamed({"source": "phrase", "n_chars": "bucket"})
    got = collocations(docs, longest, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(texts, langs, longest, least, top, 50)


def test_counts_do_not_depend_on_buckets(spark):
    texts, langs = corpus()
    docs = documents(spark, texts, langs, parts=7)
    f, n = plain_counts(texts, langs, 3)
    want = {(g, len(p), " ".join(p), a) for g, c in f.items() for p, a in c.items() if a >= 4}
    want |= {(g, 0, "", a) for g, a in n.items() if a}
    for size in (500, 3_000_000):
        rows = phrase_counts(docs, 3, 4, bucket_bytes=size).collect()
        assert len(rows) == len(want) and {tuple(r) for r in rows} == want


def test_windows_over_slices():
    words, piece = split_words([b"a b c. d", b"E\ne f g"] * 50)
    whole = count_windows(words, piece, 3, 0, len(words))
    parts = Counter()
    for at in range(0, len(words), 33):
        keys, counts = count_windows(words, piece, 3, at, 33)
        parts.update(dict(zip(keys.to_pylist(), counts.tolist())))
    assert parts == dict(zip(whole[0].to_pylist(), whole[1].tolist())) and sum(parts.values()) == len(words)
    assert parts["a b c"] == 50 and parts["c"] == 50 and isinstance(words, pa.Array)


def test_long_text_and_empty_tables(spark):
    text = "ab cd " * 400_000
    rows = collocations(documents(spark, [text], ["en"])).collect()
    assert {(r.phrase, r.a, r.n) for r in rows} == {("ab cd ab", 399_999, 800_000), ("cd ab cd", 399_999, 800_000)}
    assert collocations(documents(spark, [])).count() == 0
    assert collocations(documents(spark, ["", None, " . "]).withColumn("x", F.lit(1))).count() == 0
