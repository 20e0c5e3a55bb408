import numpy as np
import pytest
from tests.llm.helpers import ODD, documents

from chainlake.llm.queries import QUERIES
from chainlake.llm.toxicity import (
    FEATURES, INSIDE, NEAR, SECOND_PERSON, STEMS, STRETCH, Lexicon, features, learn_lexicon, score, train, units_of, words_of,
)

FOLDER = "/root/testdata/sf0.1"


def test_lexicon_hits():
    lexicon = Lexicon({b"idiot": 3.0, b"stup+": 2.0})
    words = words_of("You IDIOT, stupidity; idiots stup")
    assert words == [b"you", b"idiot", b"stupidity", b"idiots", b"stup"]
    assert lexicon.hits(words) == [(1, 3.0), (2, 2.0)]
    assert units_of(b"idiots") == [b"idiots", b"idio+", b"idiot+"]


def test_features():
    lexicon = Lexicon({b"idiot": 3.0})
    for t in ODD:
        row = features(t or "", lexicon)
        assert len(row) == FEATURES and np.isfinite(row).all()
    plain, direct, masked = (features(t, lexicon) for t in
                             ("a quiet walk here", "you are an idiot here", "what an 1d!ot he is"))
    assert plain[0] == 0 < direct[0] and direct[5] > 0 and masked[13] > 0 and masked[12] > 0
    assert features("WHAT A DAY!!!", lexicon)[8] > 0.9 and features("soooo", lexicon)[14] > 0


def test_lexicon_is_learned(spark):
    rows = [(f"word{i % 7} nasty{chr(97 + i % 5)}", 1) for i in range(40)] + [(f"word{i % 7} calm", 0) for i in range(200)]
    lexicon = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert b"nasty+" in lexicon.odds and not any(u.startswith(b"word") or u.startswith(b"calm") for u in lexicon.odds)


def test_held_out(spark):
    got = QUERIES["op6_toxicity"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    bad, good = ([r.score for r in rows if r.toxic == y] for y in (1, 0))
    assert len(bad) > 50
    rank = np.argsort(np.argsort(bad + good))[:len(bad)].mean()
    assert rank > (len(good) + len(bad)) * 0.85
    hit = sum(r.predicted for r in rows if r.toxic)
    assert hit > 0.7 * len(bad) and sum(r.predicted for r in rows if not r.toxic) < 0.02 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


@pytest.mark.parametrize("labels", [[], [1], [0, 0, 1, 1, 0]])
def test_few_labels(spark, labels):
    rows = [(i, f"text number {i}", "s") for i in range(len(labels))]
    known = [(i, y) for i, y in enumerate(labels)] + [(0, 0), (99, 1), (None, 1), (1, None)]
    scorer = train(spark.createDataFrame(rows, "doc_id long, text string, toxic string"),
                   spark.createDataFrame(known if labels else [], "doc_id long, toxic int"))
    docs = documents(spark, ODD, ids=[None, *range(len(ODD) - 1)]).withColumnRenamed("lang", "features")
    got = score(docs, scorer).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert score(documents(spark, []), scorer).count() == 0


def plain_features(text, odds):
    """The features letter by letter and word by word."""
    raw = text.encode()
    letter = lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128

    def split(data, keep):
        out, word = [], b""
        for c in data:
            if keep(c):
                word += bytes([c + 32 if 65 <= c <= 90 else c])
            elif word:
                out, word = [*out, word], b""
        return [*out, word] if word else out

    def weight(word):
        return max([odds.get(word, 0.0), *(odds.get(word[:n] + b"+", 0.0) for n in STEMS if len(word) > n)])

    words = split(text.lower().encode(), letter)
    found = [(i, weight(w)) for i, w in enumerate(words) if weight(w)]
    you = [i for i, w in enumerate(words) if w.decode(errors="ignore") in SECOND_PERSON]
    near = sum(any(abs(i - j) <= NEAR for j in you) for i, _ in found)
    stand = dict(zip(b"@$!013457", b"asioieast"))
    shown = split(raw, lambda c: letter(c) or c in stand)
    shown = [bytes(stand.get(c, c) for c in w) for w in shown]
    inside = INSIDE.findall(raw)
    n, size = max(1, len(words)), max(1, len(raw))
    upper = [65 <= c <= 90 for c in raw]
    signs = [c > 32 and not letter(c) and not 48 <= c <= 57 for c in raw]
    return [len(found) / n, np.log1p(len(found)), len({words[i] for i, _ in found}), max([w for _, w in found], default=0),
            sum(w for _, w in found) / n, near / n, float(near > 0), len(you) / n, sum(upper) / max(1, sum(map(letter, raw))),
            sum(a and b for a, b in zip(upper, upper[1:])) / size, sum(c in b"!?" for c in raw) / size, sum(signs) / size,
            len(inside) / n, max(0, sum(weight(w) > 0 for w in shown) - len(found)) / n if inside else 0,
            len(STRETCH.findall(raw)) / n, np.log1p(len(words))]


def test_features_against_a_plain_version(spark):
    lexicon = Lexicon({b"idiot": 3.0, b"stup+": 2.0, b"fool+": 1.5})
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    odd = ["You 1d!ot, you STUPID fools!!!", "sooo fooool 5tup1d u", "É you idiot É", "idiot " * 9 + "filler " * 7 + "you", "!!!"]
    long = " ".join([*odd, *(t or "" for t in given)])
    for text in [*odd, *(t or "" for t in [*ODD, *given]), long]:
        assert features(text, lexicon) == pytest.approx(plain_features(text, lexicon.odds)), text[:80]
