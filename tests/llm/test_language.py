import numpy as np
import pytest
from tests.llm.helpers import ODD, documents

from chainlake.llm.language_id import family_of, fold, identify, known_language, profiles, rare_draws, train
from chainlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_families():
    assert family_of("de") == family_of("en") != family_of("fr") == family_of("es")
    assert family_of("xx") == "=xx"


def test_profiles_are_per_text():
    texts = ["some words", "", "ünder", "a" * 3_000_000, "some words"]
    together = profiles(texts)
    for t, row in zip(texts, together):
        assert np.allclose(profiles([t])[0], row)
    assert np.allclose((together ** 2).sum(axis=1), 1)


def test_held_out_accuracy(spark, given):
    got = QUERIES["op4_language_id"](spark, FOLDER).join(given.select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows) > 100
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_are_not_inputs(spark, given):
    tree = train(given.where(fold("doc_id", 3) != 1), 300)
    odd = documents(spark, ODD + ["le la les des une que", "123 !!", "le la les des une que"], langs=None)
    rows = {r.doc_id: r for r in identify(odd.withColumnRenamed("source", "score"), tree).collect()}
    n = len(ODD)
    for i, t in enumerate(ODD):
        assert (rows[i].lang_pred == "und") == (not any(map(str.isalpha, t or "")))
    assert rows[n].lang_pred == rows[n + 2].lang_pred == "fr" and rows[n + 1][1:] == ("und", 0.0)
    assert identify(documents(spark, []), tree).count() == 0


def test_one_language_or_none(spark):
    one = train(documents(spark, ["hello there", "and you", None, "44"], ["en", "en", "en", "fr"]))
    assert one.langs == ["en"]
    assert identify(documents(spark, ["hello", ""]), one).where("lang_pred = 'en'").count() == 1
    none = train(documents(spark, ["hello there"], [None]))
    assert identify(documents(spark, ["hello", None]), none).where("lang_pred = 'und' and score = 0").count() == 2


def test_rare_language_is_learned(spark):
    assert rare_draws({"a": 1, "b": 300, "c": 9700}, 400) == {"a": 1_000_000, "b": 121_000}
    assert rare_draws({"a": 9, "b": 91}, 400) == {"a": 1_000_000} and rare_draws({}, 10) == {}
    texts = [f"the house number {i} and the river" for i in range(3000)] + ["la maison et le chat"] * 2
    tree = train(documents(spark, texts, ["en"] * 3000 + ["fr"] * 2), 40)
    assert tree.langs == ["en", "fr"]
    rows = identify(documents(spark, ["la maison et le chat", "the house number 9 and the river"]), tree).collect()
    assert {r.doc_id: r.lang_pred for r in rows} == {0: "fr", 1: "en"}


def test_language_stage_rejects_texts_without_letters_only(spark, given):
    tree = train(given, 300)
    docs = documents(spark, ["Mitt hus är rött och båten är blå", "qxzt wvkj pqrr", "123 !!", "", None])
    assert {r.doc_id for r in known_language(docs, tree).collect()} == {0, 1}
    assert identify(docs, tree).where("lang_pred <> 'und'").agg({"score": "min"}).first()[0] >= 0.25
