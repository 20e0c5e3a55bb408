import base64
import hashlib
import re

import pytest
from tests.llm.helpers import ODD, documents

from chainlake.llm.queries import QUERIES, known_words
from chainlake.llm.secret_scan import CANDIDATE, candidates, places, redact, scan

HEX = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(20)]


def plain(text):
    """(finding, first place, left) by Python's patterns."""
    out = {}
    for m in re.finditer(CANDIDATE, text or ""):
        out.setdefault(m.group(), text.find(m.group()))
    return sorted((f, at, text[max(0, at - 48):at]) for f, at in out.items())


def test_candidates_by_hand(spark):
    texts = ODD + [f'x token = "{HEX[0]}" y {HEX[0]} commit {HEX[1]}', "a" * 50, "a1" * 9, f"{HEX[2]}{HEX[3]}" * 500,
                   "see https://www.example.com/a/b/page-1234567.html and joe.smith99@mail.example.com", "é" * 60 + HEX[4]]
    docs = documents(spark, texts, ids=[*range(len(texts) - 1), None]).withColumnRenamed("lang", "finding")
    got = {}
    for r in candidates(docs).collect():
        got.setdefault(r.doc_id, []).append((r.finding, r.start, r.left))
    for i, t in zip([*range(len(texts) - 1), None], texts):
        assert sorted(got.get(i, [])) == plain(t)


@pytest.fixture(scope="module")
def mixed(spark):
    texts = []
    for i in range(0, 20, 2):
        texts += [f'We set token = "{HEX[i]}" here.', f"api_key: {HEX[i]}A", f"It came with commit {HEX[i + 1]} today.",
                  f"Write to john.smith{i}@mail.example.com or https://www.example.com/long/path/page-{i}.html"]
    return texts + ["", None, f'token = "{HEX[0]}" again {HEX[0]}', f'token = "{HEX[0]}" again {HEX[0]}']


def test_forest_tells_secrets_from_the_rest(spark, mixed):
    docs = documents(spark, mixed)
    rows = scan(docs, known_words()).collect()
    assert len(rows) == sum(len(plain(t)) for t in mixed)
    for r in rows:
        text = mixed[r.doc_id]
        assert 0 <= r.score <= 1 and text[r.start:r.start + r.length] == r.finding
        assert r.is_secret == ("token" in text or "api_key" in text), (text, r)
    assert scan(documents(spark, []), known_words()).count() == 0


def test_redaction(spark, mixed):
    docs = documents(spark, mixed, ids=[*range(len(mixed) - 1), None]).withColumnRenamed("lang", "secrets")
    got = redact(docs, scan(docs, known_words()), length_col="n_chars")
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(mixed)
    for i, t in enumerate(mixed[:-1]):
        want = t
        if t and ("token" in t or "api_key" in t):
            for f, _, _ in plain(t):
                want = want.replace(f, "[SECRET]")
        assert rows[i].text == want and rows[i].n_chars == (None if t is None else len(want))
    assert rows[None].text == 'token = "[SECRET]" again [SECRET]'


def test_given_secrets_are_found(spark):
    folder = "/root/testdata/sf0.01"
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {(r.doc_id, r.finding) for r in QUERIES["op8_secret_scan"](spark, folder).collect() if r.is_secret}
    assert found == {(i, m) for i, t in docs.items() for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', t or "")}


def test_every_place_is_judged(spark):
    texts = [f'See commit {HEX[0]} first. Then token = "{HEX[0]}" came.', f"It came with commit {HEX[1]}, sha1: {HEX[1]} again.",
             f"x{HEX[2]} then token = \"{HEX[2]}\"", None, "none here"]
    docs = documents(spark, texts)
    want = sorted((i, m.group(), m.start(), t[max(0, m.start() - 48):m.start()])
                  for i, t in enumerate(texts) for m in re.finditer(CANDIDATE, t or ""))
    assert sorted(r[1:] for r in places(docs).collect()) == want and len(want) == 6
    found = {(r.doc_id, r.finding): r for r in scan(docs, known_words()).collect()}
    assert len(found) == 4
    assert found[0, HEX[0]].is_secret and found[0, HEX[0]].start == texts[0].find(HEX[0])
    assert not found[1, HEX[1]].is_secret
    assert found[2, HEX[2]].is_secret and found[2, HEX[2]].start == texts[2].rfind(HEX[2])
    rows = {r.doc_id: r.text for r in redact(docs, scan(docs, known_words())).collect()}
    assert HEX[0] not in rows[0] and rows[1] == texts[1]


def test_names_given_values_without_space(spark):
    key, b64 = f"AKIA{HEX[3][:16].upper()}", base64.b64encode(bytes.fromhex(HEX[4])).decode()
    assert b64.endswith("=")
    cases = [(f"export AWS_ACCESS_KEY_ID={key}", key, True), (f"password={b64}\nuser=joe", b64, True),
             (f"GET /v1/items?access_token={HEX[5]}&page=2", HEX[5], True), (f"The key is {key}.", key, True),
             (f"API_KEY={HEX[6]}.", HEX[6], True), (f"commit={HEX[7]}", HEX[7], False)]
    docs = documents(spark, [t for t, _, _ in cases])
    got = {r.doc_id: r for r in candidates(docs).collect()}
    assert [(got[i].finding, got[i].start) for i in range(len(cases))] == [(f, t.find(f)) for t, f, _ in cases]
    found = scan(docs, known_words())
    assert {(r.doc_id, r.finding, r.is_secret) for r in found.collect()} == {(i, f, y) for i, (_, f, y) in enumerate(cases)}
    rows = {r.doc_id: r.text for r in redact(docs, found).collect()}
    assert all(rows[i] == (t.replace(f, "[SECRET]") if y else t) for i, (t, f, y) in enumerate(cases))
