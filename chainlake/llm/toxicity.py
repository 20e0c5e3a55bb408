"""Toxicity (operator 6): boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.session import discard, settle, small

# Second-person words of some languages.
SECOND_PERSON = {"you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "tu", "toi",
                 "te", "ton", "vous", "votre", "usted", "ti", "tus"}
# Signs that stand in for letters.
DISGUISE = bytes.maketrans(b"@$!013457", b"asioieast")
NEAR = 6          # words between a lexicon hit and a second-person word
STEMS = (4, 5, 6)  # byte lengths of word beginnings tried beside whole words
FEATURES = 16

_letters = set(range(97, 123)) | set(range(65, 91)) | set(range(128, 256))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c in _letters else 32 for c in range(256))
KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c in _letters or c in b"@$!013457 \n\t" else 32 for c in range(256))
INSIDE = re.compile(rb"[A-Za-z\x80-\xff][@$*#%!0-9_.-]+(?=[A-Za-z\x80-\xff])")
STRETCH = re.compile(rb"([A-Za-z])\1\1")


def words_of(text: str) -> list[bytes]:
    """Lower-case letter runs of a text."""
    return text.lower().encode().translate(LOWER).split()


def units_of(word: bytes) -> list[bytes]:
    """A word and its beginnings; a beginning ends in `+`."""
    return [word, *(word[:n] + b"+" for n in STEMS if len(word) > n)]


class Lexicon:
    """Units with their log odds; a word weighs as much as its heaviest unit."""

    def __init__(self, odds: dict[bytes, float]):
        self.odds = odds
        # Words that start otherwise hold no unit.
        self.heads = {u.rstrip(b"+")[:STEMS[0]] for u in odds}

    def hits(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(position, weight) of the words that hold a unit."""
        head, n, out = self.heads, STEMS[0], []
        for i, w in enumerate(words):
            if w[:n] in head:
                best = max((self.odds[u] for u in units_of(w) if u in self.odds), default=0.0)
                if best:
                    out.append((i, best))
        return out


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Dense features of one whole text; all 0 for a text without words."""
    raw = text.encode()
    words = words_of(text)
    n, size = len(words), max(1, len(raw))
    out = [0.0] * FEATURES
    if not raw:
        return out
    hits = lexicon.hits(words)
    places = np.array([i for i, _ in hits])
    second = np.array([i for i, w in enumerate(words) if w.decode(errors="ignore") in SECOND_PERSON])
    near = 0
    if len(places) and len(second):
        right = np.searchsorted(second, places)
        gap = np.minimum(np.abs(second[np.minimum(right, len(second) - 1)] - places),
                         np.abs(second[np.maximum(right - 1, 0)] - places))
        near = int((gap <= NEAR).sum())
    codes = np.frombuffer(raw, np.uint8)
    upper = (codes >= 65) & (codes <= 90)
    letters = upper | ((codes >= 97) & (codes <= 122)) | (codes >= 128)
    disguised = 0
    if INSIDE.search(raw):
        shown = raw.translate(KEEP).translate(DISGUISE).split()
        disguised = max(0, len(lexicon.hits(shown)) - len(hits))
    out[0] = len(hits) / max(1, n)
    out[1] = float(np.log1p(len(hits)))
    out[2] = len({words[i] for i, _ in hits})
    out[3] = max((w for _, w in hits), default=0.0)
    out[4] = sum(w for _, w in hits) / max(1, n)
    out[5] = near / max(1, n)
    out[6] = float(near > 0)
    out[7] = len(second) / max(1, n)
    out[8] = upper.sum() / max(1, letters.sum())
    out[9] = float((upper[1:] & upper[:-1]).sum()) / size
    out[10] = ((codes == 33) | (codes == 63)).sum() / size
    out[11] = (~letters & (codes > 32) & ~((codes >= 48) & (codes <= 57))).sum() / size
    out[12] = len(INSIDE.findall(raw)) / max(1, n)
    out[13] = disguised / max(1, n)
    out[14] = len(STRETCH.findall(raw)) / max(1, n)
    out[15] = float(np.log1p(n))
    return [float(x) for x in out]


@dataclass
class Scorer:
    lexicon: Lexicon
    trees: Any          # None where the labels hold one class only
    isotonic: Any       # None where too few labels were left to calibrate
    base: float         # share of label 1


def with_features(docs: DataFrame, lexicon: Lexicon, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns and the feature vector of every whole text; no shuffle."""
    import pyarrow as pa
    from pyspark.ml.functions import array_to_vector

    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for batch in batches:
            rows = [features(t.as_py() or "", sent.value) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "x"])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    picked = docs.select(*keep, F.col(text_col).alias("__text"))
    return picked.mapInArrow(run, ", ".join([*kinds, "x array<double>"])) \
        .withColumn("features", array_to_vector("x")).drop("x")


def learn_lexicon(labelled: DataFrame, least_docs: int = 4, least_odds: float = 2.5, most: int = 3000) -> Lexicon:
    """Words and word beginnings that stand mostly in toxic texts, up to `most` of them."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                found = {u.decode(errors="ignore") for w in set(words_of(text.as_py() or "")) if len(w) >= 3
                         for u in units_of(w)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array([toxic.as_py()] * len(found), pa.int32())],
                    names=["unit", "toxic"])

    totals = labelled.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, good = totals.bad or 0, totals.n - (totals.bad or 0)
    counted = labelled.select("text", F.col("toxic").cast("int")).mapInArrow(run, "unit string, toxic int") \
        .groupBy("unit").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (good + 1))
    rows = (counted.where(F.col("bad") >= least_docs).withColumn("odds", odds).where(F.col("odds") >= least_odds)
            .orderBy(F.desc(F.col("odds") * F.log1p("bad")), "unit").limit(most).collect())
    return Lexicon({r.unit.encode(): r.odds for r in rows})


def draw(labels: DataFrame, sample_rows: int = 30_000, id_col: str = "doc_id",
         label_col: str = "toxic") -> DataFrame:
    """Up to about `sample_rows` labelled ids, drawn by hash; one row per id, toxic if any of its rows is."""
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias(label_col))
    share = max(1, known.count() // sample_rows)
    return known.where(F.pmod(F.xxhash64(id_col), F.lit(share)) == 0)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 30_000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Scorer:
    """Lexicon, trees and calibration from up to about `sample_rows` labelled ids, drawn by hash.

    The ids drawn go to every task, so no text is moved to find its label.

    Each learns from rows of its own (half, three tenths, two tenths), so that none trusts what an
    earlier one knows by heart. Rows without label teach nothing.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    drawn = draw(labels, sample_rows, id_col, label_col).select(
        F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"),
        F.pmod(F.xxhash64(F.xxhash64(id_col)), F.lit(10)).alias("part"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = settle(texts.join(small(drawn), "doc_id").drop("doc_id"))
    lexicon = learn_lexicon(rows.where("part < 5"))
    ready = with_features(rows.where("part >= 5"), lexicon, ["toxic", "part"]) \
        .withColumn("label", F.col("toxic").cast("double")).persist()
    fit, check = ready.where("part < 8"), ready.where("part >= 8")
    seen = fit.agg(F.avg("label").alias("base"), F.count_distinct("label").alias("kinds")).first()
    trees = isotonic = None
    if seen.kinds == 2:
        trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, minInstancesPerNode=3, seed=11) \
            .fit(fit.select("features", "label"))
        raw = trees.transform(check).select(vector_to_array("probability")[1].alias("raw"), "label")
        kinds = {r.label: r["count"] for r in raw.groupBy("label").count().collect()}
        if min(kinds.get(0.0, 0), kinds.get(1.0, 0)) >= 20:
            isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="even").fit(raw)
    ready.unpersist()
    discard(rows)
    return Scorer(lexicon, trees, isotonic, seen.base or 0.0)


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every whole text, from the text alone.

    score is the calibrated chance of label 1; a hundredth of the trees' own chance keeps texts in order
    that calibration makes equal. Null and empty texts are scored as texts without words. With one class
    of labels only, every score is its share. Repeated rows and null ids come out as they come in.
    """
    from pyspark.ml.functions import vector_to_array

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if scorer.trees is None:
        chance = named.select("doc_id", F.lit(float(scorer.base)).alias("score"))
    else:
        ready = scorer.trees.transform(with_features(named, scorer.lexicon, ["doc_id"]))
        chance = ready.select("doc_id", vector_to_array("probability")[1].alias("raw"))
        if scorer.isotonic is not None:
            chance = scorer.isotonic.transform(chance).withColumn("raw", 0.99 * F.col("even") + 0.01 * F.col("raw"))
        chance = chance.select("doc_id", F.least(F.greatest("raw", F.lit(0.0)), F.lit(1.0)).alias("score"))
    return chance.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
