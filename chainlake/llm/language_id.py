"""Language identification (operator 4): family first, then one-versus-one linear SVMs."""

from __future__ import annotations

import itertools
import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Families of languages by their codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": ["de", "en", "nl", "sv", "da", "no", "is"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca"],
    "slavic": ["ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"],
    "uralic": ["fi", "et", "hu"],
}
WIDTH = 2048


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), f"={lang}")


def profiles(texts: list[str]) -> np.ndarray:
    """Unit rows of byte 1-, 2- and 3-gram frequencies (hashed, square-rooted) of whole texts."""
    out = np.zeros((len(texts), WIDTH))
    at = 0
    while at < len(texts):
        # Some texts at a time, at least one.
        held, size = [], 0
        while at + len(held) < len(texts) and (not held or size < 1 << 21):
            held.append((" " + texts[at + len(held)].lower() + " ").encode())
            size += len(held[-1])
        codes = np.frombuffer(b"".join(held), np.uint8).astype(np.uint32)
        row = np.repeat(np.arange(len(held), dtype=np.int64), [len(h) for h in held])
        gram = np.zeros(len(codes), np.uint32)
        for n in (1, 2, 3):
            gram = gram[:len(codes) - n + 1] * np.uint32(257) + codes[n - 1:]
            slot = (gram * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(21)
            # A gram that reaches into the next text is not counted.
            own = row[:len(gram)] == row[n - 1:]
            found = np.bincount(row[:len(gram)][own] * WIDTH + slot[own], minlength=len(held) * WIDTH)
            out[at:at + len(held)] += found.reshape(len(held), WIDTH)
        at += len(held)
    out = np.sqrt(out)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


class Tree:
    """Trained separators: between families, and between each two languages of a family."""

    def __init__(self, langs: list[str], weights: dict[tuple, np.ndarray]):
        self.langs, self.weights = langs, weights
        self.families: dict[str, list[str]] = {}
        for lang in langs:
            self.families.setdefault(family_of(lang), []).append(lang)

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each profile."""
        names = sorted(self.families)
        family, sure = self._vote(rows, names)
        lang = np.empty(len(rows), object)
        for i, name in enumerate(names):
            at = np.flatnonzero(family == i)
            best, inner = self._vote(rows[at], self.families[name])
            lang[at] = np.array(self.families[name], object)[best]
            sure[at] *= inner
        return lang.tolist(), sure

    def _vote(self, rows, names):
        """Each pair of names votes; ties go to the larger sum of margins."""
        votes, margins = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
        for a, b in itertools.combinations(range(len(names)), 2):
            w = self.weights[names[a], names[b]]
            margin = rows @ w[:-1] + w[-1]
            votes[:, a] += margin < 0
            votes[:, b] += margin >= 0
            margins[:, a] -= margin
            margins[:, b] += margin
        if len(names) == 1 or not len(rows):
            return np.zeros(len(rows), int), np.ones(len(rows))
        best = (votes + 1e-3 * np.tanh(margins)).argmax(axis=1)
        mean = margins[np.arange(len(rows)), best] / (len(names) - 1)
        return best, 1 / (1 + np.exp(-np.clip(3 * mean, -30, 30)))


def rare_draws(counts: dict[str, int], bound: int) -> dict[str, int]:
    """Millionths to draw of each language whose proportion of `bound` is under a quarter of an equal part."""
    least = max(1, bound // (4 * max(1, len(counts))))
    return {g: min(1_000_000, 1_100_000 * least // n) for g, n in counts.items()
            if n * bound < least * sum(counts.values())}


def train(docs: DataFrame, sample_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Tree:
    """Separators from up to `sample_rows` labelled rows, drawn by hash of their text and id.

    Languages come in their proportions, but none with less than a quarter of an equal part (or all its
    rows), so a language is learned however small its share. Rows without language or letters teach
    nothing. With no labelled row the tree is empty.
    """
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector

    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                           F.xxhash64(id_col, F.col(text_col)).alias("draw")) \
        .where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in labelled.groupBy(F.col("lang").cast("string").alias("lang"))
              .agg(F.count("*").alias("n")).collect()}
    # Keep about twice the bound by hash before texts are sorted; then exactly the bound, rare languages first.
    share = max(1, sum(counts.values()) // (2 * sample_rows))
    rare = F.from_json(F.lit(json.dumps(rare_draws(counts, sample_rows))), "map<string,int>")
    least = F.element_at(rare, F.col("lang").cast("string"))
    drawn = labelled.where(F.coalesce(F.pmod("draw", F.lit(1_000_000)) < least, F.pmod("draw", F.lit(share)) == 0)) \
        .orderBy(least.isNull(), F.hash("draw")).limit(sample_rows)
    kind = docs.schema[lang_col].dataType.simpleString()

    def shape(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                rows = profiles(some.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(1), pa.array(list(rows))], names=["lang", "x"])

    rows = drawn.repartition(4).mapInArrow(shape, f"lang {kind}, x array<double>") \
        .select(F.col("lang").cast("string").alias("lang"), array_to_vector("x").alias("features")).persist()
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())
    members: dict[str, list[str]] = {}
    for lang in langs:
        members.setdefault(family_of(lang), []).append(lang)
    pairs = {(a, b): (members[a], members[b]) for a, b in itertools.combinations(sorted(members), 2)}
    for family in members.values():
        pairs |= {(a, b): ([a], [b]) for a, b in itertools.combinations(family, 2)}
    weights = {}
    for pair, (left, right) in pairs.items():
        two = rows.where(F.col("lang").isin(left + right)).withColumn(
            "label", F.col("lang").isin(right).cast("double"))
        model = LinearSVC(maxIter=25, regParam=1e-4, standardization=False).fit(two.select("features", "label"))
        weights[pair] = np.append(model.coefficients.toArray(), model.intercept)
    rows.unpersist()
    return Tree(langs, weights)


def languages(texts, tree: Tree) -> tuple[list[str], np.ndarray]:
    """Language and score of each of some texts; `und` and 0 without a letter or a tree."""
    texts = [t or "" for t in texts.to_pylist()]
    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if tree.langs and any(map(str.isalpha, t))]
    if known:
        found, scores[known] = tree.predict(profiles([texts[i] for i in known]))
        for i, lang in zip(known, found):
            langs[i] = lang
    return langs, scores


def identify(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text, from the text alone; no shuffle.

    Null texts, texts without a letter, and an empty tree give `und` and score 0. Repeated rows
    and null ids come out as they come in; extra columns are ignored.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                langs, scores = languages(some.column(1), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(langs, pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def known_language(docs: DataFrame, tree: Tree, least_score: float = 0.2, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose language is told with `least_score` or more.

    Texts without a letter go (`und`). A score is a product of halves or more, at least 0.25 with two
    families of two languages, so the default rejects `und` only: a text in an unlearned language
    stays under a learned one. One pass, no shuffle.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(tree)
    at_text = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                langs, scores = languages(some.column(at_text), sent.value)
                yield some.filter(pa.array([g != "und" and p >= least_score for g, p in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str, parts: int):
    """crc32 of the id as text, modulo `parts`."""
    return F.crc32(F.col(id_col).cast("string")) % parts
