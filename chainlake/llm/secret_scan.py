"""Secret scans (operator 8): candidates by pattern, false positives by random forest. Columns only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.session import release, settle

# What may be a secret, and formats of well-known issuers.
# A = is padding at the end or stands between a name and its value; a full stop at the end is the sentence's.
CANDIDATE = (r"(?<![A-Za-z0-9+/_.@~-])(?=[A-Za-z+/_.@~-]*[0-9])[A-Za-z0-9+/_.@~-]{15,}[A-Za-z0-9+/_@~-]"
             r"(?:={1,2}(?![A-Za-z0-9+/_@~=-]))?")
ISSUED = (r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
          r"|AIza[A-Za-z0-9_-]{35}|glpat-[A-Za-z0-9_-]{20}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$")
NAMED = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential)"
HARMLESS = r"(?i)(commit|sha1?|sha256|md5|hash|checksum|digest|uuid|guid|etag|revision|build|version|isbn|doi)"
ASSIGNED = NAMED + r"[A-Za-z0-9_-]{0,20}[\"']?[ \t]*(=>|:=|=|:)[ \t]*[\"']?$"
LEFT = 48  # characters of context before a candidate
FEATURES = ["length", "switches", "digits", "capitals", "hexadecimal", "variety", "dictionary", "separators",
            "in_path", "mail", "issued", "named", "assigned", "harmless", "quoted"]


def places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, finding, start (from 0), left: every match of every text; `row` numbers the texts."""
    text, no_ints = F.col("text"), F.lit([]).cast("array<int>")
    # The pieces between the matches tell where each match stands.
    split = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .withColumn("row", F.monotonically_increasing_id()) \
        .select("row", "doc_id", "text", F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"),
                F.transform(F.split(text, CANDIDATE, -1), F.length).alias("gaps")) \
        .where(F.size("found") > 0)
    steps = F.zip_with(F.slice("gaps", 1, F.size("found")), "found",
                       lambda g, f: F.struct(g.alias("gap"), F.length(f).alias("n")))
    state = F.struct(F.lit(0).alias("at"), no_ints.alias("starts"))
    starts = F.aggregate(steps, state, lambda a, s: F.struct(
        (a["at"] + s["gap"] + s["n"]).alias("at"), F.array_append(a["starts"], a["at"] + s["gap"]).alias("starts")))
    each = F.zip_with("found", starts["starts"], lambda f, at: F.struct(
        f.alias("finding"), at.alias("start"),
        F.substring(text, F.greatest(at - LEFT, F.lit(0)) + 1, F.least(at, F.lit(LEFT))).alias("left")))
    return split.select("row", "doc_id", F.inline(each))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, finding, start (from 0), left: every distinct candidate of a text where it first stands."""
    first = F.min(F.struct("start", "left"))
    return places(docs, id_col, text_col).groupBy("row", "doc_id", "finding").agg(first.alias("first")) \
        .select("doc_id", "finding", "first.start", "first.left")


def dictionary(spark: SparkSession, words: list[str]) -> DataFrame:
    """A word list as a table; lower case, four letters or more."""
    kept = sorted({w.lower() for w in words if w.isalpha() and len(w) >= 4})
    return spark.createDataFrame([(w,) for w in kept], "word string")


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """`found` with the features of each finding, in one vector."""
    from pyspark.ml.functions import array_to_vector

    f, left = F.col("finding"), F.col("left")
    n = F.length(f)
    share = lambda kept: (n - F.length(F.regexp_replace(f, kept, ""))) / n
    flag = lambda c: c.cast("double")
    runs = F.length(F.regexp_replace(f, r"[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", "x"))
    # Letters in words of the dictionary: distinct letter runs of distinct findings meet the word list.
    letters = found.select("finding").distinct().select("finding", F.explode(F.array_distinct(
        F.filter(F.split(F.lower("finding"), r"[^a-z]+"), lambda w: F.length(w) >= 4))).alias("word"))
    covered = letters.join(words, "word").groupBy("finding").agg(F.sum(F.length("word")).alias("covered"))
    values = {
        "length": F.log(n.cast("double")),
        "switches": (runs - 1) / n,
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "hexadecimal": flag(f.rlike(r"^([0-9a-f]+|[0-9A-F]+)$")),
        "variety": F.size(F.array_distinct(F.split(f, ""))) / F.least(n, F.lit(62)),
        "dictionary": F.coalesce(F.col("covered"), F.lit(0)) / n,
        "separators": share("[._/@=~-]"),
        "in_path": flag(f.rlike(r"[/.][A-Za-z]|^/") | left.rlike(r"(https?://|www\.|[/\\])\S*$")),
        "mail": flag(f.rlike(r"@[A-Za-z0-9-]+\.")),
        "issued": flag(f.rlike(ISSUED)),
        "named": flag(left.rlike(NAMED)),
        "assigned": flag(left.rlike(ASSIGNED)),
        "harmless": flag(left.rlike(HARMLESS)),
        "quoted": flag(left.rlike("[\"'`]$")),
    }
    vector = array_to_vector(F.array(*[F.coalesce(values[k].cast("double"), F.lit(0.0)) for k in FEATURES]))
    return found.join(covered, "finding", "left").withColumn("features", vector).drop("covered")


def labelled_findings(spark: SparkSession, found: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """finding, left, label: findings that a strict reading settles, and made ones of known kind.

    From the corpus, up to about `sample_rows` findings drawn by hash: 1 for issuers' formats and for
    values without dictionary-like form given to a credential's name; 0 for mail, paths, web addresses
    and values named as hashes, versions or ids. Others teach nothing. The made ones
    (hashes of numbers in typical surroundings) see to it that both kinds are there.
    """
    f, left = F.col("finding"), F.col("left")
    plain = f.rlike(r"^[A-Za-z0-9+/_=-]{20,}$") & f.rlike(r"[0-9].*[0-9].*[0-9]") & ~f.rlike(r"[A-Za-z]{9,}")
    label = F.when(f.rlike(ISSUED) | (left.rlike(ASSIGNED) & plain), 1.0) \
        .when(f.rlike(r"@[A-Za-z0-9-]+\.") | left.rlike(r"https?://\S*$") | f.rlike(r"^/|\.[a-z]{2,4}$")
              | (left.rlike(HARMLESS) & ~left.rlike(NAMED)), 0.0)
    settled = found.select("finding", "left", label.alias("label")).where("label is not null").distinct()
    share = F.greatest(F.lit(1), F.ceil(F.lit(1.0) * settled.count() / sample_rows))
    settled = settled.where(F.pmod(F.xxhash64("finding", "left"), share) == 0)
    number = F.col("id").cast("string")
    kinds = [  # value, text before it, label
        (F.sha1(number), 'token = "', 1.0), (F.md5(number), "api_key: ", 1.0),
        (F.upper(F.sha1(number)), 'TOKEN = "', 1.0),
        (F.base64(F.unhex(F.sha1(number))), "password=", 1.0), (F.concat(F.lit("sk_live_"), F.md5(number)), "key ", 1.0),
        (F.concat(F.lit("AKIA"), F.upper(F.substring(F.md5(number), 1, 16))), "", 1.0),
        (F.base64(F.unhex(F.sha2(number, 256))), "client_secret: '", 1.0),
        (F.sha1(number), "commit ", 0.0), (F.md5(number), "md5: ", 0.0), (F.sha2(number, 256), 'checksum = "', 0.0),
        (F.concat(F.lit("user"), number, F.lit("@mail.example.com")), "write to ", 0.0),
        (F.concat(F.lit("example.com/articles/"), number, F.lit(".html")), "https://www.", 0.0),
        (F.concat(F.lit("/usr/share/data/part-"), number, F.lit(".csv")), "in ", 0.0),
        (F.regexp_replace(F.md5(number), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), "uuid ", 0.0),
        (F.concat(F.lit("2024-01-01T00:00:00."), number), "at ", 0.0),
        (F.concat(F.lit("chapter-number-"), number, F.lit("-of-the-story")), "see ", 0.0),
    ]
    made = spark.range(100).select(F.explode(F.array(*[
        F.struct(v.alias("finding"), F.lit(b).alias("left"), F.lit(y).alias("label")) for v, b, y in kinds])).alias("k"))
    return settled.unionByName(made.select("k.*"))


def train(labelled: DataFrame, words: DataFrame, trees: int = 40, depth: int = 7):
    """Random forest over the features of labelled findings."""
    from pyspark.ml.classification import RandomForestClassifier

    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, minInstancesPerNode=2)
    return forest.fit(featured(labelled, words).select("features", "label"))


def judge(found: DataFrame, model, words: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, finding, start, length, score, is_secret of every candidate: its first place, its highest score."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(featured(found, words))
    each = scored.select("row", "doc_id", "finding", "start", vector_to_array("probability")[1].alias("score"))
    best = each.groupBy("row", "doc_id", "finding").agg(F.min("start").alias("start"), F.max("score").alias("score"))
    return best.select("doc_id", "finding", "start", F.length("finding").alias("length"), "score",
                       (F.col("score") >= least).alias("is_secret"))


def scan(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every secret candidate of every whole text, with the forest's score.

    A finding is a distinct candidate string of a row; each of its places is judged by what stands before
    it, and one place that looks like a secret makes it one. Null and empty texts have none. Repeated rows and null ids give findings of their own;
    extra columns are ignored. `words` is the dictionary, a bounded list.
    """
    spark = docs.sparkSession
    table = dictionary(spark, words)
    found = settle(places(docs, id_col, text_col))
    release(spark)
    forest = train(labelled_findings(spark, found), table)
    release(spark)
    return judge(found, forest, table)


def redact(docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id",
           text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """`docs` with every place of a document's secrets replaced; all columns and rows stay.

    Longer secrets go first, so one that holds another is replaced whole. Rows that share an id (or have
    none) share their secrets. `length_col`, if given, gets the new length of a changed text.
    """
    secret = findings.where("is_secret").groupBy(F.col("doc_id").alias("of")).agg(
        F.collect_set("finding").alias("secrets"))
    ordered = F.reverse(F.array_sort(F.transform("f.secrets", lambda s: F.struct(F.length(s).alias("n"), s.alias("s")))))
    text = F.col(f"d.{text_col}")
    clean = F.aggregate(ordered, text, lambda t, s: F.replace(t, s["s"], F.lit(mark)))
    new = {text_col: clean}
    if length_col is not None:
        new[length_col] = F.length(clean).cast(docs.schema[length_col].dataType)
    changed = F.col("f.secrets").isNotNull() & text.isNotNull()
    met = docs.alias("d").join(secret.alias("f"), F.col(f"d.{id_col}").eqNullSafe(F.col("f.of")), "left")
    return met.select(*[F.when(changed, new[c]).otherwise(F.col(f"d.{c}")).alias(c) if c in new else F.col(f"d.{c}")
                        for c in docs.columns])
