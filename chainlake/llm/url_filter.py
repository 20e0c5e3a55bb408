"""URL filters (operator 3): listed rules first, then association rules that FP-growth mines. JVM only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.session import settle

# Words in a host or path that label a page as unwanted, to learn from, where no list decides.
SEED_WORDS = ["casino", "pills", "porn", "spam", "viagra", "warez", "xxx"]
VERDICTS = ["allow", "block"]


def host_of(url: Column) -> Column:
    """Text after the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    host = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _table(value: dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), f"map<string,{kind}>")


def listed(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule (length, rule, verdict) of (verdict, host, path) rules, or null.

    A rule fits its host and all subdomains of it if the path starts with the rule's path. Rules are
    looked up by each ending of the host, so their number does not matter per url.
    """
    at: dict[str, list] = {}
    for verdict, rule_host, rule_path in rules:
        rule = rule_host + rule_path
        at.setdefault(rule_host, []).append({"length": len(rule), "rule": rule, "verdict": verdict, "path": rule_path})
    table = _table(at, "array<struct<length:int,rule:string,verdict:string,path:string>>")
    labels = F.split(host, r"\.")
    n = F.size(labels)
    endings = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    fits = F.filter(F.flatten(F.filter(F.transform(endings, lambda h: F.element_at(table, h)), lambda x: x.isNotNull())),
                    lambda r: F.startswith(path, r["path"]))
    return F.array_max(fits)


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens of a url: host labels, the host's last two labels, hyphenated words, path parts.

    Runs of digits are one token, so ids in paths do not count as words of their own.
    """
    labels = F.split(host, r"\.")
    parts = F.filter(F.split(F.regexp_replace(F.lower(path), r"[0-9]+", "0"), r"[/.]"), lambda p: p != "")
    words = F.filter(F.split(F.concat_ws("/", host, path), r"[^\p{L}]+"), lambda w: F.length(w) > 2)
    tag = lambda name, x: F.transform(x, lambda t: F.concat(F.lit(name), F.lower(t)))
    tagged = [tag("host:", F.filter(labels, lambda p: p != "")), tag("path:", parts), tag("word:", words)]
    site = F.array(F.concat(F.lit("site:"), F.substring_index(host, ".", -2)))
    return F.array_distinct(F.concat(*tagged, site))


def seeded(tokens: Column, seeds: list[str]) -> Column:
    """Whether a seed word is among the words of a url."""
    return F.arrays_overlap(tokens, F.array(*[F.lit(f"word:{w}") for w in seeds]).cast("array<string>"))


def labelled(urls: DataFrame, rules: list[tuple[str, str, str]], seeds: list[str]) -> DataFrame:
    """tokens, label, n: the token sets of all distinct urls, without the seed words.

    A label is the listed rules' verdict or, where none decides, block for a seed word; else null. A url
    counts once, however many rows repeat it.
    """
    split = urls.where("url is not null").select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).distinct()
    best = listed(F.col("host"), F.col("path"), rules)["verdict"]
    marked = split.select(tokens_of(F.col("host"), F.col("path")).alias("all"), best.alias("best"))
    label = F.coalesce("best", F.when(seeded(F.col("all"), seeds), "block"))
    return marked.select(_unseeded(F.col("all"), seeds).alias("tokens"), label.alias("label")) \
        .groupBy("tokens", "label").agg(F.count(F.lit(1)).alias("n"))


def _unseeded(tokens: Column, seeds: list[str]) -> Column:
    """Tokens in order, without the words that made labels."""
    return F.array_sort(F.array_except(tokens, F.array(*[F.lit(f"word:{w}") for w in seeds]).cast("array<string>")))


def mine(urls: DataFrame, rules: list[tuple[str, str, str]], seeds: list[str] | None = None, least_rows: int = 2,
         least_confidence: float = 0.9) -> DataFrame:
    """parts, verdict, confidence, support, key: rules `all parts in a url -> verdict`, as a table.

    FP-growth (pyspark.ml.fpm) runs over the token sets of all distinct urls, the label of a url as one more
    item. A rule has support (urls with its parts and its label) of at least `least_rows`, a number and no
    share, so it does not come and go with the size of the table, and a confidence (support by all urls with
    its parts, labelled or not) of at least `least_confidence`. `key` is its rarest part.

    Two kinds of token never reach FP-growth, and no verdict changes for it: tokens in too few urls of a
    label, and of tokens found in exactly the same urls all but one, so long urls that repeat each other stay
    one item. A token whose urls all have one label is a rule as it stands, and what holds it needs no other.
    No labels give no rules.
    """
    from pyspark.ml.fpm import FPGrowth

    seeds = SEED_WORDS if seeds is None else seeds
    sets = settle(labelled(urls, rules, seeds).withColumn("set", F.monotonically_increasing_id()))
    each = [F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(v) for v in VERDICTS]
    hashed = [F.bit_xor(F.xxhash64("set", F.lit(k))).alias(f"h{k}") for k in range(2)]
    tokens = settle(sets.select("set", "label", "n", F.explode("tokens").alias("token"))
                    .groupBy("token").agg(F.sum("n").alias("n"), *each, *hashed))
    most = F.greatest(*VERDICTS)
    usable = tokens.where(most >= least_rows)
    verdict = F.when(F.col("block") >= F.col("allow"), "block").otherwise("allow")
    single = usable.where(most >= least_confidence * F.col("n")).select(
        F.array("token").alias("parts"), verdict.alias("verdict"), (most / F.col("n")).alias("confidence"),
        most.alias("support"))
    items = settle(usable.where(most < F.col("n")).groupBy("n", *VERDICTS, "h0", "h1").agg(F.min("token").alias("token"))
                   .select("token", F.col("n").alias("urls")))
    kept = sets.select("set", F.explode("tokens").alias("token")).join(items.select("token"), "token") \
        .groupBy("set").agg(F.collect_list("token").alias("items"))
    label = F.when(F.col("label").isNotNull(), F.array(F.concat(F.lit("="), "label"))).otherwise(F.array().cast("array<string>"))
    baskets = settle(sets.join(kept, "set").select(
        F.concat("items", label).alias("items"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("items"))
    total = baskets.count()
    found = single
    if total:
        parts = int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least_rows - 0.5) / total),
                         minConfidence=least_confidence, numPartitions=parts).fit(baskets)
        got = model.associationRules.where(
            F.get("consequent", F.lit(0)).isin([f"={v}" for v in VERDICTS]) & (F.size("antecedent") > 1))
        found = single.unionByName(got.select(
            F.array_sort("antecedent").alias("parts"), F.substring(F.get("consequent", F.lit(0)), 2, 9).alias("verdict"),
            "confidence", F.round(F.col("support") * total).cast("long").alias("support")))
    named = settle(found.withColumn("rule", F.monotonically_increasing_id()))
    rarest = named.select("rule", F.explode("parts").alias("token")).join(tokens.select("token", "n"), "token") \
        .groupBy("rule").agg(F.min(F.struct("n", "token"))["token"].alias("key"))
    return settle(named.join(rarest, "rule").drop("rule"))


def matched(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """host, path, learned: verdict of the surest mined rule all of whose parts are in the url, where one is.

    `urls` has distinct (host, path, tokens). The rules are an inverted index by their rarest part: a url
    meets those listed under one of its tokens and is then held against their other parts. Of rules of
    one confidence the shortest counts, then the one of most support, then the first in order of its parts.
    """
    met = urls.select("host", "path", F.explode("tokens").alias("key")).join(mined, "key").drop("key")
    whole = met.join(urls, ["host", "path"]).where(F.size(F.array_except("parts", "tokens")) == 0)
    order = F.struct((-F.col("confidence")).alias("c"), F.size("parts").alias("z"), (-F.col("support")).alias("s"),
                     "parts", "verdict")
    return whole.groupBy("host", "path").agg(F.min(order)["verdict"].alias("learned"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], mined: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", seeds: list[str] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, basis of every url.

    The longest listed rule decides; else the mined rule that `matched` finds; else allow. `basis` says which
    (list, mined, default). Only distinct urls that no list decides meet the mined rules, so a url on a third
    of all rows is matched once. A null url, or one without ://, has empty host and path. Rows come out
    as often as they come in; an empty table gives no rows; extra columns are ignored, whatever their names.
    """
    seeds = SEED_WORDS if seeds is None else seeds
    picked = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                          path_of(F.col(url_col)).alias("path"))
    best = picked.withColumn("best", listed(F.col("host"), F.col("path"), rules))
    if mined is None:
        known = best.withColumn("learned", F.lit(None).cast("string"))
    else:
        open_ = best.where("best is null").select("host", "path").distinct() \
            .withColumn("tokens", _unseeded(tokens_of(F.col("host"), F.col("path")), seeds))
        known = best.join(settle(matched(settle(open_), mined)), ["host", "path"], "left")
    learned = F.when(F.col("best").isNull(), F.col("learned"))
    basis = F.when(F.col("best").isNotNull(), "list").when(learned.isNotNull(), "mined").otherwise("default")
    return known.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                        F.coalesce("best.verdict", learned, F.lit("allow")).alias("verdict"), basis.alias("basis"))
