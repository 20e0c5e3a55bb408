"""Registered queries over the given tables, one per operator of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainlake.session import tune

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register `build(read) -> DataFrame` under its own name, with checking SQL."""

    def keep(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return build(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return keep


def bpe_50k() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op7_packing(read):
    """Every document packed into sequences of 2048 tokens."""
    from chainlake.llm.packing import pack

    return pack(read("documents"), bpe_50k())


@query()
def op9_token_counts(read):
    """Tokens of every whole text."""
    from chainlake.llm.token_counts import count_tokens

    return count_tokens(read("documents"), bpe_50k())


@query()
def op5_simhash_near_dedup(read):
    """Fingerprints of every whole text and the sets that 3 or fewer differing bits link."""
    from chainlake.llm.simhash import near_duplicates

    return near_duplicates(read("documents"), shingle=3, budget=3).drop("mark", "keeper")


@query("""
WITH valid AS (
  SELECT row_number() OVER () AS k, vec_id, label,
         [CAST(x AS DOUBLE) for x in embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
links AS (
  SELECT a.k AS a, b.k AS b FROM valid a JOIN valid b
  ON a.label = b.label AND a.k <> b.k AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  WITH RECURSIVE r(k, o) AS (
    SELECT k, k FROM valid UNION SELECT r.k, links.b FROM r JOIN links ON r.o = links.a)
  SELECT r.k, min(v.vec_id) AS component_id FROM r JOIN valid v ON v.k = r.o GROUP BY r.k),
found AS (
  SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.k) AS n_links, component_id
  FROM valid v JOIN reach USING (k)
  UNION ALL
  SELECT vec_id, 0, vec_id FROM embeddings
  WHERE NOT coalesce(label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0, false))
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found
""")
def op10_embedding_near_dedup(read):
    """Vectors of a label whose cosine is at least 0.98, and the sets they form."""
    from chainlake.llm.embedding_dedup import near_duplicates

    return near_duplicates(read("embeddings"), least_cosine=0.98)


@query(r"""
WITH words AS (
  SELECT row_number() OVER () AS k, doc_id,
         [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w
  FROM documents),
windows AS (
  SELECT k, i, array_to_string(w[i:i + 34], ' ') AS body
  FROM words, unnest(generate_series(1, len(w) - 34)) AS g(i)),
again AS (SELECT body FROM windows GROUP BY body HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT k, j FROM windows JOIN again USING (body), unnest(generate_series(i, i + 34)) AS g(j)),
kept AS (
  SELECT k, string_agg(w[j], ' ' ORDER BY j) AS body, count(*) AS n
  FROM words, unnest(generate_series(1, len(w))) AS g(j)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.k = words.k AND gone.j = g.j)
  GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (k)
""")
def op1_substring_dedup(read):
    """Words covered by windows of 35 words that also start elsewhere, over all texts."""
    from chainlake.llm.substring_dedup import remove_repeats

    return remove_repeats(read("documents"), window=35).drop("kept", "spans")


@query()
def op4_language_id(read):
    """Language of every whole text, learned from two thirds of the labelled ids."""
    from pyspark.sql import functions as F

    from chainlake.llm.language_id import fold, identify, train

    docs = read("documents")
    tree = train(docs.where(fold("doc_id", 3) != 1))
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return identify(docs, tree).withColumn("held_out", held_out)


# Fixed values: (verdict, host, path) of the listed rules.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query()
def op3_url_filter(read):
    """Every page's url judged by the listed rules, then by mined rules."""
    from chainlake.llm.url_filter import judge, mine

    pages = read("pages").select("page_id", "url")
    return judge(pages, URL_RULES, mine(pages, URL_RULES))


def known_words() -> list[str]:
    """Plain words of a public vocabulary: those it spells with a leading space."""
    import json

    with open(bpe_50k(), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    return [w[1:] for w in vocab if w[0] == "Ġ" and w[1:].isascii() and w[1:].isalpha()]


@query()
def op8_secret_scan(read):
    """Every secret candidate of every whole text, with the forest's verdict."""
    from chainlake.llm.secret_scan import scan

    return scan(read("documents"), known_words())


@query()
def op6_toxicity(read):
    """Toxicity of every whole text, learned from four fifths of the labelled ids."""
    from pyspark.sql import functions as F

    from chainlake.llm.language_id import fold
    from chainlake.llm.toxicity import score, train

    docs = read("documents")
    scorer = train(docs, read("labels").where(fold("doc_id", 5) != 0))
    return score(docs, scorer).withColumn("held_out", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)))


@query()
def op2_decontamination(read):
    """Benchmark passages found in whole texts, within an edit budget."""
    from chainlake.llm.decontaminate import leaks

    return leaks(read("documents"), read("benchmark"))


@query(r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER g = 1 AS kept, sha AS text_sha256
FROM texts WINDOW g AS (PARTITION BY sha ORDER BY doc_id NULLS LAST)
""")
def op11_exact_dedup(read):
    """Documents with equal texts up to white space, and the one of each group that stays."""
    from chainlake.llm.exact_dedup import mark_duplicates

    return mark_duplicates(read("documents"))


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_FIELD_SQL = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF_SQL = "sha256({}|| '' ||{}|| '' ||{}|| '' ||{}|| '' ||{})"
_LEAF, _SHOWN = (_LEAF_SQL.format(*[_FIELD_SQL.format(c) for c in cols])
                 for cols in (MANIFEST_FIELDS, ["doc_id", "source", "lang", "(n_chars + 1)", "text"]))
# CRC-32 by its published rule, bit by bit.
_CRC32_SQL = """xor(list_reduce(list_concat([4294967295], [CAST(ascii(x) AS BIGINT) for x in
    string_split(CAST(doc_id AS VARCHAR), '')]), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""
_PAIRS_SQL = "[sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')) for i in range(0, (len(l) + 1) // 2)]"
_STEP_SQL = """i // 2, proof || coalesce(l[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END], ''),
         sha256(CASE WHEN i % 2 = 0 THEN node || coalesce(l[i + 2], '') ELSE l[i] || node END)"""


@query(f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, leaf, shown, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM (SELECT doc_id, lang, {_LEAF} AS leaf,
               CASE WHEN n_chars IS NOT NULL AND {_CRC32_SQL} % 7 = 0 THEN {_SHOWN} ELSE {_LEAF} END AS shown
        FROM documents)),
levels AS (
  SELECT lang, 0 AS h, list(leaf ORDER BY i) AS l FROM leaves GROUP BY lang
  UNION ALL SELECT lang, h + 1, {_PAIRS_SQL} FROM levels WHERE len(l) > 1),
subroots AS (
  SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM levels WHERE len(l) = 1),
crown AS (
  SELECT 0 AS h, list(subroot ORDER BY i) AS l FROM subroots
  UNION ALL SELECT h + 1, {_PAIRS_SQL} FROM crown WHERE len(l) > 1),
walk AS (
  SELECT doc_id, lang, leaf, 0 AS h, i, '' AS proof, shown AS node FROM leaves
  UNION ALL
  SELECT doc_id, w.lang, leaf, w.h + 1, {_STEP_SQL}
  FROM walk w JOIN levels v ON w.h = v.h AND w.lang IS NOT DISTINCT FROM v.lang WHERE len(l) > 1),
below AS (
  SELECT w.doc_id, w.lang, w.leaf, w.proof, w.node, s.subroot, s.i
  FROM walk w JOIN subroots s ON w.lang IS NOT DISTINCT FROM s.lang
  JOIN levels v ON w.h = v.h AND w.lang IS NOT DISTINCT FROM v.lang WHERE len(v.l) = 1),
above AS (
  SELECT doc_id, leaf, subroot, 0 AS h, i, proof, node FROM below
  UNION ALL
  SELECT doc_id, leaf, subroot, w.h + 1, {_STEP_SQL}
  FROM above w JOIN crown c ON w.h = c.h WHERE len(l) > 1)
SELECT doc_id, leaf, subroot, c.l[1] AS root, sha256(proof) AS proof_sha256, node AS folded_root,
       node = c.l[1] AS verified
FROM above w JOIN crown c ON w.h = c.h WHERE len(c.l) = 1
""")
def op12_merkle_manifest(read):
    """Proof of every document in the tree of its language; every seventh shows a changed length."""
    from pyspark.sql import functions as F

    from chainlake.llm.merkle import leaf_digest, manifest

    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in MANIFEST_FIELDS]
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_digest(*changed))
    return manifest(read("documents"), MANIFEST_FIELDS, shown=shown)


@query(r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, [x for x in string_split_regex(p, '[\x20\x09]+') if x <> ''] AS w FROM pieces),
counts AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM words, unnest([1, 2, 3]) AS s(m), unnest(generate_series(1, len(w) - m + 1)) AS g(i) GROUP BY ALL),
found AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, k,
         CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT found.*, unnest(range(1, m)) AS k FROM found) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
  FROM found WHERE m = 3),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
  WHERE NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = least.lang AND inside.phrase = least.phrase
                    AND 100 * inside.a >= 50 * least.a))
SELECT lang, rank, phrase, a, l, r, (SELECT CAST(sum(f) AS BIGINT) FROM counts n WHERE n.lang = ranked.lang AND m = 1) AS n,
       score FROM ranked WHERE rank <= 2000
""")
def op13_collocations(read):
    """The 2000 phrases of two and three words of each language that belong together most."""
    from chainlake.llm.collocations import collocations

    return collocations(read("documents"))
