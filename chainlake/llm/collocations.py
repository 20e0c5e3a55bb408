"""Phrase collocation mining (operator 13): top-order marginalisation.

Texts give their longest windows only, one per word occurrence: the word and the words that lead from
it, padded with nothing at the end of a piece. All shorter phrases are prefixes of such windows, and
Spark's ROLLUP adds them up. Windows that cannot reach the least count are first folded into their
prefixes, one length at a time, so the ROLLUP meets frequent phrases and remainders only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.operators.ranking import add_rank
from chainlake.session import settle

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
KIND = np.zeros(256, np.uint8)  # 0 part of a word, 1 between words, 2 between pieces
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2

LINES = "lang string, bucket long, body binary"
HEAD = b"key\trest\tkept\n"


def split_words(texts: list[bytes]):
    """All words of the texts as one Arrow array, and the number of the piece each stands in."""
    import pyarrow as pa

    data = np.frombuffer(b"\n".join(texts).translate(LOWER) + b"\n", np.uint8)
    kind = KIND[data]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_string(), len(start),
                                  [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.searchsorted(np.flatnonzero(kind == 2), start)


def count_windows(words, piece: np.ndarray, longest: int, at: int, size: int):
    """Windows that start at words at..at+size, and how often: keys (words joined by a space), counts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n = min(size, len(words) - at)
    coded = words.slice(at, n + longest - 1).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64) + 1
    near = piece[at:at + n + longest - 1]
    span = len(coded.dictionary) + 1
    lead, ids, room, whole = [codes[:n]], codes[:n], span, np.ones(n, bool)
    for j in range(1, longest):
        code = np.zeros(n, np.int64)
        here = len(codes) - j if len(codes) - j < n else n
        whole[here:] = False
        whole[:here] &= near[j:j + here] == near[:here]
        code[:here] = codes[j:j + here]
        code[~whole] = 0
        lead.append(code)
        if room * span >= 1 << 62:
            known, ids = np.unique(ids, return_inverse=True)
            room = len(known)
        ids, room = ids * span + code, room * span
    _, first, counts = np.unique(ids, return_index=True, return_counts=True)
    names = pa.concat_arrays([pa.nulls(1, pa.large_string()), coded.dictionary])
    parts = [names.take(pa.array(code[first])) for code in lead]
    return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()), null_handling="skip"), counts


def bodies(lang: str, keys, rest: np.ndarray, kept: np.ndarray, buckets: int):
    """Record batch of LINES: the counted keys as lines of text, packed by bucket."""
    import pandas as pd
    import pyarrow as pa
    import pyarrow.compute as pc
    import zstandard

    place = pd.util.hash_array(keys.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(buckets)
    order = np.argsort(place, kind="stable")
    text, tab = pa.large_string(), pa.scalar("\t", pa.large_string())
    tail = pc.binary_join_element_wise(pa.array(kept[order]).cast(text), pa.scalar("", text), pa.scalar("\n", text))
    lines = pc.binary_join_element_wise(keys.take(pa.array(order)), pa.array(rest[order]).cast(text), tail, tab)
    _, offsets, data = lines.buffers()
    offsets = np.frombuffer(offsets, np.int64)[lines.offset:lines.offset + len(lines) + 1]
    place = place[order]
    first = np.flatnonzero(np.diff(place, prepend=np.uint64(buckets)))
    ends = np.append(first[1:], len(place))
    pack, view = zstandard.ZstdCompressor(level=1), memoryview(data)
    packed = [pack.compress(view[offsets[a]:offsets[b]]) for a, b in zip(first, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(first), pa.string()), pa.array(place[first].astype(np.int64)),
         pa.array(packed, pa.binary())], names=["lang", "bucket", "body"])


def windows(docs: DataFrame, longest: int, buckets: int, text_col: str, lang_col: str,
            chunk_bytes: int = 6_000_000, chunk_words: int = 1_000_000) -> DataFrame:
    """Counted windows of all texts as LINES, combined within each task; words beyond a chunk go in slices."""

    def run(batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> Iterator:
            words, piece = split_words(held.pop(lang))
            size.pop(lang)
            for at in range(0, len(words), chunk_words):
                keys, counts = count_windows(words, piece, longest, at, chunk_words)
                yield bodies(lang, keys, counts, np.zeros_like(counts), buckets)

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                lang, raw = lang.as_py(), text.as_buffer().to_pybytes()
                held.setdefault(lang, []).append(raw)
                size[lang] = size.get(lang, 0) + len(raw) + 1
                if size[lang] >= chunk_bytes:
                    yield from flush(lang)
            while sum(size.values()) > 8 * chunk_bytes:
                yield from flush(max(size, key=size.get))
        for lang in list(held):
            yield from flush(lang)

    picked = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                         F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    return picked.mapInArrow(run, LINES)


def _merged(table):
    out = table.group_by("key", use_threads=False).aggregate([("rest", "sum"), ("kept", "sum")])
    return out.rename_columns([{"rest_sum": "rest", "kept_sum": "kept"}.get(c, c) for c in out.column_names])


def fold(lines: DataFrame, length: int, least: int, buckets: int, held_rows: int = 1_000_000) -> DataFrame:
    """One step down: windows of `length` words seen `least` times stay, all others become their prefix.

    Rows are either LINES, of windows of at most length - 1 words, for the next step, or (lang, phrase, n):
    the n windows that begin with the phrase and with no longer phrase that stayed; phrase "" stands for what
    is left of a language. `rest` counts windows that have not come to stay, `kept` those that stayed in longer
    phrases: both together are how often the phrase occurs. A task holds one bucket at a time.
    """
    import pyarrow as pa

    def read(packed: list[bytes]):
        import zstandard
        from pyarrow import csv

        unpack = zstandard.ZstdDecompressor()
        data = HEAD + b"".join(map(unpack.decompress, packed))
        return csv.read_csv(
            pa.BufferReader(data), csv.ReadOptions(use_threads=False, block_size=1 << 22),
            csv.ParseOptions(delimiter="\t", quote_char=False, double_quote=False),
            csv.ConvertOptions(column_types={"key": pa.large_string(), "rest": pa.int64(), "kept": pa.int64()},
                               strings_can_be_null=False))

    def run(batches):
        import pyarrow.compute as pc

        lower: list = []
        now: tuple | None = None
        packed: list[bytes] = []
        found: list[tuple] = []

        def step():
            """Take the bucket at hand apart."""
            table = _merged(read(packed))
            total = pc.add(table["rest"], table["kept"])
            full = pc.equal(pc.count_substring(table["key"], " "), length - 1)
            stays = pc.and_(full, pc.greater_equal(total, least))
            for phrase, n in zip(*(table.filter(stays)[c].to_pylist() for c in ("key", "rest"))):
                if n:
                    found.append((now[0], phrase, n))
            key = table["key"]
            up = pc.replace_substring_regex(key, r" ?[^ ]+$", "")
            lower.append(pa.table({
                "key": pc.if_else(full, up, key),
                "rest": pc.if_else(stays, 0, table["rest"]),
                "kept": pc.if_else(stays, total, table["kept"])}))

        def flush(lang: str):
            if lower:
                table = _merged(pa.concat_tables(lower)).combine_chunks()
                lower.clear()
                if length == 1:
                    found.append((lang, "", pc.sum(table["rest"]).as_py()))
                else:
                    keys = table["key"].chunk(0) if table.num_rows else pa.array([], pa.large_string())
                    batch = bodies(lang, keys, table["rest"].to_numpy(), table["kept"].to_numpy(), buckets)
                    yield out(batch, [])
            yield out(None, found)
            found.clear()

        def out(batch, rows):
            n = len(rows)
            if batch is not None:
                n = batch.num_rows
                cols = [*batch.columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())]
            else:
                lang, phrase, count = zip(*rows) if rows else ((), (), ())
                cols = [pa.array(lang, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                        pa.array(phrase, pa.string()), pa.array(count, pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["lang", "bucket", "body", "phrase", "n"])

        for batch in batches:
            for lang, bucket, body in zip(*(batch.column(i) for i in range(3))):
                key = (lang.as_py(), bucket.as_py())
                if now is not None and key != now:
                    step()
                    packed.clear()
                    if key[0] != now[0] or sum(t.num_rows for t in lower) > held_rows:
                        yield from flush(now[0])
                now = key
                packed.append(body.as_py())
        if now is not None:
            step()
            yield from flush(now[0])

    placed = lines.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    return placed.mapInArrow(run, LINES + ", phrase string, n long")


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, text_col: str = "text",
                  lang_col: str = "lang", bucket_bytes: int = 3_000_000) -> DataFrame:
    """lang, size, phrase, f of every phrase of at most `longest` words with f >= least; size 0: all words."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    lines, stayed = windows(docs, longest, buckets, text_col, lang_col), []
    for length in range(longest, 0, -1):
        step = settle(fold(lines, length, least, buckets))
        stayed.append(step.where("phrase is not null").select("lang", "phrase", "n"))
        lines = step.where("body is not null").select("lang", "bucket", "body")
    rows = stayed[0]
    for more in stayed[1:]:
        rows = rows.unionByName(more)
    parts = F.split(F.col("phrase"), " ")
    names = [f"w{i + 1}" for i in range(longest)]
    rows = rows.select("lang", "n", *[
        F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(w) for i, w in enumerate(names)])
    rolled = rows.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # Of `longest` words, g names those added over: the last ones.
    rolled = rolled.withColumn("size", longest - F.log2(F.col("g") + 1).cast("int")).where("size >= 0")
    last = F.element_at(F.array(F.lit("-"), *names), F.col("size") + 1)
    return rolled.where(last.isNotNull()).select("lang", "size", F.concat_ws(" ", *names).alias("phrase"), "f")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, share: int = 50,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of 2 to `longest` words that belong together most.

    Words are lower-cased (A-Z) and split at blanks and tabs; phrases never cross `.,;:!?` or a line end.
    Everything is per language (null: `und`). A phrase with a = f(phrase) >= least is a candidate; a cut into
    two phrases found l and r times scores floor(1000000 a a / (l r)), exactly, and the cut of least score
    counts (ties: the shortest first part). A candidate found inside a longer one that has at least `share`
    per cent of its count goes. Of each language the first `top` by score, a, phrase come out.

    Null texts are empty; texts without a word give nothing, and so does an empty table. Repeated rows count
    as often as they come. Extra columns are ignored, whatever their names.
    """
    counts = settle(phrase_counts(docs, longest, least, text_col, lang_col))
    found = counts.where("size >= 2").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def text(first, count):
        return F.array_join(F.slice("w", first, count), " ")

    size = F.size("w")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        k.alias("k"), text(1, k).alias("left"), text(k + 1, size - k).alias("right")))
    cut = found.select("lang", "phrase", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    for side, name in (("left", "l"), ("right", "r")):
        part = counts.where("size >= 1").select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cut = cut.join(part, ["lang", side])
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, l * r)
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: text(i, m))))
    inside = found.where(size > 2).select("lang", "a", F.explode(inner).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share))
    ranked = add_rank(left.select("lang", "phrase", "a", "s.l", "s.r", "s.score"),
                      [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], ["lang"])
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.where(F.col("rank") <= top).join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
