"""Substring dedup (operator 1): an FM-index per shard finds word windows that occur twice."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.fm_index import repeated_windows
from chainlake.session import discard, release, settle

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: int) -> np.ndarray:
    """A hash of each slice of `values` that depends on its content alone."""
    n = len(values)
    up = np.full(n + 1, odd, np.uint64)
    down = np.full(n + 1, pow(odd, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    total = np.concatenate([[np.uint64(0)], np.cumsum(values * up[:n])])
    return _mixed((total[ends] - total[starts]) * down[starts])


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return values if span == width else np.minimum(values[:span - width], values[width - span:])


def anchored_runs(texts: list[bytes], window: int, gram: int):
    """Windows of each text, in runs that share an anchor: (text, start, count, key) arrays.

    A window's anchor is its `gram`-word slice of least hash, the first if there are several;
    key is that slice's hash. Equal windows, wherever they stand, have equal keys and anchors at
    the same place inside them, so two equal windows never share a run's anchor.
    """
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    white = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    letters, white = white.astype(np.uint64) + np.uint64(1), WHITE[white]
    edge = np.diff(white.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    none = np.zeros(0, np.int64)
    if len(starts) < window:
        return none, none, none, none
    words = _slice_hashes(letters, starts, ends, 0x9E3779B97F4A7C15)
    doc = np.searchsorted(np.cumsum(sizes), starts, "right")
    first = np.searchsorted(doc, np.arange(len(texts)))
    at = np.arange(len(words) - gram + 1)
    grams = _slice_hashes(words, at, at + gram, 0xD1B54A32D192ED03)
    low = np.uint64(0xFFFFFFFF)
    ranked = (grams & ~low) | at.astype(np.uint64)
    anchor = (_least_of(ranked, window - gram + 1) & low).astype(np.int64)
    whole = np.flatnonzero(doc[:len(anchor)] == doc[window - 1:])
    if not len(whole):
        return none, none, none, none
    anchor = anchor[whole]
    head = np.flatnonzero(np.diff(anchor, prepend=-1))
    count = np.diff(np.append(head, len(anchor)))
    start = whole[head]
    return doc[start], start - first[doc[start]], count, grams[anchor[head]].view(np.int64)


def _in_chunks(column, most: int = 1 << 20):
    """(first row, texts as bytes) of some rows at a time, at least one."""
    held, size, first = [], 0, 0
    for i, text in enumerate(column):
        held.append((text.as_py() or "").encode())
        size += len(held[-1])
        if size >= most:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def window_runs(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, mark, and the runs (key, start, count) of every text; no shuffle."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for first, texts in _in_chunks(batch.column(2)):
                doc, start, count, key = anchored_runs(texts, window, gram)
                stops = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(stops, pa.array(v)) for v in
                         (key, start.astype(np.int32), count.astype(np.int8))]
                ours = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ours.column(0), ours.column(1), *lists], names=["doc_id", "mark", "key", "start", "count"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, mark long, key array<bigint>, start array<int>, count array<tinyint>")


def candidate_segments(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Runs whose key occurs twice or more, with their words: doc_id, mark, key, start, seg, words.

    words is null where the same task has already given this segment's words.
    """
    import pyarrow as pa
    from xxhash import xxh64_intdigest

    runs = settle(window_runs(rows, window, gram))
    again = settle(runs.select(F.explode("key").alias("key")).groupBy("key").count()
                   .where("count > 1").select("key"))
    each = runs.select("doc_id", "mark", F.explode(F.arrays_zip("key", "start", "count")).alias("r"))
    wanted = (each.select("doc_id", "mark", "r.*").join(again, "key")
              .groupBy("doc_id", "mark").agg(F.collect_set(F.struct("key", "start", "count")).alias("runs")))
    # A row without id meets its runs too.
    meet = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.mark") == F.col("w.mark"))
    found = rows.alias("t").join(wanted.alias("w"), meet).select("t.doc_id", "t.mark", "t.text", "w.runs")

    def cut(batches):
        seen: set = set()
        for batch in batches:
            for first in range(0, batch.num_rows, 50):
                some = batch.slice(first, 50)
                row, keys, starts, segs, texts = [], [], [], [], []
                for i, (text, wanted) in enumerate(zip(some.column(2), some.column(3))):
                    words = text.as_py().encode().split()
                    for r in wanted.as_py():
                        at = r["start"]
                        words_of = b" ".join(words[at:at + r["count"] + window - 1])
                        seg = xxh64_intdigest(words_of)
                        new = (r["key"], seg) not in seen
                        if new:
                            if len(seen) > 100_000:
                                seen.clear()
                            seen.add((r["key"], seg))
                        row.append(i), keys.append(r["key"]), starts.append(at)
                        segs.append(seg), texts.append(words_of if new else None)
                ours = some.select([0, 1]).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ours.column(0), ours.column(1), pa.array(keys, pa.int64()), pa.array(starts, pa.int32()),
                     pa.array(np.array(segs, np.uint64).view(np.int64)), pa.array(texts, pa.string())],
                    names=["doc_id", "mark", "key", "start", "seg", "words"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = settle(found.mapInArrow(cut, f"doc_id {kind}, mark long, key long, start int, seg long, words string"))
    discard(runs, again)
    return out


def repeated_spans(segments: DataFrame, window: int, shard_words: int = 500_000,
                   key_segments: int = 20_000) -> DataFrame:
    """key, seg and the word span [from, to) of each stretch of repeated windows.

    Equal segments are one row with a weight first. Segments go to shards by key, so all equal
    windows meet; a shard's index is built over at most about `shard_words` words, cut between keys.
    The segments of a key that has more than `key_segments` of them are cut into single windows;
    equal ones become one row with the sum of their weights before they are dealt, by their own
    words, so neither a key nor a window that stands in many segments grows into one task.
    """
    import pyarrow as pa

    distinct = settle(segments.groupBy("key", "seg").agg(
        F.max("words").alias("words"), F.count(F.lit(1)).alias("weight")))
    hot = settle(distinct.groupBy("key").count().where(F.col("count") > key_segments)
                 .select("key", F.lit(True).alias("hot")))
    marked = distinct.join(hot, "key", "left").withColumn("w", F.split("words", " "))
    plain = marked.where("hot is null").select(
        F.col("key").alias("place"), "key", "seg", F.lit(None).cast("string").alias("digest"), "words", "weight",
        F.size("w").alias("n"))
    cut = marked.where("hot").select("key", "seg", "w", "weight", F.explode(
        F.sequence(F.lit(0), F.size("w") - window)).alias("at"))
    cut = cut.withColumn("words", F.array_join(F.slice("w", F.col("at") + 1, window), " ")).select(
        "key", "seg", "at", F.sha2("words", 256).alias("digest"), "words", "weight")
    # Equal windows of different segments add up ahead of the shuffle and are one row from here on.
    windows = cut.groupBy("digest").agg(F.max("words").alias("words"), F.sum("weight").alias("weight"))
    none = F.lit(None).cast("long")
    placed = plain.unionByName(windows.select(
        F.xxhash64("digest").alias("place"), none.alias("key"), none.alias("seg"), "digest", "words", "weight",
        F.lit(window).alias("n")))
    spark = segments.sparkSession
    total = distinct.agg(F.sum(F.size(F.split("words", " ")))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_words))

    def judge(block):
        got = pa.Table.from_batches(block)
        words = " ".join(got["words"].to_pylist()).split(" ")
        numbers = pa.array(words).dictionary_encode().indices.to_numpy().astype(np.int64) + 1
        stops = np.cumsum(got["n"].to_numpy())
        pieces = np.split(numbers, stops[:-1])
        row, begin, end = [], [], []
        for i, hits in enumerate(repeated_windows(pieces, got["weight"].to_numpy(), window)):
            edge = np.flatnonzero(np.diff(hits.astype(np.int8), prepend=0, append=0))
            for a, b in zip(edge[::2], edge[1::2]):
                row.append(i), begin.append(a), end.append(b + window - 1)
        ours = got.select(["key", "seg", "digest"]).take(pa.array(row, pa.int64()))
        return pa.table({"key": ours["key"], "seg": ours["seg"], "digest": ours["digest"],
                         "from": pa.array(begin, pa.int32()), "to": pa.array(end, pa.int32())}).to_batches()

    def search(batches):
        held, size, last = [], 0, None
        for batch in batches:
            place = batch.column(0).to_numpy()
            n = np.cumsum(batch.column(5).to_numpy())
            cut = 0
            for at in np.flatnonzero(np.diff(place, prepend=place[0] if last is None else last)):
                if size + (n[at - 1] if at else 0) - (n[cut - 1] if cut else 0) >= shard_words:
                    held.append(batch.slice(cut, at - cut))
                    yield from judge(held)
                    held, size, cut = [], 0, at
            held.append(batch.slice(cut))
            size += int(n[-1] - (n[cut - 1] if cut else 0))
            last = place[-1]
        if size:
            yield from judge(held)

    dealt = (placed.select("place", "key", "seg", "digest", "words", F.col("n").cast("long"), "weight")
             .repartition(shards, "place").sortWithinPartitions("place"))
    judged = settle(dealt.mapInArrow(search, "key long, seg long, digest string, `from` int, `to` int"))
    # Both sides are read from tables, so a digest that stands in very many segments is split like any hot key.
    at = settle(cut.select("key", "seg", "at", "digest"))
    again = at.join(judged.where("digest is not null").select("digest"), "digest").select(
        "key", "seg", F.col("at").cast("int").alias("from"), (F.col("at") + window).cast("int").alias("to"))
    spans = settle(judged.where("digest is null").select("key", "seg", "from", "to").unionByName(again))
    discard(distinct, hot, judged, at)
    return spans


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 12, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept, spans of every document.

    Words are cut at ASCII white space and unchanged. A word goes when a window of `window`
    consecutive words around it also starts anywhere else, in its own document too; windows are
    judged on the input. `kept` has the words left, joined by one space; `spans` the removed word
    ranges [from, to), joined where they touch.

    Windows are gathered by anchors, so that only stretches whose anchor occurs twice are shuffled
    with their words, and every window exactly once. FM-indexes of these stretches then decide.
    Null and word-less texts have no words; shorter texts than a window lose none. Repeated rows
    are repeats of each other, and rows without id are judged like others. Extra columns are ignored.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    segments = candidate_segments(rows, window, gram)
    release(docs.sparkSession)
    spans = repeated_spans(segments, window)
    release(docs.sparkSession)
    places = segments.select("doc_id", "mark", "key", "seg", "start").join(spans, ["key", "seg"])
    spans_of = settle(places.groupBy("doc_id", "mark").agg(F.collect_set(F.struct(
        (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))).alias("spans")))
    discard(segments, spans)
    release(docs.sparkSession)
    meet = F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("t.mark") == F.col("s.mark"))
    met = rows.alias("t").join(spans_of.alias("s"), meet, "left").select("t.doc_id", "t.text", "s.spans")

    def strip(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 50):
                some = batch.slice(at, 50)
                n_words, n_removed, digests, kept, spans = [], [], [], [], []
                for text, found in zip(some.column(1), some.column(2)):
                    words = text.as_py().encode().split()
                    gone = joined([(s["from"], s["to"]) for s in found.as_py() or ()])
                    edges = [0, *(x for span in gone for x in span), len(words)]
                    left = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                    whole = b" ".join(left)
                    n_words.append(len(words)), n_removed.append(len(words) - len(left))
                    digests.append(sha256(whole).hexdigest()), kept.append(whole.decode())
                    spans.append([{"from": a, "to": b} for a, b in gone])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(digests, pa.string()), pa.array(kept, pa.string()),
                     pa.array(spans, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"])

    return met.mapInArrow(strip, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, "
                                 "kept string, spans array<struct<`from`: int, `to`: int>>")


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
