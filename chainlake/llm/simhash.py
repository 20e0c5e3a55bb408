"""SimHash near-duplicates (operator 5): binary trie self-join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.components import components
from chainlake.llm.local_graph import merge
from chainlake.session import release, settle

BLOCK = 16  # bits of the exact block that names a cell: with 4 blocks and 3 bits, one agrees
LANES = np.uint64(0x0101010101010101)


def bit_sums(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many hashes of each slice have each bit: int64 of shape (slices, 64), bit 0 first.

    `ends` holds the rising ends of non-empty slices. Eight bits ride in the bytes of one word,
    which holds up to 255 hashes before it is unfolded.
    """
    starts = np.concatenate([[0], ends[:-1]])
    cuts = np.concatenate([np.arange(s, e, 255) for s, e in zip(starts, ends)])
    rows = np.searchsorted(cuts, starts)
    out = np.empty((len(ends), 8, 8), np.int64)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & LANES, cuts)
        out[:, :, shift] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), rows)
    return out.reshape(-1, 64)


def shingle_hashes(text: str, size: int) -> list[int]:
    """XXH64 (seed 42) of every word shingle, repeats included; words as ASCII white space cuts."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if len(words) <= size:
        return [xxh64_intdigest(b" ".join(words), 42)] if words else []
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    return [xxh64_intdigest(whole[s:e], 42) for s, e in zip(starts, (ends[size - 1:] - 1).tolist())]


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, mark (a hash of the text) and 64-bit SimHash (fp, a signed long) of every whole text; no shuffle.

    A bit is 1 if it is set in over half of the shingle hashes. Null and word-less texts have
    fingerprint 0. A task holds the hashes of some documents at a time, at least one.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            held, ends, rows = [], [], []

            def flush():
                if rows:
                    cut = np.array(ends)
                    sums = bit_sums(np.array(held, np.uint64), cut)
                    total = np.diff(cut, prepend=0)
                    bits = np.packbits(2 * sums > total[:, None], axis=1, bitorder="little")
                    out[rows] = bits.view(np.uint64).ravel()
                    held.clear(), ends.clear(), rows.clear()

            for i, text in enumerate(batch.column(1)):
                got = shingle_hashes(text.as_py() or "", shingle)
                if got:
                    held.extend(got)
                    ends.append(len(held))
                    rows.append(i)
                if len(held) > 200_000:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(out.view(np.int64))], names=["doc_id", "mark", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("mark"))
    return picked.mapInArrow(run, f"doc_id {kind}, mark long, fp long")


def trie_join(cells: np.ndarray, keys: np.ndarray, depth: int, budget: int,
              chunk: int = 1 << 18) -> np.ndarray:
    """Sets of keys of one cell that chains of links within `budget` bits connect.

    cells and keys are sorted by (cell, key); keys of a cell agree on the first `depth` bits.
    A trie node is a range of the sorted keys. Pairs of nodes, at first every cell with
    itself, go down the trie together and collect the bits by which they differ; a pair goes
    when that passes the budget, when its bits left are within the budget (all its leaves
    then link), or when its leaves are known to be one set already. Pairs wait on a stack in
    chunks, so memory does not grow with their number. Returns label[i] <= i.
    """
    n = len(keys)
    label = np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if n else np.zeros(0, int)
    last = np.concatenate([first[1:], [n]]) if n else first
    zeros: dict[int, np.ndarray] = {}

    def middle(lo, hi, d):
        if d not in zeros:
            ones = (keys >> np.uint64(63 - d)) & np.uint64(1)
            zeros[d] = np.concatenate([[0], np.cumsum(ones == 0)]).astype(np.int32)
        return lo + zeros[d][hi] - zeros[d][lo]

    # The same two ends mean a node with itself.
    stack = [(depth, first, last, first, last, np.zeros(len(first), np.int8))]
    while stack:
        d, al, ah, bl, bh, dist = stack.pop()
        if len(al) > chunk:
            for s in range(0, len(al), chunk):
                stack.append((d, *(x[s:s + chunk] for x in (al, ah, bl, bh, dist))))
            continue
        step = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])]) if n else label
        same = al == bl
        one = (step[al] == step[ah - 1]) & (step[bl] == step[bh - 1]) & (label[al] == label[bl])
        go = ~one & ~(same & (ah - al == 1))
        al, ah, bl, bh, dist, same = (x[go] for x in (al, ah, bl, bh, dist, same))
        # All leaves link: chain each range and tie the two.
        near = 64 - d <= budget - dist
        # Two leaves: the rest of their bits decides at once.
        leaf = ~near & (ah - al == 1) & (bh - bl == 1)
        far = np.bitwise_count(keys[al[leaf]] ^ keys[bl[leaf]])
        pairs = [(al[leaf][far <= budget], bl[leaf][far <= budget]), (al[near], bl[near])]
        for lo, hi in ((al[near], ah[near]), (bl[near], bh[near])):
            size = hi - lo - 1
            at = np.repeat(lo, size) + _within(size)
            pairs.append((at, at + 1))
        merge(label, *(np.concatenate(x) for x in zip(*pairs)))
        rest = ~near & ~leaf
        al, ah, bl, bh, dist, same = (x[rest] for x in (al, ah, bl, bh, dist, same))
        if not len(al):
            continue
        am, bm = middle(al, ah, d), middle(bl, bh, d)
        more = dist + np.int8(1)
        kids = [(al, am, bl, bm, dist), (am, ah, bm, bh, dist), (al, am, bm, bh, more)]
        other = ~same
        kids.append(tuple(x[other] for x in (am, ah, bl, bm, more)))
        al, ah, bl, bh, dist = (np.concatenate(x) for x in zip(*kids))
        keep = (al < ah) & (bl < bh) & (dist <= budget)
        stack.append((d + 1, *(x[keep] for x in (al, ah, bl, bh, dist))))
    return label


def _within(size: np.ndarray) -> np.ndarray:
    """0..size[i]-1 for each i, one after the other."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def fingerprint_links(fps: DataFrame, budget: int = 3, task_rows: int = 400_000,
                      cell_rows: int = 100_000) -> DataFrame:
    """Links (a, b) whose chains connect exactly the fingerprints (fp, distinct) that links of
    `budget` or fewer differing bits connect.

    Fingerprints are cut into budget + 1 blocks; two within the budget agree on a block, so
    each block in turn, moved to the front, names a cell, and cells join independently. A cell
    beyond `cell_rows` is cut again, by the blocks of its other bits. A cell gives at most one
    link per member, however many pairs are within the budget.
    """
    import pyarrow as pa

    blocks = budget + 1
    width = 64 // blocks
    turned = F.explode(F.array(*[
        F.struct(F.lit(r).alias("turn"), _turn(F.col("fp"), r * width).alias("key")) for r in range(blocks)]))
    cells = fps.select(turned.alias("t")).select(
        (F.col("t.turn") * (1 << width) + F.shiftrightunsigned("t.key", 64 - width)).alias("cell"),
        "t.turn", "t.key")
    hot = cells.groupBy("cell").count().where(F.col("count") > cell_rows).select("cell", F.lit(True).alias("hot"))
    hot = settle(hot)
    inner = (64 - width) // blocks
    again = F.explode(F.when(F.col("hot"), F.array(*[
        F.struct(F.lit(r).alias("sub"),
                 F.shiftrightunsigned(F.shiftleft("key", width + r * inner), 64 - inner).alias("block"))
        for r in range(blocks)])).otherwise(F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("block")))))
    cut = cells.join(hot, "cell", "left").select("cell", "turn", "key", again.alias("s"))
    cut = cut.select(F.xxhash64("cell", "s.sub", "s.block").alias("place"), "cell", "turn", "key",
                     F.col("s.sub").alias("sub"), F.col("s.block").alias("block"))
    spark = fps.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks * fps.count() // task_rows))

    def run(batches):
        batches = list(batches)
        if not batches:
            return
        got = pa.Table.from_batches(batches)
        cell, turn, sub, block = (got[c].to_numpy() for c in ("cell", "turn", "sub", "block"))
        key = got["key"].to_numpy().view(np.uint64)
        order = np.lexsort((key, block, sub, cell))
        cell, turn, sub, block, key = (x[order] for x in (cell, turn, sub, block, key))
        new = np.zeros(len(key), np.int64)
        new[1:] = np.cumsum((cell[1:] != cell[:-1]) | (sub[1:] != sub[:-1]) | (block[1:] != block[:-1]))
        label = trie_join(new, key, width, budget)
        at = np.flatnonzero(label != np.arange(len(label)))
        back = (turn.astype(np.uint64) * np.uint64(width))
        fp = _turn_back(key, back).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[label[at]])], names=["a", "b"])

    return cut.repartition(tasks, "place").drop("place").mapInArrow(run, "a long, b long")


def _turn(col, by: int):
    """Bits turned left by `by`."""
    return col if by == 0 else F.shiftleft(col, by).bitwiseOR(F.shiftrightunsigned(col, 64 - by))


def _turn_back(key: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.where(by == 0, key, (key >> by) | (key << ((np.uint64(64) - by) & np.uint64(63))))


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, mark and keeper of every document.

    Fingerprints that differ in at most `budget` bits link; component_id is the smallest doc_id
    reachable by links, itself included. Equal fingerprints are one row before any link is sought.
    keeper is true for the row that stands for its component: the one with the smallest doc_id, and
    among rows with that id the one whose text has the smallest hash (`mark`). Null ids take no part in
    the minimum; a component of null ids only has none, and keeps the text of smallest hash. Repeated
    rows come out as often as they come in, keepers too. Extra columns are ignored; an empty table
    gives no rows.
    """
    fps = settle(fingerprints(docs, shingle, id_col, text_col))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    least = settle(fps.groupBy("fp").agg(F.min(first).alias("least")))
    release(docs.sparkSession)
    linked = components(fingerprint_links(least.select("fp"), budget))
    release(docs.sparkSession)
    named = settle(least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                   .withColumn("root", F.coalesce("root", "fp")))
    roots = named.groupBy("root").agg(F.min("least").alias("first"))
    names = settle(named.join(roots, "root").select("fp", "first"))
    return fps.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"), "mark",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))).alias("keeper"))


def one_of_each(docs: DataFrame, shingle: int = 3, budget: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, that stand for their components.

    Rows that repeat a keeper's id and text go too; of their other columns the least combination stays.
    """
    judged = near_duplicates(docs, shingle, budget, id_col, text_col)
    kept = judged.where("keeper").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    marked = docs.withColumn("__hash", F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__mark"))
    found = marked.join(kept, same, "left_semi")
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    one = found.groupBy(id_col, "__hash", text_col).agg(F.min(F.struct(*rest)).alias("__rest")) if rest \
        else found.distinct()
    return one.select(*[F.col(c) if c in (id_col, text_col) else F.col("__rest")[c].alias(c) for c in docs.columns])
