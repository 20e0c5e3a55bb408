"""Sequence packing (operator 7): best-fit decreasing over a tree of capacities."""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.words import WordEncoder, gathered, sent_tokens
from chainlake.session import settle


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree over the capacities.

    A tree node says whether any capacity below it has an open window, so the tightest
    window that still takes a piece is one walk up and one walk down.
    """

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.any = [0] * (2 * self.base)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, number: int) -> None:
        self.at[capacity].append(number)
        node = self.base + capacity
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window of least capacity >= need: (capacity, number)."""
        node = self.base + need
        while not self.any[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.base:
            node = 2 * node + (not self.any[2 * node])
        capacity = node - self.base
        number = self.at[capacity].pop()
        if not self.at[capacity]:
            self.any[node] = 0
            while node > 1 and not self.any[node ^ 1]:
                node >>= 1
                self.any[node] = 0
        return capacity, number


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length; lengths come in falling order."""
    tree, opened = OpenWindows(window), 0
    number = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    for i, need in enumerate(lengths.tolist()):
        found = tree.tightest(need)
        if found is None:
            found, opened = (window, opened), opened + 1
        capacity, number[i] = found
        offset[i] = window - capacity
        if capacity > need:
            tree.put(capacity - need, number[i])
    return number, offset


FULL = 1 << 62  # sequence numbers of windows that are full as they are cut


def cut_pieces(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1,
               keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize every whole text, append `end_id`, cut full windows off; no shuffle.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, full (the sequence number of a
    full window, by partition and place in it; null for what remains of a text), and with `keep_ids`
    the ids themselves (array<int>).
    """
    import pyarrow as pa

    known = sent_tokens(docs.sparkSession, path)
    tail = np.array([end_id], "<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()
    step = 4 * window

    def run(batches):
        from pyspark import TaskContext

        coder = WordEncoder(path, known.value)
        number = FULL + (TaskContext.get().partitionId() << 40)
        for table in gathered(batches, 1):
            row, start, length, crc, total, full, ids = [], [], [], [], [], [], []
            for i, code in enumerate(coder.encode(table.column(1).combine_chunks())):
                code += tail
                for at in range(0, len(code), step):
                    piece = code[at:at + step]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(crc32(piece))
                    total.append(len(code) // 4)
                    full.append(number if len(piece) == step else None)
                    number += len(piece) == step
                    if keep_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
            cols = [table.column(0).combine_chunks().take(pa.array(row, pa.int64()))]
            cols += [pa.array(c, pa.int64()) for c in (start, length, crc, total, full)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "full"]
            if keep_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, full long"
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, shard_rows: int = 60_000,
         shard_ids: int = 16_000_000, keep_ids: bool = False, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most `window` tokens.

    Texts longer than a window are first cut into full windows, each a sequence of its own, numbered
    where it is cut. What remains of every document is placed whole by best-fit decreasing, within
    shards of about `shard_rows` remainders (with `keep_ids` also of at most some `shard_ids` ids) dealt
    out evenly whatever their ids, so hot keys do not matter and a task's memory is bounded. Pieces are a
    table in the shared folder; a shard sorts what it gets, so a task run again gives the same sequences.

    Returns doc_id, start, length, ids_crc32, doc_tokens, with `keep_ids` ids, then sequence_id and offset;
    offsets in a sequence are gapless from 0. A null text is empty: one piece of one token, the end id.
    Repeated rows are packed as often as they come. Extra columns are ignored, whatever their names. An
    empty table gives no rows.
    """
    import pyarrow as pa

    pieces = settle(cut_pieces(docs, path, window, end_id, keep_ids, id_col, text_col))
    tails = pieces.where("full is null").drop("full")
    rows, tokens = tails.agg(F.count(F.lit(1)), F.sum("length")).first()
    shards = max(1, -(-rows // shard_rows), -(-(tokens or 0) // shard_ids) if keep_ids else 1)

    def run(batches):
        from pyspark import TaskContext

        batches = list(batches)
        if not batches:
            return
        got = pa.Table.from_batches(batches).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        number, offset = best_fit(got["length"].to_numpy(), window)
        shard = TaskContext.get().partitionId()
        got = got.append_column("sequence_id", pa.array(number + (shard << 40), pa.int64()))
        got = got.append_column("offset", pa.array(offset, pa.int64()))
        yield from got.to_batches(max_chunksize=10_000)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tails.schema)
    whole = pieces.where("full is not null").withColumn("sequence_id", F.col("full")).drop("full")
    placed = tails.repartition(shards).mapInArrow(run, schema + ", sequence_id long, offset long")
    return whole.withColumn("offset", F.lit(0).cast("long")).unionByName(placed)
