"""Records meet their block inside the stream: one keyed state per few block numbers, with timers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# Payloads are long texts of few letters, which zstd packs tighter than the default.
STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}
DAY = 24 * 3600 * 1000


class BlockPairing(StatefulProcessor):
    """State of the numbers that differ in their last character only: blocks that have come, and records that wait.

    Every call to the state costs a trip to the JVM, so a batch makes two or three for all numbers of a key.
    The state only grows by what is new, and nothing in it is written again: a record it holds waits as long as
    its block is not held too, and came out in the batch that brought the block. Whatever is held for a number goes
    when its timer fires, `keep_ms` after the number was first seen; records whose block never came come out
    then as not `paired`. The last column of an input row says when it arrived.
    """

    def __init__(self, row_type: T.StructType, kind: str, number: str, keep_ms: int):
        self.row_type, self.keep_ms = row_type, keep_ms
        self.at, self.number = map(row_type.fieldNames().index, (kind, number))

    def init(self, handle) -> None:
        self.handle = handle
        until = T.StructField("_until", T.LongType())
        self.held = handle.getListState("held", T.StructType([*self.row_type.fields, until]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        blocks, waiting, until = {}, {}, {}
        for *row, end in self.held.get():
            self._sort_in(tuple(row), blocks, waiting)
            until[row[self.number]] = end
        known, came = set(blocks), {}
        waiting = {n: records for n, records in waiting.items() if n not in known}
        for *row, _, _, arrived in rows:
            row = tuple(row)
            if row[self.number] not in until:
                until[row[self.number]] = arrived + self.keep_ms
                self.handle.registerTimer(arrived + self.keep_ms)
            self._sort_in(row, blocks, came)
        fresh = [blocks[n] for n in blocks if n not in known]
        fresh += [row for n in came if n not in blocks for row in came[n]]
        if fresh:
            self.held.appendList([(*row, until[row[self.number]]) for row in fresh])
        for n, block in blocks.items():
            records = [*waiting.get(n, []), *came.get(n, [])]
            if records or n not in known:
                yield self._out(block, n not in known)
            for row in records:
                yield self._out(row, True)

    def _sort_in(self, row: tuple, blocks: dict, records: dict) -> None:
        if row[self.at] != "block":
            records.setdefault(row[self.number], []).append(row)
        else:
            blocks.setdefault(row[self.number], row)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, left, held = expiredTimerInfo.getExpiryTimeInMs(), [], [tuple(row) for row in self.held.get()]
        served = {row[self.number] for row in held if row[self.at] == "block"}
        for *row, end in held:
            if end > now:
                left.append((*row, end))
            elif row[self.number] not in served:
                yield self._out(tuple(row), False, False)
        if left:
            self.held.put(left)
        else:
            self.held.clear()

    def close(self) -> None:
        pass

    def _out(self, row: tuple, new: bool, paired: bool = True) -> Row:
        return Row(**dict(zip(self.row_type.names, row)), paired=paired, new=new)


def pair_blocks(stream: DataFrame, kind: str = "kind", number: str = "number", keep_ms: int = DAY) -> DataFrame:
    """The rows of a stream, each record together with the block it belongs to, whenever either arrives.

    A row whose `kind` is `block` is the block of its `number` (the first one counts), all others are records.
    A record comes out once, in the batch in which it and its block are both there, and the block with it:
    `paired` is true for these, and `new` tells a block's first time from its repeats for late records. The
    state of a number lives in the stream's checkpoint for `keep_ms` and then goes, so it does not grow with
    the chain; records still waiting then come out with `paired` false, for the sink to keep apart, as do in
    the end records that come after their block's state has gone. Nothing is dropped.
    """
    for key, value in STORE.items():
        stream.sparkSession.conf.set(key, value)
    # Time is the time of arrival, so no row is ever late and the clock moves with the batches.
    timed = stream.withColumn("_at", F.current_timestamp()).withWatermark("_at", "0 seconds")
    timed = timed.withColumn("_arrived", F.unix_millis("_at"))
    out = T.StructType([*stream.schema.fields, T.StructField("paired", T.BooleanType()), T.StructField("new", T.BooleanType())])
    text = F.col(number).cast("string")
    timed = timed.withColumn("_near", F.left(text, F.length(text) - 1))
    return timed.select(*stream.columns, "_near", "_at", "_arrived").groupBy("_near").transformWithState(
        statefulProcessor=BlockPairing(stream.schema, kind, number, keep_ms), outputStructType=out,
        outputMode="Append", timeMode="EventTime")
