"""Benchmark decontamination (operator 2): q-gram lemma filter, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.session import discard, settle

LADDER = [12, 10, 8, 6, 5, 4, 3, 2, 1]  # q-gram lengths in use
EDIT = 1 << 32                          # one edit, above the start kept in the low bits
_plain = np.array([chr(c).isalnum() for c in range(128)])


def normal_form(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with one space for every run of other ASCII signs, and their places."""
    low = text.lower()
    if len(low) != len(text):  # a few letters become two in lower case; these stay
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    letter = (codes >= 128) | _plain[np.minimum(codes, 127)]
    keep = letter.copy()
    keep[1:] |= letter[:-1]          # the first sign after a letter stands for its run
    at = np.flatnonzero(keep)
    out = np.where(letter[at], codes[at], np.uint32(32))
    if len(out) and out[-1] == 32:
        out, at = out[:-1], at[:-1]
    return out, at


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q consecutive codes."""
    odd = 0x9E3779B97F4A7C15
    part, span = codes.astype(np.uint64) + np.uint64(1), 1
    out, size = None, 0
    power = odd                       # odd ** span
    while True:
        if q & span:
            out = part if out is None else out[:len(out) - span] * np.uint64(power) + part[size:][:max(0, len(out) - span)]
            size += span
        if 2 * span > q:
            break
        part = part[:max(0, len(part) - span)] * np.uint64(power) + part[span:]
        power, span = power * power % (1 << 64), 2 * span
    out = out[:max(0, len(codes) - q + 1)]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class ItemIndex:
    """q-grams of a block of benchmark items, with each item's edit budget."""

    def __init__(self, items: list[tuple], rate: float, least_chars: int):
        self.ids, self.codes, self.budget, self.need = [], [], [], []
        grams: dict[int, list] = {}
        for item_id, text in items:
            codes, _ = normal_form(text or "")
            m = len(codes)
            if m < max(1, least_chars):
                continue
            k = int(rate * m)
            q = next(n for n in LADDER if n <= m // (k + 1))
            number = len(self.ids)
            self.ids.append(item_id), self.codes.append(codes), self.budget.append(k)
            # The lemma: k edits leave at least this many of the item's q-grams whole.
            self.need.append(m + 1 - q * (k + 1))
            hashes = gram_hashes(codes, q)
            grams.setdefault(q, []).append((hashes, np.full(len(hashes), number), np.arange(len(hashes))))
        self.budget, self.need = np.array(self.budget, np.int64), np.array(self.need, np.int64)
        self.by_q = {}
        for q, found in grams.items():
            hashes, item, at = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(hashes, kind="stable")
            keys, first = np.unique(hashes[order], return_index=True)
            bits = max(16, min(26, int(len(keys)).bit_length() + 6))
            maybe = np.zeros(1 << bits, bool)
            maybe[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.by_q[q] = (keys, np.append(first, len(order)), item[order], at[order], maybe, np.uint64(64 - bits))

    def regions(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, band) pairs that share enough q-grams; band b of an item with budget k covers the
        diagonals from b (k + 1) up to (b + 2) (k + 1)."""
        keys_found = []
        for q, (keys, first, item, at, maybe, shift) in self.by_q.items():
            hashes = gram_hashes(codes, q)
            place = np.flatnonzero(maybe[(hashes >> shift).astype(np.int64)])
            slot = np.searchsorted(keys, hashes[place])
            real = keys[np.minimum(slot, len(keys) - 1)] == hashes[place]
            place, slot = place[real], slot[real]
            many = first[slot + 1] - first[slot]
            entry = np.repeat(first[slot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            which = item[entry]
            # Diagonals count from the text's start; the added item length keeps them positive.
            band = (np.repeat(place, many) - at[entry] + (1 << 30)) // (self.budget[which] + 1)
            keys_found += [(which << 40) | band, (which << 40) | (band - 1)]
        if not keys_found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, count = np.unique(np.concatenate(keys_found), return_counts=True)
        key = key[count >= self.need[key >> 40]]
        which = key >> 40
        step = self.budget[which] + 1
        # Back to a diagonal: bands are counted from -(1 << 30).
        return which, (key & ((1 << 40) - 1)) * step - (1 << 30)

    def align(self, number: np.ndarray, codes: np.ndarray, diagonal: np.ndarray):
        """(edits, start, end) of the best place of each item in its band, all bands at once.

        A match's whole grams lie on k + 1 neighbouring diagonals from `diagonal` on and the rest strays
        at most k from them, so only a band of 4 k + 3 diagonals is filled (the widest of the batch).
        Longer items stand first, so that those still at work are a prefix. The start rides in the
        low bits.
        """
        size = np.array([len(self.codes[i]) for i in number])
        order = np.argsort(-size, kind="stable")
        number, size, low = number[order], size[order], (diagonal - self.budget[number])[order]
        longest, width = int(size[0]), 4 * int(self.budget[number].max()) + 3
        letters = np.zeros((len(number), longest), np.uint32)
        for row, i in enumerate(number):
            letters[row, :size[row]] = self.codes[i]
        # The text under each band; signs beyond its ends equal no letter.
        place = low[:, None] + np.arange(longest + width)
        under = np.where((place >= 0) & (place < len(codes)), codes[np.clip(place, 0, len(codes) - 1)], np.uint32(0))
        step = np.arange(width) * EDIT
        base = int(low.min())
        cost = low[:, None] + np.arange(width) - base      # no edits yet, and where it starts
        active = np.searchsorted(-size, -np.arange(longest), "left")
        for i in range(longest):
            n = active[i]
            now = cost[:n]
            best = now + EDIT * (under[:n, i:i + width] != letters[:n, i:i + 1])  # take or replace
            np.minimum(best[:, :-1], now[:, 1:] + EDIT, out=best[:, :-1])          # item's letter missing
            best -= step
            np.minimum.accumulate(best, axis=1, out=best)                           # text's letter added
            best += step
            cost[:n] = best
        at = cost.argmin(axis=1)
        found = cost[np.arange(len(low)), at]
        back = np.argsort(order)
        return (found >> 32)[back], ((found & (EDIT - 1)) + base)[back], (low + at + size)[back]

    def search(self, texts: list[str]) -> Iterator[tuple]:
        """(text number, item id, edits, first character, end) of every match in some texts."""
        gap = int(self.budget.max(initial=0)) + 1
        parts, places, first = [], [], []
        at = 0
        for text in texts:
            codes, place = normal_form(text)
            first.append(at)
            parts += [codes, np.zeros(gap, np.uint32)]   # no edits reach across
            places.append(place)
            at += len(codes) + gap
        if not texts or not len(self.ids):
            return
        codes = np.concatenate(parts)
        which, diagonal = self.regions(codes)
        found = []
        for at in range(0, len(which), 1000):
            number, some = which[at:at + 1000], diagonal[at:at + 1000]
            edits, start, end = self.align(number, codes, some)
            good = edits <= self.budget[number]
            found += zip(edits[good].tolist(), start[good].tolist(), end[good].tolist(), number[good].tolist())
        taken: dict[int, list] = {}
        for edits, start, end, number in sorted(found):
            # Bands overlap: of matches of an item that overlap, the best stands.
            if all(end <= a or start >= b for a, b in taken.setdefault(number, [])):
                taken[number].append((start, end))
                # Either end may lie in a gap, as letters replaced; the middle does not.
                doc = int(np.searchsorted(first, max(start + end, 0) // 2, "right")) - 1
                place = places[doc]
                inner = np.clip([start - first[doc], end - 1 - first[doc]], 0, max(0, len(place) - 1))
                yield doc, self.ids[number], edits, int(place[inner[0]]), int(place[inner[1]]) + 1


def _groups(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of some rows at a time, at least one."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= most:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def item_blocks(items: DataFrame, rate: float, least_chars: int, block_chars: int, id_col: str,
                text_col: str) -> Iterator[ItemIndex]:
    """Indexes over the items, each of at most about `block_chars` characters; one at a time."""
    held, size = [], 0
    for row in items.select(id_col, text_col).toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= block_chars:
            yield ItemIndex(held, rate, least_chars)
            held, size = [], 0
    if held:
        yield ItemIndex(held, rate, least_chars)


def leaks(docs: DataFrame, items: DataFrame, rate: float = 0.08, least_chars: int = 24,
          block_chars: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, edits, start, end of every benchmark passage found in a whole text.

    Texts and items are compared in lower case with runs of ASCII white space and signs as one space. An
    item of m characters is found where at most rate * m edits turn it into a stretch of the text. The
    q-gram lemma says how many of its q-grams such a stretch shares on neighbouring diagonals; bands of
    diagonals that share as many are aligned. start and end are characters of the text as given.

    Items go out in blocks of bounded size, each block against all documents in one pass without
    shuffle. Items under `least_chars` normalized characters are no passages and are not sought; null
    and empty texts hold none. Repeated rows of either table give rows of their own.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema[item_col].dataType
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, edits int, start long, `end` long"
    spark = docs.sparkSession
    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(item_kind)
    tables = []
    for index in item_blocks(items, rate, least_chars, block_chars, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for first, some in _groups(texts):
                    found = list(sent.value.search(some))
                    doc, item, edits, start, end = zip(*found) if found else ((),) * 5
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([first + d for d in doc], pa.int64())),
                         pa.array(item, item_type), pa.array(edits, pa.int32()),
                         pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                        names=["doc_id", "item_id", "edits", "start", "end"])

        tables.append(settle(picked.mapInArrow(run, schema)))
        sent.unpersist()
    out = tables[0] if tables else spark.createDataFrame([], schema)
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = 0.08, least_chars: int = 24,
          block_chars: int = 8_000_000, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, in which `leaks` would find nothing; no shuffle."""
    import pyarrow as pa

    spark, last = docs.sparkSession, None
    for index in item_blocks(items, rate, least_chars, block_chars, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(index)
        at = docs.columns.index(text_col)

        def run(batches, sent=sent, at=at):
            for batch in batches:
                texts = [t or "" for t in batch.column(at).to_pylist()]
                keep = np.ones(len(texts), bool)
                for first, some in _groups(texts):
                    keep[[first + found[0] for found in sent.value.search(some)]] = False
                yield batch.filter(pa.array(keep))

        docs = settle(docs.mapInArrow(run, docs.schema))
        if last is not None:
            discard(last)
        last = docs
    return docs
