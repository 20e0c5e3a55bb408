"""Whole-token shortcut: encode each distinct spaced word once, look the rest up.

A byte-level BPE file splits text into pre-tokens before it merges. A space that is
followed by a non-space always starts a new pre-token, whatever stands before it, so a
text may be cut there and its units encoded one by one.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

CUT = re.compile(r" (?=\S)")
# Letters below U+0250 are letters in every version of Unicode.
LETTERS = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
MARKS = r"[.,;:!?$&%*#)]"
PLAIN = f"^{LETTERS}{MARKS}*(\n{LETTERS}{MARKS}*)*$"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by the published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(path: str) -> dict[str, int]:
    """Vocabulary strings proven to encode, alone, as the one token they name.

    Bounded by the vocabulary; run once per query, before any text is read, by `sent_tokens`.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    back = byte_alphabet()
    proven: dict[str, int] = {}
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    for piece, number in tok.get_vocab(with_added_tokens=False).items():
        if piece in special or any(c not in back for c in piece):
            continue
        try:
            text = bytes(back[c] for c in piece).decode("utf-8")
        except UnicodeDecodeError:
            continue
        proven[text] = number
    names = list(proven)
    codes = tok.encode_batch_fast(names, add_special_tokens=False)
    return {n: proven[n] for n, c in zip(names, codes) if c.ids == [proven[n]]}


def sent_tokens(spark: SparkSession, path: str) -> Broadcast:
    """`whole_tokens`, broadcast. A task finds them: what the library allocates, and keeps, stays out of the driver."""
    import pyarrow as pa

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for _ in batches:
            found = whole_tokens(path)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(found.values(), pa.int64())], names=["text", "id"])

    found = spark.range(0, 1, 1, 1).mapInArrow(run, "text string, id long").toArrow()
    return spark.sparkContext.broadcast(dict(zip(*(c.to_pylist() for c in found.columns))))


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes by rank, if the file's merges are proven to make its ids in order.

    Then merging by least id is merging by first rule, and one pre-token can be merged
    without the library's text handling. None otherwise.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    back, vocab = byte_alphabet(), model["vocab"]
    rules = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if any(vocab.get(r) != len(back) + i for i, r in enumerate(rules)):
        return None
    made = [*back, *rules]
    return {bytes(back[c] for c in p): vocab[p] for p in made}


def gathered(batches: Iterable, column: int, size: int = 8 << 20) -> Iterator:
    """Arrow batches put together until their texts hold `size` bytes."""
    import pyarrow as pa

    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.column(column).nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class WordEncoder:
    """Token ids of many texts at once; the distinct units among them are encoded once.

    Units that are proven single tokens are looked up. Other units of plain words, end marks and
    single line ends fall into pre-tokens known without a pattern, and all of them are merged in one
    call. The library takes the rest whole, and so it does with texts that cannot be cut at every space.
    """

    def __init__(self, path: str, proven: dict[str, int], longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import pyarrow as pa
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = {t.content: _ids([i])
                        for i, t in self.tok.get_added_tokens_decoder().items()}
        self.proven = {lead: {p[len(lead):]: i for p, i in proven.items() if p.startswith(lead) and p != lead}
                       for lead in ("", " ")}
        self.names = {lead: pa.array(list(known), pa.large_string()) for lead, known in self.proven.items()}
        self.numbers = {lead: np.array(list(known.values()), np.uint32) for lead, known in self.proven.items()}
        ranks = merge_ranks(path)
        # A zero byte ends a pre-token, a one byte a unit; each is a token of its own.
        self.pieces = None if ranks is None else Encoding(
            "pieces", pat_str=r"[^\x00\x01]+|[\x00\x01]", mergeable_ranks=ranks, special_tokens={})
        self.ends = None if ranks is None else (ranks[b"\0"], ranks[b"\1"])
        self.longest = longest
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") \
            if self.special else None

    def merged(self, texts: list[str]) -> list[bytes]:
        """Ids by the library."""
        return [_ids(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def units(self, units, lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lead + unit for each of the given units (Arrow): all ids in a row, and how many each has."""
        import pyarrow as pa
        import pyarrow.compute as pc

        n = len(units)
        place = pc.index_in(units, value_set=self.names[lead])
        single = pc.is_valid(place).to_numpy(zero_copy_only=False)
        plain = np.zeros(n, bool)
        if self.pieces:
            plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False) & ~single
        rest = ~(single | plain)
        size = np.ones(n, np.int64)
        parts = [(single, self.numbers[lead][place.drop_null().to_numpy()])]
        if plain.any():
            text = units.filter(pa.array(plain))
            text = pc.replace_substring_regex(text, f"({MARKS}+)", "\0\\1")
            text = pc.replace_substring(text, "\n", "\0\n\0")
            whole = pc.binary_join_element_wise(*[pa.scalar(x, pa.large_string()) if x is not text else x
                                                  for x in (lead, text, "\1", "")])
            ids = self.pieces.encode_to_numpy("".join(whole.to_pylist()) if whole.offset else
                                              whole.buffers()[2].to_pybytes().decode()).astype(np.uint32)
            ids = ids[ids != self.ends[0]]
            last = np.flatnonzero(ids == self.ends[1])
            size[plain] = np.diff(last, prepend=-1) - 1
            parts.append((plain, ids[ids != self.ends[1]]))
        if rest.any():
            codes = self.merged([lead + u for u in units.filter(pa.array(rest)).to_pylist()])
            size[rest] = [len(c) // 4 for c in codes]
            parts.append((rest, np.frombuffer(b"".join(codes), "<u4")))
        start = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.uint32)
        for which, ids in parts:
            flat[_spread(start[which], size[which])] = ids
        return flat, size

    def _coded(self, texts):
        """Per unit of the texts a code, per code its ids, and which texts have to go another way."""
        import pyarrow as pa
        import pyarrow.compute as pc

        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        code, at = coded.indices.to_numpy().astype(np.int64), split.offsets.to_numpy()
        at = at - at[0]
        names, head = coded.dictionary, at[:-1]
        inner = np.ones(len(code), bool)
        inner[head] = False
        used = np.zeros(len(names), bool)
        used[code[inner]] = True
        # A unit that starts with white space, or is empty or long, is not cut off.
        first = pc.utf8_slice_codeunits(names, 0, 1)
        good = pc.and_(pc.less_equal(pc.utf8_length(names), self.longest),
                       pc.invert(pc.or_(pc.equal(first, ""), _blank(first)))).to_numpy(zero_copy_only=False)
        flat, size = np.zeros(0, np.uint32), np.zeros(len(names), np.int64)
        flat, size[used & good] = self.units(names.filter(pa.array(used & good)), " ")
        heads, head_size = self.units(names.take(pa.array(code[head])), "")
        odd = inner & ~good[code]
        code[head] = len(names) + np.arange(len(texts))
        size = np.append(size, head_size)
        flat = np.append(flat, heads)
        slowly = np.logical_or.reduceat(odd, head)
        for mark in self.special:
            slowly |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        return code, at, flat, np.cumsum(size) - size, size, slowly

    def encode(self, texts) -> list[bytes]:
        """Ids of each text of an Arrow array, as little-endian unsigned 32-bit bytes; null counts as empty."""
        texts = _filled(texts)
        if not len(texts):
            return []
        code, at, flat, start, size, slowly = self._coded(texts)
        count = size[code]
        ids = flat[_spread(start[code], count)].astype("<u4").tobytes()
        bounds = (4 * np.append(0, np.cumsum(count)[at[1:] - 1])).tolist()
        return [self._slowly(texts[i].as_py()) if odd else ids[a:b]
                for i, (odd, a, b) in enumerate(zip(slowly.tolist(), bounds, bounds[1:]))]

    def counts(self, texts) -> np.ndarray:
        """Number of ids of each text."""
        texts = _filled(texts)
        if not len(texts):
            return np.zeros(0, np.int64)
        code, at, _, _, size, slowly = self._coded(texts)
        out = np.add.reduceat(size[code], at[:-1])
        for i in np.flatnonzero(slowly).tolist():
            out[i] = len(self._slowly(texts[i].as_py())) // 4
        return out

    def _slowly(self, text: str) -> bytes:
        """Ids of a text with special strings, long units, or white space after a space."""
        import pyarrow as pa

        # Texts with special strings are cut at them first, as the library does.
        spans = self.marks.split(text) if self.marks else [text]
        out = []
        for at, span in enumerate(spans):
            if at % 2:
                out.append(self.special[span])
                continue
            head, *units = CUT.split(span)
            out += self.merged([head])
            if units:
                names = pa.array(units, pa.large_string()).dictionary_encode()
                flat, size = self.units(names.dictionary, " ")
                code = names.indices.to_numpy()
                out.append(flat[_spread((np.cumsum(size) - size)[code], size[code])].astype("<u4").tobytes())
        return b"".join(out)


def _filled(texts):
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.fill_null(texts.cast(pa.large_string()), "")


def _blank(first):
    """Whether a character is white space for Python, which knows more of it than any pattern."""
    import pyarrow as pa

    coded = first.dictionary_encode()
    blank = np.array([u.isspace() for u in coded.dictionary.to_pylist()], bool)
    return pa.array(blank[coded.indices.to_numpy()])


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... of `size[i]` places each, one after the other."""
    end = np.cumsum(size)
    return np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)


def _ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
