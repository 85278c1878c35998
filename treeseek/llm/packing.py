"""Packing of tokenised documents into windows of fixed length.

Overlong documents are cut into full windows, each a sequence of its own. The
rests are packed best-fit decreasing: the longest first, each into the open
window that it fills most tightly. A segment tree over remaining capacities
finds that window in twelve steps; the identifiers of the open windows of one
capacity are a stack at its leaf.

Rests are dealt out to groups of about ``GROUP_TOKENS`` tokens, packed one group
per task. A group sees lengths only; its size does not depend on the data. What
that costs in padding is the last windows of a group, below half a percent.

Defined results: a null or empty text has the end token only; a row with a null
id is packed like any other; repeated rows are packed each for itself; an empty
table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.llm.rows import column
from treeseek.session import materialise, spread

WINDOW = 4096
END_TOKEN = 2
GROUP_TOKENS = 2_000_000
# Words whose tokens a task keeps; the memory is bounded by it, results are the same.
CACHED_WORDS = 300_000
# And those that its worker keeps for later tasks.
KEPT_WORDS = 100_000

_PIECES = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


# Every marker of the tokenizer starts with it.
_MARKER = b"<|"


class _Known(dict):
    """Words with their ids; those of the present batch only lie beside them."""

    fresh: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        return self.fresh[word]


@lru_cache(maxsize=2)
def _kept(path: str):
    """The tokenizer and the first words of a Python worker, for all of its tasks."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}


class WordTokens:
    """Token ids of texts as little-endian 32-bit numbers.

    The tokenizer lower-cases, drops white space and never joins across it, so
    the ids of a text are those of its blank-separated words in turn, whatever
    the case of A-Z. Its markers are read before it lower-cases: a word that may
    hold one keeps its case. Each different word of a batch is tokenised once,
    some at a time, and the first ``cached`` words are kept, among which are the
    frequent ones. A full stop or comma behind a letter or digit is a token of
    its own, so a word with one is not tokenised anew.
    """

    _AT_ONCE = 200

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self._tokenizer, self._shared = _kept(path)
        self._cached = cached
        self._known = _Known(islice(self._shared.items(), cached))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        split = [self._words(t) for t in texts]
        fresh = self._tokens(set().union(*split).difference(self._known))
        room = self._cached - len(self._known)
        self._known.update(islice(fresh.items(), max(0, room)))
        self._shared.update(islice(fresh.items(), max(0, KEPT_WORDS - len(self._shared))))
        self._known.fresh = fresh
        known = self._known
        out = [b"".join([known[w] for w in words]) for words in split]
        self._known.fresh = {}
        return out

    @staticmethod
    def _words(text: str | None) -> list[bytes]:
        data = (text or "").encode()
        if _MARKER not in data:
            return data.lower().split()
        return [w if _MARKER in w else w.lower() for w in data.split()]

    def _tokens(self, words: set[bytes]) -> dict[bytes, bytes]:
        stopped = {w for w in words if len(w) > 1 and w[-1:] in (b".", b",") and w[-2:-1].isalnum()}
        plain = list((words - stopped).union(w[:-1] for w in stopped).difference(self._known))
        out: dict[bytes, bytes] = {}
        for start in range(0, len(plain), self._AT_ONCE):
            part = plain[start : start + self._AT_ONCE]
            texts = [w.decode() for w in part]
            found = self._tokenizer.encode(" ".join(texts), add_special_tokens=False)
            starts = np.array([a for a, _ in found.offsets], dtype=np.int64)
            ends = np.cumsum([len(t) + 1 for t in texts])
            cuts = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
            data = np.array(found.ids, dtype="<u4").tobytes()
            for word, a, b in zip(part, cuts, cuts[1:]):
                out[word] = data[a:b]
        marks = {m: self._one(m) for m in (".", ",")}
        for word in stopped:
            base = word[:-1]
            out[word] = (out[base] if base in out else self._known[base]) + marks[chr(word[-1])]
        return out

    def _one(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END_TOKEN, ids: bool = False) -> DataFrame:
    """(id, text) cut into full windows and a rest: id, start, length, ids_crc32, doc_tokens and, if asked, ids."""
    tail = struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokens(tokenizer)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for key, body in zip(batch.column("id"), encoder.encode_batch(batch.column("text").to_pylist())):
                encoded = body + tail
                tokens = len(encoded) // 4
                for start in range(0, tokens, window):
                    part = encoded[4 * start : 4 * (start + window)]
                    row = (key.as_py(), start, len(part) // 4, zlib.crc32(part), tokens, part if ids else None)
                    for values, value in zip(out, row):
                        values.append(value)
            arrays = [pa.array(v, pa.int64()) for v in out[:5]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if ids:
                arrays.append(pa.array(out[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(run, _PIECES + (", ids binary" if ids else ""))


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """The window and the offset of each of ``lengths``."""
    size = 1 << window.bit_length()
    tree = [0] * (2 * size)  # how many open windows have a remaining capacity in a node's range
    stacks: list[list[int]] = [[] for _ in range(window + 1)]
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    windows = 0

    def count(capacity: int, change: int) -> None:
        node = capacity + size
        while node:
            tree[node] += change
            node >>= 1

    def tightest(length: int) -> int | None:
        """The smallest capacity of an open window that is at least ``length``."""
        node = length + size
        if tree[node]:
            return length
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                while node < size:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
                return node - size
            node >>= 1
        return None

    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[i]
        capacity = tightest(length)
        if capacity is None:
            capacity, number, windows = window, windows, windows + 1
        else:
            number = stacks[capacity].pop()
            count(capacity, -1)
        placed[i] = (number, window - capacity)
        left = capacity - length
        if left:
            stacks[left].append(number)
            count(left, 1)
    return placed


def _packed(group: pa.Table) -> pa.Table:
    group = group.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("number", "ascending")])
    placed = best_fit_decreasing(group.column("length").to_pylist())
    first = group.column("group")[0].as_py() << 32
    out = group.drop_columns(["group"])
    out = out.append_column("sequence_id", pa.array([first + w for w, _ in placed], pa.int64()))
    return out.append_column("offset", pa.array([at for _, at in placed], pa.int64()))


def assign(cut: DataFrame, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Written pieces, told apart by ``number``, with ``sequence_id`` and ``offset``.

    The pieces of one sequence lie gapless from 0. A sequence is padded to the
    window; one whose length is a power of two needs no padding.
    """
    slim = cut.select("id", "start", "length", "ids_crc32", "doc_tokens", "number")
    total = slim.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    dealt = slim.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(
        _packed, f"{_PIECES}, number bigint, sequence_id bigint, offset bigint"
    )


def _written(docs: DataFrame, tokenizer: str, id_column: str, text_column: str, ids: bool) -> DataFrame:
    texts = docs.select(column(id_column).cast("bigint").alias("id"), column(text_column).alias("text"))
    cut = pieces(spread(texts), tokenizer, ids=ids)
    return materialise(cut.withColumn("number", F.monotonically_increasing_id()), "pieces")


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset for each piece of ``docs``."""
    return assign(_written(docs, tokenizer, id_column, text_column, False), group_tokens).drop("number")


def sequences(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    pad: int = 0,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """sequence_id and ``ids``, the token windows themselves, little-endian 32-bit, padded as said above."""
    cut = _written(docs, tokenizer, id_column, text_column, True)
    placed = assign(cut, group_tokens)
    whole = (
        placed.join(cut.select("number", "ids"), "number")
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n"))
    )
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    power = F.expr("bit_count(n)") == 1
    filler = F.unhex(F.repeat(F.lit(struct.pack("<I", pad).hex()), (F.lit(WINDOW) - F.col("n")).cast("int")))
    return whole.select(
        "sequence_id", F.when(power, joined).otherwise(F.concat(joined, filler)).alias("ids"), F.col("n").alias("tokens")
    )

