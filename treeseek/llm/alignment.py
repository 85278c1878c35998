"""Alignment of two tokenizers by their shared cuts.

Both tokenizers spell the same bytes, so a token is a range of bytes, and a byte
at which tokens of both end is a cut. Cuts are found by divide and conquer: in an
interval of tokens, the end nearest to the middle that a bisection finds among the
other tokenizer's ends splits it, and both halves go on; an interval without a
cut is a leaf group. All intervals of a batch take a step at once. Inside of leaf
groups, tokens whose ranges overlap are linked.

A document keeps its different linked pairs of ids with how often it has them.
Counts over the corpus sum those, and come back to the documents by a join: with
the table of counts broadcast if it has at most ``LOOKUP_PAIRS`` rows, else by a
shuffle with frequent pairs dealt out over tasks.

Defined results: null and empty texts, and texts that one of the tokenizers does
not spell byte by byte (a sign that it takes for a blank, for example), have no
tokens, zeros and an empty digest; a row with a null id is aligned like any
other; repeated rows count each for itself; an empty table gives an empty
result; columns other than id and text are not read; ids of any type are taken
as they are.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS, column
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, materialise_counted, spread

# Rows of the table of counts that may be broadcast: 17 bytes each.
LOOKUP_PAIRS = 4_000_000
# Texts are aligned together up to about so many characters.
AT_ONCE = 1_000_000
# Above this, the fast implementation of the first tokenizer is not used for a text.
_FAST = 1_000_000


def _byte_alphabet() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary, by the published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """The byte-level tokenizer: ids of blank + text, and the bytes of each id."""

    # How such vocabularies split a text into words (a fixed value).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {token["id"] for token in model.get("added_tokens", ())}
        alphabet = _byte_alphabet()
        self.bytes_of = [b""] * (1 + max(model["model"]["vocab"].values()))
        for token, number in model["model"]["vocab"].items():
            if number not in special:
                self.bytes_of[number] = bytes(alphabet[c] for c in token)
        # The ids of such a vocabulary are in the order of its merges.
        ranks = {b: i for i, b in enumerate(self.bytes_of) if b}
        self._fast = tiktoken.Encoding("bytes", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        spelled = " " + text
        if len(spelled) <= _FAST:
            return self._fast.encode_ordinary(spelled)
        return self._whole.encode(spelled, add_special_tokens=False).ids


class Pieces:
    """The sentence-piece tokenizer: ids of text, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [self._spelled(i) for i in range(self._model.vocab_size())]

    def _spelled(self, number: int) -> bytes:
        piece = self._model.id_to_piece(number)
        if self._model.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text, num_threads=1)


@lru_cache(maxsize=2)
def tokenizers(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    """The two tokenizers, once in a Python worker."""
    return ByteLevel(a), Pieces(b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which ends of the first tokenizer are ends of the second as well, as ascending positions in ``ends_a``.

    Both are ascending, and ``bounds`` are positions in ``ends_a`` that are cuts
    already, such as the last one of each text.
    """
    found = [bounds]
    # Open intervals: ends strictly between two cuts.
    low = np.append(-1, bounds[:-1]) + 1
    high = bounds
    while len(low):
        open_ = high > low
        low, high = low[open_], high[open_]
        middle = (low + high) // 2
        cut = np.full(len(low), -1, np.int64)
        left = np.arange(len(low))
        step = 0
        while len(left):
            # The ends at this distance from the middle, one on either side.
            for at in (middle[left] - step, middle[left] + step):
                inside = (at >= low[left]) & (at < high[left]) & (cut[left] < 0)
                at = at[inside]
                place = np.searchsorted(ends_b, ends_a[at])
                hit = ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at]
                cut[left[inside][hit]] = at[hit]
            step += 1
            wide = (middle[left] - step >= low[left]) | (middle[left] + step < high[left])
            left = left[(cut[left] < 0) & wide]
        split = cut >= 0
        found.append(cut[split])
        low, high = (
            np.concatenate([low[split], cut[split] + 1]),
            np.concatenate([cut[split], high[split]]),
        )
    return np.sort(np.concatenate(found))


# What the text that is hashed has between a group's ids of either tokenizer, and between groups.
SIGNS = (";", "|")


class _Spelling:
    """Decimal ids with the sign behind them, for the text that is hashed: none, comma, then the two of ``signs``."""

    def __init__(self, n: int, signs: tuple[str, str]):
        self.n = n
        self.parts = [str(i).encode() + sign.encode() for sign in ("", ",", *signs) for i in range(n)]


@lru_cache(maxsize=2)
def _spelling(n: int, signs: tuple[str, str]) -> _Spelling:
    return _Spelling(n, signs)


class Aligned:
    """Texts aligned together: per text numbers of tokens, groups and links, the digest, and its pairs of ids."""

    def __init__(
        self, a: list[np.ndarray], b: list[np.ndarray], bytes_a: np.ndarray, bytes_b: np.ndarray, n_b: int,
        signs: tuple[str, str] = SIGNS,
    ):
        """``bytes_a`` and ``bytes_b``: the number of bytes of each id. A text has tokens of both or of none."""
        self.signs = signs
        self.n_a = np.array([len(x) for x in a], dtype=np.int64)
        self.n_b = np.array([len(x) for x in b], dtype=np.int64)
        ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
        texts = len(a)
        self.n_groups = np.zeros(texts, np.int64)
        self.n_links = np.zeros(texts, np.int64)
        self.digests = [""] * texts
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2] * texts
        if not len(ids_a):
            return
        ends_a, ends_b = np.cumsum(bytes_a[ids_a]), np.cumsum(bytes_b[ids_b])
        text_a, text_b = np.repeat(np.arange(texts), self.n_a), np.repeat(np.arange(texts), self.n_b)
        bounds = np.flatnonzero(np.append(text_a[1:] != text_a[:-1], True))
        cuts = shared_cuts(ends_a, ends_b, bounds)
        self.n_groups = np.bincount(text_a[cuts], minlength=texts)
        # The groups, by the number of the cut that ends them.
        group_a = np.searchsorted(cuts, np.arange(len(ids_a)))
        group_b = np.searchsorted(ends_a[cuts], ends_b)
        # Between two neighbouring ends of either, one token of each lies: a link.
        own_b = np.ones(len(ids_b), bool)
        own_b[np.append(group_b[1:] != group_b[:-1], True)] = False
        stretch = np.sort(np.concatenate([ends_a, ends_b[own_b]]), kind="stable")
        link_a, link_b = np.searchsorted(ends_a, stretch), np.searchsorted(ends_b, stretch)
        text = text_a[link_a]
        self.n_links = np.bincount(text, minlength=texts)
        key = ids_a[link_a] * n_b + ids_b[link_b]
        self._count_pairs(text, key)
        self._digest(ids_a, ids_b, group_a, group_b, texts)

    def _count_pairs(self, text: np.ndarray, key: np.ndarray) -> None:
        both = np.sort((text << 32) | key)
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        times = np.diff(np.append(first, len(both)))
        owner, key = both[first] >> 32, both[first] & 0xFFFFFFFF
        edges = np.searchsorted(owner, np.arange(len(self.n_a) + 1))
        self.pairs = [(key[x:y], times[x:y]) for x, y in zip(edges, edges[1:])]

    def _digest(self, ids_a, ids_b, group_a, group_b, texts: int) -> None:
        # All tokens in the order of the text that is hashed: of each group first those of the first tokenizer.
        before_b = np.searchsorted(group_b, group_a)
        before_a = np.searchsorted(group_a, group_b, side="right")
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        table = _spelling(1 + int(max(ids_a.max(), ids_b.max(), 65_535)), self.signs)
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + before_b] = ids_a + table.n * np.where(last_a, 2, 1)
        order[np.arange(len(ids_b)) + before_a] = ids_b + table.n * np.where(last_b, 3, 1)
        ends = np.cumsum(self.n_a + self.n_b)
        full = np.flatnonzero(self.n_a > 0)
        order[ends[full] - 1] %= table.n
        parts = table.parts
        for i in full.tolist():
            body = order[ends[i] - self.n_a[i] - self.n_b[i] : ends[i]].tolist()
            self.digests[i] = hashlib.sha256(b"".join([parts[c] for c in body])).hexdigest()


def _aligned(texts: DataFrame, a: str, b: str, signs: tuple[str, str]) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups_sha256 and ``pairs``, the different linked ids and how often."""
    struct = pa.struct([("key", pa.int64()), ("times", pa.int32())])

    def encoded(texts: list[str | None], first: ByteLevel, second: Pieces):
        none = np.zeros(0, np.int64)
        for text in texts:
            if not text:
                yield none, none
                continue
            ids_a, ids_b = first.encode(text), second.encode(text)
            whole = b" " + text.encode()
            same = (
                b"".join([first.bytes_of[i] for i in ids_a]) == whole
                and b"".join([second.bytes_of[i] for i in ids_b]) == whole
            )
            yield (np.array(ids_a, np.int64), np.array(ids_b, np.int64)) if same else (none, none)

    def portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
        start = size = 0
        part: list[str | None] = []
        for i, text in enumerate(batch.column("text")):
            part.append(text.as_py())
            size += len(part[-1] or "")
            if size >= AT_ONCE:
                yield batch.slice(start, len(part)), part
                start, size, part = i + 1, 0, []
        if part:
            yield batch.slice(start, len(part)), part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tokenizers(a, b)
        bytes_a, bytes_b = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (first, second))
        for batch in batches:
            for slice_, texts in portions(batch):
                ids = list(encoded(texts, first, second))
                found = Aligned([x for x, _ in ids], [y for _, y in ids], bytes_a, bytes_b, len(bytes_b), signs)
                offsets = np.cumsum([0] + [len(k) for k, _ in found.pairs])
                keys = np.concatenate([np.zeros(0, np.int64), *[k for k, _ in found.pairs]])
                times = np.concatenate([np.zeros(0, np.int64), *[t for _, t in found.pairs]])
                pairs = pa.StructArray.from_arrays([pa.array(keys), pa.array(times, pa.int32())], fields=list(struct))
                numbers = [pa.array(v, pa.int64()) for v in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                yield pa.RecordBatch.from_arrays(
                    [
                        slice_.column("id"), *numbers, pa.array(found.digests),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                    ],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
                )

    kind = texts.select(
        "id", *[F.lit(None).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
        F.lit(None).cast("string").alias("groups_sha256"),
        F.lit(None).cast("array<struct<key: bigint, times: int>>").alias("pairs"),
    ).schema
    return texts.mapInArrow(run, kind)


def align(
    docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_column: str = "doc_id", text_column: str = "text",
    lookup_pairs: int = LOOKUP_PAIRS, hot: int = HOT_ROWS, signs: tuple[str, str] = SIGNS,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of ``docs``.

    ``signs``: what the hashed text has between the ids of either tokenizer in a group, and between groups.
    """
    texts = docs.select(column(id_column).alias("id"), column(text_column).alias("text"))
    found = _aligned(spread(texts), tokenizer_a, tokenizer_b, signs).withColumn("number", F.monotonically_increasing_id())
    found = materialise(found, "aligned")
    counts, pairs = pair_counts(found, tokenizer_b)
    linked = found.select("number", F.inline("pairs"))
    if pairs <= lookup_pairs:
        met = linked.join(F.broadcast(counts.drop("documents")), "key")
    else:
        large = hot_keys(counts.select("key", F.col("documents").alias("n")), ["key"], hot)
        met = join_unique(linked, counts.drop("documents"), ["key"], large, ["number"])
    sums = met.groupBy("number").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    own = found.select("number", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("bigint")
    return own.join(sums, "number", "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )


def pair_counts(found: DataFrame, tokenizer_b: str) -> tuple[DataFrame, int]:
    """For each linked pair of ids: key, n (links), best (none of its second id has more), documents; and how many pairs."""
    n_b = len(Pieces(tokenizer_b).bytes_of)
    summed = (
        found.select(F.inline("pairs")).groupBy("key")
        .agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("documents"))
        .withColumn("b", F.pmod("key", F.lit(n_b)))
    )
    summed, pairs = materialise_counted(summed, "pair-counts")
    # As many keys as the vocabulary has ids.
    most = summed.groupBy("b").agg(F.max("n").alias("most"))
    joined = summed.join(most, "b").select("key", "n", (F.col("n") == F.col("most")).alias("best"), "documents")
    return materialise(joined, "pair-counts"), pairs
