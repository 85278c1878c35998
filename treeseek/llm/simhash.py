"""Near-duplicate detection by SimHash, with anchor points that cover the space of fingerprints.

The anchors are the words of a perfect code: 63 of the 64 bits carry the
Hamming(63, 57) code, of covering radius 1, and bit 0 is free. Two fingerprints
that differ in at most two bits have a point between them that differs from
either in at most one. That point lies within the covering radius of its
anchor, so both fingerprints lie within covering radius plus threshold of it. A
fingerprint is therefore copied to the anchors of all points within one bit of
it: 33 anchors, found from its syndrome, and no pair is lost.

All fingerprints that can meet at an anchor differ from it in at most two of the
63 bits, which makes at most 4,034 of them: no group grows with the data. Only
distinct fingerprints are copied, so equal texts cost nothing. Per anchor, the
linked fingerprints are named after one of them; pairs are never listed.

Connected components come from contracting those links in rounds, each written
to the shared folder.

``one_of_similar`` is for a pipeline: it links by Jaccard similarity of shingle
sets. Candidates are texts whose SimHash fingerprints, of the same shingles, are
equal or meet at an anchor within the distance. That is not all: at similarity
0.8 about ten bits differ. Bands of minima find the candidates beyond. Each link
is checked on the sets themselves, read again for candidates only. What the
anchors linked goes into the buckets of the bands with one label. In a bucket,
members are compared with one of them, its leader, the same one in all buckets
that it can lead; labels of linked ones are contracted, and a bucket of one
label is done. A turn makes as many pairs as there are members, whatever the
size of a group. What is still open after ``LEADERS`` such turns is compared
pair by pair in buckets of at most ``FEW`` members. Members of larger ones are
compared if they have different labels and share one of the shingles that are
rare among them, at a place that leaves enough others to share: a prefix
filter, which loses no pair. That is the last turn, so the number of turns does
not grow with the data.

Defined results: null and empty texts, and texts without words, have
fingerprint zero and are linked like any other; a row with a null id belongs to
its component but is never its name; a component of null ids only has a null
name; repeated rows share a component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.llm.components import components
from treeseek.llm.rows import HOT_ROWS, field, located, sieve, sifted, without
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, materialise_counted, materialise_texts, spread

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42

# What the pipeline's stage links: texts whose sets of five-word shingles have this Jaccard similarity.
SIMILAR_WORDS = 5
SIMILARITY = 0.8
# At similarity 0.8, a pair shares none of the bands with probability (1 - 0.8 ** 5) ** 32, 3 in a million.
BANDS = 32
BAND_ROWS = 5
# Turns in which a bucket's members meet a leader only; then buckets of at most so many members compare all pairs,
# and members of larger ones those that share a rare shingle.
LEADERS = 2
FEW = 16

_ALL = (1 << 64) - 1
# Bit k of the syndrome is the parity of the positions 1 to 63 that have bit k.
_CHECKS = [sum(1 << i for i in range(64) if i >> k & 1) for k in range(6)]


def _signed(value: int) -> int:
    value &= _ALL
    return value - (1 << 64) if value >> 63 else value


def shingles(text: str | None, words: int) -> list[int]:
    """The hashes of a text's word shingles; a text of fewer words is one shingle, one of none has none."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return []
    joined = b" ".join(tokens)
    if len(tokens) < words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    starts = np.cumsum([0] + [len(t) + 1 for t in tokens]).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[words:])]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles, as an unsigned number."""
    return _majority(shingles(text, words))


def _majority(hashes: list[int]) -> int:
    if not hashes:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 255 * 64):
        part = np.array(hashes[at : at + 255 * 64], dtype=np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # Eight counters of one byte are added at once; 255 rows cannot overflow them.
        sums = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(part), 255), axis=0)
        ones += np.ascontiguousarray(sums).view(np.uint8).astype(np.int64).sum(axis=0)
    set_bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_column: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with its text replaced by ``fingerprint``, the 64 bits as a signed number."""
    rest = [c for c in docs.columns if c != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_signed(fingerprint(t.as_py(), words)) for t in batch.column(text_column)]
            columns = [batch.column(c) for c in rest] + [pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "fingerprint"])

    schema = docs.select(*rest, F.lit(0).cast("bigint").alias("fingerprint")).schema
    return docs.mapInArrow(run, schema)


def anchors(name: str = "fingerprint"):
    """The anchors of all points within one bit of a fingerprint, as an array column."""
    one = "shiftleft(1L, cast({} as int))".format
    parities = " + ".join(
        f"shiftleft(bit_count({name} & {_signed(check)}L) & 1, {k})" for k, check in enumerate(_CHECKS)
    )
    home = f"({name} ^ if(s = 0, 0L, {one('s')}))"
    pairs = (
        f"transform(filter(sequence(1, 63), i -> i < (i ^ s)), i -> {name} ^ {one('i')} ^ {one('(i ^ s)')})"
    )
    bound = f"transform(array({parities}), s -> array_union(array({home}, {home} ^ 1L), if(s = 0, array(), {pairs})))"
    return F.expr(f"{bound}[0]")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends, names = [], []
        for group in batch.column("members"):
            points = np.sort(np.array(group.as_py(), dtype=np.int64))
            near = np.bitwise_count((points[:, None] ^ points[None, :]).view(np.uint64)) <= MAX_BITS
            label = np.arange(len(points))
            while True:
                lowest = np.where(near, label[None, :], len(points)).min(axis=1)
                if (lowest == label).all():
                    break
                label = lowest
            moved = label != np.arange(len(points))
            ends.append(points[moved])
            names.append(points[label[moved]])
        if ends:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ends), pa.int64()), pa.array(np.concatenate(names), pa.int64())],
                names=["a", "b"],
            )


def at_anchors(distinct: DataFrame) -> DataFrame:
    """From distinct fingerprints: ``members``, those that meet at an anchor."""
    return (
        distinct.select("fingerprint", F.explode(anchors()).alias("anchor"))
        .groupBy("anchor")
        .agg(F.collect_list("fingerprint").alias("members"))
        .where(F.size("members") > 1)
        .select("members")
    )


def links(distinct: DataFrame) -> DataFrame:
    """From distinct fingerprints: edges (a, b) that connect all within two bits of each other."""
    return at_anchors(distinct).mapInArrow(_linked, "a bigint, b bigint").distinct()


def cluster(prints: DataFrame, id_column: str = "id", hot: int = HOT_ROWS) -> DataFrame:
    """``prints`` (with ``fingerprint``) and ``component_id``, the smallest id that links reach."""
    distinct = materialise(
        prints.groupBy("fingerprint").agg(F.min(id_column).alias("lowest"), F.count(F.lit(1)).alias("n")), "prints"
    )
    found = components(links(distinct.select("fingerprint")))
    member = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", "lowest", "n", F.coalesce("root", "fingerprint").alias("root")
    )
    member = materialise(member, "print-roots")
    named = member.groupBy("root").agg(F.min("lowest").alias("component_id"), F.count(F.lit(1)).alias("n"))
    large = hot_keys(named.select("root", "n"), ["root"], hot)
    member = join_unique(member, named.drop("n"), ["root"], large, ["fingerprint"])
    large = hot_keys(distinct.select("fingerprint", "n"), ["fingerprint"], hot)
    return join_unique(
        prints, member.select("fingerprint", "component_id"), ["fingerprint"], large, [id_column]
    )


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """row, id, fingerprint, component_id for each row of ``docs``."""
    placed = located(docs).select("row", field(id_column).alias("id"), field(text_column).alias("text"))
    prints = materialise(fingerprints(spread(placed), "text", words), "fingerprints")
    return cluster(prints)


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without all but one row of each component: that with the smallest id, nulls last."""
    placed = located(docs)
    text = placed.select("row", field(id_column).alias("id"), field(text_column).alias("text"))
    found = cluster(materialise(fingerprints(spread(text)), "fingerprints"))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    # Components without a name hold null ids only; their fingerprints keep them apart.
    key = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fingerprint"))]
    stays = found.groupBy(*key).agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    return without(placed, found.join(stays, "row", "left_anti"))


def bands(found: np.ndarray, n_bands: int = BANDS) -> list[int]:
    """Hashes of ``BAND_ROWS`` minima each: two sets share one with the probability (Jaccard) ** BAND_ROWS."""
    values = (found >> np.uint64(32)).astype(np.uint32)
    draw = np.random.default_rng(SEED)
    factors = draw.integers(0, 1 << 32, (2, n_bands * BAND_ROWS), dtype=np.uint32)
    least = np.full(n_bands * BAND_ROWS, (1 << 32) - 1, dtype=np.uint32)
    for at in range(0, len(values), 4096):
        part = values[at : at + 4096, None] * (factors[0] | np.uint32(1)) + factors[1]
        least = np.minimum(least, part.min(axis=0))
    rows = least.reshape(n_bands, BAND_ROWS)
    return [_signed(xxhash.xxh64_intdigest(rows[i].tobytes(), i)) for i in range(n_bands)]


def _distinct(hashes: list[int]) -> np.ndarray:
    return np.unique(np.array(hashes, dtype=np.uint64))


def _sketched(texts: DataFrame, words: int, n_bands: int) -> DataFrame:
    """row, id, size (number of different shingles), fingerprint and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, banded = [], [], []
            for text in batch.column("text"):
                hashes = shingles(text.as_py(), words)
                different = _distinct(hashes)
                sizes.append(len(different))
                prints.append(_signed(_majority(hashes)))
                banded.append(bands(different, n_bands))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()),
                    pa.array(banded, pa.list_(pa.int64())),
                ],
                names=["row", "id", "size", "fingerprint", "bands"],
            )

    number = F.lit(0).cast("bigint")
    schema = texts.select("row", "id", number.alias("size"), number.alias("fingerprint"), F.array(number).alias("bands"))
    return texts.mapInArrow(run, schema.schema)


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the fingerprints at an anchor, each with the first that is within the distance."""
    for batch in batches:
        ends, firsts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for group in batch.column("members"):
            points = np.sort(np.array(group.as_py(), dtype=np.int64))
            near = np.bitwise_count((points[:, None] ^ points[None, :]).view(np.uint64)) <= MAX_BITS
            first = near.argmax(axis=1)
            other = first != np.arange(len(points))
            ends.append(points[other])
            firsts.append(points[first[other]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(ends), pa.int64()), pa.array(np.concatenate(firsts), pa.int64())], names=["a", "b"]
        )


def anchored_pairs(found: DataFrame, hot: int = HOT_ROWS) -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints are equal, or meet at an anchor and differ in few bits.

    A node is paired with the first of its fingerprint, and that one with the
    first of the next fingerprint at each anchor: no more pairs than copies.
    """
    prints = found.groupBy("fingerprint").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    prints = materialise(prints, "prints")
    first = prints.select("fingerprint", "first")
    large = hot_keys(prints.select("fingerprint", "n"), ["fingerprint"], hot)
    several = first.join(prints.where("n > 1").select("fingerprint"), "fingerprint", "left_semi")
    equal = join_unique(found.select("node", "fingerprint"), several, ["fingerprint"], large, ["node"])
    equal = equal.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    edges = at_anchors(prints).mapInArrow(_nearest, "a bigint, b bigint").distinct()
    named = edges.join(first.select(F.col("fingerprint").alias("a"), F.col("first").alias("x")), "a").join(
        first.select(F.col("fingerprint").alias("b"), F.col("first").alias("y")), "b"
    )
    return equal.unionByName(named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_distinct(shingles(t.as_py(), words)).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
            )

    return texts.mapInArrow(run, "node bigint, shingles array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float, hot: int) -> DataFrame:
    """Of pairs (a, b) of nodes, with what else they carry, those whose shingle sets have the similarity."""
    rest = pairs.columns
    for end in ("a", "b"):
        large = hot_keys(pairs.groupBy(end).agg(F.count(F.lit(1)).alias("n")), [end], hot)
        right = sets.select(F.col("node").alias(end), F.col("shingles").alias(f"of_{end}"))
        pairs = join_unique(pairs, right, [end], large, ["b" if end == "a" else "a"])
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    # Two texts without words are alike.
    return pairs.where((union == 0) | (common / F.greatest(union, F.lit(1)) >= similarity)).select(*rest)


def _unlike(members: DataFrame, x: str, y: str, similarity: float) -> DataFrame:
    """Pairs (a, b) with their labels, of structs ``x`` and ``y`` that are not linked yet and may be similar."""
    near = F.least(f"{x}.size", f"{y}.size") >= F.greatest(f"{x}.size", f"{y}.size") * (similarity - 1e-9)
    first, second = F.least(x, y), F.greatest(x, y)
    return members.where((F.col(f"{x}.label") != F.col(f"{y}.label")) & near).select(
        first["node"].alias("a"), second["node"].alias("b"),
        first["label"].alias("label_a"), second["label"].alias("label_b"),
    )


def _all_of(bucket: DataFrame, similarity: float) -> DataFrame:
    """All pairs of buckets of few members."""
    each = F.expr("flatten(transform(all, (x, i) -> transform(slice(all, i + 2, size(all)), y -> struct(x, y))))")
    grouped = bucket.groupBy("bucket").agg(F.collect_list("member").alias("all")).where(F.size("all") > 1)
    return _unlike(grouped.select(F.inline(each)), "x", "y", similarity)


def _renamed(live: DataFrame, moved: DataFrame, hot: int) -> DataFrame:
    """``live`` with the labels of before replaced by their roots."""
    counts = live.groupBy("member.label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    split = live.select("bucket", "member.*")
    large = hot_keys(counts, ["label"], hot)
    named = join_unique(split, moved.withColumnRenamed("node", "label"), ["label"], large, ["bucket", "node"], "left")
    member = F.struct("node", F.coalesce("root", "label").alias("label"), "size")
    return named.select("bucket", member.alias("member"))


def similar_groups(
    placed: DataFrame, id_column: str, text_column: str, words: int, similarity: float, n_bands: int = BANDS,
    hot: int = HOT_ROWS, few: int = FEW,
) -> DataFrame:
    """row, id and root of the rows of :func:`located` that have a similar one; root names their group."""
    texts = placed.select("row", field(id_column).alias("id"), field(text_column).alias("text"))
    found = _sketched(spread(texts), words, n_bands).withColumn("node", F.monotonically_increasing_id())
    found = materialise_texts(found, "sketches")
    spots = found.select("node", "size", F.explode("bands").alias("bucket"))
    often = spots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bits = materialise(sieve(often.select(F.xxhash64("bucket").alias("h"))), "shared-bands")
    passed = sifted(spots, F.xxhash64("bucket"), bits).where("maybe")
    member = F.struct("node", F.col("node").alias("label"), "size").alias("member")
    live = materialise(passed.select("bucket", member), "band-members")

    close = materialise(anchored_pairs(found, hot).distinct(), "anchored")
    ends = close.select(F.explode(F.array("a", "b")).alias("node"))
    wanted = live.select("member.node").unionByName(ends).distinct()
    wanted = materialise(found.join(wanted, "node", "left_semi").select("row", "node"), "alike")
    marked = sifted(texts, F.xxhash64("row"), sieve(wanted.select(F.xxhash64("row").alias("h"))))
    read_again = marked.where("maybe").join(wanted, "row").select("node", "text")
    sets = materialise_texts(_sets(read_again, words), "shingle-sets")

    # What the anchors link has one label before any bucket is opened.
    alike = _verified(close, sets, similarity, hot)
    moved = materialise(components(alike, hot), "roots")
    steps: list[DataFrame] = [moved]
    live = materialise(_renamed(live, moved, hot), "band-members")
    for turn in range(LEADERS + 1):
        # One leader for all buckets that a node leads, so that it is met once and not once a bucket.
        drawn = F.struct(F.xxhash64(F.lit(turn), "member.node"), "member.node")
        open_ = (
            live.groupBy("bucket")
            .agg(
                F.count(F.lit(1)).alias("n"), F.min("member.label").alias("low"), F.max("member.label").alias("high"),
                F.min_by("member", drawn).alias("leader"),
            )
            .where("n > 1 and low <> high").select("bucket", "n", "leader")
        )
        open_, buckets = materialise_counted(open_, "open-buckets")
        if not buckets:
            break
        large = hot_keys(open_.select("bucket", "n"), ["bucket"], hot)
        met = materialise(join_unique(live, open_, ["bucket"], large, ["member"]), "met")
        if turn < LEADERS:
            pairs = _unlike(met, "member", "leader", similarity)
        else:
            crowd = met.where(F.col("n") > few).select("member.*").distinct()
            pairs = _all_of(met.where(F.col("n") <= few), similarity)
            pairs = pairs.unionByName(_crowded(materialise(crowd, "crowd"), sets, similarity, hot))
        pairs = materialise(pairs.distinct(), "pairs")
        links = materialise(_verified(pairs, sets, similarity, hot), "links")
        moved = components(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(), hot)
        moved = materialise(moved, "roots")
        steps.append(moved)
        if turn < LEADERS:
            # A leader has met all of its bucket.
            live = met.where(F.col("member.node") != F.col("leader.node")).select("bucket", "member")
            live = materialise(_renamed(live, moved, hot), "band-members")
    root = _roots(steps, hot)
    return found.select("row", "id", "node").join(root, "node").select("row", "id", "root")


def _crowded(crowd: DataFrame, sets: DataFrame, similarity: float, hot: int) -> DataFrame:
    """Pairs of nodes that crowded buckets hold (node, label, size), all that may be similar, by their rarest shingles.

    Sets are ordered by how many of the crowd have a shingle. Behind the first
    shingle that two similar sets share, enough must follow in both; so it is
    among the first fifth of either at similarity 0.8. A shingle that no other
    has only counts as a place. Under a shingle, members of the label that most
    have are compared with others only.
    """
    held = sets.join(crowd, "node").select("node", "label", "size", F.explode("shingles").alias("shingle"))
    often = materialise(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-shingles")
    common = join_unique(held, often, ["shingle"], hot_keys(often, ["shingle"], hot), ["node"])
    ordered = common.groupBy("node", "label", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("shared")
    )
    own = F.col("size") - F.size("shared")
    # A little less than the bound, as it is worked out in floating point.
    places = (F.col("size") - F.ceil(F.col("size") * similarity - 1e-6) + 1 - own).cast("int")
    first = ordered.select(
        F.struct("node", "label", "size").alias("member"), own.alias("own"),
        F.posexplode(F.slice("shared", 1, F.greatest(places, F.lit(0)))).alias("k", "s"),
    )
    first = first.select(
        "member", F.col("s.shingle").alias("shingle"), (F.col("member.size") - F.col("own") - F.col("k")).alias("rest")
    )
    first = materialise(first, "rare-shingles")
    labels = first.groupBy("shingle", F.col("member.label").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    most = labels.groupBy("shingle").agg(
        F.max_by("label", F.struct("n", "label")).alias("most"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")
    )
    most = materialise(most.where("labels > 1").drop("labels"), "open-shingles")
    marked = join_unique(first, most, ["shingle"], hot_keys(most.select("shingle", "n"), ["shingle"], hot), ["member"])
    marked = materialise(marked.withColumn("pieces", F.ceil(F.col("n") / hot).cast("int")), "open-members")
    left = marked.where(F.col("member.label") != F.col("most")).select(
        "shingle", F.col("member").alias("x"), F.col("rest").alias("x_rest"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
    )
    right = marked.select(
        "shingle", F.col("member").alias("y"), F.col("rest").alias("y_rest"), "most",
        F.pmod(F.xxhash64("member.node"), F.col("pieces")).cast("int").alias("piece"),
    )
    need = F.ceil((F.col("x.size") + F.col("y.size")) * (similarity / (1 + similarity)) - 1e-6)
    once = (F.col("y.label") == F.col("most")) | (F.col("x.node") < F.col("y.node"))
    other = (F.col("x.label") != F.col("y.label")) & (F.least("x_rest", "y_rest") >= need) & once
    return _unlike(left.join(right, ["shingle", "piece"]).where(other), "x", "y", similarity)


def _roots(steps: list[DataFrame], hot: int) -> DataFrame:
    """node and root after all steps, each of which names labels of the one before anew."""
    known = steps[-1]
    for step in reversed(steps[:-1]):
        counts = materialise(step.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "root-sizes")
        last = known.select(F.col("node").alias("root"), F.col("root").alias("last"))
        named = join_unique(step, last, ["root"], hot_keys(counts, ["root"], hot), ["node"], "left")
        named = named.select("node", F.coalesce("last", "root").alias("root"))
        known = materialise(named.unionByName(known.join(step, "node", "left_anti")), "roots")
    return known


def one_of_similar(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SIMILAR_WORDS,
    similarity: float = SIMILARITY, hot: int = HOT_ROWS,
) -> DataFrame:
    """``docs`` without all but one row of each group linked by similarity: that with the smallest id, nulls last."""
    placed = located(docs)
    found = materialise(similar_groups(placed, id_column, text_column, words, similarity, hot=hot), "similar")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    stays = found.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    return without(placed, found.join(stays, "row", "left_anti"))
