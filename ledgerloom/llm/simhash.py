"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints: every word shingle of a text votes with the 64 bits of its hash, repeats included.

Links: the anchors are the words of a covering code. 46 of the 64 bits are cut into two blocks of 23, each covered
by the perfect binary Golay code: every block is within 3 bits of exactly one code word, so a fingerprint has one
home anchor. It is replicated to every anchor within the covering radius plus the threshold: those whose block
radius of 3 it exceeds by no more than the threshold, both blocks together. Two fingerprints within the threshold
therefore meet at the home anchors of both, and are compared there on all 64 bits.

Equal fingerprints are one before anything is replicated (about 70 rows each at a threshold of 2). An anchor that is
home to more than ``crowded`` different fingerprints is not compared pair by pair: its members go to the code of
radius 0 instead, all 64-bit points, each to the points within half the threshold; members of one point are within
the threshold of each other, and a point has 65 members at most. That way is exact for thresholds of at most 2, and
a larger threshold compares crowded anchors in blocks. Either way only links that connect the members are returned,
never all pairs of an anchor.

Defined results: a null or blank text has fingerprint zero and is linked like any other; repeated rows are equal
documents; a document without an id takes part but never names a component unless no member has one (then null);
an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.components import components
from ledgerloom.llm.memory import released
from ledgerloom.operators import frequent_keys, spread_join
from ledgerloom.sources import work_folder

SEED = 42
# Bits of a block, the code's generator polynomial (x^11 + x^9 + x^7 + x^6 + x^5 + x + 1) and its covering radius.
BLOCK, GENERATOR, RADIUS = 23, 0b101011100011, 3
# An anchor with more fingerprints at home than this is compared point by point.
CROWDED = 1000
# Shingles and pairs looked at at once.
SHINGLES_AT_ONCE, PAIRS_AT_ONCE = 1 << 16, 1 << 21


def fingerprint(text: str, words: int) -> int:
    """The unsigned fingerprint of one text, over shingles of ``words`` words."""
    # Bytes: lower() and split() look at ASCII only.
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    n = len(tokens) - words + 1
    votes = np.zeros(64, np.int64)
    for begin in range(0, n, SHINGLES_AT_ONCE):
        part = tokens[begin : begin + SHINGLES_AT_ONCE + words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(words)), strict=False))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(key, fingerprint)``, the 64 bits as a signed number, and the ``keep`` columns."""
    kept = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or "", words) for t in batch.column(1)], np.uint64)
            columns = [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("fingerprint", T.LongType()), *kept])
    asked = [docs[c].alias(f"_{i}") for i, c in enumerate([key, text, *keep])]
    return docs.select(*asked).mapInArrow(released(run), schema)


# The covering code


@cache
def syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits of a block by the generator polynomial."""

    def remainder(word: int) -> int:
        for bit in range(BLOCK - 1, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    one = [remainder(1 << i) for i in range(BLOCK)]

    def table(bits: list[int]) -> np.ndarray:
        found = np.zeros(1 << len(bits), np.int64)
        for i, s in enumerate(bits):
            found[1 << i : 2 << i] = found[: 1 << i] ^ s
        return found

    return table(one[:12]), table(one[12:])


def syndrome(blocks: np.ndarray) -> np.ndarray:
    low, high = syndromes()
    return low[blocks & 0xFFF] ^ high[blocks >> 12]


@cache
def differences(excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome, the differences to code words that exceed the radius by ``excess`` bits (0: within it).

    As one array in order of syndrome, and the offsets into it.
    """
    weights = range(RADIUS + 1) if excess == 0 else [RADIUS + excess]
    patterns = np.array([sum(1 << i for i in c) for w in weights for c in combinations(range(BLOCK), w)], np.int64)
    of = syndrome(patterns)
    return patterns[np.argsort(of, kind="stable")], np.r_[0, np.cumsum(np.bincount(of, minlength=1 << 11))]


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place within the row of the elements of rows with ``counts`` elements."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def home_anchor(prints: np.ndarray) -> np.ndarray:
    first, second = prints & 0x7FFFFF, prints >> 23 & 0x7FFFFF
    leader, at = differences(0)
    return (first ^ leader[at[syndrome(first)]]) << BLOCK | (second ^ leader[at[syndrome(second)]])


def near_anchors(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and anchors whose cell is within ``threshold`` bits of the fingerprint."""
    blocks = prints & 0x7FFFFF, prints >> 23 & 0x7FFFFF
    of = [syndrome(b) for b in blocks]
    rows, anchors = [], []
    for a in range(threshold + 1):
        for b in range(threshold + 1 - a):
            (pa_, at_a), (pb_, at_b) = differences(a), differences(b)
            n_a, n_b = at_a[of[0] + 1] - at_a[of[0]], at_b[of[1] + 1] - at_b[of[1]]
            row, place = ragged(n_a * n_b)
            x = pa_[at_a[of[0][row]] + place // n_b[row]]
            y = pb_[at_b[of[1][row]] + place % n_b[row]]
            rows.append(row)
            anchors.append((blocks[0][row] ^ x) << BLOCK | (blocks[1][row] ^ y))
    return np.concatenate(rows), np.concatenate(anchors)


def replicate(prints: DataFrame, threshold: int) -> DataFrame:
    """``(anchor, fingerprint, home)`` for every anchor within the covering radius plus the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_prints = batch.column(0).to_numpy()
            for begin in range(0, len(all_prints), 4096):
                own = all_prints[begin : begin + 4096]
                row, anchor = near_anchors(own, threshold)
                columns = [pa.array(anchor), pa.array(own[row]), pa.array(anchor == home_anchor(own)[row])]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "fingerprint", "home"])

    return prints.select("fingerprint").mapInArrow(run, "anchor bigint, fingerprint bigint, home boolean")


# Comparison


def connect(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node) that connect what the links u-v connect, at most one per node."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, before[a], least)
        np.minimum.at(root, before[b], least)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def compare_cells(anchor: np.ndarray, prints: np.ndarray, home: np.ndarray, threshold: int):
    """Links among the members of whole cells, given in order of anchor: members against those at home."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    cell = np.cumsum(np.r_[0, anchor[1:] != anchor[:-1]])
    at_home = np.flatnonzero(home)
    homes_before = np.r_[0, np.cumsum(home)]
    n_homes = np.add.reduceat(home.astype(np.int64), starts)
    first_home = homes_before[starts]
    counts = n_homes[cell]
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(anchor):
        # As many members as make at most so many pairs, one at least.
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS_AT_ONCE, "right")))
        row, place = ragged(counts[begin:end])
        row += begin
        other = prints[at_home[first_home[cell[row]] + place]]
        own = prints[row]
        near = (own != other) & (np.bitwise_count((own ^ other).view(np.uint64)) <= threshold)
        if near.any():
            yield connect(own[near], other[near])
        begin = end


def link_cells(members: DataFrame, threshold: int) -> DataFrame:
    """Links ``(u, v)`` within cells; members of a cell stand together and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for u, v in compare_cells(*columns, threshold):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if not len(new[0]):
                continue
            held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
            # The last cell may go on in the next batch.
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield from links([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held:
            yield from links(held)

    ordered = members.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.select("anchor", "fingerprint", "home").mapInArrow(run, "u bigint, v bigint")


def link_points(prints: DataFrame) -> DataFrame:
    """Links ``(u, v)`` of all fingerprints within two bits: those that share a point within one bit of both."""
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)))
    points = prints.select("fingerprint", F.explode(F.transform(flips, lambda f: F.col("fingerprint").bitwiseXOR(f))).alias("point"))
    # A point has 65 neighbours, itself included: the set is bounded.
    met = points.groupBy("point").agg(F.collect_set("fingerprint").alias("members")).where("size(members) > 1")
    return met.select(F.array_min("members").alias("v"), F.explode("members").alias("u")).where("u <> v").select("u", "v")


def link_fingerprints(prints: DataFrame, threshold: int, crowded: int = CROWDED) -> DataFrame:
    """Links that connect all of the different ``fingerprint`` values within ``threshold`` bits."""
    members = replicate(prints, threshold)
    if threshold > 2:
        return link_cells(members, threshold)
    busy = replicate(prints, 0).groupBy("anchor").count().where(F.col("count") > crowded).select("anchor")
    quiet = link_cells(members.join(busy, "anchor", "left_anti"), threshold)
    dense = members.join(busy, "anchor", "left_semi").select("fingerprint").distinct()
    return quiet.union(link_points(dense))


def grouped(
    docs: DataFrame, words: int, threshold: int, key: str, text: str, crowded: int, keep: Sequence[str] = ()
) -> DataFrame:
    """``(key, fingerprint, root, component_id)`` and the ``keep`` columns: the root tells components apart."""
    spark = docs.sparkSession
    folder = work_folder(spark, "simhash")
    fingerprints(docs, words, key, text, keep).write.parquet(folder)
    prints = spark.read.parquet(folder)
    distinct = prints.groupBy("fingerprint").agg(F.min("key").alias("first"))
    roots = components(link_fingerprints(distinct, threshold, crowded))
    placed = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    lookup = placed.join(names, "root").select("fingerprint", "root", "component_id")
    return spread_join(prints, lookup, "fingerprint", frequent_keys(prints, "fingerprint"), ["key"])


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    threshold: int = 2,
    key: str = "doc_id",
    text: str = "text",
    crowded: int = CROWDED,
) -> DataFrame:
    """``(key, fingerprint, component_id)``: the component is named by its smallest key."""
    joined = grouped(docs, words, threshold, key, text, crowded)
    return joined.select(F.col("key").alias(key), "fingerprint", "component_id")


def one_of_each(
    docs: DataFrame,
    words: int = 3,
    threshold: int = 2,
    key: str = "doc_id",
    text: str = "text",
    crowded: int = CROWDED,
) -> DataFrame:
    """One row of each component, of the smallest key and then text hash; rows without a key come last.

    Components are chosen from by a hash of key and text, so texts meet the choice in one join and go nowhere else.
    The columns of ``docs`` must not be named as those of :func:`grouped`, nor ``_mark``.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    marked = docs.withColumn("_mark", F.md5(F.encode(F.concat_ws(":", name, text), "UTF-8")))
    rows = grouped(marked, words, threshold, key, text, crowded, ["_mark"])
    first = F.min(F.struct(F.col("key").isNull(), "key", "_mark"))
    chosen = rows.groupBy("root").agg(first.alias("first")).select("first._mark")
    # Rows that are equal in key and text share a mark; they stand together after the join.
    return marked.join(chosen, "_mark", "left_semi").dropDuplicates(["_mark"]).select(*docs.columns)


def hexadecimal(value: str):
    """A signed 64-bit number as 16 lowercase digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
