"""Lempel-Ziv phrase fingerprints: compression-like similarity by minimum hashes of a text's dictionary phrases.

A text is parsed into phrases, each the longest phrase seen so far and one more character. The set of phrases is
what a compressor's dictionary would hold; texts that compress each other well share many. The set is hashed and
kept as minimum hashes, so the share of equal minima estimates the likeness (Jaccard) of two phrase sets.

:func:`fingerprint_texts` is a map over rows without a shuffle. :func:`edited_neighbours` compares every document
with the next one in order of id and with an edited text of its own. It moves every text once: the ids alone are
range-partitioned to find the bounds of chunks, then each text is sent to its chunk, and the first document of a
chunk also to the chunk before. A task reads its chunk in order and holds two documents at a time.

Defined results: a null text is empty; an empty text has no phrases, and its fingerprint is like that of another
empty text only; equal ids are ordered by text, and rows equal in both are neighbours; documents without an id are
not in the order, each is its own next document; a single document is its own next; an empty table gives an empty
table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Minimum hashes of a fingerprint, each 32 bits wide.
MINIMA = 64
PHRASES_AT_ONCE = 4096
NOTHING = 0xFFFFFFFF


def odd_multipliers(n: int) -> np.ndarray:
    """Fixed odd 64-bit numbers from a linear congruential rule."""
    found, x = [], 0x2545F4914F6CDD1D
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        found.append(x | 1)
    return np.array(found, np.uint64)


MULTIPLIERS = odd_multipliers(MINIMA)


def parse(text: str, start: int = 0, phrases: tuple[str, ...] | list[str] = ()) -> list[str]:
    """New phrases of ``text`` from ``start`` on, given the phrases of what stands before.

    All beginnings of a phrase are phrases, so the longest known one is found by growing or shrinking from the
    length of the phrase before. What is left at the end is known already and adds nothing.
    """
    known = set(phrases)
    found: list[str] = []
    n, i, k = len(text), start, 1
    while i < n:
        if text[i : i + k] in known:
            k += 1
            while i + k <= n and text[i : i + k] in known:
                k += 1
        else:
            while k > 1 and text[i : i + k - 1] not in known:
                k -= 1
        if i + k > n:
            # The rest may be shorter than the phrase before; shrinking has found its longest known beginning.
            if text[i:] in known:
                break
            k = n - i
        piece = text[i : i + k]
        known.add(piece)
        found.append(piece)
        i += k
    return found


def hashes(phrases: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(p) for p in phrases), np.uint64, len(phrases))


def minima(values: np.ndarray) -> np.ndarray:
    least = np.full(MINIMA, NOTHING, np.uint64)
    for begin in range(0, len(values), PHRASES_AT_ONCE):
        spread = values[begin : begin + PHRASES_AT_ONCE, None] * MULTIPLIERS
        least = np.minimum(least, spread.min(0) >> np.uint64(32))
    return least


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal minima; what has no phrases is like nothing but its equal."""
    if a[0] == NOTHING or b[0] == NOTHING:
        return float((a == b).all())
    return float((a == b).mean())


def fingerprint_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)``: the minimum hashes of the phrases of every whole text, as hexadecimal digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_text(minima(hashes(parse(t.as_py() or "")))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fingerprint string")


class Parsed(NamedTuple):
    key: int | None
    text: str
    phrases: list[str]
    values: np.ndarray
    signature: np.ndarray


def parsed(key: int | None, text: str) -> Parsed:
    phrases = parse(text)
    values = hashes(phrases)
    return Parsed(key, text, phrases, values, minima(values))


EDITED = (
    "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_row(own: Parsed, following: Parsed) -> tuple:
    """The document against its edited text and its next document."""
    n = len(own.text)
    cut = n - n // 4
    edited = own.text[:cut] + following.text[: n // 4]
    # The edited text parses like the document as far as whole phrases lie in the common part.
    ends = np.cumsum(np.fromiter(map(len, own.phrases), np.int64, len(own.phrases)))
    same = int(np.searchsorted(ends, cut, "right"))
    rest = parse(edited, int(ends[same - 1]) if same else 0, own.phrases[:same])
    changed = np.minimum(minima(own.values[:same]), minima(hashes(rest)))
    return (
        own.key,
        n,
        hashlib.sha256(edited.encode()).hexdigest(),
        as_text(own.signature),
        as_text(changed),
        likeness(own.signature, changed),
        likeness(own.signature, following.signature),
    )


def chunk_bounds(docs: DataFrame, key: str, chunks: int) -> list[int]:
    """The smallest id of each chunk, one number per chunk, ascending."""
    ranged = docs.select(key).where(F.col(key).isNotNull()).repartitionByRange(chunks, key)
    lows = ranged.groupBy(F.spark_partition_id().alias("chunk")).agg(F.min(key).alias("low"))
    return sorted(r.low for r in lows.collect())


def edited_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """:data:`EDITED` per document; its edited text ends with the beginning of the next document.

    The last floor(n/4) characters are replaced by as many of the next document, ascending id; the first document
    follows the last.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.array(chunk_bounds(docs, key, partitions), np.int64)
    chunks = len(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their chunk; first documents also go to the chunk before. part: 0 own, 1 borrowed, 2 no id."""
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy(zero_copy_only=False)
            chunk = np.where(missing, np.arange(len(values)) % partitions, np.searchsorted(bounds, values, "right") - 1)
            first = np.flatnonzero(~missing & (bounds[np.maximum(chunk % max(1, chunks), 0)] == values)) if chunks else []
            lent = np.array(first, np.int64)
            rows = pa.array(np.r_[np.arange(len(values)), lent])
            to = np.r_[chunk, (chunk[lent] - 1) % max(1, chunks)]
            part = np.r_[np.where(missing, 2, 0), np.ones(len(lent), np.int64)]
            columns = [pa.array(to.astype(np.int32)), pa.array(part.astype(np.int32)), ids.take(rows), texts.take(rows)]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "part", "key", "text"])

    dealt = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(
        deal, "chunk int, part int, key bigint, text string"
    )
    ordered = dealt.repartitionById(partitions, "chunk").sortWithinPartitions("chunk", "part", "key", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Parsed | None = None
        at = None
        for batch in batches:
            rows = []
            for chunk, part, id_, content in zip(*(c for c in batch.columns), strict=True):
                here, kind = chunk.as_py(), part.as_py()
                if kind == 1 and (own is None or at != here):
                    # Another first document of the same id, or of a chunk that was walked already.
                    continue
                new = parsed(id_.as_py(), content.as_py() or "")
                if kind == 2:
                    rows.append(edited_row(new, new))
                    continue
                if own is not None and at == here:
                    rows.append(edited_row(own, new))
                own, at = (new, here) if kind == 0 else (None, None)
            if rows:
                names = [f.split()[0] for f in EDITED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    return ordered.mapInArrow(walk, EDITED)
