"""Spelling variant grouping: words one edit apart, found by blocked Gram matrices of their letter counts.

A word is a vector of letter counts. Two words one insertion, deletion or replacement apart have squared distance one
or two, and their lengths differ by one at most; the squared distances of two blocks of words are two matrix products.
Letters fall into a few classes; a block holds the words with the same number of letters of each class, so all its
words have one length. One edit adds or takes one letter of one class, or moves one letter between two classes: a block
meets itself and those neighbours only, each pair of blocks once. Pairs at squared distance two at most are then
verified letter by letter.

Counting is a map over whole texts with a bounded table per task and a sum per word, so a word that holds a third of
all text is a few rows. A block above ``chunk`` words is dealt into chunks by hash; a task holds one home chunk and the
visiting chunks one after the other, each pair of words is compared in one place, and only the words with a near word
leave it, summed up. Forms are followed by doubling: each round joins the written links with themselves.

Defined results: a null text has no words; a null id counts as empty text in the edit; an empty table gives no rows;
repeated rows and repeated runs count each; very long runs are words like any other; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import frequent_keys, spread_join
from ledgerloom.sources import work_folder

LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5
EDIT_EVERY = 199

# Letter classes of the blocks, and words of a chunk (expected).
CLASSES = 5
CHUNK = 4096

# Bounds of a task's table of counts.
HELD_WORDS = 300_000
HELD_CHARACTERS = 1 << 26
ROWS_AT_ONCE = 50_000
# Bytes of a comparison matrix, and cells of verified pairs at once.
CELLS_AT_ONCE = 1 << 22

# The letters; all are single bytes in Latin-1.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
RUNS = rf"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"


# Words


def lowered(text: str) -> str:
    """Lower-case A to Z alone."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def edited(run: bytes, mark: int) -> bytes:
    """The run without its code point number ``mark`` modulo its length."""
    word = run.decode()
    at = mark % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def count_runs(found: Counter, key: str, text: str, every: int = EDIT_EVERY) -> None:
    """Add the runs of one text, with the edit that the checksum of key and run decides.

    Shorter runs cannot give a word, so the pattern leaves them out.
    """
    low = lowered(text)
    runs = re.findall(RUNS.encode(), low.encode()) if low.isascii() else [r.encode() for r in re.findall(RUNS, low)]
    prefix = zlib.crc32(f"{key}:".encode())
    checksum = zlib.crc32
    found.update(runs)
    for run in [r for r in runs if not checksum(r, prefix) % every]:
        found[run] -= 1
        found[edited(run, checksum(run, prefix))] += 1


def partial_counts(docs: DataFrame, key: str, text: str, every: int) -> DataFrame:
    """``(word, n)`` as counted by each task, with words of too few letters among them."""

    def rows(found: Counter) -> Iterator[pa.RecordBatch]:
        kept = [(word, n) for word, n in found.items() if n]
        for begin in range(0, len(kept), ROWS_AT_ONCE):
            words, counts = zip(*kept[begin : begin + ROWS_AT_ONCE], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        read = 0
        for batch in batches:
            for own_key, own_text in zip(*batch.columns, strict=True):
                body = own_text.as_py() or ""
                read += len(body)
                count_runs(found, own_key.as_py() or "", body, every)
                if len(found) >= HELD_WORDS or read >= HELD_CHARACTERS:
                    yield from rows(found)
                    found, read = Counter(), 0
        yield from rows(found)

    return docs.select(F.col(key).cast("string"), F.col(text)).toDF("key", "text").mapInArrow(run, "word string, n bigint")


def class_counts(word: str, classes: int) -> F.Column:
    """Letters of each class, as an array; a letter's class is its code point modulo their number."""
    return F.array(
        *(
            F.length(word) - F.length(F.translate(word, "".join(c for c in LETTERS if ord(c) % classes == k), ""))
            for k in range(classes)
        )
    )


def vocabulary(docs: DataFrame, key: str, text: str, least_count: int, every: int, classes: int) -> DataFrame:
    """``(word, n, block)`` of the words that are long and frequent enough."""
    counts = partial_counts(docs, key, text, every).groupBy("word").agg(F.sum("n").alias("n"))
    long_enough = counts.where((F.col("n") >= least_count) & (F.length("word") >= LEAST_LETTERS))
    return long_enough.select("word", "n", class_counts("word", classes).alias("block"))


# Blocks


def moves(classes: int) -> list[list[int]]:
    """Steps to the blocks that a block visits: itself, one letter more, and one letter of another class.

    Every pair of neighbouring blocks is one step in one direction only.
    """
    unit = np.eye(classes, dtype=int)
    more = [unit[i] for i in range(classes)]
    other = [unit[i] - unit[j] for i in range(classes) for j in range(i)]
    return [step.tolist() for step in (np.zeros(classes, int), *more, *other)]


def visits(words: DataFrame, classes: int, chunk: int) -> DataFrame:
    """``(home, at, own, block, words, counts)``: packed chunks with the home chunks that they go to, their own first.

    Within a block a chunk visits the chunks after it.
    """
    blocks = words.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    dealt = words.join(blocks, "block").withColumn("number", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
    entry = F.sort_array(F.collect_list(F.struct("word", "n")))
    packed = dealt.groupBy("block", "number").agg(entry.alias("entries"))

    steps = F.array(*(F.array(*map(F.lit, step)) for step in moves(classes)))
    goals = blocks.select("block", F.explode(steps).alias("step")).select(
        "block", F.zip_with("block", "step", lambda a, b: a + b).alias("home")
    )
    routes = goals.join(blocks.withColumnsRenamed({"block": "home", "chunks": "homes"}), "home")
    same = F.col("home") == F.col("block")
    first = F.when(same, F.col("number")).otherwise(0)
    sent = packed.join(routes, "block").withColumn("at", F.explode(F.sequence(first, F.col("homes") - 1)))
    return sent.select(
        F.concat_ws(".", "home").alias("home"),
        "at",
        (same & (F.col("at") == F.col("number"))).alias("own"),
        "block",
        "number",
        F.encode(F.array_join(F.col("entries.word"), ""), "ISO-8859-1").alias("letters"),
        F.col("entries.n").alias("counts"),
    )


class Words:
    """A chunk of words of one length, ascending: their letters, counts and letter-count vectors."""

    def __init__(self, letters: bytes, counts: list[int]):
        self.counts = np.array(counts, np.int64)
        self.codes = np.frombuffer(letters, np.uint8).reshape(len(counts), -1)
        n, self.length = self.codes.shape
        # Squares of long words do not fit a short float exactly.
        kind = np.float32 if self.length < 2000 else np.float64
        flat = np.arange(n)[:, None] * 256 + self.codes
        self.vectors = np.bincount(flat.ravel(), minlength=n * 256).reshape(n, 256).astype(kind)
        self.squares = (self.vectors**2).sum(1)
        self.used = self.vectors.any(0)

    def text(self, i: int) -> str:
        return self.codes[i].tobytes().decode("latin-1")


def close_pairs(a: Words, b: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words whose letter counts are at squared distance two at most, a few rows of ``a`` at a time."""
    columns = a.used & b.used
    own, other = a.vectors[:, columns], np.ascontiguousarray(b.vectors[:, columns].T)
    rows = max(1, CELLS_AT_ONCE // len(b.counts))
    for begin in range(0, len(a.counts), rows):
        gram = own[begin : begin + rows] @ other
        gram *= 2
        gram += 2
        i, j = np.nonzero(gram >= a.squares[begin : begin + rows, None] + b.squares[None, :])
        yield i + begin, j


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of letters, whether exactly one replacement, or one more letter in ``b``, tells them apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    # The letters equal from the front and those equal from the back must cover the shorter word.
    front = np.cumprod(a == b[:, :-1], axis=1, dtype=np.uint8).sum(1, dtype=np.int64)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(1, dtype=np.int64)
    return front + back >= a.shape[1]


def near_pairs(a: Words, b: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of ``a`` and ``b`` that are one edit apart; ``b`` is no shorter."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rows = max(1, CELLS_AT_ONCE // b.length)
    for i, j in close_pairs(a, b):
        for begin in range(0, len(i), rows):
            x, y = i[begin : begin + rows], j[begin : begin + rows]
            near = one_edit(a.codes[x], b.codes[y])
            found.append((x[near], y[near]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    xs, ys = zip(*found, strict=True)
    return np.concatenate(xs), np.concatenate(ys)


def best_of_each(own: np.ndarray, other: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word in ``own``: how many partners it has, and the one of largest count, the smallest of equals."""
    order = np.lexsort((other, -words.counts[other], own))
    own, other = own[order], other[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, np.int64)
    return own[starts], np.diff(np.r_[starts, len(own)]), other[starts]


NEAR = "word string, n_near bigint, best_n bigint, best string"


def near_words(sent: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` per word and meeting of two chunks."""

    def told(own: np.ndarray, other: np.ndarray, a: Words, b: Words) -> Iterator[pa.RecordBatch]:
        words, sizes, best = best_of_each(own, other, b)
        if len(words):
            columns = [
                pa.array(map(a.text, words.tolist()), pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array(b.counts[best], pa.int64()),
                pa.array(map(b.text, best.tolist()), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home: Words | None = None
        for batch in batches:
            for own, letters, counts in zip(*(batch.column(c) for c in ("own", "letters", "counts")), strict=True):
                words = Words(letters.as_py(), counts.as_py())
                if own.as_py():
                    home = words
                    i, j = near_pairs(home, home)
                    yield from told(i, j, home, home)
                    continue
                # A visitor's words are as long as those at home, or one letter shorter.
                i, j = near_pairs(words, home)
                yield from told(i, j, words, home)
                yield from told(j, i, home, words)

    ordered = sent.repartition("home", "at").sortWithinPartitions("home", "at", F.desc("own"))
    return ordered.select("own", "letters", "counts").mapInArrow(run, NEAR)


# Forms


def follow(links: DataFrame, rounds: int) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: forms followed to the last, by doubling."""
    spark = links.sparkSession
    for number in range(rounds + 1):
        folder = work_folder(spark, "forms")
        links.write.parquet(folder)
        links = spark.read.parquet(folder)
        if number < rounds:
            onward = links.select(F.col("word").alias("form"), F.col("form").alias("next"))
            joined = spread_join(links, onward, "form", frequent_keys(links, "form"), ["word"])
            links = joined.select("word", F.coalesce("next", "form").alias("form"))
    return links.withColumnRenamed("form", "root")


def group_spellings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_count: int = LEAST_COUNT,
    every: int = EDIT_EVERY,
    classes: int = CLASSES,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the texts."""
    spark = docs.sparkSession

    def written(df: DataFrame, purpose: str) -> DataFrame:
        folder = work_folder(spark, purpose)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    words = written(vocabulary(docs, key, text, least_count, every, classes), "words")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    near = near_words(visits(words, classes, chunk)).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    joined = words.join(near, "word", "left").withColumn("top_n", -F.col("top.less"))
    strong = F.col("top_n") >= FORM_RATIO * F.col("n")
    formed = written(
        joined.select(
            "word",
            F.when(strong, F.col("top.best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(strong, F.col("top_n")).alias("form_n"),
        ),
        "formed",
    )
    # A form is FORM_RATIO times as frequent as its word, which bounds the steps to the last one.
    most = formed.agg(F.max("n").alias("n")).first().n or 1
    steps = int(math.log(max(most / least_count, 1), FORM_RATIO) + 1e-9)
    roots = follow(formed.where("form IS NOT NULL").select("word", "form"), math.ceil(math.log2(max(steps, 1))))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
