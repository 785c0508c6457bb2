"""Filter interaction audit: what each filter removes in every order in which the filters could run.

Each document has a failure mask, one bit per filter. Masks are counted per part (source), with the documents of
good quality and the toxic ones among them. Per part the counts become a decision diagram: level ``k`` tests the
``k``-th filter of the order, equal subdiagrams are one node, and every node weighs the documents below it. A swap of
two neighbouring levels gives the diagram of the next order, so one diagram is walked through all orders, each one swap
from the one before. In an order, the path along which every filter passes holds its steps: at each node the weight of
the failing side is what the step removes, and of the passing side what it keeps.

Texts are read once: a row's id, part, text hash and mask bits are written, and equal texts are found by SHA-256. The
first id of each repeated hash is found by an aggregate; a third of all rows with one text, or with one id, is spread
over tasks. A diagram has at most two to the number of filters counts, whatever the size of its part.

Defined results: a null text is empty (so it equals empty texts); a null part counts as the part ''; a row without an
id is no copy of any, no row is a copy of it, and it has no labels; rows of one id and text are no copies of each
other; an id with several labels has each that one of them has; repeated rows count each; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import frequent_keys, spread_join
from ledgerloom.sources import work_folder

# The filters in the order of their mask bits; the last compares documents with each other.
FILTERS = "ABCDE"
LEAST_WORDS = 200
WHITE_SPACE = "\t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "#$%&*|"

# Documents, good ones, toxic ones.
Weight = tuple[int, int, int]

SCHEMA = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


# Masks


def text_failures(text: Column) -> Column:
    """Mask bits of the filters that judge a text alone: short, repetitive, capitals, symbols."""
    pieces = F.split(F.translate(text, WHITE_SPACE, " " * len(WHITE_SPACE)), " ")
    words = F.array_remove(pieces, "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    failures = [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals > 2 * F.length(text),
        F.length(F.translate(text, SYMBOLS, "")) < F.length(text),
    ]
    return sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(failures)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and failure mask."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    folder = work_folder(spark, "masks")
    docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.sha2(F.encode(body, "UTF-8"), 256).alias("hash"),
        text_failures(body).alias("mask"),
    ).write.parquet(folder)
    rows = spark.read.parquet(folder)

    known = rows.where("id IS NOT NULL")
    first = (
        known.groupBy("hash").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    compared = spread_join(rows, first, "hash", frequent_keys(rows, "hash"), ["id"])
    copy = F.when(F.col("id") > F.col("first"), 1 << (len(FILTERS) - 1)).otherwise(0)

    flags = (
        labels.select(F.col(key).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
        .where("id IS NOT NULL AND (good OR toxic)")
        .groupBy("id")
        .agg(F.bool_or("good").alias("good"), F.bool_or("toxic").alias("toxic"))
    )
    judged = spread_join(
        compared.select("id", "part", "hash", (F.col("mask") + copy).alias("mask")), flags, "id", frequent_keys(rows, "id"), ["hash"]
    )
    return judged.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


# Diagrams


def added(a: Weight, b: Weight) -> Weight:
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2])


class Diagram:
    """A count-weighted decision diagram of failure masks, ordered by ``self.order``.

    ``children[node]`` is (passing, failing); the nodes of the last level lead to leaves, one per different weight.
    ``nodes[k]`` finds the node of level ``k`` by its children, so equal subdiagrams are one node.
    """

    def __init__(self, counts: dict[int, Weight], filters: str):
        self.order = list(filters)
        self.weight: list[Weight] = []
        self.children: list[tuple[int, int]] = []
        self.leaves: dict[Weight, int] = {}
        self.nodes: list[dict[tuple[int, int], int]] = [{} for _ in filters]
        self.root = self._build(0, 0, counts)

    def _add(self, weight: Weight, children: tuple[int, int]) -> int:
        self.weight.append(weight)
        self.children.append(children)
        return len(self.weight) - 1

    def _leaf(self, weight: Weight) -> int:
        if weight not in self.leaves:
            self.leaves[weight] = self._add(weight, (-1, -1))
        return self.leaves[weight]

    def _node(self, level: int, passing: int, failing: int) -> int:
        found = self.nodes[level].get((passing, failing))
        if found is None:
            found = self._add(added(self.weight[passing], self.weight[failing]), (passing, failing))
            self.nodes[level][passing, failing] = found
        return found

    def _build(self, level: int, mask: int, counts: dict[int, Weight]) -> int:
        if level == len(self.order):
            return self._leaf(counts.get(mask, (0, 0, 0)))
        return self._node(
            level, self._build(level + 1, mask, counts), self._build(level + 1, mask | 1 << level, counts)
        )

    def swap(self, level: int) -> None:
        """Exchange ``level`` and the next one. Nodes above keep their children, nodes below stay."""
        upper, self.nodes[level], self.nodes[level + 1] = self.nodes[level], {}, {}
        self.order[level : level + 2] = self.order[level + 1], self.order[level]
        for (passing, failing), node in upper.items():
            both = zip(self.children[passing], self.children[failing], strict=True)
            inner = tuple(self._node(level + 1, *pair) for pair in both)
            self.children[node] = inner
            self.nodes[level][inner] = node

    def steps(self) -> Iterator[tuple[Weight, Weight]]:
        """Along the path on which all filters pass: the weights removed and kept at each level."""
        node = self.root
        for _ in self.order:
            node, failing = self.children[node]
            yield self.weight[failing], self.weight[node]

    def only(self, name: str) -> int:
        """Documents that fail this filter and no other."""
        node = self.root
        for at_level in self.order:
            node = self.children[node][at_level == name]
        return self.weight[node][0]


def neighbour_swaps(n: int) -> list[int]:
    """Levels to swap with the next one, one after the other, to pass through all orders of ``n`` variables.

    The last variable moves through an order of the others from one end to the other; then they take one swap.
    """
    if n < 2:
        return []
    others = neighbour_swaps(n - 1)
    swaps: list[int] = []
    for turn in range(len(others) + 1):
        at_front = turn % 2 == 0
        swaps += range(n - 2, -1, -1) if at_front else range(n - 1)
        if turn < len(others):
            swaps.append(others[turn] + at_front)
    return swaps


def audit_rows(counts: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """The rows of one part, without its name: every order and step."""
    diagram = Diagram(counts, filters)
    unique = {name: diagram.only(name) for name in filters}
    walked: list[tuple[str, list[tuple[Weight, Weight]]]] = []
    for swap in [None, *neighbour_swaps(len(filters))]:
        if swap is not None:
            diagram.swap(swap)
        walked.append(("".join(diagram.order), list(diagram.steps())))
    alone = {order[0]: steps[0][0][0] for order, steps in walked}
    shapley = dict.fromkeys(filters, 0)
    for order, steps in walked:
        for name, (removed, _) in zip(order, steps, strict=True):
            shapley[name] += removed[0]
    return [
        (order, i + 1, kept[0], removed[0], alone[name] - removed[0], unique[name], removed[1], removed[2], shapley[name])
        for order, steps in walked
        for i, (name, (removed, kept)) in enumerate(zip(order, steps, strict=True))
    ]


def audit_filters(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """Per part, order of filters and step: what is kept, removed, redundant, lost, and the filter's share over all orders."""
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def audited(table: pa.Table) -> pa.Table:
        columns = (table[name].to_pylist() for name in ("mask", "n", "good", "toxic"))
        rows = audit_rows({mask: tuple(weight) for mask, *weight in zip(*columns, strict=True)})
        own: Sequence = [[table["part"][0].as_py()] * len(rows), *zip(*rows, strict=True)]
        types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        return pa.table([pa.array(list(c), kind) for c, kind in zip(own, types, strict=True)], names)

    return failure_counts(docs, labels, key, text, part).groupBy("part").applyInArrow(audited, SCHEMA)
