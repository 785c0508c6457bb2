"""Amount-to-points tier lookup: closed intervals, open top, highest lower bound wins.

An amount has a whole-number position: twice its count of ten-thousandths, plus one if it lies between two of them. Tier
bounds are whole ten-thousandths, so a tier is an interval of positions. The bounds cut the line into stretches of one
winner each. To find the winners, a tier is cut into blocks whose size and start are powers of two, at most two per size;
the blocks that contain a bound are found by shifting it. So tiers and bounds meet by equality, and rows grow with tiers
times sizes, never with pairs, however tiers nest or reach. Amounts then take their stretch in one ordered pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import ordered_chunks
from ledgerloom.sources.tables import work_folder

# Tier bounds are decimal(18,4): their positions lie well within half of this on either side of zero.
SPAN = 1 << 62
# Block sizes, as powers of two; a tier from end to end has two blocks of the largest.
SIZES = 62


def position(amount: Column) -> Column:
    """Place of an amount on the line of positions, null for a null; amounts beyond all tier bounds share the ends of the line."""
    half = F.lit(SPAN // 2).cast("decimal(38,0)")
    scaled = amount.cast("decimal(38,13)") * 10000
    steps = F.floor(scaled)
    between = F.when(scaled > steps, 1).otherwise(0)
    reach = F.greatest(-half, F.least(half, steps.cast("decimal(38,0)") * 2 + between))
    # ``least`` and ``greatest`` pass over a null, which would put it at the end of the line.
    return F.when(amount.isNotNull(), (reach + half).cast("bigint"))


def tier_blocks(tiers: DataFrame) -> DataFrame:
    """``(block, step)``: the tier that wins in each block, as (min_amount, max_amount, points_awarded).

    ``block`` is (size, number). All tiers of a block contain all of it, so the highest lower bound wins there.
    """
    # A null bound matches nothing in the lower position and means "open" in the upper one.
    usable = tiers.where(
        "min_amount IS NOT NULL AND points_awarded IS NOT NULL AND (max_amount IS NULL OR max_amount >= min_amount)"
    )
    ends = usable.select(
        F.struct("min_amount", "max_amount", "points_awarded").alias("step"),
        position(F.col("min_amount")).alias("low"),
        F.when(F.col("max_amount").isNull(), F.lit(SPAN)).otherwise(position(F.col("max_amount"))).alias("high"),
    )
    # Per size: whole blocks between the ends; one is taken at an end that no block of twice the size covers.
    sized = ends.select(
        "step",
        F.explode(
            F.expr(
                f"transform(sequence(0, {SIZES - 1}), k -> struct(k AS size, "
                "shiftright(low + shiftleft(1L, k) - 1, k) AS first, shiftright(high + 1, k) AS after))"
            )
        ).alias("b"),
    ).where("b.first < b.after")
    top = F.col("b.size") == SIZES - 1
    ends_of_size = F.filter(
        F.array(
            F.when(top | (F.col("b.first") % 2 == 1), F.col("b.first")),
            F.when(top | (F.col("b.after") % 2 == 1), F.col("b.after") - 1),
        ),
        lambda n: n.isNotNull(),
    )
    blocks = sized.select(
        "step", F.col("b.size").alias("size"), F.explode(F.array_distinct(ends_of_size)).alias("number")
    )
    return blocks.groupBy(F.struct("size", "number").alias("block")).agg(F.max("step").alias("step"))


def tier_starts(tiers: DataFrame) -> DataFrame:
    """``(position, step)``: where a winner begins to hold; ``step`` is null where none does.

    Winners change only at the lower bound of a tier and behind the upper bound of one. These places, two per tier at
    most, are matched with the blocks that contain them.
    """
    blocks = tier_blocks(tiers)
    ends = tiers.where("min_amount IS NOT NULL").select(
        F.explode(F.array(position(F.col("min_amount")), position(F.col("max_amount")) + 1)).alias("position")
    )
    places = ends.where(F.col("position").isNotNull()).distinct()
    sizes = F.sequence(F.lit(0), F.lit(SIZES - 1))
    containing = places.withColumn("size", F.explode(sizes)).select(
        "position", F.struct(F.col("size"), F.expr("shiftright(position, size)").alias("number")).alias("block")
    )
    return containing.join(blocks, "block", "left").groupBy("position").agg(F.max("step").alias("step"))


def tier_lookup(
    rows: DataFrame, amount: str, tiers: DataFrame, points: str = "points_delta", folder: str | None = None
) -> DataFrame:
    """Add ``points`` for the tier that holds ``amount``; 0 when none does or the amount is null.

    One ordered pass: rows and the places where winners begin are range-partitioned by position, and each row takes the
    last place at or before it. Rows that share a popular amount are spread over chunks by a hash. ``folder`` holds the
    ordered rows; by default a fresh working folder.
    """
    return tier_lookups(rows, amount, {points: tiers}, folder)


def tier_lookups(rows: DataFrame, amount: str, tiers: dict[str, DataFrame], folder: str | None = None) -> DataFrame:
    """:func:`tier_lookup` for several tables of tiers (name of the points -> tiers), still in one ordered pass."""
    own = F.struct(*rows.columns)
    starts = [f"_start{i}" for i in range(len(tiers))]
    # An amount that is null lies before all tiers; places come before the rows at the same position.
    places = [
        tier_starts(table).select(F.col("position").alias("_position"), F.struct("step").alias(start))
        for start, table in zip(starts, tiers.values(), strict=True)
    ]
    asked = rows.select(
        F.coalesce(position(F.col(amount)), F.lit(-1).cast("bigint")).alias("_position"),
        F.xxhash64(*rows.columns).alias("_spread"),
        own.alias("_row"),
    )
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), places, asked)
    chunks = ordered_chunks(
        both.withColumn("_asks", F.col("_row").isNotNull()), "_position", ["_asks", "_spread"],
        folder or work_folder(rows.sparkSession, "tiers"),
    )
    # What a chunk takes over from the chunks before it: one row per chunk.
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunks.groupBy("_chunk")
        .agg(*(F.max_by(s, F.when(F.col(s).isNotNull(), F.col("_position"))).alias(f"_last{s}") for s in starts))
        .select("_chunk", *(F.last(f"_last{s}", ignorenulls=True).over(before).alias(f"_carried{s}") for s in starts))
    )
    within = Window.partitionBy("_chunk").orderBy("_position", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    held = {f"_here{s}": F.last(s, ignorenulls=True).over(within) for s in starts}
    winners = {points: F.coalesce(f"_here{s}", f"_carried{s}") for points, s in zip(tiers, starts, strict=True)}
    return (
        chunks.withColumns(held)
        .where("_asks")
        .join(F.broadcast(carried), "_chunk")
        .select("_row.*", *(F.coalesce(w["step"]["points_awarded"], F.lit(0)).alias(p) for p, w in winners.items()))
    )
