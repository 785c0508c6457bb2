"""Several tables of tiers are looked up in one ordered pass."""

from __future__ import annotations

import random
from decimal import Decimal

from ledgerloom.operators import tier_lookup, tier_lookups, tiers


def test_several_tables_of_tiers_take_one_ordered_pass(spark, monkeypatch):
    rng = random.Random(7)
    passes, chunks = [], tiers.ordered_chunks
    monkeypatch.setattr(tiers, "ordered_chunks", lambda *args: (passes.append(args), chunks(*args))[1])

    def table(n):
        bands = [(low := Decimal(rng.randrange(0, 400)) / 4, None if rng.random() < 0.1 else low + rng.randrange(0, 40), Decimal(i)) for i in range(n)]
        return spark.createDataFrame(bands, "min_amount decimal(18,4), max_amount decimal(18,4), points_awarded decimal(18,4)")

    amounts = [(i, None if i % 29 == 0 else Decimal(rng.randrange(-8, 500)) / 4) for i in range(400)] * 2
    rows = spark.createDataFrame(amounts, "id int, amount decimal(18,4)")
    old, new, none = table(12), table(9), table(3).limit(0)
    both = sorted(map(tuple, tier_lookups(rows, "amount", {"a": old, "b": new, "c": none}).collect()), key=str)
    assert len(passes) == 1
    alone = tier_lookup(tier_lookup(tier_lookup(rows, "amount", old, "a"), "amount", new, "b"), "amount", none, "c")
    assert sorted(map(tuple, alone.collect()), key=str) == both
    assert {r[4] for r in both} == {0} and len({r[2] for r in both}) > 2
