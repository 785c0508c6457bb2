"""Filter audit, one-bit search and spelling variants: against plain versions, and edge cases."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import audit, onebit, spelling

# Filter audit


def plain_masks(docs):
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    masks = []
    for key, text, _ in docs:
        text = text or ""
        words = text.encode().split()
        failures = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            any(c in "#$%&*|" for c in text),
            key is not None and key > first[text],
        ]
        masks.append({name for name, failed in zip("ABCDE", failures, strict=True) if failed})
    return masks


def plain_audit(docs, labels):
    masks = plain_masks(docs)
    good = {key for key, quality, _ in labels if quality == 1 and key is not None}
    toxic = {key for key, _, bad in labels if bad == 1 and key is not None}
    rows = []
    for part in {d[2] or "" for d in docs}:
        own = [(mask, key) for mask, (key, _, source) in zip(masks, docs, strict=True) if (source or "") == part]
        found, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                shapley[name] += len(gone)
                found.append(
                    ("".join(order), step, name, len(left), len(gone), sum(name in m for m, _ in own) - len(gone),
                     sum(m == {name} for m, _ in own), sum(k in good for _, k in gone), sum(k in toxic for _, k in gone))
                )
        rows += [(part, order, step, *rest, shapley[name]) for order, step, name, *rest in found]
    return Counter(rows)


def audit_docs(rng):
    words = [f"w{i}" for i in range(300)]
    long_text = " ".join(words[:220])
    texts = [
        long_text, long_text + " #", long_text.replace("w", "Wo"), "a b c", "", None, " ".join(["same"] * 300),
        "ONE TWO " * 150, long_text + " tail", "x\t" * 200 + "|", "é" * 900 + " " + long_text,
    ]
    return [(i if rng.random() < 0.95 else None, rng.choice(texts), rng.choice(["hot", "hot", "b", "", None])) for i in range(150)]


def test_audit_equals_running_every_order(spark):
    rng = random.Random(5)
    docs = audit_docs(rng)
    # Repeated rows, repeated ids, an id with several labels, labels without a document or an id.
    docs += [docs[0], docs[0], (3, "other text", "b")]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (999, 1, 1), (None, 1, 1), (6, None, None)]
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, source string, part string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = audit.audit_filters(table, marks)
    assert Counter(map(tuple, got.collect())) == plain_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.audit_filters(docs, labels).collect() == []
    one = audit.audit_filters(spark.createDataFrame([(1, None, None)], docs.schema), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""}
    assert {(r.removed, r.kept) for r in one if r.filter_order.startswith("A") and r.step == 1} == {(1, 0)}


def test_very_long_text_is_audited_whole(spark):
    text = "word " * 400_000 + "%"
    docs = spark.createDataFrame([(1, text, "a")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = {r.filter_order: r.removed for r in audit.audit_filters(docs, labels).collect() if r.step == 1}
    assert rows["DABCE"] == 1 and rows["BACDE"] == 1 and rows["ABCDE"] == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_swaps_pass_through_all_orders(n):
    order = list(range(n))
    seen = {tuple(order)}
    for level in audit.neighbour_swaps(n):
        order[level : level + 2] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == len(audit.neighbour_swaps(n)) + 1 == len(list(itertools.permutations(range(n))))


def test_swapped_diagrams_are_those_built_in_that_order():
    rng = random.Random(2)
    counts = {m: (rng.randrange(3), rng.randrange(2), rng.randrange(2)) for m in range(32) if rng.random() < 0.6}
    diagram = audit.Diagram(counts, "ABCDE")
    for level in audit.neighbour_swaps(5):
        diagram.swap(level)
        place = {name: i for i, name in enumerate(diagram.order)}
        moved = {sum(1 << place["ABCDE"[i]] for i in range(5) if m >> i & 1): w for m, w in counts.items()}
        fresh = audit.Diagram(moved, "".join(diagram.order))
        assert list(diagram.steps()) == list(fresh.steps())
        assert [len(nodes) for nodes in diagram.nodes] == [len(nodes) for nodes in fresh.nodes]


def test_equal_subdiagrams_are_one_node():
    diagram = audit.Diagram(dict.fromkeys(range(32), (1, 0, 0)), "ABCDE")
    assert [len(nodes) for nodes in diagram.nodes] == [1] * 5


# One-bit search


def plain_nearest(rows, k, asks):
    usable = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dims = Counter(len(v) for _, v in usable)
    usual = min(dims, key=lambda d: (-dims[d], d)) if dims else 0
    usable = [(i, v) for i, v in usable if len(v) == usual]
    queries = {}
    for i, v in usable:
        if asks(i):
            queries[i] = min(v.tolist(), queries.get(i, v.tolist()))
    found = []
    for q, v in queries.items():
        scored = sorted((-float(np.cumsum(np.array(v) * w)[-1]), i) for i, w in usable if i != q)[:k]
        found += [(q, rank, i, -score) for rank, (score, i) in enumerate(scored, 1)]
    return sorted(found)


def vectors(rng, n, dims):
    rows = [(i, rng.standard_normal(dims).tolist()) for i in range(n)]
    # A third of all rows is a tight group; some rows are equal.
    centre = rng.standard_normal(dims) * 3
    rows += [(n + i, (centre + 0.01 * rng.standard_normal(dims)).tolist()) for i in range(n // 2)]
    rows += [(2 * n + i, centre.tolist()) for i in range(25)]
    return rows


def test_search_equals_all_products(spark):
    rows = vectors(np.random.default_rng(3), 300, 24)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, cell string").repartition(6)
    got = onebit.nearest(df, F.col("id") % 10 == 0, k=7, cells=4, sample=100, block=64, pack=8)
    assert sorted(map(tuple, got.collect())) == plain_nearest(rows, 7, lambda i: i % 10 == 0)


def test_search_of_unusable_repeated_and_short_rows(spark):
    good = [(i, [float(i), 1.0, -1.0]) for i in range(1, 6)]
    bad = [(20, None), (40, []), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 2.0]), (100, [float("nan"), 1.0, 1.0]), (120, [float("inf"), 1.0, 1.0])]
    bad += [(140, [1.0]), (None, [1.0, 2.0, 3.0])]
    twice = [(160, [2.0, 2.0, 2.0]), (160, [2.0, 2.0, 1.0]), (2, [2.0, 1.0, -1.0])]
    rows = good + bad + twice
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, onebit.nearest(df, F.col("id") % 20 == 0).collect()))
    assert got == plain_nearest(rows, 20, lambda i: i % 20 == 0)
    assert {g[0] for g in got} == {160} and len(got) == 6


def test_search_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert onebit.nearest(df, F.col("id") % 20 == 0).collect() == []
    nobody = spark.createDataFrame([(1, [1.0, 2.0])], df.schema)
    assert onebit.nearest(nobody, F.col("id") % 20 == 0).collect() == []


def test_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(8)
    model = onebit.fit(list(range(200)), rng.standard_normal((200, 40)).tolist(), 256, 1)
    rows, queries = rng.standard_normal((500, 40)), rng.standard_normal((50, 40))
    codes = onebit.encode(rows, model.centres[0], model.rotation)
    assert codes.signs.shape == (500, 32)
    guess, away = onebit.estimates(codes, model.centres[0], model.rotation, queries, onebit.CERTAINTY)
    error = guess - rows @ queries.T
    assert (np.abs(error) <= away).mean() > 0.9999
    # Unbiased, and bounds that choose.
    assert abs(error.mean()) < 0.05 * np.abs(rows @ queries.T).mean()
    assert away.mean() < 5 * (rows @ queries.T).std()


def test_a_vector_in_its_centre_is_estimated_exactly():
    centre = np.array([1.0, 2.0, 3.0, 4.0])
    turn = onebit.rotation(16, 4)
    codes = onebit.encode(np.array([centre]), centre, turn)
    guess, away = onebit.estimates(codes, centre, turn, np.array([[1.0, 0.0, 0.0, 1.0]]), 4.0)
    assert guess[0, 0] == pytest.approx(5) and away[0, 0] < 1e-3


# Spelling variants


def plain_words(rows, every):
    counts = Counter()
    letters = set(spelling.LETTERS)
    for key, text in rows:
        runs = [""]
        for c in text or "":
            if c in letters:
                runs[-1] += c.lower() if "A" <= c <= "Z" else c
            elif runs[-1]:
                runs.append("")
        for run in filter(None, runs):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(rows, every):
    words = plain_words(rows, every)
    near = defaultdict(list)
    for a, b in itertools.combinations(words, 2):
        if one_edit_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best
    found = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        found.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return Counter(found)


def variants(rng, word):
    letters = "abcdeéß÷"
    at = rng.randrange(len(word))
    return rng.choice([word, word, word, word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])


@pytest.mark.parametrize("chunk", [4, 4096])
def test_groups_equal_all_pairs(spark, chunk):
    rng = random.Random(6)
    stems = ["banana", "bananas", "cabana", "ananab", "strasse", "straßed", "éclairs", "abcdefgh", "hgfedcba", "zzzzzz"]
    rows = [(i, " ".join(variants(rng, rng.choice(stems)).upper() if rng.random() < 0.2 else variants(rng, rng.choice(stems)) for _ in range(60))) for i in range(120)]
    # One word holds a third of all runs, in a chain of forms; nulls, empty and repeated rows, other characters.
    rows += [(500 + i, "hotword " * 40 + "hotwird " * (i % 5) + "hotwirds ") for i in range(60)]
    rows += [(900, None), (901, ""), (None, "banana-banana_Bananas"), (None, None), rows[0], rows[0], (902, "naïveté ×÷×÷×÷ ÀÉÎÕÜŸ 漢字banana")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, word int").repartition(5)
    got = spelling.group_spellings(df, every=7, chunk=chunk)
    expected = plain_groups(rows, 7)
    assert Counter(map(tuple, got.collect())) == expected
    assert any(form and form != root for _, form, root, *_ in expected)


def test_no_words(spark):
    df = spark.createDataFrame([(1, "short one"), (2, None)], "doc_id bigint, text string")
    assert spelling.group_spellings(df).collect() == []
    assert spelling.group_spellings(df.limit(0)).collect() == []


def test_very_long_runs_are_words(spark):
    long = "ab" * 1500
    rows = [(i, f"{long} {long[:-1]} {long[:700]}c{long[701:]}") for i in range(6)] + [(9, long) for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, spelling.group_spellings(df, every=10**9).collect())) == plain_groups(rows, 10**9)


def test_pairs_of_letter_counts_and_edits():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcß") for _ in range(rng.choice([6, 7]))) for _ in range(400)})
    by_length = {n: [w for w in words if len(w) == n] for n in (6, 7)}
    packed = {n: spelling.Words("".join(ws).encode("latin-1"), list(range(len(ws)))) for n, ws in by_length.items()}
    for a, b in ((6, 6), (6, 7), (7, 7)):
        i, j = spelling.near_pairs(packed[a], packed[b])
        got = {(by_length[a][x], by_length[b][y]) for x, y in zip(i, j, strict=True)}
        assert got == {(x, y) for x in by_length[a] for y in by_length[b] if one_edit_apart(x, y)}


def test_every_pair_of_neighbour_blocks_is_one_step():
    steps = {tuple(s) for s in spelling.moves(4)}
    for a, b in itertools.product(itertools.product(range(3), repeat=4), repeat=2):
        difference = tuple(y - x for x, y in zip(a, b, strict=True))
        apart = sorted(d for d in difference if d)
        if a != b and apart in ([1], [-1], [-1, 1]):
            assert (difference in steps) != (tuple(-d for d in difference) in steps)
