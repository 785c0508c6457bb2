"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector lies in a cell, around one of a few centres. Its residual from the centre is padded with zeros, turned by
one random rotation, and stored as the signs of its components, packed to bits. Two scalars correct the code: the
residual's length, and the inner product of its direction with its code. From them and the bits comes an unbiased
estimate of the inner product with any query, with an error bound that holds but for a chance set by ``certainty``.
Only vectors whose estimate plus bound reaches the query's floor are looked up and ranked by exact products.

The floor is the ``k``-th best exact product met so far: at first among a bounded sample, then among the vectors of the
block at hand. A cell that cannot reach the floor, by its centre and radius, is not visited by that query.

The index is fitted (centres, rotation, sample) on at most ``sample`` rows, those of the smallest hashes; it holds every
row. Blocks of at most ``block`` vectors of one cell are dealt by range of (cell, hash), so a cell, or a group of copies,
that holds a third of all rows is many blocks. Queries travel in packs to the blocks of their cells; a task holds one
block, and one pack at a time, and gives at most ``k`` rows per query and block. Queries times rows are compared, in bits,
as long as the cells do not part them: on vectors without clusters no index does.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
without an id, nor vectors of another length than most (of equally frequent lengths, the least). Rows with the query's
id are its own. An id with several vectors asks with the smallest of them; each of its rows is a candidate. Ties go to
the smaller id; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources import work_folder

NEIGHBOURS = 20
BITS = 256
CELLS = 16
SAMPLE = 4096
BLOCK = 16384
PACK = 256
# Rows of a block that are estimated at once, and pairs that are ranked at once.
ROWS_AT_ONCE = 2048
PAIRS_AT_ONCE = 1 << 15
# Standard deviations that the error bound spans.
CERTAINTY = 4.0
SEED = 12
REFINEMENTS = 8


# Products


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, components added from the first to the last."""
    return np.cumsum(a.astype(np.float64) * b, axis=1)[:, -1]


def rotation(bits: int, dims: int) -> np.ndarray:
    """The first ``dims`` rows of a random rotation of ``bits`` dimensions, the same in every worker."""
    normal = np.random.default_rng(SEED).standard_normal((bits, bits))
    turned, triangle = np.linalg.qr(normal)
    return (turned * np.sign(np.diag(triangle)))[:dims]


class Model(NamedTuple):
    """What is fitted on the sample, and the sample itself."""

    centres: np.ndarray
    rotation: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray


def nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (vectors @ centres.T - (centres**2).sum(1) / 2).argmax(1)


def fit(ids: list[int], rows: list[list[float]], bits: int, cells: int) -> Model:
    """Centres by a few rounds of Lloyd's refinement, starting from rows spread over the sample."""
    vectors = np.array(rows, np.float64)
    centres = vectors[np.linspace(0, len(vectors) - 1, min(cells, len(vectors))).astype(int)].copy()
    for _ in range(REFINEMENTS):
        cell = nearest_centre(vectors, centres)
        for c in range(len(centres)):
            if (cell == c).any():
                centres[c] = vectors[cell == c].mean(0)
    dims = vectors.shape[1]
    return Model(centres, rotation(max(bits, -(-dims // 8) * 8), dims), np.array(ids, np.int64), vectors)


class Codes(NamedTuple):
    """One-bit codes of a block: packed signs, residual lengths, inner products of direction and code."""

    signs: np.ndarray
    lengths: np.ndarray
    aligned: np.ndarray


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> Codes:
    residuals = (vectors.astype(np.float64) - centre) @ turn
    lengths = np.linalg.norm(residuals, axis=1)
    total = np.abs(residuals).sum(1) / np.sqrt(turn.shape[1])
    # A vector in its centre has no direction; its estimate is exact.
    aligned = np.divide(total, lengths, out=np.ones(len(lengths)), where=lengths > 0)
    return Codes(np.packbits(residuals > 0, axis=1), lengths.astype(np.float32), aligned.astype(np.float32))


def estimates(codes: Codes, centre: np.ndarray, turn: np.ndarray, queries: np.ndarray, certainty: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (row per code, column per query) and their error bounds."""
    bits = turn.shape[1]
    signs = np.unpackbits(codes.signs, axis=1, count=bits).astype(np.float32)
    signs *= 2
    signs -= 1
    scale = codes.lengths / (codes.aligned * np.float32(np.sqrt(bits)))
    found = signs @ (queries @ turn).T.astype(np.float32)
    found *= scale[:, None]
    found += (queries @ centre).astype(np.float32)
    spread = np.sqrt(np.maximum(1 - codes.aligned.astype(np.float64) ** 2, 0)) / codes.aligned / np.sqrt(max(bits - 1, 1))
    size = np.linalg.norm(queries, axis=1)
    # The last term covers rounding.
    away = certainty * spread * codes.lengths + 1e-5 * (codes.lengths + np.linalg.norm(centre))
    return found, away[:, None].astype(np.float32) * size.astype(np.float32)


# Searching a block


class Found(NamedTuple):
    query: np.ndarray
    id: np.ndarray
    score: np.ndarray


def best(found: Found, k: int) -> Found:
    """The ``k`` best of each query, by score and then smaller id."""
    order = np.lexsort((found.id, -found.score, found.query))
    query = found.query[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    kept = order[rank < k]
    return Found(found.query[kept], found.id[kept], found.score[kept])


def raised(floors: np.ndarray, found: Found, k: int) -> np.ndarray:
    """Floors after the ``k``-th best of those queries that have as many."""
    counts = np.bincount(found.query, minlength=len(floors))
    ends = np.cumsum(counts)
    full = counts >= k
    lifted = floors.copy()
    lifted[full] = np.maximum(floors[full], found.score[ends[full] - counts[full] + k - 1])
    return lifted


def ranked(
    own: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, vectors: np.ndarray, at: np.ndarray, by: np.ndarray
) -> Found:
    """Exact products of chosen pairs (row ``at``, query ``by``) that reach the floor."""
    parts = []
    for begin in range(0, len(at), PAIRS_AT_ONCE):
        i, j = at[begin : begin + PAIRS_AT_ONCE], by[begin : begin + PAIRS_AT_ONCE]
        score = products(vectors[i], queries[j])
        good = (score >= floors[j]) & (ids[i] != own[j])
        parts.append(Found(j[good], ids[i[good]], score[good]))
    if not parts:
        return Found(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return Found(*map(np.concatenate, zip(*parts, strict=True)))


def sample_floors(model: Model, own: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th best product of each query among the sample, which the ``k``-th best of all rows reaches."""
    floors = np.full(len(own), -np.inf)
    if len(model.ids) > k:
        for q in range(len(own)):
            scores = products(model.vectors, queries[q])[model.ids != own[q]]
            if len(scores) >= k:
                floors[q] = np.partition(scores, len(scores) - k)[len(scores) - k]
    return floors


class Block(NamedTuple):
    ids: np.ndarray
    vectors: np.ndarray
    cell: int
    codes: Codes


def search(block: Block, model: Model, own: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int, certainty: float) -> Found:
    """The best of a block for a pack of queries: estimate from bits, choose by error bound, rank exactly."""
    found = Found(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    centre = model.centres[block.cell]
    for begin in range(0, len(block.ids), ROWS_AT_ONCE):
        part = slice(begin, begin + ROWS_AT_ONCE)
        guess, away = estimates(Codes(*(c[part] for c in block.codes)), centre, model.rotation, queries, certainty)
        at, by = np.nonzero(guess + away >= floors)
        new = ranked(own, queries, floors, block.ids, block.vectors, at + begin, by)
        found = best(Found(*map(np.concatenate, zip(found, new, strict=True))), k)
        floors = raised(floors, found, k)
    return found


# Tables


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)`` of the rows that take part, of whatever length."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & some
    )


def in_cells(rows: DataFrame, model: Model, kind: str) -> DataFrame:
    """Add the ``cell`` of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = nearest_centre(matrix(batch.column(1)), model.centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], ["id", "v", "cell"])

    return rows.mapInArrow(run, f"id bigint, v {kind}, cell int")


def matrix(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


INDEX = "cell int, radius double, ids binary, vectors binary, signs binary, lengths binary, aligned binary"


def index_blocks(rows: DataFrame, model: Model, kind: str, block: int) -> DataFrame:
    """The index: packed vectors of one cell with their codes, at most ``block`` of them a row."""
    number = np.float32 if "float" in kind else np.float64

    def packed(table: pa.Table) -> pa.RecordBatch:
        cell = table["cell"][0].as_py()
        vectors = matrix(table["v"].combine_chunks()).astype(number)
        codes = encode(vectors, model.centres[cell], model.rotation)
        ids = table["id"].to_numpy().astype(np.int64)
        binary = [[a.tobytes()] for a in (ids, vectors, *codes)]
        return pa.RecordBatch.from_arrays(
            [pa.array([cell], pa.int32()), pa.array([float(codes.lengths.max())]), *(pa.array(b, pa.binary()) for b in binary)],
            ["cell", "radius", "ids", "vectors", "signs", "lengths", "aligned"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in one_cell_at_a_time(batches, block):
            yield packed(table)

    placed = in_cells(rows, model, kind).repartitionByRange("cell", F.xxhash64("id"), "id").sortWithinPartitions("cell")
    return placed.mapInArrow(run, INDEX)


def one_cell_at_a_time(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows of one cell each, at most ``most``, from rows sorted by cell."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        cells = batch.column(batch.schema.get_field_index("cell")).to_numpy()
        starts = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist()] if len(cells) else []
        for begin, end in zip(starts, [*starts[1:], len(cells)], strict=False):
            if held and held[-1]["cell"][0].as_py() != int(cells[begin]):
                yield pa.Table.from_batches(held)
                held, n = [], 0
            while begin < end:
                piece = batch.slice(begin, min(end - begin, most - n))
                held.append(piece)
                n += len(piece)
                begin += len(piece)
                if n == most:
                    yield pa.Table.from_batches(held)
                    held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def query_packs(queries: DataFrame, model: Model, radii: dict[int, float], k: int, pack: int) -> DataFrame:
    """Packs of queries with their floors, one row for each cell that any of them may find something in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), pack):
                part = batch.slice(begin, pack)
                own = part.column(0).to_numpy()
                vectors = matrix(part.column(1)).astype(np.float64)
                floors = sample_floors(model, own, vectors, k)
                size = np.linalg.norm(vectors, axis=1)
                for cell, radius in radii.items():
                    reach = vectors @ model.centres[cell] + size * radius * (1 + 1e-6) + 1e-9
                    asks = reach >= floors
                    if asks.any():
                        packed = [[a[asks].tobytes()] for a in (own, vectors, floors)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([cell], pa.int32()), *(pa.array(b, pa.binary()) for b in packed)],
                            ["cell", "ids", "vectors", "floors"],
                        )

    return queries.mapInArrow(run, "cell int, ids binary, vectors binary, floors binary")


FOUND = "query_id bigint, vec_id bigint, score double"


def search_blocks(meetings: DataFrame, model: Model, kind: str, k: int, certainty: float) -> DataFrame:
    """``(query_id, vec_id, score)``: the best of each block, whose row comes before its packs of queries."""
    number = np.float32 if "float" in kind else np.float64
    dims, bits = model.rotation.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block | None = None
        for batch in batches:
            for row in range(len(batch)):
                cell, ids, vectors, floors, signs, lengths, aligned = (c[row].as_py() for c in batch.columns)
                own = np.frombuffer(ids, np.int64)
                if floors is None:
                    codes = Codes(
                        np.frombuffer(signs, np.uint8).reshape(len(own), -1),
                        np.frombuffer(lengths, np.float32),
                        np.frombuffer(aligned, np.float32),
                    )
                    block = Block(own, np.frombuffer(vectors, number).reshape(-1, dims), cell, codes)
                    continue
                queries = np.frombuffer(vectors, np.float64).reshape(-1, dims)
                found = search(block, model, own, queries, np.frombuffer(floors), k, certainty)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[found.query]), pa.array(found.id), pa.array(found.score)], ["query_id", "vec_id", "score"]
                )

    return meetings.mapInArrow(run, FOUND)


def nearest(
    rows: DataFrame,
    asks: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
    bits: int = BITS,
    cells: int = CELLS,
    sample: int = SAMPLE,
    block: int = BLOCK,
    pack: int = PACK,
    certainty: float = CERTAINTY,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for every row that ``asks`` holds for.

    ``asks`` is a condition on the ``id``.
    """
    spark = rows.sparkSession
    taking = usable(rows, key, vector)
    kind = taking.schema["v"].dataType.simpleString()
    lengths = taking.groupBy(F.size("v").alias("dims")).count()
    usual = lengths.orderBy(F.desc("count"), "dims").first()
    if usual is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    taking = taking.where(F.size("v") == usual.dims)

    chosen = taking.orderBy(F.xxhash64("id"), "id", "v").limit(sample).collect()
    model = fit([r.id for r in chosen], [r.v for r in chosen], bits, cells)

    folder = work_folder(spark, "onebit")
    numbered = index_blocks(taking, model, kind, block).withColumn("block", F.monotonically_increasing_id())
    numbered.write.option("compression", "uncompressed").parquet(folder)
    index = spark.read.parquet(folder)
    radii = {r.cell: r.radius for r in index.groupBy("cell").agg(F.max("radius").alias("radius")).collect()}

    queries = taking.where(asks).groupBy("id").agg(F.min("v").alias("v"))
    packs = query_packs(queries, model, radii, k, pack).join(index.select("cell", "block"), "cell")
    columns = ["block", "cell", "ids", "vectors", "floors", "signs", "lengths", "aligned"]
    nothing = F.lit(None).cast("binary")
    both = index.withColumn("floors", nothing).select(*columns).union(
        packs.withColumns(dict.fromkeys(("signs", "lengths", "aligned"), nothing)).select(*columns)
    )
    meetings = both.repartition("block").sortWithinPartitions("block", F.col("floors").isNotNull())
    found = search_blocks(meetings.drop("block"), model, kind, k, certainty)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    placed = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return placed.select("query_id", "rank", "vec_id", "score")
