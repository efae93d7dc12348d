"""Exact top-k search by integer inner product over an impact-ordered index, processed a level at a time.

Components become whole numbers, ``floor(scale * x)``. The vectors are dealt evenly over shards. A shard's index holds, in
place of vectors, posting segments: all vectors whose component in one dimension has one quantised impact, which is the
number of binary digits of its size. Segments of a shard are stored by descending impact and processed so: for a step of
queries all segments of one level are added to the scores together. After a level, what a vector has left is known by its
length, so each score lies within ``|query| * |rest|`` of what was added up so far. A query's possible members are the
vectors that can still reach the score that ``k + 1`` vectors surely have. Processing stops as soon as few enough pairs are
left, or with the last level, when nothing is uncertain; only possible members are rescored, exactly. So a stop never costs
a result, whatever the data are like.

Queries meet the shards in packed chunks of ``CHUNK`` queries: a pair of shard and chunk is one row and one unit of work,
and no pair needs another. Equal vectors of a shard are one entry with the ids that can matter.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, as rows without an id do; a
shorter vector counts as if zeros followed, so an empty one has score 0 with all; rows equal in id and vector are one row;
a query is no candidate of its own, but a row of the same id and another vector is; ties go to the smaller id; a component
whose whole number needs more than ``DIGITS`` binary digits is an error; no rows or no queries give no rows; other columns
are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.blocks import arrow_rows
from tripmart.llm.common import col
from tripmart.llm.packing import packed, unpacked
from tripmart.sources.tables import stored

#: Vectors of a shard, at least (for few tasks on small tables) and at most.
LEAST_ROWS, SHARD_ROWS = 2048, 16_384
#: Queries in a chunk, and how many are scored at once.
CHUNK, STEP = 1024, 64
#: Pairs for each wanted neighbour at which rescoring is cheaper than another level.
PAIRS = 4
#: Sums of products of so many digits stay exact as doubles for 8,192 dimensions.
DIGITS = 20
SCALE = 64
_PAIR_ROWS = 1 << 14


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(True))


def whole(vector: Column, scale: int) -> Column:
    """Components as whole numbers."""
    digits = F.transform(vector, lambda x: F.floor(x * scale).cast("double"))
    return F.transform(
        digits,
        lambda x: F.when(F.abs(x) < 1 << DIGITS, x.cast("int")).otherwise(
            F.raise_error(F.lit(f"a component needs more than {DIGITS} digits")).cast("int")
        ),
    )


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
    return out


class Shard:
    """Posting segments by descending impact: (level, dimension) -> entries and their components."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, size: int, dims: int, segments: np.ndarray, entries: np.ndarray, values: np.ndarray):
        self.ids, self.bounds, self.size, self.dims = ids, bounds, size, dims
        # A segment is its level, its dimension and where it ends in entries and values.
        self.segments, self.entries, self.values = segments.reshape(-1, 3), entries, values

    @staticmethod
    def of(ids: np.ndarray, vectors: np.ndarray, k: int) -> Shard:
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        other = np.ones(len(ids), dtype=bool)
        other[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        again = ~other & np.concatenate([[False], ids[1:] == ids[:-1]])
        ids, other, vectors = ids[~again], other[~again], vectors[~again]
        first = np.flatnonzero(other)
        place = np.arange(len(ids)) - np.repeat(first, np.diff(first, append=len(ids)))
        # Of equal vectors only k + 1 can be among the best of a query, which is perhaps one of them itself.
        needed = place <= k
        ids, bounds = ids[needed], np.append(np.flatnonzero(other[needed]), needed.sum())
        vectors = vectors[first]
        entry, dim = np.nonzero(vectors)
        value = vectors[entry, dim]
        level = np.frexp(np.abs(value))[1].astype(np.int64)
        by_impact = np.lexsort((entry, dim, -level))
        entry, dim, value, level = entry[by_impact], dim[by_impact], value[by_impact], level[by_impact]
        ends = np.append(np.flatnonzero(np.diff(level * vectors.shape[1] + dim)) + 1, len(level)) if len(level) else level
        segments = np.stack([level[ends - 1], dim[ends - 1], ends], axis=1) if len(level) else np.zeros((0, 3), dtype=np.int64)
        return Shard(ids, bounds, len(vectors), vectors.shape[1], segments, entry.astype(np.int32), value.astype(np.int32))

    def parts(self) -> list[bytes]:
        head = np.array([self.size, self.dims], dtype=np.int64)
        return [packed(a) for a in (self.ids, self.bounds, head, self.segments.reshape(-1), self.entries, self.values)]

    @staticmethod
    def of_parts(parts: list[bytes]) -> Shard:
        ids, bounds, head, segments, entries, values = (unpacked(p) for p in parts)
        return Shard(ids, bounds, int(head[0]), int(head[1]), segments, entries, values)

    def levels(self, dims: int) -> Iterator[np.ndarray]:
        """The segments of one level after the other, as a slab of entries by dimensions with zeros elsewhere."""
        start = 0
        for level in np.unique(self.segments[:, 0])[::-1]:
            slab = np.zeros((self.size, dims))
            for _, dim, end in self.segments[self.segments[:, 0] == level].tolist():
                slab[self.entries[start:end], dim] = self.values[start:end]
                start = end
            yield slab

    def vectors(self, dims: int) -> np.ndarray:
        out = np.zeros((self.size, dims), dtype=np.int64)
        starts = np.concatenate([[0], self.segments[:-1, 2]])
        out[self.entries, np.repeat(self.segments[:, 1], self.segments[:, 2] - starts)] = self.values
        return out


class Searcher:
    """Finds, for steps of queries, the best entries of a shard."""

    def __init__(self, shard: Shard, dims: int, k: int):
        self.shard, self.k, self.dims = shard, k, max(dims, shard.dims)
        self.vectors = shard.vectors(self.dims)
        self.slabs = list(shard.levels(self.dims))
        rest, self.rests = np.zeros(shard.size), []
        for slab in self.slabs[::-1]:
            self.rests.append(np.sqrt(rest))
            rest = rest + np.einsum("ij,ij->i", slab, slab)
        self.rests.reverse()
        self.levels_used = 0

    def possible(self, queries: np.ndarray) -> np.ndarray:
        """Which entries (columns) can be among the ``k + 1`` best of each query (row)."""
        wanted = self.k + 1
        possible = np.ones((len(queries), self.shard.size), dtype=bool)
        if self.shard.size <= wanted:
            return possible
        scores = np.zeros(possible.shape)
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        for slab, rest in zip(self.slabs, self.rests, strict=True):
            scores += queries @ slab.T
            # The bound is a rounded number, the scores are whole; half of one is far more than any rounding here.
            reach = lengths * rest * (1 + 1e-9) + 0.5 * (rest > 0)
            sure = np.partition(scores - reach, -wanted, axis=1)[:, [-wanted]]
            possible = scores + reach >= sure
            self.levels_used += 1
            if possible.sum() <= PAIRS * wanted * len(queries):
                break
        return possible

    def best(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's row, id, score) of all ids that can be among the best, exactly scored."""
        row, entry = np.nonzero(self.possible(queries.astype(np.float64)))
        score = np.concatenate(
            [
                np.einsum("ij,ij->i", queries[row[a : a + _PAIR_ROWS]], self.vectors[entry[a : a + _PAIR_ROWS]])
                for a in range(0, max(1, len(row)), _PAIR_ROWS)
            ]
        )
        order = np.lexsort((entry, -score, row))
        row, entry, score = row[order], entry[order], score[order]
        # Entries that k + 1 others surpass are out; equal ones are told apart by their ids.
        last = np.minimum(np.searchsorted(row, row) + self.k, np.searchsorted(row, row, "right") - 1)
        kept = score >= score[last]
        row, entry, score = row[kept], entry[kept], score[kept]
        bounds = self.shard.bounds
        many = bounds[entry + 1] - bounds[entry]
        at = np.repeat(bounds[entry] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.repeat(row, many), self.shard.ids[at], np.repeat(score, many), np.repeat(entry, many)


_INDEX = ("ids", "bounds", "head", "segments", "entries", "values")


def build(rows: DataFrame, shards: int, k: int) -> DataFrame:
    """The index: one row per shard. ``rows`` has vec_id and vector (whole numbers), dealt evenly whatever they hold."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        vectors = matrix(table.column("vector").combine_chunks())
        parts = Shard.of(table.column("vec_id").to_numpy(), vectors, k).parts()
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], list(_INDEX))

    made = rows.repartition(shards).mapInArrow(index, ", ".join(f"{name} binary" for name in _INDEX))
    return made.withColumn("shard", F.spark_partition_id())


def chunks(queries: DataFrame, many: int) -> DataFrame:
    """Queries in rows of about ``CHUNK``: their ids and whole vectors, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                some = batch.slice(start, CHUNK)
                vectors = matrix(some.column("vector"))
                columns = [packed(some.column("vec_id").to_numpy()), packed(vectors.reshape(-1))]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([c], pa.binary()) for c in columns], pa.array([vectors.shape[1]], pa.int32())],
                    ["queries", "wanted", "dims"],
                )

    return queries.repartition(many).mapInArrow(pack, "queries binary, wanted binary, dims int")


def _search(pairs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in range(batch.num_rows):
                held = {name: batch.column(name)[pair].as_py() for name in (*_INDEX, "chunk", "queries", "wanted", "dims")}
                numbers, dims = unpacked(held["queries"]), held["dims"]
                vectors = unpacked(held["wanted"]).reshape(len(numbers), dims).astype(np.int64)
                searcher = Searcher(Shard.of_parts([held[name] for name in _INDEX]), dims, k)
                if searcher.dims > dims:
                    vectors = np.pad(vectors, ((0, 0), (0, searcher.dims - dims)))
                for start in range(0, len(numbers), STEP):
                    some = vectors[start : start + STEP]
                    row, ids, score, entry = searcher.best(some)
                    # The query itself: the same id and the same vector.
                    itself = (ids == numbers[start + row]) & (searcher.vectors[entry] == some[row]).all(axis=1)
                    row, ids, score = row[~itself], ids[~itself], score[~itself]
                    order = np.lexsort((ids, -score, row))
                    row, ids, score = row[order], ids[order], score[order]
                    top = np.arange(len(row)) - np.searchsorted(row, row) < k
                    # A query is told from another of the same id by its chunk and its place there.
                    place = start + row[top]
                    columns = [np.full(len(place), held["chunk"]), place, numbers[place], ids[top], score[top]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["chunk", "place", "query_id", "vec_id", "score"]
    return pairs.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of each query row by exact integer inner product.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = table.sparkSession
    rows = table.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("vector", whole(F.col("vector"), scale))
    rows = stored(rows.distinct(), "impact-rows")
    asked = rows.filter(is_query)
    many, queries = rows.count(), asked.count()
    tasks = spark.sparkContext.defaultParallelism
    shard_rows = min(SHARD_ROWS, max(LEAST_ROWS, math.ceil(many / (2 * tasks))))
    shards = max(1, math.ceil(many / shard_rows))
    index = stored(build(rows, shards, k), "impact-index")
    packs = chunks(asked, max(1, math.ceil(queries / CHUNK)))
    packs = stored(packs.withColumn("chunk", F.monotonically_increasing_id()), "impact-queries")
    dealt = packs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(shards, "shard")
    pairs = dealt.join(index, "shard")
    with arrow_rows(spark, 1):
        found = stored(_search(pairs, k), "impact-found")
    order = Window.partitionBy("chunk", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
