"""Approximate nearest neighbours by largest inner product, with a robust-pruned directed graph for each shard.

A graph is built by inserting vectors in growing batches: a greedy beam search from the entry proposes neighbours, and
pruning with a relaxed distance (a candidate goes if a kept neighbour is ``ALPHA`` times nearer to it than the vector
itself) keeps few and diverse edges, in both directions. Inner products become distances by one more coordinate that
gives all vectors of a shard the same norm. A query runs the beam search in every shard; the shards' best are merged.

Equal vectors are one node of the graph. A node carries the smallest ids that have its vector, one more than the wanted
neighbours: no query can need more of them, which keeps results exact under any number of copies.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, as rows without
an id do; vectors of different lengths are never neighbours; ties go to the smaller id; other columns are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import col
from tripmart.sources.tables import stored

DEGREE, SLACK = 32, 48
BUILD_BEAM, QUERY_BEAM, WIDTH = 64, 128, 4
ALPHA = 1.2
#: A table up to ``SMALL`` vectors is one shard; a larger one has at least ``SHARDS``, of at most ``SHARD_ROWS``, about.
SMALL, SHARDS, SHARD_ROWS = 2000, 8, 50_000
#: Queries that search a shard together, about, and at once within one step.
QUERY_ROWS, STEP_ROWS = 4096, 256


def usable(vector: Column) -> Column:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


class Graph:
    """Vectors of one shard (row by row), edges (-1: none) and the entry."""

    def __init__(self, vectors: np.ndarray, seed: int = 1):
        self.vectors = vectors
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.points = np.hstack([vectors, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]]).astype(np.float32)
        self.top = np.float32(norms.max())
        self.edges = np.full((len(vectors), SLACK), -1, dtype=np.int32)
        self.entry = int(np.argmax(self.points @ self.points.mean(axis=0)))
        self._build(np.random.Generator(np.random.PCG64(seed)))

    def _build(self, random: np.random.Generator) -> None:
        order = random.permutation(len(self.points))
        order = np.concatenate([[self.entry], order[order != self.entry]])
        done = 1
        while done < len(order):
            some = order[done : done + max(1, min(STEP_ROWS, done // 4))]
            found, _ = self.search(self.points[some], BUILD_BEAM)
            kept = self.prune(some, found)
            self.edges[some, :DEGREE] = kept
            self._link_back(some, kept)
            done += len(some)

    def _link_back(self, sources: np.ndarray, kept: np.ndarray) -> None:
        """Adds the reverse of new edges; nodes that run full are pruned."""
        rows, _ = np.nonzero(kept >= 0)
        to, new = kept[kept >= 0], sources[rows]
        order = np.argsort(to, kind="stable")
        to, new = to[order], new[order]
        nodes, first, many = np.unique(to, return_index=True, return_counts=True)
        used = (self.edges[nodes] >= 0).sum(axis=1)
        fits = used + many <= SLACK
        place = np.arange(len(to)) - np.repeat(first, many) + np.repeat(used, many)
        fine = np.repeat(fits, many)
        self.edges[to[fine], place[fine]] = new[fine]
        if fits.all():
            return
        full = nodes[~fits]
        width = SLACK + int(many[~fits].max())
        candidates = np.full((len(full), width), -1, dtype=np.int32)
        candidates[:, :SLACK] = self.edges[full]
        row = np.repeat(np.cumsum(~fits) - 1, many)
        at = np.arange(len(to)) - np.repeat(first, many) + SLACK
        candidates[row[~fine], at[~fine]] = new[~fine]
        for k in range(0, len(full), STEP_ROWS):
            some = full[k : k + STEP_ROWS]
            pruned = self.prune(some, candidates[k : k + STEP_ROWS])
            self.edges[some] = -1
            self.edges[some, :DEGREE] = pruned

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """At most ``DEGREE`` diverse candidates for each node, nearest first."""
        missing = (candidates < 0) | (candidates == nodes[:, None])
        held = self.points[np.maximum(candidates, 0)]
        own = self.top - np.einsum("ncd,nd->nc", held, self.points[nodes])
        own = np.where(missing, np.inf, np.maximum(own, 0))
        order = np.argsort(own, axis=1, kind="stable")[:, : BUILD_BEAM + DEGREE]
        candidates, own = np.take_along_axis(candidates, order, 1), np.take_along_axis(own, order, 1)
        held = np.take_along_axis(held, order[:, :, None], 1)
        between = np.maximum(self.top - held @ held.transpose(0, 2, 1), 0)
        result = np.full((len(nodes), DEGREE), -1, dtype=np.int32)
        open_ = np.isfinite(own)
        row = np.arange(len(nodes))
        for k in range(DEGREE):
            going = open_.any(axis=1)
            if not going.any():
                break
            best = open_.argmax(axis=1)
            result[going, k] = candidates[row, best][going]
            # Half squared distances, hence the square of the factor.
            open_ &= between[row, best] * (ALPHA * ALPHA) > own
            open_[row, best] = False
        return result

    def search(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes found for each point, best first, and their inner products (-1 and -inf: none)."""
        q = len(points)
        ids = np.full((q, beam), -1, dtype=np.int32)
        near = np.full((q, beam), -np.inf, dtype=np.float32)
        todo = np.zeros((q, beam), dtype=bool)
        seen = np.zeros((q, len(self.points)), dtype=bool)
        ids[:, 0], near[:, 0], todo[:, 0] = self.entry, points @ self.points[self.entry], True
        seen[:, self.entry] = True
        live = np.arange(q)
        while len(live):
            open_ = todo[live]
            rank = np.cumsum(open_, axis=1)
            chosen = open_ & (rank <= WIDTH)
            left = chosen.any(axis=1)
            live, chosen = live[left], chosen[left]
            if not len(live):
                break
            todo[live] &= ~chosen
            where, at = np.nonzero(chosen)
            slot = rank[left][where, at] - 1
            nodes = np.full((len(live), WIDTH), -1, dtype=np.int32)
            nodes[where, slot] = ids[live[where], at]
            next_ = np.where(nodes[:, :, None] >= 0, self.edges[nodes], -1).reshape(len(live), -1)
            next_.sort(axis=1)
            good = next_ >= 0
            good[:, 1:] &= next_[:, 1:] != next_[:, :-1]
            good &= ~seen[live[:, None], np.maximum(next_, 0)]
            where, at = np.nonzero(good)
            fresh = next_[where, at]
            seen[live[where], fresh] = True
            product = np.full(next_.shape, -np.inf, dtype=np.float32)
            product[where, at] = np.einsum("ij,ij->i", self.points[fresh], points[live[where]])
            next_ = np.where(good, next_, -1)
            both = np.concatenate([near[live], product], axis=1)
            order = np.argsort(-both, axis=1, kind="stable")[:, :beam]
            near[live] = np.take_along_axis(both, order, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], next_], axis=1), order, 1)
            fresh_flags = np.concatenate([todo[live], good], axis=1)
            todo[live] = np.take_along_axis(fresh_flags, order, 1)
        return ids, near

    def to_bytes(self) -> bytes:
        head = np.array([*self.vectors.shape, self.entry], dtype=np.int64)
        return head.tobytes() + self.vectors.tobytes() + self.edges.tobytes()

    @classmethod
    def of_bytes(cls, data: bytes) -> Graph:
        graph = cls.__new__(cls)
        n, d, graph.entry = np.frombuffer(data, dtype=np.int64, count=3).tolist()
        graph.vectors = np.frombuffer(data, dtype=np.float64, count=n * d, offset=24).reshape(n, d)
        graph.edges = np.frombuffer(data, dtype=np.int32, offset=24 + 8 * n * d).reshape(n, SLACK)
        # The further coordinate is 0 for queries and plays no part in a search.
        graph.points = np.hstack([graph.vectors, np.zeros((n, 1))]).astype(np.float32)
        return graph


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: the vector and its ``keep`` smallest ids.

    Each task cuts its rows to the ``keep`` smallest ids of a vector before they are shuffled.
    """
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = vectors.withColumn("rank", rank).filter(F.col("rank") <= keep)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def build(distinct: DataFrame, shards: int) -> DataFrame:
    """The index: a row per shard and vector length, with the graph and the ids of its nodes."""

    def graph(rows: pd.DataFrame) -> pd.DataFrame:
        ids = [np.asarray(i, dtype=np.int64) for i in rows["ids"]]
        order = np.argsort([i[0] for i in ids])
        held = Graph(np.stack(rows["vector"].to_numpy()[order]).astype(np.float64))
        bounds = np.concatenate([[0], np.cumsum([len(ids[k]) for k in order])]).astype(np.int64)
        return pd.DataFrame(
            {
                "size": [int(rows["size"].iloc[0])],
                "shard": [int(rows["shard"].iloc[0])],
                "graph": [held.to_bytes()],
                "ids": [np.concatenate([ids[k] for k in order]).tobytes()],
                "bounds": [bounds.tobytes()],
            }
        )

    dealt = distinct.withColumn("size", F.size("vector")).withColumn(
        "shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int")
    )
    return dealt.groupBy("size", "shard").applyInPandas(
        graph, "size int, shard int, graph binary, ids binary, bounds binary"
    )


def _best(graph: Graph, ids: np.ndarray, bounds: np.ndarray, queries: np.ndarray, wanted: int) -> Iterator[tuple]:
    """For each query the ids and scores of its best nodes, until there are ``wanted`` ids."""
    found, _ = graph.search(np.hstack([queries, np.zeros((len(queries), 1))]).astype(np.float32), QUERY_BEAM)
    scores = np.einsum("qkd,qd->qk", graph.vectors[np.maximum(found, 0)], queries)
    scores = np.where(found >= 0, scores, -np.inf)
    order = np.lexsort((found, -scores), axis=1)[:, :wanted]
    for nodes, near in zip(np.take_along_axis(found, order, 1), np.take_along_axis(scores, order, 1), strict=True):
        held = nodes >= 0
        nodes, near = nodes[held], near[held]
        many = bounds[nodes + 1] - bounds[nodes]
        yield np.concatenate([ids[bounds[n] : bounds[n + 1]] for n in nodes]), np.repeat(near, many)


def search(index: DataFrame, queries: DataFrame, shards: int, wanted: int, blocks: int) -> DataFrame:
    """(query, vec_id, score) for the best of each shard. ``queries`` has query and vector.

    Every block of queries meets every shard once; a task holds one shard and one block.
    """

    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or block.empty:
            return pd.DataFrame({"query": [], "vec_id": [], "score": []})
        row = shard.iloc[0]
        graph = Graph.of_bytes(row["graph"])
        ids, bounds = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "bounds"))
        numbers, vectors = block["query"].to_numpy(), np.stack(block["vector"].to_numpy()).astype(np.float64)
        parts = []
        for k in range(0, len(numbers), STEP_ROWS):
            some = numbers[k : k + STEP_ROWS]
            for query, (near, score) in zip(
                some, _best(graph, ids, bounds, vectors[k : k + STEP_ROWS], wanted), strict=True
            ):
                # Copies of a vector have one score; of those at the end only the smallest ids are needed.
                order = np.lexsort((near, -score))[:wanted]
                parts.append((np.full(len(order), query), near[order], score[order]))
        query, near, score = (np.concatenate(p) for p in zip(*parts, strict=True))
        return pd.DataFrame({"query": query, "vec_id": near, "score": score})

    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("size", F.size("vector")).withColumn(
        "block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    )
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ("size", "shard", "block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        run, "query long, vec_id long, score double"
    )


def neighbours(
    table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query row, its own row left out.

    ``is_query`` is a condition on ``vec_id``. Queries with equal vectors are searched once.
    """
    rows = table.select(
        col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("vector")
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    distinct = stored(distinct_vectors(rows, k + 1), "ann-vectors")
    many = distinct.count()
    shards = 1 if many <= SMALL else max(SHARDS, math.ceil(many / SHARD_ROWS))
    index = stored(build(distinct, shards), "ann-index")
    asked = rows.filter(is_query)
    queries = stored(asked.groupBy("vector").agg(F.min("vec_id").alias("query")), "ann-queries")
    blocks = max(1, math.ceil(queries.count() / QUERY_ROWS))
    found = search(index, queries, shards, k + 1, blocks)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    lists = found.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near")
    )
    answers = queries.join(lists, "query").select("vector", "near")
    each = asked.select(F.col("vec_id").alias("query_id"), "vector").distinct().join(answers, "vector")
    own = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    ranked = each.select("query_id", F.posexplode(F.slice(own, 1, k)).alias("place", "hit"))
    return ranked.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )
