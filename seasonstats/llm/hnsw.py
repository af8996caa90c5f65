"""Nearest vectors by a hierarchical navigable small-world graph per shard.

Equal vectors are one point. Points are dealt into shards; each shard's task builds its graph, layer by layer, from the
blocked products of the layer's points, and keeps for each point near neighbours in different directions as flat arrays.
The queries walk all shards' graphs, many at a time, and the shards' results are merged. Scores are computed again in
double precision from the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstats.sources.shared import materialize

EVERY, NEAREST = 50, 5
SHARD_POINTS = 8192
LINKS, BEAM, CANDIDATES = 16, 128, 48
QUERY_BLOCK = 2048
LAYER_RATIO = 16  # a layer has about one in so many points of the layer below


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # no overflow of the squares
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _spread(points: np.ndarray, near: np.ndarray, sims: np.ndarray, links: int) -> np.ndarray:
    """Of each point's ``near`` (nearest first), those closer to it than to one already kept, then the nearest left."""
    n, k = near.shape
    kept = np.zeros((n, k), bool)
    if k:
        among = np.einsum("nkd,njd->nkj", points[near], points[near], optimize=True)
        for i in range(k):
            blocked = (kept & (among[:, i, :] > sims[:, i, None])).any(axis=1)
            kept[:, i] = ~blocked & (kept.sum(axis=1) < links)
    order = np.argsort(~kept, axis=1, kind="stable")[:, :links]
    return np.take_along_axis(near, order, axis=1)


def _layer(points: np.ndarray, members: np.ndarray, links: int, candidates: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the layer's ``members`` as (starts, targets), each way."""
    own = points[members]
    n, k = len(members), min(candidates, len(members) - 1)
    chosen = np.zeros((n, 0), np.int64)
    if k > 0:
        parts = []
        for a in range(0, n, 256):
            block = own[a : a + 256]
            sims = block @ own.T
            sims[np.arange(len(block)), np.arange(a, a + len(block))] = -np.inf
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(sims, near, axis=1)
            order = np.argsort(-value, axis=1, kind="stable")
            near, value = np.take_along_axis(near, order, axis=1), np.take_along_axis(value, order, axis=1)
            parts.append(_spread(own, near, value, links))
        chosen = np.concatenate(parts)
    source = np.repeat(np.arange(n), chosen.shape[1])
    target = chosen.ravel()
    pairs = np.unique(np.concatenate([source * n + target, target * n + source]))
    source, target = pairs // n, pairs % n
    starts = np.searchsorted(source, np.arange(n + 1))
    return starts.astype(np.int32), target.astype(np.int32)


class Graph:
    """Layers from the top to the ground, each as (members, starts, targets); targets are places among the members."""

    def __init__(self, points: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.points, self.layers = points, layers

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES) -> Graph:
        points = _unit(vectors)
        members, layers = np.arange(len(points)), []
        draw = np.random.default_rng(len(points))
        while True:
            layers.append((members.astype(np.int32), *_layer(points, members, links, candidates)))
            if len(members) <= 2 * LAYER_RATIO:
                return cls(points, layers[::-1])
            members = np.sort(draw.choice(members, len(members) // LAYER_RATIO, replace=False))

    def flat(self) -> tuple[bytes, list[int]]:
        """All layers' arrays in a row, and their lengths."""
        arrays = [a for layer in self.layers for a in layer]
        return np.concatenate(arrays).astype("<i4").tobytes(), [len(a) for a in arrays]

    @classmethod
    def read(cls, vectors: np.ndarray, data: bytes, lengths: list[int]) -> Graph:
        arrays = np.split(np.frombuffer(data, "<i4"), np.cumsum(lengths)[:-1])
        return cls(_unit(vectors), [tuple(arrays[i : i + 3]) for i in range(0, len(arrays), 3)])

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """The ``beam`` nearest points found for each query, nearest first; -1 where there are fewer."""
        asked = _unit(queries)
        members = self.layers[0][0]  # small: all of the top layer are entries
        entries = np.tile(np.arange(len(members)), (len(asked), 1))
        for depth, (members, starts, targets) in enumerate(self.layers):
            if depth:
                above = self.layers[depth - 1][0]
                entries = np.where(found >= 0, np.searchsorted(members, above[found]), -1)
            ground = depth == len(self.layers) - 1
            found = self._walk(asked, members, starts, targets, entries, beam if ground else beam // 4)
        return np.where(found >= 0, members[found], -1)

    def _walk(self, asked, members, starts, targets, entries, beam) -> np.ndarray:
        """Best-first walk of all queries through one layer at once."""
        own, n, q = self.points[members], len(members), len(asked)
        seen = np.zeros((q, n + 1), bool)
        rows = np.arange(q)[:, None]
        degree = int(np.diff(starts).max()) if n else 0
        table = np.full((n + 1, degree), n, np.int64)  # the last row and the value n stand for no point
        source = np.repeat(np.arange(n), np.diff(starts))
        table[source, np.arange(len(targets)) - starts[:-1][source]] = targets
        places = np.where(entries >= 0, entries, n)
        best = np.full((q, beam), n, np.int64)
        value = np.full((q, beam), -np.inf, np.float32)
        done = np.ones((q, beam), bool)
        active = np.arange(q)
        while len(active):
            fresh = ~seen[active[:, None], places] & (places < n)
            seen[active[:, None], places] = True
            sims = np.einsum("qkd,qd->qk", own[np.minimum(places, n - 1)], asked[active])
            sims = np.where(fresh, sims, -np.inf)
            all_places = np.concatenate([best[active], places], axis=1)
            all_values = np.concatenate([value[active], sims], axis=1)
            all_done = np.concatenate([done[active], ~fresh], axis=1)
            order = np.argsort(-all_values, axis=1, kind="stable")[:, :beam]
            best[active] = np.take_along_axis(all_places, order, axis=1)
            value[active] = np.take_along_axis(all_values, order, axis=1)
            done[active] = np.take_along_axis(all_done, order, axis=1)
            waiting = ~done[active] & (value[active] > -np.inf)
            more = waiting.any(axis=1)
            active = active[more]
            first = waiting[more].argmax(axis=1)
            done[active, first] = True
            places = table[best[active, first]]
        del rows
        return np.where(value > -np.inf, best, -1)


def usable(column: str):
    """Vectors with a direction: not null, not empty, all components finite, not all zero."""
    bad = f"exists({column}, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return F.expr(f"{column} IS NOT NULL AND size({column}) > 0 AND NOT {bad} AND exists({column}, x -> x <> 0)")


def scaled(column: str) -> Column:
    """The vector times the power of two that brings its largest component to 0.5 up to 1. That is exact: vectors that are
    such multiples of one another become equal, and no cosine changes."""
    largest = F.greatest(F.array_max(column), -F.array_min(column))
    power = F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), F.floor(F.log2(largest)).cast("double") + 1))
    about = F.pow(F.lit(2.0), -power)
    scale = about * F.when(largest * about >= 1, 0.5).when(largest * about < 0.5, 2.0).otherwise(1.0)
    # Repeated into an array, as a value in a lambda would be computed again for every component.
    return F.zip_with(F.col(column), F.array_repeat(scale, F.size(column)), lambda x, by: x * by)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def build_index(vectors: DataFrame, id_column: str, vector_column: str, k: int, shard_points: int) -> DataFrame:
    """A row per shard: dim, shard, its distinct vectors, up to k + 1 least ids of each, and the graph's flat arrays."""
    good = vectors.where(usable(vector_column) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    ).withColumn("vector", scaled("vector"))
    # Equal vectors, or multiples by a power of two, are one point. More than k + 1 of them never enter one result. The window keeps as many per task before the shuffle.
    least = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    points = good.withColumn("place", least).where(F.col("place") <= k + 1).groupBy("vector").agg(
        F.sort_array(F.collect_list("id")).alias("ids")
    )
    points = materialize(points.withColumn("dim", F.size("vector")), "points")
    sizes = points.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_points).alias("shards"))  # a row per dimension
    dealt = points.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        n = table.num_rows
        vectors = _matrix(table.column("vector"), n)
        ids = table.column("ids").combine_chunks()
        data, lengths = Graph.build(vectors).flat()
        return pa.table(
            {
                "dim": pa.array([vectors.shape[1]], pa.int32()), "shard": table.column("shard").slice(0, 1).cast(pa.int32()),
                "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
                "ids": pa.array([ids.flatten().to_numpy().tolist()], pa.list_(pa.int64())),
                "counts": pa.array([np.diff(ids.offsets.to_numpy()).tolist()], pa.list_(pa.int32())),
                "graph": pa.array([data], pa.binary()), "lengths": pa.array([lengths], pa.list_(pa.int32())),
            }
        )

    schema = "dim int, shard int, vectors binary, ids array<long>, counts array<int>, graph binary, lengths array<int>"
    return dealt.select("dim", "shard", "vector", "ids").groupBy("dim", "shard").applyInArrow(build, schema)


def nearest_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", every: int = EVERY, k: int = NEAREST,
    shard_points: int = SHARD_POINTS, beam: int = BEAM,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine) of the ``k`` nearest rows found for each row whose id is divisible
    by ``every``, without the row itself.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows with a null id;
    vectors of different lengths never meet. Ties go to the smaller id. A row that is there twice finds its copy. Every row
    is indexed; the search is approximate. Other columns are not read; no rows give no rows.
    """
    index = materialize(build_index(vectors, id_column, vector_column, k, shard_points), "graphs")
    asked = vectors.where(usable(vector_column) & (F.col(id_column) % every == 0)).select(
        F.col(id_column).cast("long").alias("query_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    asked = asked.withColumn("vector", scaled("vector"))
    asked = materialize(asked.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")), "queries")
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    # Each block of queries meets each shard once.
    shards = index.select("dim", "shard").distinct()
    left = asked.join(shards, "dim").select(
        F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard"), F.col("block").alias("of_block"), "row", "query_id", "vector"
    )
    right = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(queries: pa.Table, stored: pa.Table) -> pa.Table:
        out: dict[str, list] = {"row": [], "query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and stored.num_rows:
            shard = stored.slice(0, 1).to_pylist()[0]
            points = np.frombuffer(shard["vectors"], "<f8").reshape(-1, shard["dim"])
            ids, ends = np.array(shard["ids"]), np.cumsum(shard["counts"])
            graph = Graph.read(points, shard["graph"], shard["lengths"])
            given = _matrix(queries.column("vector"), queries.num_rows)
            found = graph.search(given, beam)
            rows, own = queries.column("row").to_pylist(), queries.column("query_id").to_pylist()
            norms = np.linalg.norm(points, axis=1)
            for i, near in enumerate(found):
                near = near[near >= 0]
                scores = (points[near] @ given[i]) / (norms[near] * np.linalg.norm(given[i]))
                all_ids = [ids[ends[p] - shard["counts"][p] : ends[p]] for p in near]
                pairs = [(-s, int(v)) for s, group in zip(scores.tolist(), all_ids, strict=True) for v in group]
                pairs.sort()
                # Once, where its own vector is: the row itself.
                same = next((j for j, (_, v) in enumerate(pairs) if v == own[i]), None)
                if same is not None:
                    del pairs[same]
                for score, vec_id in pairs[:k]:
                    out["row"].append(rows[i])
                    out["query_id"].append(own[i])
                    out["vec_id"].append(vec_id)
                    out["score"].append(-score)
        kinds = {"row": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    found = left.groupBy("of_dim", "of_shard", "of_block").cogroup(right.groupBy("dim", "shard", "block")).applyInArrow(
        search, "row long, query_id long, vec_id long, score double"
    )
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
