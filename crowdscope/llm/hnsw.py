"""Approximate nearest neighbours: one hierarchical navigable small-world graph
per shard, kept as flat neighbour arrays; shard results are merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdscope.llm.common import land

#: Distinct vectors of one shard, on average.
SHARD_VECTORS = 8192
#: Links that a vector picks on each level, and links back that it keeps.
PICK, BACK = 16, 32
#: Beam widths while building and searching.
BUILD_BEAM, SEARCH_BEAM = 64, 128
#: A level holds one vector in so many of the level below.
LEVEL_RATIO = 16
#: Queries that walk the graph together.
TOGETHER = 512

INDEX = "shard int, pos int, key long, vector array<float>, least long, level int, links array<int>"


def lift(vectors: np.ndarray) -> np.ndarray:
    """One more component that gives all vectors one length, so that the
    largest inner product is also the nearest point."""
    squares = (vectors.astype(float) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))
    return np.hstack([vectors, extra[:, None]]).astype(np.float32)


def walk(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int,
         limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries at once: the ``beam`` nearest points found,
    best first, as (ids, inner products); id -1 where there are fewer. Points
    from ``limit`` on do not exist yet."""
    q = len(queries)
    ids = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), -np.inf, np.float32)
    done = np.zeros((q, beam), bool)
    seen = np.zeros((q, limit), bool)
    ids[:, 0] = entry
    near[:, 0] = np.einsum("qd,qd->q", queries, points[entry])
    seen[np.arange(q), entry] = True
    live = np.arange(q)
    step = max(1, min(4, beam // 8))
    while len(live):
        score = np.where(done[live] | (ids[live] < 0), -np.inf, near[live])
        pick = np.argpartition(-score, step - 1, axis=1)[:, :step] if step < beam else np.argsort(-score, axis=1)
        take = np.isfinite(np.take_along_axis(score, pick, 1))
        on = take.any(axis=1)
        live, pick, take = live[on], pick[on], take[on]
        if not len(live):
            break
        who, col = np.nonzero(take)
        at = pick[who, col]
        done[live[who], at] = True
        next_ = links[ids[live[who], at]]
        row = np.repeat(who, next_.shape[1])
        flat = next_.reshape(-1)
        ok = (flat >= 0) & (flat < limit)
        row, flat = row[ok], flat[ok].astype(np.int64)
        new = ~seen[live[row], flat]
        code = np.unique(row[new] * limit + flat[new])
        row, flat = code // limit, code % limit
        seen[live[row], flat] = True
        if not len(row):
            continue
        value = np.einsum("pd,pd->p", queries[live[row]], points[flat])
        count = np.bincount(row, minlength=len(live))
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        wide = int(count.max())
        more_ids = np.full((len(live), wide), -1, np.int64)
        more = np.full((len(live), wide), -np.inf, np.float32)
        more_ids[row, nth], more[row, nth] = flat, value
        all_ids, all_near = np.hstack([ids[live], more_ids]), np.hstack([near[live], more])
        all_done = np.hstack([done[live], np.zeros((len(live), wide), bool)])
        best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, 1)
        near[live] = np.take_along_axis(all_near, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1)
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def diverse(points: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` candidates of each row, best first, none closer to one
    already picked than to the row's own point; free places take the best of the rest."""
    found = np.where((ids >= 0)[:, :, None], points[np.maximum(ids, 0)], 0)
    among = np.einsum("rid,rjd->rij", found, found)
    rows, width = ids.shape
    picked = np.zeros((rows, width), bool)
    for k in range(width):
        closer = (picked & (among[:, k, :] > near[:, k, None])).any(axis=1)
        picked[:, k] = (ids[:, k] >= 0) & ~closer & (picked.sum(axis=1) < most)
    order = np.argsort(~picked, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1)


def level_sizes(n: int) -> list[int]:
    """Points on each level, from 0 up."""
    sizes = [n]
    while sizes[-1] > 4 * LEVEL_RATIO:
        sizes.append(-(-sizes[-1] // LEVEL_RATIO))
    return sizes


class Graph:
    """Points in order of falling level; a level is the first so many of them.
    ``links[l]`` holds level l's neighbours: picked ones, then links back."""

    def __init__(self, points: np.ndarray, links: list[np.ndarray]):
        self.points, self.links = points, links

    @classmethod
    def build(cls, points: np.ndarray) -> Graph:
        sizes = level_sizes(len(points))
        graph = cls(points, [np.full((n, PICK + BACK), -1, np.int32) for n in sizes])
        worth = None
        for level in range(len(sizes) - 1, -1, -1):
            links = graph.links[level]
            near_back = np.full((sizes[level], BACK), -np.inf, np.float32)
            at = 0
            if level + 1 < len(sizes):  # the points above are joined already
                at = sizes[level + 1]
                links[:at], near_back[:at] = graph.links[level + 1], worth
            while at < sizes[level]:
                end = min(sizes[level], at + min(TOGETHER, max(at, 64)))
                graph._insert(level, at, end, near_back)
                at = end
            worth = near_back
        return graph

    def _insert(self, level: int, at: int, end: int, near_back: np.ndarray) -> None:
        points, links = self.points, self.links[level]
        new = points[at:end]
        within = new @ new.T
        np.fill_diagonal(within, -np.inf)
        k = min(PICK, end - at)
        mates = np.argpartition(-within, k - 1, axis=1)[:, :k]
        ids, near = mates + at, np.take_along_axis(within, mates, 1)
        ids = np.where(np.isfinite(near), ids, -1)
        if at:
            found, value = walk(points, links, new, self.enter(new, level), min(BUILD_BEAM, at), at)
            ids, near = np.hstack([ids, found]), np.hstack([near, value])
        order = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        picked = diverse(points, ids, near, PICK)
        links[at:end, :picked.shape[1]] = picked
        source = np.repeat(np.arange(at, end), picked.shape[1])
        target = picked.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        value = np.einsum("pd,pd->p", points[source], points[target])
        order = np.lexsort((source, -value, target))
        source, target, value = source[order], target[order], value[order]
        first = np.r_[True, target[1:] != target[:-1]] if len(target) else np.zeros(0, bool)
        start = np.flatnonzero(first)
        nth = np.arange(len(target)) - np.repeat(start, np.diff(np.r_[start, len(target)]))
        fits = nth < BACK
        touched = target[first]
        row = np.searchsorted(touched, target[fits])
        more_ids = np.full((len(touched), BACK), -1, np.int32)
        more = np.full((len(touched), BACK), -np.inf, np.float32)
        more_ids[row, nth[fits]], more[row, nth[fits]] = source[fits], value[fits]
        all_ids = np.hstack([links[touched, PICK:], more_ids])
        all_near = np.hstack([near_back[touched], more])
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :BACK]
        links[touched, PICK:] = np.take_along_axis(all_ids, best, 1)
        near_back[touched] = np.take_along_axis(all_near, best, 1)

    def enter(self, queries: np.ndarray, level: int) -> np.ndarray:
        """Where the queries enter ``level``, by greedy descent from the top."""
        entry = np.zeros(len(queries), np.int64)
        for above in range(len(self.links) - 1, level, -1):
            ids, _ = walk(self.points, self.links[above], queries, entry, 8, len(self.links[above]))
            entry = ids[:, 0]
        return entry

    def nearest(self, queries: np.ndarray, beam: int) -> np.ndarray:
        beam = min(beam, len(self.points))
        out = [walk(self.points, self.links[0], queries[i:i + TOGETHER], self.enter(queries[i:i + TOGETHER], 0), beam,
                    len(self.points))[0] for i in range(0, len(queries), TOGETHER)]
        return np.vstack(out) if out else np.zeros((0, beam), np.int64)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, vector) of the rows that take part."""
    wrong = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vector"))
            .where("vec_id is not null and vector is not null").where(~wrong).where(F.exists("vector", lambda x: x != 0))
            .withColumn("key", F.xxhash64("vector")))


def build_index(distinct: DataFrame, shard_vectors: int) -> tuple[DataFrame, int]:
    """The landed index of distinct (key, vector, least id) rows, and its number of shards.
    A shard holds vectors of one dimension."""
    n = max(1, -(-distinct.count() // shard_vectors))

    def build(found: pa.Table) -> pa.Table:
        key = found.column("key").to_numpy()
        order = np.argsort(key, kind="stable")  # hashes: a random order, and the same in any run
        key = key[order]
        raw = np.array(found.column("vector").to_pylist(), np.float32)[order]
        graph = Graph.build(lift(raw))
        sizes = [len(x) for x in graph.links]
        level = np.zeros(len(key), np.int32)
        for size in sizes[1:]:
            level[:size] += 1
        links = [np.concatenate([graph.links[at][p] for at in range(level[p] + 1)]) for p in range(len(key))]
        return pa.table({"shard": pa.array(np.repeat(found.column("shard")[0].as_py(), len(key)), pa.int32()),
                         "pos": pa.array(np.arange(len(key)), pa.int32()), "key": pa.array(key),
                         "vector": pa.array(list(raw), pa.list_(pa.float32())), "least": pa.array(found.column("least").to_numpy()[order]),
                         "level": pa.array(level),
                         "links": pa.array(links, pa.list_(pa.int32()))})

    shard = (F.size("vector") * n + F.pmod(F.xxhash64("key", F.lit(11)), F.lit(n))).cast("int")
    index = distinct.select("key", "vector", "least", shard.alias("shard")).groupBy("shard").applyInArrow(build, INDEX)
    return land(index, "hnsw-index"), n


def search_index(index: DataFrame, queries: DataFrame, shards: int, most: int, beam: int) -> DataFrame:
    """(query, key, score): each query's ``most`` nearest distinct vectors of
    each shard. Index rows and query rows of a shard meet in one task, the
    index first; queries then pass in Arrow batches."""

    def run(batches):
        graph, shard, held = None, None, []
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            of, kind = cols["shard"].to_numpy(), cols["kind"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (kind[1:] != kind[:-1])]) if len(of) else []
            for i, j in zip(cuts, [*cuts[1:], len(of)]):
                part = {name: c.slice(i, j - i) for name, c in cols.items()}
                if kind[i] == 0:
                    if of[i] != shard:
                        graph, shard, held = None, of[i], []
                    held.append((part["key"].to_numpy(), np.array(part["vector"].to_pylist(), np.float32),
                                 part["level"].to_numpy(), part["least"].to_numpy(), part["links"].to_pylist()))
                    continue
                if of[i] != shard:
                    continue  # no vector of this dimension
                if graph is None:
                    key, raw, level, least = (np.concatenate([h[k] for h in held]) for k in range(4))
                    flat = [x for h in held for x in h[4]]
                    width = PICK + BACK
                    links = [np.array([f[width * at:width * (at + 1)] for f in flat[:int((level >= at).sum())]], np.int32)
                             for at in range(int(level.max()) + 1)]
                    graph, exact = Graph(lift(raw), links), raw.astype(float)
                asked, of_query, width = np.array(part["vector"].to_pylist(), np.float32), part["key"].to_numpy(), beam
                while len(asked):
                    ids = graph.nearest(np.hstack([asked, np.zeros((len(asked), 1), np.float32)]), width)
                    score = np.where(ids >= 0, np.einsum("qd,qkd->qk", asked.astype(float), exact[np.maximum(ids, 0)]), -np.inf)
                    best = np.lexsort((least[np.maximum(ids, 0)], -score), axis=1)
                    ids, score = np.take_along_axis(ids, best, 1), np.take_along_axis(score, best, 1)
                    # while the last place ties with all that follow, more may tie: these queries look further
                    tied = (score[:, -1] == score[:, min(most, score.shape[1]) - 1]) & (ids[:, -1] >= 0) & (width < len(key))
                    ids, score = ids[:, :most], score[:, :most]
                    row, col = np.nonzero((ids >= 0) & ~tied[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(of_query[row]), pa.array(key[ids[row, col]]), pa.array(score[row, col]),
                                                      pa.array(least[ids[row, col]])], names=["query", "key", "score", "least"])
                    asked, of_query, width = asked[tied], of_query[tied], min(2 * width, len(key))

    names = ["shard", "kind", "pos", "key", "vector", "least", "level", "links"]
    none = F.lit(None)
    rows = index.select("shard", F.lit(0).alias("kind"), "pos", "key", "vector", "least", "level", "links")
    first = (F.size("vector") * shards).cast("int")
    asked = queries.select(F.explode(F.sequence(first, first + shards - 1)).alias("shard"), F.lit(1).alias("kind"), F.lit(0).alias("pos"), "key", "vector",
                           none.cast("long").alias("least"), none.cast("int").alias("level"), none.cast("array<int>").alias("links"))
    met = rows.unionByName(asked).select(*names).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "pos")
    return met.mapInArrow(run, "query long, key long, score double, least long")


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 20, shard_vectors: int = SHARD_VECTORS,
                       beam: int = SEARCH_BEAM) -> DataFrame:
    """The ``k`` rows of largest inner product of each query row, over all rows
    but its own: query_id, rank (from 1), vec_id and score (in double precision
    on the original vectors), ties to the smaller vec_id.

    Equal vectors are one point of the graph, with the k + 1 smallest of their
    ids; no more can be in a result. Each query is searched in every shard.

    Defined cases: null and zero vectors, those with null or non-finite
    components, and rows without vec_id take no part; a repeated row counts
    once; vectors meet only vectors of their dimension; a query with fewer
    than k others gets all; an empty table gives no rows; other columns are
    not looked at.
    """
    rows = land(valid_vectors(vectors).dropDuplicates(["vec_id", "key"]), "vectors")
    by_key = Window.partitionBy("key").orderBy("vec_id")
    smallest = rows.withColumn("_n", F.row_number().over(by_key)).where(F.col("_n") <= k + 1)
    points = land(smallest.groupBy("key").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")),
                  "points")
    index, shards = build_index(points.select("key", "vector", F.element_at("ids", 1).alias("least")), shard_vectors)
    asked = rows.where(is_query)
    found = search_index(index, asked.dropDuplicates(["key"]).select("key", "vector"), shards, k + 1, beam)
    by_query = Window.partitionBy("query")
    best = found.withColumn("_n", F.row_number().over(by_query.orderBy(F.desc("score"), "least", "key"))).where(F.col("_n") <= k + 1)
    wide = best.join(points.select("key", "ids"), "key").select("query", "score", F.explode("ids").alias("vec_id"))
    ranked = wide.withColumn("_n", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))).where(F.col("_n") <= k + 1)
    per_row = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query")).join(ranked.drop("_n"), "query")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (per_row.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
