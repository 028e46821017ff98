"""Approximate nearest neighbours by cosine with balanced posting lists.

Centroids are fitted on the driver over a bounded sample (``PER_LIST`` vectors for each list, at most ``MAX_LISTS`` lists):
spherical k-means whose assignment charges crowded lists. They are searched through an in-memory graph (each centroid's nearest
others and a few far ones) by a beam. Every vector is indexed: it joins its nearest list and, as a boundary vector, further lists
nearly as close, unless a list it already joined is closer to that list than the vector is. A query looks into the lists whose
distance is within a ratio of its nearest one. Candidates are compared exactly, in double precision on the original vectors.

Equal vectors are indexed once, with their smallest ids: no list holds more than one of them, so heavy repeats cost nothing.
Lists and their queries are dealt into blocks of at most ``BLOCK`` rows, so no task holds a whole list if it is large.

Vectors that are null, zero, of another length than most, or hold a null or a component that isn't finite take no part. Ties go
to the smaller id. An id that repeats with equal vectors counts once; with different vectors, each is a candidate. A query with fewer candidates than
asked for gets them all that its lists hold; with at most ``LIST_SIZE`` vectors there is one list, and the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import Shipped
from .sampling import about

LIST_SIZE = 200
MAX_LISTS = 16_384
PER_LIST = 32
COPIES = 4  # lists a boundary vector may join
JOIN_RATIO = 1.15  # of distances: how much farther a list may be for a boundary vector
PROBE_RATIO = 1.6
PROBES = 64
BEAM = 80
BLOCK = 4_000


@dataclass
class Centroids:
    """Unit centroids and their graph."""

    points: np.ndarray
    links: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, near: int = 16, far: int = 4, seed: int = 5) -> Centroids:
        n = len(points)
        if n <= near + far + 1:
            return cls(points, np.tile(np.arange(n), (n, 1)))
        links = np.empty((n, near + far), np.int64)
        rng = np.random.default_rng(seed)
        for at in range(0, n, 1024):
            close = points[at:at + 1024] @ points.T
            close[np.arange(len(close)), np.arange(at, at + len(close))] = -2
            links[at:at + len(close), :near] = np.argpartition(-close, near, axis=1)[:, :near]
        links[:, near:] = rng.integers(0, n, (n, far))
        return cls(points, links)

    def search(self, queries: np.ndarray, want: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of about the nearest centroids of unit vectors, nearest first; all queries walk side by side."""
        n = len(self.points)
        beam = min(max(beam, want), n)
        rows = np.arange(len(queries))[:, None]
        starts = np.linspace(0, n - 1, beam).astype(np.int64)
        ids = np.tile(starts, (len(queries), 1))
        close = queries @ self.points[starts].T
        open_ = np.ones(ids.shape, bool)
        seen = np.zeros((len(queries), n), bool)
        seen[:, starts] = True
        while True:
            pick = np.where(open_, close, -3).argmax(axis=1)
            live = np.flatnonzero(open_[rows[:, 0], pick])
            if not len(live):
                break
            open_[live, pick[live]] = False
            fresh = self.links[ids[live, pick[live]]]
            new = ~seen[live[:, None], fresh]
            order = np.sort(fresh, axis=1)  # the same centroid may stand twice among the links
            if (order[:, 1:] == order[:, :-1]).any():
                first = np.ones(fresh.shape, bool)
                for j in range(1, fresh.shape[1]):
                    first[:, j] = ~(fresh[:, :j] == fresh[:, j:j + 1]).any(axis=1)
                new &= first
            seen[live[:, None], fresh] = True
            value = np.where(new, np.einsum("qd,qkd->qk", queries[live], self.points[fresh]), -3)
            all_ids, all_close = np.hstack([ids[live], fresh]), np.hstack([close[live], value])
            all_open = np.hstack([open_[live], new])
            best = np.argpartition(-all_close, beam - 1, axis=1)[:, :beam]
            ids[live], close[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_close, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1)
        order = np.argsort(-close, axis=1, kind="stable")[:, :min(want, n)]
        return np.take_along_axis(ids, order, 1), np.sqrt(np.maximum(2 - 2 * np.take_along_axis(close, order, 1), 0))


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Spherical k-means of unit vectors; an assignment costs more in a list that holds more than its share."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(x))
    points = x[rng.permutation(len(x))[:lists]].copy()
    charge = np.zeros(lists)
    for _ in range(rounds):
        owner = np.concatenate([(x[at:at + 2048] @ points.T - charge).argmax(axis=1) for at in range(0, len(x), 2048)])
        counts = np.bincount(owner, minlength=lists)
        charge = 0.02 * np.log1p(counts / (len(x) / lists))
        sums = np.zeros_like(points)
        np.add.at(sums, owner, x)
        empty = counts == 0
        sums[empty] = x[rng.integers(0, len(x), int(empty.sum()))]
        points = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return points


def sound(vector: Column) -> Column:
    """True for vectors that take part, whatever their length."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _listed(df: DataFrame, index: Centroids, lists_of, schema_keep: list[str]) -> DataFrame:
    """A row for each list of each vector."""
    shared = Shipped(df, index)  # at most MAX_LISTS centroids and links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.load()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = _unit(_matrix(part.column(part.schema.names.index("vector"))))
                which, ids = lists_of(index, x)
                taken = part.take(pa.array(which))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(ids, pa.int64())], names=[*schema_keep, "list"])

    types = dict(df.dtypes)
    return df.select(*schema_keep).mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in schema_keep) + ", list long")


def joined_lists(index: Centroids, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, far = index.search(x, 2 * COPIES)
    keep = far <= far[:, :1] * JOIN_RATIO
    keep[:, 0] = True
    for j in range(1, ids.shape[1]):  # a list that a joined list is closer to than the vector is adds little
        for i in range(j):
            between = 2 - 2 * np.einsum("nd,nd->n", index.points[ids[:, i]], index.points[ids[:, j]])
            keep[:, j] &= ~(keep[:, i] & (np.sqrt(np.maximum(between, 0)) < far[:, j] * 0.8))
    keep &= np.cumsum(keep, axis=1) <= COPIES
    which, place = np.nonzero(keep)
    return which, ids[which, place]


def probed_lists(index: Centroids, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, far = index.search(x, PROBES)
    keep = far <= far[:, :1] * PROBE_RATIO
    keep[:, :4] = True
    which, place = np.nonzero(keep)
    return which, ids[which, place]


def search(df: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that ``queries`` selects, itself left out."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("vector"), queries.alias("asks")).filter(sound(F.col("vector")) & F.col("id").isNotNull())
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == length["n"])
    # equal vectors become one, with the k + 1 smallest ids; the limit works before the shuffle too
    distinct_ids = rows.groupBy("vector", "id").agg(F.max("asks").alias("asks"))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    classes = distinct_ids.select("vector", "id").withColumn("place", place).filter(F.col("place") <= k + 1)
    classes = classes.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = classes.withColumn("h", F.xxhash64("vector"))
    total = classes.count()
    lists = min(MAX_LISTS, max(1, -(-total // LIST_SIZE)))
    sample = about(classes.select("h", "vector"), "h", max(lists * PER_LIST, 1)).select("h", "vector").toArrow().combine_chunks()
    x = _unit(_matrix(sample.column("vector").combine_chunks()))[np.argsort(sample.column("h").to_numpy(), kind="stable")]
    index = Centroids.of(balanced_centroids(x, lists))
    indexed = _listed(classes, index, joined_lists, ["vector", "ids"])
    asked = rows.filter("asks").groupBy("vector").agg(F.lit(1).alias("one")).select("vector", F.xxhash64("vector").alias("h"))
    probing = _listed(asked, index, probed_lists, ["vector"])

    # blocks: a list with n vectors and q queries becomes ceil(n / BLOCK) * ceil(q / BLOCK) groups
    block_count = lambda c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1))
    sizes = indexed.groupBy("list").agg(F.count("*").alias("n")).join(probing.groupBy("list").agg(F.count("*").alias("q")), "list")
    sizes = sizes.select("list", block_count("n").alias("vb"), block_count("q").alias("qb")).hint("broadcast")  # at most MAX_LISTS rows
    hashed = F.pmod(F.xxhash64("vector", F.lit(9)), F.lit(1 << 20))
    steps = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    left = indexed.join(sizes, "list").select("list", F.pmod(hashed, F.col("vb")).alias("v"), steps("qb").alias("q"), "vector", "ids")
    right = probing.join(sizes, "list").select("list", F.pmod(hashed, F.col("qb")).alias("q"), steps("vb").alias("v"), "vector")

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"vector": b.column("vector").slice(0, 0), "ids": a.column("ids").slice(0, 0), "score": pa.array([], pa.float64())})
        ids = a.column("ids").combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0]]
        order = np.argsort(first, kind="stable")  # ties go to the smaller id
        vectors = _matrix(a.column("vector").combine_chunks())[order]
        asked_ = _matrix(b.column("vector").combine_chunks())
        norms = np.linalg.norm(vectors, axis=1)
        query_at, vector_at, score = [], [], []
        take = min(k + 1, len(vectors))
        for at in range(0, len(asked_), 256):
            part = asked_[at:at + 256]
            values = (part @ vectors.T) / norms / np.linalg.norm(part, axis=1)[:, None]
            best = np.argsort(-values, axis=1, kind="stable")[:, :take] if len(vectors) <= 64 else _best(values, take)
            query_at.append(np.repeat(np.arange(at, at + len(part)), best.shape[1]))
            vector_at.append(order[best.ravel()])
            score.append(np.take_along_axis(values, best, 1).ravel())
        return pa.table({
            "vector": b.column("vector").combine_chunks().take(pa.array(np.concatenate(query_at))),
            "ids": ids.take(pa.array(np.concatenate(vector_at))), "score": pa.array(np.concatenate(score))})

    schema = f"vector {dict(df.dtypes)[vector]}, ids array<bigint>, score double"
    found = left.groupBy("list", "v", "q").cogroup(right.groupBy("list", "v", "q")).applyInArrow(compare, schema)
    found = found.groupBy("vector", "ids").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("vector").orderBy(F.desc("score"), F.col("ids")[0]))
    found = found.withColumn("place", best).filter(F.col("place") <= k + 1)
    near = found.groupBy("vector").agg(F.slice(F.sort_array(F.flatten(F.collect_list(
        F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("id")))))), 1, k + 1).alias("near"))
    hits = rows.filter("asks").select("id", "vector").distinct().join(near, "vector")
    chosen = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    return hits.select(F.col("id").alias("query_id"), F.posexplode(chosen).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.s")).alias("score"))


def _best(values: np.ndarray, take: int) -> np.ndarray:
    """The best columns of each row in order; among equal values the first ones."""
    edge = -np.partition(-values, take - 1, axis=1)[:, take - 1]
    best = np.empty((len(values), take), np.int64)
    for i, row in enumerate(values):
        at = np.flatnonzero(row >= edge[i])
        best[i] = at[np.argsort(-row[at], kind="stable")[:take]]
    return best
