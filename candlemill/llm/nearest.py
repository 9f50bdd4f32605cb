"""Approximate nearest neighbours by inner product, with randomly rotated one-bit codes.

Vectors are dealt to the nearest of some centroids. What a vector differs from its centroid
by is rotated at random and kept as one bit for each dimension, with two scalars: its
length, and the inner product of its direction with the code's. From packed bits and
scalars an inner product with any query is estimated, with a bound on the error. In each
list that a query looks into, only vectors whose upper bound reaches the best lower bounds
are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import saved

NEAREST = 20
# Rows that the centroids are fitted on, at most, and rows in a list on average.
SAMPLE = 20_000
LIST_ROWS = 1000
MOST_LISTS = 1024
# Lists that a query looks into: this share of them, and at least so many.
PROBED_SHARE = 0.75
LEAST_PROBED = 8
# Rows of a list, and queries, that are compared at once.
BLOCK = 2048
# Standard deviations that the error bound allows for.
CONFIDENCE = 3.0
SEED = 10


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A seeded random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


class Codes:
    """One-bit codes of vectors around a centroid."""

    def __init__(self, vectors: np.ndarray, centroid: np.ndarray, turn: np.ndarray):
        self.n, self.dimensions = vectors.shape
        rest = (vectors - centroid) @ turn.T
        self.length = np.linalg.norm(rest, axis=1)
        direction = rest / np.where(self.length > 0, self.length, 1)[:, None]
        self.bits = np.packbits(rest > 0, axis=1)
        # Of the direction with its code, whose coordinates are 1 / sqrt(D) up or down.
        self.agreement = np.abs(direction).sum(axis=1) / np.sqrt(self.dimensions)
        self.centroid, self.turn = centroid, turn

    def estimate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (query by vector) and bounds on their errors.

        A query is rotated too and its coordinates are added up over set bits: a table of
        all 256 sums for each eight of them turns the packed bytes into partial sums.
        """
        turned = queries @ self.turn.T
        pad = -self.dimensions % 8
        eights = np.pad(turned, ((0, 0), (0, pad))).reshape(len(queries), -1, 8)
        patterns = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
        sums = eights @ patterns.T.astype(float)
        over = np.zeros((len(queries), self.n))
        for byte in range(self.bits.shape[1]):
            over += sums[:, byte, :][:, self.bits[:, byte]]
        with_code = (2 * over - turned.sum(axis=1)[:, None]) / np.sqrt(self.dimensions)
        agreement = np.where(self.agreement > 0, self.agreement, 1.0)
        center = queries @ self.centroid
        estimate = center[:, None] + self.length * with_code / agreement
        spread = np.sqrt(np.maximum(0, 1 - agreement**2)) / agreement / np.sqrt(max(1, self.dimensions - 1))
        error = CONFIDENCE * self.length * spread * np.linalg.norm(queries, axis=1)[:, None]
        return estimate, error


def best_in_block(
    vectors: np.ndarray,
    weight: np.ndarray,
    queries: np.ndarray,
    floors: np.ndarray,
    codes: Codes,
    nearest: int,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and exact inner products of its candidates in a block.

    ``weight`` counts the ids that share a vector. A vector is reranked unless its upper
    bound is below the query's floor, or below the lower bounds of vectors of ``nearest``
    ids. It is a candidate if its inner product reaches the floor.
    """
    estimate, error = codes.estimate(queries)
    out = []
    for q in range(len(queries)):
        low = estimate[q] - error[q]
        order = np.argsort(-low, kind="stable")[: nearest + 1]
        enough = np.searchsorted(np.cumsum(weight[order]), nearest)
        floor = max(floors[q], low[order[enough]] if enough < len(order) else -np.inf)
        take = np.flatnonzero(estimate[q] + error[q] >= floor)
        exact = (vectors[take] * queries[q]).sum(axis=1)
        take, exact = take[exact >= floors[q]], exact[exact >= floors[q]]
        if len(take) > nearest:
            kept = np.argsort(-exact, kind="stable")
            last = exact[kept[nearest - 1]]
            take, exact = take[exact >= last], exact[exact >= last]
        out.append((take, exact))
    return out


def centroids(sample: np.ndarray, lists: int, seed: int = SEED) -> np.ndarray:
    """Seeded k-means over a sample, a few rounds."""
    rng = np.random.default_rng(seed)
    sample = np.unique(sample, axis=0)
    lists = max(1, min(lists, len(sample)))
    centers = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(8):
        at = nearest_centers(sample, centers, 1)[:, 0]
        count = np.bincount(at, minlength=lists)
        total = np.zeros_like(centers)
        np.add.at(total, at, sample)
        centers = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centers)
    return centers


def nearest_centers(vectors: np.ndarray, centers: np.ndarray, count: int) -> np.ndarray:
    distance = (centers**2).sum(axis=1) - 2 * vectors @ centers.T
    if count >= len(centers):
        return np.argsort(distance, axis=1, kind="stable")
    near = np.argpartition(distance, count - 1, axis=1)[:, :count]
    return near


def promising_lists(queries: np.ndarray, centers: np.ndarray, reach: np.ndarray, count: int) -> np.ndarray:
    """The lists whose vectors may have the largest inner products: centre and reach."""
    hope = queries @ centers.T + np.linalg.norm(queries, axis=1)[:, None] * reach * 0.5
    count = min(count, len(centers))
    return np.argsort(-hope, axis=1, kind="stable")[:, :count]


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that take part, and their dimensions."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    usable = vectors.select("vec_id", v.alias("v"))
    usable = usable.where(
        "vec_id IS NOT NULL AND v IS NOT NULL"
        " AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(v, x -> x <> 0)"
    )
    common = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return usable, 0
    return usable.where(F.size("v") == common[0]), int(common[0])


def _best(found: DataFrame, nearest: int) -> DataFrame:
    """The ``nearest`` + 1 nearest of each query: its own id is still among them."""
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best))
    return found.where(F.col("n") <= nearest + 1).select("q", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    queries_every: int = 20,
    nearest: int = NEAREST,
    probed_share: float = PROBED_SHARE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) over ``vectors`` (vec_id, embedding, ...).

    Queries are the rows whose vec_id is divisible by ``queries_every``; candidates are all
    rows but those of the query's own id. Each query gets its ``nearest`` nearest found by inner
    product in double precision, nearest first, ties to the smaller vec_id; fewer if there
    are not as many. Rows with a null id, and vectors that are null, zero, of another length
    than most, or with null or non-finite components take no part. Equal vectors are
    searched once, with as many of their smallest ids as can be wanted; of rows with one id
    and one vector one takes part. No rows give no rows. Further columns are not looked at.

    Index and search: centroids are fitted on at most SAMPLE rows, every row is indexed, and
    a query looks into the lists of the share ``probed_share``, LEAST_PROBED at least: into
    the most promising one first, and of the others for vectors that are as near as the
    last of the ``nearest`` found there.
    """
    spark = vectors.sparkSession
    usable, dimensions = _usable(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    if not dimensions:
        return spark.createDataFrame([], schema)
    # A query's own id is left out later, so one id more is kept than can be wanted.
    same = Window.partitionBy("v").orderBy("vec_id")
    ids = usable.dropDuplicates(["vec_id", "v"]).withColumn("place", F.row_number().over(same))
    ids = saved(ids.where(F.col("place") <= nearest + 1).select("vec_id", "v"), "ids")
    distinct = ids.groupBy("v").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("key")
    )
    distinct = saved(distinct, "distinct")
    asked = usable.where(F.col("vec_id") % queries_every == 0).dropDuplicates(["vec_id", "v"])
    asked = asked.select(F.col("vec_id").alias("query_id"), "v")

    count = distinct.count()
    lists = int(min(MOST_LISTS, max(1, round(count / LIST_ROWS))))
    sample = distinct.orderBy(F.xxhash64("key", F.lit(SEED))).limit(SAMPLE).select("v")
    sample = np.array([r.v for r in sample.collect()]).reshape(-1, dimensions)
    centers = centroids(sample, lists)
    at = nearest_centers(sample, centers, 1)[:, 0]
    away = np.linalg.norm(sample - centers[at], axis=1)
    reach = np.array([away[at == c].mean() if (at == c).any() else 0.0 for c in range(len(centers))])
    probed = max(LEAST_PROBED, int(np.ceil(len(centers) * probed_share)))
    turn = rotation(dimensions)

    def into_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(0), dimensions)
                near = nearest_centers(v, centers, 1)[:, 0].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(near)], names=["v", "ids", "key", "list"]
                )

    def into_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(0), dimensions)
                look = promising_lists(v, centers, reach, probed).astype(np.int32)
                ends = pa.array(np.arange(len(v) + 1, dtype=np.int32) * look.shape[1])
                lists_ = pa.ListArray.from_arrays(ends, pa.array(look.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists_], names=["v", "q", "lists"])

    listed = distinct.select("v", "ids", "key").mapInArrow(
        into_lists, "v array<double>, ids array<long>, key long, list int"
    )
    listed = saved(listed, "listed")
    # Equal query vectors have equal answers: they are searched once.
    searched = asked.groupBy("v").agg(F.min("query_id").alias("q")).select("v", "q")
    probes = searched.mapInArrow(into_probes, "v array<double>, q long, lists array<int>")
    probes = saved(probes.select("v", "q", F.posexplode("lists").alias("turn", "list")), "probes")

    def search(key: tuple, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        q, place, score = [], [], []
        if len(rows) and len(asks):
            v = np.stack(rows["v"].to_numpy())
            weight = np.array([len(i) for i in rows["ids"]])
            codes = Codes(v, centers[key[0]], turn)
            for at in range(0, len(asks), 256):
                part = asks.iloc[at : at + 256]
                floors = part["floor"].fillna(-np.inf).to_numpy()
                asked_v = np.stack(part["v"].to_numpy())
                found = best_in_block(v, weight, asked_v, floors, codes, nearest + 1)
                for query, (take, exact) in zip(part["q"], found):
                    q += [query] * len(take)
                    place += list(take)
                    score += list(exact)
        ids = rows["ids"].to_numpy()
        return pd.DataFrame({"q": q, "ids": [ids[p] for p in place], "score": score})

    def answers(asks: DataFrame, label: str) -> DataFrame:
        """The nearest of each query in the lists that it asks."""
        # Blocks of a list's rows by blocks of the queries that look into it.
        rows_of = listed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rows"))
        asks_of = asks.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("asks"))
        sizes = saved(rows_of.join(asks_of, "list"), "sizes")
        left = listed.join(sizes, "list").select(
            "list",
            F.pmod(F.xxhash64("key"), "rows").cast("int").alias("r"),
            F.explode(F.expr("sequence(0, asks - 1)")).alias("a"),
            "v",
            "ids",
        )
        right = asks.join(sizes, "list").select(
            "list",
            F.explode(F.expr("sequence(0, rows - 1)")).alias("r"),
            F.pmod(F.xxhash64("q"), "asks").cast("int").alias("a"),
            "v",
            "q",
            "floor",
        )
        found = left.groupBy("list", "r", "a").cogroup(right.groupBy("list", "r", "a"))
        found = found.applyInPandas(search, "q long, ids array<long>, score double")
        return saved(_best(found.select("q", F.explode("ids").alias("vec_id"), "score"), nearest), label)

    first = probes.where("turn = 0").withColumn("floor", F.lit(None).cast("double"))
    first = answers(first, "first")
    # The floor of a query: the last of as many as can be wanted; none if there are fewer.
    floors = first.groupBy("q").agg(
        F.when(F.count("*") > nearest, F.min("score")).alias("floor")
    )
    others = answers(probes.where("turn > 0").join(floors, "q", "left"), "others")
    answered = _best(first.union(others), nearest)

    groups = searched.join(asked, "v").select("query_id", "q")
    out = groups.join(answered, "q").where("query_id <> vec_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
    return out.select("query_id", "rank", "vec_id", "score")
