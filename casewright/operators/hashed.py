"""Approximate cosine nearest neighbours through hash buckets.

Every table turns the vectors by a random rotation of its own and files each under its ``codes`` largest turned
coordinates, one from each of ``codes`` rotations, with their signs: 2 * dims buckets a code. A query asks the ``probes`` buckets
that fit it best in each table; what it meets there is ranked by its exact distance. Nearer vectors share buckets more often, so
the share of pairs that are compared is about tables * probes / buckets, whatever the size of the index.

Rows and queries with one vector are one vector here. Buckets that hold many vectors, or are asked by many queries, are
cut into blocks and chunks of bounded size. A query that meets fewer than k rows is answered by the exact search.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from casewright.operators import vectors
from casewright.operators.joins import salted_join
from casewright.operators.positions import small_side
from casewright.session import stage

_SALTS = 64
_FOUND = "query_vector bigint, vector_id bigint, distance double"


@dataclass(frozen=True)
class HashPlan:
    """``codes`` of 2 or more give (2 * dims) ** codes buckets, for indexes of many millions of vectors."""
    tables: int = 16
    probes: int = 4
    codes: int = 1
    block_rows: int = 20_000
    chunk_rows: int = 20_000
    seed: int = 1

    def share(self, dims: int) -> float:
        """Expected share of all pairs that are compared, pairs that meet in several tables counted each time."""
        return min(1.0, self.tables * self.probes / (2 * dims) ** self.codes)


def _rotations(plan: HashPlan, dims: int) -> np.ndarray:
    rng = np.random.default_rng(plan.seed)
    return np.stack([np.linalg.qr(rng.standard_normal((dims, dims)))[0] for _ in range(plan.tables * plan.codes)])


def _ordered(turned: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``most`` of the 2 * dims signed axes of each row, best first, and how far each falls short of the best."""
    both = np.concatenate([turned, -turned], axis=1)
    best = np.argsort(-both, axis=1, kind="stable")[:, :most]
    fit = np.take_along_axis(both, best, axis=1)
    return best, fit[:, :1] - fit


def buckets(matrix: np.ndarray, rotations: np.ndarray, plan: HashPlan, probes: int) -> np.ndarray:
    """(rows, tables, probes): numbers of the buckets that fit each row best, best first."""
    sides = 2 * matrix.shape[1]
    probes = min(probes, sides**plan.codes)
    out = np.empty((len(matrix), plan.tables, probes), np.int64)
    for table in range(plan.tables):
        number, short = np.zeros((len(matrix), 1), np.int64), np.zeros((len(matrix), 1))
        for code in range(plan.codes):
            best, behind = _ordered(matrix @ rotations[table * plan.codes + code], min(probes, sides))
            number = (number[:, :, None] * sides + best[:, None, :]).reshape(len(matrix), -1)
            short = (short[:, :, None] + behind[:, None, :] ** 2).reshape(len(matrix), -1)
            keep = np.argsort(short, axis=1, kind="stable")[:, :probes]
            number, short = np.take_along_axis(number, keep, axis=1), np.take_along_axis(short, keep, axis=1)
        out[:, table] = number
    return out


def _filed(df: DataFrame, plan: HashPlan, dims: int, probes: int) -> DataFrame:
    """``df`` with a row for each (table, bucket) its embedding is filed under, or asks."""
    shared = df.sparkSession.sparkContext.broadcast(_rotations(plan, dims))

    @F.arrow_udf("array<struct<table:int,bucket:bigint>>")
    def places(embedding: pa.Array) -> pa.Array:
        found = buckets(vectors._matrix(embedding), shared.value, plan, probes)
        rows, tables, each = found.shape
        items = pa.StructArray.from_arrays(
            [pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), each), rows)), pa.array(found.ravel())], names=["table", "bucket"])
        return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * (tables * each), items)

    return df.withColumn("place", F.explode(places("embedding"))).select("*", "place.table", "place.bucket").drop("place")


def distinct_vectors(index: DataFrame, most: int) -> DataFrame:
    """vector_id, embedding, ids: each distinct vector with its ``most`` smallest row numbers, the smallest as vector_id.

    Equal vectors are ranked by row number, so no other of their rows can be among the nearest. A vector that fills a
    large part of the index is first cut down in 64 parts.
    """
    rows = index.filter(F.col("embedding").isNotNull()).select(F.col("row_index").cast("long").alias("row_index"), "embedding")
    salted = W.partitionBy("embedding", F.pmod(F.xxhash64("row_index"), F.lit(_SALTS))).orderBy("row_index")
    few = rows.withColumn("__n", F.row_number().over(salted)).filter(F.col("__n") <= most)
    listed = few.groupBy("embedding").agg(F.slice(F.sort_array(F.collect_list("row_index")), 1, most).alias("ids"))  # at most 64 * most ids
    return listed.select(F.col("ids")[0].alias("vector_id"), "embedding", "ids")


def _compare(asked: DataFrame, filed: DataFrame, n_vectors: int, plan: HashPlan, k: int) -> DataFrame:
    """The k best vectors of each (query, bucket, block), with exact distances.

    Small buckets of a table go to a task together, as many as make about ``block_rows`` vectors.
    """
    place = ["table", "bucket"]
    packs = math.ceil(n_vectors / plan.block_rows)
    loads = (filed.groupBy(*place).agg(F.count(F.lit(1)).alias("__rows"))
             .join(asked.groupBy(*place).agg(F.count(F.lit(1)).alias("__asked")), place)
             .select(*place, F.ceil(F.col("__rows") / plan.block_rows).cast("int").alias("__blocks"),
                     F.ceil(F.col("__asked") / plan.chunk_rows).cast("int").alias("__chunks"))
             .withColumn("__pack", F.when((F.col("__blocks") > 1) | (F.col("__chunks") > 1), -1 - F.col("bucket")).otherwise(F.pmod("bucket", F.lit(packs)))))
    loads = small_side(loads)
    left = asked.join(loads, place).withColumn("chunk", F.pmod(F.xxhash64("query_vector"), F.col("__chunks")).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))).withColumn("pack", F.col("__pack")).drop("__blocks", "__chunks", "__pack")
    right = filed.join(loads, place).withColumn("block", F.pmod(F.xxhash64("vector_id"), F.col("__blocks")).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))).withColumn("pack", F.col("__pack")).drop("__blocks", "__chunks", "__pack")

    def search(asking: pa.Table, block: pa.Table) -> pa.Table:
        parts = {"query_vector": [], "vector_id": [], "distance": []}
        if asking.num_rows and block.num_rows:
            number, vector_id = asking["query_vector"].to_numpy(), block["vector_id"].to_numpy()
            questions, matrix = vectors._matrix(asking["embedding"]), vectors._matrix(block["embedding"])
            here, there = asking["bucket"].to_numpy(), block["bucket"].to_numpy()
            by_question, by_row = np.argsort(here, kind="stable"), np.argsort(there, kind="stable")
            here, there = here[by_question], there[by_row]
            for bucket in np.intersect1d(here, there):
                q = by_question[np.searchsorted(here, bucket):np.searchsorted(here, bucket, "right")]
                r = by_row[np.searchsorted(there, bucket):np.searchsorted(there, bucket, "right")]
                for row, near, distance in vectors._nearest(questions[q], matrix[r], vector_id[r], k, None):
                    for name, values in zip(parts, (number[q[row]], near, distance)):
                        parts[name].append(values)
        types = {"query_vector": pa.int64(), "vector_id": pa.int64(), "distance": pa.float64()}
        return pa.table({n: pa.array(np.concatenate(v) if v else [], types[n]) for n, v in parts.items()})

    keys = ["table", "pack", "block", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _FOUND)


def visited_pairs(asked: DataFrame, filed: DataFrame) -> int:
    """Pairs of vectors that are compared, those that meet in several tables counted each time."""
    place = ["table", "bucket"]
    met = (filed.groupBy(*place).agg(F.count(F.lit(1)).alias("__rows"))
           .join(asked.groupBy(*place).agg(F.count(F.lit(1)).alias("__asked")), place))
    return met.agg(F.coalesce(F.sum(F.col("__rows") * F.col("__asked")), F.lit(0))).first()[0]


def knn_hashed(
    queries: DataFrame, index: DataFrame, k: int, exclude_self: bool = True, plan: HashPlan = HashPlan(), report: dict | None = None,
) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): about the k nearest index rows of each query, nearest first, ties by id.

    Takes what ``knn_cosine`` takes and gives as many rows: k for each query, or all there are. Distances are exact; what is
    approximate is only whether a near row was met. ``report`` gets the number of compared pairs, of all pairs and of the
    queries that had to be searched exactly.
    """
    spark = queries.sparkSession
    empty = "query_id bigint, rank int, neighbor_id bigint, distance double"
    if "own_id" not in queries.columns:
        queries = queries.withColumn("own_id", F.col("query_id"))
    asked_rows = stage(queries.filter(F.col("embedding").isNotNull()).select(
        F.col("query_id").cast("long").alias("query_id"), F.col("own_id").cast("long").alias("own_id"), "embedding"), "hashed-queries")
    need = k + 1 if exclude_self else k
    stored = stage(distinct_vectors(index, need), "hashed-vectors")
    dims, n_vectors = stored.agg(F.max(F.size("embedding")), F.count(F.lit(1))).first()
    if not n_vectors:
        return spark.createDataFrame([], empty)
    questions = stage(asked_rows.groupBy("embedding").agg(F.min("query_id").alias("query_vector")), "hashed-questions")
    asked = stage(_filed(questions, plan, dims, plan.probes), "hashed-asked")
    filed = stage(_filed(stored.drop("ids"), plan, dims, 1), "hashed-filed")

    met = _compare(asked, filed, n_vectors, plan, need).distinct()
    order = W.partitionBy("query_vector").orderBy("distance", "vector_id")
    nearest = met.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= need)
    # The expanded rows of the nearest vectors, at most need * need a query, in (distance, id) order.
    rows = nearest.join(stored.select("vector_id", "ids"), "vector_id").groupBy("query_vector").agg(F.slice(F.sort_array(F.flatten(F.collect_list(
        F.transform("ids", lambda i: F.struct(F.col("distance").alias("distance"), i.alias("neighbor_id")))))), 1, need).alias("__near"))
    lists = stage(questions.join(rows, "query_vector", "left").select("embedding", F.coalesce("__near", F.array().cast(
        "array<struct<distance:double,neighbor_id:bigint>>")).alias("__near")), "hashed-near")
    own = lambda n: ~n["neighbor_id"].eqNullSafe(F.col("own_id"))
    answered = salted_join(asked_rows, lists, "embedding", "query_id").select(
        "query_id", "own_id", "embedding", F.slice(F.filter("__near", own) if exclude_self else F.col("__near"), 1, k).alias("__near"))
    answered = stage(answered, "hashed-answers")

    n_rows = index.filter(F.col("embedding").isNotNull()).count()
    itself = index.filter(F.col("embedding").isNotNull()).select(F.col("row_index").cast("long").alias("own_id")).distinct().withColumn("__in", F.lit(1))
    short = answered.filter(F.size("__near") < min(k, n_rows))
    if exclude_self and n_rows <= k:  # here it matters whether the query itself is one of the few rows
        short = short.join(itself, "own_id", "left").filter(F.size("__near") < F.lit(n_rows) - F.coalesce("__in", F.lit(0)))
    short = stage(short.select("query_id", "own_id", "embedding"), "hashed-short")
    n_short = short.count()
    if report is not None:
        report |= {"visited": visited_pairs(asked, filed), "pairs": questions.count() * n_vectors, "searched_exactly": n_short}
    found = answered.join(short.select("query_id"), "query_id", "left_anti") if n_short else answered
    out = found.select("query_id", F.posexplode("__near").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "n.neighbor_id", "n.distance")
    return out.unionByName(vectors.knn_cosine(short, index, k, exclude_self)) if n_short else out
