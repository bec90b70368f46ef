"""Nearest neighbours by randomly rotated one-bit codes with error bounds (operator 7)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from casewright.session import stage

#: Bits of a code, at least; vectors of more dimensions get a bit for each.
CODE_BITS = 256
#: Rows and questions that meet in one task.
_PART, _BLOCK = 16_384, 4_096
_STEP = 256
#: Ids of one vector are first cut to the needed few in so many groups, so no task holds a frequent vector.
_SALTS = 64


@lru_cache(maxsize=8)
def rotation(dimensions: int, bits: int, seed: int) -> np.ndarray:
    """(bits, dimensions) with orthonormal columns, drawn at random: a rotation of the vectors padded with zeros."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dimensions]).standard_normal((bits, dimensions)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed codes, lengths, correction): the signs of the rotated vectors, their lengths, and the inner products of the
    unit vectors with their codes, by which estimates are divided."""
    n, d = vectors.shape
    bits = -(-max(CODE_BITS, d) // 8) * 8
    turned = vectors.astype(np.float64) @ rotation(d, bits, seed).T
    lengths = np.linalg.norm(turned, axis=1)
    correction = np.abs(turned).sum(axis=1) / np.sqrt(bits) / np.where(lengths > 0, lengths, 1)
    return np.packbits(turned > 0, axis=1), lengths, np.where(lengths > 0, correction, 1.0)


def bounds(codes: np.ndarray, lengths: np.ndarray, correction: np.ndarray, questions: np.ndarray, confidence: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (questions x rows) of the squared distances.

    The inner product of two unit vectors is estimated by that of the question with the code, over the correction; it is
    off by more than confidence * sqrt((1 - c^2) / c^2 / (bits - 1)) with a chance that falls exponentially in the square
    of ``confidence``.
    """
    d = questions.shape[1]
    bits = codes.shape[1] * 8
    asked = questions.astype(np.float64) @ rotation(d, bits, seed).T
    asked_lengths = np.linalg.norm(asked, axis=1)
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    found = (asked / np.where(asked_lengths > 0, asked_lengths, 1)[:, None] / np.sqrt(bits)).astype(np.float32) @ signs.T / correction[None, :]
    error = confidence * np.sqrt(np.maximum(1 - correction**2, 0) / correction**2 / (bits - 1))
    both = 2 * asked_lengths[:, None] * lengths[None, :]
    sums = asked_lengths[:, None] ** 2 + lengths[None, :] ** 2
    return sums - both * np.minimum(found + error, 1), sums - both * np.maximum(found - error, -1)


def _distances(x: np.ndarray, question: np.ndarray) -> np.ndarray:
    """Euclidean distances. Where squares would leave the range of a double the components are scaled by the largest one, so
    only a distance beyond that range itself is infinite."""
    with np.errstate(over="ignore", under="ignore"):
        gaps = x - question
        largest = np.abs(gaps).max(axis=1)
        found = np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
        odd = np.flatnonzero((largest > 1e150) | (largest > 0) & (largest < 1e-150))
        if len(odd):
            up = np.where(largest[odd] > 1, 0.25, 1.0)[:, None]
            gaps = x[odd] * up - question * up
            largest = np.abs(gaps).max(axis=1)
            gaps /= largest[:, None]
            found[odd] = largest * np.sqrt(np.einsum("ij,ij->i", gaps, gaps)) / up[:, 0]
    return found


def _distinct(rows: DataFrame, most: int) -> DataFrame:
    """One row per distinct vector: dims, vector and its ``most`` smallest ids, as structs (vec_id, row)."""
    key = ["dims", "vector"]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(_SALTS)))
    first = salted.withColumn("nth", F.row_number().over(Window.partitionBy(*key, "salt").orderBy(F.col("vec_id").asc_nulls_last(), "row"))).filter(F.col("nth") <= most)
    return (first.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "row"))).alias("ids"))
            .withColumn("ids", F.slice("ids", 1, most)))


def search(vectors: DataFrame, is_question, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", confidence: float = 3.0, seed: int = 0) -> DataFrame:
    """(query_id, query_row, rank, vec_id, score): the ``k`` nearest found of every row that ``is_question`` (a condition on id_col) holds for.

    Score is the Euclidean distance of the vectors as they are, in double precision; ties go to the smaller id. Vectors
    that are null, empty, zero, or hold a null or a value that is not finite take no part; vectors of different length
    are not compared. Every other row is indexed; equal vectors are one entry, with the k + 1 smallest ids. Rows are
    told apart, also those with equal ids, and a row is not its own neighbour. Vectors are centred on the mean of
    those of their length.

    Entries meet the questions in parts and blocks of bounded size. A part is coded; in it, entries whose lower bound is
    above the (k + 1)-th smallest upper bound are left out, the others are measured exactly. Nothing else is cut off. Where
    components are so large that a bound overflows, it cuts nothing off. Distances beyond the range of a double are infinite
    and rank last. An empty table, or one without questions, gives an empty one; other columns of any name are not read.
    """
    value = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = stage(vectors.select(F.col(id_col).alias("vec_id"), value.alias("vector")).filter(F.col("vector").isNotNull() & (F.size("vector") > 0))
                 .filter(finite).filter(F.exists("vector", lambda x: x != 0)).withColumn("dims", F.size("vector")).withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    entries = stage(_distinct(rows, k + 1).withColumn("entry", F.monotonically_increasing_id()), "ann-entries")
    asked = stage(rows.withColumn("__ask", is_question(F.col("vec_id"))).filter("__ask").drop("__ask"), "ann-questions")
    id_kind = rows.schema["vec_id"].dataType.simpleString()
    parts = max(1, -(-entries.count() // _PART))
    blocks = max(1, -(-asked.count() // _BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Both sides' keys are ints: an int and a long of one value hash differently, and their groups would not meet.
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    left = entries.select("dims", "entry", "vector", dealt("entry", parts).alias("part"), every(blocks).alias("block"))
    right = asked.select("dims", "row", "vector", every(parts).alias("part"), dealt("row", blocks).alias("block"))

    def meet(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(asking):
            x, q = np.stack(own["vector"].to_numpy()), np.stack(asking["vector"].to_numpy())
            centre = (x / len(x)).sum(axis=0)
            with np.errstate(over="ignore", invalid="ignore"):
                codes = encode(x - centre, seed)
            entry, row = own["entry"].to_numpy(), asking["row"].to_numpy()
            for at in range(0, len(q), _STEP):
                with np.errstate(over="ignore", invalid="ignore"):
                    low, high = bounds(*codes, q[at:at + _STEP] - centre, confidence, seed)
                sure = np.isfinite(low) & np.isfinite(high)
                low, high = np.where(sure, low, -np.inf), np.where(sure, high, np.inf)
                enough = np.partition(high, min(k, len(x) - 1), axis=1)[:, min(k, len(x) - 1)]
                for i in range(len(low)):
                    chosen = np.flatnonzero(low[i] <= enough[i])
                    exact = _distances(x[chosen], q[at + i])
                    # Ties at the end all stay: which of them count depends on their ids.
                    limit = np.partition(exact, min(k, len(exact) - 1))[min(k, len(exact) - 1)]
                    kept = exact <= limit
                    out.append(pd.DataFrame({"row": row[at + i], "entry": entry[chosen[kept]], "score": exact[kept]}))
        return pd.concat(out) if out else pd.DataFrame({"row": pd.Series(dtype="int64"), "entry": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    found = stage(left.groupBy("dims", "part", "block").cogroup(right.groupBy("dims", "part", "block")).applyInPandas(meet, "row long, entry long, score double"), "ann-found")
    # The k + 1 nearest entries hold the k nearest rows beside the question's own; equal scores stay together.
    near = found.withColumn("place", F.rank().over(Window.partitionBy("row").orderBy("score"))).filter(F.col("place") <= k + 1)
    expanded = (near.join(entries.select("entry", "ids"), "entry").select("row", "score", F.explode("ids").alias("id")).filter(F.col("id.row") != F.col("row")))
    ranked = expanded.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy("score", F.col("id.none"), F.col("id.vec_id"), F.col("id.row")))).filter(F.col("rank") <= k)
    return ranked.join(asked.select("row", F.col("vec_id").alias("query_id")), "row").select(
        F.col("query_id").cast(id_kind), F.col("row").alias("query_row"), "rank", F.col("id.vec_id").alias("vec_id"), "score")
