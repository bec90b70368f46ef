"""What the operators share: reading tables, byte views of text columns, joins that split hot keys, components, ranks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from casewright.session import stage

#: The six characters ``[\x20\x09-\x0D]``; ``bytes.split()`` and ``bytes.strip()`` know exactly these.
SPACES = b" \t\n\x0b\x0c\r"
#: A key is hot if it holds at least this share of all rows, so there are at most as many hot keys.
HOT_SHARE = 256
#: Texts handed to one vectorised step; longer ones form a step of their own.
STEP_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null is an empty text."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def release() -> None:
    """Give back what a task no longer holds. A worker lives on, beside a full heap and the workers of other stages, and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``step_bytes`` of ``column``, so that a task's memory does not follow the row count.

    Memory is given back after each of the given batches, as these are large.
    """
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = np.asarray(pa.compute.binary_length(batch.column(at)).fill_null(0), dtype=np.int64)
        parts = np.cumsum(sizes) // step_bytes
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
        del batch
        release()


def nullable_key(column: Column) -> Column:
    """A string that is never null: "" for null, else the value behind an equals sign."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def join_unique(rows: DataFrame, unique: DataFrame, key: str | list[str], count: str, total: int, how: str = "left") -> DataFrame:
    """Join ``unique`` (one row per key, ``count`` = rows of the key among ``total``) to ``rows``.

    The keys that hold 1/256 of the rows or more are at most 256; they are broadcast and never meet in one task.
    The others go through an ordinary join. ``key`` must not be null. ``rows`` is read twice, so stage it first.
    """
    key = [key] if isinstance(key, str) else key
    hot = unique.filter(F.col(count) * HOT_SHARE >= F.lit(total))
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(
        unique.filter(F.col(count) * HOT_SHARE < F.lit(total)), key, how)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def numbered(df: DataFrame, order: list[Column], into: str, name: str) -> DataFrame:
    """Consecutive numbers from 0 along ``order`` without a one-task window: ranges are counted, then numbered by themselves.

    ``order`` must tell all rows apart.
    """
    ranged = stage(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), name)
    within = Window.partitionBy("__range").orderBy(*order)
    counts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    # One row per range, so this window holds as many rows as there are partitions.
    starts = counts.withColumn("__start", F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).drop("__n")
    return (ranged.join(F.broadcast(starts), "__range")
            .withColumn(into, F.col("__start") + F.row_number().over(within) - 1).drop("__range", "__start"))


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of its connected component.

    Alternating large-star and small-star steps; every step is a map-side combined minimum and a join that splits
    hot centres, and is written to the shared folder. The number of rounds grows with the logarithm of the longest path.
    """
    def star(pairs: DataFrame, step: str) -> DataFrame:
        """pairs: (u, v). For each u: m = min(u, its v); give (v, m) for every v, and (u, m)."""
        pairs = stage(pairs.filter("u <> v").distinct(), f"{name}-{step}")
        total = pairs.count()
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        return join_unique(pairs, low, "u", "n", total, "inner").select("u", "v", "m")

    def print_of(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    known = print_of(now)
    for _ in range(most_rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, "large").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = star(large.filter("u <> v"), "small")
        after = stage(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
                      .filter("u <> v").distinct(), f"{name}-after")
        now, before, known = after, known, print_of(after)
        if before == known:
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
