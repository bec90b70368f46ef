"""Row positions and ranks without a single-partition sort, and size-checked small sides.

A rank is computed as (rows in earlier buckets) + (row number inside the bucket).
Buckets are ranges of the sort order, so the result equals one global
``row_number``, but no task holds more than one bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casewright.session import stage

ROWS_PER_BUCKET = 100_000
BYTES_PER_BUCKET = 256 << 20
SMALL_ROWS = 100_000


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as it is.

    Meant for narrow aggregates such as class counts. At most ``max_rows`` + 1
    rows reach the driver; a larger table is joined by shuffle instead.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema))


def _add_offsets(df: DataFrame, within: list[str], bucket: list[str], order: list[Column], name: str) -> DataFrame:
    """row_number inside each (within, bucket) group plus the rows of earlier buckets of ``within``."""
    keys = within + bucket
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    before = W.partitionBy(*within).orderBy(*bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    numbered = df.withColumn("__row", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    joined = numbered.join(small_side(offsets), keys)
    return joined.withColumn(name, (F.col("__row") + F.col("__before")).cast("long")).drop("__row", "__before")


def file_position(df: DataFrame, name: str = "row_position") -> DataFrame:
    """0-based row order of a freshly read file source: by file, split and place in the split."""
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    )
    splits = tagged.groupBy("__file", "__start").agg(
        F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__size"))
    before = W.orderBy("__file", "__start").rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.select(
        "__file", "__start", (F.coalesce(F.sum("__size").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    return (
        tagged.join(small_side(offsets, 1_000_000), ["__file", "__start"])
        .withColumn(name, F.col("__id") + F.col("__shift"))
        .drop("__file", "__start", "__id", "__shift")
    )


def _by_key(df: DataFrame, key: str) -> list[Column]:
    """Order by the key, nulls last, then by the content; ``__tie`` is the content hash."""
    return [F.col(key).asc_nulls_last(), F.col("__tie"), *[F.col(c) for c in df.columns if c not in (key, "__tie")]]


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: its texts and 16 for each other column."""
    return sum([F.coalesce(F.octet_length(c), F.lit(0)).cast("long") if kind in ("string", "binary") else F.lit(16) for c, kind in df.dtypes], F.lit(0))


def _ranges(tagged: DataFrame, key: str, ranges: int) -> DataFrame:
    """``tagged`` (with ``__tie``), staged in sorted ranges; ``__at`` is the range's number << 33 plus the row's place there.

    The ranges are cut in the key's own type, so neighbouring whole numbers beyond 2^53 stay apart. Rows of one key are
    split by their content hash, and equal rows, which nobody can tell apart, by a salt that is written before it is used.
    """
    order = _by_key(tagged, key)
    salted = stage(tagged.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id())), "rows-to-rank")
    placed = salted.repartitionByRange(ranges, order[0], "__tie", "__salt").sortWithinPartitions(*order)
    return stage(placed.drop("__salt").withColumn("__at", F.monotonically_increasing_id()), "ranked-rows")


def _placed(tagged: DataFrame, key: str, name: str, rows_per_bucket: int) -> DataFrame:
    """``tagged`` with the 0-based position along ``_by_key``, in ranges of bounded rows and bytes."""
    n, size = tagged.agg(F.count(F.lit(1)), F.sum(_row_bytes(tagged))).first()
    ranges = max(math.ceil(n / rows_per_bucket), math.ceil((size or 0) / BYTES_PER_BUCKET))
    if ranges <= 1:
        row = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*_by_key(tagged, key)))
        return tagged.withColumn(name, (row - 1).cast("long"))
    placed = _ranges(tagged, key, ranges).withColumn("__range", F.shiftright("__at", 33))
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    place = F.col("__at").bitwiseAND((1 << 33) - 1)
    return placed.join(small_side(starts), "__range").withColumn(name, F.col("__start") + place).drop("__range", "__at", "__start")


def key_position(
    df: DataFrame, key: str, name: str = "row_position", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """0-based position in the order of a key; nulls come last, rows with equal keys are ordered by their content.

    Rows move once, to sampled ranges of the order; a hot key, nulls and copies of one row included, fills many ranges.
    """
    return _placed(df.withColumn("__tie", F.xxhash64(*df.columns)), key, name, rows_per_bucket).drop("__tie")


def shuffled_rank(
    df: DataFrame, group: str, key: str, seed: int, name: str = "rank", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """1-based rank inside each group in the pseudo-random order md5(key, seed).

    A large group is split by md5 prefix, so one dominant class is still ranked
    by many tasks. Adds the group size as ``group_size``.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    largest = sizes.agg(F.max("group_size")).first()[0] or 0
    digits = 0 if largest <= rows_per_bucket else math.ceil(math.log(largest / rows_per_bucket, 16))
    tagged = df.join(small_side(sizes), group).withColumn("__md5", digest)
    order = [F.col("__md5"), F.col(key)]
    if digits == 0:
        row = F.row_number().over(W.partitionBy(group).orderBy(*order))
        return tagged.withColumn(name, row.cast("long")).drop("__md5")
    tagged = tagged.withColumn("__prefix", F.substring("__md5", 1, digits))
    return _add_offsets(tagged, [group], ["__prefix"], order, name).drop("__md5", "__prefix")


def limit_rows(df: DataFrame, n: int, key: str, heap_rows: int = 10_000, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The first ``n`` rows by key, nulls last, equal keys by content.

    Small limits use a heap per task. For large ones only (key, content hash) is ranked, to find the last row that stays; whole
    rows stay where they are, but for those equal to the last one. Both ways give the same rows.
    """
    tagged = df.withColumn("__tie", F.xxhash64(*df.columns))
    if n <= heap_rows:
        return tagged.orderBy(*_by_key(df, key)).limit(n).drop("__tie")
    ranked = _placed(tagged.select(key, "__tie"), key, "__position", rows_per_bucket)
    last = ranked.filter(F.col("__position") == n - 1).first()
    if last is None:
        return df
    value, tie = F.lit(last[key]).cast(df.schema[key].dataType), F.col("__tie")
    same = F.col(key).eqNullSafe(value)
    earlier = F.col(key).isNotNull() if last[key] is None else F.coalesce(F.col(key) < value, F.lit(False))
    first = ranked.filter(same & (tie == last["__tie"])).agg(F.min("__position")).first()[0]
    edge = _placed(tagged.filter(same & (tie == last["__tie"])), key, "__position", rows_per_bucket)
    return tagged.filter(earlier | (same & (tie < last["__tie"]))).drop("__tie").unionByName(
        edge.filter(F.col("__position") < n - first).drop("__tie", "__position"))
