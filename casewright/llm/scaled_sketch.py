"""Threshold-scaled document fingerprints (operator 12): every shingle hash below a fixed fraction of the hash range is kept.

As the threshold is the same for all documents, the sketch of two texts together is made from their two sketches, and the
share of one sketch found in the other estimates how much of one text is in the other, however unequal they are.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.functions.binding import let
from casewright.session import stage

_WORD = r"[^\x20\x09-\x0D]+"
#: Share of the hash range whose hashes are kept.
FRACTION = 1 / 8
_RANGE = 1 << 63


def _limit(fraction: float) -> int:
    if not 0 < fraction <= 1:
        raise ValueError("the fraction must be above 0 and at most 1")
    return min(int(_RANGE * fraction), _RANGE - 1)


def _kept(hashes: Column, fraction: float) -> Column:
    """Distinct hashes below the threshold in order; the smallest one where none is below it."""
    limit = F.lit(_limit(fraction))
    return let(hashes, lambda all_of: let(F.filter(all_of, lambda h: h < limit), lambda low: F.when(
        F.size(low) > 0, F.sort_array(F.array_distinct(low))).when(F.size(all_of) > 0, F.array(F.array_min(all_of))).otherwise(low)))


def sketch(text: Column, fraction: float = FRACTION, words_per_shingle: int = 5) -> Column:
    """The kept 63-bit hashes of a text's word shingles, ascending.

    A text with fewer words than a shingle has one shingle, all its words; null or a text without words has none. Where no
    hash is below the threshold the smallest is kept, so only texts without words have an empty sketch.
    """
    def hashes(words: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(words) - words_per_shingle, F.lit(0)))
        shingles = F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(words_per_shingle))).bitwiseAND(F.lit(_RANGE - 1)))
        return F.when(F.size(words) > 0, shingles).otherwise(F.array().cast("array<bigint>"))

    return _kept(let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0)), hashes), fraction)


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of the two documents' shingles together, from their sketches alone."""
    return _kept(F.array_union(a, b), fraction)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first document's shingles that are in the second: 0 to 1.

    A sketch without hashes (a text without words) is wholly in another one without, and not at all in any other.
    """
    return F.when(F.size(a) == 0, (F.size(b) == 0).cast("double")).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of either document that are in both."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def printed(hashes: Column) -> Column:
    """A sketch as text: 16 lower-case hex digits for each hash."""
    return F.lower(F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION, words_per_shingle: int = 5) -> DataFrame:
    """id, sketch and fingerprint (its text form) of every document. Map-only; nulls, repeated rows and ids stay as they are."""
    found = docs.select(F.col(id_col).alias("id"), sketch(F.col(text_col), fraction, words_per_shingle).alias("sketch"))
    return found.withColumn("fingerprint", printed(F.col("sketch")))


def _in_buckets(texts: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None, int]:
    """The texts dealt to buckets along (id, version), each with the row before its first; hot rows by themselves; bucket count.

    The narrow (id, version) rows are ranged first; only the ranges' ends (two rows each) come to the driver. A group of
    equal rows that fills a quarter of a bucket or more (so 4 * ``most`` groups at most) is left as one row here: the row before
    each of the others is its equal, so those are returned apart, as one row with their number.
    """
    spark = texts.sparkSession
    keys = stage(texts.select("id", "version"), "sketch-keys")
    total = keys.count()
    id_type = keys.schema["id"].dataType.simpleString()
    hot = [tuple(r) for r in keys.groupBy("id", "version").count().filter((F.col("count") > 1) & (F.col("count") * 4 * most >= total)).collect()]
    copies = None
    if hot:
        listed = F.broadcast(spark.createDataFrame(hot, f"hot_id {id_type}, hot_version long, copies long"))
        same = [F.col("id").eqNullSafe(F.col("hot_id")), F.col("version") == F.col("hot_version")]
        one = stage(texts.join(listed, same).groupBy("id", "version", "copies").agg(F.first("text").alias("text")), "sketch-hot")
        copies = one.withColumn("copies", F.col("copies") - 1)
        texts = texts.join(listed, same, "left_anti").unionByName(one.drop("copies"))
        keys = keys.join(listed, same, "left_anti").unionByName(one.select("id", "version"))

    place = F.struct("id", "version")
    ranges = (keys.repartitionByRange(most, "id", "version").withColumn("range", F.spark_partition_id())
              .groupBy("range").agg(F.min(place).alias("low"), F.max(place).alias("high")).orderBy("range").collect())
    if not ranges:
        return texts.withColumns({"bucket": F.lit(0), "kind": F.lit(1)}), copies, 1
    here = F.struct(F.col("id"), F.col("version"))
    lows = F.array(*(F.struct(F.lit(r["low"]["id"]).cast(id_type).alias("id"), F.lit(r["low"]["version"]).alias("version")) for r in ranges))
    bucket = F.size(F.filter(lows, lambda low: low <= here)) - 1
    ends = F.broadcast(spark.createDataFrame([((k + 1) % len(ranges), r["high"]["id"], r["high"]["version"]) for k, r in enumerate(ranges)],
                                             f"bucket int, end_id {id_type}, end_version long"))
    before = (texts.join(ends, [F.col("id").eqNullSafe(F.col("end_id")), F.col("version") == F.col("end_version")])
              .groupBy("bucket", "id", "version").agg(F.first("text").alias("text")).withColumn("kind", F.lit(0)))
    return texts.withColumns({"bucket": bucket, "kind": F.lit(1)}).unionByName(before), copies, len(ranges)


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = 3, fraction: float = FRACTION,
                    words_per_shingle: int = 5) -> DataFrame:
    """Every document's fingerprint against that of its edited text and that of the next document.

    The next document has the next smaller id, that of the last is the first; null ids come last, equal ids go by the hash
    of the text. The edited text has its last floor(n_chars / ``part``) code points replaced by the first as many of the next
    document. Returned, one row per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next
    (``containment`` of the document's sketch in the other's).

    A null text is empty; an empty table gives no rows; a single document is its own next; other columns are ignored. Whole texts
    are dealt once, to buckets of equal numbers of rows along the ids, whatever their length; a row has to fit in memory a few
    times over, as its words and their hashes are arrays.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("version", F.xxhash64("text"))
    dealt, copies, buckets = _in_buckets(texts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = lambda text: sketch(F.col(text), fraction, words_per_shingle)
    order = Window.partitionBy("bucket").orderBy("kind", "id", "version")
    rows = (dealt.repartitionById(buckets, "bucket").withColumn("sketch", made("text"))
            .withColumns({"next_text": F.lag("text").over(order), "next_sketch": F.lag("sketch").over(order)}).filter("kind = 1"))
    # An empty text has an empty cut, so its own text stands in where a table holds one row only.
    rows = rows.select("id", "text", "sketch", F.lit(1).alias("times"), F.coalesce("next_text", "text").alias("next_text"),
                       F.coalesce("next_sketch", "sketch").alias("next_sketch"))
    if copies is not None:
        own = copies.select("id", "text", made("text").alias("sketch"), "copies")
        rows = rows.unionByName(own.select("id", "text", "sketch", F.col("copies").alias("times"), F.col("text").alias("next_text"),
                                           F.col("sketch").alias("next_sketch")))
    cut = F.floor(F.length("text") / part).cast("int")
    edited = (rows.withColumn("n_chars", F.length("text").cast("long"))
              .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut)))
              .withColumn("edited_sketch", made("edited")))
    found = edited.select("id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), printed(F.col("sketch")).alias("fingerprint"),
                          printed(F.col("edited_sketch")).alias("edited_fingerprint"), containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                          containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"), "times")
    if copies is not None:
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("copy")
    return found.drop("times")
