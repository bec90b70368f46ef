"""Mixes sources to target weights by entropy balancing (operator 4). DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm.common import join_unique, nullable_key, numbered
from casewright.session import stage

_WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources, repeating in their order.
WEIGHTS = (5, 2, 1)
#: Rates and sums are kept in units of 2**-30, as whole numbers: sums then do not depend on the order of the rows.
_UNIT = 1 << 30
#: Documents rounded together, about.
_BUCKET = 4096


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, version (a hash of the text), source_key and size in words for every row."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(source_col).cast("string").alias("source"),
                       nullable_key(F.col(source_col)).alias("source_key"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(_WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source_key, source_size, n_docs and target (in words) of every source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words. No target is above
    ``most`` times its source's size; what is cut off goes to the others by weight, again and again, until none is above.
    """
    sources = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = numbered(sources, [F.col("source").isNull(), F.col("source")], "rank", "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(ranked.select("source_key", "source_size", "n_docs", weight.cast("long").alias("weight")), "mix-weights")
    whole = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    limit = F.col("source_size") * most
    # A source whose fair level was above its limit once stays above, as the level of the rest only rises. The level
    # is what a unit of weight gets.
    level, full = None, F.lit(False)
    while True:
        free, taken = table.agg(F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.coalesce(F.sum(F.when(full, limit)), F.lit(0))).first()
        if not free:
            break
        before, level = level, (whole - taken) / free
        full = F.lit(level) * F.col("weight") > limit
        if level == before:
            break
    target = limit.cast("double") if level is None or not free else F.when(full, limit.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return table.select("source_key", "source_size", "n_docs", target.alias("target"))


def _rate(tilt: Column, size: Column, mean: Column, most: int) -> Column:
    """Exponentially tilted rate of a document: e^(tilt * size / mean size), ``most`` at most."""
    return F.least(F.exp(F.least(tilt * size / mean, F.lit(50.0))), F.lit(float(most)))


def tilts(sizes: DataFrame, aims: DataFrame, most: int = 2, most_rounds: int = 200) -> DataFrame:
    """source_key, source_size, n_docs, target, tilt and mean: the solution of the convex dual, one multiplier per source.

    The rates nearest to 1 in relative entropy whose words sum to the targets, none above ``most``, are e^(tilt * size /
    mean). The tilt of a source is a zero of an increasing function: the logarithm of the sum of size * rate, less that of
    the target. All sources take a Newton step together in each round, over the counts of equal (source, size), until
    none is open. A step that leaves the bracket of the root is replaced by its middle; while an end of the bracket is not
    known, steps up, and those without a slope, are bounded by a span that doubles. Raises if a source stays open. A tilt
    is null for a source that takes everything ``most`` times.
    """
    counts = stage(sizes.filter("size > 0").groupBy("source_key", "size").agg(F.count("*").alias("n")), "mix-histogram")
    total = counts.count()
    per_source = counts.groupBy("source_key").agg(F.count("*").alias("n_sizes"))
    state = stage(aims.join(per_source, "source_key", "left").withColumn("n_sizes", F.coalesce("n_sizes", F.lit(0)))
                  .withColumn("mean", F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1)))
                  .withColumn("open", (F.col("source_size") > 0) & (F.col("target") < most * F.col("source_size")))
                  .withColumn("tilt", F.when(F.col("open"), F.lit(0.0)))
                  .withColumn("low", F.lit(-math.inf)).withColumn("high", F.lit(math.inf)), "mix-state")
    for k in range(most_rounds):
        rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
        whole = lambda x: F.sum(F.round(x * 1024).cast("decimal(28,0)"))  # noqa: E731  (whole numbers add up the same in any order)
        sums = (join_unique(counts, state.filter("open").select("source_key", "tilt", "mean", "n_sizes"), "source_key", "n_sizes", total, "inner")
                .groupBy("source_key").agg(whole(words).alias("words"), whole(slope).alias("slope")))
        reached, slope = (F.col(c).cast("double") / 1024 for c in ("words", "slope"))
        gap = reached - F.col("target")
        low, high = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")), F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        # Below 0 no rate is cut, so the logarithm is convex and a step down does not pass the root; a step up may go too far.
        span = F.lit(2.0 ** (k + 1))
        bounded = F.least(F.col("tilt") - F.log(reached / F.col("target")) * F.try_divide(reached, slope), F.col("tilt") + span)
        after = (F.when((F.col("words") > 0) & (F.col("slope") > 0) & (bounded > low) & (bounded < high), bounded)
                 .when(low == -math.inf, F.col("tilt") - span).when(high == math.inf, F.col("tilt") + span).otherwise((low + high) / 2))
        done = (F.abs(gap) <= F.lit(0.25)) | (high - low < 1e-13 * F.greatest(F.abs(F.col("tilt")), F.lit(1.0)))
        state = stage(state.join(sums, "source_key", "left").select(
            "source_key", "source_size", "n_docs", "n_sizes", "target", "mean", (F.col("open") & ~F.coalesce(done, F.lit(True))).alias("open"),
            F.when(F.col("open") & ~done, after).otherwise(F.col("tilt")).alias("tilt"),
            F.when(F.col("open"), low).otherwise(F.col("low")).alias("low"), F.when(F.col("open"), high).otherwise(F.col("high")).alias("high")), f"mix-state-{k}")
        if state.filter("open").isEmpty():
            break
    else:
        raise RuntimeError("the tilts did not settle")
    return state.select("source_key", "source_size", "n_docs", "target", "tilt", "mean")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, most: int = 2,
        weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """id, version, source_key, size, source_size, target, copies and taken (copies * size) for every row of ``docs``.

    Rates are rounded into copies within buckets of some thousand documents of a source, by size: a document gets the
    whole numbers that the running sum of rates passes at it, so each bucket's copies match its rates to one document,
    and neighbours in size make up for each other. All sums are whole numbers, so runs agree.

    A null text has size 0; documents without words are not taken. Null sources form one source, the last. Repeated rows
    count and are rounded each; rows alike in id, text and source may swap their copies. An empty table gives an empty one.
    """
    sizes = stage(sized(docs, id_col, text_col, source_col), "mix-sizes")
    total = sizes.count()
    solved = stage(tilts(sizes, targets(sizes, share, most, weights), most), "mix-tilts")
    rows = join_unique(sizes, solved, "source_key", "n_docs", total, "inner")
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("tilt").isNull(), F.lit(float(most))).otherwise(
        _rate(F.col("tilt"), F.col("size"), F.col("mean"), most))
    bucket = F.pmod(F.xxhash64("id", "version", "source_key"), F.ceil(F.col("n_docs") / _BUCKET))
    rated = rows.withColumn("rate", F.round(rate * _UNIT).cast("long")).withColumn("bucket", bucket)
    upto = F.sum("rate").over(Window.partitionBy("source_key", "bucket").orderBy("size", "id", "version").rowsBetween(Window.unboundedPreceding, 0))
    half = _UNIT // 2
    passed = F.floor((upto + half) / _UNIT) - F.floor((upto - F.col("rate") + half) / _UNIT)
    return (rated.withColumn("copies", F.least(passed, F.lit(most)).cast("long"))
            .select("id", "version", "source_key", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """Every row of ``docs`` as often as the mix takes it, with its columns. Rows alike in id, text and source are told apart by
    number; all others are joined to their copies directly, which shuffles the texts once. ``docs`` must not have columns whose
    names begin with two underscores."""
    key = ["__id", "__version", "__source"]
    mixed = stage(mix(docs, id_col, text_col, source_col, **how).select(
        F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("source_key").alias("__source"), F.col("copies").cast("int").alias("__copies")), "mix-copies")
    groups = mixed.groupBy(*key).agg(F.count("*").alias("__rows"), F.max("__copies").alias("__copies"))
    keyed = docs.withColumn("__v", F.xxhash64(text_col)).withColumn("__s", nullable_key(F.col(source_col)))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__v") == F.col("__version")) & (F.col("__s") == F.col("__source"))
    copied = lambda joined: joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
    single = copied(keyed.join(groups.filter("__rows = 1 AND __copies > 0").drop("__rows"), same))
    alike = stage(groups.filter("__rows > 1").select(*key), "mix-alike")
    if alike.isEmpty():
        return single

    def nth(*columns: str) -> Column:
        return F.row_number().over(Window.partitionBy(*columns).orderBy(F.lit(0)))

    taken = mixed.join(alike, [F.col(c).eqNullSafe(alike[c]) for c in key], "left_semi").withColumn("__nth", nth(*key)).filter("__copies > 0")
    rows = keyed.join(alike, same, "left_semi").withColumn("__n", nth(id_col, "__v", "__s"))
    return single.unionByName(copied(rows.join(taken, same & (F.col("__n") == F.col("__nth")))))
