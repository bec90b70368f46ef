"""Trie of conversation prefixes by composable fingerprints (operator 11).

A conversation is rebuilt as the head of a base conversation and its own turns after that. Its text is never put
together: the fingerprint of a run of turns is a pair (length, value) with (a, x) + (b, y) = (a + b, x * M**b + y) modulo
a prime, so a prefix of the rebuilt conversation is the product of a prefix of the base and a run of its own turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm import bloom
from casewright.llm.common import join_unique
from casewright.session import stage

#: Fingerprints are numbers below this Mersenne prime.
PRIME = (1 << 127) - 1
#: Turns of a conversation kept in one row; a head is at most so long.
RUN = 1024
#: Bytes of joined ids in one row while ends are hashed.
_PIECE = 4096
_FLUSH = 1 << 16
_LOW = (1 << 64) - 1
_NODE = ["depth", "fp1", "fp2"]
_ROWS = "depth long, fp1 long, fp2 long, up1 long, up2 long, conv long, k1 long, k2 long, bytes long, ends long"
_PRODUCTS = "conv long, at long, length long, hi long, lo long"


class Collision(RuntimeError):
    """Two different prefixes or turns had the same fingerprint."""


def base_of_five(conv: Column) -> Column:
    return conv - conv % 5


def head_by_crc(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % 9


def combine(left: tuple[int, int], right: tuple[int, int], base: int, prime: int) -> tuple[int, int]:
    """The fingerprint of one run of turns followed by another."""
    return left[0] + right[0], (left[1] * pow(base, right[0], prime) + right[1]) % prime


def _multiplier(seed: int, prime: int) -> int:
    return 2 + int.from_bytes(hashlib.sha256(f"prefix-trie {seed}".encode()).digest(), "big") % (prime - 3)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array([v & _LOW for v in values], dtype=np.uint64).view(np.int64))


def _numbers(high: list[int], low: list[int]) -> list[int]:
    return [(a & _LOW) << 64 | (b & _LOW) for a, b in zip(high, low)]


def stored_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, seed: int) -> DataFrame:
    """conv, turn, role, k1 and k2 (two hashes of role and text) and bytes of every turn; no text."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return turns.filter(F.col(conv_col).cast("long").isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).select(
        "conv", "turn", "role", "text", F.xxhash64(F.lit(2 * seed), "role", "text").alias("k1"),
        F.xxhash64(F.lit(2 * seed + 1), "text", "role").alias("k2"), F.octet_length("text").cast("long").alias("bytes"))


def positions(stored: DataFrame) -> DataFrame:
    """``pos`` from 1 within each conversation, by turn (null first), then role, then hash of the content.

    The sort is split by range, so a conversation with a large part of all turns is in several tasks. What each range holds
    of its first and last conversation (one row a range) carries the numbers on to the next range.
    """
    order = ["turn", "role", "k1", "k2", "row"]
    ranged = stage(stored.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("conv", *order)
                   .withColumn("range", F.spark_partition_id()), "trie-ranged")
    ends = (ranged.groupBy("range", "conv").agg(F.count("*").alias("n")).groupBy("range")
            .agg(F.min("conv").alias("first"), F.max(F.struct("conv", "n")).alias("last")).orderBy("range").collect())
    carried, open_conv, so_far = [], None, 0
    for r in ends:
        if r["first"] == open_conv:
            carried.append((r["range"], r["first"], so_far))
        so_far = r["last"]["n"] + (so_far if r["last"]["conv"] == open_conv else 0)
        open_conv = r["last"]["conv"]
    offsets = stored.sparkSession.createDataFrame(carried, "range int, conv long, before long")
    within = Window.partitionBy("range", "conv").orderBy(*order)
    return (ranged.withColumn("pos", F.row_number().over(within).cast("long")).join(F.broadcast(offsets), ["range", "conv"], "left")
            .select("conv", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "k1", "k2", "bytes"))


def runs_of(placed: DataFrame) -> DataFrame:
    """One row for every ``RUN`` turns of a conversation: conv, at (number of the run) and its turns in order."""
    return (placed.groupBy("conv", F.expr(f"(pos - 1) div {RUN}").alias("at"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "bytes"))).alias("turns")))


def _lists(column: pa.ListArray) -> Iterator[tuple[list[int], list[int]]]:
    """The turns of each row as (numbers, bytes); a null list is empty."""
    cut = column.offsets.to_pylist()
    cells = column.values
    k1, k2, size = (cells.field(n).to_pylist() for n in ("k1", "k2", "bytes"))
    valid = column.is_valid().to_pylist()
    for a, b, there in zip(cut, cut[1:], valid):
        yield (_numbers(k1[a:b], k2[a:b]), size[a:b]) if there else ([], [])


def run_products(runs: DataFrame, base: int, prime: int) -> DataFrame:
    """The product of each run's own turns; of the first run, of those after the head."""
    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, high, low = [], [], []
            for (numbers, _), at, h in zip(_lists(batch.column("turns")), batch.column("at").to_pylist(), batch.column("h").to_pylist()):
                own = numbers[h:] if at == 0 else numbers
                value = 0
                for t in own:
                    value = (value * base + t) % prime
                length.append(len(own)), high.append(value >> 64), low.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("at"), pa.array(length, pa.int64()), _signed(high), _signed(low)],
                                             names=["conv", "at", "length", "hi", "lo"])

    return runs.mapInArrow(product, _PRODUCTS)


def before_runs(products: DataFrame, base: int, prime: int) -> DataFrame:
    """What of its conversation's own turns lies before each run: the scan over the runs' products.

    A conversation has one row in ``RUN`` here, 40 bytes each, so even one with a third of all turns is a small group.
    """
    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        state, length, high, low = (0, 0), [], [], []
        for n, a, b in zip(rows["length"].tolist(), rows["hi"].tolist(), rows["lo"].tolist()):
            length.append(state[0]), high.append(state[1] >> 64), low.append(state[1])
            state = combine(state, (n, _numbers([a], [b])[0]), base, prime)
        return pd.DataFrame({"conv": rows["conv"], "at": rows["at"], "length": length, "hi": _signed(high).to_numpy(), "lo": _signed(low).to_numpy()})

    return products.groupBy("conv").applyInPandas(scan, _PRODUCTS)


def members(runs: DataFrame, base: int, prime: int) -> DataFrame:
    """One row for every conversation and depth: the prefix's fingerprint, that of the prefix without its last turn, the last
    turn's hashes and bytes, and whether the conversation ends there. ``runs`` has h, n, head and before_* beside the turns."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            scalars = [batch.column(c).to_pylist() for c in ("conv", "at", "h", "n", "length", "hi", "lo")]
            for conv, at, h, n, length, hi, lo, (head, head_bytes), (own, own_bytes) in zip(
                    *scalars, _lists(batch.column("head")), _lists(batch.column("turns"))):
                whole = len(head) + max(0, n - h)
                if at == 0:
                    depth, state = 0, 0
                    _add(out, 0, 0, None, conv, None, 0, whole == 0)
                    todo = zip(head + own[h:], head_bytes + own_bytes[h:])
                else:
                    state = 0
                    for t in head:
                        state = (state * base + t) % prime
                    depth, state = combine((len(head), state), (length, _numbers([hi], [lo])[0]), base, prime)
                    todo = zip(own, own_bytes)
                for t, size in todo:
                    up, depth = state, depth + 1
                    state = (state * base + t) % prime
                    _add(out, depth, state, up, conv, t, size, depth == whole)
                if len(out[0]) >= _FLUSH:
                    yield _batch(out)
                    out = [[] for _ in range(10)]
            yield _batch(out)

    return runs.mapInArrow(rows, _ROWS)


def _add(out, depth, state, up, conv, turn, size, ends) -> None:
    pair = lambda x: (None, None) if x is None else (x >> 64, x & _LOW)
    for column, value in zip(out, (depth, *pair(state), *pair(up), conv, *pair(turn), size, int(ends))):
        column.append(value)


def _batch(out: list[list]) -> pa.RecordBatch:
    """The 64-bit halves are unsigned here and signed in the table; only the root has nulls among them."""
    def column(values: list, name: str) -> pa.Array:
        if name not in ("fp1", "fp2", "up1", "up2", "k1", "k2"):
            return pa.array(values, pa.int64())
        bits = np.array([0 if v is None else v for v in values], dtype=np.uint64).view(np.int64)
        return pa.array(bits, mask=np.array([v is None for v in values], dtype=bool))

    names = [x.split()[0] for x in _ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([column(v, n) for v, n in zip(out, names)], names=names)


def check_turns(texts: DataFrame, n_turns: int) -> None:
    """Turns of one hash pair must be one (role, text): those whose hash may occur twice are compared by their whole text."""
    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(batch.column("k1")).view(np.uint64)

    twice = bloom.share(texts, bloom.build(texts.select("k1"), hashes, bloom.bits_for(n_turns), "trie-filter")[1])

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.holds(twice.value, hashes(batch))))

    wide = texts.select("k1", "k2", "role", "text")
    if not wide.mapInArrow(suspected, wide.schema).distinct().groupBy("k1", "k2").count().filter("count > 1").isEmpty():
        raise Collision("two turns with one hash")


def ends_hashes(ends: DataFrame) -> DataFrame:
    """depth, fp1, fp2, n and ends_sha256 of every node at which a conversation ends: the hash of their ids, ascending.

    Ids are joined into pieces of 4 KB in ranges of (node, id), so a node at which a third of all conversations end is split;
    SHA-256 itself has to run over its pieces one after the other, which one task does as a stream.
    """
    key = [*_NODE, "conv"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"depth": [node[0]], "fp1": [node[1]], "fp2": [node[2]], "conv": [first], "n": [len(ids)],
                                               "ids": [",".join(ids)]})

        for batch in batches:
            done = []
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in key)):
                if at != node or size > _PIECE:
                    if ids:
                        done.append(piece())
                    node, first, ids, size = at, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, n, state = None, 0, None
        names = [*_NODE, "n", "ends_sha256"]
        for batch in batches:
            done = []
            for *at, more, ids in zip(*(batch.column(c).to_pylist() for c in [*_NODE, "n", "ids"])):
                if at != node:
                    if node:
                        done.append((*node, n, state.hexdigest()))
                    node, n, state = at, 0, hashlib.sha256()
                state.update((("," if n else "") + ids).encode())
                n += more
            if done:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*done)))))
        if node:
            yield pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in (*node, n, state.hexdigest())))))

    pieces = (ends.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
              .mapInArrow(join, "depth long, fp1 long, fp2 long, conv long, n long, ids string"))
    return (pieces.repartition(*_NODE).sortWithinPartitions(*key)
            .mapInArrow(digest, "depth long, fp1 long, fp2 long, n long, ends_sha256 string"))


def _before_on_path(nodes: DataFrame) -> DataFrame:
    """For every node with two members or more: the weight of the nodes above it that have the same smallest member."""
    shared = nodes.filter("n_convs > 1").select(*_NODE, "conv_id", "weight", F.expr(f"depth div {RUN}").alias("part"))
    parts = shared.groupBy("conv_id", "part").agg(F.sum("weight").alias("part_weight"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("part_weight").over(earlier), F.lit(0)).alias("part_before"))
    above = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return (shared.withColumn("in_part", F.coalesce(F.sum("weight").over(above), F.lit(0))).join(parts, ["conv_id", "part"])
            .select(*_NODE, (F.col("in_part") + F.col("part_before")).alias("before")))


def _tries(turns: DataFrame, columns: tuple[str, str, str, str], base_conv, head_turns, most_head: int, seed: int, prime: int) -> DataFrame:
    multiplier = _multiplier(seed, prime)
    texts = stored_turns(turns, *columns, seed)
    stored = stage(texts.drop("text"), "trie-turns")
    check_turns(texts, stored.count())

    runs = stage(runs_of(positions(stored)), "trie-runs")
    h = F.least(head_turns(F.col("conv")), F.lit(most_head)).cast("long")
    lengths = runs.groupBy("conv").agg(F.sum(F.size("turns")).alias("n")).select("conv", "n", h.alias("h"), base_conv(F.col("conv")).alias("base"))
    heads = runs.filter("at = 0").select(F.col("conv").alias("base"), F.slice("turns", 1, most_head).alias("head"))
    about = lengths.join(heads, "base", "left").select("conv", "n", "h", F.expr("slice(head, 1, cast(h as int))").alias("head"))
    long_ones = runs.join(lengths.filter(F.col("n") > RUN).select("conv", "h"), "conv")
    before = before_runs(run_products(long_ones, multiplier, prime), multiplier, prime)
    rows = stage(members(runs.join(about, "conv").join(before, ["conv", "at"], "left"), multiplier, prime), "trie-members")

    ended = F.when(F.col("ends") == 1, F.col("conv"))
    checks = ["up1", "up2", "k1", "k2"]
    nodes = stage(rows.groupBy(*_NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.sum("ends").alias("n_ends"), F.min(ended).alias("first_end"),
        F.max("bytes").alias("bytes"), *(F.min(c).alias(c) for c in checks),
        F.coalesce(F.expr(" or ".join(f"min({c}) <> max({c})" for c in checks)), F.lit(False)).alias("mixed"))
        .withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes")).select(
        *_NODE, "n_convs", "conv_id", "n_ends", "first_end", "weight", "up1", "up2", "mixed"), "trie-nodes")
    if not nodes.filter("mixed").isEmpty():
        raise Collision("two prefixes with one fingerprint")

    # A node belongs to its smallest member; a conversation's nodes are the lower end of its path. So the nodes below one are
    # those of its members, but for what its own smallest member has above it.
    owners = nodes.groupBy("conv_id").agg(F.sum("weight").alias("weight"), F.max((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaf"))
    owners = stage(owners.join(rows.groupBy(F.col("conv").alias("conv_id")).agg(F.count("*").alias("n")), "conv_id")
                   .withColumnRenamed("conv_id", "conv"), "trie-owners")
    below = join_unique(rows.select(*_NODE, "conv"), owners, "conv", "n", rows.count(), "inner")
    tops = stage(nodes.filter("depth > 0").join(nodes.groupBy("conv_id").agg(F.min("depth").alias("depth")), ["conv_id", "depth"], "left_semi")
                 .select("conv_id", "depth", (F.col("depth") - 1).alias("up0"), "up1", "up2"), "trie-tops")
    sums = (below.select(*_NODE, "weight", "leaf", F.lit(0).alias("tops"))
            .unionByName(tops.select(F.col("up0").alias("depth"), F.col("up1").alias("fp1"), F.col("up2").alias("fp2"), F.lit(0).alias("weight"),
                                     F.lit(0).alias("leaf"), F.lit(1).alias("tops")))
            .groupBy(*_NODE).agg(F.sum("weight").alias("members_weight"), F.sum("leaf").alias("n_leaves"), F.sum("tops").alias("tops")))
    summed = stage(nodes.drop("up1", "up2", "mixed", "weight").join(sums, _NODE), "trie-summed")
    parents = summed.filter("tops > 0").select(F.col("depth").alias("up0"), F.col("fp1").alias("up1"), F.col("fp2").alias("up2"),
                                               F.col("conv_id").alias("parent"), "tops")
    above = join_unique(tops, stage(parents, "trie-parents"), ["up0", "up1", "up2"], "tops", tops.count(), "inner").select("conv_id", "depth", "parent")
    hashes = ends_hashes(rows.filter("ends = 1")).filter("n > 1").drop("n")
    own_end = F.coalesce(F.col("first_end") == F.col("conv_id"), F.lit(False))
    return (summed.join(_before_on_path(nodes), _NODE, "left").join(above, ["conv_id", "depth"], "left").join(hashes, _NODE, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"), "n_convs",
        (F.col("tops") + F.when(own_end, 0).otherwise(1)).alias("n_children"), "n_leaves",
        F.when(F.col("n_convs") == 1, 0).otherwise(F.col("members_weight") - F.col("before")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.coalesce(F.col("first_end").cast("string"), F.lit("")).cast("binary"), 256)).alias("ends_sha256")))


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                base_conv: Callable[[Column], Column] = base_of_five, head_turns: Callable[[Column], Column] = head_by_crc, most_head: int = 8,
                seed: int = 1, attempts: int = 3, prime: int = PRIME) -> DataFrame:
    """The trie of the rebuilt conversations: one row per node.

    Conversation c is rebuilt as the first h = ``head_turns(c)`` turns of ``base_conv(c)`` (all if it has fewer, none if there is
    no such conversation; ``head_turns`` gives at most ``most_head``, which is at most 1,024) and c's own turns after its first h.
    Returned: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn_col`` (null first), ties by role and then by a hash of the content; a repeated row is a turn of its
    own. Null role or text is empty. Rows whose conversation id is null, or not a whole number, belong to no conversation and are
    left out. An empty table gives no rows. Long texts are hashed in the JVM and never meet in one group; other columns are
    ignored. Equality is exact: turns of one hash are compared by text, nodes by their parent and last turn; where two differ the
    work is done again with another seed, and after ``attempts`` a ``Collision`` is raised.
    """
    if most_head > RUN:
        raise ValueError(f"a head has at most {RUN} turns")
    for attempt in range(attempts):
        try:
            return _tries(turns, (conv_col, turn_col, role_col, text_col), base_conv, head_turns, most_head, seed + attempt, prime)
        except Collision:
            if attempt + 1 == attempts:
                raise
