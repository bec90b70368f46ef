"""SimHash fingerprints linked through vantage-point trees (operator 9)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm import bloom
from casewright.llm.common import as_bytes, components, join_unique, slices
from casewright.session import stage

#: The 64 bits are cut into this many blocks, each with a tree of its own.
_BLOCKS = 4
_BLOCK_BITS = 16
#: Fingerprints a leaf should hold, by the number of parts: every copy of a fingerprint of several parts is as wide as they are
#: together, so larger leaves, which are visited less often, are worth the longer comparisons there.
_LEAF = {1: 4096, 4: 16384}
#: Most fingerprints on one side of one comparison.
_SIDE = {1: 8192, 4: 32768}
_STEP = 1 << 16
#: Copies of a fingerprint that one round of meetings shuffles, on average. The trees get deeper with the number of fingerprints and the
#: copies more, so there are more rounds, and what is on disk at once follows the fingerprints.
_COPIES = 24
#: Most texts and bytes of text of one piece of a group whose texts are compared exactly.
_PIECE, _PIECE_BYTES = 1024, 4 << 20
#: Copies of a text that one round of these comparisons shuffles, on average.
_TEXT_COPIES = 4
#: Hashes below this are small: three in ten, so that a text of its own has more of them than a prefix is long. A text has about 96; the
#: twice-seen filter is emptier than the once-seen one, and takes a quarter of the usual bits for each.
_SMALL, _SMALL_SHINGLES = np.uint64(3 * 2**64 // 10), 96 // 4
_PARITY_BITS = 512


def shingle_hashes(text: bytes, words_per_shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each of a text's shingles, A-Z lower-cased; empty without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - words_per_shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    first, last = (ends - lengths)[:n].tolist(), (ends[-n:] - 1).tolist()
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(first, last)), np.uint64, n)


def fingerprint(text: bytes, words_per_shingle: int, n_parts: int = 1) -> list[int]:
    """SimHash of a text's shingles, A-Z lower-cased, in parts of 64 bits; all 0 without words.

    The first part is that of the shingles' XXH64 (seed 42); the others are those of hashes mixed from it. With several
    parts a repeated shingle counts once, as in a Jaccard similarity.
    """
    every = shingle_hashes(text, words_per_shingle)
    if n_parts > 1:
        every = np.unique(every)
    n = len(every)
    if not n:
        return [0] * n_parts
    ones = np.zeros((n_parts, 64), np.int64)
    for at in range(0, n, _STEP):
        hashes = every[at:at + _STEP]
        for part in range(n_parts):
            if part:
                hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                hashes ^= hashes >> np.uint64(29)
            ones[part] += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, axis=1, bitorder="little")
    return bits.view(np.uint64)[:, 0].tolist()


def _sized(sizes: dict[int, int], n_parts: int) -> int:
    return sizes[1] if n_parts == 1 else sizes[4]


def _parts(n_parts: int) -> list[str]:
    return [f"part{i}" for i in range(n_parts)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4, n_parts: int = 1) -> DataFrame:
    """(id, version, part0, ...): version is a hash of the text, the parts are signed longs. A null text has no words."""
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    names = _parts(n_parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, words_per_shingle, n_parts) for t in as_bytes(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("version"), *(pa.array(found[:, i]) for i in range(n_parts))],
                                             names=["id", "version", *names])

    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, version long, " + ", ".join(f"{c} long" for c in names))


@dataclass
class Forest:
    """Where each value of each block goes: its home leaf first, then the smaller leaves that its ball reaches into.

    ``starts[b]`` and ``leaves[b]`` list the leaves by value; ``homes[b]`` and ``visits[b]`` count fingerprints by leaf.
    """

    starts: list[np.ndarray]
    leaves: list[np.ndarray]
    homes: list[np.ndarray]
    visits: list[np.ndarray]


def _tree(weight: np.ndarray, radius: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A vantage-point tree over the values of one block, ``weight[v]`` = fingerprints with value v.

    A node of more than ``most`` fingerprints splits its values by their distance to a vantage point at the weighted median. A value also visits a branch
    that is not its own when the triangle inequality leaves room there for a value within ``radius``.
    """
    present = np.flatnonzero(weight).astype(np.int32)
    home = np.full(len(weight), -1, np.int32)
    reach: list[tuple[np.ndarray, int]] = []
    leaf = 0
    stack = [(present, present)]
    while stack:
        own, near = stack.pop()
        if len(own) == 0:
            continue
        total = weight[own].sum()
        split = None
        if total > most and len(own) > 1:
            # Of a few candidates take the vantage point that halves the node best.
            for point in own[np.linspace(0, len(own) - 1, min(len(own), 5)).astype(int)]:
                gaps = np.bitwise_count(own ^ point)
                inside = np.cumsum(np.bincount(gaps, weights=weight[own], minlength=_BLOCK_BITS + 1))
                at = int(np.argmin(np.abs(inside - total / 2)))
                if inside[at] < total and (split is None or abs(inside[at] - total / 2) < split[0]):
                    split = abs(inside[at] - total / 2), point, at
        if split is None:
            home[own] = leaf
            reach.append((near, leaf))
            leaf += 1
            continue
        _, point, at = split
        own_gap, near_gap = (np.bitwise_count(x ^ point).astype(int) for x in (own, near))
        stack.append((own[own_gap > at], near[near_gap + radius > at]))
        stack.append((own[own_gap <= at], near[near_gap - radius <= at]))
    values = np.concatenate([v for v, _ in reach]) if reach else np.empty(0, int)
    at_leaf = np.concatenate([np.full(len(v), k, np.int32) for v, k in reach]) if reach else np.empty(0, np.int32)
    kept = at_leaf <= home[values]  # each pair of leaves is met from one side
    values, at_leaf = values[kept], at_leaf[kept]
    order = np.lexsort((-at_leaf, values))
    values, at_leaf = values[order], at_leaf[order]
    starts = np.searchsorted(values, np.arange(len(weight) + 1))
    homes = np.bincount(home[present], weights=weight[present], minlength=leaf).astype(np.int64)
    return starts, at_leaf, homes, np.bincount(at_leaf, weights=weight[values], minlength=leaf).astype(np.int64)


def plant(fps: DataFrame, radius: int) -> Forest:
    """Trees for the blocks of all parts of the distinct fingerprints, from the counts of at most 65,536 values a block."""
    trees = []
    parts = [c for c in fps.columns if c.startswith("part")]
    most = _sized(_LEAF, len(parts))
    for part in parts:  # one part at a time: at most 262,144 counts are here
        blocks = F.explode(F.array(*[F.struct(F.lit(b).alias("block"), F.shiftright(part, b * _BLOCK_BITS).bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int").alias("value"))
                                     for b in range(_BLOCKS)]))
        counts = fps.select(blocks.alias("x")).groupBy("x.block", "x.value").count().toArrow()
        block, value, count = (counts.column(c).to_numpy() for c in ("block", "value", "count"))
        for b in range(_BLOCKS):
            weight = np.zeros(1 << _BLOCK_BITS, np.int64)
            weight[value[block == b]] = count[block == b]
            trees.append(_tree(weight, radius, most))
    return Forest(*map(list, zip(*trees)))


def _copies(forest: Forest, side: int) -> list[int]:
    """How many rows ``link`` sends to the leaves of each block."""
    counts = []
    for homes, visits in zip(forest.homes, forest.visits):
        bases, askers = -(-homes // side), -(-visits // side)
        cut = (askers > 1) | (bases > 1)
        counts.append(int((visits * bases).sum() + (homes * askers)[cut].sum()))
    return counts


def _rounds(copies: list[int], most: int) -> list[list[int]]:
    """Blocks by round, in order: each round has ``most`` copies or fewer, or one block."""
    rounds, filled = [], 0
    for b, n in enumerate(copies):
        if not rounds or filled + n > most:
            rounds.append([])
            filled = 0
        rounds[-1].append(b)
        filled += n
    return rounds


def _links(base: np.ndarray, asking: np.ndarray, part: int, probe_bits: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (asking, base) that connect all fingerprints linked here: one for each, not one for each link.

    ``base`` and ``asking`` have a row for each fingerprint and a column for each part; two link at ``probe_bits`` or
    fewer in ``part`` and ``max_bits`` or fewer in all. Numbers of the base follow those of the asking.
    """
    group = np.arange(len(base))
    asked, answer = [], []
    step = max(1, (1 << 21) // max(len(base), 1))
    own, others = base[:, part].copy(), asking[:, part].copy()
    for at in range(0, len(asking), step):
        close = np.bitwise_count(others[at:at + step, None] ^ own[None, :]) <= probe_bits
        for i in np.flatnonzero(close.any(axis=1)):
            hits = np.flatnonzero(close[i])
            if base.shape[1] > 1:
                hits = hits[np.bitwise_count(base[hits] ^ asking[at + i]).sum(axis=1, dtype=np.int64) <= max_bits]
            if len(hits):
                asked.append(at + i)
                answer.append(hits[0])
                labels = np.unique(group[hits])
                if len(labels) > 1:
                    group[np.isin(group, labels[1:])] = labels[0]
    n = len(asking)
    return (np.concatenate([np.array(asked, int), n + np.arange(len(base))]), np.concatenate([n + np.array(answer, int), n + group]))


def link(fps: DataFrame, probe_bits: int, max_bits: int, radius: int | None = None) -> DataFrame:
    """(a, b): links between the distinct fingerprints (``node``, parts) that make the same components as all links.

    Two link at ``probe_bits`` or fewer in some part and ``max_bits`` or fewer in all. Every fingerprint goes to its home
    leaf in each tree and, as a question, to the leaves its ball reaches into. Leaves that are too large for one task are
    cut on both sides, and every piece meets every other. The trees are asked in rounds of about ``_COPIES`` copies of each
    fingerprint; a round's shuffle files go before the next one.

    Of two parts at ``probe_bits`` or fewer bits, some block differs in at most a quarter of them, the ``radius`` if none
    is given. With a smaller one two link only if some block of the four of some part differs in so many bits at most, or
    if they share a leaf.
    """
    parts = [c for c in fps.columns if c.startswith("part")]
    side = _sized(_SIDE, len(parts))
    context = fps.sparkSession.sparkContext
    planted = plant(fps, probe_bits // _BLOCKS if radius is None else radius)
    shared = context.broadcast(planted)  # four arrays of at most 65,536 values' leaves for each block

    def send(batches: Iterator[pa.RecordBatch], blocks: list[int]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            node = batch.column("node").to_numpy()
            fp = np.stack([batch.column(c).to_numpy() for c in parts], axis=1)
            mixed = ((node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            for b in blocks:
                value = ((fp[:, b // _BLOCKS].view(np.uint64) if len(parts) == 1 else fp[:, b // _BLOCKS].copy().view(np.uint64))
                         >> np.uint64(b % _BLOCKS * _BLOCK_BITS)).astype(np.int64) & ((1 << _BLOCK_BITS) - 1)
                starts, leaves = forest.starts[b], forest.leaves[b]
                many = starts[value + 1] - starts[value]
                row = np.repeat(np.arange(len(node)), many)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                leaf = leaves[starts[value][row] + nth]
                bases, askers = -(-forest.homes[b] // side), -(-forest.visits[b] // side)
                for asking in (False, True):
                    # A fingerprint is a base at home, and asks at home and where it visits; each copy meets all pieces of the other side.
                    chosen = slice(None) if asking else nth == 0
                    if not asking:
                        chosen = (nth == 0) & ((askers[leaf] > 1) | (bases[leaf] > 1))  # in an uncut leaf the base is among those that ask
                    r, k = row[chosen], leaf[chosen]
                    home = (nth == 0)[chosen]
                    other = (bases if asking else askers)[k]
                    r2 = np.repeat(np.arange(len(r)), other)
                    piece = np.arange(len(r2)) - np.repeat(np.cumsum(other) - other, other)
                    mine = mixed[r[r2]] % np.maximum((askers if asking else bases)[k[r2]], 1)
                    base_piece, ask_piece = (piece, mine) if asking else (mine, piece)
                    uncut = (askers[k[r2]] == 1) & (bases[k[r2]] == 1)
                    role = np.where(uncut & home[r2], 2, int(asking)).astype(np.int8)  # 0 base, 1 asking, 2 both
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(r2), b, np.int32)), pa.array(k[r2].astype(np.int32)), pa.array(base_piece.astype(np.int32)), pa.array(ask_piece.astype(np.int32)),
                         pa.array(role), pa.array(node[r[r2]]), *(pa.array(fp[r[r2], i]) for i in range(len(parts)))],
                        names=["block", "leaf", "base", "ask", "role", "node", *parts])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        role, node, fp = rows["role"].to_numpy(), rows["node"].to_numpy(np.int64), rows[parts].to_numpy(np.int64).view(np.uint64)
        base, asking = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
        a, b = _links(np.ascontiguousarray(fp[base]), np.ascontiguousarray(fp[asking]), int(rows["block"].iloc[0]) // _BLOCKS, probe_bits, max_bits)
        both = np.concatenate([node[asking], node[base]])
        a, b = both[a], both[b]
        return pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    kinds = ", ".join(f"{c} long" for c in parts)
    rounds = _rounds(_copies(planted, side), _COPIES * int(planted.homes[0].sum()))

    def met(blocks: list[int]) -> DataFrame:
        sent = fps.select("node", *parts).mapInArrow(lambda batches: send(batches, blocks), f"block int, leaf int, base int, ask int, role byte, node long, {kinds}")
        return sent.groupBy("block", "leaf", "base", "ask").applyInPandas(meet, "a long, b long").distinct()

    if len(rounds) == 1:
        return met(rounds[0])
    found = [stage(met(blocks), f"simhash-links-{i}") for i, blocks in enumerate(rounds)]
    return reduce(DataFrame.unionByName, found).distinct()


def _prefix(size: int, least: float) -> int:
    """Of two sets at a Jaccard similarity of ``least`` or more the first so many elements share one, whatever the common order."""
    return size - math.ceil(least * size - 1e-9) + 1


def _parity(hashes: np.ndarray) -> np.ndarray:
    """A bit for each of ``_PARITY_BITS`` buckets: whether an odd number of the distinct hashes is in it. Sets differ in as many elements as bits, at least."""
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (_PARITY_BITS - 1), minlength=_PARITY_BITS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def _maybe_alike(sizes: np.ndarray, odd: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs that connect all sets which may, by sizes and parities, have a Jaccard similarity of ``least`` or more."""
    group, found = np.arange(len(sizes)), []
    for i in range(1, len(sizes)):
        differ = np.bitwise_count(odd[:i] ^ odd[i]).sum(axis=1, dtype=np.int64)
        small, large = np.minimum(sizes[:i], sizes[i]), np.maximum(sizes[:i], sizes[i])
        maybe = (differ * (1 + least) <= (1 - least) * (sizes[:i] + sizes[i]) + 1e-6) & (small >= least * large - 1e-9)
        for j in np.flatnonzero(maybe).tolist():
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                found.append((i, j))
    return found


def _alike(sets: list[np.ndarray], side: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs at a Jaccard similarity of ``least`` or more that make the same components as all such pairs would.

    If ``side`` has two values only pairs across them are looked at. A set is compared with those that share one of its
    rarest elements, unless sizes or components decide the matter. Empty sets are alike.
    """
    sizes, group, crossing = np.array([len(s) for s in sets]), np.arange(len(sets)), len(np.unique(side)) > 1
    _, element, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    cuts = np.cumsum(sizes)[:-1]
    holders: dict[int, list[int]] = {}
    found = []
    for i, own in enumerate(np.split(element, cuts)):
        rarest = own[np.lexsort((own, counts[own]))][:_prefix(len(own), least)]
        keys = rarest[counts[rarest] > 1].tolist() if len(own) else [-1]
        near = [holders[k] for k in keys if k in holders]
        if near:
            others = np.unique(np.concatenate([np.array(x) for x in near]))
            small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
            others = others[(group[others] != group[i]) & (small >= least * large - 1e-9) & ((side[others] != side[i]) | (not crossing))]
            for j in others.tolist():
                if group[i] == group[j]:
                    continue
                both = np.concatenate([sets[i], sets[j]])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                if shared >= least * (len(both) - shared) - 1e-9:
                    group[group == group[j]] = group[i]
                    found.append((i, j))
        for k in keys:
            holders.setdefault(k, []).append(i)
    return found


def _held(keys: DataFrame, n: int, name: str) -> Callable[[Column], Column]:
    """A test whether a long is probably among the ``n`` of the one column of ``keys``; it never misses one that is."""
    shared = bloom.share(keys, bloom.build(keys, lambda b: b.column(0).to_numpy().view(np.uint64), bloom.bits_for(n), name)[0])

    @F.arrow_udf("boolean")
    def maybe(key: pa.Array) -> pa.Array:
        return pa.array(bloom.holds(shared.value, key.to_numpy(zero_copy_only=False).view(np.uint64)))

    return maybe


def sharing(fps: DataFrame, docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int, least: float) -> DataFrame:
    """(a, b): links within whose components all pairs of texts at a Jaccard similarity of ``least`` or more lie.

    Two such texts share a shingle among the first ``_prefix`` of each, in any order common to all texts. Here those that no
    other text has come first, as far as a twice-seen filter of the shingles with small hashes knows them; they link nothing
    and stay where they are. So a text with enough shingles of its own sends none. Of copies one row is read.
    """
    n = fps.count()
    first = _held(fps.select(F.xxhash64("node", "first.id").alias("row")), n, "simhash-first")
    version = F.xxhash64(text_col)
    texts = docs.filter(first(F.xxhash64(version, F.col(id_col)))).select(version.alias("node"), F.col(text_col).alias("text"))

    def small(batch: pa.RecordBatch) -> np.ndarray:
        found = [np.empty(0, np.uint64)]
        for part in slices([batch]):
            for t in as_bytes(part.column("text")):
                own = np.unique(shingle_hashes(t, words_per_shingle))
                found.append(own[:np.searchsorted(own, _SMALL)])
        return np.concatenate(found)

    twice = bloom.share(docs, bloom.build(texts, small, bloom.bits_for(n * _SMALL_SHINGLES), "simhash-shingles")[1])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, sizes, odd, keys = [], [], [], []
            for i, t in enumerate(as_bytes(batch.column("text"))):
                own = np.unique(shingle_hashes(t, words_per_shingle))
                known = bloom.holds(twice.value, own[:np.searchsorted(own, _SMALL)])
                left = _prefix(len(own), least) - int(np.count_nonzero(~known))
                if left > 0 and len(own):
                    rows.append(i), sizes.append(len(own)), odd.append(_parity(own))
                    keys.append(np.delete(own, np.flatnonzero(~known))[:left].view(np.int64))
            odd = np.array(odd, np.uint64).reshape(-1, len(odds)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                                              *(pa.array(odd[:, i]) for i in range(len(odds)))], names=["node", "size", "keys", *odds])

    odds = [f"odd{i}" for i in range(_PARITY_BITS // 64)]
    kinds = ", ".join(f"{c} long" for c in odds)
    sets = stage(texts.mapInArrow(send, f"node long, size long, keys array<long>, {kinds}").dropDuplicates(["node"]), "simhash-prefixes")
    sent = sets.select("node", F.explode("keys").alias("key"))
    shared = stage(sent.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1"), "simhash-shared")
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = stage(join_unique(sent, shared, "key", "n", total, "inner"), "simhash-sharing")
    bundles = max(1, -(-total // _STEP))

    def meet(table: pa.Table) -> pa.Table:
        key, node, size = (table.column(c).to_numpy() for c in ("key", "node", "size"))
        odd = np.stack([table.column(c).to_numpy() for c in odds], axis=1).view(np.uint64)
        order = np.lexsort((node, key))
        a, b = [], []
        for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            for i, j in _maybe_alike(size[own], odd[own], least):
                a.append(node[own[i]])
                b.append(node[own[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    few = rows.filter(F.col("n") <= _PIECE).join(sets.drop("keys"), "node").withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)))
    # A shingle of very many texts links them all; the exact comparison tells them apart.
    many = rows.filter((F.col("n") > _PIECE) & (F.col("node") != F.col("low"))).select(F.col("node").alias("a"), F.col("low").alias("b"))
    return few.select("bundle", "key", "node", "size", *odds).groupBy("bundle").applyInArrow(meet, "a long, b long").unionByName(many).distinct()


def confirmed(links: DataFrame, fps: DataFrame, docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int, least: float) -> DataFrame:
    """(a, b): links that make the components of all pairs of texts at a Jaccard similarity of ``least`` or more within those of ``links``.

    ``fps`` has a row (``node``, ``first``) for each distinct text. Of each text in ``links`` the row with its first id
    is fetched: a Bloom filter of these rows leaves all others where they are. The texts of a component are compared in one
    task if they are few; else they are cut into pieces, and every piece meets every other. Small components share tasks. The copies
    grow with the square of a large component, so pieces meet in rounds of about ``_TEXT_COPIES`` copies of each text, whose shuffle files go.
    """
    near = stage(fps.select("node", F.xxhash64("node", "first.id").alias("row")).join(components(links, "simhash-near"), "node"), "simhash-candidates")
    wanted = _held(near.select("row"), near.count(), "simhash-wanted")
    version = F.xxhash64(text_col)
    rows = docs.filter(wanted(F.xxhash64(version, F.col(id_col)))).select(version.alias("node"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = stage(rows.dropDuplicates(["node"]).join(near.drop("row"), "node").withColumn("bytes", F.octet_length("text").cast("long")), "simhash-texts")
    total, whole = texts.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    pieces = F.greatest(F.ceil(F.col("members") / _PIECE), F.ceil(F.col("size") / _PIECE_BYTES), F.lit(1)).cast("int")
    loads = texts.groupBy("root").agg(F.count("*").alias("members"), F.sum("bytes").alias("size")).withColumn("pieces", pieces)
    bundles = max(1, -(-total // _PIECE), -(-whole // _PIECE_BYTES))
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("pieces")).cast("int")
    bundle = F.when(F.col("pieces") == 1, F.pmod(F.xxhash64("root", F.lit(2)), F.lit(bundles))).otherwise(F.col("root"))
    sent = (join_unique(texts, loads, "root", "members", total, "inner").withColumn("piece", mine).withColumn("bundle", bundle)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
            .select("bundle", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"), "root", "node", "piece", "text"))

    def compare(table: pa.Table) -> pa.Table:
        root, node, piece = (table.column(c).to_numpy() for c in ("root", "node", "piece"))
        order = np.lexsort((node, root))
        sets = [np.unique(shingle_hashes(t.as_buffer().to_pybytes(), words_per_shingle)) for t in table.column("text")]
        a, b = [], []
        for rows in np.split(order, np.flatnonzero(np.diff(root[order])) + 1):
            for i, j in _alike([sets[r] for r in rows], piece[rows], least):
                a.append(node[rows[i]])
                b.append(node[rows[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    copies = loads.agg(F.coalesce(F.sum(F.col("members") * F.col("pieces")), F.lit(0))).first()[0]
    rounds = max(1, -(-copies // max(1, _TEXT_COPIES * total)))
    turn = F.pmod(F.xxhash64("bundle", "low", "high"), F.lit(rounds))

    def met(number: int) -> DataFrame:
        return sent.filter(turn == number).groupBy("bundle", "low", "high").applyInArrow(compare, "a long, b long").distinct()

    if rounds == 1:
        return met(0)
    return reduce(DataFrame.unionByName, [stage(met(i), f"simhash-confirmed-{i}") for i in range(rounds)]).distinct()


def classes(marked: DataFrame, probe_bits: int, max_bits: int, radius: int | None = None, confirm: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """``marked`` (id, version, parts) with ``component_id`` and ``keeper_version``: the smallest id in reach, and a text of it.

    Rows whose fingerprints are equal are one node, so a group of copies of any size costs one row; with ``confirm``, which
    maps the links and the fingerprints to the links that hold, it is rows whose texts are equal. Ids that are null come
    after all others; a component of null ids has a null component_id.
    """
    parts = [c for c in marked.columns if c.startswith("part")]
    node = F.col("version") if confirm else F.col(parts[0]) if len(parts) == 1 else F.xxhash64(*parts)
    marked = stage(marked.withColumn("node", node), "simhash-rows")
    total = marked.count()
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "version")).alias("first")
    fps = stage(marked.groupBy("node", *parts).agg(F.count("*").alias("n"), first), "simhash-fps")
    links = link(fps, probe_bits, max_bits, radius)
    found = stage(components(confirm(links, fps) if confirm else links, "simhash-links"), "simhash-components")
    grouped = stage(fps.select("node", "n", "first").join(found, "node", "left").select("node", "n", "first", F.coalesce("root", "node").alias("root")), "simhash-roots")
    heads = grouped.groupBy("root").agg(F.count("*").alias("members"), F.min("first").alias("head"))
    named = stage(join_unique(grouped.select("root", "node", "n"), heads, "root", "members", grouped.count(), "inner")
                  .select("node", "n", F.col("head.id").alias("component_id"), F.col("head.version").alias("keeper_version")), "simhash-heads")
    return join_unique(marked, named, "node", "n", total, "inner").drop("n", "node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 5, n_parts: int = 4,
                    probe_bits: int = 15, max_bits: int = 56, radius: int | None = 1, least: float = 0.8) -> DataFrame:
    """id, version, parts, component_id and keeper_version for every row of ``docs``.

    By default two texts link if the sets of their five-word shingles have a Jaccard similarity of ``least`` or more. The
    fingerprints, four parts of 64 bits, find most candidates: pairs at 56 bits or fewer, where 38.8 are expected at
    0.8, with a block of 16 bits that differs in one bit at most. Those that they miss have a rare shingle in common
    (``sharing``), so no pair is lost. One part and 4 bits are the classic form, which the bits alone decide.

    Texts without words, null ones included, have fingerprint zero and are linked like any other. Repeated rows stay
    repeated. An empty table gives an empty one. Only the two named columns are read.
    """
    marked = fingerprints(docs, id_col, text_col, words_per_shingle, n_parts)
    if n_parts == 1:
        return classes(marked, probe_bits, max_bits)

    def confirm(links: DataFrame, fps: DataFrame) -> DataFrame:
        every = links.unionByName(sharing(fps, docs, id_col, text_col, words_per_shingle, least))
        return confirmed(every, fps, docs, id_col, text_col, words_per_shingle, least)

    return classes(marked, probe_bits, max_bits, radius, confirm)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of every component: the first by id (nulls last), then by the hash of its text.

    Only rows that go, and those with an equal of the same id and text, are joined to the list of these; a Bloom filter of
    the list lets all others through where they are. ``docs`` must not have columns named ``__v``, ``__id``, ``__version``,
    ``__maybe`` or ``__stays``.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    stays = F.col("id").eqNullSafe(F.col("component_id")) & F.col("version").eqNullSafe(F.col("keeper_version"))
    listed = stage(found.select("id", "version", stays.alias("stays")).groupBy("id", "version", "stays").agg(F.count("*").alias("n"))
                   .filter("NOT stays OR n > 1"), "simhash-listed")
    n, repeated = listed.agg(F.count("*"), F.coalesce(F.max("stays"), F.lit(False))).first()
    if not n:
        return docs
    maybe = _held(listed.select(F.xxhash64("version", "id").alias("key")), n, "simhash-filter")
    rows = docs.withColumn("__v", F.xxhash64(text_col)).withColumn("__maybe", maybe(F.xxhash64("__v", F.col(id_col))))
    exact = listed.select(F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("stays").alias("__stays"))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__v") == F.col("__version"))
    # Rows that the filter lets through by chance are not on the list.
    kept = rows.filter("NOT __maybe").select(*docs.columns).unionByName(rows.filter("__maybe").join(exact, same, "left_anti").select(*docs.columns))
    if not repeated:
        return kept
    once = rows.filter("__maybe").join(exact.filter("__stays"), same).dropDuplicates(["__id", "__version"])
    return kept.unionByName(once.select(*docs.columns))
