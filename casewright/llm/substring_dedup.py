"""Removes every byte of a string of 200 bytes that occurs twice, by merging Burrows-Wheeler transforms (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from casewright.llm import bloom
from casewright.llm.common import as_bytes, join_unique, slices
from casewright.session import stage

#: Bytes of the string a window is sorted by, see ``anchors``.
_GRAM = 32
#: Bytes of text one merge takes, and one shard of it.
_MERGE_BYTES, _SHARD_BYTES = 2 << 20, 1 << 19
#: Distinct segments around one gram beyond which its windows are counted one by one instead.
_HOT_SEGMENTS = 4000
#: Window starts looked at together: of one text, or of several short ones. The arrays over them stay in a core's cache.
_PART = 1 << 16
#: Ways a window may lie around its anchor that are told apart before a merge.
_SIDES = 8
#: Between strings; no byte of UTF-8.
_END = 0xFF
_LOW = (1 << 24) - 1
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
#: Anchors expected in a document, for the size of the filters only.
_ANCHORS = 48


# ---- cutting texts into segments ---------------------------------------------------------------

def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window start, number of windows, place of the gram, gram) of every segment of the texts.

    Each window of ``length`` bytes has an anchor: of its 32-byte strings, the leftmost one with the smallest hash. Equal
    windows have equal anchors at equal places, so only windows with the same gram can be equal. A segment is a run of
    neighbouring windows with one anchor. Short texts are looked at together, as a call costs more than what it does to one.
    """
    found, rows, bases, parts, size = [], [], [], [], 0
    for i, text in enumerate(texts):
        for base in range(0, len(text) - length + 1, _PART):
            part = text[base:base + _PART + length - 1]
            if size + len(part) > _PART and parts:
                found.append(_anchors(rows, bases, parts, length))
                rows, bases, parts, size = [], [], [], 0
            rows.append(i), bases.append(base), parts.append(part)
            size += len(part)
    if parts:
        found.append(_anchors(rows, bases, parts, length))
    if not found:
        return *(np.empty(0, np.int64) for _ in range(4)), np.empty(0, np.uint64)
    return tuple(map(np.concatenate, zip(*found)))


def _anchors(rows: list[int], bases: list[int], parts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """``anchors`` of parts of texts, each of ``length`` bytes or more, as one string; windows over an end do not count."""
    text = b"".join(parts)
    sizes = np.array(list(map(len, parts)))
    ends = np.cumsum(sizes)
    width = length - _GRAM + 1
    n, m = len(text) - _GRAM + 1, len(text) - length + 1
    words = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,)).copy()
    h, other = words[:n] * _FACTORS[0], np.empty(n, np.uint64)
    for i in range(1, _GRAM // 8):
        h ^= np.right_shift(h, np.uint64(29), out=other)
        h += words[8 * i:8 * i + n]
        h *= _FACTORS[i]
    h ^= np.right_shift(h, np.uint64(32), out=other)
    keys = np.bitwise_and(h, np.uint64(2**64 - 1 - _LOW), out=other)
    keys |= np.arange(n, dtype=np.uint64)
    span = 1
    while 2 * span <= width:  # the least key of ``span`` places
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    least = np.minimum(keys[:m], keys[width - span:width - span + m])
    whole = np.repeat(ends, sizes)[:m] - np.arange(m) >= length
    edge = np.ones(m, bool)
    np.not_equal(least[1:], least[:-1], out=edge[1:])
    edge[1:] |= whole[1:] != whole[:-1]
    edge[ends[ends < m]] = True
    first = np.flatnonzero(edge)
    counts = np.diff(np.append(first, m))[whole[first]]
    first = first[whole[first]]
    place = (least[first] & np.uint64(_LOW)).astype(np.int64)
    part = np.searchsorted(ends, first, "right")
    moved = np.array(bases) - (ends - sizes)
    return np.array(rows)[part], first + moved[part], counts, place + moved[part], h[place]


def _segments(texts: list[bytes], length: int, *filters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Text, start, windows, place of the gram in it, gram and bytes of the segments whose gram all filters hold."""
    rows, starts, counts, places, grams = anchors(texts, length)
    held = np.ones(len(grams), bool)
    for bits in filters:
        held &= bloom.holds(bits, grams)
    rows, starts, counts, places, grams = rows[held], starts[held], counts[held], places[held], grams[held]
    ends = starts + counts + length - 1
    return rows, starts, counts, places - starts, grams, [texts[i][a:b] for i, a, b in zip(rows.tolist(), starts.tolist(), ends.tolist())]


def _keys(segments: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh128_digest, segments)), np.int64).reshape(-1, 2)


def may_share(segments: list[bytes], places: list[int], length: int) -> np.ndarray:
    """Whether a segment may have a window in common with another one; ``places`` are those of the grams.

    A window reaches a bytes to the left of its gram. Those with a from k * step to (k + 1) * step - 1 all hold the k * step bytes
    before the gram, and as many after it as the shortest of them has there; so segments that differ there for every k share none.
    """
    width = length - _GRAM + 1
    step = -(-width // _SIDES)
    reach = [(a, _GRAM + max(width - step - a, 0)) for a in range(0, width, step)]
    first: dict[tuple[int, bytes], int] = {}
    out = np.zeros(len(segments), bool)
    for i, (segment, at) in enumerate(zip(segments, places)):
        for left, right in reach:
            if left > at:
                break
            if at + right <= len(segment):
                other = first.setdefault((left, segment[at - left:at + right]), i)
                if other != i:
                    out[i] = out[other] = True
    return out


# ---- merging Burrows-Wheeler transforms -----------------------------------------------------------

def _suffix_array(text: np.ndarray, deepest: int = 256) -> np.ndarray:
    """Places of the suffixes in the order of their first ``deepest`` bytes, by doubling; only ties are sorted again."""
    n = len(text)
    words = np.ndarray((n,), ">u8", np.concatenate([text, np.zeros(8, np.uint8)]).tobytes(), 0, (1,)).astype(np.uint64)
    order = np.argsort(words, kind="stable")
    new = np.concatenate([[True], words[order][1:] != words[order][:-1], [True]])
    rank = np.empty(n, np.int64)  # where the suffix's group of ties starts in the order
    rank[order] = np.maximum.accumulate(np.where(new[:-1], np.arange(n), 0))
    tied = np.flatnonzero(~(new[:-1] & new[1:]))
    step = 8
    while len(tied) and step < deepest:
        own = order[tied]
        after = np.where(own + step < n, rank[np.minimum(own + step, n - 1)] + 1, 0)
        keys = rank[own] * (n + 1) + after
        turn = np.argsort(keys, kind="stable")
        own, keys = own[turn], keys[turn]
        order[tied] = own
        new = np.concatenate([[True], keys[1:] != keys[:-1], [True]])
        rank[own] = tied[np.maximum.accumulate(np.where(new[:-1], np.arange(len(tied)), 0))]
        tied = tied[~(new[:-1] & new[1:])]
        step *= 2
    return order


def shard_transform(strings: list[bytes], step: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transform, LF, suffix array) of one shard: the strings, each with an end, as one text.

    ``transform[i]`` is the symbol before the suffix in row i, which is the ``step`` bytes there as a number; one that
    holds an end is the largest number. ``LF[i]`` is the row of the suffix that is longer by that symbol.
    """
    text = np.frombuffer(bytes([_END]).join(strings) + bytes([_END]), np.uint8)
    suffixes = _suffix_array(text)
    row = np.empty(len(text), np.int32)
    row[suffixes] = np.arange(len(text), dtype=np.int32)
    symbols, ends = np.zeros(len(text), np.uint64), np.zeros(len(text), bool)
    for back in range(step, 0, -1):
        before = np.roll(text, back)
        symbols = symbols * np.uint64(256) + before
        ends |= before == _END
    symbols[ends] = np.iinfo(np.uint64).max
    return symbols[suffixes], row[(suffixes - step) % len(text)], suffixes


def shared_prefixes(strings: list[bytes], most: int, shard_bytes: int | None = None, step: int | None = None, full: bool = False) -> list[np.ndarray]:
    """For every string and place in it, how many bytes, up to ``most``, its suffix shares with another suffix.

    The strings are dealt to shards, each with its own transform. The transforms are merged by refining their interleave:
    a round turns the order of all suffixes by their first h bytes into that by the first h + ``step``, by reading the
    symbols before them in that order, dealing them out by symbol, and keeping the order within (a stable step). Suffixes
    that are alike so far form an interval; one that is alone has its longest shared prefix, and, as all longer suffixes
    that end in it are alone too, is not read again. Those in a common interval at the end share ``most`` bytes.

    A symbol is one byte, or 2, 4 or 8 bytes where that divides ``most`` and the strings hold few enough different ones;
    prefixes are then counted in whole symbols. A prefix that runs over the end of a string does not count.

    With ``full`` only prefixes of all ``most`` bytes are looked for, and other places get some smaller number: a round then
    needs the suffixes from which the rounds to come lead to the start of such a prefix, and reads no others.
    """
    shards, size = [[]], 0
    limit = shard_bytes or _SHARD_BYTES
    for i, s in enumerate(strings):
        if size > limit:
            shards.append([])
            size = 0
        shards[-1].append(i)
        size += len(s) + 1
    for width in [step] if step else [w for w in (8, 4, 2, 1) if most % w == 0]:
        parts = [shard_transform([strings[i] for i in shard], width) for shard in shards]
        read = np.concatenate([p[0] for p in parts])
        known = np.unique(read)
        if width == 1 or step or len(known) < 65_535:
            break
    base = np.cumsum([0, *(len(p[0]) for p in parts)])
    symbol = np.searchsorted(known, read).astype(np.uint16 if len(known) < 65_535 else np.int32)
    end = len(known) - (known[-1] == np.iinfo(np.uint64).max)  # the symbols with an end in them
    follow = np.concatenate([p[1] + b for p, b in zip(parts, base)]).astype(np.int32)
    place = np.concatenate([p[2] + b for p, b in zip(parts, base)])
    del parts, read
    shared = np.zeros(base[-1], np.int16)
    rows = np.arange(base[-1], dtype=np.int32)  # the interleave of no rounds: shard after shard
    if full:
        sizes = np.array([len(strings[i]) + 1 for shard in shards for i in shard], np.int64)
        within = np.arange(base[-1]) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = rows[(within >= most)[place]]
    interval = np.zeros(len(rows), np.int32)
    for h in range(width, most + 1, width):
        found = symbol[rows]
        order = np.argsort(found, kind="stable")
        found = found[order]
        order = order[:np.searchsorted(found, end)]
        if not len(order):
            break
        found, before = found[:len(order)], interval[order]
        new = np.ones(len(order) + 1, bool)
        np.not_equal(found[1:], found[:-1], out=new[1:-1])
        new[1:-1] |= before[1:] != before[:-1]
        kept = ~(new[:-1] & new[1:])
        rows = follow[rows[order[kept]]]
        interval = np.cumsum(new[:-1], dtype=np.int32)[kept]
        shared[rows] = h
    by_place = np.empty(base[-1], np.int16)
    by_place[place] = shared
    out, at = [], 0
    for shard in shards:
        for i in shard:
            n = len(strings[i])
            out.append(np.minimum(by_place[at:at + n], np.arange(n, 0, -1)))
            at += n + 1
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


# ---- the operator ---------------------------------------------------------------------------------

def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """(id, version, spans) of the texts with repeats: ``spans`` lists (first, last) window starts, not yet put together.

    1. All texts' anchors fill a once-seen and a twice-seen filter; windows whose gram occurs once cannot repeat.
    2. Segments at the other anchors are listed, and counted by their hash: copies collapse, a segment that is there
       twice repeats as a whole.
    3. Segments that differ but share a gram are brought together by gram, in groups of bounded size. Those that differ from
       all others around the gram go; the transforms of the others' shards are merged. Windows of a gram with very many
       different segments are counted by hash instead, so no group grows with the data.
    4. What repeats in a segment is joined back to its places.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    size = bloom.bits_for(narrow.count() * _ANCHORS)

    def grams_of(batch: pa.RecordBatch) -> np.ndarray:
        return anchors(as_bytes(batch.column("text")), length)[4]

    twice = bloom.share(docs, bloom.build(narrow.select("text"), grams_of, size, "substring-filters")[1])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, first, windows, _, grams, parts = _segments(as_bytes(batch.column("text")), length, twice.value)
            keys = _keys(parts)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("version").take(at), pa.array(first), pa.array(windows.astype(np.int32)),
                 pa.array(grams.view(np.int64)), pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=["id", "version", "start", "windows", "gram", "h1", "h2"])

    located = stage(narrow.mapInArrow(locate, f"id {kind}, version long, start long, windows int, gram long, h1 long, h2 long"), "substring-places")
    segment = ["gram", "h1", "h2"]
    counted = stage(located.groupBy(*segment).agg(F.count("*").alias("n"), F.first("windows").alias("windows")), "substring-segments")
    grams = stage(counted.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "substring-grams")
    kinds, n_grams = grams.agg(F.coalesce(F.sum("kinds"), F.lit(0)), F.count("*")).first()
    gram_of = lambda b: b.column("gram").to_numpy().view(np.uint64)
    several = bloom.share(docs, bloom.build(grams.select("gram"), gram_of, bloom.bits_for(n_grams), "substring-several")[0])
    crowded = grams.filter(F.col("kinds") > _HOT_SEGMENTS).select("gram")
    n_crowded = crowded.count()
    hot = bloom.share(docs, bloom.build(crowded, gram_of, bloom.bits_for(n_crowded), "substring-hot")[0])
    groups = max(1, -(-kinds * 320 // _MERGE_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches):
            _, _, _, places, gram, parts = _segments(as_bytes(batch.column("text")), length, twice.value, several.value)
            fresh = []
            for i, part in enumerate(parts):
                key = xxhash.xxh128_digest(part)
                if key not in seen:
                    if len(seen) > 100_000:  # forgetting only lets a copy through
                        seen.clear()
                    seen.add(key)
                    fresh.append(i)
            contents, gram, places = [parts[i] for i in fresh], gram[fresh].view(np.int64), places[fresh].astype(np.int32)
            keys = _keys(contents)
            mixed = (gram.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            yield pa.RecordBatch.from_arrays(
                [pa.array((mixed % np.uint64(groups)).astype(np.int64)), pa.array(bloom.holds(hot.value, gram.view(np.uint64))), pa.array(gram), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                 pa.array(places), pa.array(contents, pa.binary())], names=["bucket", "hot", *segment, "place", "content"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["h1", "h2", "gram"])
        rows = rows[may_share(rows["content"].tolist(), rows["place"].tolist(), length)].reset_index(drop=True)
        found = []
        if len(rows):
            for i, shared in enumerate(shared_prefixes(rows["content"].tolist(), length, full=True)):
                found += [(i, a, b) for a, b in zip(*_runs(shared >= length))]
        found = np.array(found, np.int64).reshape(-1, 3)
        return pd.DataFrame({c: rows[c].to_numpy(np.int64)[found[:, 0]] for c in segment} | {"a": found[:, 1].astype(np.int32), "b": found[:, 2].astype(np.int32)})

    cut_schema = "bucket long, hot boolean, gram long, h1 long, h2 long, place int, content binary"
    pieces = narrow.select("text").mapInArrow(cut, cut_schema)
    if n_crowded:  # then two steps read the pieces
        pieces = stage(pieces, "substring-pieces")
    merged = pieces.filter(~F.col("hot")).groupBy("bucket").applyInPandas(merge, "gram long, h1 long, h2 long, a int, b int")
    if n_crowded:
        merged = merged.unionByName(_counted_windows(stage(pieces.filter("hot").drop("bucket", "hot", "place").dropDuplicates(segment), "substring-crowded"), length))
    # A segment that is there twice repeats as a whole, whatever the merge says of its parts.
    partly = merged.groupBy(*segment).agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("windows").alias("b")))
    found = stage(counted.filter("n > 1").select(*segment, "n", whole.alias("runs")).unionByName(
        counted.filter("n = 1").join(partly, segment).select(*segment, "n", "runs")), "substring-found")
    spans = (join_unique(located, found, segment, "n", located.count(), "inner")
             .select("id", "version", F.explode(F.transform("runs", lambda r: F.struct((F.col("start") + r.a).alias("a"), (F.col("start") + r.b).alias("b")))).alias("span")))
    return spans.groupBy("id", "version").agg(F.collect_set("span").alias("spans"))


def _counted_windows(crowded: DataFrame, length: int) -> DataFrame:
    """(gram, h1, h2, a, b) of the repeated windows of distinct segments, by counting the windows' hashes."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, first, windows = [], [], []
                for i, content in enumerate(part.column("content").to_pylist()):
                    n = len(content) - length + 1
                    rows += [i] * n
                    first += range(n)
                    windows += [content[a:a + length] for a in range(n)]
                keys = _keys(windows)
                index = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(index) for c in ("gram", "h1", "h2")), pa.array(first, pa.int32()), pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                                                 names=["gram", "h1", "h2", "a", "w1", "w2"])

    windows = crowded.mapInArrow(explode, "gram long, h1 long, h2 long, a int, w1 long, w2 long")
    often = stage(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1"), "substring-windows")
    total = often.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0]
    return join_unique(windows, often, ["w1", "w2"], "n", total, "inner").select("gram", "h1", "h2", "a", (F.col("a") + 1).alias("b"))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept (binary) and removed (array of [start, end) in bytes) for every row.

    Every byte goes that a string of ``length`` bytes covers which also starts anywhere else, in the same or another
    text; judged on the input, so of copies none stays. A null text is empty; repeated rows are copies of each other; a
    kept text may be cut within a character, so it is binary. Only the two named columns are read.
    """
    if length < 2 * _GRAM:
        raise ValueError(f"length must be {2 * _GRAM} or more")
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    found = repeats(docs, id_col, text_col, length).select(F.col("id").alias("__id"), F.col("version").alias("__version"), "spans")
    kind = narrow.schema["id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, gone, kept, removed = [], [], [], []
            spans = batch.column("spans")
            ends = spans.flatten()
            first, last = (np.asarray(ends.field(c)) for c in ("a", "b"))
            at = 0
            for text, n in zip(as_bytes(batch.column("text")), pa.compute.list_value_length(spans).fill_null(0).to_pylist()):
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, first[at:at + n], 1)
                np.add.at(change, last[at:at + n] + length - 1, -1)
                at += n
                starts, stops = _runs(np.cumsum(change[:-1]) > 0) if n else (np.empty(0, int), np.empty(0, int))
                edges = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(text)]
                sizes.append(len(text))
                gone.append(int((stops - starts).sum()))
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append(np.stack([starts, stops], axis=1).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(map(len, removed), pa.int64()),
                                              pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pa.list_(pa.int64())))],
                                             names=["id", "n_bytes", "n_removed", "n_spans", "kept", "removed"])

    joined = narrow.join(found, F.col("id").eqNullSafe(F.col("__id")) & F.col("version").eqNullSafe(F.col("__version")), "left").select("id", "text", "spans")
    return joined.mapInArrow(remove, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, removed array<array<bigint>>")
